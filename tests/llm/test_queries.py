import duckdb
import pytest

from fleetstream.llm.queries import ORACLES, QUERIES
from tests.llm.conftest import SF


def test_one_query_per_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = con.sql(ORACLES[name])
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    rows = [tuple(r) for r in got.select(*want.columns).collect()]
    assert sorted(rows) == sorted(want.fetchall())
