"""Every registered query against its SQL, over the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from fleetstream.plans.catalog import QUERIES
from fleetstream.plans.oracles import ORACLES

SF = "/root/testdata/sf0.001"
TABLES = sorted(p.stem for p in Path(SF).glob("*.parquet"))
pytestmark = pytest.mark.skipif(not TABLES, reason="no test tables")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
    return a == b


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sql, name):
    df = entry.queries()[name](spark, SF)
    got = normal(df.collect(), df.columns)
    assert got
    result = sql.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(result.columns)
    want = normal(result.fetchall(), result.columns)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert all(same(x, y) for x, y in zip(a, b)), (a, b)


def test_logistic_queries_agree(spark):
    """Row weights and stored fanned-out rows lead to the same model."""
    by_weight, by_rows = (
        {r["position"]: r["weight"] for r in entry.queries()[name](spark, SF).collect()}
        for name in ("train_logistic_batch", "train_logistic_history")
    )
    assert by_weight == pytest.approx(by_rows, rel=1e-2, abs=1e-2)
