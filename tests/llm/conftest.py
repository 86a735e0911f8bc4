import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def shipped(spark):
    from fleetstream.llm.storage import ship_package

    ship_package(spark)


@pytest.fixture
def documents(spark):
    return lambda rows: spark.createDataFrame(rows, "doc_id long, text string")


@pytest.fixture(scope="session")
def real(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    return [(r.doc_id, r.text) for r in rows]
