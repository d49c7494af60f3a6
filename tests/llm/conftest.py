import pytest
from edge_rows import COLUMNS, EDGE, SF



@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(EDGE, COLUMNS)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r["doc_id"]: r["text"] for r in documents.collect()}
