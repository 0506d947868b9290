import pytest

from monthmill.llm.common import importable
from monthmill.workspace import Workspace

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    importable(spark)


@pytest.fixture
def space(spark):
    workspace = Workspace(spark, "test")
    yield workspace
    workspace.close()


@pytest.fixture
def texts(spark):
    """Documents from (doc_id, text) pairs, with a further column of an unusual name."""

    def build(*rows):
        schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, size string"
        return spark.createDataFrame(
            [(key, text, "en", f"s{(key or 0) % 3}", len(text or ""), "x") for key, text in rows], schema
        )

    return build


@pytest.fixture
def given(spark):
    """One of the given tables at the smallest size."""
    return lambda name: spark.read.parquet(f"{SMALL}/{name}.parquet")
