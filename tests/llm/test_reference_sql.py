import sys
from pathlib import Path

import pytest

from monthmill.llm.queries import QUERIES
from monthmill.llm.reference_sql import SQL
from tests.llm.conftest import SMALL

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from oracle_check import connect, differences  # noqa: E402


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_sql(spark, name):
    assert differences(QUERIES[name](spark, SMALL), connect(SMALL), SQL[name]) == []


@pytest.mark.parametrize("name", [name for name in QUERIES if name not in SQL])
def test_other_queries_have_all_rows(spark, name):
    table, key = {"op8": ("pages", "page_id"), "op12": ("embeddings", "vec_id")}.get(
        name.split("_")[0], ("documents", "doc_id")
    )
    rows = QUERIES[name](spark, SMALL)
    assert rows.select(key).distinct().count() == spark.read.parquet(f"{SMALL}/{table}.parquet").count()
