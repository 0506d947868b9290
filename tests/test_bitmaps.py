"""Distinct counts from numbered values and monthly bitmaps."""

import datetime

import pytest
from pyspark.sql import functions as F

from monthmill.catalog.queries import QUERIES
from monthmill.operators import bitmaps
from monthmill.operators.bitmaps import BitmapStore

SCHEMA = "day date, who string, amount double"


def d(text):
    return datetime.date.fromisoformat(text)


def counted(df):
    return {(r.level, r.period and str(r.period), r.column_name): r.distinct_count for r in df.collect()}


def test_one_scan_for_all_columns(spark, frame):
    plan = QUERIES["column_cardinality"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet [l_orderkey") == 1 and "Expand" not in plan
    rows = [(None, "a", 0.0), (None, "b", -0.0), (None, None, float("nan")), (None, "a", float("nan"))]
    found = bitmaps.distinct_counts(frame(SCHEMA, *rows), ["day", "who", "amount"])
    assert {r.column_name: r.distinct_count for r in found.collect()} == {"day": 0, "who": 2, "amount": 2}
    empty = bitmaps.distinct_counts(frame(SCHEMA), ["day", "who"])
    assert {r.column_name: r.distinct_count for r in empty.collect()} == {"day": 0, "who": 0}
    assert bitmaps.distinct_counts(frame(SCHEMA), []).count() == 0


def test_clashing_and_dotted_names(frame):
    df = frame("`a.b` string, column_name string, value int, _part int", ("x", "y", 1, 1), ("x", "z", 1, 2))
    found = bitmaps.distinct_counts(df, df.columns)
    assert {r.column_name: r.distinct_count for r in found.collect()} == {"a.b": 1, "column_name": 2, "value": 1, "_part": 2}


def test_months_merge_and_reruns_replace_them(spark, frame, tmp_path):
    store = BitmapStore(spark, str(tmp_path / "s"))
    assert counted(store.counts()) == {}
    first = [(d("2023-01-05"), "a", 1.0), (d("2023-01-30"), "b", 1.0), (d("2023-02-01"), "b", 2.0), (None, "never", 9.0)]
    store.store(frame(SCHEMA, *first), F.col("day"), ["who", "amount"])
    second = [(d("2023-02-02"), "c", 2.0), (d("2023-04-02"), "a", None)]
    store.store(frame(SCHEMA, *second), F.col("day"), ["who", "amount"], "2023-02-01", "2023-04-01")
    months = counted(store.counts(F.col("period"), "month"))
    assert months == {
        ("month", "2023-01-01", "who"): 2, ("month", "2023-01-01", "amount"): 1,
        ("month", "2023-02-01", "who"): 1, ("month", "2023-02-01", "amount"): 1,
        ("month", "2023-04-01", "who"): 1,
    }
    quarters = counted(store.counts(F.trunc("period", "quarter"), "quarter"))
    assert quarters["quarter", "2023-01-01", "who"] == 3 and quarters["quarter", "2023-04-01", "who"] == 1
    assert counted(store.counts())["whole", None, "who"] == 3
    # numbers are given once: b keeps its own although February no longer has it
    ids = {(r.column_name, r.value): r.value_id for r in store.ids().collect()}
    assert len(set(ids.values())) == len(ids) == 5


def test_numbers_over_several_buckets(spark, tmp_path):
    store = BitmapStore(spark, str(tmp_path / "s"))
    rows = spark.range(100_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("who"),
        F.expr("date_add(date'2023-01-15', cast(id % 2 as int) * 31)").alias("day"),
    )
    store.store(rows, F.col("day"), ["who"])
    values = 66_666 + 1
    assert counted(store.counts())["whole", None, "who"] == values
    assert store.bitmaps().agg(F.max("bucket")).first()[0] >= 2
    months = counted(store.counts(F.col("period"), "month"))
    assert sum(months.values()) == values + 1 and len(months) == 2


def test_a_run_lost_after_the_numbers(spark, frame, tmp_path, monkeypatch):
    store = BitmapStore(spark, str(tmp_path / "s"))
    rows = frame(SCHEMA, (d("2023-01-05"), "a", 1.0), (d("2023-01-06"), "b", 1.0))
    real = bitmaps.swap_in

    def lost(df, root, *args, **options):
        if root == store.bitmaps_root:
            raise RuntimeError("lost")
        real(df, root, *args, **options)

    monkeypatch.setattr(bitmaps, "swap_in", lost)
    with pytest.raises(RuntimeError):
        store.store(rows, F.col("day"), ["who"])
    assert counted(store.counts()) == {}
    monkeypatch.setattr(bitmaps, "swap_in", real)
    store.store(rows, F.col("day"), ["who"])
    assert counted(store.counts())["whole", None, "who"] == 2 and store.ids().count() == 2


def test_counts_read_bitmaps_only(spark, frame, tmp_path):
    store = BitmapStore(spark, str(tmp_path / "s"))
    store.store(frame(SCHEMA, (d("2023-01-05"), "a", 1.0)), F.col("day"), ["who"])
    plan = store.counts(F.trunc("period", "quarter"), "q")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan
