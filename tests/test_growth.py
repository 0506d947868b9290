"""What a task holds and what a job writes must not grow faster than the input."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from monthmill.catalog import views
from monthmill.operators import asof, quantiles, sketches, summaries
from monthmill.plans import medallion
from monthmill.session import RUNTIME, tuned
from monthmill.sinks import writers


@pytest.mark.parametrize("n", [1, 500, 40_000])
def test_a_summary_keeps_ranks_and_ends(n):
    values = np.random.default_rng(n).permutation(n) / 7
    growing = summaries.Growing(200, 1000)
    for part in np.array_split(values, 37):
        growing.add(part)
    points, weights = growing.points()
    assert len(points) <= 202 and growing.count == n and weights.sum() == pytest.approx(n)
    for share, found in zip((0, 0.3, 0.5, 1), summaries.quantiles(points, weights, (0, 0.3, 0.5, 1)), strict=True):
        assert abs((values <= found).sum() / n - share) <= 0.01 + 1 / n
    assert summaries.quantiles(points, weights, [0, 1]) == [values.min(), values.max()]


def test_few_distinct_values_are_kept_exactly():
    points, weights = summaries.summary(np.repeat([3.0, 1.0, 2.0], [5, 7, 9]), 4)
    assert points.tolist() == [1, 2, 3] and weights.tolist() == [7, 9, 5]


def test_quantile_passes_make_no_wide_generated_code(spark):
    table = spark.range(10).select(*[F.col("id").cast("double").alias(f"c{n}") for n in range(3)])
    values = table.select(*[v.alias(n) for n, v in quantiles._numbers({c: F.col(c) for c in table.columns}).items()])
    whole = {n: quantiles._Interval(f"v{n}", None, None, 2**62) for n in range(3)}
    plan = quantiles.merged_states(values, whole)._jdf.queryExecution().executedPlan().toString()
    assert "kll" not in plan and "isnan" not in plan.lower()


def test_months_that_are_mixed_in_every_task_send_short_summaries(spark):
    rows = spark.range(0, 40_000, 1, 2).selectExpr("date_add('2024-01-01', int(id % 2)) as snapshot_date", "double(id) as v0")
    sent = rows.mapInArrow(sketches._task_sketches(["v"], 8, 4000, 100), sketches.SCHEMA)
    assert [row[0] for row in sent.select(F.size("points")).collect()] == [102] * 4


def test_a_session_built_elsewhere_gets_the_settings_it_lacks(spark):
    bare = spark.newSession()
    bare.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    bare.conf.set("spark.sql.codegen.hugeMethodLimit", "9000")
    tuned(bare)
    assert bare.conf.get("spark.sql.codegen.hugeMethodLimit") == "9000"
    for key in list(RUNTIME)[1:]:
        assert bare.conf.get(key) == RUNTIME[key]


def test_rows_per_task_are_bounded_where_rows_multiply(spark, tmp_path, monkeypatch):
    spark.range(1000).withColumnRenamed("id", "k").write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    monkeypatch.setattr(views, "ROWS_PER_TASK", 50)
    assert views.spread(table, "k", grows=True).rdd.getNumPartitions() == 20


def test_a_record_is_moved_once(spark):
    rows = spark.createDataFrame([("a", None, 1, "x")], "Customer_ID string, snapshot_date date, n int, t string")
    records = asof.one_record_per_date(asof.Feature("f", rows))
    plan = records._jdf.queryExecution().executedPlan().toString()
    assert "max_by" not in plan and [f.name for f in records.schema["f"].dataType] == ["n", "t", asof.FEATURE_DATE]


def test_silver_comes_from_bronze_without_a_shuffle(spark, tmp_path, monkeypatch):
    raw = spark.createDataFrame([("a", "2024-01-01", "N", "3_", "1", "x")], "Customer_ID string, snapshot_date string, Name string, Age string, SSN string, Occupation string")
    writers.write_csv(raw, str(tmp_path / "s"), "gzip")
    assert list((tmp_path / "s").glob("*.csv.gz"))
    medallion.ingest_bronze(spark, "attributes", str(tmp_path / "s"), str(tmp_path / "b"))
    asked = []
    by_snapshot = writers.by_snapshot
    monkeypatch.setattr(writers, "by_snapshot", lambda *a: asked.append(a) or by_snapshot(*a))
    clean = medallion.refine_silver(spark, "attributes", str(tmp_path / "b"), str(tmp_path / "c"))
    assert not asked and [row.Age for row in clean.collect()] == [None]


def test_tasks_are_as_many_as_the_rows_made_ask_for(spark, tmp_path, monkeypatch):
    spark.range(1000).withColumnRenamed("id", "k").write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    monkeypatch.setattr(views, "ROWS_PER_TASK", 50)
    assert views.spread(table, "k", grows=3).rdd.getNumPartitions() == 60


def test_the_text_of_a_month_is_not_made_in_every_row(spark, tmp_path):
    spark.range(1, 3).withColumnRenamed("id", "c_custkey").write.parquet(str(tmp_path / "customer.parquet"))
    clicks = views.clickstream_raw(spark, str(tmp_path))
    assert "add_months" not in clicks._jdf.queryExecution().optimizedPlan().toString()
    months = [f"{1995 + m // 12}-{m % 12 + 1:02}-01" for m in range(87)]
    assert sorted(row[0] for row in clicks.where("Customer_ID = 'CUS_2'").select("snapshot_date").collect()) == months
