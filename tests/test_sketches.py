"""Sketches and states that are kept per month, and quantiles of large groups."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from monthmill.catalog import queries
from monthmill.operators import profile, sketches
from monthmill.plans import feature_store, medallion, monthly
from monthmill.sinks import writers
from monthmill.sources import readers

SF = "/root/testdata/sf0.001"
MONTHS = ["2024-01-01", "2024-02-01", "2024-03-01"]


@pytest.fixture(scope="module")
def layer(spark):
    """A month with most of the rows, gaps, NaN, a column without values."""
    month = F.when(F.col("id") % 10 < 8, F.lit(MONTHS[0])).when(F.col("id") % 10 == 8, F.lit(MONTHS[1]))
    v = F.abs(F.xxhash64("id") % 100_003).cast("double")
    return spark.range(60_000).select(
        F.coalesce(month, F.lit(MONTHS[2])).cast("date").alias("snapshot_date"),
        F.when(F.col("id") % 7 != 0, v).alias("v"),
        F.when(F.col("id") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("id") % 3).alias("few"),
        F.lit(None).cast("int").alias("never"),
    )


@pytest.mark.parametrize("period", [(None, None), (MONTHS[1], None), (MONTHS[1], MONTHS[1]), ("2025-01-01", None)])
def test_medians_of_any_period(spark, layer, tmp_path, period):
    names = ["v", "few", "never"]
    stored = sketches.store_sketches(layer, names, str(tmp_path / "s"))
    part = readers.in_period(layer, *period)
    found = sketches.medians_by_column(stored, *period)
    assert set(found) == ({"v", "few"} if period[0] != "2025-01-01" else set())
    for row in sketches.rank_errors(part, found, names).collect():
        values = part.where(f"{row.column_name} is not null and not isnan({row.column_name})").count()
        assert row.n_values == values
        assert row.rank_error is None if row.column_name not in found else row.rank_error <= 0.001


def test_only_the_months_of_the_period_are_read(spark, layer, tmp_path):
    sketches.store_sketches(layer, ["v"], str(tmp_path / "s"))
    stored = readers.read_layer(spark, str(tmp_path / "s"))
    plan = sketches.merged_medians(stored, MONTHS[1], MONTHS[1])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[isnotnull\(snapshot_date", plan)


def test_no_task_takes_the_sketches_of_all_tasks(spark, layer):
    plan = sketches.monthly_sketches(layer, ["v", "few"])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and len(re.findall(r"Exchange hashpartitioning\(snapshot_date", plan)) == 2


def test_rank_errors_see_a_wrong_median(spark, layer):
    found = {r.column_name: r.rank_error for r in sketches.rank_errors(layer, {"v": 0.0, "few": 2.0}, ["v", "few"]).collect()}
    assert found["v"] == pytest.approx(0.5, abs=0.01) and found["few"] > 0.1


def test_both_passes_hand_python_one_array_a_row(spark, layer):
    names = ["v", "few", "never"]
    for found in (sketches.monthly_sketches(layer, names), sketches.rank_errors(layer, {"v": 1.0}, names)):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(r"MapInArrow \w+\((?:snapshot_date#\d+, )?values#\d+\)", plan)) == 1


def test_rank_errors_of_gaps_infinities_and_no_rows(spark):
    inf = float("inf")
    rows = spark.createDataFrame([(1.0, None), (2.0, 5), (float("nan"), 5), (inf, 7), (-inf, 9), (None, None)], "a double, b int")
    found = {r.column_name: (r.n_values, r.rank_error) for r in sketches.rank_errors(rows, {"a": 2.0, "b": 9.0}, ["a", "b"]).collect()}
    # of -inf, 1, 2, inf the value 2 has rank 3; of 5, 5, 7, 9 the value 9 has rank 4
    assert found == {"a": (4, 0.25), "b": (4, 0.5)}
    empty = sketches.rank_errors(rows.where("a > 5 and a < 4"), {"a": 2.0}, ["a", "b"]).collect()
    assert sorted(map(tuple, empty)) == [("a", 0, None), ("b", 0, None)]


def test_grouped_quantiles_of_a_hot_continuous_group(spark):
    dice = random.Random(1)
    rows = [(None if k % 50 == 0 else "hot" if k % 3 == 0 else f"g{k % 9}", dice.choice([dice.random() * 1e6, float(k % 4), None]))
            for k in range(6000)] + [("none", None), ("one", 5.0), ("nan", float("nan"))]
    found = profile.grouped_summary(spark.createDataFrame(rows, "g string, v double"), "g", "v", 6).collect()
    assert {r.g for r in found} == {g for g, _ in rows if g}
    for r in found:
        data = [v for g, v in rows if g == r.g and v is not None and v == v]
        assert r["count"] == sum(1 for g, v in rows if g == r.g and v is not None)
        if data:
            assert [r.q25, r.q50, r.q75] == pytest.approx(np.quantile(data, [0.25, 0.5, 0.75]).tolist(), rel=1e-9)
        else:
            assert (r.q25, r.q50, r.q75) == (None, None, None)
    assert profile.grouped_summary(spark.createDataFrame([], "g string, v double"), "g", "v").count() == 0


def test_grouped_quantiles_hold_no_group_in_one_buffer(spark):
    rows = spark.range(1000).selectExpr("cast(id % 3 as string) as g", "cast(id as double) as v", "1L as w")
    plan = profile.grouped_quantiles(rows, "g", "v", "w", [0.5])._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan and "collect_list" not in plan and "SinglePartition" not in plan.split("Subquery")[0]


# --- states ----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def mart(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("mart"))
    for name, rows in {
        "loan_daily": queries._loans(spark, SF), "clickstream": queries._clicks(spark, SF),
        "financials": queries._financials(spark, SF), "attributes": queries._attributes(spark, SF),
    }.items():
        writers.write_layer(rows, f"{root}/silver/{name}")
    return root


def test_states_are_the_last_records(spark, mart, tmp_path):
    rows = queries._financials(spark, SF)
    for since in (None, "1996-06-01", "1999-12-01"):
        earlier = None if since is None else monthly.advance(rows, since)
        found = monthly.advance(rows, "1999-12-01", earlier, since)
        whole = monthly.advance(rows, "1999-12-01")
        assert found.columns == rows.columns
        assert found.exceptAll(whole).isEmpty() and whole.exceptAll(found).isEmpty()
        assert found.count() == rows.where("snapshot_date <= '1999-12-01' and Customer_ID is not null").select("Customer_ID").distinct().count()


def test_a_month_from_states_equals_the_whole_join(spark, mart, tmp_path):
    options = {"credit_mixes": queries.CREDIT_MIXES, "loan_types": queries.LOAN_TYPES}
    day, states = "1998-06-01", {n: str(tmp_path / n) for n in ("financials", "attributes")}
    for step in ("1995-01-01", "1997-03-01", day, day):  # the last one twice: a rerun
        for name, root in states.items():
            monthly.store_state(spark, f"{mart}/silver/{name}", root, step)
    found = monthly.month_features(
        spark, day, f"{mart}/silver/loan_daily", f"{mart}/silver/clickstream", *states.values(), **options)
    layers = [readers.read_layer(spark, f"{mart}/silver/{n}") for n in ("financials", "loan_daily", "clickstream", "attributes")]
    whole = readers.on_day(feature_store.build_features(*layers, **options), day)
    assert whole.count() > 50 and found.columns == whole.columns
    assert found.exceptAll(whole).isEmpty() and whole.exceptAll(found).isEmpty()
    plan = found._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"FileScan parquet.*", plan)
    # the counts of the month's own pairs are staged on the way; everything else is a layer or a state
    scans = [scan for scan in scans if "/monthmill/" not in scan]
    assert len(scans) == 4
    assert scans and all(re.search(r"PartitionFilters: \[.*(snapshot_date|as_of).* = ", scan) for scan in scans)


def test_refreshing_a_month_leaves_the_others(spark, tmp_path):
    options = {"credit_mixes": queries.CREDIT_MIXES, "loan_types": queries.LOAN_TYPES}
    root, source = str(tmp_path / "mart"), queries._sources(spark, SF)
    _, features = medallion.run_pipeline(spark, source, root, None, None, **options)
    before = features.toArrow().sort_by([("snapshot_date", "ascending"), ("loan_id", "ascending")])
    found = monthly.refresh_month(spark, "1998-06-01", root, **options)
    assert found.count() > 50
    again = readers.read_layer(spark, f"{root}/gold/feature_store").toArrow()
    again = again.sort_by([("snapshot_date", "ascending"), ("loan_id", "ascending")]).select(before.column_names)
    assert again.equals(before)
    medians = {r.column_name: r.median for r in medallion.stored_medians(spark, f"{root}/gold/feature_store").collect()}
    assert medians["tenure"] == 6.0 and set(medians) >= {"loan_amt", "Age"}

