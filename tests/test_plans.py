"""The physical plans are the wanted ones."""

import re

import pytest
from pyspark.sql import functions as F

from monthmill.catalog import views
from monthmill.catalog.queries import QUERIES
from monthmill.operators import asof
from monthmill.plans import labels

SF = "/root/testdata/sf0.001"
LIGHT = [n for n in QUERIES if not n.startswith(("feature_store", "pipeline", "histogram"))]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LIGHT)
def test_no_python_and_no_all_pairs(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    for bad in ("Python", "Pandas", "CartesianProduct", "NestedLoop"):
        assert bad not in plan


def loans(spark, folder):
    """Loans as the jobs read them, from files."""
    views.loan_daily(spark, SF).write.partitionBy("snapshot_date").parquet(folder)
    return spark.read.parquet(folder)


def test_left_rows_of_the_asof_join_move_once(spark, tmp_path):
    left = loans(spark, str(tmp_path / "loans"))
    clicks = views.clickstream_raw(spark, SF).withColumn("snapshot_date", F.col("snapshot_date").cast("date"))
    fin = views.financials_raw(spark, SF).withColumn("snapshot_date", F.col("snapshot_date").cast("date"))
    plan = plan_of(asof.with_records(left, [asof.Feature("f", fin)], exact=[clicks]))
    by_pair = re.findall(r"Exchange hashpartitioning\(Customer_ID#\d+, snapshot_date#\d+, \d+\)", plan)
    # loans, clicks and resolved features once each, and the records of the features where they are chosen;
    # as no pair is frequent there are no pieces, no list of hot pairs and no second count
    assert len(by_pair) == 4 and "_piece" not in plan and "Broadcast" not in plan
    assert plan.count("SortMergeJoin") == 2


def test_frequent_pairs_are_joined_in_pieces(spark, tmp_path):
    left = loans(spark, str(tmp_path / "loans"))
    left = left.withColumn("Customer_ID", F.when(F.rand(3) < 0.5, F.lit("CUS_1")).otherwise(F.col("Customer_ID")))
    left = left.withColumn("snapshot_date", F.when(F.col("Customer_ID") == "CUS_1", F.lit("1997-01-01").cast("date")).otherwise(F.col("snapshot_date")))
    fin = views.financials_raw(spark, SF).withColumn("snapshot_date", F.col("snapshot_date").cast("date"))
    plan = plan_of(asof.with_records(left, [asof.Feature("f", fin)]))
    by_pair = re.findall(r"Exchange hashpartitioning\(Customer_ID#\d+, snapshot_date#\d+, _piece#\d+", plan)
    assert len(by_pair) == 2


def test_collapsing_limits_groups_before_the_shuffle(spark, tmp_path):
    left = loans(spark, str(tmp_path / "loans"))
    plan = plan_of(asof.one_row_per_pair(left, "loan_id"))
    # a task keeps one row of a pair below the exchange, so a frequent pair sends few rows; an
    # aggregate with whole rows in its buffer would sort them twice
    final, exchange, partial = plan.index(", Final"), plan.index("Exchange"), plan.index(", Partial")
    assert final < exchange < partial and plan.count("Exchange") == 1
    assert "SortAggregate" not in plan


def test_label_scan_reads_only_the_needed_columns(spark):
    folder = f"{spark.conf.get('spark.checkpoint.dir')}/label-scan"
    table = views.loan_daily(spark, SF).withColumn("mob", F.col("installment_num")).withColumn("dpd", F.lit(0))
    table.write.mode("overwrite").parquet(folder)
    plan = plan_of(labels.default_labels(spark.read.parquet(folder)))
    assert "PushedFilters: [IsNotNull(mob), EqualTo(mob,6)]" in plan
    assert "balance" not in plan and "loan_amt" not in plan


def test_rows_are_ordered_without_a_single_partition(spark):
    plan = plan_of(QUERIES["pareto_customers"](spark, SF))
    # the only single partition holds one row per bucket
    for part in plan.split("Exchange SinglePartition")[1:]:
        assert "HashAggregate(keys=[_bucket" in part.split("\n")[1]
