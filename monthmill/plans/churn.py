"""Churn label from an observation window and a label window."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthmill.functions.retail import percent

OBSERVED_UNTIL = "2011-08-31"
LABELLED_UNTIL = "2011-12-09"


def _moment(bound: str | datetime) -> Column:
    return F.lit(str(bound)).cast("timestamp_ntz")


def churn_labels(
    sales: DataFrame,
    observed_until: str | datetime = OBSERVED_UNTIL,
    labelled_until: str | datetime = LABELLED_UNTIL,
) -> DataFrame:
    """Customers seen up to ``observed_until``: 0 if they buy again up to ``labelled_until``, else 1.

    A bound given as a day is its midnight.
    """
    moment, observed, labelled = F.col("InvoiceDate"), _moment(observed_until), _moment(labelled_until)
    seen = F.max(moment <= observed)
    again = F.max((moment > observed) & (moment <= labelled))
    flags = sales.groupBy("CustomerID").agg(seen.alias("seen"), again.alias("again"))
    return flags.where("seen").select("CustomerID", F.when(F.col("again"), 0).otherwise(1).alias("Churned"))


def churn_rate(labels: DataFrame) -> DataFrame:
    """Customers, churned and retained, as counts and percentages."""
    everyone, churned = F.count(F.lit(1)), F.coalesce(F.sum("Churned"), F.lit(0))
    return labels.agg(
        everyone.alias("customers"),
        churned.alias("churned"),
        F.bround(percent(churned, everyone), 1).alias("churned_pct"),
        (everyone - churned).alias("retained"),
        F.bround(percent(everyone - churned, everyone), 1).alias("retained_pct"),
    )
