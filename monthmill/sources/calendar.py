"""Snapshot dates: those found in a table and those a calendar asks for."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthmill.sources.readers import SNAPSHOT


def has_snapshot(df: DataFrame) -> DataFrame:
    """Rows with a snapshot date that is neither null nor blank text."""
    column = F.col(SNAPSHOT)
    filled = column.isNotNull()
    if dict(df.dtypes)[SNAPSHOT] == "string":
        filled = filled & (column != "")
    return df.where(filled)


def snapshot_dates(df: DataFrame) -> DataFrame:
    """The distinct snapshot dates, in order."""
    return has_snapshot(df).select(SNAPSHOT).distinct().orderBy(SNAPSHOT)


def month_calendar(spark: SparkSession, start: str | date, end: str | date) -> DataFrame:
    """First day of each month from the month of ``start`` up to ``end``, both included."""
    first = F.trunc(F.lit(str(start)).cast("date"), "month")
    last = F.lit(str(end)).cast("date")
    # a start after the end has no months
    months = F.when(first <= last, F.sequence(first, last, F.expr("interval 1 month")))
    return spark.range(1).select(F.explode(months).alias(SNAPSHOT))


def month_range(df: DataFrame) -> DataFrame:
    """First day of each month between the first and the last snapshot of a table."""
    ends = df.agg(
        F.trunc(F.min(SNAPSHOT), "month").alias("first"), F.max(SNAPSHOT).alias("last")
    )
    months = F.sequence("first", "last", F.expr("interval 1 month"))
    return ends.select(F.explode(months).alias(SNAPSHOT))


def rows_per_snapshot(df: DataFrame) -> DataFrame:
    """Row count of each snapshot, for every layer in the same way."""
    return df.groupBy(SNAPSHOT).agg(F.count(F.lit(1)).alias("row_count"))
