"""Entry points by snapshot date, for schedulers that run one date at a time.

Each call replaces the given date only. To load many dates use ``monthmill.plans.medallion``,
which handles all of them in one job.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from monthmill.operators import asof
from monthmill.plans import medallion
from monthmill.sources.calendar import month_calendar, snapshot_dates
from monthmill.sources.readers import SNAPSHOT, read_raw_csv

DATA = "data"


def _day(value: str | date) -> str:
    """ISO text of a date; text is checked by parsing."""
    if isinstance(value, str):
        return datetime.strptime(value, "%Y-%m-%d").date().isoformat()
    return value.strftime("%Y-%m-%d")


def _bronze(table: str, day: str | date, bronze: str, spark: SparkSession, source: str | None) -> DataFrame:
    path = source or f"{DATA}/{medallion.TABLES[table].source_file}"
    return medallion.ingest_bronze(spark, table, path, bronze, _day(day), _day(day))


def _silver(table: str, day: str | date, bronze: str, silver: str, spark: SparkSession) -> DataFrame:
    return medallion.refine_silver(spark, table, bronze, silver, _day(day), _day(day))


def process_bronze_table(snapshot_date, bronze_dir, spark, source=None) -> DataFrame:
    return _bronze("loan_daily", snapshot_date, bronze_dir, spark, source)


def process_bronze_financials(snapshot_date, bronze_dir, spark, source=None) -> DataFrame:
    return _bronze("financials", snapshot_date, bronze_dir, spark, source)


def process_bronze_attributes(snapshot_date, bronze_dir, spark, source=None) -> DataFrame:
    return _bronze("attributes", snapshot_date, bronze_dir, spark, source)


def process_bronze_clickstream(snapshot_date, bronze_dir, spark, source=None) -> DataFrame:
    return _bronze("clickstream", snapshot_date, bronze_dir, spark, source)


def process_silver_table(snapshot_date, bronze_dir, silver_dir, spark) -> DataFrame:
    return _silver("loan_daily", snapshot_date, bronze_dir, silver_dir, spark)


def process_silver_financials(snapshot_date, bronze_dir, silver_dir, spark) -> DataFrame:
    return _silver("financials", snapshot_date, bronze_dir, silver_dir, spark)


def process_silver_attributes(snapshot_date, bronze_dir, silver_dir, spark) -> DataFrame:
    return _silver("attributes", snapshot_date, bronze_dir, silver_dir, spark)


def process_silver_clickstream(snapshot_date, bronze_dir, silver_dir, spark) -> DataFrame:
    return _silver("clickstream", snapshot_date, bronze_dir, silver_dir, spark)


def process_labels_gold_table(snapshot_date, silver_dir, gold_dir, spark, dpd, mob) -> DataFrame:
    day = _day(snapshot_date)
    return medallion.store_labels(spark, silver_dir, gold_dir, day, day, dpd, mob)


def process_gold_features(
    spark, financials_dir, loans_dir, clickstream_dir, attributes_dir, gold_dir, **options
) -> DataFrame:
    """``mode="exact"`` gives the variant that joins on equal dates only."""
    return medallion.store_features(
        spark, financials_dir, loans_dir, clickstream_dir, attributes_dir,
        f"{gold_dir.rstrip('/')}/feature_store", **options,
    )


def as_of_join(
    loans: DataFrame, feature: DataFrame, name: str, collapse_on: str | None = None
) -> DataFrame:
    """``collapse_on="loan_id"`` keeps one loan per customer and date."""
    return asof.asof_join(loans, asof.Feature(name, feature), collapse_on=collapse_on)


def generate_first_of_month_dates(spark: SparkSession, start: str, end: str) -> list[str]:
    return [row[SNAPSHOT].isoformat() for row in month_calendar(spark, start, end).collect()]


def source_dates(spark: SparkSession, path: str) -> list[str]:
    """The distinct snapshot dates of a source file, in order (one short text per date)."""
    return [row[SNAPSHOT] for row in snapshot_dates(read_raw_csv(spark, path)).collect()]
