"""Bronze, silver and gold layers on storage. Each layer is one job over all its months."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthmill import fixed_values as fixed
from monthmill.operators import sketches
from monthmill.plans import silver
from monthmill.plans.feature_store import feature_blocks
from monthmill.plans.labels import default_labels
from monthmill.sinks import writers
from monthmill.sources import readers
from monthmill.staging import staging_scope

Day = str | date | None


@dataclass(frozen=True)
class Table:
    """One of the four snapshot tables on its way from file to silver."""

    name: str
    source_file: str
    read_source: Callable[[SparkSession, str], DataFrame]
    read_bronze: Callable[..., DataFrame]
    bronze_format: str
    clean: Callable[[DataFrame], DataFrame]


TABLES = {
    "loan_daily": Table(
        "loan_daily", "lms_loan_daily.csv",
        readers.read_loans, readers.read_bronze_loans, "csv", silver.clean_loans,
    ),
    "financials": Table(
        "financials", "features_financials.csv",
        readers.read_raw_csv, readers.read_layer, "parquet", silver.clean_financials,
    ),
    "attributes": Table(
        "attributes", "features_attributes.csv",
        readers.read_raw_csv, readers.read_layer, "parquet", silver.clean_attributes,
    ),
    "clickstream": Table(
        "clickstream", "feature_clickstream.csv",
        readers.read_raw_csv, readers.read_layer, "parquet", silver.clean_clickstream,
    ),
}


def _months(df: DataFrame, start: Day, end: Day) -> DataFrame:
    return readers.in_period(df, start, end)


def month_start(day: Day) -> Day:
    """The first day of the month of an ISO date."""
    return None if day is None else f"{str(day)[:7]}-01"


def ingest_bronze(
    spark: SparkSession,
    table: str,
    source: str,
    bronze: str,
    start: Day = None,
    end: Day = None,
    calendar: bool = False,
    compression: str | None = None,
) -> DataFrame:
    """Source file to bronze, unchanged, for the months from ``start`` to ``end``.

    ``calendar`` loads snapshots on the first of a month only. ``compression`` is that of the files.
    """
    kind = TABLES[table]
    start = month_start(start) if calendar else start
    rows = _months(kind.read_source(spark, source), start, end)
    if calendar:
        rows = readers.on_calendar(rows, start, end)
    writers.write_layer(rows, bronze, kind.bronze_format, start, end, compression=compression)
    return _months(kind.read_bronze(spark, bronze), start, end)


def refine_silver(
    spark: SparkSession, table: str, bronze: str, silver_root: str, start: Day = None, end: Day = None
) -> DataFrame:
    """Bronze to silver for the months from ``start`` to ``end``."""
    kind = TABLES[table]
    rows = kind.clean(_months(kind.read_bronze(spark, bronze), start, end))
    writers.write_layer(rows, silver_root, start=start, end=end, grouped=True)
    return _months(readers.read_layer(spark, silver_root, schema=rows.schema), start, end)


def store_labels(
    spark: SparkSession,
    silver_loans: str,
    labels: str,
    start: Day = None,
    end: Day = None,
    dpd: int = fixed.LABEL_DPD,
    mob: int = fixed.LABEL_MOB,
) -> DataFrame:
    """Silver loans to the label store for the months from ``start`` to ``end``."""
    rows = _months(readers.read_layer(spark, silver_loans), start, end)
    found = default_labels(rows, dpd, mob)
    writers.write_layer(found, labels, start=start, end=end, grouped=True)
    return _months(readers.read_layer(spark, labels, schema=found.schema), start, end)


def store_features(
    spark: SparkSession,
    silver_financials: str,
    silver_loans: str,
    silver_clickstream: str,
    silver_attributes: str,
    features: str,
    **options,
) -> DataFrame:
    """All silver layers to the feature store, which is replaced as a whole.

    Unless medians are exact, the sketches they come from are kept beside it (``stored_medians``)."""
    with staging_scope(spark):
        if not options.get("exact_medians"):
            options.setdefault("sketch_root", sketch_root(features))
        blocks = feature_blocks(
            readers.read_layer(spark, silver_financials),
            readers.read_layer(spark, silver_loans),
            readers.read_layer(spark, silver_clickstream),
            readers.read_layer(spark, silver_attributes),
            **options,
        )
        writers.replace_in_parts(blocks, spark, features)
    return readers.read_layer(spark, features)


def sketch_root(features: str) -> str:
    return f"{features}_sketches"


def stored_medians(spark: SparkSession, features: str, start: Day = None, end: Day = None) -> DataFrame:
    """The medians before imputation of any period of a stored feature table, from its sketches alone."""
    return sketches.merged_medians(readers.read_layer(spark, sketch_root(features)), start, end)


def run_pipeline(
    spark: SparkSession,
    data: str,
    datamart: str,
    start: Day = "2023-01-01",
    end: Day = "2024-12-01",
    dpd: int = fixed.LABEL_DPD,
    mob: int = fixed.LABEL_MOB,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """From the four source files to the label store and the feature store.

    Loan snapshots are those on the first of a month, from the month of ``start`` up to ``end``;
    the feature tables are taken with all the dates they have. Repeating a run replaces the
    same months. Beside the layers, ``audit`` holds the rows of every layer and snapshot.
    """
    start = month_start(start)
    for name, kind in TABLES.items():
        loans = name == "loan_daily"
        period = (start, end) if loans else (None, None)
        bronze, clean = f"{datamart}/bronze/{name}", f"{datamart}/silver/{name}"
        # text takes several times the room; other formats are compressed anyway
        packed = "gzip" if kind.bronze_format == "csv" else None
        ingest_bronze(spark, name, f"{data}/{kind.source_file}", bronze, *period, calendar=loans, compression=packed)
        refine_silver(spark, name, bronze, clean, *period)
    layers = {name: f"{datamart}/silver/{name}" for name in TABLES}
    labels = store_labels(
        spark, layers["loan_daily"], f"{datamart}/gold/label_store", start, end, dpd, mob
    )
    features = store_features(
        spark,
        layers["financials"],
        layers["loan_daily"],
        layers["clickstream"],
        layers["attributes"],
        f"{datamart}/gold/feature_store",
        **options,
    )
    audit(spark, datamart, labels, features).write.mode("overwrite").parquet(f"{datamart}/audit")
    return labels, features


def audit(spark: SparkSession, datamart: str, labels: DataFrame, features: DataFrame) -> DataFrame:
    """Rows per layer, table and snapshot, and for the features how many rows found a record."""
    parts = {("gold", "label_store"): labels, ("gold", "feature_store"): features}
    for name, kind in TABLES.items():
        parts["bronze", name] = kind.read_bronze(spark, f"{datamart}/bronze/{name}")
        parts["silver", name] = readers.read_layer(spark, f"{datamart}/silver/{name}")
    counts = None
    for (layer, name), table in parts.items():
        rows = table.groupBy(F.col(readers.SNAPSHOT).cast("date").alias(readers.SNAPSHOT)).agg(
            F.count(F.lit(1)).alias("row_count"),
            *[
                (F.count(lag) if lag in table.columns else F.lit(None).cast("bigint")).alias(f"{lag[:-9]}_matched")
                for lag in ("financials_lag_days", "attributes_lag_days")
            ],
        )
        rows = rows.select(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "*")
        counts = rows if counts is None else counts.unionByName(rows)
    return counts
