"""File scans. Schemas are given, so no scan needs an inference pass."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from monthmill.functions.cleaning import cast_text
from monthmill.sources import journal, schemas

SNAPSHOT = "snapshot_date"
Day = str | date | None
#: A quote inside a quoted value is written twice.
QUOTES = {"quote": '"', "escape": '"'}


def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with header, every column as text exactly as it stands in the file."""
    return spark.read.csv(path, header=True, inferSchema=False, **QUOTES)


def read_typed_csv(spark: SparkSession, path: str | list[str], types: dict[str, str], **options) -> DataFrame:
    """CSV with header: the listed columns cast by name, further columns left as text.

    Fields that do not parse become null. The types are given, so there is no inference pass.
    """
    raw = spark.read.csv(path, header=True, inferSchema=False, **{**QUOTES, **options})
    return raw.withColumns({name: cast_text(F.col(name), to) for name, to in types.items()})


def read_loans(spark: SparkSession, path: str) -> DataFrame:
    return read_typed_csv(spark, path, schemas.RAW_LOAN_TYPES)


def read_layer(
    spark: SparkSession, root: str, day: str | date | None = None, schema: StructType | None = None
) -> DataFrame:
    """A layer stored by snapshot date; with ``day`` only that partition is listed and read.

    With a schema, a layer of which no month is left is an empty table. Months that a lost run left
    half replaced are read as they are to be.
    """

    def read(folders: list[str], options: dict[str, str]) -> DataFrame:
        reader = spark.read.schema(schema) if schema else spark.read
        return reader.options(**options).parquet(*folders)

    layer = journal.current(spark, root, SNAPSHOT, read)
    return layer if day is None else on_day(layer, day)


def read_bronze_loans(spark: SparkSession, root: str, day: str | date | None = None) -> DataFrame:
    """The loan layer, which is kept as CSV."""

    def read(folders: list[str], options: dict[str, str]) -> DataFrame:
        return read_typed_csv(spark, folders, schemas.RAW_LOAN_TYPES, **options)

    layer = journal.current(spark, root, SNAPSHOT, read)
    return layer if day is None else on_day(layer, day)


def on_day(df: DataFrame, day: str | date) -> DataFrame:
    """Rows of one snapshot; on raw text the comparison is on the text itself."""
    text = day if isinstance(day, str) else day.isoformat()
    literal = F.lit(text) if dict(df.dtypes)[SNAPSHOT] == "string" else F.lit(text).cast("date")
    return df.where(F.col(SNAPSHOT) == literal)


def on_calendar(df: DataFrame, start: str | date | None, end: str | date | None) -> DataFrame:
    """Snapshots on the first of a month, from the month of ``start`` up to ``end``."""
    day = F.col(SNAPSHOT).cast("date")
    df = df.where(F.dayofmonth(day) == 1)
    if start is not None:
        df = df.where(day >= F.trunc(F.lit(str(start)).cast("date"), "month"))
    if end is not None:
        df = df.where(day <= F.lit(str(end)).cast("date"))
    return df


def in_period(df: DataFrame, start: str | date | None, end: str | date | None) -> DataFrame:
    """Rows with a snapshot date between ``start`` and ``end``, both included."""
    if start is not None:
        df = df.where(F.col(SNAPSHOT) >= F.lit(str(start)))
    if end is not None:
        df = df.where(F.col(SNAPSHOT) <= F.lit(str(end)))
    return df


def read_transactions(
    spark: SparkSession,
    path: str,
    timestamp_format: str | None = "M/d/yyyy H:mm",
    multi_line: bool = False,
) -> DataFrame:
    """Retail transactions: Latin-1 CSV, time as ``timestamp_ntz``, customer as a whole number.

    Without ``timestamp_format`` times are read as ISO text. ``multi_line`` allows line breaks
    inside quoted values; each file is then read by one task.
    """
    raw = read_typed_csv(
        spark, path, schemas.TRANSACTION_TYPES, encoding="ISO-8859-1", multiLine=multi_line
    )
    moment = F.col("InvoiceDate")
    if timestamp_format:
        # wall clock time, whatever the session zone; the first test keeps bad text from raising
        pattern = F.lit(timestamp_format)
        readable = F.try_to_timestamp(moment, pattern).isNotNull()
        parsed = F.when(readable, F.to_timestamp_ntz(moment, pattern))
    else:
        parsed = moment.try_cast("timestamp_ntz")
    return raw.withColumn("InvoiceDate", parsed)


def read_index_returns(spark: SparkSession, path: str) -> DataFrame:
    """Daily market index returns, with column names that need no quoting."""
    raw = read_typed_csv(spark, path, schemas.INDEX_TYPES)
    return raw.withColumnsRenamed(schemas.INDEX_NAMES)
