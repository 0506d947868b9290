"""Exact distinct counts that merge: bitmaps of numbered values, kept per month.

Every distinct value of a column gets a number, once and for all. The values of a month are then a set of
numbers, stored as bitmaps of 32 768 bits each, and the distinct values of any run of months are the bits
of the bitmaps laid over each other. No row and no value is read again for a quarter or a year.

Rows are reduced to distinct (month, column, value) triples before anything is shuffled, so a value that a
third of all rows hold is one triple per task and month. A bitmap has at most 32 768 numbers behind
it, whatever the size of the data. All columns are read in one scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monthmill.operators.ordering import global_rank
from monthmill.sinks.writers import swap_in
from monthmill.sources import journal
from monthmill.staging import stage

PERIOD, COLUMN, VALUE, ID = "period", "column_name", "value", "value_id"
BATCH = "batch"


def as_text(df: DataFrame, name: str) -> Column:
    """A column's values as text, equal where the values are."""
    column = F.col(f"`{name}`")
    if dict(df.dtypes)[name] in ("float", "double"):
        column = column + 0.0  # a negative zero is a zero
    return column.cast("string")


def long_values(df: DataFrame, columns: Sequence[str], *kept: Column) -> DataFrame:
    """One row per row and column: the name of the column and the value as text."""
    pairs = [F.struct(F.lit(c).alias(COLUMN), as_text(df, c).alias(VALUE)) for c in columns]
    return df.select(*kept, F.inline(F.array(*pairs)))


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column_name`` and ``distinct_count`` of the values that are not null, in one scan."""
    if not columns:
        return df.sparkSession.createDataFrame([], f"{COLUMN} string, distinct_count bigint")
    names = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in columns])).alias(COLUMN))
    # values meet on the map side; a last row per name keeps columns without values
    values = long_values(df, columns).where(F.col(VALUE).isNotNull()).groupBy(COLUMN, VALUE).agg(F.lit(1).alias("one"))
    # two levels: a column of very many values is counted in as many places as there are partitions
    part = F.spark_partition_id().alias("_part")
    counted = values.groupBy(COLUMN, part).agg(F.count(F.lit(1)).alias("n")).select(COLUMN, "n")
    rows = counted.unionByName(names.withColumn("n", F.lit(0).cast("bigint")))
    return rows.groupBy(COLUMN).agg(F.sum("n").alias("distinct_count"))


class BitmapStore:
    """Numbered values and monthly bitmaps of some columns, below one folder.

    ``ids`` has the number of every value seen so far; numbers are never given anew. ``bitmaps`` has one
    partition per month. A store has one writer at a time. If a run is lost between the two, its values
    have numbers that no bitmap shows yet, and the next run uses them.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.ids_root, self.bitmaps_root = f"{root}/ids", f"{root}/bitmaps"

    def _layer(self, root: str, column: str, schema: str) -> DataFrame:
        if not journal.Layer(self.spark, root, column).has_months():
            return self.spark.createDataFrame([], schema)

        def read(folders: list[str], options: dict[str, str]) -> DataFrame:
            return self.spark.read.schema(schema).options(**options).parquet(*folders)

        return journal.current(self.spark, root, column, read)

    def ids(self) -> DataFrame:
        """Column, value and number of every value seen so far."""
        schema = f"{COLUMN} string, {VALUE} string, {ID} bigint, {BATCH} bigint"
        return self._layer(self.ids_root, BATCH, schema)

    def bitmaps(self) -> DataFrame:
        """Month, column, bucket of numbers and bitmap."""
        schema = f"{COLUMN} string, bucket bigint, bitmap binary, {PERIOD} date"
        return self._layer(self.bitmaps_root, PERIOD, schema)

    def store(self, rows: DataFrame, day: Column, columns: Sequence[str], start=None, end=None) -> None:
        """Replace the months from ``start`` to ``end`` (their first days) by those of ``rows``.

        ``rows`` are the rows of that period. Rows without a day and null values are left out.
        """
        month = F.trunc(day.cast("date"), "month").alias(PERIOD)
        found = long_values(rows, columns, month).where(F.col(PERIOD).isNotNull() & F.col(VALUE).isNotNull())
        triples = stage(found.distinct(), "triples")
        self._number(triples.select(COLUMN, VALUE).distinct())
        numbered = triples.join(self.ids().drop(BATCH), [COLUMN, VALUE])
        bitmaps = numbered.groupBy(PERIOD, COLUMN, F.bitmap_bucket_number(ID).alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(F.col(ID))).alias("bitmap")
        )
        swap_in(bitmaps, self.bitmaps_root, PERIOD, start=start, end=end)

    def _number(self, values: DataFrame) -> None:
        """Number the values that have no number yet, after the last one given."""
        known = self.ids()
        last, batch = known.agg(F.coalesce(F.max(ID), F.lit(0)), F.coalesce(F.max(BATCH), F.lit(0))).first()
        new = stage(values.join(known.select(COLUMN, VALUE), [COLUMN, VALUE], "left_anti"), "new-values")
        if new.isEmpty():
            return
        ranked = global_rank(new, [F.col(COLUMN), F.col(VALUE)], "_rank")
        numbered = ranked.select(COLUMN, VALUE, (F.col("_rank") + last).alias(ID), F.lit(batch + 1).alias(BATCH))
        # a batch of its own folder: earlier numbers are not touched
        swap_in(numbered, self.ids_root, BATCH, start=str(batch + 1), end=str(batch + 1))

    def counts(self, period: Column | None = None, level: str = "whole") -> DataFrame:
        """``level``, ``period``, ``column_name`` and ``distinct_count`` for each value of ``period``, an
        expression over the month; without one for all months together (``period`` is null)."""
        of = (F.lit(None).cast("date") if period is None else period).alias("_of")
        merged = self.bitmaps().groupBy(of, COLUMN, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
        counted = merged.groupBy("_of", COLUMN).agg(F.sum(F.bitmap_count("bitmap")).alias("distinct_count"))
        return counted.select(F.lit(level).alias("level"), F.col("_of").alias(PERIOD), COLUMN, "distinct_count")
