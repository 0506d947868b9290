"""Layer writers. A run replaces the months of its period, whatever they held before.

The new months are written to a side folder first. A journal then names them and the months that go;
from that moment the layer is the new one: readers (``sources.journal``) look into the side folder for months
that are not in place yet, and the next run completes moves that a lost driver left open. Without a
journal a side folder is what a lost run left, and the layer is the old one.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from monthmill.sources import journal
from monthmill.sources.calendar import has_snapshot
from monthmill.sources.readers import QUOTES, SNAPSHOT
from monthmill.staging import COMPRESSION, shuffles_removed

# blanks around a value are part of it
CSV = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, **QUOTES}

Day = str | date | None


def by_snapshot(df: DataFrame, column: str = SNAPSHOT) -> DataFrame:
    """Few files per month: AQE merges small months and splits large ones at the advisory size."""
    return df.hint("rebalance", column)


def write_layer(
    df: DataFrame,
    root: str,
    file_format: str = "parquet",
    start: Day = None,
    end: Day = None,
    grouped: bool = False,
    compression: str | None = None,
) -> None:
    """Write by snapshot date; stored months from ``start`` to ``end`` that ``df`` does not have go.

    ``df`` holds rows of that period only, and may be read from the layer itself. Months outside of the
    period are not touched. ``grouped`` rows come row by row from a layer stored by snapshot: a task holds
    few months of it, so the rows are written as they come, without a shuffle.
    """
    swap_in(has_snapshot(df), root, SNAPSHOT, file_format, start, end, grouped, compression)


def replace_layer(df: DataFrame, root: str) -> None:
    """Write by snapshot date and replace the whole data set."""
    swap_in(df, root)


def replace_in_parts(parts: Iterable[DataFrame], spark: SparkSession, root: str) -> None:
    """``replace_layer`` of a table that comes in parts, one written after the other and none left out.

    Give each month whole in one part, else it gets files from several. A part is asked for when the one before it is
    written, and the layer is the old one until all are."""
    _swap_parts(parts, spark, root, SNAPSHOT)


def swap_in(
    df: DataFrame,
    root: str,
    column: str = SNAPSHOT,
    file_format: str = "parquet",
    start: Day = None,
    end: Day = None,
    grouped: bool = False,
    compression: str | None = None,
) -> None:
    """Replace the partitions of a period by those of ``df`` in one step. A layer has one writer at a time."""
    _swap_parts([df], df.sparkSession, root, column, file_format, start, end, grouped, compression)


def _swap_parts(
    parts: Iterable[DataFrame],
    spark: SparkSession,
    root: str,
    column: str,
    file_format: str = "parquet",
    start: Day = None,
    end: Day = None,
    grouped: bool = False,
    compression: str | None = None,
) -> None:
    layer = journal.Layer(spark, root, column)
    layer.complete()
    side = layer.new_side()
    options = CSV if file_format == "csv" else {"compression": COMPRESSION}
    if compression:
        options = options | {"compression": compression}
    for df in parts:
        rows = df if grouped else by_snapshot(df, column)
        with shuffles_removed(spark):
            rows.write.mode("append").partitionBy(column).format(file_format).options(**options).save(side)
    layer.publish(side, start, end)
    layer.complete()


def write_csv(df: DataFrame, path: str, compression: str | None = None) -> None:
    """CSV with header, written by the executors."""
    df.write.mode("overwrite").options(**CSV).csv(path, compression=compression)
