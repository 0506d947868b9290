"""Order over a whole table without putting it into one partition.

The rows are range-partitioned by the sort key and written out with their bucket number, so
the buckets are fixed from then on. The totals of the earlier buckets (one row per bucket)
are then added to the running totals inside each bucket.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthmill.staging import stage

BUCKET = "_bucket"


def running_totals(
    df: DataFrame,
    order: Sequence[Column],
    running: Mapping[str, Column],
    totals: Mapping[str, str] | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Add running sums in the order ``order``, which must be unique per row.

    ``running`` maps a new column to what is summed; ``totals`` maps a new column to the
    running column whose grand total it carries.
    """
    # without a given number AQE merges neighbouring ranges that are small, which keeps the order
    ranges = [buckets, *order] if buckets else order
    parts = {name: f"_part_{name}" for name in running}
    ranged = (
        df.withColumns({parts[name]: value for name, value in running.items()})
        .repartitionByRange(*ranges)
        .withColumn(BUCKET, F.spark_partition_id())
    )
    fixed = stage(ranged, "ranged")

    # one row per bucket from here on: small whatever the size of the table
    sums = fixed.groupBy(BUCKET).agg(*[F.sum(part).alias(name) for name, part in parts.items()])
    earlier = Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    offsets = sums.select(
        BUCKET,
        *[F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(f"_before_{name}") for name in running],
        *[F.sum(source).over(everything).alias(name) for name, source in (totals or {}).items()],
    )

    inside = (
        Window.partitionBy(BUCKET)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ordered = fixed.join(F.broadcast(offsets), BUCKET)
    so_far = {
        name: F.col(f"_before_{name}") + F.sum(part).over(inside) for name, part in parts.items()
    }
    helpers = [BUCKET, *parts.values(), *[f"_before_{name}" for name in running]]
    return ordered.withColumns(so_far).drop(*helpers)


def global_rank(
    df: DataFrame, order: Sequence[Column], name: str, total: str | None = None
) -> DataFrame:
    """Add the 1-based position of each row and, if named, the row count."""
    totals = {total: name} if total else None
    return running_totals(df, order, {name: F.lit(1).cast("bigint")}, totals)
