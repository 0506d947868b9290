"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import time
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monthmill.workspace import importable as importable  # the operators take it from here

#: What separates words: the blank and the ASCII control characters tab to carriage return.
SPACES = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
#: Seconds that listeners get for the events of a finished pass.
LISTENERS = 0.7


def tables(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def word_array(text: Column) -> Column:
    """The words of a text in order; an empty array for null or blank texts."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, SPACE_RUN)).otherwise(
        F.array().cast("array<string>")
    )


def word_count(text: Column) -> Column:
    """How many words a text has, without making them: each run of word characters becomes one."""
    marked = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\x20\x09-\x0D]+", "w")
    return (F.length(marked) - F.length(F.translate(marked, "w", ""))).cast("bigint")


def ascii_lower(text: Column) -> Column:
    """Lower-case A to Z and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def with_plain_names(
    docs: DataFrame, used: Sequence[str], work: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """``work`` on ``docs``, whose columns other than ``used`` bear names meanwhile that need no quoting and
    are no helper's. The result has the old names again."""
    plain = {name: f"carried_{k}" for k, name in enumerate(docs.columns) if name not in used}
    old = {new: name for name, new in plain.items()}
    found = work(docs.select(*[F.col(f"`{name}`").alias(plain.get(name, name)) for name in docs.columns]))
    return found.select(*[F.col(f"`{name}`").alias(old.get(name, name)) for name in found.columns])


def shuffle_tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of finished passes: it does so when the driver's JVM
    finds, at a collection, that nothing refers to them any more. Listeners that still work off the events of
    the last pass refer to it, so a second collection follows the first."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    time.sleep(LISTENERS)
    spark.sparkContext._jvm.System.gc()


def spread_lookup(
    rows: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    count: str,
    total: int,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Left join of ``rows`` with ``table``, which has one row per key and its number of rows.
    Where the rows of ``table`` are large, ``counts`` has the numbers instead.

    A key with more than a fair share of the rows (their number over the shuffle partitions) is
    split: its table row is repeated and its rows take turns. Fewer keys than shuffle partitions
    can be that frequent, which bounds the list that is broadcast. ``rows`` must be a scan, so
    that a repeated task deals its rows in the same way. Keys must not be null.
    """
    keys = list(keys)
    fair = max(1, total // max(1, shuffle_tasks(rows)))
    pieces = F.ceil(F.col(count) / F.lit(fair)).cast("int")
    known = table if counts is None else counts
    hot = known.filter(F.col(count) > fair).select(*keys, pieces.alias("_pieces"))
    dealt = (
        rows.withColumn("_turn", F.monotonically_increasing_id())
        .join(F.broadcast(hot), keys, "left")
        .withColumn("_piece", F.pmod("_turn", F.coalesce("_pieces", F.lit(1))).cast("int"))
        .drop("_turn", "_pieces")
    )
    if counts is None:
        last = F.when(F.col(count) > fair, pieces - 1).otherwise(F.lit(0))
    else:
        table, last = table.join(F.broadcast(hot), keys, "left"), F.coalesce("_pieces", F.lit(1)) - 1
    repeated = table.withColumn("_piece", F.explode(F.sequence(F.lit(0), last))).drop("_pieces")
    return dealt.join(repeated, [*keys, "_piece"], "left").drop("_piece")
