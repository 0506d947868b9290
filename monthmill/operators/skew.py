"""Equi-joins whose left side may hold very many rows of one key.

Keys above a share of all rows are split into pieces: the left rows take turns, the right
rows are repeated once per piece. The share is what one of the shuffle partitions would hold,
so fewer keys than partitions can be that frequent, which bounds the list that is broadcast
whatever the size of the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthmill.staging import settled, stage

ROWS = "_rows"
PIECES = "_pieces"
PIECE = "_piece"


def count_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key, counted on the map side first; rows without a key are left out."""
    return keyed(df, keys).groupBy(*keys).agg(F.count(F.lit(1)).alias(ROWS))


def keyed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with a complete key. Written as the filter that joins imply anyway, so that plans
    with and without the join stay equal and share their shuffles."""
    for key in keys:
        df = df.where(F.col(key).isNotNull())
    return df


class Split:
    """How often each key of a left table is split, from its row counts per key.

    The counts are staged, so every later use reads them instead of counting again. Where no key
    and no lack of a key is that frequent, rows are joined as they are, without pieces.

    Pieces go by row position, which also deals out exact copies of a row. The left table is
    therefore settled first: a repeated task must find its rows in the same order.
    """

    def __init__(self, left: DataFrame, keys: Sequence[str], share: float | None = None) -> None:
        self.left = settled(left)
        self.keys = list(keys)
        self.share = share or 1 / int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        every = stage(self.left.groupBy(*self.keys).agg(F.count(F.lit(1)).alias(ROWS)), "key-counts")
        self.counts = keyed(every, self.keys)
        keyless = F.lit(False)
        for key in self.keys:
            keyless = keyless | F.col(key).isNull()
        self.keyless = keyless
        rows = F.when(~keyless, F.col(ROWS))
        seen = every.agg(
            F.sum(rows).alias("keyed"), F.max(rows).alias("largest"), F.sum(F.when(keyless, F.col(ROWS))).alias("keyless")
        ).first()
        self.fair = max(1.0, (seen.keyed or 0) * self.share)
        #: Whether rows have to be dealt out at all.
        self.uneven = max(seen.largest or 0, seen.keyless or 0) > self.fair
        self.hot = self.counts.where(F.col(ROWS) > self.fair).select(
            *self.keys, self.pieces(F.col(ROWS)).alias(PIECES)
        )

    def pieces(self, rows: Column) -> Column:
        """Pieces of a key with that many rows."""
        return F.when(rows > self.fair, F.ceil(rows / self.fair).cast("int")).otherwise(F.lit(1))

    def spread(self) -> DataFrame:
        """Deal the left rows of a hot key out over its pieces, rows without a key over many."""
        if not self.uneven:
            return self.left
        known = F.coalesce(F.col(PIECES), F.lit(1))
        pieces = F.when(self.keyless, F.lit(int(1 / self.share))).otherwise(known)
        return (
            self.left.join(F.broadcast(self.hot), self.keys, "left")
            .withColumn(PIECE, F.pmod(F.monotonically_increasing_id(), pieces).cast("int"))
            .drop(PIECES)
        )

    def repeat(self, right: DataFrame) -> DataFrame:
        """One copy of the right rows per piece of their key."""
        if not self.uneven:
            return right
        found = right.join(F.broadcast(self.hot), self.keys, "left")
        return self.copies(found, F.coalesce(F.col(PIECES), F.lit(1))).drop(PIECES)

    def copies(self, right: DataFrame, pieces: Column) -> DataFrame:
        if not self.uneven:
            return right
        return right.withColumn(PIECE, F.explode(F.sequence(F.lit(0), pieces - 1)))

    def join(self, spread: DataFrame, repeated: DataFrame) -> DataFrame:
        """Left join on key and piece. Both sides grow with the data, so neither is broadcast."""
        on = [*self.keys, PIECE] if self.uneven else self.keys
        return spread.join(repeated.hint("merge"), on, "left")


def left_joins(
    left: DataFrame,
    rights: Sequence[DataFrame],
    keys: Sequence[str],
    share: float | None = None,
) -> DataFrame:
    """Left joins of several tables on the same keys with one shuffle of each table.

    All joins use (keys, piece), so the partitioning of the first serves the others.
    """
    split = Split(left, keys, share)
    joined = split.spread()
    for right in rights:
        joined = split.join(joined, split.repeat(right))
    return joined.drop(PIECE)
