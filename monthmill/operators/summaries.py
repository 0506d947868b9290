"""Summaries of many numbers: a few weighted points each, which merge, made by numpy over Arrow batches.

A summary of ``size`` points misses a rank by half a point's weight at most, ``1 / (2 * size)`` of the values
it stands for; each further merge that condenses adds as much. Equal values share a point, so a column with few
distinct values is kept exactly. The smallest and the largest value always stay.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Points of a summary, and of one that a scan task sends for each of many groups.
SIZE = 4000
SENT = 1000
#: Values that are sorted at once, and summaries that are merged at once.
CHUNK = 1 << 17
FAN = 16

Points = tuple[np.ndarray, np.ndarray]
NONE: Points = np.empty(0), np.empty(0)


def merged(parts: Sequence[Points], size: int) -> Points:
    """Points and weights of several summaries, condensed to ``size`` points and both ends."""
    if not parts:
        return NONE
    values, weights = (np.concatenate(side) for side in zip(*parts, strict=True))
    order = np.argsort(values, kind="stable")
    return _condensed(values[order], weights[order], size)


def summary(values: np.ndarray, size: int) -> Points:
    """The summary of plain values."""
    values = np.sort(values)
    return _condensed(values, np.ones(len(values)), size)


def _condensed(values: np.ndarray, weights: np.ndarray, size: int) -> Points:
    if not len(values):
        return NONE
    first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    values, weights = values[first], np.add.reduceat(weights, first)
    if len(values) <= size + 2:
        return values, weights
    upto = np.cumsum(weights)
    picked = np.searchsorted(upto, (np.arange(size) + 0.5) * (upto[-1] / size))
    equal = np.full(size, upto[-1] / size)
    return (
        np.concatenate((values[:1], values[np.minimum(picked, len(values) - 1)], values[-1:])),
        np.concatenate(([0.0], equal, [0.0])),
    )


def quantiles(points: Sequence[float], weights: Sequence[float], shares: Sequence[float]) -> list[float] | None:
    """Values at the given shares of a summary; None if it has no values."""
    values, weights = merged([(np.asarray(points, float), np.asarray(weights, float))], max(len(points), 1))
    if not len(values):
        return None
    upto = np.cumsum(weights)
    # a weight may be off in its last bits; a share of 1 is the largest value
    ranks = np.ceil(np.asarray(shares, float) * upto[-1] - 1e-6)
    places = np.minimum(np.searchsorted(upto, np.maximum(ranks, 1e-6) - 1e-6), len(values) - 1)
    return [float(values[-1] if share >= 1 else values[0] if share <= 0 else values[at]) for share, at in zip(shares, places)]


class Growing:
    """The summary of values that come piece by piece, in bounded room."""

    def __init__(self, size: int = SIZE, chunk: int = CHUNK):
        self.size, self.chunk = size, chunk
        self.plain: list[np.ndarray] = []
        self.waiting = self.count = 0
        self.levels: list[list[Points]] = []

    def add(self, values: np.ndarray) -> None:
        self.plain.append(values)
        self.waiting += len(values)
        self.count += len(values)
        if self.waiting >= self.chunk:
            self._settle()

    def _settle(self) -> None:
        if self.waiting:
            self._keep(summary(np.concatenate(self.plain), self.size), 0)
        self.plain, self.waiting = [], 0

    def _keep(self, points: Points, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(points)
        if len(self.levels[level]) == FAN:
            full, self.levels[level] = self.levels[level], []
            self._keep(merged(full, self.size), level + 1)

    def points(self, size: int | None = None) -> Points:
        self._settle()
        parts = [points for level in self.levels for points in level]
        return merged(parts, size or self.size)


def chunks(batches: Iterator[pa.RecordBatch], rows: int = CHUNK) -> Iterator[pa.Table]:
    """Arrow batches put together to tables of at least ``rows`` rows, but for the last."""
    held, count = [], 0
    for batch in batches:
        held.append(batch)
        count += batch.num_rows
        if count >= rows:
            yield pa.Table.from_batches(held)
            held, count = [], 0
    if count:
        yield pa.Table.from_batches(held)


def packed(columns: Sequence[str]) -> Column:
    """Columns as doubles in one array, nulls as NaN: one array a row reaches Python several times faster than as
    many columns."""
    return F.array(*[F.coalesce(F.col(f"`{name}`").cast("double"), F.lit(float("nan"))) for name in columns])


def matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """A column of ``packed`` arrays: a row for each, a column for each of theirs."""
    parts = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    flat = [part.flatten().to_numpy(zero_copy_only=False) for part in parts]
    return np.concatenate(flat or [np.empty(0)]).reshape(-1, width)


def numbers(column: pa.ChunkedArray) -> np.ndarray:
    """A column of doubles; nulls become NaN."""
    return column.to_numpy()


def known(values: np.ndarray) -> np.ndarray:
    missing = np.isnan(values)
    return values[~missing] if missing.any() else values


def lists(column: pa.ChunkedArray) -> list[np.ndarray]:
    """The lists of a column of lists of doubles."""
    return [np.asarray(v, float) for v in (s.values.to_numpy() for s in column if s.is_valid)]
