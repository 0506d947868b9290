"""Exact quantiles of many columns without sorting or shuffling the values.

Each pass is one scan that numpy reads as Arrow batches: every task sends one small state per column, those of
the tasks that share a salt are merged first, and only then are the merged states of a column brought
together, each column in a place of its own. No task takes a state from every task.

The first pass summarizes the columns, which brackets each quantile between two values. The next ones
count exactly what lies below, at and between the ends of a bracket, and look between them: with
another summary while many values are left there, by gathering them once their number is known to
be small. Up to some five million rows that makes two passes, and one more per factor of 250 beyond.
A bracket that misses its quantile is left again.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from monthmill.operators import summaries
from monthmill.staging import settled
from monthmill.workspace import importable

#: Points of a summary. With 4000 the rank error is at most 0.0005: four times values are condensed.
SKETCH = 4000
#: What is taken for the rank error of a summary.
ERROR = 0.001
#: Parts into which a summary divides a bracket that holds many values.
GRID = 500
GATHER = 20_000


@dataclass(frozen=True)
class _Interval:
    """The values of a column strictly between two bounds; at most ``bound`` of them."""

    column: str
    low: float | None
    high: float | None
    bound: int

    @property
    def small(self) -> bool:
        return self.bound <= GATHER

    @property
    def single(self) -> bool:
        """Both ends alike: only the rank of that value is left to be made sure of."""
        return self.low is not None and self.low == self.high

    def split(self, values: np.ndarray) -> tuple[int, int, np.ndarray, int]:
        """How many values lie below, which ones inside, and how many at the ends."""
        below = at_low = at_high = 0
        if self.low is not None:
            below, at_low = int((values < self.low).sum()), int((values == self.low).sum())
        if self.single:
            return below, at_low, values[:0], 0
        if self.high is not None:
            at_high = int((values == self.high).sum())
            values = values[values < self.high]
        if self.low is not None:
            values = values[values > self.low]
        return below, at_low, values, at_high


_NOTHING = Row(below=0, at_low=0, inside=0, at_high=0, cuts=None, held=[])

COUNTS = ("below", "at_low", "inside", "at_high")
LISTS = ("points", "weights", "held")
STATES = ", ".join(["n int", "_salt int", *[f"{c} bigint" for c in COUNTS], *[f"{c} array<double>" for c in LISTS]])
_TYPES = pa.schema(
    [("n", pa.int32()), ("_salt", pa.int32())]
    + [(c, pa.int64()) for c in COUNTS]
    + [(c, pa.list_(pa.float64())) for c in LISTS]
)


def _task_states(intervals: Mapping[int, _Interval], salts: int, size: int) -> Callable:
    """What a scan task knows of each interval: the counts, and the values inside as a list if they are
    few, else as a summary."""
    small = {n for n, interval in intervals.items() if interval.small}

    def states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {n: np.zeros(4, dtype=np.int64) for n in intervals}
        held: dict[int, list] = {n: [] for n in intervals}
        growing = {n: summaries.Growing(size) for n in intervals}
        seen = False
        for table in summaries.chunks(batches):
            seen = True
            columns = {c: summaries.known(summaries.numbers(table[c])) for c in table.column_names}
            for n, interval in intervals.items():
                below, at_low, inside, at_high = interval.split(columns[interval.column])
                counts[n] += (below, at_low, len(inside), at_high)
                if n in small:
                    held[n].append(inside)
                else:
                    growing[n].add(inside)
        if seen:
            salt = TaskContext.get().partitionId() % salts
            rows = []
            for n in intervals:
                points, weights = growing[n].points()
                gathered = np.concatenate(held[n]) if held[n] else ()
                lists = dict(zip(LISTS, (points, weights, gathered), strict=True))
                rows.append({"n": n, "_salt": salt, **dict(zip(COUNTS, counts[n].tolist(), strict=True)), **lists})
            yield pa.RecordBatch.from_pylist(rows, schema=_TYPES)

    return states


def _merging(size: int) -> Callable[[pa.Table], pa.Table]:
    """States of one interval to one."""

    def merge(table: pa.Table) -> pa.Table:
        points, weights, held = (summaries.lists(table[c]) for c in LISTS)
        values, heavy = summaries.merged(list(zip(points, weights, strict=True)), size)
        row = {c: table[c][0].as_py() for c in ("n", "_salt")} | {c: sum(table[c].to_pylist()) for c in COUNTS}
        row |= {"points": values, "weights": heavy, "held": np.concatenate(held) if held else ()}
        return pa.Table.from_pylist([row], schema=_TYPES)

    return merge


def merged_states(df: DataFrame, intervals: Mapping[int, _Interval]) -> DataFrame:
    """One row per interval, ``n`` and the merged fields: first by salt, then by interval."""
    importable(df.sparkSession)
    salts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = sorted({interval.column for interval in intervals.values()})
    rows = df.select(*names).mapInArrow(_task_states(dict(intervals), salts, SKETCH), STATES)
    by_salt = rows.groupBy("_salt", "n").applyInArrow(_merging(SKETCH), STATES)
    return by_salt.groupBy("n").applyInArrow(_merging(SKETCH), STATES).drop("_salt")


def _states(df: DataFrame, intervals: Sequence[_Interval], points: Sequence[float]) -> list:
    """Counts of each interval, and its summary at ``points`` or its sorted values."""
    known: dict[int, Row] = {}
    for row in merged_states(df, dict(enumerate(intervals))).collect():
        cuts = summaries.quantiles(row.points, row.weights, points)
        known[row.n] = Row(**{c: row[c] for c in COUNTS}, cuts=cuts, held=sorted(row.held))
    # a table without rows has no states
    return [known.get(n, _NOTHING) for n in range(len(intervals))]


def _around(p: float) -> tuple[float, float]:
    """Probabilities that enclose ``p`` given the error of a summary."""
    return p - ERROR, p + ERROR


def _first_bracket(column: str, count: int, p: float, ends: Mapping[float, float]) -> _Interval:
    if count <= GATHER:
        return _Interval(column, None, None, count)
    low, high = _around(p)
    return _Interval(column, ends.get(low), ends.get(high), math.ceil(count * 4 * ERROR) + 2)


def _look(df: DataFrame, targets: Mapping[tuple[str, int], _Interval]) -> tuple[dict, dict]:
    """One pass: targets found, and the intervals in which the others have to be looked for."""
    groups: dict[_Interval, list[int]] = {}
    for (_, rank), interval in targets.items():
        groups.setdefault(interval, []).append(rank)
    states = _states(df, list(groups), np.linspace(0, 1, GRID + 1))

    found, pending = {}, {}
    for (interval, ranks), state in zip(groups.items(), states, strict=True):
        before, column = state.below + state.at_low, interval.column
        for rank in ranks:
            target = column, rank
            if rank < state.below:  # not in the bracket after all: go on below it
                pending[target] = _Interval(column, None, interval.low, state.below)
            elif rank < before:
                found[target] = interval.low
            elif rank < before + state.inside:
                if interval.small:
                    found[target] = state.held[rank - before]
                else:
                    place = (rank - before) / state.inside * GRID
                    wide = max(1, math.ceil(ERROR * GRID))
                    left, right = max(math.floor(place) - wide, 0), min(math.ceil(place) + wide, GRID)
                    bound = math.ceil(state.inside * ((right - left) / GRID + 2 * ERROR)) + 2
                    # the ends of the grid are ends of the bracket, whose own values lie outside of it
                    low = state.cuts[left] if left else interval.low
                    high = state.cuts[right] if right < GRID else interval.high
                    pending[target] = _Interval(column, low, high, min(bound, state.inside))
            elif rank < before + state.inside + state.at_high:
                found[target] = interval.high
            else:  # or above it
                pending[target] = _Interval(column, interval.high, None, 2**62)
    return found, pending


def _numbers(columns: Mapping[str, Column]) -> dict[str, Column]:
    """The columns as doubles under short names. The tasks leave out NaN: a test per column here would make
    a generated method that the JVM does not compile."""
    return {f"v{n}": value.cast("double") for n, value in enumerate(columns.values())}


def exact_quantiles(
    df: DataFrame,
    columns: Mapping[str, Column],
    probabilities: Sequence[float],
    method: str = "linear",
) -> dict[str, list[float | None]]:
    """Quantiles of each column, nulls and NaN ignored; None for a column without values.

    ``linear`` interpolates between neighbours, ``lower`` takes the value at rank
    ``ceil(p * n)``. Values are compared as doubles. A derived table is staged first, with
    the named columns only; a scan is read again in each pass.
    """
    if not columns:
        return {}
    short = {name: f"v{n}" for n, name in enumerate(columns)}
    values = settled(df.select(*[v.alias(name) for name, v in _numbers(columns).items()]), "quantiles")

    ends = sorted({e for p in probabilities for e in _around(p) if 0 < e < 1}) or [0.5]
    whole = [_Interval(name, None, None, 2**62) for name in short.values()]
    wanted: dict[tuple[str, float], tuple[int, float]] = {}
    targets: dict[tuple[str, int], _Interval] = {}
    for interval, state in zip(whole, _states(values, whole, ends), strict=True):
        name, count = interval.column, state.inside
        for p in probabilities if count else ():
            place = p * (count - 1) if method == "linear" else max(math.ceil(p * count) - 1, 0)
            rank = math.floor(place)
            wanted[name, p] = rank, place - rank
            bracket = _first_bracket(name, count, p, dict(zip(ends, state.cuts)))
            for needed in (rank, rank + 1) if place > rank else (rank,):
                targets[name, needed] = bracket

    at: dict[tuple[str, int], float] = {}
    while targets:
        found, targets = _look(values, targets)
        at.update(found)

    def value(name: str, p: float) -> float | None:
        if (name, p) not in wanted:
            return None
        rank, part = wanted[name, p]
        start = at[name, rank]
        return start + (at[name, rank + 1] - start) * part if part else start

    return {name: [value(short[name], p) for p in probabilities] for name in columns}


def approximate_quantiles(
    df: DataFrame, columns: Mapping[str, Column], probabilities: Sequence[float]
) -> dict[str, list[float | None]]:
    """Quantiles with a rank error of at most ``ERROR``, one summary per column, in one pass."""
    if not columns:
        return {}
    short = _numbers(columns)
    values = df.select(*[v.alias(name) for name, v in short.items()])
    states = _states(values, [_Interval(name, None, None, 2**62) for name in short], probabilities)
    none = [None] * len(probabilities)
    return {name: list(state.cuts or none) for name, state in zip(columns, states, strict=True)}
