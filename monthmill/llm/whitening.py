"""Embedding whitening by spectral divide and conquer on polar decompositions.

Entries c of a vector become whole numbers floor(1024 * c) + 100000, so that sums over all rows
are exact whatever their order. Two passes over the rows give the covariance: first the number of
rows and the sums per dimension, then the second moments about the nearest whole means; the
rest to the true means is taken off in whole numbers, and only the end result is rounded.

The covariance (the square of the dimension, whatever the rows) is split on the driver: the polar
factor of the matrix shifted by its mean eigenvalue, found by the dynamically weighted Halley
iteration with QR factorisations, is +1 on the components above the shift and -1 on those below.
Half of it plus one half is the projector on the upper ones; its range and the complement are
invariant subspaces, which are split in turn until each has one dimension, or eigenvalues that
agree to rounding. The axes go to all tasks, which project their rows.

Scale: rows are read four times (sums, moments, the check of the result, the result) and never
shuffled; what is shuffled are sums per task. Nothing depends on keys, so no key is hot.

Edge cases: vectors that are null, empty or hold null or non-finite entries are dropped; repeated rows
and null ids count and are returned; directions without variance (all rows alike, one row) have
no component, so such tables and empty ones give no rows; vectors of more than one length are an
error, and so are entries beyond 2^42, whose whole number a double does not hold exactly; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthmill.staging import is_scan
from monthmill.workspace import Workspace

SCALE = 1024
SHIFT = 100_000
COMPONENTS = 8
LARGEST = 2.0**42
#: Directions with less than this share of the variance are rounding.
NO_VARIANCE = 1e-13
EPS = np.finfo(float).eps


def finite(vector: Column) -> Column:
    """Neither null nor empty, all entries finite."""
    good = F.forall(vector, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)) & ~F.isnan(x))
    return F.coalesce((F.size(vector) > 0) & good, F.lit(False))


def polar(matrix: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix without eigenvalues at zero."""
    size = len(matrix)
    x = matrix / np.linalg.norm(matrix)
    # no singular value that rounding lets us tell from zero is smaller
    low = max(EPS, 0.9 / (np.linalg.norm(np.linalg.pinv(x)) or 1.0))
    for _ in range(40):
        gap = np.cbrt(4 * (1 - low**2) / low**4)
        a = np.sqrt(1 + gap) + 0.5 * np.sqrt(max(0.0, 8 - 4 * gap + 8 * (2 - low**2) / (low**2 * np.sqrt(1 + gap))))
        b = (a - 1) ** 2 / 4
        c = a + b - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(c) * x, np.eye(size)]))
        last, x = x, b / c * x + (a - b / c) / np.sqrt(c) * q[:size] @ q[size:].T
        x = (x + x.T) / 2
        low = min(1.0, low * (a + b * low**2) / (1 + c * low**2))
        if np.linalg.norm(x - last) < 1e-13 * size and 1 - low < 1e-13:
            break
    return x


def spectrum(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix."""
    values, vectors = _split(matrix, 8 * EPS * np.linalg.norm(matrix), np.random.default_rng(0))
    order = np.argsort(-values, kind="stable")
    vectors = vectors[:, order]
    # rounding of the products on the way down is taken off once more, on the whole matrix
    vectors, _ = np.linalg.qr(vectors)
    return np.einsum("ij,ij->j", vectors, matrix @ vectors), vectors


def _split(matrix: np.ndarray, noise: float, random: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    size = len(matrix)
    middle = np.trace(matrix) / size
    if size == 1 or np.linalg.norm(matrix - middle * np.eye(size)) <= noise:
        return np.diag(matrix).copy(), np.eye(size)
    width = np.linalg.norm(matrix - middle * np.eye(size)) / np.sqrt(size)
    # the mean parts the eigenvalues unless one lies on it; then a shift beside it does
    for beside in (0.0, 0.05, -0.05, 0.13, -0.13, 0.31, -0.31):
        projector = (polar(matrix - (middle + beside * width) * np.eye(size)) + np.eye(size)) / 2
        rank = round(float(np.trace(projector)))
        if 0 < rank < size and np.linalg.norm(projector @ projector - projector) < 1e-12 * size:
            break
    else:
        return np.diag(matrix).copy(), np.eye(size)
    upper, _ = np.linalg.qr(projector @ random.standard_normal((size, rank)))
    basis, _ = np.linalg.qr(projector @ upper, mode="complete")
    found = []
    for part in (basis[:, :rank], basis[:, rank:]):
        inner = part.T @ matrix @ part
        values, vectors = _split((inner + inner.T) / 2, noise, random)
        found.append((values, part @ vectors))
    return np.concatenate([values for values, _ in found]), np.hstack([vectors for _, vectors in found])


@dataclass(frozen=True)
class Whitening:
    """What all rows give: their number, sums, axes and the variances along them."""

    n: int
    sums: tuple[int, ...]
    axes: np.ndarray
    variances: np.ndarray
    total: float

    @property
    def means(self) -> list[int]:
        """The nearest whole means."""
        return [(2 * s + self.n) // (2 * self.n) for s in self.sums]

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened coordinates of whole-number rows."""
        rest = np.array([(s - self.n * m) / self.n for s, m in zip(self.sums, self.means, strict=True)])
        centred = (x - np.array(self.means, dtype=np.int64)).astype(np.float64) - rest
        return centred @ self.axes / np.sqrt(self.variances)

    def deviations(self, x: np.ndarray) -> pa.Array:
        """The exact sum over dimensions of (n * x - S)^2."""
        means = np.array(self.means, dtype=np.int64)
        y = x - means
        rest = [s - self.n * m for s, m in zip(self.sums, self.means, strict=True)]
        bound = self.n * (int(np.abs(y).max(initial=0)) + 1)
        if bound * bound * len(rest) < 2**63:
            away = self.n * y - np.array(rest, dtype=np.int64)
            return pa.array((away * away).sum(axis=1)).cast(pa.decimal128(38, 0))
        large = self.n * y.astype(object) - np.array(rest, dtype=object)
        return pa.array([Decimal(int(total)) for total in (large * large).sum(axis=1)], pa.decimal128(38, 0))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    """The whole-number vectors of a batch, one row each."""
    lists = batch.column("x")
    if not len(lists):
        return np.zeros((0, 0), np.int64)
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _summed(rows: DataFrame, partial) -> dict[tuple[int, int], int]:
    """Whole numbers per pair of dimensions, added over all tasks."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if len(batch):
                found = partial(_matrix(batch))
                held = found if held is None else held + found
        if held is not None:
            i, j = np.nonzero(np.triu(np.ones(held.shape)) if held.shape[0] > 1 else np.ones(held.shape))
            yield pa.record_batch({
                "i": pa.array(i, pa.int32()),
                "j": pa.array(j, pa.int32()),
                "v": pa.array([Decimal(int(v)) for v in held[i, j]], pa.decimal128(38, 0)),
            })

    partials = rows.mapInArrow(sums, "i int, j int, v decimal(38,0)")
    found = partials.groupBy("i", "j").agg(F.sum("v").alias("v")).collect()  # dimension squared at most
    return {(r.i, r.j): int(r.v) for r in found}


def _exact(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The product of whole-number matrices, exact, as Python numbers."""
    largest = int(np.abs(x).max(initial=0)) * int(np.abs(y).max(initial=0))
    step = max(1, 2**53 // max(1, largest))
    total = np.zeros((x.shape[1], y.shape[1]), dtype=object)
    if largest >= 2**53:
        return total + x.T.astype(object) @ y.astype(object)
    for start in range(0, len(x), step):
        part = x[start : start + step].astype(np.float64).T @ y[start : start + step].astype(np.float64)
        total = total + part.astype(np.int64).astype(object)
    return total


def whole(vectors: DataFrame, space: Workspace, vector: str = "embedding") -> DataFrame:
    """Usable rows with their whole-number entries ``x``, beside ``vec_id``."""
    entries = F.col(f"`{vector}`").cast("array<double>")
    rounded = F.transform(entries, lambda c: F.floor(F.lit(float(SCALE)) * c) + F.lit(SHIFT))
    too_large = F.exists(entries, lambda c: F.abs(c) > F.lit(LARGEST))
    x = F.when(too_large, F.raise_error(F.lit("an entry is beyond 2^42"))).otherwise(rounded)
    rows = vectors.filter(finite(entries)).select("vec_id", x.alias("x"))
    return rows if is_scan(vectors) else space.write(rows, "whole-vectors")


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of all ``rows``; None if there are none."""
    counted = rows.agg(F.count(F.lit(1)).alias("n"), F.min(F.size("x")).alias("a"), F.max(F.size("x")).alias("b")).first()
    n, size = counted.n, counted.b
    if not n:
        return None
    if counted.a != size:
        raise ValueError(f"vectors of {counted.a} and of {size} entries")
    sums = _summed(rows, lambda x: _exact(np.ones((len(x), 1), np.int64), x))
    totals = tuple(sums[0, j] for j in range(size))
    start = Whitening(n, totals, np.zeros((size, 0)), np.zeros(0), 0.0)
    means = np.array(start.means, dtype=np.int64)
    moments = _summed(rows, lambda x: _exact(x - means, x - means))
    rest = [s - n * m for s, m in zip(totals, start.means, strict=True)]
    covariance = np.zeros((size, size))
    for (i, j), value in moments.items():
        covariance[i, j] = covariance[j, i] = (n * value - rest[i] * rest[j]) / (n * n)
    total = float(np.trace(covariance))
    if total <= 0:
        return start
    values, vectors = spectrum(covariance)
    used = [k for k in range(min(components, size)) if values[k] > NO_VARIANCE * total]
    return Whitening(n, totals, vectors[:, used], values[used], total)


def identity_error(rows: DataFrame, fitted: Whitening) -> float:
    """The largest absolute entry of the covariance of all whitened rows minus the identity."""
    width = len(fitted.variances)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 1, width))
        for batch in batches:
            if len(batch):
                w = fitted.project(_matrix(batch))
                total += np.vstack([w.T @ w, w.sum(axis=0)])
        i, j = np.indices(total.shape)
        yield pa.record_batch({"i": pa.array(i.ravel()), "j": pa.array(j.ravel()), "v": pa.array(total.ravel())})

    sums = rows.mapInArrow(moments, "i bigint, j bigint, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    found = np.zeros((width + 1, width))
    for i, j, v in sums.collect():  # the square of the number of components
        found[i, j] = v
    mean = found[width] / fitted.n
    return float(np.abs(found[:width] / fitted.n - np.outer(mean, mean) - np.eye(width)).max(initial=0.0))


def whiten(
    vectors: DataFrame, space: Workspace, components: int = COMPONENTS, vector: str = "embedding"
) -> DataFrame:
    """One row per usable vector and component: ``vec_id``, ``component`` (from 1, by falling
    variance), ``n``, ``deviation`` (exact), ``whitened``, ``explained`` and ``identity_error``."""
    rows = whole(vectors, space, vector)
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = (
        f"vec_id {kind}, component int, n bigint, deviation decimal(38,0), "
        "whitened double, explained double, identity_error double"
    )
    fitted = fit(rows, components)
    if fitted is None or not len(fitted.variances):
        return rows.sparkSession.createDataFrame([], schema)
    error, shares = identity_error(rows, fitted), fitted.variances / fitted.total

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                x = _matrix(batch)
                w = fitted.project(x)
                row = pa.array(np.repeat(np.arange(len(x)), w.shape[1]))
                yield pa.record_batch({
                    "vec_id": batch.column("vec_id").take(row),
                    "component": pa.array(np.tile(np.arange(1, w.shape[1] + 1), len(x)), pa.int32()),
                    "n": pa.array(np.full(w.size, fitted.n, dtype=np.int64)),
                    "deviation": fitted.deviations(x).take(row),
                    "whitened": pa.array(w.ravel()),
                    "explained": pa.array(np.tile(shares, len(x))),
                    "identity_error": pa.array(np.full(w.size, error)),
                })

    return rows.mapInArrow(projected, schema)
