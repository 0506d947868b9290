"""Embedding near-dedup by a subspace pigeonhole join, exact for cosine >= 0.9.

Two unit vectors with cosine c are at squared distance 2 - 2c. All vectors are rotated to the
principal axes of the whole table and split into blocks of ``BLOCK_DIMS`` axes; every block gets a
share of the squared distance in proportion to its variance. If two vectors are within the
total, they are within the share of at least one block. Each block is a range join: vectors
have a home cell on a grid over the block's first axes (as many as part the rows into cells of
the wanted size, none where the range is as wide as the data) and also visit the neighbouring
cells that their range touches. Candidates of a cell are found block by block of a distance matrix,
kept in the first block that joins them (so each pair is judged once), and verified exactly with
the full vectors in double precision.

What leaves a cell is never the pairs: only how many vectors each row is linked to, and a
spanning forest of the links. Components are then joined over all cells.

Scale: equal vectors meet first (on the map side) and are one class with a count. Cells with
more than ``CELL_ROWS`` vectors are cut into parts, and every pair of parts is a task, so memory
is bounded and no task grows with the data. The grid takes more axes the more vectors there are.
Vectors without structure (all variances alike) leave a share of all pairs to compare that falls
only slowly with the number of axes; that is a property of the method.

Edge cases: vectors that are null, empty, zero, or hold null or non-finite components link with
nothing; vectors of different lengths do not link; repeated rows are vectors of their own that
link with each other; an empty table gives an empty result; other columns (the labels too) are
not read. A null vec_id never names a component unless all of its vec_ids are null.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthmill.llm.common import spread_lookup
from monthmill.llm.components import components
from monthmill.workspace import Workspace

COSINE = 0.9
BLOCK_DIMS = 16
CELL_ROWS = 20_000
#: Rows and columns of the distance matrix computed at once.
TILE = (1024, 4096)
#: Slack for rounding in block distances; pairs are verified exactly afterwards.
SLACK = 1e-9


def usable(vector: Column) -> Column:
    """Neither null nor empty nor zero, all components finite."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)) & ~F.isnan(x))
    some = F.exists(vector, lambda x: x != 0)
    return F.coalesce((F.size(vector) > 0) & finite & some, F.lit(False))


def unit_rows(vectors: pd.Series, width: int) -> np.ndarray:
    """Unit vectors in double precision, shorter ones filled up with zeros."""
    if len(vectors) and (vectors.map(len) == width).all():
        out = np.stack(vectors.to_list()).astype(np.float64)
    else:
        out = np.zeros((len(vectors), width))
        for k, vector in enumerate(vectors):
            out[k, : len(vector)] = vector
    # the largest component first, so that squares neither overflow nor vanish
    out /= np.abs(out).max(axis=1, keepdims=True)
    return out / np.sqrt((out * out).sum(axis=1, keepdims=True))


def rotated(units: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Coordinates on the principal axes. Added up axis by axis: a row's result must not depend
    on the rows beside it, as matrix products do in their last bits."""
    out = np.zeros((len(units), axes.shape[1]))
    for d in range(units.shape[1]):
        out += units[:, d : d + 1] * axes[d]
    return out


def principal_axes(classes: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Axes (columns) and variances, largest first, over all classes."""

    def moments(frames):
        total, second, n = np.zeros(width), np.zeros((width, width)), 0
        for frame in frames:
            units = unit_rows(frame["embedding"], width)
            total, second, n = total + units.sum(axis=0), second + units.T @ units, n + len(units)
        if n:
            yield pd.DataFrame({
                "i": np.arange(width + 1),
                "row": [*second, np.concatenate([total, [n]])],
            })

    sums = classes.select("embedding").mapInPandas(moments, "i int, row array<double>")
    values = sums.select("i", F.posexplode("row").alias("j", "x")).groupBy("i", "j").agg(F.sum("x").alias("x"))
    matrix = np.zeros((width + 1, width + 1))
    for i, j, x in values.collect():  # the square of the vector length, whatever the rows
        matrix[i, j] = x
    n = max(1.0, matrix[width, width])
    mean = matrix[width, :width] / n
    variances, axes = np.linalg.eigh(matrix[:width, :width] / n - np.outer(mean, mean))
    order = np.argsort(variances)[::-1]
    return axes[:, order], np.maximum(variances[order], 0)


class Layout:
    """Blocks of axes with their squared-distance budgets and grids."""

    def __init__(self, variances: np.ndarray, rows: int, cosine: float, cell_rows: int = CELL_ROWS):
        whole = 2 - 2 * cosine
        self.blocks: list[tuple[slice, float, float, int]] = []
        total = variances.sum()
        for start in range(0, len(variances), BLOCK_DIMS):
            part = slice(start, min(start + BLOCK_DIMS, len(variances)))
            share = variances[part].sum() / total if total else 0.0
            if share < 1e-6 and self.blocks:
                continue  # the other blocks' shares still add up to nearly all; see below
            self.blocks.append((part, share, 0.0, 1))
        scale = sum(share for _, share, _, _ in self.blocks) or 1.0
        sized = []
        for part, share, _, _ in self.blocks:
            # shares are raised to the whole again, so the pigeonhole holds without the blocks left out
            budget = whole * (share / scale if total else 1.0) * (1 + SLACK) + SLACK
            radius = math.sqrt(budget)
            grid, cells = 0, 1.0
            while grid < part.stop - part.start and rows / cells > cell_rows:
                spread = 4 * math.sqrt(max(variances[part.start + grid], 0.0))
                if spread < 4 * radius:
                    break  # fewer than two cells on this axis: it would copy rows and part nothing
                cells *= spread / (2 * radius)
                grid += 1
            sized.append((part, budget, 2 * radius, grid))
        self.blocks = sized


def visits(coordinates: np.ndarray, layout: Layout):
    """Per block: number, rows, cells and whether the cell is the row's home."""
    for number, (part, budget, width, grid) in enumerate(layout.blocks):
        place = coordinates[:, part][:, :grid]
        radius = math.sqrt(budget) * (1 + 1e-9)
        low = np.floor((place - radius) / width).astype(np.int64)
        high = np.floor((place + radius) / width).astype(np.int64)
        home = np.floor(place / width).astype(np.int64)
        for corner in np.ndindex(*[int(x) for x in (high - low).max(axis=0) + 1] if len(place) else []):
            cell = low + np.asarray(corner)
            rows = np.flatnonzero((cell <= high).all(axis=1))
            if len(rows):
                yield number, rows, cell[rows], (cell[rows] == home[rows]).all(axis=1)


class Forest:
    """Union-find over the rows of a cell."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        while True:
            a, b = self.root[i], self.root[j]
            apart = a != b
            if not apart.any():
                return
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while True:
                above = self.root[self.root]
                if (above == self.root).all():
                    break
                self.root = above


def cell_links(
    keys: np.ndarray, amounts: np.ndarray, sizes: np.ndarray, units: np.ndarray, places: np.ndarray,
    left: np.ndarray, right: np.ndarray, block: int, layout: Layout, cosine: float,
) -> tuple[np.ndarray, np.ndarray]:
    """Links between the rows ``left`` and ``right`` of a cell whose first joining block is
    ``block``: linked vectors per row, and a root per row of the spanning forest."""
    linked = np.zeros(len(keys), dtype=np.int64)
    forest = Forest(len(keys))
    part, budget, _, _ = layout.blocks[block]
    near = places[:, part].astype(np.float32)
    half = (near * near).sum(axis=1, keepdims=True) / 2
    # one product gives x.y - |x|^2/2 - |y|^2/2, minus half the squared distance
    one = np.ones_like(half)
    rows_of, columns_of = np.hstack([near, -half, one]), np.hstack([near, one, -half])
    least = np.float32(-budget / 2 - 1e-5)
    left, right = left[np.argsort(keys[left])], right[np.argsort(keys[right])]

    def apart(i: np.ndarray, j: np.ndarray, at: slice) -> np.ndarray:
        difference = places[i, at] - places[j, at]
        return (difference * difference).sum(axis=1)

    for a in range(0, len(left), TILE[0]):
        rows = left[a : a + TILE[0]]
        first = int(np.searchsorted(keys[right], keys[rows[0]], side="right"))
        for b in range(first, len(right), TILE[1]):
            columns = right[b : b + TILE[1]]
            i, j = np.nonzero(rows_of[rows] @ columns_of[columns].T >= least)
            i, j = rows[i], columns[j]
            later = keys[i] < keys[j]  # a pair belongs to the home cell of its smaller key
            i, j = i[later], j[later]
            for start in range(0, len(i), 50_000):
                x, y = i[start : start + 50_000], j[start : start + 50_000]
                own = (apart(x, y, part) <= budget) & (sizes[x] == sizes[y])
                x, y = x[own], y[own]
                for earlier_part, earlier_budget, _, _ in layout.blocks[:block]:
                    new = apart(x, y, earlier_part) > earlier_budget
                    x, y = x[new], y[new]
                close = np.einsum("ij,ij->i", units[x], units[y]) >= cosine
                x, y = x[close], y[close]
                np.add.at(linked, x, amounts[y])
                np.add.at(linked, y, amounts[x])
                forest.link(x, y)
    return linked, forest.root


def near_duplicates(
    vectors: DataFrame, space: Workspace, cosine: float = COSINE, cell_rows: int = CELL_ROWS
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` for every row of ``vectors``."""
    rows = space.write(vectors.select("vec_id", "embedding", usable(F.col("embedding")).alias("good")), "vectors")
    classes = space.write(
        rows.filter("good").groupBy("embedding").agg(
            F.min("vec_id").alias("label"), F.count(F.lit(1)).alias("amount")
        ).withColumn("key", F.monotonically_increasing_id()),
        "vector-classes",
    )
    n, width, total = classes.agg(
        F.count(F.lit(1)), F.max(F.size("embedding")), F.sum("amount")
    ).first()
    if not n:
        return rows.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.lit(True).alias("kept"))
    axes, variances = principal_axes(classes, width)
    layout = Layout(variances, n, cosine, cell_rows)

    def route(frames):
        for frame in frames:
            for begin in range(0, len(frame), 5000):
                piece = frame.iloc[begin : begin + 5000].reset_index(drop=True)
                places = rotated(unit_rows(piece["embedding"], width), axes)
                for block, found, cells, home in visits(places, layout):
                    yield pd.DataFrame({
                        "block": block, "cell": [c.tobytes() for c in cells], "home": home,
                        "key": piece["key"].to_numpy()[found], "amount": piece["amount"].to_numpy()[found],
                        "embedding": piece["embedding"].to_numpy()[found],
                    })

    # single precision stays as narrow as it is; anything else is compared as doubles
    given = classes.schema["embedding"].dataType.simpleString()
    kind = given if given == "array<float>" else "array<double>"
    shape = f"block int, cell binary, home boolean, key bigint, amount bigint, embedding {kind}"
    routed = classes.select("key", "amount", F.col("embedding").cast(kind)).mapInPandas(route, shape)
    routed = space.write(routed, "vector-cells")
    counts = routed.groupBy("block", "cell").agg(
        F.count(F.lit(1)).alias("present"), F.sum(F.col("home").cast("int")).alias("homes")
    ).filter("homes > 0 and present > 1")
    # rows of a cell are dealt over its parts; every pair of parts, homes against all, is a task
    counts = counts.withColumn("lefts", F.ceil(F.col("homes") / cell_rows).cast("int"))
    counts = space.write(counts.withColumn("rights", F.ceil(F.col("present") / cell_rows).cast("int")), "vector-counts")
    dealt = spread_lookup(routed, counts, ["block", "cell"], "present", routed.count()).filter("present is not null")
    turn = F.xxhash64("key")
    as_left = dealt.filter("home").select(
        "block", "cell", F.pmod(turn, F.col("lefts")).cast("int").alias("l"),
        F.explode(F.sequence(F.lit(0), F.col("rights") - 1)).alias("r"),
        F.lit(True).alias("is_left"), "key", "amount", "embedding",
    )
    as_right = dealt.select(
        "block", "cell", F.explode(F.sequence(F.lit(0), F.col("lefts") - 1)).alias("l"),
        F.pmod(turn, F.col("rights")).cast("int").alias("r"),
        F.lit(False).alias("is_left"), "key", "amount", "embedding",
    )

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        block = int(frame["block"].iloc[0])
        left_keys = frame["key"].to_numpy()[frame["is_left"].to_numpy()]
        right_keys = frame["key"].to_numpy()[~frame["is_left"].to_numpy()]
        frame = frame.drop_duplicates("key")
        keys = frame["key"].to_numpy()
        order = np.argsort(keys)
        left, right = (order[np.searchsorted(keys[order], x)] for x in (left_keys, right_keys))
        units = unit_rows(frame["embedding"], width)
        sizes = frame["embedding"].map(len).to_numpy()
        linked, root = cell_links(keys, frame["amount"].to_numpy(), sizes, units, rotated(units, axes),
                                  left, right, block, layout, cosine)
        some = np.flatnonzero(linked)
        return pd.DataFrame({"key": keys[some], "linked": linked[some], "root": keys[root[some]]})

    found = as_left.unionByName(as_right).groupBy("block", "cell", "l", "r").applyInPandas(
        compare, "key bigint, linked bigint, root bigint"
    )
    found = space.write(found, "vector-links")
    space.drop(routed, counts)
    linked = found.groupBy("key").agg(F.sum("linked").alias("linked"))
    star = components(found.select(F.col("key").alias("a"), F.col("root").alias("b")), space)
    placed = classes.select("key", "label").join(star.withColumnRenamed("node", "key"), "key", "left")
    placed = placed.withColumn("component", F.coalesce("component", "key"))
    names = placed.groupBy("component").agg(F.min("label").alias("component_id"))
    table = space.write(
        classes.join(placed.select("key", "component"), "key").join(names, "component").join(linked, "key", "left")
        .select("embedding", "amount", "component_id",
                (F.coalesce("linked", F.lit(0)) + F.col("amount") - 1).alias("n_links")),
        "vector-result",
    )
    good = spread_lookup(rows.filter("good"), table, ["embedding"], "amount", total)
    bad = rows.filter("not good").select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    out = good.select("vec_id", F.col("n_links").cast("bigint").alias("n_links"), "component_id").unionByName(bad)
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
