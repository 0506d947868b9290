"""Hard-negative mining with an inverted multi-index, exact.

Vectors of whole numbers are split into two halves; a codebook per half, fitted on a bounded sample,
gives every row two codewords and so one of their pairs, its cell. What an anchor can score with a row
of a cell is at most the sum of two half scores: the product of the anchor's half with the codeword
plus its norm times the largest distance (the radius) of any row from that codeword. A
multi-sequence heap over the two sorted lists of half scores visits an anchor's cells by falling
bound.

A search asks, per anchor, for the first so many rows of a window of scores, of the anchor's label or of
the others. Anchors visit cells in waves, each with ``GROWTH`` times the rows of the one before. A
window is certified, and its anchor stops, when the next cell's bound lies below the window or below the
last of enough rows found, or when no cell is left. Positives are searched first; each gives a
window of its own for the negatives.

Scale: codebooks, radii and the number of rows per cell (the square of the codebook at most) are all that is
sent to every task. Cells with more than ``BLOCK_ROWS`` rows are cut into blocks, and the
anchors that visit a block come in groups, so what meets in a task is bounded however full a cell
is or however many anchors visit it. Every block sends the few best rows per window only, and in later waves
only such as reach the last of the rows found so far.
Vectors without structure have wide radii: most cells are then visited, which costs time but
loses nothing.

Edge cases: rows with a null label, a null or empty vector or a null entry take no part (non-finite entries
have no whole number; leave them out before); repeated rows are rows of their own, and a row is
never its own partner; ties go to the smaller vec_id, nulls last, then to the earlier row; a null
vec_id is no anchor; vectors of more than one length are an error; empty tables give no rows; other
columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthmill.workspace import Workspace

#: The codebooks are fitted on so many rows, chosen by a hash; the index has every row.
SAMPLE_ROWS = 20_000
CELL_ROWS = 256
CODEWORDS = 512
ITERATIONS = 8
BLOCK_ROWS = 1024
GROUP_ANCHORS = 256
FIRST_ROWS = 2048
GROWTH = 8
#: Slack for rounding in bounds; scores are whole numbers and exact.
SLACK = 1e-9

HIT = "anchor bigint, k int, row bigint, vec_id bigint, score bigint"


def codebook(sample: np.ndarray, size: int) -> np.ndarray:
    """At most ``size`` codewords by Lloyd's iteration, started from different rows."""
    distinct = np.unique(sample, axis=0)
    random = np.random.default_rng(0)
    words = distinct[random.permutation(len(distinct))[:size]]
    for _ in range(ITERATIONS):
        home = nearest(sample, words)[0]
        held = np.bincount(home, minlength=len(words))
        sums = np.zeros_like(words)
        np.add.at(sums, home, sample)
        words = np.where(held[:, None] > 0, sums / np.maximum(held, 1)[:, None], words)
    return words


def nearest(rows: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest codeword of each row and the distance to it."""
    home = np.zeros(len(rows), np.int64)
    norms = (words * words).sum(axis=1)
    for start in range(0, len(rows), 4096):
        part = rows[start : start + 4096]
        home[start : start + 4096] = np.argmin(norms - 2 * part @ words.T, axis=1)
    return home, np.sqrt(((rows - words[home]) ** 2).sum(axis=1))


@dataclass(frozen=True)
class Index:
    """Codebooks of the two halves, the radius of each codeword, and the rows of each cell."""

    books: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray]
    rows: np.ndarray

    @property
    def cut(self) -> int:
        return self.books[0].shape[1]

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x[:, : self.cut], x[:, self.cut :]

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The cell of each row and its distances from the two codewords."""
        (a, near), (b, far) = [nearest(half, book) for half, book in zip(self.halves(x), self.books, strict=True)]
        return a * len(self.books[1]) + b, near, far

    def bounds(self, anchor: np.ndarray) -> list[np.ndarray]:
        """Per half, the most that the anchor can score with a row of each codeword."""
        found = []
        for half, book, radius in zip(self.halves(anchor[None, :]), self.books, self.radii, strict=True):
            norm = float(np.linalg.norm(half))
            size = norm * (np.linalg.norm(book, axis=1) + radius)
            found.append(book @ half[0] + norm * radius + SLACK * size + SLACK)
        return found

    def visits(self, anchor: np.ndarray, skip: int, wanted: int) -> tuple[list[int], int, float | None]:
        """Cells in the order of falling bounds after the first ``skip``, until they hold ``wanted`` rows;
        how many cells have been passed then, and the bound of the next one (None: there is none)."""
        first, second = self.bounds(anchor)
        a, b = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
        first, second = first[a], second[b]
        heap = [(-(first[0] + second[0]), 0, 0)] if len(a) and len(b) else []
        cells: list[int] = []
        passed = held = 0
        while heap:
            bound, i, j = heapq.heappop(heap)
            cell = int(a[i] * len(b) + b[j])
            if passed >= skip and self.rows[cell]:
                if held >= wanted:
                    return cells, passed, float(-bound)
                cells.append(cell)
                held += int(self.rows[cell])
            passed += 1
            if j + 1 < len(b):
                heapq.heappush(heap, (-(first[i] + second[j + 1]), i, j + 1))
            if j == 0 and i + 1 < len(a):
                heapq.heappush(heap, (-(first[i + 1] + second[0]), i + 1, 0))
        return cells, passed, None


def _vectors(lists: pa.Array) -> np.ndarray:
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole-number rows, exact."""
    largest = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if largest < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T
    if max(abs(int(exact.max())), abs(int(exact.min()))) >= 2**56:
        raise OverflowError("a score is beyond 2^56")
    return exact.astype(np.int64)


def first_rows(scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, wanted: int) -> np.ndarray:
    """Places of the ``wanted`` best: by falling score, then by id and row."""
    places = np.arange(len(scores))
    if len(scores) > wanted:
        places = np.flatnonzero(scores >= np.partition(scores, len(scores) - wanted)[len(scores) - wanted])
    return places[np.lexsort((rows[places], ids[places], -scores[places]))[:wanted]]


def build(rows: DataFrame, space: Workspace, cell_rows: int = CELL_ROWS) -> tuple[Index, DataFrame] | None:
    """The index over all ``rows`` (a scan with ``row``, ``vec_id``, ``label``, ``x``) and its blocks; None
    without rows."""
    known = rows.agg(F.count(F.lit(1)).alias("n"), F.min(F.size("x")).alias("a"), F.max(F.size("x")).alias("b")).first()
    if not known.n:
        return None
    if known.a != known.b:
        raise ValueError(f"vectors of {known.a} and of {known.b} entries")
    chosen = rows.orderBy(F.xxhash64("row"), "row").limit(SAMPLE_ROWS).select("x").toArrow()
    sample = _vectors(chosen.column("x")).astype(np.float64)
    size = min(CODEWORDS, max(1, int(np.ceil(np.sqrt(known.n / cell_rows)))))
    cut = (known.b + 1) // 2
    books = (codebook(sample[:, :cut], size), codebook(sample[:, cut:], size))
    width = len(books[1])
    start = Index(books, (np.zeros(len(books[0])), np.zeros(width)), np.zeros(len(books[0]) * width, np.int64))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                cell, near, far = start.cells(_vectors(batch.column("x")).astype(np.float64))
                for name, values in (("cell", cell), ("near", near), ("far", far)):
                    batch = batch.append_column(name, pa.array(values))
                yield batch

    schema = "row bigint, vec_id bigint, label int, x array<bigint>, cell bigint, near double, far double"
    placed = space.write(rows.select("row", "vec_id", "label", "x").mapInArrow(assign, schema), "cells")
    cells = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("near").alias("near"), F.max("far").alias("far"))
    counts, radii = start.rows, start.radii
    for cell, n, near, far in cells.collect():  # at most the square of the codebook
        counts[cell] = n
        radii[0][cell // width] = max(radii[0][cell // width], near)
        radii[1][cell % width] = max(radii[1][cell % width], far)
    pieces = F.ceil(F.col("n") / F.lit(BLOCK_ROWS)).cast("bigint")
    # the cells, at most the square of the codebook
    dealt = placed.join(F.broadcast(cells.select("cell", pieces.alias("pieces"))), "cell")
    blocks = (
        dealt.withColumn("piece", F.pmod(F.xxhash64("row"), "pieces"))
        .groupBy("cell", "piece")
        .agg(F.collect_list(F.struct("row", "vec_id", "label", "x")).alias("members"))
    )
    return Index(books, radii, counts), space.write(blocks, "blocks")


def search(
    index: Index, blocks: DataFrame, anchors: DataFrame, space: Workspace, same: bool, wanted: int,
    first_wave: int = FIRST_ROWS,
) -> DataFrame:
    """The first ``wanted`` rows of every window of every anchor: ``anchor`` (its row), ``k`` (the window),
    ``row``, ``vec_id``, ``score`` and ``place``, from 1.

    ``anchors`` has ``row``, ``label``, ``x`` and ``windows``, each with ``k``, ``low`` and ``high``: 100 times the score
    must lie between them. ``same`` searches among rows of the anchor's label, else among the others.
    """
    spark = blocks.sparkSession
    groups = anchors.count() // GROUP_ANCHORS + 1
    active = anchors.select("row", "label", "x", "windows", F.lit(0).cast("bigint").alias("passed"))
    best = spark.createDataFrame([], HIT)
    ranked = Window.partitionBy("anchor", "k").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    wave, budget = 0, first_wave

    while True:
        rows_now = budget

        def visit(batches: Iterator[pa.RecordBatch], rows_now: int = rows_now) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if len(batch):
                    x = _vectors(batch.column("x")).astype(np.float64)
                    found = [index.visits(one, skip, rows_now) for one, skip in zip(x, batch.column("passed").to_pylist(), strict=True)]
                    batch = batch.drop_columns(["passed"])
                    for name, kind, values in (
                        ("passed", pa.int64(), [f[1] for f in found]),
                        ("cells", pa.list_(pa.int64()), [f[0] for f in found]),
                        ("next_bound", pa.float64(), [f[2] for f in found]),
                    ):
                        batch = batch.append_column(name, pa.array(values, kind))
                    yield batch

        window = "array<struct<k:int,low:bigint,high:bigint>>"
        schema = f"row bigint, label int, x array<bigint>, windows {window}, passed bigint, cells array<bigint>, next_bound double"
        plan = space.write(active.mapInArrow(visit, schema), f"visits-{wave}")
        if wave and plan.isEmpty():
            break
        asked = plan.select("row", "label", "x", "windows", F.explode("cells").alias("cell"))
        visitors = (
            asked.join(blocks.select("cell", "piece").hint("shuffle_hash"), "cell")
            .groupBy("cell", "piece", F.pmod(F.xxhash64("row"), F.lit(groups)).alias("group"))
            .agg(F.collect_list(F.struct("row", "label", "x", "windows")).alias("visitors"))
        )
        met = visitors.join(blocks.hint("merge"), ["cell", "piece"]).select("visitors", "members")
        hits = met.mapInArrow(_scored(same, wanted), HIT)
        merged = hits.unionByName(best).withColumn("place", F.row_number().over(ranked)).filter(F.col("place") <= wanted)
        best = space.write(merged.drop("place"), f"best-{wave}")
        last = best.groupBy("anchor", "k").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("last"))
        # where enough rows are found, only such as reach the last of them are still wanted
        full = F.coalesce(F.col("n") >= wanted, F.lit(False))
        raised = F.when(full, F.greatest("low", F.col("last") * 100)).otherwise(F.col("low"))
        open_windows = (
            plan.filter(F.col("next_bound").isNotNull())
            .select("row", "next_bound", F.inline("windows"))
            .join(last.withColumnRenamed("anchor", "row"), ["row", "k"], "left")
            .withColumn("low", raised)
            .filter(F.lit(100.0) * F.col("next_bound") >= F.col("low"))
            .groupBy("row")
            .agg(F.collect_list(F.struct("k", "low", "high")).alias("windows"))
        )
        active = plan.select("row", "label", "x", "passed").join(open_windows.hint("merge"), "row")
        active = active.select("row", "label", "x", "windows", "passed")
        wave, budget = wave + 1, budget * GROWTH
    return best.withColumn("place", F.row_number().over(ranked))


def _scored(same: bool, wanted: int):
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for visitors, members in zip(batch.column("visitors"), batch.column("members"), strict=True):
                asking, offered = visitors.values, members.values
                rows = offered.field("row").to_numpy()
                labels = offered.field("label").to_numpy()
                ids = offered.field("vec_id").fill_null(np.iinfo(np.int64).max).to_numpy()
                scores = products(_vectors(asking.field("x")), _vectors(offered.field("x")))
                anchors, own = asking.field("row").to_numpy(), asking.field("label").to_numpy()
                hits = []
                for i, windows in enumerate(asking.field("windows").to_pylist()):
                    usable = (labels == own[i]) & (rows != anchors[i]) if same else labels != own[i]
                    places = np.flatnonzero(usable)
                    found = scores[i, places]
                    for w in windows:
                        inside = places[(100 * found >= w["low"]) & (100 * found <= w["high"])]
                        top = inside[first_rows(scores[i, inside], ids[inside], rows[inside], wanted)]
                        hits.append((np.full(len(top), anchors[i]), np.full(len(top), w["k"]), top, scores[i, top]))
                anchor, k, top, score = (np.concatenate(part).astype(np.int64) for part in zip(*hits, strict=True))
                yield pa.record_batch({
                    "anchor": pa.array(anchor),
                    "k": pa.array(k.astype(np.int32)),
                    "row": pa.array(rows[top]),
                    "vec_id": offered.field("vec_id").take(pa.array(top)),
                    "score": pa.array(score),
                })

    return scored


def mine(
    vectors: DataFrame,
    space: Workspace,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    cell_rows: int = CELL_ROWS,
    first_wave: int = FIRST_ROWS,
) -> DataFrame:
    """For the anchors among ``vectors`` (``vec_id`` long, ``label`` int, ``x`` array of longs) and each of their
    first ``positives``: the first ``negatives`` whose score is between ``low`` and ``high`` percent of the positive's."""
    usable = F.col("label").isNotNull() & (F.size("x") > 0) & F.forall("x", lambda c: c.isNotNull())
    marked = vectors.select("vec_id", "label", "x", F.coalesce(is_anchor, F.lit(False)).alias("asks")).filter(usable)
    rows = space.write(marked.withColumn("row", F.monotonically_increasing_id()), "vectors")
    empty = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    built = build(rows, space, cell_rows)
    if built is None:
        return rows.sparkSession.createDataFrame([], empty)
    index, blocks = built
    anchors = rows.filter("asks")
    everything = F.struct(
        F.lit(0).alias("k"), F.lit(-(2**63)).cast("bigint").alias("low"), F.lit(2**63 - 1).cast("bigint").alias("high")
    )
    near = search(
        index, blocks, anchors.withColumn("windows", F.array(everything)), space, True, positives, first_wave
    )
    near = space.write(
        near.select("anchor", "place", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")),
        "positives",
    )
    # a positive with a score below 0 has no score between its shares
    windows = near.filter("positive_score >= 0").groupBy("anchor").agg(
        F.collect_list(
            F.struct(
                F.col("place").alias("k"),
                (F.col("positive_score") * low).alias("low"),
                (F.col("positive_score") * high).alias("high"),
            )
        ).alias("windows")
    )
    asking = anchors.join(windows.withColumnRenamed("anchor", "row").hint("merge"), "row")
    far = search(index, blocks, asking, space, False, negatives, first_wave)
    far = far.select(
        "anchor", F.col("k").alias("place"), F.col("place").alias("rank"), F.col("vec_id").alias("negative_id"),
        F.col("score").alias("negative_score"),
    )
    named = anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    found = far.join(near.hint("merge"), ["anchor", "place"]).join(named.hint("merge"), "anchor")
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
