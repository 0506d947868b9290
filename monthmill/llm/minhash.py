"""Near-duplicate documents by SetSketch registers, bands and exact verification.

A document's set are its distinct five-word shingles (64-bit hashes; words are split at ASCII
white space, A-Z lower-cased; a document with fewer words has its whole sequence as the only
shingle). Its sketch has ``REGISTERS`` registers: the smallest hash of the set under each of so many
hash functions, as an exponential value, truncated to its place on an exponential scale of base
``BASE``. Registers of a union are the maxima of registers, so sketches are mergeable.

1. Documents with equal sets are one class, counted on the map side first.
2. Bands of ``ROWS`` registers are keys; classes that share a key are candidates. Each class is
   paired with the smallest class of its key only (a star, not all pairs).
3. A pair must have sizes that allow the threshold; then the similarity is estimated by maximum
   likelihood from both register sets and sizes, with a margin of ``MARGIN`` standard deviations;
   what passes is verified on the full sets.
4. Keys whose classes are not all connected by then are compared once more, in parts of bounded
   size: of each pair of parts only the pairs between different components matter. They are
   estimated and verified inside the task, and only links that connect components leave it.

A pair at the threshold misses all bands with a probability below 1e-8 (0.85) or 4e-6 (0.8), and the estimate
with 4e-6; every link that is reported is exact.

Scale: sketches are a few hundred bytes per document; texts are only shuffled for candidates.
Keys with very many classes are split over tasks by pairs of parts.

Edge cases: null, empty and blank texts have an empty set, link with nothing and are kept;
repeated rows are documents of their own with equal sets, so they form a group named by their
doc_id; a null doc_id never names a group that has another; an empty table gives an empty result; other columns are
ignored, or carried along where documents are filtered.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import cache
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthmill.llm.common import spread_lookup, with_plain_names
from monthmill.llm.components import components
from monthmill.workspace import Workspace

WORDS = 5
BANDS = 32
ROWS = 5
REGISTERS = BANDS * ROWS
BASE = 1.01
MARGIN = 4.5
#: Registers stay within 16 bits: hashes are 32-bit numbers.
TOP = 4000
REMEMBERED = 400_000
PART = 1000
KEPT_BYTES = 64_000_000


class Known(dict):
    """Hashes of words, computed when first asked for."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


@cache
def known() -> list[Known]:
    """The word hashes of this worker, in a list so that they can be replaced."""
    return [Known()]


@cache
def functions() -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(20)
    odd = random.integers(0, 2**31, REGISTERS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    return odd[:, None], random.integers(0, 2**32, REGISTERS, dtype=np.uint32)[:, None]


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (a bijection)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def shingle_set(text: str | None) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    store = known()
    if len(store[0]) > REMEMBERED:  # what came first is what comes often
        store[0] = Known(islice(store[0].items(), REMEMBERED // 2))
    hashes = np.fromiter(map(store[0].__getitem__, words), np.uint64, len(words))
    width = min(WORDS, len(words))
    value = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        value = value * np.uint64(0x9E3779B97F4A7C15) + hashes[k : len(hashes) - width + 1 + k]
    return np.unique(mixed(value))


def registers(found: np.ndarray) -> np.ndarray:
    """The sketch of a set that is not empty."""
    factor, shift = functions()
    values = (found >> np.uint64(32)).astype(np.uint32)
    least = np.full(REGISTERS, 2**32 - 1, np.uint32)
    for start in range(0, len(values), 1024):
        block = factor * values[start : start + 1024][None, :] + shift
        np.minimum(least, block.min(axis=1), out=least)
    exponential = -np.log1p(-(least.astype(np.float64) + 0.5) / 2**32)
    scale = np.floor(1 - np.log(exponential) / math.log(BASE)) + 400
    return np.clip(scale, 0, TOP).astype("<u2")


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of a union from the sketches of its parts."""
    return np.maximum(a, b)


def estimate(sketches_a: np.ndarray, sketches_b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood similarity of pairs from their registers and set sizes."""
    larger = (sketches_a > sketches_b).sum(axis=1)[:, None]
    smaller = (sketches_a < sketches_b).sum(axis=1)[:, None]
    equal = sketches_a.shape[1] - larger - smaller
    u = (n_a / (n_a + n_b))[:, None]
    v = 1 - u
    most = np.minimum(u / v, v / u)
    grid = np.linspace(0, 1, 101)[None, :] * most

    def chance(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / math.log(BASE)

    up, down = chance(u - v * grid), chance(v - u * grid)
    tiny = 1e-12
    likelihood = (
        larger * np.log(np.maximum(up, tiny)) + smaller * np.log(np.maximum(down, tiny))
        + equal * np.log(np.maximum(1 - up - down, tiny))
    )
    return np.take_along_axis(grid, likelihood.argmax(axis=1)[:, None], axis=1)[:, 0]


def possible(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, percent: int) -> np.ndarray:
    """Whether pairs may reach the threshold: by size exactly, by estimate with the margin."""
    keep = 100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b)
    threshold = percent / 100
    margin = MARGIN * math.sqrt(threshold * (1 - threshold) / REGISTERS)
    rows = np.flatnonzero(keep)
    for start in range(0, len(rows), 4096):
        part = rows[start : start + 4096]
        keep[part] = estimate(a[part], b[part], n_a[part], n_b[part]) >= threshold - margin
    return keep


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Exactly: 100 * |A and B| >= percent * |A or B| for sorted distinct sets."""
    if not len(a) or not len(b):
        return False
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    both = int((b[at] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


SKETCH = "doc_id bigint, mark bigint, n_shingles bigint, digest binary, registers binary"


def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, digests, sketches = [], [], []
        for text in batch.column("text"):
            found = shingle_set(text.as_py())
            sizes.append(len(found))
            digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
            sketches.append(registers(found).tobytes() if len(found) else None)
        yield pa.record_batch({
            "doc_id": batch.column("doc_id"), "mark": batch.column("mark"), "n_shingles": pa.array(sizes, pa.int64()),
            "digest": pa.array(digests, pa.binary()), "registers": pa.array(sketches, pa.binary()),
        })


def marked(docs: DataFrame) -> DataFrame:
    """Documents with a hash of id and text: rows equal in both are the same document twice."""
    return docs.withColumn("mark", F.xxhash64("doc_id", "text", F.col("doc_id").isNull(), F.col("text").isNull()))


def band_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per class and band: the band's number and a hash of its registers."""
    for batch in batches:
        n = batch.num_rows
        sketches = stacked(batch.column("registers"))
        rows = sketches.reshape(n, BANDS, ROWS).astype(np.uint64)
        value = np.zeros((n, BANDS), np.uint64)
        for k in range(ROWS):
            value = mixed(value * np.uint64(0x9E3779B97F4A7C15) + rows[:, :, k] + np.uint64(1))
        yield pa.record_batch({
            "band": pa.array(np.tile(np.arange(BANDS, dtype=np.int32), n)),
            "value": pa.array(value.ravel().view(np.int64)),
            "key": pa.array(np.repeat(batch.column("key").to_numpy(), BANDS)),
        })


def stacked(column) -> np.ndarray:
    values = column.to_pylist() if isinstance(column, pa.Array) else list(column)
    return np.frombuffer(b"".join(values), "<u2").reshape(len(values), REGISTERS)


def candidate_texts(keys: DataFrame, classes: DataFrame, docs: DataFrame, space: Workspace) -> DataFrame:
    """The text of one document of each class in ``keys``."""
    wanted = keys.join(classes.select("key", "mark"), "key")
    # one row per class even if its document is there twice; rows of one mark are equal
    texts = marked(docs.select("doc_id", "text")).select("mark", "text")
    texts = texts.mapInArrow(first_of_mark, texts.schema)
    found = texts.join(wanted, "mark").select("key", "text").repartition("key")
    return space.write(found.mapInArrow(first_of_key, "key bigint, text string"), "minhash-texts")


def linked_pairs(pairs: DataFrame, classes: DataFrame, texts: DataFrame, space: Workspace, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``) of class keys that are similar, verified on the full sets."""
    facts = classes.select("key", "n_shingles", "registers")
    both = pairs.join(facts.select(F.col("key").alias("a"), F.col("n_shingles").alias("n_a"),
                                   F.col("registers").alias("r_a")), "a")
    both = both.join(facts.select(F.col("key").alias("b"), F.col("n_shingles").alias("n_b"),
                                  F.col("registers").alias("r_b")), "b")

    def estimated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keep = possible(stacked(batch.column("r_a")), stacked(batch.column("r_b")),
                                batch.column("n_a").to_numpy().astype(float),
                                batch.column("n_b").to_numpy().astype(float), percent)
                yield batch.select(["a", "b"]).filter(pa.array(keep))

    good = space.write(both.mapInArrow(estimated, "a bigint, b bigint"), "minhash-pairs")
    ready = good.join(texts.select(F.col("key").alias("b"), F.col("text").alias("text_b")), "b")
    ready = ready.join(texts.select(F.col("key").alias("a"), F.col("text").alias("text_a")), "a")

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, center = None, np.empty(0, np.uint64)
        for batch in batches:
            keep = []
            for a, text_a, text_b in zip(batch.column("a").to_pylist(), batch.column("text_a"),
                                         batch.column("text_b"), strict=True):
                if a != last:  # a join brings the pairs of one class together
                    last, center = a, shingle_set(text_a.as_py())
                keep.append(similar(center, shingle_set(text_b.as_py()), percent))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    out = space.write(ready.select("a", "b", "text_a", "text_b").mapInArrow(verified, "a bigint, b bigint"), "minhash-links")
    space.drop(good)
    return out


def first_of(name: str):
    """Rows whose ``name`` was not seen before in the task; keeps 64-bit values only."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            keep = []
            for value in batch.column(name).to_pylist():
                keep.append(value not in seen)
                seen.add(value)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return first


first_of_mark = first_of("mark")
first_of_key = first_of("key")


GROUP = ("band", "value", "l", "r")


class Sets:
    """Shingle sets of a group's texts, made when needed and kept up to a bound."""

    def __init__(self, texts: list) -> None:
        self.texts, self.made, self.size = texts, {}, 0

    def __getitem__(self, i: int) -> np.ndarray:
        if i not in self.made:
            if self.size > KEPT_BYTES:
                self.made, self.size = {}, 0
            self.made[i] = shingle_set(self.texts[i].as_py())
            self.size += self.made[i].nbytes
        return self.made[i]


def group_links(rows: pa.Table, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between different components in one task's group."""
    band, l, r = (rows.column(name)[0].as_py() for name in ("band", "l", "r"))
    keys = rows.column("key").to_numpy()
    order = np.argsort(keys, kind="stable")
    order = order[np.concatenate([[True], keys[order][1:] != keys[order][:-1]])]
    rows = rows.take(pa.array(order))
    keys, own = rows.column("key").to_numpy(), rows.column("own").to_numpy()
    sizes = rows.column("n_shingles").to_numpy().astype(float)
    sketches = stacked(rows.column("registers").combine_chunks())
    sets = Sets(rows.column("text"))
    group = np.unique(rows.column("component").to_numpy(), return_inverse=True)[1]
    links = []
    for i in range(len(keys) - 1):
        j = np.arange(i + 1, len(keys))
        j = j[(group[j] != group[i]) & ((l == r) | (own[j] != own[i]))]
        if not len(j):
            continue
        a = np.broadcast_to(sketches[i], (len(j), REGISTERS))
        equal = (a == sketches[j]).reshape(len(j), BANDS, ROWS).all(axis=2)
        first = equal.argmax(axis=1) == band  # a pair is judged in its first shared band
        j, a = j[first], a[first]
        keep = possible(a, sketches[j], np.full(len(j), sizes[i]), sizes[j], percent)
        for k in j[keep].tolist():
            if group[k] != group[i] and similar(sets[i], sets[k], percent):
                links.append((int(keys[i]), int(keys[k])))
                group[group == group[k]] = group[i]
    return links


def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows in the order of their groups, one table per group."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        parts = [batch.column(name).to_numpy() for name in GROUP]
        fresh = np.zeros(batch.num_rows, bool)
        for part in parts:
            fresh[1:] |= part[1:] != part[:-1]
        first = tuple(part[0] for part in parts)
        if held and first != last:
            yield pa.Table.from_batches(held)
            held = []
        bounds = [0, *np.flatnonzero(fresh).tolist(), batch.num_rows]
        for begin, end in zip(bounds, bounds[1:], strict=False):
            held.append(batch.slice(begin, end - begin))
            if end < batch.num_rows:
                yield pa.Table.from_batches(held)
                held = []
        last = tuple(part[-1] for part in parts)
    if held:
        yield pa.Table.from_batches(held)


def remaining_links(
    bands: DataFrame, classes: DataFrame, texts: DataFrame, star: DataFrame, space: Workspace, percent: int
) -> DataFrame:
    """Links between different components that keys not connected yet still hold."""
    placed = classes.select("key", "n_shingles", "registers").join(
        star.withColumnRenamed("node", "key"), "key", "left"
    ).withColumn("component", F.coalesce("component", "key"))
    member = bands.join(placed.select("key", "component"), "key")
    split = member.groupBy("band", "value").agg(
        F.count(F.lit(1)).alias("members"), F.min("component").alias("low"), F.max("component").alias("high"),
    ).filter("low < high")
    split = space.write(split.select("band", "value", "members").withColumn(
        "parts", F.ceil(F.col("members") / PART).cast("int")), "minhash-split")
    member = spread_lookup(bands, split, ["band", "value"], "members", bands.count()).filter("parts is not null")
    turn = F.pmod(F.xxhash64("key"), F.col("parts")).cast("int")
    numbers = F.sequence(F.lit(0), F.col("parts") - 1)
    # every pair of parts is a task's group: part l against part r, l <= r
    spread = member.select("band", "value", "key", turn.alias("own"), F.explode(numbers).alias("other")).select(
        "band", "value", F.least("own", "other").alias("l"), F.greatest("own", "other").alias("r"), "own", "key")
    ready = spread.join(placed, "key").join(texts, "key")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches):
            found = group_links(rows, percent)
            if found:
                yield pa.record_batch([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    ordered = ready.repartition(*GROUP).sortWithinPartitions(*GROUP)
    return space.write(ordered.mapInArrow(compared, "a bigint, b bigint"), "minhash-more-links")


def grouped(docs: DataFrame, space: Workspace, percent: int) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with ``mark``, ``n_shingles``, ``component_id`` and
    ``keeper``, the mark of the document that stands for its group (null for empty sets)."""
    rows = space.write(marked(docs.select("doc_id", "text")).mapInArrow(sketched, SKETCH), "minhash-sketches")
    classes = rows.filter("digest is not null").groupBy("digest").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")).alias("rep"),
        F.count(F.lit(1)).alias("amount"), F.first("n_shingles").alias("n_shingles"),
        F.first("registers").alias("registers"),
    )
    classes = space.write(classes.select(
        F.monotonically_increasing_id().alias("key"), "digest", "rep.doc_id", "rep.mark",
        "amount", "n_shingles", "registers"), "minhash-classes")
    bands = classes.select("key", "registers").mapInArrow(band_keys, "band int, value bigint, key bigint")
    centers = bands.groupBy("band", "value").agg(F.min("key").alias("a"), F.count(F.lit(1)).alias("members"))
    centers = space.write(centers.filter("members > 1"), "minhash-centers")
    total = BANDS * classes.count()
    shared = spread_lookup(bands, centers, ["band", "value"], "members", total).filter("a is not null")
    shared = space.write(shared.select("band", "value", "key", "a"), "minhash-bands")
    pairs = shared.filter("key != a").select("a", F.col("key").alias("b")).distinct()
    texts = candidate_texts(shared.select("key").distinct(), classes, docs, space)
    links = linked_pairs(pairs, classes, texts, space, percent)
    star = components(links, space)
    more = remaining_links(shared.drop("a"), classes, texts, star, space, percent)
    if more.limit(1).count():
        star = components(links.unionByName(more), space)
    space.drop(texts)
    placed = classes.join(star.withColumnRenamed("node", "key"), "key", "left").withColumn(
        "component", F.coalesce("component", "key"))
    best = placed.groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")).alias("best"))
    table = space.write(placed.join(best, "component").select(
        "digest", "amount", F.col("best.doc_id").alias("component_id"), F.col("best.mark").alias("keeper")), "minhash-result")
    full = rows.filter("digest is not null")
    found = spread_lookup(full.drop("registers"), table, ["digest"], "amount", full.count())
    empty = rows.filter("digest is null").select(
        "doc_id", "mark", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(None).cast("bigint").alias("keeper"))
    return found.select("doc_id", "mark", "n_shingles", "component_id", "keeper").unionByName(empty)


def near_duplicates(docs: DataFrame, space: Workspace, percent: int) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` for every document."""
    return grouped(docs, space, percent).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def one_of_each(docs: DataFrame, space: Workspace, percent: int = 80) -> DataFrame:
    """The documents that stand for their group, and those with empty sets, once each and with
    all their columns, whatever the names of those."""
    return with_plain_names(docs, ("doc_id", "text"), lambda plain: _one_of_each(plain, space, percent))


def _one_of_each(docs: DataFrame, space: Workspace, percent: int) -> DataFrame:
    found = grouped(docs, space, percent)
    keep = found.filter("keeper is null or keeper = mark").select(F.col("mark").alias("_s_mark")).distinct()
    keep = space.write(keep, "minhash-kept")
    rows = docs.withColumn("_s_mark", F.xxhash64(
        "doc_id", "text", F.col("doc_id").isNull(), F.col("text").isNull()))
    # a document that is there many times leaves a task once; the rest meet after the shuffle
    rows = rows.mapInArrow(first_of("_s_mark"), rows.schema).repartition("_s_mark")
    kept = rows.join(keep, "_s_mark", "left_semi").select(rows.columns)
    return kept.mapInArrow(first_of("_s_mark"), rows.schema).drop("_s_mark")
