"""Best-fit packing of documents into sequences by a grouping genetic algorithm.

``pieces`` cuts every document's ids (with the end id behind them) into pieces of at most
``capacity`` tokens. ``pack`` gives every piece a sequence and an offset in it.

Pieces of the full capacity are sequences of their own. The others are dealt by a hash into
blocks of about ``BLOCK_PIECES``; as only lengths matter, a block is described by how many pieces
of each length it has, which is at most ``capacity`` numbers. Every block is packed by a grouping
genetic algorithm on several islands, one task each: an individual is a set of bins; crossover
injects whole well-filled bins of one parent into the other, removes the bins that hold the same
pieces a second time, and places the displaced pieces best-fit, the longest first. After each
epoch the islands write their best individual to a shared table and receive that of their
neighbour in a ring. Islands start from best fit in random orders and stop when they meet a lower
bound for the number of bins; best fit over the longest pieces first joins only where they miss it. The best
island gives the block's bins, whose slots are matched to pieces by length and rank.

Scale: pieces of a block are bounded, so no task grows with the data, whatever lengths are
frequent; a block wastes less than one sequence against a packing of all. Rows are only shuffled as narrow pieces, never with their texts.

Edge cases: a null or empty text is the end id alone (length 1); repeated rows are documents of
their own; ties in length are broken by document, piece and checksum and do not matter for the
packing; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from random import Random

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthmill.llm.wordtable import encode
from monthmill.workspace import Workspace

CAPACITY = 2048
END_ID = 0
BLOCK_PIECES = 20_000
ISLANDS = 2
EPOCHS = 2
GENERATIONS = 4
POPULATION = 4
#: Bins filled at least to this share may be injected whole.
WELL_FILLED = 0.98

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def pieces(
    docs: DataFrame,
    path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    space: Workspace | None = None,
) -> DataFrame:
    """The pieces of every document: where they start, their length and a checksum of their ids."""
    end = np.asarray([end_id], dtype="<u4").tobytes()

    def cut(block: pa.Table) -> pa.Table:
        out: list[tuple] = []
        for key, ids in zip(block.column("key").to_pylist(), block.column("ids").to_pylist(), strict=True):
            ids += end
            for number, at in enumerate(range(0, len(ids), 4 * capacity)):
                part = ids[at : at + 4 * capacity]
                out.append((key, number, at // 4, len(part) // 4, zlib.crc32(part)))
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        columns = list(zip(*out, strict=True)) if out else [[]] * len(names)
        return pa.table(
            [pa.array(values, kind) for values, kind in zip(columns, types, strict=True)], names=names
        )

    space = space or Workspace(docs.sparkSession, "pieces")
    return encode(docs, path, space, finish=cut, schema=PIECES)


def place(
    bins: list[list[int]], loose: list[int], lengths: list[int], capacity: int, longest_first: bool = True
) -> list[list[int]]:
    """Best fit: each loose piece, the longest first, into the fullest bin that still takes it.

    Bins are filed by their free room; the rooms in use are the set bits of one number, so the
    smallest sufficient room is its lowest set bit from the piece's length on."""
    filed: list[list[int]] = [[] for _ in range(capacity + 1)]
    used = 0
    for number, content in enumerate(bins):
        room = capacity - sum([lengths[i] for i in content])
        filed[room].append(number)
        used |= 1 << room
    for i in sorted(loose, key=lengths.__getitem__, reverse=True) if longest_first else loose:
        length = lengths[i]
        fitting = used >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            number = filed[room].pop()
            if not filed[room]:
                used ^= 1 << room
            bins[number].append(i)
        else:
            room, number = capacity, len(bins)
            bins.append([i])
        filed[room - length].append(number)
        used |= 1 << (room - length)
    return bins


def fitness(bins: list[list[int]], lengths: list[int], capacity: int) -> tuple[int, float]:
    """Fewer bins first, then fuller ones: larger is better."""
    full = sum([(sum([lengths[i] for i in content]) / capacity) ** 2 for content in bins])
    return -len(bins), full / max(1, len(bins))


def crossover(
    host: list[list[int]], donor: list[list[int]], lengths: list[int], capacity: int, random: Random
) -> list[list[int]]:
    """``host`` with some well-filled bins of ``donor`` injected whole."""
    good = [content for content in donor if sum([lengths[i] for i in content]) >= WELL_FILLED * capacity]
    wanted = random.sample(good, max(1, len(good) // 3)) if good else []
    injected = {i for content in wanted for i in content}
    kept, loose = [], []
    poor = random.uniform(0.0, 0.9) * capacity
    for content in host:
        doubled = [i for i in content if i in injected]
        if doubled:
            loose += [i for i in content if i not in injected]
        elif sum([lengths[i] for i in content]) < poor:
            loose += content  # mutation: badly filled bins are opened
        else:
            kept.append(list(content))
    return place(kept + [list(content) for content in wanted], loose, lengths, capacity)


def lower_bound(lengths: list[int], capacity: int) -> int:
    """No packing needs fewer bins (the bound of Martello and Toth over all thresholds)."""
    values = np.sort(np.asarray(lengths, dtype=np.int64))
    total = np.concatenate([[0], np.cumsum(values)])
    best = -(-int(total[-1]) // capacity)
    half = int(np.searchsorted(values, capacity // 2, side="right"))
    for k in np.unique(values[:half]).tolist():
        above = int(np.searchsorted(values, capacity - k, side="right"))
        first = int(np.searchsorted(values, k, side="left"))
        large, middle = len(values) - above, above - half
        room = middle * capacity - int(total[above] - total[half])
        rest = max(0, int(total[half] - total[first]) - room)
        best = max(best, large + middle + -(-rest // capacity))
    large = len(values) - half
    return max(best, large)


def evolve(
    lengths: list[int],
    migrants: list[list[list[int]]],
    seed: int,
    capacity: int = CAPACITY,
    population: int = POPULATION,
    generations: int = GENERATIONS,
) -> list[list[int]]:
    """The best set of bins that one island finds in one epoch.

    The first parents are migrants, or else best fit over pieces in a random order. Only where
    their descendants miss the lower bound does best fit over the longest pieces join them, and
    another round of generations follows."""
    random = Random(seed)
    order = list(range(len(lengths)))
    goal = lower_bound(lengths, capacity)
    people = [[list(content) for content in bins] for bins in migrants]

    def score(bins: list[list[int]]) -> tuple[int, float]:
        return fitness(bins, lengths, capacity)

    while len(people) < population and not (people and len(people[0]) <= goal):
        people.append(place([], random.sample(order, len(order)), lengths, capacity, longest_first=False))
    for late in (None, order):
        if late and len(people[0]) > goal:
            people.append(place([], late, lengths, capacity))
        people.sort(key=score, reverse=True)
        for _ in range(generations):
            if len(people[0]) <= goal:
                break
            children = []
            for _ in range(len(people)):
                host, donor = random.sample(people, 2) if len(people) > 1 else (people[0], people[0])
                children.append(crossover(host, donor, lengths, capacity, random))
            people = sorted(people + children, key=score, reverse=True)[:population]
    return people[0]


def encoded(bins: list[list[int]]) -> tuple[bytes, bytes]:
    """Members of all bins one after the other, and where bins end."""
    members = np.asarray([i for content in bins for i in content], dtype="<u4")
    ends = np.cumsum([len(content) for content in bins], dtype=np.int64).astype("<u4")
    return members.tobytes(), ends.tobytes()


def decoded(members: bytes, ends: bytes) -> list[list[int]]:
    flat = np.frombuffer(members, "<u4").tolist()
    bounds = [0, *np.frombuffer(ends, "<u4").tolist()]
    return [flat[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]


def block_lengths(histogram: pd.DataFrame) -> list[int]:
    """The lengths of a block's pieces, the longest first."""
    rows = histogram.sort_values("length", ascending=False)
    return np.repeat(rows["length"].to_numpy(), rows["amount"].to_numpy()).tolist()


ELITE = "block bigint, island int, bins int, score double, members binary, ends binary"
SLOT = "block bigint, length bigint, place bigint, bin bigint, offset bigint"


def block_hash(turn: Column) -> Column:
    """Deals pieces over blocks. Repeated rows differ by their position ``turn`` in the table."""
    return F.xxhash64("doc_id", "piece", "start", "ids_crc32", turn)


def pack(parts: DataFrame, space: Workspace, capacity: int = CAPACITY, block_pieces: int = BLOCK_PIECES,
         islands: int = ISLANDS, epochs: int = EPOCHS) -> DataFrame:
    """``parts`` (a scan of pieces) with ``sequence_id`` and ``offset``."""
    blocks = parts.count() // block_pieces + 1
    key = block_hash(F.monotonically_increasing_id())
    dealt = space.write(
        parts.withColumn("_p_block", F.when(F.col("length") < capacity, F.pmod(key, F.lit(blocks)))),
        "pack-dealt",
    )
    open_parts = dealt.filter(F.col("_p_block").isNotNull())
    histogram = space.write(
        open_parts.groupBy(F.col("_p_block").alias("block"), "length").agg(F.count(F.lit(1)).alias("amount")),
        "pack-histogram",
    )
    numbers = F.explode(F.array(*[F.lit(k) for k in range(islands)]))
    homes = histogram.withColumn("island", numbers)

    def island_of(epoch: int):
        def island(keys, instance: pd.DataFrame, migrants: pd.DataFrame) -> pd.DataFrame:
            lengths = block_lengths(instance)
            found = [decoded(m, e) for m, e in zip(migrants["members"], migrants["ends"], strict=True)]
            seed = (int(keys[0]) * islands + int(keys[1])) * epochs + epoch
            bins = evolve(lengths, found, seed, capacity)
            score = fitness(bins, lengths, capacity)
            row = (keys[0], keys[1], len(bins), score[1], *encoded(bins))
            return pd.DataFrame([row], columns=["block", "island", "bins", "score", "members", "ends"])

        return island

    elites = parts.sparkSession.createDataFrame([], ELITE)
    for epoch in range(epochs):
        # the elite stays on its island and also goes to the next one in the ring
        ring = elites.unionByName(elites.withColumn("island", (F.col("island") + 1) % islands))
        work = homes.groupBy("block", "island").cogroup(ring.groupBy("block", "island"))
        found = space.write(work.applyInPandas(island_of(epoch), ELITE), f"pack-epoch-{epoch}")
        if epoch:
            space.drop(elites)
        elites = found

    best = elites.groupBy("block").agg(
        F.min_by(F.struct("members", "ends"), F.struct("bins", -F.col("score"), "island")).alias("best")
    ).select("block", "best.members", "best.ends")

    def slots(keys, instance: pd.DataFrame, winner: pd.DataFrame) -> pd.DataFrame:
        lengths = np.asarray(block_lengths(instance), dtype=np.int64)
        members = np.frombuffer(winner["members"].iloc[0], "<u4").astype(np.int64)
        ends = np.frombuffer(winner["ends"].iloc[0], "<u4").astype(np.int64)
        sizes = np.diff(np.concatenate([[0], ends]))
        bins = np.repeat(np.arange(len(ends)), sizes)
        taken = lengths[members]
        before = np.cumsum(taken) - taken
        offsets = before - np.repeat(before[ends - sizes], sizes)
        # the rank of a piece among those of its length, in the order of the block's list
        firsts = len(lengths) - np.searchsorted(lengths[::-1], taken, side="right")
        return pd.DataFrame({"block": keys[0], "length": taken, "place": members - firsts + 1,
                             "bin": bins, "offset": offsets})

    filled = histogram.groupBy("block").cogroup(best.groupBy("block")).applyInPandas(slots, SLOT)
    rank = Window.partitionBy("_p_block", "length").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = open_parts.withColumn("place", F.row_number().over(rank).cast("bigint"))
    ranked = ranked.withColumnRenamed("_p_block", "block")
    stride = F.lit(1 << 20)
    packed = ranked.join(filled, ["block", "length", "place"]).withColumn(
        "sequence_id", F.col("block") * stride + F.col("bin")
    )
    names = [name for name in parts.columns]
    # full pieces: numbers below zero, from their position in the table
    alone = dealt.filter(F.col("_p_block").isNull()).select(
        *names, (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")
    )
    return packed.select(*names, "sequence_id", "offset").unionByName(alone)
