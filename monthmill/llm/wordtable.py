"""BPE encoding and decoding by a table of distinct words.

``encode`` gives the token ids of every document, ``decode`` the text that ids stand for.

Encoding is for tokenizers that drop white space and never join characters across it, as their
file says: a text then has the ids of its words, one after the other. Documents are taken in
blocks of about ``BLOCK_BYTES``. Three steps:

1. every block sends its distinct words, each once, to the word table, which is dealt by a hash of
   the words into buckets of about the size of a block;
2. a bucket encodes each of its distinct words once, wherever they came from, and sends every
   block the ids of its words in the order in which the block listed them;
3. every block sends its documents as positions in its list; both meet by the block's name and
   the ids are joined back by position.

A block's name is its place in the scan with a digest of its word list, so what meets under a name
belongs together; if the documents came in another order when they were read again, the job stops.
Tables that are not plain scans are written first, because only a scan keeps its order.

``decode`` joins ids with the table of pieces, one row per id of the tokenizer, whose size does
not depend on the data. Tokenizers that have no decoder put one blank between pieces; for others
the library puts the pieces together.

Scale: no text is shuffled. What is shuffled is each distinct word once per block, its ids once
per block, and about two bytes per word of text. A task holds one block, one bucket or one text.
A word that a third of all documents hold is one entry per block, so no word is hot; repeated
documents are repeated positions.

Edge cases: a null or empty text, or one of blanks only, has no ids and an empty text; special
strings inside a text are handled as the library does by default; a very long text is a block
of its own; repeated rows and null keys are kept; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthmill.llm.tokens import drops_spaces, encoder, groups
from monthmill.staging import is_scan
from monthmill.workspace import Workspace

BLOCK_BYTES = 8_000_000
#: So many words are hashed at once.
HASHED = 50_000
#: Marks that do not change the bucket of a word: words that differ in them share most of their ids.
MARKS = ".,;:!?|"

ZSTD = pa.Codec("zstd", compression_level=3)


def squeezed(values: np.ndarray) -> bytes:
    """Numbers below 2^32 in few bytes: their lowest bytes first, then the next ones."""
    planes = np.ascontiguousarray(values, dtype="<u4").view(np.uint8).reshape(-1, 4).T
    return pressed(planes.tobytes())


def pressed(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + ZSTD.compress(raw, asbytes=True)


def restored(payload: bytes) -> bytes:
    size = int.from_bytes(payload[:8], "little")
    return ZSTD.decompress(payload[8:], decompressed_size=size, asbytes=True)


def numbers(payload: bytes) -> np.ndarray:
    planes = np.frombuffer(restored(payload), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def gathered(firsts: np.ndarray, lengths: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The runs of ``values`` that start at ``firsts``, one after the other."""
    before = np.cumsum(lengths) - lengths
    return values[np.repeat(firsts - before, lengths) + np.arange(int(lengths.sum()))]


def blocks(batches: Iterator[pa.RecordBatch], block_bytes: int) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Keys and texts (null: empty) of consecutive rows of a task with about ``block_bytes`` of text."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
        start = 0
        for row, length in enumerate(lengths.tolist()):
            size += length
            if size >= block_bytes:
                held.append(batch.slice(start, row + 1 - start))
                yield _joined(held)
                held, size, start = [], 0, row + 1
        if start < len(lengths):
            held.append(batch.slice(start))
    if held:
        yield _joined(held)


def _joined(held: list[pa.RecordBatch]) -> tuple[pa.Array, pa.Array]:
    keys = pa.concat_arrays([batch.column(0) for batch in held])
    return keys, pc.fill_null(pa.concat_arrays([batch.column(1) for batch in held]), "")


def hashed(words: pa.Array) -> np.ndarray:
    """A number per word that depends on its bytes alone."""
    parts = [_hashed(words.slice(start, HASHED)) for start in range(0, len(words), HASHED)]
    return np.concatenate([np.zeros(0, np.uint64), *parts])


def _hashed(words: pa.Array) -> np.ndarray:
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1]
    raw = np.frombuffer(words.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    place = (np.arange(len(raw)) - np.repeat(offsets[:-1], np.diff(offsets))).astype(np.uint64)
    # each byte is mixed with its place; the sum over a word is a difference of running sums
    mixed = (raw + np.uint64(257) * (place + np.uint64(1))) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed)])
    found = total[offsets[1:]] - total[offsets[:-1]]
    return found ^ (found >> np.uint64(32))


def word_list(words: pa.Array) -> bytes:
    """Words as their lengths and their bytes."""
    raw = b"".join([words.buffers()[2][a:b].to_pybytes() for a, b in [_span(words)] if b > a])
    lengths = squeezed(pc.binary_length(words).to_numpy(zero_copy_only=False))
    return len(lengths).to_bytes(8, "little") + lengths + pressed(raw)


def _span(words: pa.Array) -> tuple[int, int]:
    offsets = np.frombuffer(words.buffers()[1], np.int32)
    return int(offsets[words.offset]), int(offsets[words.offset + len(words)])


def listed_words(payload: bytes) -> pa.Array:
    size = int.from_bytes(payload[:8], "little")
    lengths, raw = numbers(payload[8 : 8 + size]), restored(payload[8 + size :])
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(lengths), pa.py_buffer(offsets.tobytes()), pa.py_buffer(raw))


class Block:
    """The words of some texts: which there are, bucket by bucket, and where each stands."""

    def __init__(self, texts: pa.Array, buckets: int):
        lists = pc.ascii_split_whitespace(texts)
        # blanks at the ends of a text leave empty words there
        real = pc.not_equal(pc.list_flatten(lists), "")
        before = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False), dtype=np.int64)])
        #: Words of each text.
        self.counts = np.diff(before[lists.offsets.to_numpy()])
        coded = pc.list_flatten(lists).filter(real).dictionary_encode()
        del lists, real, before
        distinct = coded.dictionary
        core = pc.ascii_rtrim(pc.ascii_lower(distinct), characters=MARKS)
        home = (hashed(core) % np.uint64(buckets)).astype(np.int64) if len(core) else np.zeros(0, np.int64)
        order = np.argsort(home, kind="stable")
        place = np.empty(len(order), np.uint32)
        place[order] = np.arange(len(order), dtype=np.uint32)
        #: Positions of all words, text after text, in the list of distinct words.
        self.positions = place[coded.indices.to_numpy(zero_copy_only=False)]
        ends = np.cumsum(np.bincount(home, minlength=1)).tolist()
        listed = distinct.take(pa.array(order))
        #: The distinct words of every bucket that has some.
        self.lists = {
            bucket: word_list(listed.slice(begin, end - begin))
            for bucket, (begin, end) in enumerate(zip([0, *ends], ends, strict=False))
            if end > begin
        }
        self.digest = hashlib.blake2b(digest_size=16)
        for bucket, payload in self.lists.items():
            self.digest.update(b"%d %d " % (bucket, len(payload)) + payload)

    def name(self, number: int) -> bytes:
        """For block ``number`` of the running task."""
        task = TaskContext.get()
        return b"%d %d " % (task.partitionId() if task else 0, number) + self.digest.digest()


@cache
def check_tokenizer(path: str) -> None:
    if not drops_spaces(path):
        raise ValueError(f"{path} does not say that it drops white space: its words depend on their surroundings")


def encoded_bucket(bucket: pa.Table, path: str) -> pa.Table:
    """Every distinct word of a bucket is encoded once; each block gets the ids of its words."""
    spoken = [listed_words(payload) for payload in bucket.column("words").to_pylist()]
    told = pa.concat_arrays(spoken).dictionary_encode()
    ends = np.cumsum([len(words) for words in spoken])
    coded = np.split(told.indices.to_numpy(zero_copy_only=False), ends[:-1])
    ids: list[bytes] = []
    coder = encoder(path)
    for group in groups(told.dictionary.to_pylist()):
        ids += coder.encode(group)
    # another bucket has other words
    coder.known.clear()
    coder.words.clear()
    lengths = np.fromiter((len(one) // 4 for one in ids), np.int64, len(ids))
    firsts, values = np.cumsum(lengths) - lengths, np.frombuffer(b"".join(ids), "<u4")
    return pa.table({
        "block": bucket.column("block"),
        "bucket": bucket.column("bucket"),
        "lengths": pa.array([squeezed(lengths[at]) for at in coded], pa.binary()),
        "ids": pa.array([squeezed(gathered(firsts[at], lengths[at], values)) for at in coded], pa.binary()),
    })


def encode(
    docs: DataFrame,
    path: str,
    space: Workspace,
    key: str = "doc_id",
    text: str = "text",
    block_bytes: int = BLOCK_BYTES,
    finish: Callable[[pa.Table], pa.Table] | None = None,
    schema: str | None = None,
) -> DataFrame:
    """``key`` and ``ids`` (little-endian unsigned 32-bit integers) of every document.

    ``finish`` may turn the documents of a block, a table with the columns ``key`` and ``ids``, into
    rows of ``schema`` in the task that has their ids, so that the ids need not leave it."""
    check_tokenizer(path)
    named = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    rows = named if is_scan(named) else space.write(named, "word-docs")
    kind = rows.schema["key"].dataType.simpleString()
    total = rows.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    buckets = total // block_bytes + 1

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, (_, texts) in enumerate(blocks(batches, block_bytes)):
            block = Block(texts, buckets)
            if block.lists:
                yield pa.record_batch({
                    "block": pa.array([block.name(number)] * len(block.lists), pa.binary()),
                    "bucket": pa.array(list(block.lists), pa.int64()),
                    "words": pa.array(list(block.lists.values()), pa.binary()),
                })

    def learned(bucket: pa.Table) -> pa.Table:
        return encoded_bucket(bucket, path)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, (keys, texts) in enumerate(blocks(batches, block_bytes)):
            block = Block(texts, buckets)
            yield pa.record_batch({
                "block": pa.array([block.name(number)], pa.binary()),
                "lists": pa.array([len(block.lists)], pa.int64()),
                "keys": pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys),
                "counts": pa.array([squeezed(block.counts)], pa.binary()),
                "positions": pa.array([squeezed(block.positions)], pa.binary()),
            })

    def joined(block: pa.Table, lists: pa.Table) -> pa.Table:
        """The ids of one block's texts: every position finds the ids of its word."""
        if block.num_rows != 1 or block.column("lists")[0].as_py() != lists.num_rows:
            raise RuntimeError("the documents were not read in the same order again")
        lists = lists.sort_by("bucket")
        lengths = np.concatenate([np.zeros(0, "<u4"), *map(numbers, lists.column("lengths").to_pylist())])
        values = np.concatenate([np.zeros(0, "<u4"), *map(numbers, lists.column("ids").to_pylist())])
        positions = numbers(block.column("positions")[0].as_py())
        counts = numbers(block.column("counts")[0].as_py())
        taken = lengths[positions].astype(np.int64)
        firsts = (np.cumsum(lengths, dtype=np.int64) - lengths)[positions]
        raw = gathered(firsts, taken, values).astype("<u4").tobytes()
        ends = 4 * np.concatenate([[0], np.cumsum(taken)])[np.cumsum(counts, dtype=np.int64)]
        offsets = np.concatenate([[0], ends]).astype(np.int32)
        ids = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(raw)])
        return pa.table({"key": block.column("keys").combine_chunks().flatten(), "ids": ids})

    known = (
        rows.mapInArrow(listed, "block binary, bucket bigint, words binary")
        .groupBy("bucket")
        .applyInArrow(learned, "block binary, bucket bigint, lengths binary, ids binary")
    )
    texts = rows.mapInArrow(
        placed, f"block binary, lists bigint, keys array<{kind}>, counts binary, positions binary"
    )
    met = texts.groupBy("block").cogroup(known.groupBy("block"))
    if finish:
        return met.applyInArrow(lambda block, lists: finish(joined(block, lists)), schema)
    return met.applyInArrow(joined, f"key {kind}, ids binary").withColumnRenamed("key", key)


@cache
def pieces_of(path: str) -> pa.Array:
    """The table of pieces by id; null where the tokenizer has none."""
    from tokenizers import Tokenizer

    vocabulary = Tokenizer.from_file(path).get_vocab(with_added_tokens=True)
    pieces: list[bytes | None] = [None] * (max(vocabulary.values(), default=-1) + 1)
    for piece, number in vocabulary.items():
        pieces[number] = piece.encode() + b" "
    return pa.array(pieces, pa.binary())


@cache
def has_decoder(path: str) -> bool:
    with open(path, encoding="utf-8") as file:
        return json.load(file).get("decoder") is not None


def texts_of(rows: list[bytes | None], path: str) -> pa.Array:
    """The text of each row of ids (little-endian unsigned 32-bit integers), null for null.

    Ids that the tokenizer does not know stand for nothing, as in the library."""
    if has_decoder(path):
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(path)
        known = [None if row is None else np.frombuffer(row, "<u4").tolist() for row in rows]
        return pa.array([None if ids is None else model.decode(ids, skip_special_tokens=False) for ids in known], pa.string())
    table = pieces_of(path)
    ids = np.frombuffer(b"".join([row or b"" for row in rows]), "<u4")
    # the join: every id finds its piece, a blank behind it; one array holds them all in order
    found = table.take(pa.array(np.where(ids < len(table), ids, 0).astype(np.int64)))
    if len(ids) and (ids.max() >= len(table) or found.null_count):
        found = pc.if_else(pa.array(ids < len(table)), found, None).fill_null(b"")
    ends = np.concatenate([[0], np.cumsum([len(row or b"") // 4 for row in rows])])
    offsets = np.frombuffer(found.buffers()[1], np.int32)[found.offset :][ends].tolist()
    raw = found.buffers()[2]
    out = []
    for row, begin, end in zip(rows, offsets, offsets[1:], strict=False):
        # without the blank behind the last piece
        out.append(None if row is None else raw[begin : end - 1].to_pybytes().decode() if end > begin else "")
    return pa.array(out, pa.string())


def _ends(sizes: np.ndarray) -> list[int]:
    """Where groups of consecutive rows of about ``BLOCK_BYTES`` end."""
    group = np.cumsum(sizes.astype(np.int64)) // BLOCK_BYTES
    return [*(np.flatnonzero(np.diff(group)) + 1).tolist(), len(sizes)] if len(sizes) else []


def decode(encoded: DataFrame, path: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """``encoded`` with the text (a string) that its ids stand for; null ids: null."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, texts, start = batch.column(ids), [], 0
            sizes = pc.fill_null(pc.binary_length(rows), 0).to_numpy(zero_copy_only=False)
            for end in _ends(sizes):
                texts.append(texts_of(rows.slice(start, end - start).to_pylist(), path))
                start = end
            yield batch.append_column(name, pa.concat_arrays(texts) if texts else pa.array([], pa.string()))

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema]
    return encoded.mapInArrow(read, ", ".join([*fields, f"`{name}` string"]))


def digests(docs: DataFrame, path: str, space: Workspace, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Every document encoded and decoded again: ``doc_id``, ``n_tokens``, ``ids_sha256`` of the ids
    as little-endian unsigned 32-bit integers and ``decoded_sha256`` of the decoded text in UTF-8."""

    def finish(block: pa.Table) -> pa.Table:
        ids = block.column("ids").combine_chunks()
        texts, start = [], 0
        for end in _ends(pc.binary_length(ids).to_numpy(zero_copy_only=False)):
            found = texts_of(ids.slice(start, end - start).to_pylist(), path)
            texts += [hashlib.sha256(text.as_buffer()).hexdigest() for text in found]
            start = end
        return pa.table({
            "doc_id": block.column("key"),
            "n_tokens": pc.divide(pc.binary_length(ids), 4).cast(pa.int64()),
            "ids_sha256": pa.array([hashlib.sha256(one.as_buffer()).hexdigest() for one in ids], pa.string()),
            "decoded_sha256": pa.array(texts, pa.string()),
        })

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return encode(docs, path, space, block_bytes=block_bytes, finish=finish, schema=schema)
