"""Token counts through a digest cache, and the encoder that the packing uses too.

``count_tokens`` joins the digests of normalised texts and of the tokenizer file with stored
counts, encodes only the distinct texts that are missing, appends their counts to the cache and
joins again. The cache is a folder of Parquet files, one partition per tokenizer digest; a
run that finds its texts there encodes nothing.

Encoding: a tokenizer that drops white space and never joins characters across it (as its file says) gives for
a text exactly what it gives for the pieces between blanks, one after the other. For such a file
every distinct piece of a task goes through the tokenizer library once and is remembered, up to
``REMEMBERED`` pieces and words per worker; other tokenizers get whole texts. The normalisation of the
digest follows the same rule: runs of white space become one blank where they make no difference.

Edge cases: a null text counts as empty (0 bytes, 0 tokens); special strings inside a text are
handled as the library does by default; repeated rows and repeated texts are encoded once; empty
tables work; a null doc_id is kept; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monthmill.llm.common import SPACE_RUN, SPACES, spread_lookup
from monthmill.workspace import Workspace

REMEMBERED = 250_000
#: So many words go through the library in one call.
TOGETHER = 200
#: Latin letters whose lower case is one letter, with marks behind them.
SIMPLE = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([.,;:!?|]*)")
#: Texts are taken in groups of about so many bytes, which bounds what a task holds at once.
GROUP_BYTES = 4_000_000
LIMIT = 2048


def tokenizer_digest(path: str) -> str:
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


@cache
def drops_spaces(path: str) -> bool:
    """Whether the tokenizer file says that white space separates and is dropped: its normaliser
    makes runs of white space one blank, and its first splitter keeps only matches of a pattern
    none of whose parts matches white space, with letters apart from other marks."""
    if not path.endswith(".json"):
        return False
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    steps = (spec.get("normalizer") or {}).get("normalizers", [])
    collapses = any(step.get("type") == "Replace" and step["pattern"].get("Regex") == r"\s+" for step in steps)
    first = ((spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
    keeps = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") is True
    pattern = (first.get("pattern") or {}).get("Regex", r"\s")
    letters = pattern.replace(r"[^\s", "[^").replace(r"[\p{L}]", "").replace(r"[\p{N}]", "")
    separate = r"[\p{L}]+" in pattern and r"[^\s\p{L}\p{N}]+" in pattern
    return collapses and keeps and separate and r"\s" not in letters and " " not in letters


class Encoder:
    """Token ids of texts, as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a task per core
        self.by_piece = drops_spaces(path)
        self.known: dict[bytes, bytes] = {}
        self.words: dict[str, bytes] = {}
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self._ids = lambda texts: model.encode(texts, num_threads=1)
        else:
            from tokenizers import Tokenizer

            model = Tokenizer.from_file(path)
            model.no_truncation()
            model.no_padding()
            self._model = model
            self._ids = lambda texts: [
                found.ids for found in model.encode_batch(texts, add_special_tokens=False)
            ]

    def whole(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, given to the library as it is."""
        return [np.asarray(ids, dtype="<u4").tobytes() for ids in self._ids(texts)]

    def _learn_words(self, words: list[str]) -> None:
        """Ids of words that consist of letters only, many of them in one call."""
        for start in range(0, len(words), TOGETHER):
            part = words[start : start + TOGETHER]
            found = self._model.encode(" ".join(part), add_special_tokens=False)
            ids = np.asarray(found.ids, dtype="<u4").tobytes()
            owner = np.asarray(found.word_ids)
            ends = (4 * np.searchsorted(owner, np.arange(1, len(part) + 1))).tolist()
            begin = 0
            for word, end in zip(part, ends, strict=True):
                self.words[word] = ids[begin:end]
                begin = end

    def _learn(self, pieces: list[bytes]) -> None:
        """Ids of new pieces. Letters and the marks behind them are separate for the tokenizer
        and letters are lower-cased one by one, so such pieces share the ids of their word."""
        texts = [piece.decode() for piece in pieces]
        simple = [SIMPLE.fullmatch(text) for text in texts]
        parts = [(m[1].lower(), m[2]) if m else None for m in simple]
        new = {part[0] for part in parts if part} - self.words.keys()
        self._learn_words(list(new))
        odd = {part[1] for part in parts if part and part[1]} | {
            text for text, part in zip(texts, parts, strict=True) if not part
        }
        odd_list = list(odd)
        others = dict(zip(odd_list, self.whole(odd_list), strict=True)) if odd_list else {}
        for piece, text, part in zip(pieces, texts, parts, strict=True):
            if part:
                self.known[piece] = self.words[part[0]] + (others[part[1]] if part[1] else b"")
            else:
                self.known[piece] = others[text]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        if not self.by_piece:
            return self.whole(texts)
        pieces = [text.encode().split() for text in texts]
        for name in ("known", "words"):
            table = getattr(self, name)
            if len(table) > REMEMBERED:  # what came first is what comes often
                setattr(self, name, dict(islice(table.items(), REMEMBERED // 2)))
        missing = list(set().union(*pieces) - self.known.keys())
        if missing:
            self._learn(missing)
        find = self.known.__getitem__
        return [b"".join(map(find, row)) for row in pieces]


@cache
def encoder(path: str) -> Encoder:
    """One encoder per worker process."""
    return Encoder(path)


def groups(texts: list[str | None]) -> Iterator[list[str]]:
    """Consecutive texts (null: empty) in groups of bounded size, never fewer than one."""
    group: list[str] = []
    size = 0
    for text in texts:
        group.append(text or "")
        size += len(group[-1])
        if size > GROUP_BYTES:
            yield group
            group, size = [], 0
    if group:
        yield group


def normalised(text: Column, path: str) -> Column:
    """What the digest is taken of: texts that are equal here have the same tokens."""
    text = F.coalesce(text, F.lit(""))
    return F.regexp_replace(F.btrim(text, F.lit(SPACES)), SPACE_RUN, " ") if drops_spaces(path) else text


def first_per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per digest and task; keeps the digests of the task only."""
    seen: set[bytes] = set()
    for batch in batches:
        keep = []
        for key in batch.column("digest").to_pylist():
            keep.append(key not in seen)
            seen.add(key)
        yield batch.filter(pa.array(keep, pa.bool_()))


def read_cache(spark: SparkSession, folder: str, version: str) -> DataFrame:
    """Stored counts of one tokenizer by digest; an empty table if there are none yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/version={version}")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], "digest binary, n_tokens bigint")
    stored = spark.read.schema("digest binary, n_tokens bigint").parquet(f"{folder}/version={version}")
    # two runs at the same time may both have appended a text; they agree on its count
    return stored.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(docs: DataFrame, path: str, cache_folder: str, space: Workspace, limit: int = LIMIT) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit`` of every document."""
    spark = docs.sparkSession
    version = tokenizer_digest(path)
    content = normalised(F.col("text"), path)
    rows = space.write(
        docs.select(
            "doc_id",
            F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"),
            F.unhex(F.sha2(content, 256)).alias("digest"),
        ),
        "token-rows",
    )
    texts = docs.select(F.unhex(F.sha2(content, 256)).alias("digest"), content.alias("content"))
    # copies meet in their map task first, so that a text with very many copies is shuffled once a task
    texts = texts.mapInArrow(first_per_task, texts.schema).repartition("digest")
    missing = texts.join(read_cache(spark, cache_folder, version), "digest", "left_anti")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for batch in first_per_task(batches):
            counts = []
            for group in groups(batch.column("content").to_pylist()):
                counts += [len(ids) // 4 for ids in encode(group)]
            yield pa.record_batch({"digest": batch.column("digest"), "n_tokens": pa.array(counts, pa.int64())})

    missing.mapInArrow(counted, "digest binary, n_tokens bigint").write.mode("append").parquet(
        f"{cache_folder}/version={version}"
    )
    uses = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("uses"))
    stored = read_cache(spark, cache_folder, version).join(uses, "digest")
    found = spread_lookup(rows, stored, ["digest"], "uses", rows.count())
    return found.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
