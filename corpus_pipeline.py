"""A training corpus from ``documents``: five stages, each of which works on all that its
predecessor kept. Every stage but the last returns the columns of ``documents``.

1. quality rules: documents that a rule rejects go;
2. near-duplicates by SetSketch registers (five-word shingles, similarity of 0.8 or more): one
   document of each group stays;
3. suffix dedup: passages of 100 bytes or more that occur earlier are cut out of the texts,
   n_chars is counted anew, and documents of which no word is left go;
4. mixing: every document as often as its source's share wants it;
5. packing: the pieces of the documents with their sequence and offset.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthmill.llm import minhash, mixing, packing, quality, suffix
from monthmill.llm.common import importable, tables
from monthmill.workspace import Workspace

TOKENIZER = "word_bpe_49k.json"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return minhash.one_of_each(docs, Workspace(spark, "pipeline-minhash"), percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    cleaned = suffix.without_repeats(docs, Workspace(spark, "pipeline-suffix"))
    names = cleaned.columns
    rest = cleaned.filter(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return rest.withColumn("n_chars", F.length("text").cast("bigint")).select(*[f"`{name}`" for name in names])


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs, Workspace(spark, "pipeline-mixing"))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    space = Workspace(spark, "pipeline-packing")
    parts = packing.pieces(docs, public_tokenizers.path(TOKENIZER))
    return packing.pack(space.write(parts, "pieces"), space)


STAGES = [
    ("quality_rules", quality_rules),
    ("minhash_near_dedup", near_duplicates),
    ("suffix_dedup", repeated_passages),
    ("source_mix", source_mix),
    ("best_fit_packing", packed_sequences),
]

#: SQL can express neither the near-duplicate stage nor tokens and packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written as Parquet and read back for the next."""
    space = Workspace(spark, "pipeline")
    docs = tables(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = space.write(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
