"""Registered queries of the operators of this subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthmill.llm import (
    embeddings, html, minhash, mining, mixing, packing, quality, suffix, tokens, urls, warc, whitening, wordtable,
)
from monthmill.llm.common import importable, tables
from monthmill.workspace import Workspace

TOKENIZER = "word_bpe_49k.json"


def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    space = Workspace(spark, "packing")
    parts = packing.pieces(tables(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return packing.pack(space.write(parts, "pieces"), space)


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a cache that starts empty, so that every distinct text is encoded once."""
    importable(spark)
    space = Workspace(spark, "tokens")
    docs = tables(spark, sf_dir, "documents").select("doc_id", "text")
    return tokens.count_tokens(docs, public_tokenizers.path(TOKENIZER), space.path("cache"), space)


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(tables(spark, sf_dir, "documents"))


def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(tables(spark, sf_dir, "documents"), Workspace(spark, "mixing"))


def url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = tables(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge(pages, urls.rule_table(spark), Workspace(spark, "urls")).drop("url")


def warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    space = Workspace(spark, "warc")
    folder = space.path("archive")
    warc.write_archive(tables(spark, sf_dir, "pages"), folder, space, warc_files=True)
    return warc.record_index(warc.read_archive(spark, folder, space))


def embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    vectors = tables(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return embeddings.near_duplicates(vectors, Workspace(spark, "embeddings"))


def minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    docs = tables(spark, sf_dir, "documents").select("doc_id", "text")
    return minhash.near_duplicates(docs, Workspace(spark, "minhash"), percent=85)


def suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    docs = tables(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix.removal(docs, Workspace(spark, "suffix"))


def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    pages = tables(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html.extract(pages, html.train(html.training_pages(pages)))


def bpe_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    docs = tables(spark, sf_dir, "documents").select("doc_id", "text")
    return wordtable.digests(docs, public_tokenizers.path(TOKENIZER), Workspace(spark, "words"))


def embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null where a deviation exceeds a long."""
    importable(spark)
    vectors = tables(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    found = whitening.whiten(vectors, Workspace(spark, "whitening"))
    return found.withColumn("deviation", F.expr("try_cast(deviation as bigint)"))


def hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of every seventh vector move on by one, which plants negatives close to their anchors."""
    importable(spark)
    entries = F.col("embedding").cast("array<double>")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = tables(spark, sf_dir, "embeddings").filter(whitening.finite(entries)).select(
        "vec_id", moved.alias("label"), F.transform(entries, lambda c: F.floor(F.lit(256.0) * c)).alias("x")
    )
    return mining.mine(vectors, Workspace(spark, "mining"), F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": best_fit_packing,
    "op10_embedding_near_dedup": embedding_near_dedup,
    "op11_bpe_words": bpe_words,
    "op12_embedding_whitening": embedding_whitening,
    "op13_hard_negatives": hard_negatives,
    "op2_warc_archive": warc_archive,
    "op3_minhash_near_dedup": minhash_near_dedup,
    "op4_quality_rules": quality_rules,
    "op5_token_counts": token_counts,
    "op6_suffix_dedup": suffix_dedup,
    "op7_url_filters": url_filters,
    "op8_html_extraction": html_extraction,
    "op9_source_mix": source_mix,
}
