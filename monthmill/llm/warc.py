"""A content-addressed WARC archive: payload bytes once, record headers apart.

``write_archive`` makes one WARC record per page. The archive is three tables below one folder:
``payloads`` holds every distinct payload once, compressed, under its SHA-256, ``headers`` the exact header
block of every record with the digest of its payload, both Parquet, and ``warc`` (optional) the records themselves
as gzip-compressed WARC files. ``read_archive`` joins headers and payloads, verifies that
every payload still has its digest and length, and returns the original records byte by byte.

Of the records with equal payloads of at least ``REVISIT_BYTES`` bytes, the one with the largest
page_id is the response and the others are revisits of it; smaller payloads are always
responses. A revisit's record has no payload bytes, as usual, but its headers name the digest.

Scale: payloads are compressed where they are read. They are shuffled once to be stored, by
digest, and only one row per digest and task leaves the map side; and once to be written as WARC files. Their
lengths and digests are taken where they are read back, so the index moves no payload. All
other joins are on digests and small rows; digests with
very many pages are split (``spread_lookup``).

Edge cases: a null html is an empty payload; repeated rows are records of their own, and if
several rows of one payload share the largest page_id all of them are responses; a null
page_id is never the largest unless all are null (then all are responses); an empty table gives an empty archive;
other columns are not part of a record and are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monthmill.llm.common import free_shuffles, spread_lookup
from monthmill.workspace import Workspace

REVISIT_BYTES = 1000
CRLF = "\r\n"
#: Fixed, so that reruns write the same archive.
RECORD_DATE = "2024-01-01T00:00:00Z"


def record_id(page_id: Column, url: Column) -> Column:
    """A stable URN from page and url."""
    text = F.md5(F.concat_ws("\n", F.coalesce(page_id.cast("string"), F.lit("null")), F.coalesce(url, F.lit(""))))
    parts = [F.substring(text, start, length) for start, length in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def header_block(kind: Column) -> Column:
    """The header lines of a record, without the empty line that ends them."""
    revisit = kind == "revisit"
    line_breaks = r"[\r\n]+"
    url = F.regexp_replace(F.coalesce("url", F.lit("")), line_breaks, " ")
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), kind),
        F.concat(F.lit("WARC-Record-ID: "), record_id(F.col("page_id"), F.col("url"))),
        F.lit(f"WARC-Date: {RECORD_DATE}"),
        F.concat(F.lit("WARC-Target-URI: "), url),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("sha1")),
        F.concat(F.lit("X-Payload-Length: "), F.col("bytes")),
        F.concat(F.lit("X-Page-ID: "), F.coalesce(F.col("page_id").cast("string"), F.lit("null"))),
        F.when(revisit, F.concat(F.lit("X-Refers-To-Page-ID: "), F.col("holder").cast("string"))),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.when(revisit, F.lit("0")).otherwise(F.col("bytes").cast("string"))),
    ]
    return F.concat_ws(CRLF, *lines)  # null lines are left out


def first_per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per digest and task. Keeps digests only, 32 bytes for each payload of a task."""
    seen: set[str] = set()
    for batch in batches:
        keep = []
        for key in batch.column("sha256").to_pylist():
            keep.append(key not in seen)
            seen.add(key)
        yield batch.filter(pa.array(keep, pa.bool_()))


def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct payloads of a task, compressed."""
    shrink = zstandard.ZstdCompressor(level=6).compress
    for batch in first_per_task(batches):
        bodies = [shrink(body.as_buffer()) for body in batch.column("payload")]
        yield pa.record_batch({"sha256": batch.column("sha256"), "payload": pa.array(bodies, pa.binary())})


def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stored payloads with the length and SHA-1 of what they hold; fails if one lost its digest."""
    restore = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        sizes, digests = [], []
        for key, body in zip(batch.column("sha256").to_pylist(), batch.column("payload"), strict=True):
            body = restore(body.as_buffer())
            if hashlib.sha256(body).hexdigest() != key:
                raise ValueError(f"payload does not have its digest {key}")
            sizes.append(len(body))
            digests.append(hashlib.sha1(body).hexdigest())
        yield pa.record_batch({
            "sha256": batch.column("sha256"), "payload": batch.column("payload"),
            "payload_bytes": pa.array(sizes, pa.int64()), "payload_digest": pa.array(digests, pa.string()),
        })


CHECKED = "sha256 string, payload binary, payload_bytes bigint, payload_digest string"


def unpacked(payload: Column) -> Column:
    """Payloads as they were. An expression, so whoever needs no payload has none moved."""

    def restored(packed: pa.Array) -> pa.Array:
        restore = zstandard.ZstdDecompressor().decompress
        return pa.array([restore(body.as_buffer()) for body in packed], pa.binary())

    return F.arrow_udf(restored, "binary")(payload)


def write_archive(pages: DataFrame, folder: str, space: Workspace, warc_files: bool = False) -> None:
    """Write the records of ``pages`` (page_id, url, html) below ``folder``."""
    html = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    read = pages.select("page_id", "url", html.alias("payload"))
    digests = space.write(
        read.select("page_id", "url", F.sha2("payload", 256).alias("sha256"), F.sha1("payload").alias("sha1"),
                    F.octet_length("payload").cast("bigint").alias("bytes")),
        "warc-digests",
    )
    holders = digests.groupBy("sha256").agg(
        F.max("page_id").alias("holder"), F.count(F.lit(1)).alias("uses")
    )
    holders = space.write(holders, "warc-holders")
    total = holders.agg(F.sum("uses")).first()[0] or 0
    rows = spread_lookup(digests, holders, ["sha256"], "uses", total)
    again = (F.col("bytes") >= REVISIT_BYTES) & ~F.col("page_id").eqNullSafe(F.col("holder"))
    kind = F.when(again, F.lit("revisit")).otherwise(F.lit("response"))
    rows.select("page_id", "sha256", header_block(kind).alias("header")).write.parquet(f"{folder}/headers")
    space.drop(digests, holders)
    free_shuffles(pages.sparkSession)

    bodies = read.select(F.sha2("payload", 256).alias("sha256"), "payload")
    once = bodies.mapInArrow(packed, bodies.schema).repartition("sha256")
    once.mapInArrow(first_per_task, bodies.schema).write.parquet(f"{folder}/payloads")
    free_shuffles(pages.sparkSession)
    if warc_files:
        # a text writer that ends its values with two line breaks writes exactly WARC records
        records = read_archive(pages.sparkSession, folder, space)
        records.select(F.expr("decode(substr(record, 1, length(record) - 4), 'UTF-8')").alias("value")).write.option(
            "lineSep", CRLF * 2
        ).option("compression", "gzip").text(f"{folder}/warc")
        free_shuffles(pages.sparkSession)


def header_field(header: Column, name: str) -> Column:
    """The value of a header line; null if there is none."""
    found = F.regexp_extract(header, rf"(?:^|\r\n){name}: ([^\r\n]*)", 1)
    return F.when(F.instr(header, f"\r\n{name}: ") > 0, found)


def read_archive(spark: SparkSession, folder: str, space: Workspace) -> DataFrame:
    """The original records: ``page_id``, ``header``, ``payload`` (full, also of revisits) and
    ``record`` (the exact bytes), with ``payload_bytes`` and ``payload_digest`` (SHA-1) of the full payload.
    Fails if a payload is missing or lost its digest or length.

    Payloads are verified where they are read. They are moved compressed, and only if the payload or the record is used."""
    headers = spark.read.parquet(f"{folder}/headers")
    payloads = spark.read.parquet(f"{folder}/payloads").mapInArrow(checked, CHECKED)
    uses = headers.groupBy("sha256").agg(F.count(F.lit(1)).alias("uses"))
    total = headers.count()
    rows = spread_lookup(headers, payloads, ["sha256"], "uses", total, counts=uses)
    missing = F.raise_error(F.concat(F.lit("no payload with the digest "), F.col("sha256")))
    size = F.coalesce("payload_bytes", missing.cast("bigint")).alias("payload_bytes")
    rows = rows.select("page_id", "header", unpacked(F.col("payload")).alias("payload"), size, "payload_digest")
    body = F.when(header_field(F.col("header"), "WARC-Type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    record = F.concat(F.encode(F.concat("header", F.lit(CRLF * 2)), "UTF-8"), body, F.lit((CRLF * 2).encode()))
    return rows.select("page_id", "header", "payload", record.alias("record"), "payload_bytes", "payload_digest")


def record_index(records: DataFrame) -> DataFrame:
    """What the records that were read back say: one row per page."""
    header = F.col("header")
    page = F.nullif(header_field(header, "X-Page-ID"), F.lit("null")).cast("bigint")
    return records.select(
        page.alias("page_id"),
        "payload_bytes",
        "payload_digest",
        header_field(header, "WARC-Type").alias("record_type"),
        header_field(header, "X-Refers-To-Page-ID").cast("bigint").alias("refers_to"),
    )
