import gzip
import hashlib
import re
from collections import defaultdict
from pathlib import Path

import pytest
import zstandard

from monthmill.llm import queries, warc


def pages_of(spark, *rows):
    return spark.createDataFrame(list(rows), "page_id bigint, url string, html string, header string")


def test_round_trip_and_revisits(spark, space, given):
    long = "ä" * 600  # 1200 bytes
    extra = pages_of(spark, (10**6, "u\r\nX: y", long, "h"), (10**6 + 1, None, long, "h"), (10**6 + 2, "v", "short\r\n\r\n", "h"),
                     (10**6 + 3, "v", "short\r\n\r\n", "h"), (10**6 + 4, "v", None, "h"), (None, "v", long, "h"))
    pages = given("pages").select("page_id", "url", "html").unionByName(extra.drop("header"))
    folder = space.path("archive")
    warc.write_archive(pages, folder, space, warc_files=True)
    records = warc.read_archive(spark, folder, space)
    index = {r.page_id: r for r in warc.record_index(records).collect()}
    by = defaultdict(list)
    for row in pages.collect():
        by[(row.html or "").encode()].append(row.page_id)
    assert len(index) == sum(map(len, by.values()))
    for body, ids in by.items():
        last = max(i for i in ids if i is not None)
        for key in ids:
            row = index[key]
            again = len(body) >= 1000 and key != last
            assert (row.payload_bytes, row.payload_digest) == (len(body), hashlib.sha1(body).hexdigest())
            assert (row.record_type, row.refers_to) == (("revisit", last) if again else ("response", None))
    # the files hold exactly the records
    raw = b"".join(gzip.open(f).read() for f in Path(f"{folder}/warc".removeprefix("file:")).glob("*.gz"))
    whole = [bytes(r.record) for r in records.select("record").collect()]
    assert len(raw) == sum(map(len, whole)) and all(record in raw for record in whole)
    payloads = spark.read.parquet(f"{folder}/payloads")
    assert payloads.count() == payloads.select("sha256").distinct().count() == len(by)


def test_registered_query_writes_records(spark, monkeypatch):
    spaces, workspace = [], queries.Workspace
    monkeypatch.setattr(queries, "Workspace", lambda *given: spaces.append(workspace(*given)) or spaces[-1])
    rows = queries.warc_archive(spark, "/root/testdata/sf0.001").count()
    found = list(Path(spaces[0].folder.removeprefix("file:")).glob("*-archive/warc/*.gz"))
    raw = b"".join(gzip.open(f).read() for f in found)
    assert len(re.findall(rb"(?m)^WARC/1\.1\r$", raw)) == rows > 0
    spaces[0].close()


def test_repeated_rows_and_empty_table(spark, space):
    body = "x" * 2000
    folder = space.path("archive")
    warc.write_archive(pages_of(spark, (7, "u", body, ""), (7, "u", body, ""), (3, "u", body, "")), folder, space)
    rows = warc.record_index(warc.read_archive(spark, folder, space)).collect()
    assert sorted((r.page_id, r.record_type, r.refers_to) for r in rows) == [
        (3, "revisit", 7), (7, "response", None), (7, "response", None)]
    empty = space.path("archive")
    warc.write_archive(spark.createDataFrame([], "page_id bigint, url string, html string"), empty, space)
    assert warc.read_archive(spark, empty, space).count() == 0


def test_damaged_payload_is_noticed(spark, space):
    folder = space.path("archive")
    warc.write_archive(pages_of(spark, (1, "u", "body", "")), folder, space)
    stored = spark.read.parquet(f"{folder}/payloads").collect()
    spark.createDataFrame([(r.sha256, zstandard.ZstdCompressor().compress(b"other")) for r in stored], "sha256 string, payload binary").write.mode(
        "overwrite").parquet(f"{folder}/payloads")
    with pytest.raises(Exception, match="digest"):
        warc.read_archive(spark, folder, space).collect()


def test_the_index_moves_no_payload(spark, space):
    rows = [(k, f"http://a/{k}", f"<p>{k % 7}</p>" + "x" * 1200, "") for k in range(40)]
    folder = space.path("archive")
    warc.write_archive(pages_of(spark, *rows), folder, space)
    found = warc.record_index(warc.read_archive(spark, folder, space))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # where payloads are verified, only what is said of them goes on
    assert re.search(r"Project \[sha256#\d+, payload_bytes#\d+L, payload_digest#\d+\]\n(?:\W+Filter .*\n)?\W+MapInArrow checked", plan), plan
    assert "restored" not in plan
    for row in found.collect():
        body = rows[row.page_id][2].encode()
        assert (row.payload_bytes, row.payload_digest) == (len(body), hashlib.sha1(body).hexdigest())


def test_missing_payload_is_noticed(spark, space):
    folder = space.path("archive")
    warc.write_archive(pages_of(spark, (1, "u", "body", ""), (2, "u", "other", "")), folder, space)
    stored = spark.read.parquet(f"{folder}/payloads").collect()
    spark.createDataFrame(stored[:1], "sha256 string, payload binary").write.mode("overwrite").parquet(f"{folder}/payloads")
    with pytest.raises(Exception, match="no payload with the digest"):
        warc.record_index(warc.read_archive(spark, folder, space)).collect()
