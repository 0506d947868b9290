"""Further columns of any name pass through the stages as they are."""

import pytest

import corpus_pipeline
from tests.llm.conftest import SMALL

NAMES = ["_piece", "_pieces", "_turn", "_s_mark", "_x_doc", "_x_mark", "_x_ranges", "_q_text", "_q_words", "_q_keep",
         "_m_keep_0", "_m_copy", "_m_size", "a.b", "mark", "digest", "doc", "size", "kept", "carried_3"]


@pytest.fixture
def odd(spark):
    """Documents with a group of copies, null ids and texts, and further columns."""
    given = spark.read.parquet(f"{SMALL}/documents.parquet").limit(40).collect()
    rows = [(r.doc_id, r.text, r.source) for r in given]
    rows += [(10**6 + k, given[0].text, given[0].source) for k in range(3)] + [(None, None, None), (None, given[1].text, "s")]
    rows += [rows[0], rows[0]]
    schema = "doc_id bigint, text string, source string, n_chars bigint, " + ", ".join(f"`{n}` bigint" for n in NAMES)
    values = [(key, text, source, len(text or ""), *[hash((key, k)) % 1000 for k in range(len(NAMES))]) for key, text, source in rows]
    return spark.createDataFrame(values, schema)


@pytest.mark.parametrize("number", range(4))
def test_a_stage_keeps_columns_of_any_name(spark, space, odd, number):
    docs = space.write(odd, "docs")
    plain = space.write(docs.select("doc_id", "text", "source", "n_chars"), "plain")
    name, stage = corpus_pipeline.STAGES[number]
    found = stage(spark, docs, SMALL)
    assert found.columns == docs.columns
    rows = found.collect()
    assert rows
    for row in rows:
        assert [row[n] for n in NAMES] == [hash((row.doc_id, k)) % 1000 for k in range(len(NAMES))]
    if name != "source_mix":  # its draws of equal documents depend on all columns
        wanted = stage(spark, plain, SMALL).collect()
        assert sorted(map(str, ((r.doc_id, r.text) for r in rows))) == sorted(map(str, ((r.doc_id, r.text) for r in wanted)))


def test_packing_ignores_further_columns(spark, space, odd):
    found = corpus_pipeline.packed_sequences(spark, space.write(odd, "docs"), SMALL)
    assert "a.b" not in found.columns and found.filter("piece = 0").count() == odd.count()
