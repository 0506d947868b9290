import corpus_pipeline
from monthmill.llm import minhash, quality, suffix
from monthmill.llm.queries import QUERIES
from tests.llm.conftest import SMALL


def test_stages_take_effect(spark, space):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "minhash_near_dedup", "suffix_dedup", "source_mix", "best_fit_packing"]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    made = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = space.write(stage(spark, docs, SMALL), name)
        assert docs.columns == columns
        made.append(docs)
        counts.append(docs.count())
    raw, good, single, cut, mixed = made
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    assert ids(good) == ids(quality.judged(raw).filter("kept"))
    assert ids(single) == ids(minhash.near_duplicates(good, space, 80).filter("kept"))
    assert counts[2] < counts[1] < counts[0]
    assert not cut.filter("n_chars != length(text)").count()
    removed = suffix.removal(single, space).selectExpr("sum(n_bytes - n_removed)").first()[0]
    assert removed - 4 * counts[2] <= cut.selectExpr("sum(octet_length(text))").first()[0] <= removed
    packed = corpus_pipeline.STAGES[-1][1](spark, mixed, SMALL)
    assert ids(packed.filter("piece = 0")) == ids(mixed)


def test_every_operator_has_its_query():
    names = sorted(QUERIES, key=lambda name: int(name[2:].split("_")[0]))
    assert [name[2:].split("_")[0] for name in names] == [str(n) for n in range(1, 14)]
