import pytest

from monthmill.llm import mixing


def water_filled(sizes):
    """Targets by resharing until none is above its bound."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {name: k % 3 + 1 for k, name in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [n for n in names if n not in fixed]
        rest = total - sum(fixed.values())
        shares = {n: rest * weight[n] / sum(weight[m] for m in free) for n in free}
        above = [n for n in free if shares[n] > 3 * sizes[n]]
        if not above:
            return fixed | shares
        fixed |= {n: 3 * sizes[n] for n in above}


def check(docs, rows, slack=1):
    by = {}
    for row in rows:
        by.setdefault(row.source, []).append(row)
    sizes = {name: sum(r["size"] for r in part) for name, part in by.items()}
    targets = water_filled(sizes)
    for name, part in by.items():
        assert {r.source_size for r in part} == {sizes[name]}
        assert all(r.target == pytest.approx(targets[name]) for r in part)
        assert all(0 <= r.taken <= 3 * r["size"] and r.taken == r.copies * r["size"] for r in part)
        longest = max(r["size"] for r in part)
        assert abs(sum(r.taken for r in part) - targets[name]) <= slack * longest


def test_targets_and_nearness(given, space):
    docs = given("documents")
    rows = mixing.mix(docs, space, keep=["doc_id", "source"]).collect()
    assert len(rows) == docs.count()
    check(docs, rows)


def test_small_sources_nulls_ties_and_reruns(spark, space):
    rows = [(k, "w " * (k % 5 + 1), "big", 1) for k in range(300)]
    rows += [(1000, "a b", "tiny", 1), (1001, None, "tiny", 1), (None, "a b c", None, 1), (None, "a b c", None, 1),
             (1002, "", "empty", 1), (5, "w", "big", 1), (5, "w", "big", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, target int")
    first = mixing.mix(docs, space, keep=["doc_id", "source"]).collect()
    check(docs, first)
    again = mixing.mix(docs.repartition(7), space, keep=["doc_id", "source"]).collect()
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(map(key, first)) == sorted(map(key, again))
    mixed = mixing.mixed_documents(docs, space)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r.copies for r in first)


@pytest.mark.parametrize("key", [None, 5])
def test_one_id_on_a_third_of_the_rows(spark, space, monkeypatch, key):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 20)
    monkeypatch.setattr(mixing, "RUN_ROWS", 64)
    seen, bucketed = [], mixing.bucketed
    monkeypatch.setattr(mixing, "bucketed", lambda *given: seen.append(bucketed(*given)) or seen[-1])
    rows = [(k + 10, "w w w", "ab"[k % 2]) for k in range(2000)]
    rows += [(key, "w w w", "a")] * 500 + [(key, f"v{k} w w", "a") for k in range(500)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(5)
    first = mixing.mix(docs, space, keep=["doc_id", "source", "text"]).collect()
    check(docs, first)
    groups = seen[-1].filter("_m_bucket is not null").groupBy("_m_group", "_m_bucket").count()
    assert groups.agg({"count": "max"}).first()[0] < 5 * 20
    shares = {}
    for r in first:
        if r.source == "a":
            shares.setdefault((r.doc_id == key, r.text == "w w w"), []).append(r.copies)
    shares = [sum(copies) / len(copies) for copies in shares.values()]
    assert len(shares) == 3 and max(shares) - min(shares) < 0.1
    # another run takes the same rows, however the table lies
    line = lambda r: tuple(str(v) for v in r)
    mixed = mixing.mixed_documents(docs.repartition(2), space).collect()
    assert sorted(map(line, mixed)) == sorted(line((r.doc_id, r.text, r.source)) for r in first for _ in range(r.copies))


def test_digest_of_any_column(spark):
    rows = [(1, "a", None, {"k": 1}), (1, None, "a", {"k": 1}), (1, "a", None, {"k": 2}), (1, "a", None, {"k": 1})]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, `a.b` string, m map<string, int>")
    found = [r[0] for r in docs.select(mixing.digest(docs)).collect()]
    assert found[0] == found[3] and len(set(found)) == 3


def test_wanted_copies_differ_by_class(spark, space):
    docs = spark.createDataFrame(
        [(k, "w " * (20 if k % 2 else 300), "ab"[k % 4 // 2]) for k in range(800)], "doc_id bigint, text string, source string"
    )
    rows = mixing.mix(docs, space, keep=["doc_id", "source"]).collect()
    short = [r.copies for r in rows if r.source == "a" and r["size"] == 20]
    long = [r.copies for r in rows if r.source == "a" and r["size"] == 300]
    assert sum(long) / len(long) > sum(short) / len(short) > 0


def test_empty_table(spark, space):
    none = spark.createDataFrame([], "doc_id bigint, text string, source string")
    assert mixing.mix(none, space).count() == 0
    assert mixing.mixed_documents(none, space).count() == 0
