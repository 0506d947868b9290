import re
from collections import Counter

from monthmill.llm import quality

EDGES = [(1, None), (2, ""), (3, " \n\t "), (4, "a b a b a b a b"), (4, "a b a b a b a b"), (None, "x " * 60),
         (5, "one\ntwo\none\n\n \none two"), (6, "#a $b %c & |<>" * 30), (7, "ä ö\x0bü\x0cß"), (8, "word " * 30_000)]


def measured(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(covered))


def test_values_and_base_rules(texts, given):
    docs = texts(*EDGES).select("doc_id", "text").unionByName(given("documents").select("doc_id", "text"))
    expected = Counter()
    for row in docs.collect():
        values = measured(row.text)
        failed = values[0] < 50 or 100 * values[4] > 50 * values[0]
        expected[(row.doc_id, *values, failed)] += 1
    found = quality.judged(docs).collect()
    assert Counter(tuple(row)[:7] for row in found) == expected
    assert not any(row.kept and row.base_failed for row in found)


def test_filter_agrees_with_verdict_and_keeps_columns(texts, given):
    docs = given("documents").unionByName(texts(*EDGES).drop("size"))
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    verdicts = quality.judged(docs).filter("kept")
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in verdicts.collect())


def test_clean_documents_stay(given):
    labels = given("labels").filter("quality = 1")
    good = quality.judged(given("documents")).join(labels, "doc_id").filter("n_words >= 50")
    assert good.count() and not good.filter("not kept").count()


def test_empty_table_and_order_of_rules(texts):
    none = texts((1, "a")).limit(0)
    assert quality.judged(none).count() == 0 and quality.keep_good(none).count() == 0
    docs = quality.prepared(texts(*EDGES), "text").cache()
    rules = [*quality.base_rules(quality.features()), *quality.style_rules(quality.features())]
    ordered = quality.ordered_rules(docs, rules)
    assert sorted(r.name for r in ordered) == sorted(r.name for r in rules)
    first = docs.filter(quality.cascade(rules)).count()
    assert first == docs.filter(quality.cascade(list(reversed(rules)))).count()
