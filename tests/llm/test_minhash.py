import re
from collections import Counter, defaultdict
from random import Random

import numpy as np
import pytest

from monthmill.llm import minhash


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def expected(rows, percent):
    """Components over all pairs."""
    sets = {key: shingles(text) for key, text in rows}
    holders = defaultdict(list)
    for key, found in sets.items():
        for shingle in found:
            holders[shingle].append(key)
    root = {key: key for key in sets}

    def find(key):
        while root[key] != key:
            key = root[key]
        return key

    for key, found in sets.items():
        both = Counter(other for shingle in found for other in holders[shingle] if other > key)
        for other, n in both.items():
            if 100 * n >= percent * (len(found) + len(sets[other]) - n):
                a, b = find(key), find(other)
                root[max(a, b)] = min(a, b)
    return {key: (len(sets[key]), find(key)) for key in sets}


def edited(words, random, share):
    return [random.choice("abcdefgh") * 3 if random.random() < share else w for w in words]


def near_copies(random, families=12, size=9):
    rows, key = [], 10_000
    for _ in range(families):
        base = ["".join(random.choices("abcdefghij", k=5)) for _ in range(random.randint(8, 120))]
        for _ in range(size):
            base = edited(base, random, 0.02)  # a chain: ends differ more than neighbours
            rows.append((key, " ".join(base)))
            key += 1
    return rows


EDGES = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A  b"), (6, "a b c d e"), (7, "x y z w"), (8, "word " * 100_000), (9, "Word " * 50_000)]


@pytest.mark.parametrize("percent", [85, 80])
def test_components_against_all_pairs(spark, space, given, percent):
    rows = EDGES + near_copies(Random(percent)) + [(r.doc_id + 10**6, r.text) for r in given("documents").collect()]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    wanted = expected(rows, percent)
    found = minhash.near_duplicates(docs, space, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == wanted
    assert all(r.kept == (r.doc_id == r.component_id) for r in found) and len(found) == len(rows)
    kept = minhash.one_of_each(docs, space, percent)
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c in wanted.values()})


def test_second_round_finds_what_stars_miss(spark, space, monkeypatch):
    """With one register per band keys hold many unlike documents, and parts of two rows."""
    monkeypatch.setattr(minhash, "ROWS", 1)
    monkeypatch.setattr(minhash, "BANDS", 160)
    monkeypatch.setattr(minhash, "PART", 3)
    rows = near_copies(Random(5), families=6, size=6)
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), space, 85)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == expected(rows, 85)


def test_repeated_rows_nulls_and_empty_table(texts, space):
    rows = [(5, "same text of five words"), (5, "same text of five words"), (None, "same text of five words"), (None, None), (6, "")]
    docs = texts(*rows)
    found = minhash.near_duplicates(docs, space, 85).collect()
    key = lambda r: str(tuple(r))
    assert sorted(found, key=key) == sorted(
        [(5, 1, 5, True), (5, 1, 5, True), (None, 1, 5, False), (None, 0, None, True), (6, 0, 6, True)], key=lambda r: str(tuple(r)))
    kept = minhash.one_of_each(docs, space, 80)
    assert kept.columns == docs.columns and kept.count() == 3
    assert minhash.near_duplicates(docs.limit(0), space, 85).count() == 0
    assert minhash.one_of_each(docs.limit(0), space).count() == 0


def test_sketches_merge_and_estimate():
    random = np.random.default_rng(3)
    errors = []
    for share in (0.0, 0.3, 0.6, 0.8, 0.9, 1.0):
        for _ in range(30):
            both = int(400 * share)
            pool = random.integers(0, 2**63, 800 - both, dtype=np.uint64)
            a, b = np.unique(pool[:400]), np.unique(np.concatenate([pool[400 - both : 400], pool[400 : 800 - both]]))
            ra, rb = minhash.registers(a), minhash.registers(b)
            assert (minhash.merged(ra, rb) == minhash.registers(np.union1d(a, b))).all()
            true = both / (800 - both)
            guess = minhash.estimate(ra[None], rb[None], np.asarray([400.0]), np.asarray([400.0]))[0]
            errors.append(guess - true)
    assert np.abs(errors).max() < 0.16 and abs(np.mean(errors)) < 0.01
