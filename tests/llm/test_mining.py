from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from monthmill.llm import mining

SCHEMA = "vec_id bigint, label int, x array<bigint>, row int, cell string, k int, `a.b` int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], SCHEMA)


def expected(rows, every=100):
    good = [r for r in rows if r[1] is not None and r[2] and None not in r[2]]
    last = 2**63
    out = Counter()
    for i, (key, label, x) in enumerate(good):
        if key is None or key % every:
            continue
        scored = [(-sum(a * b for a, b in zip(x, r[2], strict=True)), last if r[0] is None else r[0], j, r)
                  for j, r in enumerate(good) if j != i]
        near = sorted(s for s in scored if s[3][1] == label)[:5]
        others = sorted(s[:3] for s in scored if s[3][1] != label)
        for p, _, _, positive in near:
            inside = [s for s in others if 30 * -p <= 100 * -s[0] <= 90 * -p][:10]
            for rank, (s, _, j) in enumerate(inside, 1):
                out[key, positive[0], rank, good[j][0], -p, -s] += 1
    return out


def clustered(seed, n, dims, spread):
    random = np.random.default_rng(seed)
    centers = random.normal(size=(6, dims)) * 60
    kind = random.integers(0, 6, n)
    x = np.floor(centers[kind] + random.normal(size=(n, dims)) * spread).astype(int)
    label = np.where(random.random(n) < 0.2, (kind + 1) % 6, kind)
    return [(k, int(a), v.tolist()) for k, (a, v) in enumerate(zip(label, x, strict=True))]


@pytest.mark.parametrize("cell_rows, first_wave, spread", [(10, 30, 25), (4, 5, 5), (100_000, 10, 25)])
def test_against_all_pairs(spark, space, cell_rows, first_wave, spread):
    rows = clustered(3, 500, 11, spread)
    found = mining.mine(frame(spark, rows), space, F.col("vec_id") % 20 == 0, cell_rows=cell_rows, first_wave=first_wave)
    wanted = expected(rows, 20)
    assert wanted and Counter(map(tuple, found.collect())) == wanted


def test_ties_repeated_rows_nulls_and_a_hot_vector(spark, space):
    rows = [(k, k % 3, [9, 9, 1]) for k in range(200)] + [(k, 7, [9, 8, 0]) for k in range(300, 330)]
    rows += [(7, 1, [9, 9, 1]), (None, 1, [50, 50, 50]), (None, 7, [8, 8, 0]), (400, None, [1, 2, 3]), (500, 2, None),
             (600, 2, []), (700, 2, [1, None, 3]), (800, 9, [-5, -5, 0]), (900, 9, [5, 5, 0]), (1000, 11, [0, 0, 0])]
    found = mining.mine(frame(spark, rows), space, F.col("vec_id") % 100 == 0, cell_rows=20, first_wave=8)
    assert Counter(map(tuple, found.collect())) == expected(rows)


def test_blocks_and_groups_are_bounded(spark, space, monkeypatch):
    rows = [(k, k % 2, [3, 4]) for k in range(3000)]
    table = space.write(frame(spark, rows).select("vec_id", "label", "x").withColumn("row", F.monotonically_increasing_id()))
    _, blocks = mining.build(table, space)
    sizes = [r.n for r in blocks.select(F.size("members").alias("n")).collect()]
    assert sum(sizes) == 3000 and max(sizes) < 2 * mining.BLOCK_ROWS and len(sizes) == 3


def test_cells_come_by_falling_bounds_that_hold(given):
    random = np.random.default_rng(2)
    x = np.floor(random.normal(size=(400, 8)) * 100 + 40 * random.integers(0, 3, (400, 1)))
    books = (mining.codebook(x[:, :4], 5), mining.codebook(x[:, 4:], 5))
    start = mining.Index(books, (np.zeros(5), np.zeros(5)), np.zeros(25, int))
    cell, near, far = start.cells(x)
    radii = tuple(np.array([d[c == k].max(initial=0) for k in range(5)]) for d, c in ((near, cell // 5), (far, cell % 5)))
    index = mining.Index(books, radii, np.bincount(cell, minlength=25))
    for anchor in x[:20]:
        order, passed, rest = index.visits(anchor, 0, 10**9)
        assert rest is None and passed == 25 and sorted(order) == sorted(set(cell))
        first, second = index.bounds(anchor)
        bound = {c: first[c // 5] + second[c % 5] for c in range(25)}
        assert [bound[c] for c in order] == sorted((bound[c] for c in order), reverse=True)
        assert all((x[cell == c] @ anchor).max() <= bound[c] for c in order)
        # in waves the same cells come in the same order, and the next bound is that of the next cell
        seen, skip, next_bound = [], 0, None
        while True:
            part, skip, next_bound = index.visits(anchor, skip, 60)
            seen += part
            if next_bound is None:
                break
            assert next_bound == pytest.approx(bound[order[len(seen)]])
        assert seen == order


def test_searches_stop_before_all_cells_are_visited(spark, space, monkeypatch):
    rows = clustered(5, 600, 8, 2)
    table = space.write(frame(spark, rows).select("vec_id", "label", "x").withColumn("row", F.monotonically_increasing_id()))
    index, blocks = mining.build(table, space, cell_rows=6)
    window = F.array(F.struct(F.lit(0).alias("k"), F.lit(-(2**62)).alias("low"), F.lit(2**62).alias("high")))
    anchors = table.filter("vec_id % 50 = 0").withColumn("windows", window)
    written = {}
    real = space.write
    monkeypatch.setattr(space, "write", lambda df, label: written.setdefault(label, real(df, label)))
    mining.search(index, blocks, anchors, space, True, 5, first_wave=20).count()
    visited = sum(r.n for name, t in written.items() if name.startswith("visits") for r in t.select(F.size("cells").alias("n")).collect())
    assert visited < 0.7 * anchors.count() * int((index.rows > 0).sum())


def test_scores_beyond_doubles_and_empty_tables(spark, space):
    big = 2**27
    rows = [(0, 1, [big, 1]), (1, 1, [big, 3]), (2, 1, [big, 2]), (3, 2, [big // 2, 1]), (4, 2, [big // 2, 2])]
    found = mining.mine(frame(spark, rows), space, F.col("vec_id") % 100 == 0)
    assert Counter(map(tuple, found.collect())) == expected(rows)
    assert mining.mine(frame(spark, rows).limit(0), space, F.col("vec_id") % 100 == 0).count() == 0
    assert mining.mine(frame(spark, rows), space, F.col("vec_id") == 77).count() == 0
    with pytest.raises(ValueError, match="entries"):
        mining.mine(frame(spark, [(0, 1, [1]), (1, 1, [1, 2])]), space, F.lit(True))
