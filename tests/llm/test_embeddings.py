from collections import Counter

import numpy as np
import pandas as pd
import pytest

from monthmill.llm import embeddings
from monthmill.llm.components import components


def expected(rows, cosine=0.9, kind=np.float32):
    good = [(k, np.asarray(v, kind).astype(float)) for k, v in rows
            if v is not None and len(v) and None not in v and np.isfinite(v).all() and np.any(np.asarray(v) != 0)]
    root = list(range(len(good)))
    links = [0] * len(good)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, a) in enumerate(good):
        for j in range(i):
            b = good[j][1]
            if len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= cosine:
                links[i] += 1
                links[j] += 1
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (key, _) in enumerate(good):
        least[find(i)] = min(least.get(find(i), key), key)
    out = [(key, links[i], least[find(i)]) for i, (key, _) in enumerate(good)]
    used = {id(v) for _, v in rows}
    bad = [(k, 0, k) for k, v in rows if not (v is not None and len(v) and None not in v and np.isfinite(v).all() and np.any(np.asarray(v) != 0))]
    assert used
    return sorted(out + bad)


def clustered(seed, dims, n):
    random = np.random.default_rng(seed)
    rows = []
    for _ in range(n):
        center = random.normal(size=dims)
        for _ in range(random.integers(1, 6)):
            rows.append((center + random.normal(size=dims) * random.choice([0.1, 0.3, 0.45])).astype(np.float32).tolist())
    return rows


@pytest.mark.parametrize("cell_rows", [20_000, 40])
def test_links_against_all_pairs(spark, space, given, cell_rows):
    vectors = clustered(1, 24, 60)
    vectors += vectors[:20] + [[3 * x for x in v] for v in vectors[20:40]]
    vectors += [None, [], [0.0] * 24, [float("nan")] * 24, [float("inf")] * 24, [1.0, None], [1.0, 2.0], [2.0, 4.0], [1e30] * 24, [1e30] * 24]
    if cell_rows == 20_000:
        vectors += [r.embedding for r in given("embeddings").limit(100).collect()]
    rows = list(enumerate(vectors))
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    found = embeddings.near_duplicates(df, space, cell_rows=cell_rows).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in found) == expected(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)


def on_few_axes(seed, n, dims=40):
    """Vectors near a sphere of three axes that lie askew, in groups."""
    random = np.random.default_rng(seed)
    axes = np.linalg.qr(random.normal(size=(dims, dims)))[0][:3]
    centers = random.normal(size=(n, 3))
    near = np.repeat(centers, 3, axis=0) + random.normal(size=(3 * n, 3)) * 0.04
    return (near @ axes + random.normal(size=(3 * n, dims)) * 0.01).tolist()


@pytest.mark.parametrize("block_dims", [4, 16])
def test_range_join_on_grids_against_all_pairs(spark, space, monkeypatch, block_dims):
    monkeypatch.setattr(embeddings, "BLOCK_DIMS", block_dims)
    rows = list(enumerate(on_few_axes(3, 250)))
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    layouts, made = [], embeddings.Layout
    monkeypatch.setattr(embeddings, "Layout", lambda *given: layouts.append(made(*given)) or layouts[-1])
    found = embeddings.near_duplicates(df, space, cosine=0.995, cell_rows=25).collect()
    assert max(grid for *_, grid in layouts[0].blocks) >= 2
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in found) == expected(rows, 0.995, float)


def test_grids_leave_few_pairs_of_a_block():
    units = embeddings.unit_rows(pd.Series(on_few_axes(4, 3000)), 40)
    variances, axes = np.linalg.eigh(np.cov(units.T))
    layout = embeddings.Layout(variances[::-1], len(units), 0.995, 200)
    places, cells = embeddings.rotated(units, axes[:, ::-1]), Counter()
    for block, _, cell, home in embeddings.visits(places, layout):
        for key, at_home in zip(map(tuple, cell), home, strict=True):
            cells[block, key, True] += int(at_home)
            cells[block, key, False] += 1
    compared = Counter()
    for (block, key, homes), n in cells.items():
        if homes:
            compared[block] += n * cells[block, key, False]
    assert compared[0] < 0.1 * len(units) ** 2


def test_doubles_are_not_rounded(spark, space):
    def at(c):
        return [c, (1 - c * c) ** 0.5]

    # by 1e-9 inside and outside of the threshold; in single precision both are 0.9 less 2e-8
    rows = [(1, [1.0, 0.0]), (2, at(0.9 + 1e-9)), (11, [0.0, -1.0]), (12, [(1 - (0.9 - 1e-9) ** 2) ** 0.5, -(0.9 - 1e-9)])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_duplicates(df, space).collect()}
    assert found == {1: (1, 1), 2: (1, 1), 11: (0, 11), 12: (0, 12)}


def test_hot_vector_repeated_rows_and_empty_table(spark, space):
    rows = [(k % 90, [1.0, 2.0, 3.0], 1) for k in range(100)] + [(500, [1.0, 2.0, 3.01], 2), (501, [-3.0, 0.0, 1.0], 2)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, n_links int")
    found = embeddings.near_duplicates(df, space).collect()
    assert len(found) == 102
    assert all((r.n_links, r.component_id) == ((0, 501) if r.vec_id == 501 else (100, 0)) for r in found)
    assert embeddings.near_duplicates(df.limit(0), space).count() == 0


def test_components_of_paths_stars_and_cycles(spark, space):
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, k) for k in range(2, 40)] + [(k, 500 + k % 7) for k in range(200, 260)]
    edges += [(70, 71), (71, 72), (72, 70), (80, 80)]
    found = components(spark.createDataFrame(edges, "a bigint, b bigint"), space)
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        root[max(find(a), find(b))] = min(find(a), find(b))
    assert {r.node: r.component for r in found.collect()} == {x: find(x) for x in root if find(x) != x}
    assert components(spark.createDataFrame([], "a bigint, b bigint"), space).count() == 0
