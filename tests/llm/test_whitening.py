from fractions import Fraction
from math import floor

import numpy as np
import pytest

from monthmill.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>, label int, x string, component int, `a.b` int"


def frame(spark, rows):
    return spark.createDataFrame([(k, v, 1, "x", 7, 2) for k, v in rows], SCHEMA)


def expected(rows):
    """By exact fractions and the library's solver."""
    good = [(k, np.asarray(v, np.float32).astype(float)) for k, v in rows
            if v is not None and len(v) and None not in v and np.isfinite(np.asarray(v, float)).all()]
    x = [[floor(1024 * c) + 100000 for c in v.tolist()] for _, v in good]
    n, width = len(x), len(x[0])
    sums = [sum(row[d] for row in x) for d in range(width)]
    mean = [Fraction(s, n) for s in sums]
    centred = [[row[d] - mean[d] for d in range(width)] for row in x]
    v = np.array([[float(sum(r[i] * r[j] for r in centred) / n) for j in range(width)] for i in range(width)])
    values, vectors = np.linalg.eigh(v)
    order = np.argsort(-values)
    values, vectors = values[order], vectors[:, order]
    out = {}
    for (key, _), row, c in zip(good, x, centred, strict=True):
        deviation = sum((n * a - s) ** 2 for a, s in zip(row, sums, strict=True))
        w = np.array([float(y) for y in c]) @ vectors / np.sqrt(np.maximum(values, 1e-300))
        for k in range(min(8, width)):
            if values[k] > 1e-10 * values.sum():
                out[key, k + 1] = (n, deviation, w[k], values[k] / values.sum())
    return out


def check(found, wanted):
    got = {(r.vec_id, r.component): r for r in found}
    assert got.keys() == wanted.keys() and len(got) == len(found)
    sign = {}
    for key, row in got.items():
        n, deviation, w, share = wanted[key]
        assert (row.n, int(row.deviation)) == (n, deviation)
        assert row.explained == pytest.approx(share, rel=1e-9)
        assert 0 <= row.identity_error < 1e-9
        side = sign.setdefault(key[1], 1 if abs(w) < 1e-6 else np.sign(w * row.whitened))
        assert side * row.whitened == pytest.approx(w, abs=1e-6)


def test_against_exact_fractions(spark, space):
    random = np.random.default_rng(5)
    mix = random.normal(size=(12, 12)) * np.linspace(1, 0.05, 12)
    rows = [(k, (random.normal(size=12) @ mix).tolist()) for k in range(90)]
    rows += [(3, rows[3][1][:]), (901, None), (902, []), (903, [float("nan")] * 12), (904, [1.0, None] * 6), (905, [float("inf")] * 12)]
    rows = [(k if k != 3 or i < 90 else 906, v) for i, (k, v) in enumerate(rows)]
    check(whitening.whiten(frame(spark, rows), space).collect(), expected(rows))


def test_given_vectors(spark, space, given):
    vectors = given("embeddings")
    rows = [(r.vec_id, r.embedding) for r in vectors.limit(150).collect()]
    check(whitening.whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"), space).collect(), expected(rows))
    whole = whitening.whiten(vectors, space)
    assert whole.count() == 8 * vectors.count()


def test_spectra_with_equal_tiny_and_negative_eigenvalues():
    random = np.random.default_rng(1)
    for values in ([5.0] * 6, [1, 1, 1, 2, 2, 9], [0, 0, 0, 1e-9, 1, 1e6], list(range(-3, 4)), [1, 1 + 1e-9, 1 - 1e-9, 3],
                   [0.0], [1, -1], np.geomspace(1e-8, 1e8, 40), [2.0, 1.0, 0.0]):
        size = len(values)
        axes, _ = np.linalg.qr(random.normal(size=(size, size)))
        matrix = axes * np.asarray(values, float) @ axes.T
        matrix = (matrix + matrix.T) / 2
        found, vectors = whitening.spectrum(matrix)
        scale = max(1e-300, np.abs(values).max())
        assert np.allclose(found, np.sort(values)[::-1], atol=1e-13 * scale * size)
        assert np.allclose(vectors.T @ vectors, np.eye(size), atol=1e-13 * size)
        assert np.allclose(matrix @ vectors, vectors * found, atol=1e-12 * scale * size)


def test_axes_come_from_polar_factors(monkeypatch):
    """Without the split by the polar factor there are no components."""
    matrix = np.diag([4.0, 1.0]) + 0.5
    monkeypatch.setattr(whitening, "polar", lambda m: np.zeros_like(m))
    values, _ = whitening.spectrum(matrix)
    assert not np.allclose(values, np.linalg.eigvalsh(matrix)[::-1])


def test_large_numbers_stay_exact(spark, space):
    rows = [(k, [float(1000003 * (k % 7)), -3.5e5 * k, 0.25 * k]) for k in range(40)]
    found = whitening.whiten(frame(spark, rows), space).collect()
    wanted = expected(rows)
    assert {(r.vec_id, r.component): int(r.deviation) for r in found} == {k: v[1] for k, v in wanted.items()}
    assert max(v[1] for v in wanted.values()) > 2**63


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (None, [1.0, 2.0])]])
def test_tables_without_variance(spark, space, rows):
    found = whitening.whiten(frame(spark, rows), space)
    assert found.columns[:2] == ["vec_id", "component"] and found.count() == 0


def test_few_dimensions_null_ids_and_mixed_lengths(spark, space):
    rows = [(None, [1.0, 5.0]), (2, [2.0, 5.0]), (2, [2.0, 5.0])]
    found = whitening.whiten(frame(spark, rows), space).collect()
    assert [r.component for r in found] == [1, 1, 1] and {r.vec_id for r in found} == {None, 2}
    with pytest.raises(ValueError, match="entries"):
        whitening.whiten(frame(spark, [(1, [1.0]), (2, [1.0, 2.0])]), space)
