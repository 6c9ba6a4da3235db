import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from garimpo.llm import spectral, whitening

entries = st.one_of(st.integers(-4, 4).map(float), st.floats(-1e3, 1e3))


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 12).flatmap(lambda n: st.lists(entries, min_size=n * n, max_size=n * n)))
def test_eigen_solves_any_symmetric_matrix(values):
    n = math.isqrt(len(values))
    a = np.array(values).reshape(n, n)
    a = (a + a.T) / 2
    w, v = spectral.eigen(a)
    size = max(np.abs(a).max(), 1e-300)
    assert np.abs(w - np.linalg.eigvalsh(a)[::-1]).max() <= 1e-12 * n * size
    assert np.abs(a @ v - v * w).max() <= 1e-12 * n * size
    assert np.abs(v.T @ v - np.eye(n)).max() <= 1e-12


@pytest.mark.parametrize("spectrum", [
    [0.0] * 30, [7.0] * 30, [1.0] * 15 + [1 + 1e-9] * 15, [5.0] + [0.0] * 29, [10.0 ** -k for k in range(30)],
    list(range(-15, 15)), [1e-300 * k for k in range(30)]])
def test_eigen_on_clustered_and_graded_spectra(spectrum):
    q, _ = np.linalg.qr(np.random.default_rng(5).standard_normal((30, 30)))
    a = q @ np.diag(spectrum) @ q.T
    a = (a + a.T) / 2
    w, v = spectral.eigen(a, 4)
    want = np.sort(np.array(spectrum, float))[::-1]
    size = max(np.abs(want).max(), 1e-300)
    assert w.shape == (4,) and v.shape == (30, 4)
    assert np.abs(w - want[:4]).max() <= 1e-13 * 30 * size and np.abs(a @ v - v * w).max() <= 1e-13 * 30 * size


def test_polar_sign_of_an_ill_conditioned_matrix():
    q, _ = np.linalg.qr(np.random.default_rng(6).standard_normal((20, 20)))
    signs = np.array([1, -1] * 10)
    a = q @ np.diag(signs * 10.0 ** -np.linspace(0, 13, 20)) @ q.T
    u = spectral.polar_sign((a + a.T) / 2)
    assert np.abs(u @ u - np.eye(20)).max() < 1e-12


def table(spark, rows):
    rows = [(i, v and [None if c is None else float(c) for c in v], label) for i, v, label in rows]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    for name in ("v", "x", "d", "n", "part", "row", "component", "whitened"):
        frame = frame.withColumn(name, frame.label)
    return frame


def expected(rows):
    """(n, S, V, kept rows) in plain Python from the contract."""
    kept = [(i, [math.floor(256 * c) for c in v]) for i, v in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]
    lengths = [len(x) for _, x in kept]
    usual = max(lengths, key=lambda d: (lengths.count(d), d)) if lengths else 0
    kept = [k for k in kept if len(k[1]) == usual]
    fit = sorted({tuple(x) for _, x in kept})
    n, total = len(fit), [sum(c) for c in zip(*fit)]
    y = np.array([[c - s / n for c, s in zip(x, total)] for x in fit])
    return n, total, y.T @ y / n if n else None, kept


def agrees(got, rows, components=4):
    n, total, v, kept = expected(rows)
    k = min(components, len(total))
    assert len(got) == k * len(kept)
    values = np.linalg.eigvalsh(v)[::-1][:k]
    trace = np.trace(v)
    fit = sorted({tuple(x) for _, x in kept})
    key = lambda i: (i is None, i)
    deviation = sorted(((i, sum((n * c - s) ** 2 for c, s in zip(x, total))) for i, x in kept), key=lambda t: (key(t[0]), t[1]))
    for c in range(1, k + 1):
        mine = [r for r in got if r.component == c]
        assert sorted(((r.vec_id, r.deviation) for r in mine), key=lambda t: (key(t[0]), t[1])) == deviation
        assert all(r.n == n and r.identity_error <= 1e-4 for r in mine)
        if trace > 0:
            assert all(r.explained == pytest.approx(values[c - 1] / trace, rel=1e-4, abs=1e-12) for r in mine)
        if values[c - 1] > 1e-9 * max(trace, 1e-300):
            assert all(r.whitened is not None for r in mine)
    assert len({r.identity_error for r in got}) <= 1
    return fit, values


def test_rows_follow_the_contract(spark):
    rng = random.Random(12)
    rows = [(i, [rng.gauss(0, 1 + j) / 7 for j in range(6)]) for i in range(150)]
    rows += [(200 + i, rows[0][1]) for i in range(80)] + [(3, rows[5][1]), (3, rows[5][1]), (None, rows[9][1]), (None, [0.25] * 6)]
    rows += [(400, None), (401, []), (402, [1.0, None, 2, 3, 4, 5]), (403, [math.nan] * 6), (404, [math.inf, 1, 1, 1, 1, 1]),
             (405, [1.0, 2.0]), (406, [-0.0] * 6), (407, [1000.5, -9.0, 0, 0, 0, 0])]
    rng.shuffle(rows)
    got = whitening.whitened(table(spark, [(i, v, 1) for i, v in rows])).collect()
    agrees(got, rows)
    n, total, v, kept = expected(rows)
    w, axes = np.linalg.eigh(v)
    for c in range(1, 5):
        axis = axes[:, -c] / math.sqrt(w[-c])
        want = sorted(abs(float((np.array(x) - np.array(total) / n) @ axis)) for _, x in kept)
        assert sorted(abs(r.whitened) for r in got if r.component == c) == pytest.approx(want, abs=1e-9)


def test_few_or_equal_vectors(spark):
    for rows in ([(1, [0.5, 0.25])], [(1, [0.5, 0.25, 1.0])] * 3, [(1, [0.0]), (2, [1.0])],
                 [(i, [float(i % 2), 0.0, 0.0, 0.0, 0.0]) for i in range(6)]):
        got = whitening.whitened(table(spark, [(i, v, 1) for i, v in rows])).collect()
        agrees(got, rows)
        assert all((r.whitened is None) == (r.explained is None or r.explained < 1e-12) for r in got)


def test_empty_tables_and_refused_entries(spark):
    assert whitening.whitened(table(spark, [])).count() == 0
    assert whitening.whitened(table(spark, [(1, None, 1), (2, [math.nan], 1)])).count() == 0
    with pytest.raises(Exception, match="an entry is beyond"):
        whitening.whitened(table(spark, [(1, [1e300], 1)])).collect()


def test_deviations_beyond_a_long_are_null():
    x = np.array([[1 << 40, 0], [1, 2]])
    assert whitening.deviations(x, 1 << 20, [5, 7]) == [None, ((1 << 20) - 5) ** 2 + ((2 << 20) - 7) ** 2]
