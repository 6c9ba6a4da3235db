import math
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from garimpo.llm import multi_index as M

finite = st.floats(0, 100).map(lambda x: round(x, 1))


@settings(max_examples=100, deadline=None)
@given(st.lists(finite, min_size=1, max_size=7), st.lists(finite, min_size=1, max_size=7))
def test_pairs_come_by_growing_distance_and_each_once(a, b):
    got = list(M.traversal(np.array(a), np.array(b)))
    assert sorted((i, j) for _, i, j in got) == [(i, j) for i in range(len(a)) for j in range(len(b))]
    assert all(d == a[i] + b[j] for d, i, j in got)
    assert [d for d, _, _ in got] == sorted(d for d, _, _ in got)


def table(spark, rows):
    rows = [(i, v and [None if c is None else float(c) for c in v], "x") for i, v in rows]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    for name in ("v", "h", "ids", "q", "own", "i", "j", "rank", "score", "query_id", "bound", "e", "b"):
        frame = frame.withColumn(name, frame.label)
    return frame


def brute(rows, k=5, every=50):
    """{(query id, vector): [(id, score)]} over all rows."""
    sound = [(i, tuple(map(float, v))) for i, v in rows
             if v and all(c is not None and math.isfinite(c) for c in v) and any(v)]
    lengths = [len(v) for _, v in sound]
    usual = max(lengths, key=lambda d: (lengths.count(d), d)) if lengths else 0
    sound = sorted({r for r in sound if len(r[1]) == usual}, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    out = {}
    for i, v in sound:
        if i is None or i % every:
            continue
        scored = [(-float(M.cosines(np.array([v]), np.array([w]))[0]), j is None, j or 0) for j, w in sound if j != i]
        out[i, v] = [(None if null else j, -s) for s, null, j in sorted(scored)[:k]]
    return out


def awkward(rng):
    def near(c, size):
        return [x + rng.gauss(0, size) for x in c]

    centres = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(5)]
    rows = [(i, near(rng.choice(centres), 0.2)) for i in range(0, 600, 2)]
    rows += [(1001 + i, rows[0][1]) for i in range(120)] + [(50 * i, rows[0][1]) for i in range(20, 40)]
    rows += [(3000, rows[3][1]), (3000, rows[3][1]), (3000, rows[4][1]), (None, rows[5][1]), (None, rows[25][1]), (None, None)]
    rows += [(3001, [2 * c for c in rows[25][1]]), (3050, None), (3100, []), (3150, [0.0] * 8), (3200, [math.nan] * 8),
             (3250, [1.0, None] * 4), (3300, [math.inf] * 8), (3350, [1.0, 2.0]), (3400, [1e300] + [0.0] * 7), (3450, [1e-310] * 8)]
    rng.shuffle(rows)
    return rows


def collected(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return out


def test_all_lists_visited_give_the_exact_answer(spark, monkeypatch):
    monkeypatch.setattr(M, "ENTRY_BLOCK", 17)
    monkeypatch.setattr(M, "QUERY_BLOCK", 3)
    rows = awkward(random.Random(11))
    want = brute(rows)
    got = collected(M.nearest(table(spark, rows), centroids=4, first=1 << 40))
    assert got.keys() == {i for i, _ in want}
    for i in got:
        expected = sorted((n + 1, j, s) for (q, _), found in want.items() if q == i for n, (j, s) in enumerate(found))
        assert [(n, j) for n, j, _ in sorted(got[i], key=str)] == [(n, j) for n, j, _ in sorted(expected, key=str)], i
        assert [s for *_, s in sorted(got[i], key=str)] == pytest.approx([s for *_, s in sorted(expected, key=str)], abs=1e-15)


def test_two_passes_find_nearly_all(spark):
    rng = np.random.default_rng(7)
    for spread in (0.3, 100.0):
        centres = rng.standard_normal((20, 16))
        vectors = centres[rng.integers(0, 20, 1500)] + spread * rng.standard_normal((1500, 16))
        rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
        want = brute(rows)
        got = collected(M.nearest(table(spark, rows), first=60))
        hits = sum(len({j for _, j, _ in got[q]} & {j for j, _ in found}) for (q, _), found in want.items())
        assert hits >= 0.9 * 5 * len(want)
        assert all(len(found) == 5 and [n for n, *_ in found] == [1, 2, 3, 4, 5] for found in got.values())


def test_clustered_vectors_visit_few_lists():
    rng = np.random.default_rng(8)
    vectors = np.repeat(rng.standard_normal((200, 32)), 20, axis=0) + 0.05 * rng.standard_normal((4000, 32))
    book = M.Codebook(vectors, 32, M.REACHED, 5)
    points = M.units(vectors)
    i, j = book.cells(points)
    first, second = book.distances(points[:100])
    within = first[:, i] + second[:, j] <= 2 - 2 * np.sort(points[:100] @ points.T, axis=1)[:, -6][:, None] + book.margin
    assert within.mean() < 0.05


def test_few_candidates_and_empty_tables(spark):
    assert M.nearest(table(spark, [])).count() == 0
    assert M.nearest(table(spark, [(0, None), (50, [0.0, 0.0])])).count() == 0
    assert M.nearest(table(spark, [(0, [1.0, 0.0])])).count() == 0
    assert M.nearest(table(spark, [(1, [1.0, 0.0]), (2, [1.0, 1.0])])).count() == 0
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 2.0]), (None, [1.0, 0.0]), (0, [1.0, 0.0]), (50, [-1.0])]
    assert collected(M.nearest(table(spark, rows))) == {0: [(1, 1, 1.0), (2, None, 1.0), (3, 2, 0.0)]}


def test_cosines_do_not_overflow():
    a = np.array([[1e300, 1e300], [1e-310, 0], [3, 4]])
    assert M.cosines(a, a) == pytest.approx([1, 1, 1], abs=1e-15)
    assert pa.array(M.cosines(a, -a)).to_pylist() == pytest.approx([-1, -1, -1], abs=1e-15)
