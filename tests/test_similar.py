"""Exact top k with pivots: equal to all pairs, and few pairs scored where vectors form groups."""

import math

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from garimpo.functions.vectors import cosine_similarity
from garimpo.operators import similar


def _frame(spark, vectors):
    rows = [(i, None if v is None else [float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "id long, v array<double>")


def _wanted(vectors, probes, k):
    out = {}
    for p in probes:
        scored = []
        for i, v in enumerate(vectors):
            if i != p and v is not None and np.linalg.norm(v) > 0:
                cos = float(np.dot(v, vectors[p]) / (np.linalg.norm(v) * np.linalg.norm(vectors[p])))
                scored.append((-round(cos, 9), i))
        out[p] = [i for _, i in sorted(scored)[:k]]
    return out


def _got(found):
    out = {}
    for r in sorted(found.collect(), key=lambda r: (r.probe, r["rank"])):
        out.setdefault(r.probe, []).append(r.id)
    return out


def test_pruned_answers_are_exact_and_score_few_pairs(spark):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((40, 12))
    vectors = list(centres[rng.integers(0, 40, 1200)] + 0.02 * rng.standard_normal((1200, 12)))
    vectors += [None, np.zeros(12)]
    base = _frame(spark, vectors)
    probes = base.where("id % 40 = 0")
    asked = [i for i in range(1200) if i % 40 == 0]
    assert _got(similar.similar_batch(base, "id", "v", probes, k=3, sample=400)) == _wanted(vectors, asked, 3)
    scored = similar.candidates(base, "id", "v", probes, k=3, sample=400).count()
    assert scored < 0.3 * 1200 * len(asked)


def test_vectors_without_structure_and_many_blocks(spark, monkeypatch):
    vectors = list(np.random.default_rng(4).standard_normal((150, 6)))
    base = _frame(spark, vectors)
    probes = base.where("id % 5 = 0")
    want = _wanted(vectors, [i for i in range(150) if i % 5 == 0], 10)
    assert _got(similar.similar_batch(base, "id", "v", probes, block=7)) == want
    monkeypatch.setattr(similar, "BROADCAST_BYTES", 0)
    assert _got(similar.similar_batch(base, "id", "v", probes, block=7)) == want


def test_few_records_and_no_probes(spark):
    base = _frame(spark, [[1.0, 0.0], [0.0, 1.0], [1.0, 1.0]])
    assert _got(similar.similar_batch(base, "id", "v", base.where("id = 0"))) == {0: [2, 1]}
    assert similar.similar_batch(base, "id", "v", base.where("id < 0")).count() == 0
    found = similar.similar_batch(base, "id", "v", base.where("id = 2")).collect()
    assert [round(r.similarity, 9) for r in found] == [round(math.sqrt(0.5), 9)] * 2


def test_tiles_hand_on_few_pairs_and_score_like_the_expression(spark, monkeypatch):
    rng = np.random.default_rng(5)
    vectors = rng.standard_normal((300, 6)).tolist()
    # Copies tie by id; zero, short, huge and non-finite vectors and those with a null in them.
    vectors += [vectors[0]] * 40 + [[0.0] * 6, [1.0, 2.0], [2.0, 1.0], [1e200] * 6, [1e-170] * 6, [float("nan")] * 6,
                                    [float("inf")] + [1.0] * 5, [None] + [1.0] * 5, []]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)] + [(None, vectors[1]), (7, vectors[8])], "id long, v array<double>")
    probes = df.where("id % 5 = 0 or id > 335")
    one, two = df.alias("a"), probes.alias("b")
    every = two.join(one, F.col("a.id") != F.col("b.id")).select(
        F.col("b.id").alias("probe"), F.col("a.id").alias("id"), cosine_similarity(F.col("a.v"), F.col("b.v")).alias("similarity"))
    every = every.where("similarity is not null")
    rank = F.row_number().over(Window.partitionBy("probe").orderBy(F.desc("similarity"), "id"))
    want = every.withColumn("rank", rank).where("rank <= 4").orderBy("probe", "rank").collect()
    monkeypatch.setattr(similar, "RECORD_BLOCK", 100)
    for block in (9, 1000):
        got = similar.similar_batch(df, "id", "v", probes, k=4, block=block).orderBy("probe", "rank").collect()
        assert [str(r) for r in got] == [str(r) for r in want]
    pairs = similar.candidates(df, "id", "v", probes, k=4).count()
    assert pairs <= 4 * 4 * probes.count() < every.count() / 4
