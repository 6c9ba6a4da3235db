"""The index finds what a scan finds, reads no texts and skips blocks."""

import random

from garimpo.operators import notices, text_index


def _texts(spark, rows):
    return spark.createDataFrame(rows, "id long, text string")


def _both(spark, df, terms, k, path, block=16):
    text_index.write_index(df, "id", "text", path, block)
    got = [tuple(r) for r in text_index.search_index(spark, path, terms, k).collect()]
    want = [tuple(r) for r in notices.search(df, "id", "text", sorted(set(terms)), k).collect()]
    return got, want


def _corpus(n=600, seed=5):
    rng = random.Random(seed)
    words = ["edital", "preço", "obra", "lote", "item", "água", "x1"]
    return [(i, " ".join(rng.choices(words, k=rng.choice([1, 3, 8, 20, 90])))) for i in range(n)]


def test_same_ranking_as_a_scan(spark, folder):
    df = _texts(spark, _corpus() + [(9001, None), (9002, ""), (9003, "  ,;"), (None, "edital " * 200)])
    for k in (1, 20, 5000):
        got, want = _both(spark, df, ["edital", "água"], k, f"{folder}/i{k}")
        assert got == want
        assert got[0] == (None, 200)


def test_ties_repeated_terms_and_case(spark, folder):
    df = _texts(spark, [(i, "Obra lote") for i in range(50)])
    got, want = _both(spark, df, ["OBRA", "lote"], 7, f"{folder}/i", block=4)
    assert got == want == [(i, 2) for i in range(7)]
    assert [tuple(r) for r in text_index.search_index(spark, f"{folder}/i", ["obra", "OBRA"], 2).collect()] == [(0, 1), (1, 1)]


def test_nothing_to_find(spark, folder):
    got, want = _both(spark, _texts(spark, _corpus(40)), ["absent"], 5, f"{folder}/i")
    assert got == want == []
    assert text_index.search_index(spark, f"{folder}/i", [], 5).collect() == []
    empty, _ = _both(spark, _texts(spark, []), ["edital"], 5, f"{folder}/e")
    assert empty == []


def test_blocks_of_short_texts_are_skipped(spark, folder):
    text_index.write_index(_texts(spark, _corpus(1500)), "id", "text", f"{folder}/i", 16)
    index = spark.read.parquet(f"{folder}/i")
    every = text_index.block_bounds(index, ["edital"]).count()
    read = text_index.blocks_to_read(index, ["edital"], 10).count()
    assert read < 0.5 * every
    assert index.agg({"texts": "max"}).first()[0] <= 4 * 16


def test_plan_reads_maxima_without_postings_and_pushes_terms(spark, folder):
    text_index.write_index(_texts(spark, _corpus(100)), "id", "text", f"{folder}/i", 16)
    index = spark.read.parquet(f"{folder}/i")
    plan = text_index.block_bounds(index, ["edital", "obra"])._jdf.queryExecution().executedPlan().toString()
    assert "postings" not in plan
    assert "PushedFilters: [In(term" in plan
