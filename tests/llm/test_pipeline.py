import random
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from garimpo.llm import common, queries, quality
from garimpo.llm.common import BATCH_ROWS
from garimpo.session import fresh_path

from . import brute


@pytest.fixture(scope="module")
def folder(spark):
    rng = random.Random(11)
    base = [brute.sentence(rng, 80) for _ in range(6)]
    item = brute.sentence(rng, 30)
    rows, labels = [], []
    for i in range(240):
        text, good = brute.sentence(rng, rng.randint(20, 90)), 1
        if i % 6 == 0:
            text, good = " ".join(w.upper() + "!!" for w in text.split(" ")), 0
        elif i % 6 == 1:
            words = base[i % 5].split(" ")
            words[rng.randrange(80)] = "edit"
            text = " ".join(words)
        elif i % 30 == 2:
            text = text + " " + item
        rows.append((i, text, rng.choice(["a", "b", "c"])))
        labels.append((i, good, 0))
    rows += [(300, None, "a"), (301, "", None), (302, "few words", "b")]
    top = fresh_path(spark, "tables")
    brute.documents(spark, rows).write.parquet(f"{top}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{top}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{top}/benchmark.parquet")
    return top


def test_every_stage_takes_effect_on_what_the_one_before_kept(spark, folder):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_dedup", "decontaminate", "mix", "tokens"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = [(r.doc_id, r.text, r.source) for r in docs.collect()]
        docs = stage(spark, docs, folder)
        assert docs.columns == columns
        path = fresh_path(spark, "stage")
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        after = [r.doc_id for r in docs.collect()]
        kept[name] = (before, after)
    before, after = kept["quality"]
    assert not [i for i in after if i % 6 == 0 and i < 300 and brute.held_out(i) is False]
    clean = [i for i, _, _ in before if i < 300 and i % 6]
    assert len(set(clean) & set(after)) >= 0.97 * len(clean)
    before, after = kept["near_dedup"]
    assert sorted(after) == sorted(r[0] for r in brute.near(before) if r[3])
    before, after = kept["decontaminate"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    assert sorted(after) == sorted(r[0] for r in brute.contaminated(before, items) if not r[5])
    before, after = kept["mix"]
    words = {i: len(brute.BLANK.findall(t or "")) for i, t, _ in before}
    assert sum(words[i] for i in after) == pytest.approx(1.5 * sum(words.values()), rel=0.03)
    assert max(np.unique(after, return_counts=True)[1]) == 2
    tokens = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert sorted(r.doc_id for r in tokens) == sorted(after)
    assert sum(r.n_tokens for r in tokens) == max(r.start + r.n_tokens for r in tokens)


def test_near_dedup_stage_keeps_a_row_of_every_component_whatever_its_id(spark):
    rng = random.Random(3)
    a, b, c, d = (brute.sentence(rng, 60) for _ in range(4))
    rows = [(1, a), (1, b), (1, b), (2, b), (3, a + " "), (None, c), (None, d), (None, d), (9, d), (4, ""), (None, None), (None, " ")]
    docs = brute.documents(spark, rows)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    assert got == sorted([(1, a), (1, b), (None, c), (9, d), (4, ""), (None, None), (None, " ")], key=repr)


def test_run_applies_all_stages(spark, folder):
    got = corpus_pipeline.run(spark, folder)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and got.count() > 100


def test_workers_get_few_documents_at_once_and_give_memory_back(spark, folder, monkeypatch):
    seen, stages = [], []
    before = spark.conf.get(BATCH_ROWS, None)
    for name, stage in corpus_pipeline.STAGES:
        stages.append((name, lambda s, d, f, stage=stage: seen.append(s.conf.get(BATCH_ROWS)) or stage(s, d, f)))
    monkeypatch.setattr(corpus_pipeline, "STAGES", stages)
    corpus_pipeline.run(spark, folder)
    assert seen == ["1000"] * 5 and spark.conf.get(BATCH_ROWS, None) == before

    freed = []
    monkeypatch.setattr(common.ctypes, "CDLL", lambda _: SimpleNamespace(malloc_trim=freed.append))
    assert list(common.lean(iter)([1, 2])) == [1, 2] and freed == [0]


def test_registered_queries_name_every_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)


def test_sql_agrees_on_the_smallest_tables(spark):
    import oracle

    from tests.conftest import DATA

    con = oracle.duck(DATA)
    for name, sql in queries.ORACLE_SQL.items():
        assert oracle.compare(queries.QUERIES[name](spark, DATA), con, sql) is None, name
