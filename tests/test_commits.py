"""Commit log: whole runs only, exclusive numbers, conflicts, folding, and odd names."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from garimpo.operators import maintain
from garimpo.operators.commits import CommitLog, Conflict, folder_value
from garimpo.operators.state import StateTable
from garimpo.streaming.ingest import Ingest, ingest_batch

DAY = datetime(2025, 10, 22, 15)


def _batch(spark, ids, day=DAY):
    return spark.createDataFrame([(i, day, n) for n, i in enumerate(ids)], "id string, at timestamp_ntz, pos int")


def _job(spark, base, source="pncp"):
    return Ingest(spark, base, source, "id", "at", ("pos",))


def _ids(job):
    return sorted(r.id for r in job.read().collect())


def test_numbers_are_taken_once_and_replacements_conflict(spark, folder):
    one, two = CommitLog(spark, folder), CommitLog(spark, folder)
    assert one.live() == [] and not one.published("a")
    assert one.publish("a", ["t/x", "t/y"]) == 1
    assert two._create(1, "b", [("add", "t/z")]) is False
    assert two.publish("b", ["u/z"]) == 2
    assert one.live("t") == ["t/x", "t/y"] and two.live() == ["t/x", "t/y", "u/z"]
    assert one.publish("c", ["t/xy"], ["t/x", "t/y"]) == 3
    with pytest.raises(Conflict):
        two.publish("d", ["t/other"], ["t/x"])
    assert two.live("t") == ["t/xy"] and two.published("c") and not two.published("d")
    assert two.fold() == 4
    fresh = CommitLog(spark, folder)
    assert fresh.live() == ["t/xy", "u/z"] and all(fresh.published(k) for k in "abc")
    fresh.vacuum(older_than_seconds=0)
    again = CommitLog(spark, folder)
    assert again._numbers() == [4] and again.live() == ["t/xy", "u/z"] and again.published("a")
    assert again.publish("e", ["t/new"]) == 5


def test_a_log_folds_itself(spark, folder, monkeypatch):
    monkeypatch.setattr("garimpo.operators.commits.FOLD_EVERY", 3)
    log = CommitLog(spark, folder)
    for n in range(7):
        log.publish(f"k{n}", [f"t/{n}"])
    assert [len(log._read[n]) for n in (4, 7)] == [1 + 3 + 3, 1 + 5 + 5]
    assert CommitLog(spark, folder).live() == [f"t/{n}" for n in range(7)]


@pytest.mark.parametrize("broken", ["add", "log"])
def test_a_broken_run_is_not_seen_and_not_known(spark, folder, monkeypatch, broken):
    job = _job(spark, folder)
    ingest_batch(job, _batch(spark, ["1"]), "r0")
    real = getattr(StateTable, broken)
    monkeypatch.setattr(StateTable, broken, lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        ingest_batch(job, _batch(spark, ["1", "2", "3"]), "r1")
    monkeypatch.setattr(StateTable, broken, real)
    assert _ids(job) == ["1"] and job.state.ids("pncp").count() == 1 and job.state.runs().count() == 1
    # Another run finds the same rows new, for the broken one has said nothing.
    ingest_batch(job, _batch(spark, ["2", "3", "4"]), "r2")
    assert _ids(job) == ["1", "2", "3", "4"]
    # The broken run comes back with what is left of it.
    ingest_batch(job, _batch(spark, ["1", "2", "3"]), "r1")
    ingest_batch(job, _batch(spark, ["9"]), "r1")
    assert _ids(job) == ["1", "2", "3", "4"] and job.state.runs().count() == 3


def test_state_opens_the_days_of_the_batch(spark, folder):
    job = _job(spark, folder)
    days = [datetime(2025, 10, n, 15) for n in (1, 2, 3)]
    for n, day in enumerate(days):
        ingest_batch(job, _batch(spark, ["1", "2"], day), f"r{n}")
    files = job.state.ids("pncp", dates=["2025-10-02"]).inputFiles()
    assert files and all("/date=2025-10-02/" in f for f in files)
    assert job.state.ids("pncp", date="2025-10-03").count() == 2 and job.state.ids("pncp", dates=["2025-11-01"]).count() == 0


def test_compaction_swaps_at_once_and_refuses_a_lost_race(spark, folder):
    job = _job(spark, folder)
    for n in range(3):
        ingest_batch(job, _batch(spark, [str(n), "x"]), f"r{n}")
    path = f"{folder}/{job.table}"
    before = _ids(job)
    old = job.commits.live(job.table)

    class Racing(CommitLog):
        def publish(self, key, adds=(), removes=()):
            assert _ids(job) == before
            CommitLog(self.spark, self.base).publish("other", ["pncp/other"], list(removes)[:1])
            return super().publish(key, adds, removes)

    with pytest.raises(Conflict):
        maintain.compact(spark, path, "id", commits=Racing(spark, folder))
    job.commits.publish("undo", old[:1], ["pncp/other"])
    assert _ids(job) == before
    maintain.compact(spark, path, "id", commits=CommitLog(spark, folder))
    assert _ids(job) == before and len(job.commits.live(job.table)) == 1
    assert job.commits.vacuum(older_than_seconds=3600) == 0
    assert job.commits.vacuum(older_than_seconds=-1) == 3 and _ids(job) == before


def test_names_that_spark_escapes(spark, folder):
    odd = "a:b/c=d%e [f]^{g}#'*?\\\""
    assert folder_value(None) == folder_value("") == "__HIVE_DEFAULT_PARTITION__"
    job = Ingest(spark, folder, "pncp", "id", "at", ("pos",))
    for run in (odd, odd + "2"):
        ingest_batch(job, _batch(spark, ["1", run]), run)
    assert _ids(job) == sorted(["1", odd, odd + "2"]) and job.state.runs().count() == 2
    assert job.state.merge_runs("pncp") == 2 and job.state.ids("pncp").count() == 3
    # A plain state table removes the folders it merged.
    plain = StateTable(spark, f"{folder}/plain")
    for run in (odd, odd + "2"):
        plain.add(spark.createDataFrame([("1", odd), (run, odd)], "id string, date string"), odd, run)
    assert plain.merge_runs(odd) == 2 and plain.ids(odd).select("run").distinct().count() == 1


def test_a_batch_without_rows_or_whose_rows_go(spark, folder):
    job = _job(spark, folder)
    ingest_batch(job, _batch(spark, ["1"]), "r0")
    ingest_batch(job, _batch(spark, []), "empty")
    gone = Ingest(spark, folder, "pncp", "id", "at", ("pos",), transform=lambda df: df.where(F.lit(False)))
    ingest_batch(gone, _batch(spark, ["2"], datetime(2025, 10, 23, 15)), "gone")
    assert _ids(job) == ["1"]
