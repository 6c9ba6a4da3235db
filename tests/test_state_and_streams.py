from datetime import datetime

import pytest
from pyspark.sql import functions as F

from garimpo.operators import dedupe
from garimpo.operators.state import StateTable, state_summary
from garimpo.sources.lake import read_table
from garimpo.streaming.ingest import Ingest, bounded_distinct, ingest_batch, landing_stream, run_stream

DAY = datetime(2025, 10, 22, 15)


def _records(spark, ids, day=DAY):
    rows = [(i, day, n) for n, i in enumerate(ids)]
    return spark.createDataFrame(rows, "id string, at timestamp_ntz, pos int")


def _job(spark, base, **kw):
    return Ingest(spark, base, "pncp", "id", "at", ("pos",), **kw)


def test_three_runs_of_a_day(spark, folder):
    job = _job(spark, folder)
    seen = []
    for n, ids in enumerate([["1", "2", "3"], ["1", "2", "3", "4", "5"], ["1", "2", "3", "4", "5"]]):
        batch = _records(spark, ids)
        known = job.state.ids("pncp", date="2025-10-22")
        stats = dedupe.filter_stats(dedupe.flag_new(batch, F.col("id"), known, "new"), "new", F.col("id")).first()
        seen.append((stats.new_records, stats.already_processed, stats.filter_rate))
        ingest_batch(job, batch, f"run{n}")
    assert seen == [(3, 0, 0.0), (2, 3, 60.0), (0, 5, 100.0)]
    assert job.state.ids("pncp").count() == 5
    assert read_table(spark, f"{folder}/pncp").count() == 5
    summary = state_summary(job.state.ids("pncp"), job.state.runs()).first()
    assert (summary.total_processed, summary.total_executions, summary.total_new) == (5, 3, 5)


def test_missing_ids_and_duplicates(spark, folder):
    batch = _records(spark, ["a", "a", None, "", "b"])
    flagged = dedupe.flag_new(batch, F.col("id"), _records(spark, ["b"]).select("id"), "new")
    row = dedupe.filter_stats(flagged, "new", F.col("id")).first()
    # Duplicates inside the batch pass; rows without id count as processed and show on their own.
    assert (row.total_input, row.new_records, row.already_processed, row.missing_id) == (5, 2, 3, 2)
    assert [r.id for r in dedupe.dedupe_batch(batch, "id", ["pos"]).orderBy("id").collect()] == ["a", "b"]
    parity, clean = _job(spark, folder + "/p", dedupe=False), _job(spark, folder + "/c")
    for job in (parity, clean):
        ingest_batch(job, batch, "r")
    assert read_table(spark, folder + "/p/pncp").count() == 3
    assert read_table(spark, folder + "/c/pncp").count() == 2


def test_state_is_scoped_to_day_and_source(spark, folder):
    job = _job(spark, folder)
    ingest_batch(job, _records(spark, ["1"]), "r1")
    ingest_batch(job, _records(spark, ["1"], datetime(2025, 10, 23, 15)), "r2")
    assert job.state.ids("pncp").count() == 2
    assert job.state.ids("other").count() == 0
    # 02:00 UTC is still the day before in Sao Paulo, so the id is known there.
    ingest_batch(job, _records(spark, ["1"], datetime(2025, 10, 23, 2)), "r3")
    assert job.state.ids("pncp").count() == 2


def test_repeating_a_failed_run_changes_nothing(spark, folder, monkeypatch):
    job = _job(spark, folder)
    ingest_batch(job, _records(spark, ["1"]), "r0")
    real = StateTable.add
    monkeypatch.setattr(StateTable, "add", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        ingest_batch(job, _records(spark, ["1", "2", "3"]), "r1")
    monkeypatch.setattr(StateTable, "add", real)
    for _ in range(2):
        ingest_batch(job, _records(spark, ["1", "2", "3"]), "r1")
    assert sorted(r.id for r in read_table(spark, f"{folder}/pncp").collect()) == ["1", "2", "3"]
    assert sorted(r.id for r in job.state.ids("pncp").collect()) == ["1", "2", "3"]
    assert job.state.runs().count() == 2


def test_log_needs_required_fields(spark, folder):
    with pytest.raises(ValueError):
        StateTable(spark, folder).log(spark.sql("SELECT 'x' source, 'r' run"))


def test_stream_equals_batch_on_shuffled_files(spark, folder):
    events = spark.range(400).select(
        F.concat(F.lit("u"), (F.col("id") % 23).cast("string")).alias("id"),
        (F.timestamp_seconds(F.lit(1704110400) + F.col("id") * 3607)).cast("timestamp_ntz").alias("at"),
        F.col("id").cast("int").alias("pos"))
    events.orderBy(F.xxhash64("pos")).repartition(5).write.parquet(f"{folder}/landing")
    job = _job(spark, f"{folder}/lake")
    stream = landing_stream(spark, f"{folder}/landing", events.schema, files_per_batch=2)
    run_stream(job, stream, f"{folder}/checkpoint")
    got = {(r.year + r.month + r.day, r.id) for r in read_table(spark, f"{folder}/lake/pncp").collect()}
    local = F.date_format(F.convert_timezone(F.lit("UTC"), F.lit("America/Sao_Paulo"), "at"), "yyyyMMdd")
    want = {(r.d, r.id) for r in events.select(local.alias("d"), "id").distinct().collect()}
    assert got == want
    assert read_table(spark, f"{folder}/lake/pncp").count() == len(want)
    # Nothing new arrived: a second start finds no batch.
    run_stream(job, landing_stream(spark, f"{folder}/landing", events.schema), f"{folder}/checkpoint")
    assert read_table(spark, f"{folder}/lake/pncp").count() == len(want)


def test_bounded_distinct_needs_order_but_dedupes(spark, folder):
    rows = _records(spark, ["a", "a", "b"]).unionAll(_records(spark, ["a"], datetime(2025, 10, 23, 15)))
    rows.coalesce(1).write.parquet(f"{folder}/in")
    stream = landing_stream(spark, f"{folder}/in", rows.schema)
    query = (bounded_distinct(stream, "id", "at", "1 day").writeStream.format("parquet")
             .option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start(f"{folder}/out"))
    query.awaitTermination()
    assert spark.read.parquet(f"{folder}/out").count() == 3


def test_resume_batch(spark):
    batch = _records(spark, list("edcba"))
    done = _records(spark, ["d"]).select("id")
    got = [r.id for r in dedupe.resume_batch(batch, F.col("id"), done, ["pos"], batch_size=2).orderBy("pos").collect()]
    assert got == ["e", "c"]
    assert dedupe.resume_batch(batch, F.col("id"), done, ["pos"]).count() == 4
    assert dedupe.resume_batch(batch, F.col("id"), done, ["pos"], max_records=3).count() == 3


def test_a_second_checkpoint_loses_nothing(spark, folder):
    job = _job(spark, f"{folder}/lake")
    for n, ids in enumerate((["1", "2"], ["2", "3"])):
        _records(spark, ids).coalesce(1).write.parquet(f"{folder}/in{n}")
        stream = landing_stream(spark, f"{folder}/in{n}", _records(spark, []).schema)
        run_stream(job, stream, f"{folder}/checkpoint{n}")
    assert sorted(r.id for r in read_table(spark, f"{folder}/lake/pncp").collect()) == ["1", "2", "3"]
    assert sorted(r.id for r in job.state.ids("pncp").collect()) == ["1", "2", "3"]
    assert job.state.runs().select("run").distinct().count() == 2


def test_detail_types_stay_apart(spark, folder):
    jobs = [_job(spark, folder, detail_type=kind) for kind in ("itens", "arquivos")]
    for job in jobs:
        ingest_batch(job, _records(spark, ["1", "2"]), "daily")
    for job in jobs:
        assert read_table(spark, f"{folder}/{job.table}").count() == 2
        assert job.state.ids("pncp", job.detail_type).count() == 2
    assert jobs[0].state.runs().count() == 2


def test_records_without_a_time_are_kept(spark, folder):
    job = _job(spark, folder)
    batch = _records(spark, ["1", "2"]).unionAll(_records(spark, ["3", "3"], None))
    for run in ("a", "b"):
        ingest_batch(job, batch, run)
    table = read_table(spark, f"{folder}/pncp")
    assert sorted((r.id, r.day) for r in table.collect()) == [("1", "22"), ("2", "22"), ("3", None)]
    logged = {(r.run, r.date): (r.input_rows, r.new_rows, r.undated_rows) for r in job.state.runs().collect()}
    assert logged == {("a", "2025-10-22"): (2, 2, 0), ("a", "undated"): (2, 1, 2),
                      ("b", "2025-10-22"): (2, 0, 0), ("b", "undated"): (2, 0, 2)}


def test_merged_state_keeps_first_runs_and_repeats(spark, folder):
    job = _job(spark, folder)
    for run, ids in (("a", ["1"]), ("b", ["1", "2"]), ("c", ["3"])):
        ingest_batch(job, _records(spark, ids), run)
    assert job.state.merge_runs("pncp") == 3
    held = {r.id: r.first_run for r in job.state.ids("pncp").collect()}
    assert held == {"1": "a", "2": "b", "3": "c"}
    assert job.state.ids("pncp").select("run").distinct().count() == 1 and job.state.merge_runs("pncp") == 0
    # A repeated run still does not count its own ids as known.
    assert {r.id for r in job.state.ids("pncp", before_run="c").collect()} == {"1", "2"}
