import json
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from garimpo.operators import maintain, nested, reports, sinks
from garimpo.sources import lake, pages, registry_files

RECORD = T.StructType([T.StructField("id", T.StringType())])
KEYS = T.StructType([T.StructField("pull", T.StringType()), T.StructField("pagina", T.IntegerType())])


def _land(root: Path, pull: str, page: int, body: str) -> None:
    target = root / f"pull={pull}" / f"pagina={page}"
    target.mkdir(parents=True)
    (target / "page.json").write_text(body, encoding="utf-8")


def _page(ids, left=None):
    doc = {"data": [{"id": i} for i in ids], "totalRegistros": 9, "totalPaginas": 9}
    if left is not None:
        doc["paginasRestantes"] = left
    return json.dumps(doc, indent=1)


def test_page_sequences(spark, tmp_path):
    for page, ids, left in [(1, "ab", 2), (2, "cd", 1), (3, "e", 0), (4, "zz", 0)]:
        _land(tmp_path, "remaining", page, _page(ids, left))
    for page, ids, left in [(1, "fg", 3), (2, "", 2), (3, "h", 0)]:
        _land(tmp_path, "empty", page, _page(ids, left))
    _land(tmp_path, "absent", 1, _page("ij"))
    _land(tmp_path, "absent", 2, _page("k", 0))
    _land(tmp_path, "corrupt", 1, _page("l", 5))
    _land(tmp_path, "corrupt", 2, "{not json")
    _land(tmp_path, "corrupt", 3, _page("m", 0))
    _land(tmp_path, "blank", 1, "")
    landed = pages.read_pages(spark, str(tmp_path), RECORD, KEYS)

    def ids(max_pages=None):
        kept = pages.reachable_pages(landed, ["pull"], "pagina", pages.is_last_page(), max_pages)
        rows = pages.page_rows(kept, ["pull", "pagina"]).orderBy("pull", "pagina", "pos").collect()
        out = {}
        for r in rows:
            out[r.pull] = out.get(r.pull, "") + r.id
        return out

    assert ids() == {"remaining": "abcde", "empty": "fg", "absent": "ij", "corrupt": "l"}
    assert ids(1) == {"remaining": "ab", "empty": "fg", "absent": "ij", "corrupt": "l"}
    assert ids(0) == {}
    assert [r.pull for r in landed.where("corrupt is not null").select("pull", "data", "corrupt").collect()] == ["corrupt"]


def test_child_pages(spark, tmp_path):
    _land(tmp_path, "a", 1, json.dumps([{"id": "1"}, {"id": "2"}]))
    _land(tmp_path, "a", 2, json.dumps({"data": [{"id": "3"}]}))
    _land(tmp_path, "a", 3, json.dumps([{"id": "4"}, {"id": "5"}]))
    _land(tmp_path, "b", 1, "")
    found = pages.read_child_pages(spark, str(tmp_path), RECORD, KEYS)
    kept = pages.reachable_pages(found, ["pull"], "pagina", pages.is_short_page(full=2))
    assert [r.id for r in pages.page_rows(kept, ["pull", "pagina"]).orderBy("pagina", "pos").collect()] == ["1", "2", "3"]


def test_pull_windows():
    today = date(2025, 10, 23)
    assert pages.pull_window("hourly", today, max_pages=20) == pages.PullWindow(today, today, 20)
    assert pages.pull_window("daily", today) == pages.PullWindow(today, today)
    assert pages.pull_window("yesterday", today).start == date(2025, 10, 22)
    assert pages.pull_window("last_30_days", today).start == date(2025, 9, 23)
    with pytest.raises(ValueError):
        pages.pull_window("backfill", today)


def test_record_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id": "1"},\n {"id": "2"}]')
    (tmp_path / "w.json").write_text('{"data": [{"id": "1"}, {"id": "2"}], "total": 2}')
    for name in ("a", "w"):
        got = [r.id for r in lake.read_records_json(spark, str(tmp_path / f"{name}.json")).collect()]
        assert got == ["1", "2"]


def test_registry_csv(spark, tmp_path):
    body = '"1";"Ação; com ""aspas"""\n"2";"fim\\"\n"3";""\n"4";NULL\n"5";"duas\nlinhas"\n'
    (tmp_path / "cnaes.csv").write_bytes(body.encode("iso-8859-1"))
    rows = registry_files.read_registry(spark, str(tmp_path / "cnaes.csv"), "cnaes").orderBy("codigo").collect()
    assert [tuple(r) for r in rows] == [
        ("1", 'Ação; com "aspas"'), ("2", "fim\\"), ("3", None), ("4", None), ("5", "duas\nlinhas")]
    (tmp_path / "odd.csv").write_bytes(b'"1";"2";"3"\n')
    assert registry_files.read_registry(spark, str(tmp_path / "odd.csv"), "cnaes").columns == ["col_0", "col_1", "col_2"]


def test_catalogue(spark):
    rows = {r.entity: r for r in registry_files.catalogue(spark).collect()}
    assert rows["empresas"].file_pattern == "Empresas{}.zip" and rows["cnaes"].file_pattern == "Cnaes.zip"
    assert {e for e, r in rows.items() if r.is_large} == {"empresas", "estabelecimentos", "socios", "simples"}
    assert [len([r for r in rows.values() if r.priority == p]) for p in (1, 2, 3)] == [3, 2, 5]


@pytest.mark.parametrize("current, latest, due", [
    ("2025-09", "2025-10", True), ("2025-10", "2025-10", False), (None, "2025-10", True), ("2025-10", None, False)])
def test_version_check(spark, current, latest, due):
    def one(v):
        return spark.createDataFrame([(v,)], "v string")

    row = registry_files.version_check(one(current), one(latest)).first()
    assert (row.current, row.latest, row.needs_update) == (current, latest, due)


def test_latest_version(spark):
    html = spark.createDataFrame([('<a href="2025-09/">x</a><a href="2025-10/">y</a>2099-01',), ("none",)], "h string")
    assert registry_files.latest_version(html, "h").first().latest == "2025-10"


def _bronze(spark, folder, run, ids, day=15):
    rows = [(i, run, datetime(2024, 1, day, 15)) for i in ids]
    df = spark.createDataFrame(rows, "id string, tag string, at timestamp_ntz")
    return sinks.write_bronze(df, folder, "t", F.col("at"), run)


def test_partition_values_keep_zero_padding(spark, folder):
    path = _bronze(spark, folder, "a", ["1"], day=5)
    assert read_parts(spark, path) == [("2024", "01", "05")]
    assert lake.read_day(spark, path, date(2024, 1, 5), "id").count() == 1
    assert lake.read_days(spark, path, today=date(2024, 2, 4)).count() == 1
    assert lake.read_days(spark, path, today=date(2024, 2, 5)).count() == 0


def read_parts(spark, path):
    return [tuple(r) for r in lake.read_table(spark, path).select("year", "month", "day").distinct().collect()]


def test_compaction(spark, folder):
    path = _bronze(spark, folder, "a", ["1", "2"])
    _bronze(spark, folder, "b", ["2", "3"])
    _bronze(spark, folder, "b", ["9"], day=16)
    preview = maintain.compact(spark, path, "id", dry_run=True)
    assert lake.read_table(spark, path).count() == 5
    stats = {r.day: r for r in preview.collect()}
    assert (stats["15"].total_before, stats["15"].total_after, stats["15"].needs_work) == (4, 3, True)
    assert not stats["16"].needs_work
    maintain.compact(spark, path, "id")
    rows = {r.id: r.tag for r in lake.read_table(spark, path).collect()}
    assert rows == {"1": "a", "2": "a", "3": "b", "9": "b"}
    before = sorted(r.path for r in lake.inventory(spark, path, "*.parquet").collect())
    maintain.compact(spark, path, "id")
    assert sorted(r.path for r in lake.inventory(spark, path, "*.parquet").collect()) == before


def test_interrupted_compaction_loses_nothing(spark, folder, monkeypatch):
    path = _bronze(spark, folder, "a", ["1", "2"])
    _bronze(spark, folder, "b", ["2", "3"])
    real = maintain._delete
    monkeypatch.setattr(maintain, "_delete", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        maintain.compact(spark, path, "id")
    assert lake.read_day(spark, path, date(2024, 1, 15), "id").count() == 3
    monkeypatch.setattr(maintain, "_delete", real)
    maintain.compact(spark, path, "id")
    assert lake.read_table(spark, path).count() == 3


def test_large_day_is_split_over_files(spark, folder):
    path = _bronze(spark, folder, "a", [str(i) for i in range(500)])
    _bronze(spark, folder, "b", [str(i) for i in range(500)])
    # The runtime would merge such tiny partitions again.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        maintain.compact(spark, path, "id", target_bytes=3000)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert lake.inventory(spark, path, "*.parquet").count() > 1
    assert lake.read_table(spark, path).count() == 500


def test_clean_day(spark, folder):
    path = _bronze(spark, folder, "a", ["1", "2"])
    _bronze(spark, folder, "a", ["3"], day=16)
    target = [f"{path}/year=2024/month=01/day=15", f"{path}/year=2024/month=01/day=20"]
    assert maintain.clean_day(spark, target, dry_run=True).first().files >= 1
    assert lake.read_table(spark, path).count() == 3
    assert maintain.clean_day(spark, target).count() == 1
    assert [r.id for r in lake.read_table(spark, path).collect()] == ["3"]
    assert maintain.clean_day(spark, target).count() == 0


def test_rewriting_a_registry_version(spark, folder):
    df = spark.createDataFrame([("1", "x")], "codigo string, descricao string")
    for version in ("2025-09", "2025-10", "2025-10"):
        path = sinks.write_registry(df, folder, "cnaes", version)
    assert lake.read_table(spark, path).count() == 2


def test_enrichment_of_odd_records(spark):
    records = spark.createDataFrame(
        [("1", 2024, 7), (None, 2024, 8), ("", 2024, 9), ("1", 2024, 0), ("2", 2024, 5)],
        "cnpj string, anoCompra int, sequencialCompra int")
    items = spark.createDataFrame([("1", 2024, 7, 2, "b"), ("1", 2024, 7, 1, "a")],
                                  "cnpj string, anoCompra int, sequencialCompra int, numeroItem int, descricao string")
    docs = items.withColumnRenamed("numeroItem", "ordem")
    failed = spark.createDataFrame([("2", 2024, 5, "timeout")], "cnpj string, anoCompra int, sequencialCompra int, error string")
    out = nested.enrich(records, ["cnpj", "anoCompra", "sequencialCompra"], items, docs, ["numeroItem"], ["ordem"], failed)
    rows = {r.sequencialCompra: r for r in out.collect()}
    assert [i.descricao for i in rows[7].itens] == ["a", "b"]
    assert rows[7].metadata.api_calls == 2 and rows[7].metadata.fetch_error is None
    for k in (8, 9, 0):
        assert rows[k].itens == [] and rows[k].metadata.fetch_error == nested.KEY_ERROR and rows[k].metadata.api_calls == 0
    assert rows[5].arquivos == [] and rows[5].metadata.fetch_error == "timeout"
    assert nested.enrichment_totals(out).first().asDict() == {
        "processed": 5, "total_itens": 2, "total_arquivos": 2, "api_calls": 4, "errors": 4}


def test_reports_on_empty_and_odd_input(spark):
    empty = spark.createDataFrame([], "itens array<int>, arquivos array<int>")
    row = reports.details_summary(empty, nested.list_size("itens"), nested.list_size("arquivos")).first()
    assert tuple(row) == (0, 0, 0, 0.0, 0.0)
    names = spark.createDataFrame([("Edital", "x"), ("", "y"), (None, None)], "n string, d string")
    got = [r.l for r in names.select(reports.document_label(F.col("n"), F.col("d")).alias("l")).collect()]
    assert got == ["Edital", "y", "Unknown"]
    rows = spark.createDataFrame([("a", "2024-01-05T00:00:00"), ("a", "2024-01-06"), ("b", "bad"), (None, "2024-02-01")],
                                 "numeroControlePNCP string, dataPublicacaoPncp string")
    report = reports.coverage(rows, reports.report_date(rows), reports.report_id(rows), detailed=True).collect()
    by = {(r.grain, r.year_month, r.day): (r.records, r.unique_ids) for r in report}
    assert by[("total", None, None)] == (4, 2) and by[("month", "2024-01", None)] == (2, 1)
    assert by[("month", None, None)] == (1, 1) and by[("day", "2024-02", "2024-02-01")] == (1, 0)
    noid = rows.drop("numeroControlePNCP")
    assert reports.report_id(noid) is None
    total = reports.coverage(noid, reports.report_date(noid), None).where("grain = 'total'").first()
    assert (total.records, total.unique_ids) == (4, 4)


def test_day_reads_with_a_row_without_a_day(spark, folder):
    rows = spark.createDataFrame(
        [("a", datetime(2024, 1, 5, 15)), ("b", datetime(2024, 1, 6, 15)), ("c", None)], "id string, at timestamp_ntz")
    path = sinks.write_bronze(rows, folder, "t", F.col("at"), "r")
    assert [r.id for r in lake.read_days(spark, path, date(2024, 1, 5), date(2024, 1, 5)).collect()] == ["a"]
    schema = "id string, at timestamp_ntz, year string, month string, day string, run string"
    assert [r.id for r in lake.read_day(spark, path, date(2024, 1, 6), "id", schema).collect()] == ["b"]
    assert lake.read_day(spark, path, date(2024, 2, 1), "id").count() == 0
    found = {r.id: r.d for r in lake.read_table(spark, path).select("id", lake.partition_date().alias("d")).collect()}
    assert found == {"a": date(2024, 1, 5), "b": date(2024, 1, 6), "c": None}


def test_compaction_settles_on_large_and_undated_days(spark, folder):
    rows = spark.range(3000).select(
        F.col("id"), F.md5(F.col("id").cast("string")).alias("text"),
        F.when(F.col("id") % 3 > 0, F.lit(datetime(2024, 1, 5, 15))).cast("timestamp_ntz").alias("at"))
    for run in ("a", "b"):
        path = sinks.write_bronze(rows.repartition(3), folder, "t", F.col("at"), run)
    first = maintain.compact(spark, path, "id", target_bytes=20_000)
    assert {r.needs_work for r in first.collect()} == {True}
    table = lake.read_table(spark, path)
    assert table.count() == 3000 and table.where("day is null").count() == 1000
    # Small shuffle partitions are merged at run time, so this small day may end in fewer files than asked for.
    assert table.select("_metadata.file_path").distinct().count() >= 2
    again = maintain.compact(spark, path, "id", target_bytes=20_000)
    assert {r.needs_work for r in again.collect()} == {False}


def test_compaction_without_an_id_column(spark, folder):
    at = datetime(2024, 1, 5, 15)
    for run, values in (("a", [1, 1, 2]), ("b", [2, 3])):
        rows = spark.createDataFrame([(v, at) for v in values], "v int, at timestamp_ntz")
        path = sinks.write_bronze(rows, folder, "t", F.col("at"), run)
    maintain.compact(spark, path, "id")
    assert sorted(r.v for r in lake.read_table(spark, path).collect()) == [1, 2, 3]


def test_numbers_are_no_dates(spark):
    from garimpo.operators.validate import with_errors

    rows = spark.createDataFrame([("a", 20241022), ("b", 0), ("c", None)], "id string, d long")
    got = {r.id: len(r.errors) for r in with_errors(rows, "id", "d").collect()}
    assert got == {"a": 1, "b": 0, "c": 0}
    texts = spark.createDataFrame([("a", "20241022")], "id string, d string")
    assert with_errors(texts, "id", "d").first().errors == []


def _dump(rng, records, end="\n"):
    def field():
        kind = rng.randrange(6)
        text = "".join(rng.choice("abç \\;'") for _ in range(rng.randrange(8)))
        if kind == 0:
            return '"' + text + rng.choice(["\n", end, "\n\n", '""', '""\n""', "\n;"]) + '"'
        return '"' + text + '"' if kind < 4 else text.replace(";", "").strip() or "x"

    return end.join(";".join(["%d" % n] + [field() for _ in range(3)]) for n in range(records)) + end


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_quoted_dumps_are_cut_anywhere(spark, tmp_path, end):
    import csv
    import random

    rng = random.Random(31)
    (tmp_path / "dump").mkdir()
    for n in range(3):
        (tmp_path / "dump" / f"part{n}.csv").write_bytes(_dump(rng, 60, end).encode("latin-1"))
    (tmp_path / "dump" / "empty.csv").write_bytes(b"")
    long = "0;\"" + "\n".join("line %d" % n for n in range(200)) + "\";\"b\";c" + end
    (tmp_path / "dump" / "long.csv").write_bytes((long + _dump(rng, 5, end)).encode("latin-1"))
    path = str(tmp_path / "dump")
    want = []
    for file in sorted((tmp_path / "dump").iterdir()):
        with open(file, encoding="latin-1", newline="") as opened:
            want += [tuple(None if v in ("", "NULL") else v for v in r) for r in csv.reader(opened, delimiter=";") if r]
    want.sort(key=repr)
    if end == "\n":
        whole = spark.read.csv(path, sep=";", encoding="ISO-8859-1", quote='"', escape='"', multiLine=True)
        assert sorted((tuple(None if v in (None, "", "NULL") else v for v in r) for r in whole.collect()), key=repr) == want
    settings = {"spark.sql.files.maxPartitionBytes": "97", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        got = registry_files.read_registry(spark, path, "empresas")
        assert sorted(map(tuple, got.collect()), key=repr) == want
        blocks = registry_files._lines(spark, path).select("file", "block").distinct().count()
        assert blocks > 40
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_an_empty_dump_has_no_records(spark, tmp_path):
    (tmp_path / "none.csv").write_bytes(b"\n\n")
    assert registry_files.read_registry(spark, str(tmp_path / "none.csv"), "cnaes").count() == 0
