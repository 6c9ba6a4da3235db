from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from garimpo.functions import domains, text, timeparts, vectors
from garimpo.functions.cleaning import sanitize_frame
from garimpo.operators import filters, validate

ISO = [
    "2024-10-22", "2024-10-22T10:00:00Z", "20241022", "20241022T1000", "20241022T100001", "2024-10-22 10",
    "2024-10-22T10Z", "2024-10-22T10:00-03:00", "2024-10-22T10:00-0300", "2024-10-22T10-03",
    "2024-10-22T10:00:00.123456789", "2024-10-22T10:00:00,5", "2024", "2024-1-2", "10:00", " 2024-10-22",
    "2024-02-30", "2024-02-29", "0000-01-01", "2024-10-22T25:00", "2024-10-22T10:00:00+03:00:30", "bad",
    "2024-1022", "202410-22", "2024-10-22T10:0000", "9999-12-31T23:59:59",
    "2024-W43-2", "2024W432", "2024-W01-1", "2025-W01-1", "2020-W53-7", "2021-W53-1", "2024-W43-8", "2024-W00-1", "2024-W43",
    "2024W43", "2024-W432", "2024W43-2", "2024-W43-2T10:00:00-03:00", "2024W432T1030", "0000-W01-1",
]


def _python_utc(s):
    try:
        at = datetime.fromisoformat(s.replace("Z", "+00:00"))
    except ValueError:
        return None
    return at if at.tzinfo is None else at.astimezone(timezone.utc).replace(tzinfo=None)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_iso_dates_agree_with_python(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(s,) for s in ISO], "s string")
        got = {r.s: r.t for r in df.select("s", timeparts.iso_timestamp(F.col("s")).alias("t")).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == {s: _python_utc(s) for s in ISO}


def test_local_day_parts(spark):
    df = spark.sql("SELECT explode(array(TIMESTAMP_NTZ '2025-10-23 03:00:00', TIMESTAMP_NTZ '2025-10-23 02:00:00')) t")
    rows = df.select(timeparts.day_key(F.col("t")).alias("k"), timeparts.run_stamp(F.col("t")).alias("s")).collect()
    assert [(r.k, r.s) for r in rows] == [("20251023", "20251023_000000"), ("20251022", "20251022_230000")]
    keys = spark.createDataFrame([("20251023",), ("2025-10-23",), ("20251399",)], "k string")
    got = [r.t for r in keys.select(timeparts.parse_day_key(F.col("k")).alias("t")).collect()]
    assert got == [datetime(2025, 10, 23, 3), None, None]


def test_date_spine_and_last_days(spark):
    days = [r.day for r in timeparts.date_spine(spark, "2025-10-16", "2025-10-23").collect()]
    assert len(days) == 8 and days[0] == date(2025, 10, 16) and days[-1] == date(2025, 10, 23)
    row = spark.range(1).select(*timeparts.last_days(F.to_date(F.lit("2025-10-23")), 7)).first()
    assert tuple(row) == (date(2025, 10, 16), date(2025, 10, 23))


def test_trigram_similarity(spark):
    pairs = [("word", "two words"), ("abc", "abc"), ("Caçador", "cacador"), ("", ""), (None, "x")]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = [r.s for r in df.select(text.text_similarity(F.col("a"), F.col("b")).alias("s")).collect()]
    assert round(got[0], 6) == 0.363636 and got[1] == 1.0 and 0 < got[2] < 1 and got[3] == 0.0 and got[4] is None


def test_company_ids_and_entities(spark):
    df = spark.createDataFrame([("12.345.678/0001-95 pagou R$ 1.234,56 em 03/10/2024 e 2024-10-04",), ("123",)], "t string")
    row, other = df.select(
        text.extract_entities(F.col("t"))["cnpjs"].alias("c"), text.extract_entities(F.col("t"))["valores"].alias("v"),
        text.extract_entities(F.col("t"))["datas"].alias("d"), text.is_valid_cnpj(F.col("t")).alias("ok")).collect()
    assert row.c == ["12345678000195"] and row.v == ["R$ 1.234,56"] and row.d == ["03/10/2024", "2024-10-04"]
    assert other.c == [] and other.ok is False


def test_cosine(spark):
    df = spark.sql("SELECT array(1f, 0f) a, array(1f, 1f) b, array(0f, 0f) z, array(1f) s")
    row = df.select(
        vectors.cosine_similarity(F.col("a"), F.col("b")), vectors.cosine_similarity(F.col("a"), F.col("z")),
        vectors.cosine_similarity(F.col("a"), F.col("s"))).first()
    assert abs(row[0] - 0.5 ** 0.5) < 1e-12 and row[1] is None and row[2] is None


def test_domain_codes(spark):
    df = spark.sql("SELECT explode(array(6D, 6.5D, 99D, CAST(NULL AS DOUBLE))) code")
    got = [r.modalidade_name for r in domains.attach_domain(df, "code", "modalidade").collect()]
    assert got == ["PREGAO_ELETRONICO", None, None, None]
    known = [r.ok for r in domains.is_known_code(df, "code", "modalidade", "ok").collect()]
    assert known == [True, False, False, False]
    sizes = {name: domains.domain_table(spark, name).count() for name in domains.DOMAINS}
    assert sizes["natureza_juridica"] == 91 and sizes["amparo_legal"] == 80 and len(sizes) == 16
    table = {r.code: r for r in domains.domain_table(spark, "amparo_legal").collect()}
    assert table[1].artigo == "LEI 14133, Art. 28, I" and table[80].artigo == "LEI 14133, Art. 1, PARAGRAFO, 2"
    natures = {r.code: r for r in domains.domain_table(spark, "natureza_juridica").collect()}
    assert not natures[1082].is_state and natures[1236].is_state and natures[1341].is_federal
    first = domains.domain_table(spark, "modalidade").orderBy("code").first()
    assert first.descricao == "Leilao Eletronico"


def test_item_and_document_codes(spark):
    df = spark.sql("""
        SELECT array(named_struct('itemCategoriaId', 1, 'situacaoCompraItem', 2, 'criterioJulgamentoId', 1, 'materialOuServico', 'M'),
                     named_struct('itemCategoriaId', 77, 'situacaoCompraItem', CAST(NULL AS INT), 'criterioJulgamentoId', 3,
                                  'materialOuServico', CAST(NULL AS STRING))) itens,
               array(named_struct('tipoDocumentoId', 2, 'statusAtivo', true), named_struct('tipoDocumentoId', 16, 'statusAtivo', false)) arquivos""")
    row = domains.parse_document_codes(domains.parse_item_codes(df)).first()
    a, b = (i.parsed_domains for i in row.itens)
    assert (a.categoria, a.categoria_descricao, a.situacao, a.situacao_has_winner, a.criterio_julgamento,
            a.tipo_material_servico) == ("MATERIAL", "Material", "HOMOLOGADO", True, "MENOR_PRECO", "Material")
    assert (b.categoria, b.situacao, b.situacao_has_winner, b.criterio_julgamento, b.tipo_material_servico) == (
        None, None, None, None, "Serviço")
    assert [(d.parsed_domains.tipo_documento, d.parsed_domains.arquivo_ativo) for d in row.arquivos] == [
        ("EDITAL", True), (None, False)]


def test_record_codes_only_for_present_columns(spark):
    df = spark.sql("SELECT 6 modalidadeId, 99 modoDisputaId")
    row = domains.parse_record_codes(df).first()
    assert row.parsed_domains.asDict() == {"modalidade": "PREGAO_ELETRONICO", "modoDisputa": None}
    plain = spark.sql("SELECT 1 x")
    assert domains.parse_record_codes(plain).columns == ["x"]


def test_sanitize_recurses(spark):
    df = spark.sql("""SELECT array(named_struct('v', double('NaN'), 't', TIMESTAMP_NTZ '2024-01-02 03:04:05.5')) a,
        DATE '2024-01-02' d, map('k', double('NaN')) m, CAST(NULL AS STRUCT<x: DOUBLE>) s, 'x' plain""")
    row = sanitize_frame(df).first()
    assert row.a[0].v is None and row.a[0].t == "2024-01-02T03:04:05.500000"
    assert row.d == "2024-01-02" and row.m == {"k": None} and row.s is None and row.plain == "x"


def test_date_range_keeps_end_day_and_ignores_missing_column(spark):
    df = spark.createDataFrame(
        [("a", "2024-10-22T10:00:00Z"), ("b", "bad"), ("c", None), ("d", "2024-10-22T23:59:59"), ("e", "2024-10-23")],
        "id string, dataPublicacaoPncp string")
    got = [r.id for r in filters.date_range(df, "2024-10-22", "2024-10-22", "dataPublicacaoPncp").collect()]
    assert got == ["a", "d"]
    assert filters.date_range(df, "2024-10-22", "2024-10-22", "other").count() == 5


def test_nested_frame_for_no_columns(spark):
    empty = filters.nested_frame(spark.range(0).select())
    assert empty.columns == ["cnpj", "anoCompra", "sequencialCompra", "numeroControlePNCP", "itens", "arquivos", "metadata"]


def test_validation_and_gates(spark):
    df = spark.createDataFrame(
        [(0, "a", "2024-01-01"), (1, "", "bad"), (2, None, None), (3, "d", "")],
        "pos long, numeroControlePNCP string, dataPublicacaoPncp string")
    checked = validate.with_errors(df)
    assert validate.validation_report(checked).first().asDict() == {
        "total_records": 4, "valid_records": 2, "invalid_records": 2}
    messages = [r.message for r in validate.first_messages(checked, "pos").orderBy("idx", "part").collect()]
    assert messages == [
        "Record 1: Missing required field 'numeroControlePNCP'", "Record 1: Invalid date format in 'dataPublicacaoPncp'",
        "Record 2: Missing required field 'numeroControlePNCP'"]
    schema = "total_input long, new_records long, record_count long, uploaded boolean, key string, invalid_records long"

    def gate(*row):
        return validate.ingestion_gate(spark.createDataFrame([row], schema))

    assert gate(0, 0, 0, None, None, 0).first().reason == "no_data_from_api"
    assert gate(5, 0, 0, None, None, 0).first().reason == "all_duplicates"
    assert gate(5, 2, 2, True, "k", 0).first().validated
    validate.require(gate(5, 2, 2, True, "k", 0))
    for bad in [(5, 2, 2, True, "k", 1), (5, 2, 2, False, "k", 0), (5, 2, 2, True, "", 0), (5, 2, 0, True, "k", 0)]:
        with pytest.raises(ValueError):
            validate.require(gate(*bad))


def test_metadata_columns(spark):
    df = filters.add_metadata(spark.range(1), {"tags": {"b", "a"}, "at": date(2024, 1, 2), "n": 3, "d": {"k": 1}})
    row = df.first()
    assert (row.meta_tags, row.meta_at, row.meta_n, row.meta_d) == ('["a", "b"]', "2024-01-02", 3, '{"k": 1}')


# Rows and digest of each published code list as it was compared with its source; a changed code shows here.
CODE_LISTS = {
    "modalidade": (13, "1329ea694f742b65"),
    "modo_disputa": (6, "14609320e9fcc800"),
    "criterio_julgamento": (8, "8653ef7abc5f61e2"),
    "instrumento_convocatorio": (3, "69660cd3429e7375"),
    "situacao_contratacao": (4, "f3089b69e12259bf"),
    "situacao_item": (5, "9cca2442b54d6c65"),
    "situacao_resultado_item": (2, "90f45e393f028b7d"),
    "categoria_item_plano": (8, "680dc3487b9cf36e"),
    "categoria_processo": (11, "b1e2cd91350d4500"),
    "tipo_beneficio": (5, "6d7e4362f8cf651e"),
    "porte_empresa": (5, "ab05ea32699e2b1a"),
    "tipo_contrato": (12, "9f9857b81b00ed7c"),
    "tipo_termo_contrato": (3, "1609ed91bf3e72f9"),
    "tipo_documento": (17, "bb35c4389d8761ed"),
    "natureza_juridica": (91, "b549657458df1b00"),
    "amparo_legal": (80, "ac3eadd0f6813557"),
}


@pytest.mark.parametrize("name", sorted(CODE_LISTS))
def test_code_lists_are_the_published_ones(name):
    import hashlib

    rows = sorted(domains._rows(name))
    text = "\n".join(f"{code}|{label}|{description or ''}" for code, label, description in rows)
    assert (len(rows), hashlib.sha256(text.encode()).hexdigest()[:16]) == CODE_LISTS[name]


def test_combined_scores_of_empty_documents_match_sql(spark, folder):
    from oracle import compare
    import duckdb

    from garimpo.plans import catalog
    from garimpo.plans.registry import Tables

    docs = [(1, "en", 20), (2, "en", 0), (3, "", 0), (4, None, 0), (5, "", 7), (6, "en", None), (7, "en", 0), (8, "", 0)]
    labels = [(1, 1, 0), (2, 1, 0), (3, None, 1), (4, 1, 1), (5, 0, 1), (7, None, None)]
    spark.createDataFrame(docs, "doc_id long, lang string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    con, query = duckdb.connect(), catalog.REGISTRY["combined_scores"]
    for name in ("documents", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder.removeprefix('file:')}/{name}.parquet/*.parquet')")
    assert compare(query.plan(Tables(spark, folder)), con, query.sql) is None
