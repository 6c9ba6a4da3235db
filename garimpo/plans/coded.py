"""Queries: coded domains, company ids, similarity functions, entities in texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from garimpo.functions import domains, text, vectors
from garimpo.plans.registry import REGISTRY, Query, Tables, query

# Domain, inventory row, code column expression over part, and the flags as DuckDB sees them.
DECODED = [
    ("modalidade", "C1", "p_size", {
        "is_electronic": "code = 1 OR code = 4 OR code = 6", "is_presencial": "code = 5 OR code = 7 OR code = 13",
        "permite_disputa": "code <> 8 AND code <> 9", "is_common": "code = 6 OR code = 8 OR code = 9"}),
    ("modo_disputa", "C2", "p_size", {"permite_lances": "code = 1 OR code = 3 OR code = 6"}),
    ("criterio_julgamento", "C3", "p_size", {
        "is_price_based": "code < 3 OR code = 4 OR code = 6", "requires_technical_evaluation": "code = 4 OR code > 7"}),
    ("instrumento_convocatorio", "C4", "p_size", {}),
    ("situacao_contratacao", "C5", "p_size", {
        "is_active": "code = 1 OR code = 4", "is_cancelled": "code = 2 OR code = 3"}),
    ("situacao_item", "C6", "p_size", {"has_winner": "name = 'HOMOLOGADO'", "is_unsuccessful": "code >= 3"}),
    ("situacao_resultado_item", "C7", "p_size", {"is_valid": "name = 'INFORMADO'"}),
    ("categoria_item_plano", "C8", "p_size", {
        "is_goods": "code = 1", "is_services": "code = 2 OR code = 4", "is_construction": "code = 3 OR code = 8",
        "is_it_solution": "code = 5", "is_real_estate": "code = 6 OR code = 7"}),
    ("categoria_processo", "C9", "p_size", {
        "is_goods": "code = 2 OR code = 3", "is_services": "code = 6 OR code BETWEEN 8 AND 10",
        "is_construction": "code = 7"}),
    ("tipo_beneficio", "C10", "p_size", {"has_mepp_benefit": "code <= 3", "is_exclusive_mepp": "code = 1"}),
    ("porte_empresa", "C11", "p_size", {
        "is_small_business": "code <= 2", "is_large_company": "code = 3", "is_individual": "code = 4"}),
    ("tipo_contrato", "C12", "p_size", {
        "is_formal_contract": "code <= 5 OR code = 12", "is_agreement": "code = 6 OR code BETWEEN 9 AND 11"}),
    ("tipo_termo_contrato", "C13", "p_size", {"is_termination": "code = 1", "is_amendment": "code > 1"}),
    ("tipo_documento", "C14", "p_size", {
        "is_procurement_doc": "code <= 2", "is_technical_doc": "code >= 4 AND code <= 10",
        "is_contract_doc": "code >= 12", "is_amendment_doc": "code >= 13 AND code <= 15"}),
    ("natureza_juridica", "C15", "p_partkey + 1000", {
        "is_public_entity": "code >= 1015 AND code <= 1341", "is_private_entity": "code >= 2011 AND code <= 5037",
        "is_federal": "name LIKE '%FEDERAL%' OR name LIKE '%UNIAO%'",
        "is_state": "name LIKE '%ESTADUAL#_DF%' ESCAPE '#' OR code = 1236",
        "is_municipal": "name LIKE '%MUNICIPAL%' OR code = 1244",
        "is_company": "name LIKE '%EMPRESA%' OR name LIKE '%SOCIEDADE%'"}),
    ("amparo_legal", "C16", "p_partkey", {
        "is_dispensavel": "regexp_matches(name, 'ART_7[458]')", "is_inexigivel": "regexp_matches(name, 'ART_76')",
        "is_licitacao_obrigatoria": "regexp_matches(name, 'ART_28')", "is_emergency": "regexp_matches(name, 'ART_78')",
        "artigo": "regexp_replace(replace(name, '_ART_', ', Art. '), '^LEI_', 'LEI ')"}),
]


def _decoded_sql(name: str, code: str, flags: dict[str, str]) -> str:
    """Left join on the code list as VALUES; names without a description spell themselves out."""
    listing = ", ".join(
        f"({c}, '{n}', {'NULL' if d is None else repr(d)})" for c, n, d in domains._rows(name))
    spaced = "replace(name, '_', ' ')"
    if name != "amparo_legal":
        spaced = f"""list_aggregate(list_transform(string_split(lower({spaced}), ' '),
          lambda w: upper(w[1]) || w[2:]), 'string_agg', ' ')"""
    rules = {f: (f"replace({rule}, '_', ', ')" if f == "artigo" else rule) for f, rule in flags.items()}
    extra = "".join(f", CASE WHEN name IS NOT NULL THEN {rule} END AS {name}_{f}" for f, rule in rules.items())
    return f"""WITH d(code, name, descricao) AS (VALUES {listing})
SELECT p_partkey, name AS {name}_name, CASE WHEN name IS NOT NULL THEN coalesce(descricao, {spaced}) END
  AS {name}_descricao{extra}
FROM part LEFT JOIN d ON d.code = {code}"""


def _register(name: str, ident: str, code: str, flags: dict[str, str]) -> None:
    def plan(t: Tables):
        coded = t.part.select("p_partkey", F.expr(code).alias("code"))
        return domains.attach_domain(coded, "code", name).drop("code")

    label = f"decode_{name}"
    REGISTRY[label] = Query(label, ident, plan, _decoded_sql(name, code, flags))


for _entry in DECODED:
    _register(*_entry)


@query("C1", """SELECT p_partkey, p_size IN (1, 2, 3, 4, 5, 6) AS known FROM part""")
def known_codes(t: Tables):
    return domains.is_known_code(t.part.select("p_partkey", "p_size"), "p_size", "modo_disputa", "known").drop("p_size")


def _names(domain: str) -> str:
    return ", ".join(f"({c}, '{n}')" for c, n, _ in domains._rows(domain))


@query("C17", f"""
WITH m(code, name) AS (VALUES {_names('modalidade')}), d(code, name) AS (VALUES {_names('modo_disputa')}),
c(code, name) AS (VALUES {_names('criterio_julgamento')})
SELECT o_orderkey, m.name AS modalidade, d.name AS modo_disputa, c.name AS criterio
FROM orders LEFT JOIN m ON m.code = month(o_orderdate) LEFT JOIN d ON d.code = dayofweek(o_orderdate) + 1
LEFT JOIN c ON c.code = quarter(o_orderdate)""")
def record_codes(t: Tables):
    coded = t.orders.select(
        "o_orderkey", F.month("o_orderdate").alias("modalidadeId"), F.dayofweek("o_orderdate").alias("modoDisputaId"),
        F.quarter("o_orderdate").alias("criterioJulgamentoId"),
    )
    parsed = domains.parse_record_codes(coded)
    return parsed.select(
        "o_orderkey", "parsed_domains.modalidade", F.col("parsed_domains.modoDisputa").alias("modo_disputa"),
        F.col("parsed_domains.criterioJulgamento").alias("criterio"))


@query("C18", f"""
WITH k(code, name) AS (VALUES {_names('categoria_item_plano')}), s(code, name) AS (VALUES {_names('situacao_item')}),
c(code, name) AS (VALUES {_names('criterio_julgamento')})
SELECT k.name AS categoria, s.name AS situacao, CASE WHEN s.name IS NOT NULL THEN s.code = 2 END AS has_winner,
  c.name AS criterio, CASE l_returnflag WHEN 'R' THEN 'Material' ELSE 'Serviço' END AS tipo, count(*) AS n
FROM lineitem LEFT JOIN k ON k.code = l_quantity LEFT JOIN s ON s.code = l_linenumber
LEFT JOIN c ON c.code = l_linenumber GROUP BY ALL""")
def item_codes(t: Tables):
    kind = F.when(F.col("l_returnflag") == "R", "M").when(F.col("l_returnflag") == "A", "S")
    item = F.struct(
        F.col("l_quantity").alias("itemCategoriaId"), F.col("l_linenumber").alias("situacaoCompraItem"),
        F.col("l_linenumber").alias("criterioJulgamentoId"), kind.alias("materialOuServico"),
    )
    # A line is a record with one item: nothing is gathered to be taken apart again.
    nested = t.lineitem.select(F.array(item).alias("itens"))
    decoded = domains.parse_item_codes(nested).select(F.explode("itens").alias("i")).select("i.parsed_domains.*")
    return decoded.groupBy(
        "categoria", "situacao", F.col("situacao_has_winner").alias("has_winner"),
        F.col("criterio_julgamento").alias("criterio"), F.col("tipo_material_servico").alias("tipo"),
    ).agg(F.count("*").alias("n"))


@query("C19", f"""
WITH k(code, name) AS (VALUES {_names('tipo_documento')})
SELECT k.name AS tipo, toxic = 0 AS ativo, count(*) AS n FROM documents
LEFT JOIN labels USING (doc_id) LEFT JOIN k ON k.code = length(lang) + coalesce(quality, 0) GROUP BY ALL""")
def document_codes(t: Tables):
    doc = F.struct(
        (F.length("lang") + F.coalesce("quality", F.lit(0))).alias("tipoDocumentoId"), (F.col("toxic") == 0).alias("statusAtivo"))
    nested = t.documents.join(t.labels, "doc_id", "left").select("doc_id", F.array(doc).alias("arquivos"))
    decoded = domains.parse_document_codes(nested).select(F.explode("arquivos").alias("a"))
    return decoded.groupBy(
        F.col("a.parsed_domains.tipo_documento").alias("tipo"), F.col("a.parsed_domains.arquivo_ativo").alias("ativo"),
    ).agg(F.count("*").alias("n"))


# Sentences with company ids, money and dates built from orders, for the text functions.
def _company_id(t: Tables):
    digits = F.lpad((F.col("o_custkey") * 100003 + F.col("o_orderkey")).cast("string"), 14, "1")
    return F.when(F.col("o_orderstatus") == "F", text.format_cnpj(digits)).when(
        F.col("o_orderstatus") == "O", digits).otherwise(F.substring(digits, 1, 11))


COMPANY_SQL = """
c AS (SELECT *, lpad((o_custkey * 100003 + o_orderkey)::VARCHAR, 14, '1') AS digits FROM orders),
company AS (SELECT *, CASE o_orderstatus WHEN 'F' THEN digits[1:2] || '.' || digits[3:5] || '.' || digits[6:8] || '/'
  || digits[9:12] || '-' || digits[13:14] WHEN 'O' THEN digits ELSE digits[1:11] END AS raw FROM c)"""


@query("Q1 Q2 B2", f"""WITH {COMPANY_SQL}
SELECT o_orderkey, replace(replace(replace(raw, '.', ''), '/', ''), '-', '') AS cnpj, o_orderstatus <> 'P' AS valid,
  CASE WHEN o_orderstatus <> 'P' THEN regexp_replace(digits, '(..)(...)(...)(....)(..)', '\\1.\\2.\\3/\\4-\\5') END
  AS formatted FROM company""")
def company_ids(t: Tables):
    raw = _company_id(t)
    return t.orders.select(
        "o_orderkey", text.normalize_cnpj(raw).alias("cnpj"), text.is_valid_cnpj(raw).alias("valid"),
        text.format_cnpj(raw).alias("formatted"))


@query("Q3", """
SELECT vec_id, round(list_cosine_similarity(embedding::DOUBLE[], list_reverse(embedding)::DOUBLE[]), 9) AS similarity
FROM embeddings""")
def cosine_of_reversed(t: Tables):
    v = F.col("embedding")
    return t.embeddings.select(
        "vec_id", F.round(vectors.cosine_similarity(v, F.reverse(v)), 9).alias("similarity"))


@query("Q4", """
WITH g AS (SELECT p_partkey,
  [list_distinct(flatten([[('  ' || w || ' ')[i:i + 2] for i in range(1, length(w) + 2)] for w in ws])) for ws in
   [[w for w in regexp_split_to_array(lower(s), '[^a-z0-9]+') if w <> ''] for s in
    [p_name, p_type || ' ' || p_brand || ' ' || p_name]]] AS t FROM part)
SELECT p_partkey, round(len(list_intersect(t[1], t[2]))
  / len(list_distinct(list_concat(t[1], t[2]))), 9) AS similarity FROM g""")
def name_similarity(t: Tables):
    full = F.concat_ws(" ", "p_type", "p_brand", "p_name")
    return t.part.select("p_partkey", F.round(text.text_similarity(F.col("p_name"), full), 9).alias("similarity"))


@query("B5", f"""WITH {COMPANY_SQL},
s AS (SELECT o_orderkey, 'Empresa ' || raw || ' oferta R$ 1.' || lpad((o_custkey % 1000)::VARCHAR, 3, '0') || ',50 em '
  || strftime(o_orderdate, '%d/%m/%Y') || ' e ' || strftime(o_orderdate, '%Y-%m-%d') || '.' AS txt FROM company)
SELECT o_orderkey, regexp_extract(txt, 'oferta (R\\$ [0-9.,]+) em', 1) AS valor,
  regexp_extract(txt, 'em (\\S+) e', 1) AS data1, regexp_extract(txt, ' e (\\S+)\\.$', 1) AS data2,
  CAST(regexp_matches(txt, '^Empresa [0-9./-]{{14,}} ') AS INT) AS n_cnpjs FROM s""")
def entities_in_notices(t: Tables):
    sentence = F.concat(
        F.lit("Empresa "), _company_id(t), F.lit(" oferta R$ 1."),
        F.lpad(F.pmod("o_custkey", F.lit(1000)).cast("string"), 3, "0"), F.lit(",50 em "),
        F.date_format("o_orderdate", "dd/MM/yyyy"), F.lit(" e "), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("."),
    )
    found = t.orders.select("o_orderkey", sentence.alias("txt"))
    found = found.select("o_orderkey", *(c.alias(n) for n, c in text.extract_entities(F.col("txt")).items()))
    return found.select(
        "o_orderkey", F.col("valores")[0].alias("valor"), F.col("datas")[0].alias("data1"),
        F.col("datas")[1].alias("data2"), F.size("cnpjs").alias("n_cnpjs"))


@query("B5", """
SELECT * REPLACE (n_cnpjs::INT AS n_cnpjs, n_valores::INT AS n_valores, n_datas::INT AS n_datas, n_digits::INT AS n_digits)
FROM (SELECT doc_id, len(regexp_extract_all(text, '[0-9]{2}\\.?[0-9]{3}\\.?[0-9]{3}/?[0-9]{4}-?[0-9]{2}')) AS n_cnpjs,
  len(regexp_extract_all(text, 'R\\$ ?[0-9]{1,3}(\\.[0-9]{3})*(,[0-9]{2})?')) AS n_valores,
  len(regexp_extract_all(text, '\\b[0-9]{2}/[0-9]{2}/[0-9]{4}\\b|\\b[0-9]{4}-[0-9]{2}-[0-9]{2}\\b')) AS n_datas,
  length(regexp_replace(text, '[^0-9]', '', 'g')) AS n_digits FROM documents)""")
def entities_in_documents(t: Tables):
    found = text.extract_entities(F.col("text"))
    return t.documents.select(
        "doc_id", F.size(found["cnpjs"]).alias("n_cnpjs"), F.size(found["valores"]).alias("n_valores"),
        F.size(found["datas"]).alias("n_datas"), F.length(text.normalize_cnpj(F.col("text"))).alias("n_digits"))
