"""The given tables in the shape of procurement records.

Each ``*_SQL`` text is the same view for the SQL check, written independently.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from garimpo.plans.registry import Tables


def money(col: str | Column) -> Column:
    """Cents-exact amount: decimal sums do not depend on the order of rows."""
    return (F.col(col) if isinstance(col, str) else col).cast("decimal(15,2)")


def money_sum(col: str | Column) -> Column:
    return F.sum(money(col)).cast("double")


def notices(t: Tables) -> DataFrame:
    """Documents as landed records: some lack the id, some have odd publication dates."""
    src, ident = F.col("source"), F.concat(F.lit("DOC-"), F.col("doc_id").cast("string"))
    published = (
        F.when(src == "src1", "2024").when(src == "src2", "2024-10-22T10:00:00Z").when(src == "src3", "bad")
        .when(src == "src4", "20241022").when(src == "src5", F.lit(None)).when(src == "src6", "")
        .when(src == "src7", "2024-1-2").when(src == "src8", "2024-10-22T23:30:00-03:00")
        .when(src == "src9", "2024-02-30").when(src == "src10", " 2024-10-22")
        .when(src == "src11", "2024-10-22T10:00:00.250").when(src == "src12", "2024-10-22T25:00:00")
        .otherwise(F.concat(F.lit("2024-10-"), F.lpad((F.pmod("n_chars", F.lit(28)) + 1).cast("string"), 2, "0")))
    )
    return t.documents.select(
        "doc_id", "n_chars", "lang", "source",
        F.when(F.col("lang") == "de", F.lit(None)).when(F.col("lang") == "es", "").otherwise(ident)
        .alias("numeroControlePNCP"),
        published.alias("dataPublicacaoPncp"),
    )


NOTICES_SQL = """
notices AS (
  SELECT doc_id, n_chars, lang, source,
    CASE lang WHEN 'de' THEN NULL WHEN 'es' THEN '' ELSE 'DOC-' || doc_id END AS "numeroControlePNCP",
    CASE source WHEN 'src1' THEN '2024' WHEN 'src2' THEN '2024-10-22T10:00:00Z' WHEN 'src3' THEN 'bad'
      WHEN 'src4' THEN '20241022' WHEN 'src5' THEN NULL WHEN 'src6' THEN '' WHEN 'src7' THEN '2024-1-2'
      WHEN 'src8' THEN '2024-10-22T23:30:00-03:00' WHEN 'src9' THEN '2024-02-30' WHEN 'src10' THEN ' 2024-10-22'
      WHEN 'src11' THEN '2024-10-22T10:00:00.250' WHEN 'src12' THEN '2024-10-22T25:00:00'
      ELSE '2024-10-' || lpad((n_chars % 28 + 1)::VARCHAR, 2, '0') END AS "dataPublicacaoPncp"
  FROM documents)
"""

# The odd dates above, judged by hand: what they mean in UTC, or null when they are no date.
NOTICE_TIME_SQL = """
CASE WHEN source IN ('src1','src3','src5','src6','src7','src9','src10','src12') THEN NULL
  WHEN source IN ('src2') THEN TIMESTAMP '2024-10-22 10:00:00'
  WHEN source = 'src11' THEN TIMESTAMP '2024-10-22 10:00:00.250'
  WHEN source = 'src4' THEN TIMESTAMP '2024-10-22 00:00:00'
  WHEN source = 'src8' THEN TIMESTAMP '2024-10-23 02:30:00'
  ELSE CAST("dataPublicacaoPncp" AS TIMESTAMP) END
"""


def returned_orders(t: Tables) -> DataFrame:
    """Order ids counted as already processed: those with a returned line."""
    return t.lineitem.where(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("id")).distinct()


def shipped_orders(t: Tables) -> DataFrame:
    """A second processed set: orders with a line in status F."""
    return t.lineitem.where(F.col("l_linestatus") == "F").select(F.col("l_orderkey").alias("id")).distinct()


def records(t: Tables) -> DataFrame:
    """Orders as records keyed by (cnpj, anoCompra, sequencialCompra); low priority lacks the company."""
    return t.orders.select(
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey").cast("string")).alias("cnpj"),
        F.year("o_orderdate").alias("anoCompra"),
        F.col("o_orderkey").alias("sequencialCompra"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("dataPublicacaoPncp"),
        "o_orderstatus", "o_orderpriority", "o_totalprice",
    )


KEYS = ("cnpj", "anoCompra", "sequencialCompra")


def _keys_of_orders(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_custkey").cast("string").alias("cnpj"),
        F.year("o_orderdate").alias("anoCompra"),
        F.col("o_orderkey").alias("sequencialCompra"),
    )


def items(t: Tables) -> DataFrame:
    """Order lines as line items."""
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("sequencialCompra"),
        F.col("l_linenumber").alias("numeroItem"),
        F.col("l_partkey").alias("partkey"),
        F.col("l_extendedprice").alias("valor"),
        F.col("l_quantity").alias("quantidade"),
        F.when(F.col("l_returnflag") != "A", F.col("l_returnflag")).alias("itemCategoriaNome"),
        F.col("l_linestatus").alias("situacaoCompraItemNome"),
    )
    # Held whole by every task, the keys would grow with the orders.
    return lines.join(_keys_of_orders(t).hint("merge"), "sequencialCompra", "left")


def attachments(t: Tables) -> DataFrame:
    """Documents as files of the order with the same number."""
    docs = t.documents.select(
        F.col("doc_id").alias("sequencialCompra"),
        F.col("doc_id").alias("ordem"),
        F.when(F.col("lang") == "en", "Edital").when(F.col("lang") == "fr", "").alias("tipoDocumentoNome"),
        F.when(F.col("lang") != "de", F.col("lang")).alias("tipoDocumentoDescricao"),
    )
    return docs.join(_keys_of_orders(t), "sequencialCompra", "left")
