"""Exact dedup by skew-safe combining (operator 9)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from garimpo.llm.common import texts_of, written

SALTS = 32


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical; of equal texts the largest doc_id stays. Rows are first counted by
    digest. Texts whose digest occurs more than once are compared by their content at every stage: within
    a task and per salt (the partial aggregation, then the salted shuffle), then across the salt winners.
    A group of any size is at most ``salts`` rows when it meets in one task. Should two different texts
    ever share a SHA-256, their rows find their winner by content.

    Null text is empty text. A null doc_id loses against any number; a group of null ids keeps them all
    under keep_id null. Repeated rows (same id, same text) tie and are all marked as the winner is. An
    empty table gives no rows. Other input columns are ignored, whatever their names.
    """
    rows = texts_of(docs, id_col, text_col).withColumn("digest", F.sha2("text", 256))
    repeated = rows.groupBy("digest").agg(F.count("*").alias("times")).filter("times > 1").select("digest")
    winners = written(
        rows.join(repeated, "digest", "left_semi")
        .withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)))
        .groupBy("digest", "text", "salt")
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("n"))
        .groupBy("digest", "text")
        .agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("n")),
        "exact-winners",
    )
    by_digest = winners.groupBy("digest").agg(
        F.count("*").alias("texts"), F.max("keep_id").alias("group_keep"), F.max("n").alias("n"))
    out = _labelled(rows.drop("text").join(by_digest.filter("texts = 1"), "digest", "left"))
    collided = by_digest.filter("texts > 1").select("digest")
    if collided.isEmpty():
        return out
    by_content = _labelled(
        rows.join(collided, "digest", "left_semi")
        .join(winners.withColumnRenamed("keep_id", "group_keep"), ["digest", "text"], "left"))
    return out.join(collided.withColumnRenamed("digest", "text_sha256"), "text_sha256", "left_anti").select(
        out.columns).unionByName(by_content)


def _labelled(joined: DataFrame) -> DataFrame:
    keep = F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("group_keep"))
    return joined.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce(F.col("n"), F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without exact copies: one whole row of each group stays, repeated rows once."""
    kept = exact_groups(docs, id_col, text_col).filter("kept").select(
        F.col("doc_id").alias("__kept_id"), F.col("text_sha256").alias("__kept_text")).distinct()
    digest = F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)
    return docs.join(
        kept, F.col(id_col).cast("long").eqNullSafe(F.col("__kept_id")) & (digest == F.col("__kept_text")), "left_semi"
    ).dropDuplicates([id_col, text_col])


SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
WINDOW w AS (PARTITION BY t)
"""
