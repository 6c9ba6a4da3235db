"""Notice texts: restriction rules, search and term weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from garimpo.functions.text import tokens
from garimpo.session import fresh_path

# Fixed value: a deadline below this many days is short.
SHORT_DEADLINE_DAYS = 5


def rule_flags(
    text: Column, deadline_days: Column, priceless_items: Column, brands: str, certificates: Sequence[str]
) -> dict[str, Column]:
    """The four restriction flags of a notice; unknown inputs raise no flag.

    ``brands`` is a pattern, ``certificates`` are rare ones searched as plain text.
    """
    def sure(test: Column) -> Column:
        return F.coalesce(test, F.lit(False))

    rare = F.lit(False)
    for certificate in certificates:
        rare = rare | F.contains(F.lower(text), F.lit(certificate.lower()))
    return {
        "flag_prazo_curto": sure(deadline_days < SHORT_DEADLINE_DAYS),
        "flag_marca_especifica": sure(text.rlike(brands)),
        "flag_requisitos_excessivos": sure(rare),
        "flag_valores_inconsistentes": sure(priceless_items > 0),
    }


def with_rule_score(df: DataFrame, flags: dict[str, Column], name: str = "score_restritivo_regras") -> DataFrame:
    """Add the flags and their share."""
    flagged = df.withColumns(flags)
    total = sum((F.col(n).cast("int") for n in flags), F.lit(0))
    return flagged.withColumn(name, total / len(flags))


def search(df: DataFrame, ident: str, text: str, terms: Sequence[str], k: int) -> DataFrame:
    """The k texts with most occurrences of the terms, ties by id; texts without any stay out."""
    wanted = F.array(*(F.lit(t.lower()) for t in terms))
    hits = F.size(F.filter(tokens(F.col(text)), lambda w: F.array_contains(wanted, w)))
    scored = df.select(ident, hits.alias("score")).where("score > 0")
    return scored.orderBy(F.desc("score"), ident).limit(k)


def tf_idf(df: DataFrame, ident: str, text: str, top: int | None = None) -> DataFrame:
    """Weight tf * ln((N + 1) / (df + 1)) of each term of each text, tf being its count there.

    A text moves once, to the task that counts its words: that is fewer bytes than a row per distinct term, each
    with the id. The counts are written once, since the document frequencies and the weights both need them; the texts are read and
    taken apart once. A common word moves one row per text, and the join by word may be split where a word
    is hot.
    """
    spark = df.sparkSession
    words = df.select(ident, text).repartition(ident).select(ident, F.explode(tokens(F.col(text))).alias("term"))
    path = fresh_path(spark, "terms")
    words.groupBy(ident, "term").agg(F.count("*").alias("tf")).write.parquet(path)
    tf = spark.read.parquet(path)
    spread = tf.groupBy("term").agg(F.count("*").alias("df"))
    texts = df.agg(F.count("*")).scalar()
    weighted = tf.join(spread, "term").withColumn("weight", F.col("tf") * F.log((texts + 1) / (F.col("df") + 1)))
    if top is None:
        return weighted
    best = Window.partitionBy(ident).orderBy(F.desc("weight"), "term")
    return weighted.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
