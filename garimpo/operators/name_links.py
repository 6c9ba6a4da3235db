"""Names that share most of their trigrams: each dealt to a representative, with the number of its links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from garimpo.functions.text import trigrams
from garimpo.session import fresh_path


def _needed(size: Column, percent: int) -> Column:
    """The trigrams that a set of this size must share with any set it is linked to."""
    return F.ceil(size * percent / F.lit(100.0)).cast("int")


def _parity(grams: Column, seed: int) -> Column:
    """64 bits, each the parity of the trigrams dealt to it: bits that differ between two sets bound what sets them apart."""
    def flipped(bits: Column, gram: Column) -> Column:
        place = F.pmod(F.xxhash64(F.lit(seed), gram), F.lit(64)).cast("int")
        return bits.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))

    return F.aggregate(grams, F.lit(0).cast("long"), flipped)


def distinct_sets(df: DataFrame, name: str) -> DataFrame:
    """One row per distinct trigram set: its trigrams, the smallest name that has it, and how many names do.

    Equal names are one before any trigram is cut. Names without a word have no trigrams and stay apart.
    """
    names = df.select(F.col(name).alias("name")).where(F.col("name").isNotNull()).distinct()
    cut = names.select("name", F.array_sort(trigrams(F.col("name"))).alias("grams"))
    alone = F.when(F.size("grams") == 0, F.col("name")).alias("alone")
    return cut.groupBy("grams", alone).agg(F.min("name").alias("head"), F.count("*").alias("names")).drop("alone")


def links(sets: DataFrame, percent: int) -> DataFrame:
    """(left, right, left_names, right_names) of linked sets, left below right; every pair once.

    The trigrams of a set are sorted by how many sets hold them, rarest first. Two linked sets share one of their
    first ``n - needed + 1`` trigrams, so only those are listed. Where two meet, their sizes, the places of the
    shared trigram and parity bits bound what they can share; what is left is counted in full. A pair that meets
    in several lists is taken in the list of its first shared trigram only, so no pairs are shuffled.
    """
    held = sets.where(F.size("grams") > 0)
    spread = held.select(F.explode("grams").alias("gram")).groupBy("gram").agg(F.count("*").alias("df"))
    one = held.select("head", "names", F.explode("grams").alias("gram")).join(spread, "gram")
    ordered = one.groupBy("head", "names").agg(F.array_sort(F.collect_list(F.struct("df", "gram"))).alias("o"))
    n = F.size("o")
    cut = ordered.select("head", "names", F.col("o.gram").alias("grams"), n.alias("n"), (n - _needed(n, percent) + 1).alias("first"))
    cut = cut.withColumns({f"bits{i}": _parity(F.col("grams"), i) for i in range(2)})
    listed = cut.select(
        "head", "names", "grams", "n", "bits0", "bits1", F.posexplode(F.slice("grams", F.lit(1), F.col("first"))).alias("pos", "gram"))
    a, b = listed.alias("a"), listed.alias("b")
    na, nb, pa, pb = F.col("a.n"), F.col("b.n"), F.col("a.pos"), F.col("b.pos")
    # Places count from 0: what lies up to the shared trigram on either side, and what follows it.
    most = F.least(pa, pb) + F.least(na - pa, nb - pb)
    apart = F.bit_count(F.col("a.bits0").bitwiseXOR(F.col("b.bits0")))
    other = F.bit_count(F.col("a.bits1").bitwiseXOR(F.col("b.bits1")))
    bounded = ((F.col("a.head") < F.col("b.head")) & (100 * F.least(na, nb) >= percent * F.greatest(na, nb))
               & ((100 + percent) * most >= percent * (na + nb))
               & ((100 + percent) * F.greatest(apart, other) <= (100 - percent) * (na + nb)))
    shared = F.array_intersect("a.grams", "b.grams")
    alike = ((100 + percent) * F.size(shared) >= percent * (na + nb)) & (F.get(shared, F.lit(0)) == F.col("a.gram"))
    # One expression, because the optimizer would count shared trigrams before it looks at the bounds.
    linked = a.join(b, (F.col("a.gram") == F.col("b.gram")) & F.when(bounded, alike).otherwise(F.lit(False)))
    return linked.select(
        F.col("a.head").alias("left"), F.col("b.head").alias("right"), F.col("a.names").alias("left_names"),
        F.col("b.names").alias("right_names"))


def represented(df: DataFrame, ident: str, name: str, percent: int = 70) -> DataFrame:
    """(ident, name, representative, links) per row: the smallest name linked with the row's own, itself included.

    Two names are linked when shared trigrams make up ``percent`` of all their trigrams; ``links`` is the number of
    other names linked. Dealing is not carried on from name to name. A null name has no representative and no
    links; a name without words is its own. Rows of one name share an answer that is joined by the name.
    """
    spark = df.sparkSession
    path = fresh_path(spark, "name-sets")
    distinct_sets(df, name).write.parquet(path)
    sets = spark.read.parquet(path)
    pairs = links(sets, percent)
    sides = F.array(
        F.struct(F.col("left").alias("head"), F.col("right").alias("other"), F.col("right_names").alias("names")),
        F.struct(F.col("right").alias("head"), F.col("left").alias("other"), F.col("left_names").alias("names")))
    near = pairs.select(F.inline(sides)).groupBy("head").agg(F.min("other").alias("other"), F.sum("names").alias("more"))
    dealt = sets.join(near, "head", "left").select(
        "grams", F.when(F.size("grams") == 0, F.col("head")).alias("alone"),
        F.least("head", F.coalesce("other", "head")).alias("representative"),
        (F.col("names") - 1 + F.coalesce("more", F.lit(0))).alias("links"))
    names = df.select(F.col(name).alias("name")).where(F.col("name").isNotNull()).distinct()
    cut = names.select("name", F.array_sort(trigrams(F.col("name"))).alias("grams"))
    cut = cut.withColumn("alone", F.when(F.size("grams") == 0, F.col("name")))
    same = (cut["grams"] == dealt["grams"]) & cut["alone"].eqNullSafe(dealt["alone"])
    answers = cut.join(dealt, same).select("name", "representative", "links")
    rows = df.select(F.col(ident).alias(ident), F.col(name).alias("name"))
    return rows.join(answers, "name", "left").select(ident, "name", "representative", F.coalesce("links", F.lit(0)).cast("long").alias("links"))
