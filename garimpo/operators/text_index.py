"""Inverted index over texts, written as a table: postings in blocks with their maxima, top k by skipping blocks.

Layout: one row per term and block of texts, ``(term, block, top, texts, postings)``. ``top`` is the highest count
of the term in a text of the block, ``texts`` how many texts hold it, ``postings`` the pairs (id, count). Texts of
similar length share a block, because counts grow with length: blocks of long texts have high maxima, blocks
of short ones are skipped. Files are sorted by term and block and carry a Bloom filter of their terms, so a search
reads the row groups that may hold its terms and, for the maxima, narrow columns only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from garimpo.functions.text import tokens

# Texts of one block; a posting list holds at most about as many pairs.
BLOCK = 4096
# Length classes per doubling of the length.
STEPS = 2


def _length_class(text: Column) -> Column:
    return F.floor(F.log2(F.greatest(F.length(text), F.lit(1))) * STEPS).cast("int")


def write_index(df: DataFrame, ident: str, text: str, path: str, block: int = BLOCK) -> None:
    """Write the index of all whole texts to ``path``. Null texts and texts without words leave nothing.

    Rows that share an id count as one text per length class. A class is dealt by the id's hash to as many
    blocks as its rows ask for; the classes are at most 62, so their sizes are broadcast. Words are shuffled once,
    by term and block, and a word that is in every text is cut into blocks like the rest.
    """
    held = df.select(F.col(ident).alias("id"), F.col(text).alias("text")).where(F.col("text").isNotNull())
    held = held.withColumn("class", _length_class(F.col("text")))
    sizes = held.groupBy("class").agg(F.ceil(F.count("*") / block).alias("blocks"))
    number = F.col("class").cast("long") * F.lit(1 << 40) + F.pmod(F.xxhash64("id"), F.col("blocks"))
    dealt = held.join(F.broadcast(sizes), "class").select(number.alias("block"), "id", F.explode(tokens(F.col("text"))).alias("term"))
    # Both aggregates are clustered by what the words were dealt by.
    counted = dealt.repartition("term", "block").groupBy("term", "block", "id").agg(F.count("*").alias("n"))
    lists = counted.groupBy("term", "block").agg(
        F.max("n").alias("top"), F.count("*").alias("texts"), F.collect_list(F.struct("id", "n")).alias("postings"))
    sorted_lists = lists.sortWithinPartitions("term", "block")
    sorted_lists.write.option("parquet.bloom.filter.enabled#term", "true").mode("overwrite").parquet(path)


def block_bounds(index: DataFrame, terms: Sequence[str]) -> DataFrame:
    """(block, bound, texts) of the blocks that hold any term; no text of a block scores above its bound.

    ``texts`` is a number of texts that the block surely has hits in. Postings are not read.
    """
    named = index.where(F.col("term").isin(list(terms))).select("term", "block", "top", "texts")
    return named.groupBy("block").agg(F.sum("top").alias("bound"), F.max("texts").alias("texts"))


def _scores(index: DataFrame, terms: Sequence[str], blocks: DataFrame) -> DataFrame:
    """(id, score) of every hit in the blocks. A block's lists meet by block, so no text is shuffled twice."""
    lists = index.where(F.col("term").isin(list(terms))).join(blocks.select("block"), "block", "left_semi")
    pairs = lists.select("block", F.inline("postings"))
    return pairs.groupBy("block", "id").agg(F.sum("n").alias("score")).drop("block")


def _best(scored: DataFrame, k: int) -> DataFrame:
    return scored.orderBy(F.desc("score"), "id").limit(k)


def blocks_to_read(index: DataFrame, terms: Sequence[str], k: int) -> DataFrame:
    """The blocks that may hold one of the k best texts: those whose bound reaches the k-th best score of a few.

    The few are the blocks of highest bound that surely hold k hits, at most k blocks; they alone are scored first.
    Only these block numbers and one score pass the driver.
    """
    bounds = block_bounds(index, terms)
    few, hits = [], 0
    for row in bounds.orderBy(F.desc("bound"), "block").limit(k).collect():
        if hits >= k:
            break
        few.append(row["block"])
        hits += row["texts"]
    if hits < k:
        return bounds
    first = _best(_scores(index, terms, bounds.where(F.col("block").isin(few))), k)
    return bounds.where(F.col("bound") >= F.lit(first.agg(F.min("score")).scalar()))


def search_index(spark: SparkSession, path: str, terms: Sequence[str], k: int) -> DataFrame:
    """(id, score): the k texts with most occurrences of the terms, ties by id; exact, like ``notices.search``.

    Reads the index only. Blocks whose maxima add up to less than the k-th best score of the first blocks
    are skipped. Terms are compared in lower case and count once each; without terms nothing is found.
    """
    wanted = sorted({t.lower() for t in terms})
    index = spark.read.parquet(path)
    return _best(_scores(index, wanted, blocks_to_read(index, wanted, k)), k)
