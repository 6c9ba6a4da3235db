"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from garimpo.llm.common import discard, written


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); the component is its smallest node.

    Each round hangs every node's larger neighbours on its smallest one (large star), then every node and
    its smaller neighbours on the smallest of them (small star). Groups meet as minima only, so a node
    with any number of links is never one task's list. Rounds grow with the logarithm of the size; each
    one is written to the shared folder. Loops and repeated links are allowed; no links give no rows.
    """
    edges = written(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(),
        "links")
    before = _mark(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select("a", "b", "m")
        last, edges = edges, written(
            small.select("a", F.col("m").alias("b"))
            .unionByName(small.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct(),
            "links")
        discard(last)
        after = _mark(edges)
        if after == before:
            break
        before = after
    tops = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(tops)
