"""Filter interaction audit by forward-backward path counting over the subset lattice (operator 13)."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from garimpo.llm.common import written

WORD = r"[^\x20\x09-\x0D]+"
#: Few words, repeated words, capitals, symbols, copy of an earlier text.
FILTERS = "ABCDE"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def path_weights(n: int) -> list[tuple[int, int, int]]:
    """(state, filter, paths) for every edge of the lattice of ``n`` filters.

    A state is the set of filters applied so far, as bits; an edge applies one more. The forward pass counts
    the orders that reach a state, the backward pass the ways to go on from it, each by one sum over the
    neighbouring states; their product is the number of full orders that run through the edge.
    """
    full = (1 << n) - 1
    reaching, leaving = [0] * (full + 1), [0] * (full + 1)
    reaching[0] = leaving[full] = 1
    for state in range(1, full + 1):
        reaching[state] = sum(reaching[state ^ 1 << f] for f in range(n) if state >> f & 1)
    for state in range(full - 1, -1, -1):
        leaving[state] = sum(leaving[state | 1 << f] for f in range(n) if not state >> f & 1)
    return [
        (state, f, reaching[state] * leaving[state | 1 << f])
        for state in range(full + 1) for f in range(n) if not state >> f & 1]


def text_failures(text: Column) -> Column:
    """Bits 0 to 3: the failure conditions A to D of one text."""
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))
    total = F.size(words).cast("long")
    return (
        F.when(total < 100, 1).otherwise(0)
        + F.when(100 * F.size(F.array_distinct(words)).cast("long") < 80 * total, 2).otherwise(0)
        + F.when(100 * F.regexp_count(text, F.lit("[A-Z]")).cast("long") > 10 * F.char_length(text).cast("long"), 4).otherwise(0)
        + F.when(text.rlike("[#$%&*|]"), 8).otherwise(0))


def failure_counts(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang",
) -> DataFrame:
    """(part, mask, n, good, toxic): documents by the set of filters they fail (bit f for letter f of FILTERS).

    Texts are read once, in a narrow table of digests. Equal texts meet as counts by (text, part, label, id)
    and then by (text, part, label) with their smallest id, so a text that holds a third of all rows is
    summed up before it is shuffled; a row fails E when its id is above its text's smallest one. Null
    text is empty text, null part the empty string. A null id is above and below no other, so such a row
    never fails E and makes no other fail it; it has no labels. Repeated rows count each and equal ids do
    not make each other copies. A document is good (toxic) when any label row of its id says so.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = written(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
            text_failures(text).alias("mask"),
            F.unhex(F.sha2(text, 256)).alias("digest"),
        ), "filter-failures")
    marks = labels.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    marked = rows.filter("doc_id IS NOT NULL").join(marks, "doc_id", "left").fillna(False, ["good", "toxic"])
    unnamed = rows.filter("doc_id IS NULL").withColumns({"good": F.lit(False), "toxic": F.lit(False)})
    by_text = (
        marked.unionByName(unnamed)
        .groupBy("digest", "part", "mask", "good", "toxic", "doc_id").agg(F.count("*").alias("n"))
        .groupBy("digest", "part", "mask", "good", "toxic").agg(
            F.sum("n").alias("n"), F.min("doc_id").alias("least"),
            F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("unnamed"),
            F.min_by("n", "doc_id").alias("at_least")))
    first = by_text.groupBy("digest").agg(F.min("least").alias("first"))
    copy_bit = 1 << FILTERS.index("E")
    originals = F.col("unnamed") + F.when(F.col("least") == F.col("first"), F.col("at_least")).otherwise(0)
    split = by_text.join(first, "digest").select(
        "part", "good", "toxic",
        F.explode(F.array(
            F.struct(F.col("mask"), originals.alias("n")),
            F.struct((F.col("mask") + copy_bit).alias("mask"), (F.col("n") - originals).alias("n")))).alias("x"))
    n = F.col("x.n")
    return split.filter("x.n > 0").groupBy("part", F.col("x.mask").alias("mask")).agg(
        F.sum(n).alias("n"),
        F.sum(F.when(F.col("good"), n).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), n).otherwise(0)).alias("toxic"))


def edge_counts(masks: DataFrame, n_filters: int) -> DataFrame:
    """(part, state, filter, counts..., paths): what happens on every edge of the lattice, per part.

    ``masks`` has (part, mask, n, good, toxic), one row per part and set of failed filters. Each of them is
    dealt to all edges, a number that depends on ``n_filters`` alone; every part gets every edge.
    """
    edges = F.array(*[
        F.struct(F.lit(state).alias("state"), F.lit(f).alias("filter"), F.lit(1 << f).alias("bit"),
                 F.lit(paths).cast("long").alias("paths"))
        for state, f, paths in path_weights(n_filters)])
    dealt = masks.withColumn("edge", F.explode(edges)).select("*", "edge.*").drop("edge")
    passed = F.col("mask").bitwiseAND(F.col("state")) == 0
    fails = F.col("mask").bitwiseAND(F.col("bit")) != 0

    def total(condition: Column, of: str = "n") -> Column:
        return F.sum(F.when(condition, F.col(of)).otherwise(0))

    return dealt.groupBy("part", "state", "filter", "paths").agg(
        total(passed & ~fails).alias("kept"),
        total(passed & fails).alias("removed"),
        total(~passed & fails).alias("redundant"),
        total(F.col("mask") == F.col("bit")).alias("unique_fails"),
        total(passed & fails, "good").alias("good_lost"),
        total(passed & fails, "toxic").alias("toxic_lost"))


def order_steps(masks: DataFrame, letters: str) -> DataFrame:
    """(part, filter_order, step, counts...): a row per part, order of the filters and step.

    A step of an order is an edge of the lattice, so its counts are read from there; the Shapley column adds
    up each filter's removals over all orders, as edge removals times the orders through the edge.
    """
    edges = edge_counts(masks, len(letters))
    totals = edges.groupBy("part", "filter").agg(F.sum(F.col("removed") * F.col("paths")).alias("shapley"))
    steps = masks.sparkSession.createDataFrame(
        [("".join(letters[f] for f in order), step + 1, sum(1 << f for f in order[:step]), order[step])
         for order in permutations(range(len(letters))) for step in range(len(letters))],
        "filter_order string, step int, state int, filter int")
    return edges.join(totals, ["part", "filter"]).join(F.broadcast(steps), ["state", "filter"]).select(
        "part", "filter_order", "step", *COUNTS)


def filter_audit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang",
) -> DataFrame:
    """All 120 orders of the five filters over whole texts, per part: what each step keeps and removes.

    See ``failure_counts`` for nulls and repeated rows. An empty text has no words: it fails A alone, and E
    if an earlier one exists. Other columns are ignored, whatever their names; an empty table gives no rows.
    """
    masks = failure_counts(docs, labels, id_col, text_col, part_col)
    return order_steps(written(masks, "filter-masks"), FILTERS)


SQL = r"""
WITH words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
marks AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
          FROM labels GROUP BY doc_id),
docs AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, {
    'A': len(w) < 100,
    'B': 100 * len(list_distinct(w)) < 80 * len(w),
    'C': 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t),
    'D': regexp_matches(t, '[#$%&*|]'),
    'E': coalesce(words.doc_id > min(words.doc_id) OVER (PARTITION BY t), false)} AS f
  FROM words LEFT JOIN marks USING (doc_id)),
fails AS (
  SELECT part, good, toxic, concat(
    CASE WHEN f.A THEN 'A' ELSE '' END, CASE WHEN f.B THEN 'B' ELSE '' END, CASE WHEN f.C THEN 'C' ELSE '' END,
    CASE WHEN f.D THEN 'D' ELSE '' END, CASE WHEN f.E THEN 'E' ELSE '' END) AS fail FROM docs),
grouped AS (
  SELECT part, fail, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM fails GROUP BY ALL),
letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS o FROM letter a, letter b, letter c, letter d, letter e
  WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
steps AS (SELECT o, s, substr(o, s, 1) AS l, substr(o, 1, s - 1) AS earlier
          FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS s)),
counted AS (
  SELECT part, o, s, l,
    sum(CASE WHEN earlier_hit = '' AND NOT contains(fail, l) THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN earlier_hit = '' AND contains(fail, l) THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN earlier_hit <> '' AND contains(fail, l) THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN fail = l THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN earlier_hit = '' AND contains(fail, l) THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN earlier_hit = '' AND contains(fail, l) THEN toxic ELSE 0 END) AS toxic_lost
  FROM (SELECT *, CASE WHEN earlier = '' THEN '' ELSE regexp_replace(fail, '[^' || earlier || ']', '', 'g') END AS earlier_hit
        FROM grouped, steps) GROUP BY ALL)
SELECT part, o AS filter_order, s AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
  redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
  toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, l))::BIGINT AS shapley
FROM counted
"""
