"""Mixing sources to target weights by min-cost flow (operator 10)."""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from garimpo.llm.common import written

#: Weights of the sources in code point order, repeating.
WEIGHTS = (3, 1, 2)
#: Sum of all targets over the sum of all sizes.
SHARE = 1.5
#: How often a document may be taken.
REPEATS = 2
SEED = 20240611
#: Bits of the selection hash that one refinement pass resolves.
LEVEL_BITS = 8


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: dict, weights: tuple = WEIGHTS, share: float = SHARE, repeats: float = REPEATS) -> dict:
    """Target words per source: ``share`` of all sizes by weight, at most ``repeats`` times the source.

    What a full source cannot take is shared again by weight among the others until none is above.
    Sources are ordered by code point, null last; the weights repeat in that order.
    """
    ordered = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-8", "surrogatepass")))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(ordered)}
    rest, open_, out = share * sum(sizes.values()), list(ordered), {}
    while open_:
        total = sum(weight[s] for s in open_)
        full = [s for s in open_ if rest * weight[s] / total > repeats * sizes[s]]
        if not full:
            out |= {s: rest * weight[s] / total for s in open_}
            break
        for s in full:
            out[s] = float(repeats * sizes[s])
        rest -= sum(repeats * sizes[s] for s in full)
        open_ = [s for s in open_ if s not in out]
    return {s: float(out[s]) for s in ordered}


def route(patterns: dict, quotas: dict, repeats: int = REPEATS) -> dict:
    """Min-cost flow of words from membership patterns to source quotas.

    ``patterns`` maps a tuple of sources to its words. A pattern feeds each of its sources; its first
    copy costs 0 a word, its second 1, its third 2 and so on (convex), up to ``repeats`` copies. Returns
    the words each pattern sends to each source, {(pattern, source): words}. Quotas are whole words.
    Successive shortest paths with potentials; the graph has patterns and sources only, never documents.
    """
    names = list(patterns)
    nodes = {("start",): 0}
    for key in [("p", p) for p in names] + [("s", s) for s in quotas] + [("end",)]:
        nodes[key] = len(nodes)
    graph: list[list[int]] = [[] for _ in nodes]
    to, room, cost = [], [], []

    def arc(a, b, cap, price):
        for x, y, c, w in ((a, b, cap, price), (b, a, 0, -price)):
            graph[x].append(len(to))
            to.append(y)
            room.append(c)
            cost.append(w)

    links = {}
    for p in names:
        for copy in range(repeats):
            arc(0, nodes["p", p], patterns[p], copy)
        for s in dict.fromkeys(p):
            if s in quotas:
                links[p, s] = len(to)
                arc(nodes["p", p], nodes["s", s], patterns[p] * repeats, 0)
    for s, quota in quotas.items():
        arc(nodes["s", s], nodes[("end",)], quota, 0)
    end, height = nodes[("end",)], [0] * len(nodes)
    while True:
        far, back, queue = [float("inf")] * len(nodes), [-1] * len(nodes), [(0, 0)]
        far[0] = 0
        while queue:
            d, a = heapq.heappop(queue)
            if d > far[a]:
                continue
            for e in graph[a]:
                step = d + cost[e] + height[a] - height[to[e]]
                if room[e] > 0 and step < far[to[e]]:
                    far[to[e]], back[to[e]] = step, e
                    heapq.heappush(queue, (step, to[e]))
        if far[end] == float("inf"):
            break
        height = [h + min(f, far[end]) for h, f in zip(height, far)]
        push, a = float("inf"), end
        while a:
            push, a = min(push, room[back[a]]), to[back[a] ^ 1]
        a = end
        while a:
            room[back[a]] -= push
            room[back[a] ^ 1] += push
            a = to[back[a] ^ 1]
    return {key: room[e ^ 1] for key, e in links.items()}


def _size_class(size: Column) -> Column:
    return F.when(size > 0, F.floor(F.log2(size.cast("double")))).otherwise(F.lit(-1)).cast("int")


def _thresholds(rows: DataFrame, budgets: dict) -> tuple[dict, dict]:
    """Per (pattern, size class): the largest selected hash, and what remains of each pattern's budget.

    In hash order, documents are taken while their running sum stays within the class's part. The point
    is found by histograms over the leading bits of the hash, then over the next bits inside the bucket
    where the sum crosses, and so on. What reaches the driver is one row per pattern, class and bucket:
    patterns x 40 x 2**LEVEL_BITS at most, however many documents there are.
    """
    spark = rows.sparkSession
    totals = {(r.pattern, r.cls): r.n for r in rows.groupBy("pattern", "cls").agg(F.sum("size").alias("n")).collect()}
    whole = {}
    for (p, _), n in totals.items():
        whole[p] = whole.get(p, 0) + n
    left = {k: budgets[k[0]] * n // whole[k[0]] if whole[k[0]] else 0 for k, n in totals.items()}
    carry = {p: budgets[p] - sum(v for k, v in left.items() if k[0] == p) for p in whole}
    done, prefix = {}, {k: 0 for k in totals}
    for shift in range(64 - LEVEL_BITS, -1, -LEVEL_BITS):
        active = [(k[0], k[1], prefix[k]) for k in totals if k not in done]
        if not active:
            break
        spots = spark.createDataFrame(active, "pattern int, cls int, prefix long")
        deep = rows.join(F.broadcast(spots), ["pattern", "cls"])
        if shift < 64 - LEVEL_BITS:
            deep = deep.filter(F.shiftrightunsigned("hash", shift + LEVEL_BITS) == F.col("prefix"))
        bucket = F.shiftrightunsigned("hash", shift).bitwiseAND(F.lit((1 << LEVEL_BITS) - 1)).cast("int")
        found: dict = {}
        for r in deep.groupBy("pattern", "cls", bucket.alias("bucket")).agg(
                F.sum("size").alias("n"), F.count("*").alias("rows")).collect():
            found.setdefault((r.pattern, r.cls), []).append((r.bucket, r.n, r.rows))
        for p, c, at in active:
            k = (p, c)
            for b, n, count in sorted(found.get(k, [])):
                if n <= left[k]:
                    left[k] -= n
                    continue
                if count == 1 or shift == 0:
                    # The next document does not fit: everything below its bucket is taken.
                    done[k] = (((at << LEVEL_BITS) | b) << shift) - 1
                else:
                    prefix[k] = (at << LEVEL_BITS) | b
                break
            else:
                # All buckets of this level fit; the ones after the prefix begin at the next prefix.
                done[k] = (((at + 1) << (shift + LEVEL_BITS)) - 1) if shift < 64 - LEVEL_BITS else (1 << 64) - 1
    for k in totals:
        done.setdefault(k, (prefix[k] << 0) - 1)
        carry[k[0]] += left[k]
    return done, carry


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


class Mixture:
    """Copies per document as a rule over pattern, size class and seeded hash; small, so it is broadcast."""

    def __init__(self, seed: int):
        self.seed = seed
        self.patterns: list[tuple[str, int, int]] = []
        self.points: dict = {}
        self.extra: dict = {}
        self.flow: dict = {}

    def coded(self, df: DataFrame, id_col: str, sources_col: str, size_col: str, tag_col: str | None = None) -> DataFrame:
        """Adds __pattern, __base, __cls and __hash."""
        patterns = df.sparkSession.createDataFrame(self.patterns, "__key string, __pattern int, __base int")
        return (
            df.withColumn("__key", _pattern_key(sources_col)).join(F.broadcast(patterns), "__key").drop("__key")
            .withColumn("__cls", _size_class(F.col(size_col)))
            .withColumn("__hash", F.xxhash64(F.lit(self.seed), F.col(id_col).cast("long"), F.col(tag_col) if tag_col else F.lit(None))))

    def chosen(self, coded: DataFrame) -> DataFrame:
        """Adds ``copies`` and whether the rule takes the row's last part."""
        # As signed numbers, hashes at or above 2**63 are negative: compare with the sign bit flipped.
        rule = coded.sparkSession.createDataFrame(
            [(p, c, _signed(max(v, 0) ^ (1 << 63)), v >= 0, _signed(self.extra.get((p, c), 0)), (p, c) in self.extra)
             for (p, c), v in self.points.items()],
            "__pattern int, __cls int, __upto long, __some boolean, __more long, __has boolean")
        take = (F.col("__some") & (_ordered(F.col("__hash")) <= F.col("__upto"))) | (
            F.col("__has") & (F.col("__hash") == F.col("__more")))
        return (
            coded.join(F.broadcast(rule), ["__pattern", "__cls"]).withColumn("__take", take)
            .withColumn("copies", F.col("__base") + F.col("__take").cast("int")))

    def apply(self, df: DataFrame, id_col: str, sources_col: str, size_col: str, tag_col: str | None = None) -> DataFrame:
        """``df`` with ``copies``; no shuffle."""
        return self.chosen(self.coded(df, id_col, sources_col, size_col, tag_col)).select(*df.columns, "copies")


def _ordered(value: Column) -> Column:
    """Signed numbers in the order of the unsigned hash."""
    return value.bitwiseXOR(F.lit(_signed(1 << 63)))


def _pattern_key(sources_col: str) -> Column:
    return F.to_json(F.struct(F.array_sort(F.array_distinct(F.transform(
        sources_col, lambda s: F.coalesce(F.concat(F.lit("="), s), F.lit(""))))).alias("s")))


def fit_mixture(sized: DataFrame, quotas: dict, repeats: int = REPEATS, seed: int = SEED) -> Mixture:
    """How often each document of ``sized`` (doc_id, sources, size and maybe tag) is taken to meet the quotas.

    ``sources`` is an array of strings; null entries are a source. Documents are added up by membership
    pattern (their distinct sources); ``route`` gives each pattern its words. Whole copies go to all
    documents of the pattern; the rest goes to documents in the order of a seeded hash, in equal parts
    over size classes (powers of two), so the selection is representative and the gap is small. ``tag`` is a
    hash of the text: rows that share an id, or have none, differ by it, and only equal rows are taken
    together. Every step is a function of ids, tags, sizes and the seed, so reruns agree. The driver holds one row per pattern, class and hash bucket.
    """
    out = Mixture(seed)
    found = sized.select(_pattern_key("sources").alias("key"), "size", "sources").groupBy("key").agg(
        F.sum("size").alias("n"), F.any_value(F.array_distinct("sources")).alias("sources")).collect()
    found = sorted(found, key=lambda r: r.key)
    out.flow = route({tuple(r.sources): r.n for r in found}, quotas, repeats)
    budgets = {}
    for i, r in enumerate(found):
        words = sum(v for (p, _), v in out.flow.items() if p == tuple(r.sources))
        base = min(repeats, words // r.n) if r.n else 0
        budgets[i] = words - base * r.n
        out.patterns.append((r.key, i, base))
    coded = out.coded(sized, "doc_id", "sources", "size", "tag" if "tag" in sized.columns else None)
    rows = coded.select(
        F.col("__pattern").alias("pattern"), F.col("__cls").alias("cls"), F.col("__hash").alias("hash"), "size")
    out.points, gap = _thresholds(rows, budgets)
    # One more document of a class may close the gap: look at the next hash of each class once.
    rest = out.chosen(coded).filter(~F.col("__take") & (F.col("size") > 0))
    same = rest.groupBy("__pattern", "__cls", "__hash").agg(F.sum("size").alias("size"))
    nexts = same.groupBy("__pattern", "__cls").agg(
        F.min_by(F.struct("__hash", "size"), _ordered(F.col("__hash"))).alias("next")).collect()
    for r in sorted(nexts, key=lambda r: (r["__pattern"], -r["__cls"])):
        if r.next["size"] <= gap[r["__pattern"]]:
            gap[r["__pattern"]] -= r.next["size"]
            out.extra[r["__pattern"], r["__cls"]] = r.next["__hash"]
    return out


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return written(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.array(F.col(source_col).cast("string")).alias("sources"),
        word_count(F.col(text_col).cast("string")).alias("size"),
        F.xxhash64(F.col(text_col).cast("string")).alias("tag")), "mix-sizes")


def _source_mixture(sized: DataFrame, weights: tuple, share: float, repeats: int, seed: int):
    by_source = sized.groupBy(F.col("sources")[0].alias("source")).agg(F.sum("size").alias("n"))
    sizes = {r.source: r.n for r in by_source.collect()}
    want = targets(sizes, weights, share, repeats)
    return sizes, want, fit_mixture(sized, {s: round(v) for s, v in want.items()}, repeats, seed)


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    weights: tuple = WEIGHTS, share: float = SHARE, repeats: int = REPEATS, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, copies.

    A null text has size 0; a null source is a source of its own and ordered last. Rows that repeat an id
    are each counted and taken; equal rows are taken together. Texts without words add nothing, whether taken or not. An empty
    table gives no rows. Other columns are ignored, whatever their names.

    The driver holds one row per source. Sources are corpora, not documents; their number is bounded by
    the mixture's definition.
    """
    sized = _sized(docs, id_col, text_col, source_col)
    sizes, want, mixture = _source_mixture(sized, weights, share, repeats, seed)
    facts = docs.sparkSession.createDataFrame(
        [(s, sizes[s], want[s]) for s in want], "source string, source_size long, target double")
    taken = mixture.apply(sized, "doc_id", "sources", "size", "tag").withColumn("from", F.col("sources")[0])
    return taken.join(F.broadcast(facts), F.col("from").eqNullSafe(F.col("source"))).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"), "copies")


def repeat_to_weights(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                      weights: tuple = WEIGHTS, share: float = SHARE, repeats: int = REPEATS, seed: int = SEED) -> DataFrame:
    """``docs`` with every row as often as the mixture takes it (never, once, ...); columns unchanged."""
    names = docs.columns
    _, _, mixture = _source_mixture(_sized(docs, id_col, text_col, source_col), weights, share, repeats, seed)
    # The input's names are put aside before columns are added.
    rows = docs.select([F.col(f"`{n}`").alias(f"__in_{i}") for i, n in enumerate(names)])
    text, source = (F.col(f"__in_{names.index(c)}").cast("string") for c in (text_col, source_col))
    rows = rows.withColumns({"__sources": F.array(source), "__size": word_count(text), "__tag": F.xxhash64(text)})
    taken = mixture.apply(rows, f"__in_{names.index(id_col)}", "__sources", "__size", "__tag").filter("copies > 0")
    taken = taken.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return taken.select([F.col(f"__in_{i}").alias(n) for i, n in enumerate(names)])
