"""MinHash near-dedup with bottom-k sketches from one hash function (operator 1)."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from garimpo.llm import words as W
from garimpo.llm.common import discard, lean, passing, pieces, ship, slices, texts_of, unused, utf8, written
from garimpo.llm.components import connected

#: Words of a shingle.
WORDS = 5
#: Linked when 100 * intersection >= LINK * union.
LINK = 85
#: Smallest hashes that a sketch retains.
RETAINED = 64
#: Bins of the bit filter.
BINS = 64
#: Pairs across components that a list may give; members of longer ones are told apart by their differences.
PAIRED = 256
#: Texts that a Python worker gets at once, and text bytes whose shingle sets it hands back at once.
BATCH_ROWS = 1000
PIECE = 1 << 20


def least_agreeing(link: int, retained: int = RETAINED) -> int:
    """Of the ``retained`` smallest hashes of a union, so many must be in both sets for a pair to be verified.

    At the link similarity the number is binomial with mean ``retained * link / 100``; it is below the bound in
    at most one of 10**9 pairs. A set smaller than the sketch is retained whole, and the same share of it is a
    certain bound. For operator 1 it is 34.
    """
    return _quantile(retained, link / 100, 1e-9)


def most_unlike(link: int) -> int:
    """Bits in which a linked pair may differ: one bit of the smallest hash in each of BINS bins of a whole set.

    A bin's bits differ with a chance of half the distance; more bits than the bound differ in at most
    one of 10**8 pairs at the link similarity. For operator 1 it is 20; unrelated sets differ in about 29.
    """
    return BINS - _quantile(BINS, 1 - (1 - link / 100) / 2, 1e-8)


def _quantile(n: int, p: float, tail: float) -> int:
    """The largest k for which fewer than k of n tries succeed with a chance of at most ``tail``."""
    below = 0.0
    for k in range(n + 1):
        below += math.comb(n, k) * p ** k * (1 - p) ** (n - k)
        if below > tail:
            return k
    return n


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, n: int = WORDS):
    """The sorted distinct shingle hashes (63 bits) of each text; a text with fewer words is one shingle."""
    for a, b in slices(offsets, W.CHUNK):
        part, local = raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
        starts, ends, first = W.spans(part, local, W.BLANK_SEPARATED)
        hashes = W.hashes(part, starts, ends)
        for i in range(b - a):
            yield W.distinct(W.grams(hashes[first[i]:first[i + 1]], n) >> np.uint64(1))


def one_bits(s: np.ndarray) -> int:
    """64 bits of a sorted set: the lowest bit of the smallest hash in every bin, 0 for an empty bin."""
    at = np.searchsorted(s, _EDGES)
    least = np.append(s, np.uint64(0))[at[:-1]] & np.uint64(1)
    least[at[:-1] == at[1:]] = 0
    return int(np.packbits(least.astype(np.uint8)).view(">i8")[0])


_EDGES = np.append(np.arange(64, dtype=np.uint64) << np.uint64(57), np.uint64(1 << 63))


def sketches(docs: DataFrame, words: int = WORDS, retained: int = RETAINED) -> DataFrame:
    """doc_id, n_shingles, digests of the text and of the whole set (null when empty), its smallest hashes in order."""
    ship(docs.sparkSession)

    def run(batches):
        for batch in pieces(batches, 1, PIECE):
            raw, offsets = utf8(batch.column(1))
            sizes, digests, kept = [], [], []
            view = memoryview(raw)
            texts = [hashlib.md5(view[x:y]).digest() for x, y in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            for s in shingle_sets(raw, offsets, words):
                sizes.append(len(s))
                digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                kept.append(s[:retained].astype(np.int64))
            ends = np.cumsum([0] + [len(k) for k in kept]).astype(np.int32)
            flat = np.concatenate(kept) if kept else np.empty(0, np.int64)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), "n_shingles": pa.array(sizes, pa.int64()),
                "text_md5": pa.array(texts, pa.binary()), "digest": pa.array(digests, pa.binary()),
                "sketch": pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int64()))})

    return docs.mapInArrow(lean(run), "doc_id long, n_shingles long, text_md5 binary, digest binary, sketch array<long>")


def _agree(pairs: DataFrame, nodes: DataFrame, retained: int, agreeing: int, link: int) -> DataFrame:
    """Pairs whose sizes allow a link and whose union sketch lets it be likely."""
    one = nodes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    two = nodes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    joined = pairs.join(one, "a").join(two, "b").filter(100 * F.least("na", "nb") >= link * F.greatest("na", "nb"))
    union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, retained)
    joined = joined.withColumn("u", F.size(union)).withColumn(
        "x", F.size(F.array_intersect(union, F.array_intersect("sa", "sb"))))
    return joined.filter(F.col("x") * retained >= F.col("u") * agreeing).select("a", "b")


def _verified(pairs: DataFrame, sets: DataFrame, link: int) -> DataFrame:
    """Pairs of nodes whose whole shingle sets are linked."""
    one = sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("values").alias("va"))
    two = sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("values").alias("vb"))
    both = F.size(F.array_intersect("va", "vb"))
    return pairs.join(one, "a").join(two, "b").filter(100 * both >= link * (F.col("na") + F.col("nb") - both)).select("a", "b")


def _whole_sets(nodes: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """node, n, bits and all shingle hashes of the given nodes, from the row that stands for each.

    A row is found by id and text digest together, so rows without an id do not meet each other's texts.
    """
    wanted = nodes.select("node", F.col("row.doc_id").alias("id"), F.col("row.text_md5").alias("md5"))
    keyed = texts.withColumn("key", F.unhex(F.md5("text")))
    joined = keyed.join(wanted, wanted.id.eqNullSafe(keyed.doc_id) & (wanted.md5 == keyed.key)).select("node", "text")

    def run(batches):
        for batch in pieces(batches, 1, PIECE):
            sets, bits = [], []
            for s in shingle_sets(*utf8(batch.column(1)), words):
                sets.append(s.astype(np.int64))
                bits.append(one_bits(s))
            ends = np.cumsum([0] + [len(s) for s in sets]).astype(np.int32)
            flat = np.concatenate(sets) if sets else np.empty(0, np.int64)
            yield pa.RecordBatch.from_pydict({
                "node": batch.column(0), "n": pa.array(np.diff(ends).astype(np.int64)),
                "bits": pa.array(bits, pa.int64()),
                "values": pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int64()))})

    # Rows that repeat an id and a text bring the same set several times.
    return joined.mapInArrow(lean(run), "node long, n long, bits long, values array<long>").dropDuplicates(["node"])


def _by_rarity(listed: DataFrame, key: list[str]) -> DataFrame:
    """``key`` and the values that it shares with others, rarest first. All but the key's last column part the lists."""
    of = key[:-1] + ["value"]
    frequency = listed.groupBy(*of).agg(F.count("*").alias("df")).filter("df > 1")
    return listed.join(frequency, of).groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("df", "value"))).alias("values"))


def _crossing(lists: DataFrame, labels: DataFrame, nodes: DataFrame, sets: DataFrame, texts: DataFrame, words: int,
              link: int, unlike: int) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) of different components that may still be linked, and the whole sets of their nodes.

    Nodes of lists that hold several components are listed again, now by their whole sets: a linked pair
    shares a value among the ``n - ceil(link * n) + 1`` rarest of each set, and at the first one they
    share, what is left of both sets must reach the overlap that a link needs. Both bounds are certain.
    Texts whose rare values are their own, which is what a weak relative of a group has, drop out here.

    Members of a list outside its largest component look for partners. In a list of up to PAIRED such pairs
    they are made, and one bit of each bin's smallest hash sets unrelated texts apart. A longer list is
    that of a family of texts; its members go on to ``_apart``.
    """
    known = labels.withColumnRenamed("node", "id")

    def marked(members: DataFrame) -> DataFrame:
        joined = members.join(known, members.node == known.id, "left")
        return joined.withColumn("component", F.coalesce("component", "node")).drop("id")

    several = marked(lists).groupBy("value").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi").select("value")
    open_ = lists.join(several, "value", "left_semi").select("node").distinct()
    unread = nodes.join(open_, "node", "left_semi").join(sets, "node", "left_anti")
    sets = written(
        sets.join(open_, "node", "left_semi").unionByName(_whole_sets(unread, texts, words)), "near-sets", BATCH_ROWS)
    listed = sets.select("node", F.explode("values").alias("value"))
    alone = F.col("n") - F.size("values")
    room = F.col("n") - F.ceil(F.col("n") * F.lit(link) / F.lit(100)) + 1 - alone
    prefixes = (
        _by_rarity(listed, ["node"]).join(sets.select("node", "n", "bits"), "node")
        .withColumn("alone", alone).withColumn("room", room.cast("int")).filter("room > 0")
        .select("node", "n", "bits", "alone", F.posexplode(F.slice("values", F.lit(1), F.col("room"))).alias("place", "v"))
        .select("node", "n", "bits", "alone", (F.col("alone") + F.col("place")).alias("place"), F.col("v.value").alias("value")))
    prefixes = written(marked(prefixes), "near-prefixes")
    # The head of a family is the member with the fewest values of its own: what it links is linked to most.
    parts = prefixes.groupBy("value", "component").agg(
        F.count("*").alias("m"), F.max(F.struct((-F.col("alone")).alias("plain"), "node")).alias("head"))
    largest = F.max(F.struct("m", "head.plain", "component", "head.node"))
    parts = parts.groupBy("value").agg(largest.alias("main"), F.sum("m").alias("members"), F.count("*").alias("parts"))
    parts = parts.filter("parts > 1").select(
        "value", F.col("main.component").alias("main"), F.col("main.node").alias("head"),
        ((F.col("members") - F.col("main.m")) * F.col("members") <= PAIRED).alias("short"))
    rest = prefixes.join(parts, "value")
    rows = rest.filter("short").select(
        "value", "node", "n", "component", "bits", (F.col("n") - F.col("place")).alias("left"),
        (F.col("component") == F.col("main")).alias("in_main"))
    one = rows.filter("not in_main").select("value", *[F.col(c).alias(c + "_a") for c in rows.columns[1:]])
    two = rows.select("value", *[F.col(c).alias(c + "_b") for c in rows.columns[1:]])
    # 100 * overlap >= link * union means (100 + link) * overlap >= link * (n_a + n_b).
    enough = f"{100 + link} * least(left_a, left_b) >= {link} * (n_a + n_b)"
    near = f"bit_count(bits_a ^ bits_b) <= {unlike}"
    pairs = one.join(two, "value").filter(f"component_a <> component_b and (in_main_b or node_a < node_b) and {enough} and {near}")
    pairs = pairs.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b"))
    long = rest.filter("not short").select("head", "node", "component").distinct()
    return pairs.unionByName(_apart(long, sets, link)).distinct(), sets


def _apart(members: DataFrame, sets: DataFrame, link: int) -> DataFrame:
    """Pairs (a, b) of ``members`` (head, node, component) that may be linked, by their differences from a common head.

    Copies of one text agree in nearly all values, linked or not; what tells them apart is where they differ
    from the head of their list. With D(x) the values that only one of x and the head has, D(a) and D(b)
    differ exactly where a and b do, and a link allows at most ``c * (na + nb)`` such values, with
    c = (100 - link) / (100 + link). So a linked pair shares at least half of
    ``|D(a)| + |D(b)| - c * (na + nb)`` differences. Two members that the head links are in one component; hence
    one of a pair is far, with more than ``c * (n + nh)`` differences. This leaves to a member x near the
    head at least ``(|D(x)| + c * (nh - nx)) / 2`` shared ones, to a far one that or ``(|D(x)| - c * (nx + nh)) /
    (1 + c)``, and one at least. Differences of each head are listed rarest first up to these bounds, and at the
    first one that a pair shares, the rest must reach the pair's own bound. All bounds are certain. Members
    near a head of another component are paired with it.
    """
    x = sets.select("node", F.col("n").alias("n"), F.col("values").alias("vx"))
    h = sets.select(F.col("node").alias("head"), F.col("n").alias("nh"), F.col("values").alias("vh"))
    coded = written(
        members.filter("node <> head").join(x, "node").join(h, "head").select(
            "head", "node", "component", "n", "nh", F.concat(F.array_except("vx", "vh"), F.array_except("vh", "vx")).alias("values"))
        .withColumn("d", F.size("values").cast("long")), "near-differences")
    most, all_ = 100 - link, 100 + link
    far = F.col("d") * all_ > most * (F.col("n") + F.col("nh"))
    half = (F.col("d") * all_ + most * (F.col("nh") - F.col("n"))) / (2.0 * all_)
    over = (F.col("d") * all_ - most * (F.col("n") + F.col("nh"))) / 200.0
    # A little less than the exact fraction, so that rounding cannot raise a bound.
    shared = F.greatest(F.lit(1), F.ceil(F.when(F.col("far"), F.least(half, over)).otherwise(half) - 1e-9))
    sized = coded.withColumn("far", far)
    listed = coded.select("head", "node", F.explode("values").alias("value"))
    alone = F.col("d") - F.size("values")
    prefixes = (
        _by_rarity(listed, ["head", "node"]).join(sized.drop("values"), ["head", "node"])
        .withColumn("alone", alone).withColumn("room", (F.col("d") - shared + 1 - F.col("alone")).cast("int")).filter("room > 0")
        .select("head", "node", "component", "n", "d", "far", "alone",
                F.posexplode(F.slice("values", F.lit(1), F.col("room"))).alias("place", "v"))
        .select("head", F.col("v.value").alias("value"), "node", "component", "n", "d", "far",
                (F.col("d") - F.col("alone") - F.col("place")).alias("left")))
    prefixes = written(prefixes, "near-prefixes")
    one = prefixes.filter("far").select("head", "value", *[F.col(c).alias(c + "_a") for c in prefixes.columns[2:]])
    two = prefixes.select("head", "value", *[F.col(c).alias(c + "_b") for c in prefixes.columns[2:]])
    enough = f"2 * {all_} * least(left_a, left_b) >= {all_} * (d_a + d_b) - {most} * (n_a + n_b)"
    alike = f"100 * least(n_a, n_b) >= {link} * greatest(n_a, n_b)"
    pairs = one.join(two, ["head", "value"]).filter(
        f"component_a <> component_b and (not far_b or node_a < node_b) and {alike} and {enough}")
    pairs = pairs.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b"))
    near = sized.filter("not far").select(F.least("head", "node").alias("a"), F.greatest("head", "node").alias("b"))
    return pairs.unionByName(near)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                    link: int = LINK, retained: int = RETAINED, agreeing: int | None = None,
                    unlike: int | None = None) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    1. Every text becomes its set of distinct word shingles and a sketch, the set's smallest hashes.
       Documents with the same whole set are one node, whatever their number.
    2. A node lists only the rarest of its retained values: two sketches that agree in ``agreeing`` values
       share one among the ``retained - agreeing + 1`` rarest of each. A passage that very many documents
       share is therefore in no list unless it fills most of a document. Values of one node are dropped.
    3. Every list links its members to its smallest node only. Candidates pass the size bound and the
       estimate from the union's sketch, then the Jaccard similarity of the whole sets decides.
    4. Members of lists that are not yet in one component are listed again by the rare part of their whole
       sets, which gives the pairs across components that can still be linked (see ``_crossing``). They
       pass the same filters. No pair within a component is needed.

    Lost links: a pair is missed only if its sketches agree less than ``agreeing`` says (default
    ``least_agreeing``: one in 10**9 at the similarity bound), or its bits differ in more than ``unlike``
    (default ``most_unlike``: one in 10**8). Both follow ``link``. No list, partner or
    candidate is capped.

    Null and empty texts have no shingles and stay alone, with themselves as component. Of rows that
    repeat an id, each takes part; all rows with the component's id count as kept. A null id is the
    component's id only if no member has another. Texts are read whole. Other columns are ignored.
    """
    return _labelled(docs, id_col, text_col, words, link, retained, agreeing, unlike).drop("text_md5", "node")


def _labelled(docs: DataFrame, id_col: str, text_col: str, words: int = WORDS, link: int = LINK, retained: int = RETAINED,
              agreeing: int | None = None, unlike: int | None = None) -> DataFrame:
    """The rows of ``near_duplicates`` with text_md5 and the component's node (null for a text without words)."""
    agreeing = least_agreeing(link, retained) if agreeing is None else agreeing
    unlike = most_unlike(link) if unlike is None else unlike
    texts = texts_of(docs, id_col, text_col)
    base = written(sketches(texts, words, retained), "near-sketches", BATCH_ROWS)
    firsts = base.filter("digest is not null").groupBy("digest").agg(
        F.min("doc_id").alias("doc_id"), F.min(F.struct("doc_id", "text_md5")).alias("row"), F.any_value("n_shingles").alias("n"), F.any_value("sketch").alias("sketch"))
    nodes = written(firsts.withColumn("node", F.monotonically_increasing_id()), "near-nodes")

    shared = _by_rarity(nodes.select("node", F.explode("sketch").alias("value")), ["node"])
    sizes = nodes.select("node", "n", F.size("sketch").alias("s"))
    need = F.ceil(F.col("s") * F.lit(agreeing) / F.lit(retained)).cast("int")
    room = F.col("s") - need + 1 - (F.col("s") - F.size("values"))
    lists = written(
        shared.join(sizes, "node").withColumn("room", room).filter("room > 0")
        .select("node", "n", F.explode(F.slice("values", F.lit(1), F.col("room"))).alias("v"))
        .select("node", "n", F.col("v.value").alias("value")),
        "near-lists")

    hubs = lists.groupBy("value").agg(F.min("node").alias("a"), F.count("*").alias("m")).filter("m > 1").select("value", "a")
    stars = lists.join(hubs, "value").filter("node <> a").select("a", F.col("node").alias("b")).distinct()
    tested = written(_agree(stars, nodes, retained, agreeing, link), "near-pairs")
    asked = tested.select(F.col("a").alias("node")).unionByName(tested.select(F.col("b").alias("node"))).distinct()
    sets = written(_whole_sets(nodes.join(asked, "node", "left_semi"), texts, words), "near-sets", BATCH_ROWS)
    links = written(_verified(tested, sets, link), "near-links")

    labels = connected(links)
    discard(links)
    with passing(docs.sparkSession) as keep:
        crossing, whole = _crossing(lists, labels, nodes, sets, texts, words, link, unlike)
        discard(sets)
        keep(whole)
        crossing = crossing.join(tested, ["a", "b"], "left_anti")
        crossing = keep(written(_agree(crossing, nodes, retained, agreeing, link), "near-pairs"))
    discard(lists, tested)
    more = written(_verified(crossing, whole, link), "near-links") if not crossing.isEmpty() else None
    discard(whole, crossing)
    if more is not None and not more.isEmpty():
        # The components so far are stars already, so only the new links take rounds.
        labels = connected(labels.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))

    placed = nodes.select("node", "digest", "doc_id").join(labels, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    heads = placed.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = placed.join(heads, "component").select("digest", "component_id", F.col("component").alias("node"))
    return base.select("doc_id", "n_shingles", "text_md5", "digest").join(named, "digest", "left").select(
        "text_md5", "node", "doc_id", "n_shingles",
        F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _rows_of(docs: DataFrame, chosen: DataFrame, id_col: str, text_col: str, digest: str) -> DataFrame:
    """Whole rows of the chosen (doc_id, text_md5) with a column ``digest``, a name that ``docs`` does not have."""
    wanted = chosen.select(F.col("doc_id").alias("id"), "text_md5").distinct().alias("wanted")
    marked = docs.withColumn(digest, F.unhex(F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))).alias("rows")
    same = F.col(f"rows.`{id_col}`").cast("long").eqNullSafe(F.col("wanted.id"))
    return marked.join(wanted, same & (F.col(f"rows.`{digest}`") == F.col("wanted.text_md5")), "left_semi")


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one whole row of each id that heads a component; columns unchanged, whatever their names.

    For tables whose ids are unique and not null. Of rows that repeat an id, the text with the smallest MD5
    stays, all null ids are one, and their other texts go; ``keep_every_component`` keeps them.
    """
    digest = unused(docs, "md5")
    kept = _labelled(docs, id_col, text_col, **options).filter("kept")
    chosen = kept.groupBy("doc_id").agg(F.min("text_md5").alias("text_md5"))
    return _rows_of(docs, chosen, id_col, text_col, digest).dropDuplicates([id_col]).drop(digest)


def keep_every_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one whole row of every component, whether ids are null, repeated or unique; columns unchanged.

    The row with the smallest id stays, a null id only if no member has another; of rows that share that id,
    the text with the smallest MD5. Equal rows of one id and text are one. A document without words is a
    component of its own, so all such rows stay.
    """
    digest = unused(docs, "md5")
    members = _labelled(docs, id_col, text_col, **options).filter("node is not null")
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_md5")
    chosen = members.groupBy("node").agg(F.min(first).alias("f")).select("f.doc_id", "f.text_md5")
    blank = F.translate(F.coalesce(F.col(text_col).cast("string"), F.lit("")), " \t\n\x0b\x0c\r", "") == ""
    worded = _rows_of(docs.filter(~blank), chosen, id_col, text_col, digest).dropDuplicates([id_col, digest]).drop(digest)
    return worded.unionByName(docs.filter(blank))
