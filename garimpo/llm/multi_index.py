"""Nearest neighbours by an inverted multi-index (operator 11)."""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from garimpo.llm.common import ship, written
from garimpo.llm.vectors import finite_vectors, matrix, nonzero

NEIGHBOURS = 5
#: Queries are rows whose id is divisible by EVERY.
EVERY = 50
#: Centroids of each half; the index has CENTROIDS**2 cells.
CENTROIDS = 64
#: Distinct vectors that the centroids and the margin are fitted on, at most; every vector is indexed.
FIT_ROWS = 20_000
#: Vectors that the first pass reaches at least.
FIRST = 500
#: Share of true neighbours whose cell the second pass reaches, as measured on the fit rows.
REACHED = 0.8
#: Index vectors and queries that meet in one task, at most; larger lists are dealt to several tasks.
ENTRY_BLOCK = 8192
QUERY_BLOCK = 2048
SEED = 20240611


def units(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one; a power of two is taken out first, so that no square overflows."""
    scaled = np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, keepdims=True))[1])
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``a`` with the row of ``b`` beside it; equal pairs of rows get equal numbers."""
    a = np.ldexp(a, -np.frexp(np.abs(a).max(axis=1, keepdims=True))[1])
    b = np.ldexp(b, -np.frexp(np.abs(b).max(axis=1, keepdims=True))[1])
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def _nearest(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.argmin((centroids ** 2).sum(axis=1) - 2 * points @ centroids.T, axis=1)


def _means(points: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Centroids of ``points`` by Lloyd's rounds from seeded rows; one that loses all its points stays."""
    centroids = points[np.random.Generator(np.random.PCG64(SEED)).choice(len(points), k, replace=False)]
    for _ in range(rounds):
        own = _nearest(points, centroids)
        count = np.bincount(own, minlength=k)
        total = np.zeros_like(centroids)
        np.add.at(total, own, points)
        centroids = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centroids)
    return centroids


class Codebook:
    """Centroids of both halves of unit vectors, and how far a neighbour's cell may lie beyond the neighbour."""

    def __init__(self, sample: np.ndarray, centroids: int, reached: float, k: int):
        points = units(sample)
        self.cut = points.shape[1] // 2
        # Rows that did not shape the centroids tell how well cells stand for unseen rows.
        fitted, unseen = points[::2], points[1::2]
        size = max(1, min(centroids, len(fitted) // 8))
        self.halves = [_means(half, size) for half in self._cut(fitted)]
        self.margin = self._excess(unseen if len(unseen) else fitted, reached, k)

    def _cut(self, points: np.ndarray):
        return points[:, :self.cut], points[:, self.cut:]

    def cells(self, points: np.ndarray) -> list[np.ndarray]:
        return [_nearest(half, c) for half, c in zip(self._cut(points), self.halves)]

    def distances(self, points: np.ndarray) -> list[np.ndarray]:
        """Squared distance of each point's halves to all centroids of that half."""
        return [np.maximum(0, (half ** 2).sum(axis=1, keepdims=True) - 2 * half @ c.T + (c ** 2).sum(axis=1))
                for half, c in zip(self._cut(points), self.halves)]

    def _excess(self, points: np.ndarray, reached: float, k: int) -> float:
        """Of distances to the cell of a true neighbour less that to the neighbour, the quantile ``reached``."""
        asking = points[:512]
        true = asking @ points.T
        true[np.arange(len(asking)), np.arange(len(asking))] = -2
        near = np.argsort(-true, axis=1, kind="stable")[:, :k]
        first, second = self.distances(asking)
        i, j = self.cells(points)
        to_cell = first[np.arange(len(asking))[:, None], i[near]] + second[np.arange(len(asking))[:, None], j[near]]
        return float(np.quantile(to_cell - (2 - 2 * np.take_along_axis(true, near, axis=1)), reached))


def traversal(first: np.ndarray, second: np.ndarray):
    """Pairs (distance, i, j) by growing summed distance, from the distances to the centroids of both halves.

    A heap holds at most one open pair per centroid of the first half; taking a pair opens its two successors.
    """
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    da, db = first[a].tolist(), second[b].tolist()
    heap = [(da[0] + db[0], 0, 0)]
    while heap:
        distance, x, y = heapq.heappop(heap)
        yield distance, int(a[x]), int(b[y])
        if y + 1 < len(db):
            heapq.heappush(heap, (da[x] + db[y + 1], x, y + 1))
        if y == 0 and x + 1 < len(da):
            heapq.heappush(heap, (da[x + 1] + db[0], x + 1, 0))


def index(vectors: DataFrame, keep: int) -> DataFrame:
    """(h, v, ids): each distinct vector with the smallest ``keep`` ids that hold it, ascending, null last.

    No row beyond these can be among ``keep`` nearest, for equal vectors are equally near. Copies meet as
    rows of one id first; the rank limit works within tasks before the shuffle, so a vector that a third of
    all rows hold is ``keep`` rows a task.
    """
    distinct = vectors.select("vec_id", "v", F.xxhash64("v").alias("h")).distinct()
    order = Window.partitionBy("h", "v").orderBy(F.asc_nulls_last("vec_id"))
    ranked = distinct.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= keep)
    by_rank = F.array_sort(F.collect_list(F.struct("r", "vec_id")))
    return ranked.groupBy("h", "v").agg(F.transform(by_rank, lambda x: x.vec_id).alias("ids"))


def _sample(entries: DataFrame, rows: int) -> np.ndarray:
    """About ``rows`` distinct vectors at most, chosen by hash, in the order of their hash."""
    total = entries.count()
    share = min(1.0, rows / max(1, total))
    bound = int((2 * share - 1) * (1 << 63)) - (share >= 1)
    found = entries.filter(F.xxhash64("h") <= bound).orderBy("h").select("v").limit(rows).toArrow()
    return matrix(found.column(0))


def nearest(
    embeddings: DataFrame, k: int = NEIGHBOURS, every: int = EVERY, id_col: str = "vec_id", vector_col: str = "embedding",
    centroids: int = CENTROIDS, fit_rows: int = FIT_ROWS, first: int = FIRST, reached: float = REACHED,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest rows found for each row whose id ``every`` divides.

    Both halves of a unit vector are quantised on their own; every distinct vector is listed under its pair
    of centroids. A query takes pairs off a heap by summed distance, first until ``first`` vectors are
    reached. Their exact scores bound its neighbours' distance; the second pass goes on to all pairs within
    that distance and a margin that ``reached`` of the true neighbours of fit rows keep. There is no cap on
    vectors or lists. Lists are dealt to blocks of ENTRY_BLOCK vectors and QUERY_BLOCK queries, so no list
    is one task's, and reranked by cosine in double precision on the original vectors; ties go to the
    smaller id, null ids last.

    Only one of equal vectors is searched: it stands for all queries that hold it. Vectors that are null,
    zero, empty, hold null or non-finite entries or have another length than most take no part. A row with a
    null id is a candidate, not a query. Repeated rows count once; where an id has several vectors, each of
    them is a query and a candidate of other ids, never of its own. Fewer candidates than ``k`` are all
    returned; an empty table gives no rows. Other input columns are ignored, whatever their names.
    """
    spark = embeddings.sparkSession
    ship(spark)
    vectors = finite_vectors(embeddings, id_col, vector_col).filter(nonzero(F.col("v")))
    entries = written(index(vectors, k + 1), "multi-index-vectors")
    sample = _sample(entries, fit_rows)
    schema = "query_id long, rank int, vec_id long, score double"
    if not len(sample):
        return spark.createDataFrame([], schema)
    book = Codebook(sample, centroids, reached, k)
    listed = written(_listed(entries, book), "multi-index-lists")
    sizes = np.zeros([len(c) for c in book.halves], np.int64)
    for r in listed.groupBy("i", "j").count().collect():
        sizes[r.i, r.j] = r["count"]

    asked = vectors.filter(F.col("vec_id") % every == 0).select("vec_id", "v", F.xxhash64("v").alias("h")).distinct()
    several = asked.groupBy("vec_id").agg(F.count("*").alias("n")).filter("n > 1").select("vec_id", F.col("vec_id").alias("own"))
    asked = written(asked.join(several, "vec_id", "left"), "multi-index-queries")
    # One search stands for all queries with a vector; ids that have several vectors are searched on their own.
    keys = written(asked.groupBy("h", "v", "own").agg(F.min("vec_id").alias("q")).select("q", "h", "own", "v"), "multi-index-keys")
    unbound = keys.withColumn("bound", F.lit(None).cast("double"))
    near = written(_best(_scored(unbound, listed, sizes, book, k + 1, first, False), k + 1), "multi-index-first")
    reach = near.groupBy("q", "h").agg(F.count("*").alias("n"), F.min("score").alias("least")).select(
        "q", "h", F.when(F.col("n") > k, 2 - 2 * F.col("least") + book.margin).alias("bound"))
    rest = _scored(keys.join(reach, ["q", "h"], "left"), listed, sizes, book, k + 1, first, True)
    answers = _best(near.drop("r").unionByName(rest), k + 1).groupBy("q", "h").agg(
        F.array_sort(F.collect_list(F.struct("r", "vec_id", "score"))).alias("found"))
    asks = asked.alias("a").join(
        keys.alias("b"), F.expr("a.h = b.h AND a.v = b.v AND a.own <=> b.own")).select("a.vec_id", "b.q", "b.h")
    others = F.filter("found", lambda x: ~x.vec_id.eqNullSafe(F.col("query_id")))
    return (
        asks.withColumnRenamed("vec_id", "query_id").join(answers, ["q", "h"])
        .select("query_id", F.posexplode(F.slice(others, 1, k)).alias("at", "x"))
        .select("query_id", (F.col("at") + 1).alias("rank"), "x.vec_id", "x.score"))


def _best(scored: DataFrame, keep: int) -> DataFrame:
    order = Window.partitionBy("q", "h").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return scored.select("q", "h", "vec_id", "score").withColumn("r", F.row_number().over(order)).filter(F.col("r") <= keep)


def _listed(entries: DataFrame, book: Codebook) -> DataFrame:
    """``entries`` with the pair of centroids (i, j) that lists each vector."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                i, j = book.cells(units(matrix(batch.column(1))))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32))], names=["h", "v", "ids", "i", "j"])

    return entries.select("h", "v", "ids").mapInArrow(run, "h long, v array<double>, ids array<long>, i int, j int")


def _probes(keys: DataFrame, sizes: np.ndarray, book: Codebook, first: int, further: bool) -> DataFrame:
    """(q, h, own, v, i, js): the lists that a query visits, by the first half's centroid.

    The first pass takes pairs until ``first`` vectors are listed there. The ``further`` pass takes the pairs
    behind these, up to the query's bound, or all of them where it has none.
    """

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            at, halves, lists_of = [], [], []
            bounds = batch.column(4).to_pylist()
            for row, (a, b) in enumerate(zip(*book.distances(units(matrix(batch.column(3)))))):
                seen, took = 0, {}
                bound = math.inf if bounds[row] is None else bounds[row]
                for distance, i, j in traversal(a, b):
                    early = seen < first
                    if not early and (not further or distance > bound):
                        break
                    seen += int(sizes[i, j])
                    if sizes[i, j] and early != further:
                        took.setdefault(i, []).append(j)
                at += [row] * len(took)
                halves += took
                lists_of += took.values()
            taken = batch.select([0, 1, 2, 3]).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*taken.columns, pa.array(halves, pa.int32()), pa.array(lists_of, pa.list_(pa.int32()))],
                names=["q", "h", "own", "v", "i", "js"])

    return keys.select("q", "h", "own", "v", "bound").mapInArrow(
        run, "q long, h long, own long, v array<double>, i int, js array<int>")


def _blocks(counts: np.ndarray, most: int):
    """Column: into how many blocks the rows of centroid ``i`` are dealt."""
    return F.element_at(F.array(*[F.lit(max(1, -(-int(c) // most))) for c in counts]), F.col("i") + 1)


def _scored(
    keys: DataFrame, listed: DataFrame, sizes: np.ndarray, book: Codebook, keep: int, first: int, further: bool,
) -> DataFrame:
    """(q, h, vec_id, score): of every block that a query visits, the ``keep`` nearest rows."""
    probes = written(_probes(keys, sizes, book, first, further), "multi-index-probes")
    asking = np.zeros(len(sizes), np.int64)
    for r in probes.groupBy("i").count().collect():
        asking[r.i] = r["count"]
    entry_blocks, query_blocks = _blocks(sizes.sum(axis=1), ENTRY_BLOCK), _blocks(asking, QUERY_BLOCK)
    key = ["i", "e", "b"]
    left = probes.withColumn("b", F.pmod(F.xxhash64("q", "h"), query_blocks).cast("int")).withColumn(
        "e", F.explode(F.sequence(F.lit(0), entry_blocks - 1)))
    visited = F.element_at(F.array(*[F.lit(bool(c)) for c in asking]), F.col("i") + 1)
    right = listed.filter(visited).withColumn("e", F.pmod(F.xxhash64("h"), entry_blocks).cast("int")).withColumn(
        "b", F.explode(F.sequence(F.lit(0), query_blocks - 1)))
    width = sizes.shape[1]
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(
        lambda queries, rows: _reranked(queries, rows, width, keep), "q long, h long, vec_id long, score double")


def _reranked(queries: pa.Table, rows: pa.Table, width: int, keep: int) -> pa.Table:
    names = ["q", "h", "vec_id", "score"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.float64()]
    if not queries.num_rows or not rows.num_rows:
        return pa.Table.from_arrays([pa.array([], t) for t in types], names=names)
    asked, vectors = matrix(queries["v"]), matrix(rows["v"])
    listed_at = rows["j"].to_numpy()
    ids = rows["ids"].to_pylist()
    alone = np.array([x[0] if len(x) == 1 and x[0] is not None else -1 for x in ids], np.int64)
    single = np.array([len(x) == 1 and x[0] is not None for x in ids])
    own, visits = queries["own"].to_pylist(), queries["js"].to_pylist()
    unit = units(vectors).T
    at, found, scores = [], [], []
    for a in range(0, len(asked), 256):
        close = units(asked[a:a + 256]) @ unit
        for row in range(len(close)):
            allowed = np.zeros(width, bool)
            allowed[visits[a + row]] = True
            ok = allowed[listed_at]
            mine = own[a + row]
            if mine is not None:
                ok &= ~(single & (alone == mine))
            near = np.flatnonzero(ok)
            if len(near) > keep:
                value = close[row][near]
                # What rounding may have put behind the last one kept is compared exactly too.
                near = near[value >= np.partition(value, len(value) - keep)[len(value) - keep] - 1e-9]
            if not len(near):
                continue
            exact = cosines(np.broadcast_to(asked[a + row], (len(near), asked.shape[1])), vectors[near])
            pairs = sorted(((-s, i is None, i or 0) for s, n in zip(exact.tolist(), near) for i in ids[n]
                            if mine is None or i != mine))[:keep]
            at += [a + row] * len(pairs)
            found += [None if null else i for _, null, i in pairs]
            scores += [-s for s, _, _ in pairs]
    return pa.Table.from_arrays([
        queries["q"].take(pa.array(at, pa.int64())), queries["h"].take(pa.array(at, pa.int64())),
        pa.array(found, pa.int64()), pa.array(scores, pa.float64())], names=names)
