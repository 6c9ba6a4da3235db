"""Quality classifier on random-indexing word vectors and a small network (operator 6)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from garimpo.llm import words as W
from garimpo.llm.common import lean, ship, slices, utf8, written

#: Words are hashed to so many buckets, shapes to SHAPES; both have vectors of DIM numbers.
BUCKETS = 1 << 14
SHAPES = 512
DIM = 32
#: Nonzero entries of an index vector, and words on each side that make a context.
NONZERO = 4
SPAN = 2
#: Labelled documents that the network is fitted on, at most; a seeded sample of all labelled rows.
FIT_ROWS = 20_000
HIDDEN = 32
EPOCHS = 60
SEED = 20240611
THRESHOLD = 0.3
#: Text bytes whose words have their vectors in memory together; each of them takes about a hundred times its size.
CHUNK = 1 << 16

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[0x21:0x30] = _SYMBOLS[0x3A:0x41] = _SYMBOLS[0x5B:0x61] = _SYMBOLS[0x7B:0x7F] = True
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[0x30:0x3A] = True


def index_vectors() -> np.ndarray:
    """Sparse ternary vectors, one per bucket and shape; the same everywhere."""
    rng = np.random.Generator(np.random.PCG64(SEED))
    out = np.zeros((BUCKETS + SHAPES, DIM), np.float32)
    for sign in (1, -1):
        for _ in range(NONZERO // 2):
            out[np.arange(len(out)), rng.integers(0, DIM, len(out))] += sign
    return out


def word_codes(raw: np.ndarray, offsets: np.ndarray):
    """Bucket and shape of every word, and each text's first word."""
    starts, ends, first = W.spans(raw, offsets, W.BLANK_SEPARATED)
    hashes = W.hashes(raw, starts, ends, lower=False)

    def inside(kind):
        total = np.zeros(len(raw) + 1, np.int32)
        np.cumsum(kind[raw], out=total[1:])
        return total[ends] - total[starts]

    upper, digits, symbols, size = inside(_UPPER), inside(_DIGIT), inside(_SYMBOLS), ends - starts
    letters = size - digits - symbols
    lower = letters - upper
    case = np.where(upper == 0, 0, np.where(lower == 0, 2, np.where(upper == 1, 1, 3)))
    length = np.digitize(size, (2, 4, 8))
    again = np.zeros(len(hashes), np.int64)
    again[1:] = hashes[1:] == hashes[:-1]
    again[first[:-1][first[:-1] < len(hashes)]] = 0
    shape = ((((case * 2 + (lower > 0)) * 2 + (digits > 0)) * 4 + np.minimum(symbols, 3)) * 4 + length) * 2 + again
    return (hashes & np.uint64(BUCKETS - 1)).astype(np.int64), shape, first


def contexts(bucket: np.ndarray, shape: np.ndarray, first: np.ndarray, index: np.ndarray) -> np.ndarray:
    """Sum of the index vectors of each word's neighbours in its own text."""
    own = index[bucket] + index[BUCKETS + shape]
    out = np.zeros_like(own)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    for step in range(1, SPAN + 1):
        if len(own) > step:
            near = (text[step:] == text[:-step])[:, None]
            out[:-step] += own[step:] * near
            out[step:] += own[:-step] * near
    return out


def _added(table: np.ndarray, keys: np.ndarray, values: np.ndarray) -> None:
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    edges = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    table[ordered[edges]] += np.add.reduceat(values[order], edges, axis=0)


def word_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Unit context vectors of all buckets and shapes, summed over every word of every document, with weights.

    Tasks add up tables of fixed size; Spark sums them by bucket. The result has (BUCKETS + SHAPES) rows
    however large the corpus is, which bounds what the driver collects. The last column is the weight of
    a bucket: small for frequent ones.
    """
    ship(docs.sparkSession)
    rows = BUCKETS + SHAPES

    def run(batches):
        index = index_vectors()
        table = np.zeros((rows, DIM + 1), np.float64)
        for batch in batches:
            raw, offsets = utf8(batch.column(0))
            for a, b in slices(offsets, CHUNK):
                bucket, shape, first = word_codes(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                if not len(bucket):
                    continue
                around = np.concatenate((contexts(bucket, shape, first, index), np.ones((len(bucket), 1), np.float32)), axis=1)
                _added(table, bucket, around)
                _added(table, BUCKETS + shape, around)
        used = np.flatnonzero(table[:, DIM])
        columns = [pa.array(used.astype(np.int32))] + [pa.array(table[used, j].astype(np.int64)) for j in range(DIM + 1)]
        yield pa.RecordBatch.from_arrays(columns, names=["row"] + [f"c{j}" for j in range(DIM + 1)])

    schema = "row int, " + ", ".join(f"c{j} long" for j in range(DIM + 1))
    texts = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    sums = texts.mapInArrow(lean(run), schema).groupBy("row").agg(*[F.sum(f"c{j}").alias(f"c{j}") for j in range(DIM + 1)])
    found = sums.toPandas().to_numpy(np.float64)
    table = np.zeros((rows, DIM + 1))
    if len(found):
        table[found[:, 0].astype(np.int64)] = found[:, 1:]
    norm = np.linalg.norm(table[:, :DIM], axis=1, keepdims=True)
    share = table[:, DIM:] / max(1.0, table[:BUCKETS, DIM].sum())
    return np.concatenate((table[:, :DIM] / np.maximum(norm, 1e-9), 1e-3 / (1e-3 + share)), axis=1).astype(np.float32)


def pooled(raw: np.ndarray, offsets: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """One row per text: weighted mean of its words' vectors and mean of its shapes' vectors; zeros if empty."""
    out = np.zeros((len(offsets) - 1, 2 * DIM), np.float32)
    for a, b in slices(offsets, CHUNK):
        bucket, shape, first = word_codes(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
        full = np.flatnonzero(first[:-1] < first[1:])
        if not len(full):
            continue
        weight = vectors[bucket, DIM:]
        words = np.concatenate((vectors[bucket, :DIM] * weight, weight, vectors[BUCKETS + shape, :DIM]), axis=1)
        total = np.add.reduceat(words, first[:-1][full], axis=0, dtype=np.float64)
        count = np.diff(first)[full][:, None]
        out[a + full, :DIM] = total[:, :DIM] / np.maximum(total[:, DIM:DIM + 1], 1e-9)
        out[a + full, DIM:] = total[:, DIM + 1:] / count
    return out


class Network:
    """Two layers, fitted by Adam, with a temperature from labelled rows that the layers did not see."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = SEED):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.temperature = 1.0
        self.prior = (float(y.sum()) + 1.0) / (len(y) + 2.0)
        self.fitted = len(y) > 0 and 0 < y.sum() < len(y)
        if not self.fitted:
            return
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-3
        z = (x - self.mean) / self.scale
        order = rng.permutation(len(y))
        apart = len(y) // 5 if len(y) >= 50 else 0
        held, used = order[:apart], order[apart:]
        w = [rng.normal(0, 1 / np.sqrt(z.shape[1]), (z.shape[1], HIDDEN)), np.zeros(HIDDEN),
             rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
        m, v, t = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w], 0
        for _ in range(EPOCHS):
            for batch in np.array_split(rng.permutation(used), max(1, len(used) // 256)):
                h = np.tanh(z[batch] @ w[0] + w[1])
                p = 1 / (1 + np.exp(-np.clip(h @ w[2] + w[3][0], -30, 30)))
                d = (p - y[batch]) / len(batch)
                back = np.outer(d, w[2]) * (1 - h * h)
                grads = [z[batch].T @ back + 1e-4 * w[0], back.sum(0), h.T @ d + 1e-4 * w[2], np.array([d.sum()])]
                t += 1
                for i, g in enumerate(grads):
                    m[i] = 0.9 * m[i] + 0.1 * g
                    v[i] = 0.999 * v[i] + 0.001 * g * g
                    w[i] = w[i] - 3e-3 * (m[i] / (1 - 0.9 ** t)) / (np.sqrt(v[i] / (1 - 0.999 ** t)) + 1e-8)
        self.weights = w
        check = held if len(held) and 0 < y[held].sum() < len(held) else used
        logits, truth = self._logits(x[check]), y[check]
        grid = np.geomspace(0.25, 8, 61)
        losses = [np.mean(np.logaddexp(0, logits / g) - truth * logits / g) for g in grid]
        self.temperature = float(grid[int(np.argmin(losses))])

    def _logits(self, x: np.ndarray) -> np.ndarray:
        w = self.weights
        return np.tanh((x - self.mean) / self.scale @ w[0] + w[1]) @ w[2] + w[3][0]

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not self.fitted:
            return np.full(len(x), self.prior)
        return 1 / (1 + np.exp(-np.clip(self._logits(x) / self.temperature, -30, 30)))


def held_out(id_column):
    """Ids whose labels are never learnt from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(id_column.cast("long").cast("string")) % 5 == 0, F.lit(False))


def _features(docs: DataFrame, id_col: str, text_col: str, vectors: np.ndarray) -> DataFrame:
    def run(batches):
        for batch in batches:
            x = pooled(*utf8(batch.column(1)), vectors)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([row.tobytes() for row in x], pa.binary())], names=["doc_id", "features"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(lean(run), "doc_id long, features binary")


def _sampled_marks(labels: DataFrame, label_col: str, fit_rows: int, seed: int) -> DataFrame:
    """(doc_id, mark) of about twice ``fit_rows`` labelled documents, or of all if there are fewer."""
    marks = labels.filter(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    marks = marks.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.avg(label_col).alias("mark"))
    share = min(1.0, 2 * fit_rows / max(1, marks.count()))
    return marks.filter(F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))


def _fit(features: DataFrame, marks: DataFrame, fit_rows: int, seed: int) -> Network:
    # The marks are bounded by fit_rows, so they may be broadcast and one task may sort what they meet.
    rows = features.join(F.broadcast(marks), "doc_id")
    rows = rows.orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id", "features").limit(fit_rows)
    got = rows.select("features", "mark").toArrow()
    x = np.frombuffer(b"".join(got["features"].to_pylist()), np.float32).reshape(-1, 2 * DIM).astype(np.float64)
    return Network(x, (got["mark"].to_numpy() >= 0.5).astype(np.float64), seed)


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "quality", threshold: float = THRESHOLD, fit_rows: int = FIT_ROWS,
                   seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Word and shape vectors come from all documents; only texts are inputs of a score. The network is
    fitted on at most ``fit_rows`` labelled rows outside the held-out fold, chosen by a seeded hash.

    Null and empty texts have the zero vector and a score like any text. Rows that repeat an id are
    scored each; of labels that repeat an id the mean decides (a half is 1); null labels are ignored. A
    null id is not held out. Without labels of both kinds every score is the smoothed share of label 1.
    An empty table gives no rows. Other columns are ignored, whatever their names.
    """
    vectors = word_vectors(docs, text_col)
    features = written(_features(docs, id_col, text_col, vectors), "quality-features")
    network = _fit(features, _sampled_marks(labels, label_col, fit_rows, seed), fit_rows, seed)

    def run(batches):
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.float32).reshape(-1, 2 * DIM)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(network.scores(x.astype(np.float64)), pa.float64())], names=["doc_id", "score"])

    return features.mapInArrow(lean(run), "doc_id long, score double").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).cast("int").alias("predicted"))


def drop_rejected(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", threshold: float = THRESHOLD, fit_rows: int = FIT_ROWS,
                  seed: int = SEED) -> DataFrame:
    """``docs`` without the rows that score below the threshold; columns unchanged, nothing shuffled by text."""
    vectors = word_vectors(docs, text_col)
    marks = _sampled_marks(labels, label_col, fit_rows, seed)
    known = marks.select(F.col("doc_id").alias("labelled")).alias("known")
    rows = docs.alias("rows")
    marked = rows.join(F.broadcast(known), F.col(f"rows.`{id_col}`").cast("long") == F.col("known.labelled"), "left_semi")
    network = _fit(_features(marked, id_col, text_col, vectors), marks, fit_rows, seed)
    names, schema = docs.columns, docs.schema
    at = names.index(text_col)

    def run(batches):
        for batch in batches:
            scores = network.scores(pooled(*utf8(batch.column(at)), vectors).astype(np.float64))
            yield batch.filter(pa.array(scores >= threshold))

    return docs.mapInArrow(lean(run), schema).select(names)
