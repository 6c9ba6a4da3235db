"""Similar records by embedding: top k by cosine for given probes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from garimpo.functions.vectors import cosine_similarity, norm

# Probes and records that one tile compares; a task holds the vectors of one tile.
PROBE_BLOCK = 4096
RECORD_BLOCK = 8192
# What is known of all probes together is sent to every executor up to this size.
BROADCAST_BYTES = 64 << 20
# Probes whose distances rule out pairs; a sample of about SAMPLE records, at most one in SAMPLED, bounds them first.
PIVOTS = 8
SAMPLE = 2000
SAMPLED = 4


def similar_to(base: DataFrame, ident: str, vector: str, probe: Column, k: int = 10) -> DataFrame:
    """The k records nearest to one vector, ties by id. One scan; each task sends k rows."""
    held = base.select(ident, vector, probe.alias("__probe"))
    scored = held.select(ident, cosine_similarity(F.col(vector), F.col("__probe")).alias("similarity"))
    return scored.where(F.col("similarity").isNotNull()).orderBy(F.desc("similarity"), ident).limit(k)


def similar_to_id(base: DataFrame, ident: str, vector: str, wanted, k: int = 10) -> DataFrame:
    """The k records nearest to a stored record, itself left out."""
    probe = base.where(F.col(ident) == F.lit(wanted)).agg(F.first(vector)).scalar()
    return similar_to(base.where(F.col(ident) != F.lit(wanted)), ident, vector, probe, k)


def _distance(similarity: Column) -> Column:
    """Distance of unit vectors from their cosine; unlike the cosine it obeys the triangle inequality."""
    return F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * similarity))


def _pivot_distances(vector: Column, pivots: list) -> Column:
    return F.array(*[_distance(cosine_similarity(vector, F.lit(p))) for p in pivots]).cast("array<double>")


def _best(scored: DataFrame, ident: str, k: int) -> DataFrame:
    order = Window.partitionBy("probe").orderBy(F.desc("similarity"), ident)
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _best_of_tile(k: int):
    """A function of two Arrow tables, records and probes: the k best records of each probe among these.

    Products of matrices name the records that may be among the k best; those are scored in the order of
    ``cosine_of``, so that scores and ties are its own. Vectors whose norm leaves the range where the two
    differ by far less than ``slack`` are scored that way with all others.
    """
    slack, chunk, step = 1e-9, 256, 1 << 18

    def run(records: pa.Table, asked: pa.Table) -> pa.Table:
        if not len(records) or not len(asked):
            none = [asked.column(2).slice(0, 0), records.column(2).slice(0, 0), pa.array([], pa.float64())]
            return pa.table(none, names=["probe", records.column_names[2], "similarity"])
        records, asked = records.combine_chunks(), asked.combine_chunks()
        records = records.take(pc.sort_indices(records.column(2)))

        def flat(table, name):
            column = table.column(name).combine_chunks()
            ends = np.append(0, np.cumsum(pc.list_value_length(column).to_numpy(zero_copy_only=False))).astype(np.int64)
            return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64), ends

        def known(table, name):
            return pc.fill_null(table.column(name), float("nan")).to_numpy().astype(np.float64)

        names = pa.concat_arrays(records.column(2).chunks + asked.column(2).chunks).dictionary_encode()
        codes = names.indices.to_numpy()
        own, other = codes[:len(records)], codes[len(records):]
        (values, ends), (probed, probe_ends) = flat(records, "__v"), flat(asked, "__v")
        norms, probe_norms = known(records, "__n"), known(asked, "__n")
        away, probe_away = flat(records, "__d")[0].reshape(len(records), -1), flat(asked, "__d")[0].reshape(len(asked), -1)
        reach, least = known(asked, "__reach"), known(asked, "__least")
        sizes, probe_sizes = np.diff(ends), np.diff(probe_ends)
        usual, probe_usual = ((n > 1e-100) & (n < 1e100) for n in (norms, probe_norms))
        found = []

        def keep_best(at, to, score):
            """The k best of each probe among scored pairs; NaN counts as largest, ties go by the records' order."""
            order = np.lexsort((at, -np.where(np.isnan(score), 0, score), ~np.isnan(score), to))
            at, to, score = at[order], to[order], score[order]
            first = np.flatnonzero(np.append(True, to[1:] != to[:-1])) if len(to) else np.empty(0, np.int64)
            place = np.arange(len(to)) - np.repeat(first, np.diff(np.append(first, len(to))))
            return tuple(x[place < k] for x in (at, to, score))

        def exact(at, to, x, y, rows, cols):
            best = tuple(np.empty(0, t) for t in (np.int64, np.int64, np.float64))
            for i in range(0, len(at), step):
                a, t = at[i:i + step], to[i:i + step]
                scale = norms[rows[a]] * probe_norms[cols[t]]
                fit = (scale != 0) & (own[rows[a]] != other[cols[t]])
                a, t, scale = a[fit], t[fit], scale[fit]
                dot = np.zeros(len(a))
                for c in range(x.shape[1]):
                    dot += x[a, c] * y[t, c]
                best = keep_best(*(np.concatenate(z) for z in zip(best, (rows[a], cols[t], dot / scale))))
            found.append(best)

        with np.errstate(all="ignore"):
            for size in np.intersect1d(sizes, probe_sizes):
                rows, cols = np.flatnonzero(sizes == size), np.flatnonzero(probe_sizes == size)
                # Probes that lie alike towards the pivots ask for the same records.
                d = probe_away[cols]
                if d.shape[1]:
                    nearest = np.where(np.isnan(d), np.inf, d)
                    cols = cols[np.lexsort((nearest.min(axis=1), nearest.argmin(axis=1)))]
                x = values[ends[rows][:, None] + np.arange(size)]
                y = probed[probe_ends[cols][:, None] + np.arange(size)]
                plain, plain_probe = usual[rows], probe_usual[cols]
                unit, unit_probe = x / norms[rows][:, None], y / probe_norms[cols][:, None]
                for i in range(0, len(cols), chunk):
                    some = np.arange(i, min(i + chunk, len(cols)))
                    odd = some[~plain_probe[some]]
                    for one in odd:
                        exact(np.arange(len(rows)), np.full(len(rows), one), x, y, rows, cols)
                    some = some[plain_probe[some]]
                    if not len(some):
                        continue
                    # A comparison with an unknown distance or bound is false and rules nothing out.
                    near = away[rows]
                    low, high = (probe_away[cols[some]] + sign * reach[cols[some]][:, None] for sign in (-1, 1))
                    out = (near < low.min(axis=0)) | (near > high.max(axis=0))
                    stay = np.flatnonzero(plain & ~out.any(axis=1))
                    odd = np.flatnonzero(~plain & (norms[rows] != 0))
                    at = [np.tile(odd, len(some))]
                    to = [np.repeat(some, len(odd))]
                    if len(stay):
                        rough = unit_probe[some] @ unit[stay].T
                        # A probe's own record is no answer, nor does it count among the k best.
                        rough[other[cols[some]][:, None] == own[rows[stay]][None, :]] = -np.inf
                        bound = least[cols[some]] - slack
                        bound[np.isnan(bound)] = -2.0
                        many = np.flatnonzero((rough >= bound[:, None]).sum(axis=1) > 8 * k)
                        if len(many):
                            kth = np.partition(rough[many], len(stay) - k, axis=1)[:, len(stay) - k]
                            bound[many] = np.maximum(bound[many], kth - slack)
                        t, a = np.nonzero(rough >= bound[:, None])
                        at.append(stay[a])
                        to.append(some[t])
                    exact(np.concatenate(at), np.concatenate(to), x, y, rows, cols)
        at, to, score = (np.concatenate([f[i] for f in found]) if found else np.empty(0, np.int64) for i in range(3))
        return pa.table([asked.column(2).take(pa.array(to)), records.column(2).take(pa.array(at)),
                         pa.array(score, pa.float64())], names=["probe", records.column_names[2], "similarity"])

    return run


def _scored(base: DataFrame, ident: str, asked: DataFrame, tiles: tuple[int, int], k: int) -> DataFrame:
    """(probe, ident, similarity): the k best records of each probe in every tile of records and probes."""
    def dealt(rows: DataFrame, mine: str, its: str, own: int, others: int) -> DataFrame:
        rows = rows.withColumn(mine, F.pmod(F.monotonically_increasing_id(), F.lit(own)))
        rows = rows.withColumn(its, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(others - 1).cast("long"))))
        return rows.select("__r", "__p", *[c for c in rows.columns if c not in ("__r", "__p")])

    records, probes = tiles
    kind = base.schema[ident].dataType
    schema = StructType([StructField("probe", kind), StructField(ident, kind), StructField("similarity", DoubleType())])
    one = dealt(base, "__r", "__p", records, probes).groupBy("__r", "__p")
    two = dealt(asked, "__p", "__r", probes, records).groupBy("__r", "__p")
    return one.cogroup(two).applyInArrow(_best_of_tile(k), schema)


def similar_batch(
    base: DataFrame, ident: str, vector: str, probes: DataFrame, k: int = 10, block: int = PROBE_BLOCK,
    pivots: int = PIVOTS, sample: int = SAMPLE,
) -> DataFrame:
    """The k nearest records of each probe (same columns as the base), the probe itself left out. Exact.

    Probes and records are dealt into tiles of about ``block`` probes and RECORD_BLOCK records, so a task
    holds two bounded sets of vectors whatever their number. A tile hands on k records per probe.

    A probe's k-th distance within a sample of the base bounds its true one. A record whose distance to some
    pivot differs from the probe's by more than that cannot be nearer (triangle inequality), so its score
    is not computed; neighbouring probes are asked together. Records and probes know their distances to ``pivots``
    probes. Where vectors have no structure nothing is ruled out and the work is records times probes.
    """
    return _best(candidates(base, ident, vector, probes, k, block, pivots, sample), ident, k)


def candidates(
    base: DataFrame, ident: str, vector: str, probes: DataFrame, k: int = 10, block: int = PROBE_BLOCK,
    pivots: int = PIVOTS, sample: int = SAMPLE,
) -> DataFrame:
    """The scored pairs that ``similar_batch`` ranks: k of every tile and probe, at most."""
    # Rows without an id, and vectors that hold a null, are in no pair.
    first = probes.where(F.col(vector).isNotNull()).orderBy(F.xxhash64(ident), ident).select(vector).limit(pivots).collect()
    points = [r[0] for r in first]
    total, count = probes.count(), base.count()
    small = total * 32 <= BROADCAST_BYTES
    own = _pivot_distances(F.col(vector), points)

    def held(rows: DataFrame) -> DataFrame:
        rows = rows.select(F.col(ident).alias(ident), F.col(vector).cast("array<double>").alias("__v"), norm(F.col(vector)).alias("__n"), own.alias("__d"))
        return rows.where(F.col(ident).isNotNull() & F.col("__n").isNotNull())

    records, asked = held(base), held(probes)
    share = max(SAMPLED, count // sample)
    few = records.where(F.pmod(F.xxhash64(F.lit(share), ident), F.lit(share)) == 0)
    unbound = asked.withColumn("__reach", F.lit(None).cast("double")).withColumn("__least", F.lit(None).cast("double"))
    blocks = max(1, -(-total // block))
    known = _best(_scored(few, ident, unbound, (max(1, -(-count // (share * RECORD_BLOCK))), blocks), k), ident, k)
    known = known.groupBy(F.col("probe").alias("__probe")).agg(F.count("*").alias("n"), F.min("similarity").alias("least"))
    # The slack is above what rounding may add to a distance.
    known = known.where(F.col("n") == k).select(
        "__probe", (_distance(F.col("least")) + 1e-6).alias("__reach"), F.col("least").alias("__least"))
    asked = asked.join(F.broadcast(known) if small else known, F.col(ident) == F.col("__probe"), "left").drop("__probe")
    return _scored(records, ident, asked, (max(1, -(-count // RECORD_BLOCK)), blocks), k)
