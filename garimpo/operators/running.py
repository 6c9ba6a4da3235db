"""Running totals, ranks and exact quantiles that survive a hot key.

A window over one key sorts the whole key in one task. Here the key is cut into buckets
that follow the order, and neighbouring buckets into blocks: bucket and block totals come
from map-side combined aggregates, one window runs over the blocks of a key, one over the
buckets of a block, and the row-level window never sees more than one bucket. Any bucket
expression that does not decrease along the order gives exact results; a finer one only
spreads the work better.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from garimpo.session import fresh_path

BUCKET = "__bucket"
BLOCK = "__block"
# Buckets that make a block, where buckets are numbers.
PER_BLOCK = 1024

# How partial results of the same kind combine.
_COMBINE = {"sum": F.sum, "count": F.sum, "max": F.max, "min": F.min}
_START = {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min}


def _merge(how: str, a: Column, b: Column) -> Column:
    if how == "max":
        return F.greatest(a, b)
    if how == "min":
        return F.least(a, b)
    return F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))


def _block(kind: T.DataType) -> Column:
    """A coarser bucket: neighbouring numbers together, or the leading field of a struct."""
    if isinstance(kind, T.StructType):
        return F.col(BUCKET)[kind.fields[0].name]
    return F.floor(F.col(BUCKET) / PER_BLOCK) if isinstance(kind, T.NumericType) else F.col(BUCKET)


def totals_before(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    measures: dict[str, tuple[str, Column]],
    bucket: Column,
    overall: dict[str, str] | None = None,
) -> DataFrame:
    """Add, per row, totals over the rows of its key that sort strictly before it.

    ``measures`` maps an output column to ``(how, column)`` with how one of sum, count,
    max, min. ``order`` should be total; ``bucket`` must not decrease along it. ``overall`` maps
    a further output to a measure whose total over the whole key is wanted. Rows with a null
    key are kept and get their totals within their bucket only.
    """
    rows = df.withColumn(BUCKET, bucket)
    parts = rows.groupBy(*keys, BUCKET).agg(
        *(_START[how](col).alias(name) for name, (how, col) in measures.items())
    ).withColumn(BLOCK, _block(rows.schema[BUCKET].dataType))
    overall = overall or {}
    # Two levels: blocks of a key, then buckets of a block. No window sees all buckets of a hot key.
    blocks = parts.groupBy(*keys, BLOCK).agg(*(_COMBINE[how](name).alias(name) for name, (how, _) in measures.items()))
    whole = Window.partitionBy(*keys)
    before = whole.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    placed = blocks.select(
        *(F.col(k).alias(f"__b{i}") for i, k in enumerate(keys)),
        F.col(BLOCK).alias("__bb"),
        *(_COMBINE[how](name).over(before).alias(f"__far_{name}") for name, (how, _) in measures.items()),
        *(_COMBINE[measures[m][0]](m).over(whole).alias(name) for name, m in overall.items()),
    )
    earlier = Window.partitionBy(*keys, BLOCK).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    near = parts.select(
        *keys, BUCKET, BLOCK,
        *(_COMBINE[how](name).over(earlier).alias(f"__near_{name}") for name, (how, _) in measures.items()),
    )
    here = [F.col(k).eqNullSafe(F.col(f"__b{i}")) for i, k in enumerate(keys)] + [F.col(BLOCK).eqNullSafe(F.col("__bb"))]
    offsets = near.join(placed, here).select(
        *(F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)),
        F.col(BUCKET).alias("__kb"),
        *(_merge(how, F.col(f"__far_{n}"), F.col(f"__near_{n}")).alias(f"__off_{n}") for n, (how, _) in measures.items()),
        *overall,
    )
    inside = Window.partitionBy(*keys, BUCKET).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = rows.select(
        *(F.col(c) for c in rows.columns),
        *(_START[how](col).over(inside).alias(f"__in_{name}") for name, (how, col) in measures.items()),
    )
    same = [F.col(k) == F.col(f"__k{i}") for i, k in enumerate(keys)] + [F.col(BUCKET) == F.col("__kb")]
    joined = local.join(offsets, same, "left")
    return joined.select(
        *df.columns,
        *(_merge(how, F.col(f"__off_{n}"), F.col(f"__in_{n}")).alias(n) for n, (how, _) in measures.items()),
        *overall,
    )


def magnitude_bucket(value: Column, per_octave: int = 128) -> Column:
    """Monotone bucket of a number: logarithmic steps on both sides of zero, NaN on top.

    Steps are relative, so shares below one spread as prices do: 128 buckets between 0.5 and 1.
    """
    v = value.cast("double")
    # Doubles lie between 2 ** -1074 and 2 ** 1024, so a shifted logarithm is positive for every one.
    step = F.floor(F.least(F.log2(F.abs(v)), F.lit(1025.0)) * per_octave) + 1100 * per_octave
    signed = F.when(v == 0, F.lit(0)).when(v > 0, step).otherwise(-step)
    return F.when(F.isnan(v), F.lit(1 << 62)).otherwise(signed).cast("long")


def range_bucket(value: Column, width: int) -> Column:
    """Monotone bucket of an integer position."""
    return F.floor(value / width)


def position(df: DataFrame, order: str, name: str, width: int = 1 << 20) -> DataFrame:
    """Zero-based position of each row along a unique integer column, without a global sort."""
    keyed = df.withColumn("__all", F.lit(0))
    placed = totals_before(
        keyed, ["__all"], [order], {name: ("count", F.lit(1))}, range_bucket(F.col(order), width)
    )
    return placed.drop("__all")


def value_ranks(df: DataFrame, keys: Sequence[str], value: str, bucket: Column | None = None) -> DataFrame:
    """Distinct values per key with ``n`` (rows), ``n_before`` (rows below) and ``n_total``.

    Equal values are counted before anything is ordered, so ties cost nothing. The key comes as
    one struct ``__key``: it is never null, so groups with null parts are ranked like others and
    both uses of the counts share one shuffle.
    """
    present = df.where(F.col(value).isNotNull()).select(F.struct(*keys).alias("__key"), F.col(value).alias("__v"))
    counts = present.groupBy("__key", "__v").agg(F.count("*").alias("n"))
    return totals_before(
        counts, ["__key"], ["__v"], {"n_before": ("sum", F.col("n"))},
        magnitude_bucket(F.col("__v")) if bucket is None else bucket, {"n_total": "n_before"},
    )


def written_ranks(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``value_ranks`` as a table in the shared folder, for figures that all need the same ranks."""
    path = fresh_path(df.sparkSession, "ranks")
    value_ranks(df, keys, value).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float], ranked: DataFrame | None = None,
    distinct: str | None = None,
) -> DataFrame:
    """Exact linearly interpolated quantiles per key; no group is held in one task.

    ``ranked`` is a ``value_ranks`` of the same data, if there is one; ``distinct`` names a further
    output, the number of distinct values.
    """
    ranked = value_ranks(df, keys, value) if ranked is None else ranked

    def pick(place: Column) -> Column:
        hit = (F.col("n_before") <= place) & (place < F.col("n_before") + F.col("n"))
        return F.max(F.when(hit, F.col("__v").cast("double")))

    parts, outputs = [F.max("n_total").alias("__n")], []
    if distinct:
        parts.append(F.count("*").alias(distinct))
        outputs.append(F.col(distinct))
    for name, p in probs.items():
        place = F.lit(p) * (F.col("n_total") - 1)
        parts += [pick(F.floor(place)).alias(f"__lo_{name}"), pick(F.ceil(place)).alias(f"__hi_{name}")]
        low, high, at = F.col(f"__lo_{name}"), F.col(f"__hi_{name}"), F.lit(p) * (F.col("__n") - 1)
        outputs.append((low + (high - low) * (at - F.floor(at))).alias(name))
    return ranked.groupBy("__key").agg(*parts).select("__key.*", *outputs)


def percent_ranks(
    df: DataFrame, keys: Sequence[str], value: str, name: str, ranked: DataFrame | None = None
) -> DataFrame:
    """Add the percent rank of each row's value within its key; null values get null."""
    rank = F.when(F.col("n_total") > 1, F.col("n_before") / (F.col("n_total") - 1)).otherwise(0.0)
    ranked = value_ranks(df, keys, value) if ranked is None else ranked
    ranked = ranked.select(F.col("__key").alias("__rk"), F.col("__v").alias("__rv"), rank.alias(name))
    same = (F.struct(*keys) == F.col("__rk")) & (F.col(value) == F.col("__rv"))
    return df.join(ranked, same, "left").select(*df.columns, name)


def join_groups(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of two grouped results; null group keys meet each other."""
    renamed = right.select(*(F.col(c).alias(f"__g_{c}") if c in keys else F.col(c) for c in right.columns))
    same = [F.col(k).eqNullSafe(F.col(f"__g_{k}")) for k in keys]
    return left.join(renamed, same, "left").drop(*(f"__g_{k}" for k in keys))
