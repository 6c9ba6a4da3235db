"""Mergeable price references: sketches per day that are merged for any range of days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from garimpo.operators.gold import REFERENCE_QUANTILES

# Size of a KLL sketch. A quantile's rank is off by about 0.7 % of the rows at one end of a 99 % interval.
K = 400


def daily_references(df: DataFrame, keys: Sequence[str], day: str, value: str, k: int = K) -> DataFrame:
    """One row per group and day: sketch, count, sum and extremes. Nulls and NaN are left out.

    Sketches are built per task and merged, so a hot group costs one sketch per task. A day's rows are final
    once the day is; a new day adds rows and touches no old ones.
    """
    price = F.col(value).cast("double")
    base = df.select(*keys, F.col(day).alias("day"), price.alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    return base.groupBy(*keys, "day").agg(
        F.kll_sketch_agg_double("v", F.lit(k)).alias("sketch"), F.count("*").alias("n"), F.sum("v").alias("total"),
        F.min("v").alias("low"), F.max("v").alias("high"))


def reference_over(
    daily: DataFrame, keys: Sequence[str], first: Column | None = None, last: Column | None = None,
    wanted: dict[str, float] = REFERENCE_QUANTILES, k: int = K,
) -> DataFrame:
    """Count, mean, extremes (exact) and quantiles (by sketch) per group over a range of days, both ends included.

    An end that is not given is open. Reads one row per group and day, never the records.
    """
    kept = daily if first is None else daily.where(F.col("day") >= first)
    kept = kept if last is None else kept.where(F.col("day") <= last)
    merged = kept.groupBy(*keys).agg(
        F.sum("n").alias("n"), (F.sum("total") / F.sum("n")).alias("mean"), F.min("low").alias("low"),
        F.max("high").alias("high"), F.kll_merge_agg_double("sketch", F.lit(k)).alias("__sketch"))
    named = [F.kll_sketch_get_quantile_double("__sketch", F.lit(float(q))).alias(c) for c, q in wanted.items()]
    return merged.select(*keys, "n", "mean", "low", "high", *named)


def rank_errors(df: DataFrame, keys: Sequence[str], value: str, reference: DataFrame, wanted: dict[str, float]) -> DataFrame:
    """How far the rank of each estimated quantile is from the one wanted, as a share of the group's rows.

    A value that repeats covers a span of ranks; the distance to that span counts. One pass over the records.
    """
    price = F.col(value).cast("double")
    base = df.select(*keys, price.alias("__v")).where(F.col("__v").isNotNull() & ~F.isnan("__v"))
    joined = base.join(reference.select(*keys, *wanted), list(keys))
    counts = [F.avg((F.col("__v") < F.col(c)).cast("double")).alias(f"__b_{c}") for c in wanted]
    counts += [F.avg((F.col("__v") <= F.col(c)).cast("double")).alias(f"__u_{c}") for c in wanted]
    spans = joined.groupBy(*keys).agg(*counts)
    off = [F.greatest(F.lit(0.0), F.col(f"__b_{c}") - q, q - F.col(f"__u_{c}")).alias(c) for c, q in wanted.items()]
    return spans.select(*keys, *off)
