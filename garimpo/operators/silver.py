"""Clean records, derived columns, the integrated join and market prices."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from garimpo.functions.text import format_cnpj, normalize_cnpj
from garimpo.functions.timeparts import iso_timestamp
from garimpo.operators.dedupe import keep_first


def normal_text(col: Column) -> Column:
    """Upper case, no outer blanks, single inner blanks."""
    return F.upper(F.regexp_replace(F.trim(col), r"\s+", " "))


def clean(
    df: DataFrame, key: Sequence[str], order: Sequence[str], required: Sequence[str],
    amounts: Sequence[str] = (), dates: Sequence[str] = (), texts: Sequence[str] = (),
) -> DataFrame:
    """Cast, parse and normalise, drop rows lacking a required value, keep the first per key."""
    typed = df.withColumns({
        **{c: F.col(c).try_cast("decimal(15,2)") for c in amounts},
        **{c: F.to_date(iso_timestamp(F.col(c))) for c in dates},
        **{c: normal_text(F.col(c)) for c in texts},
    })
    return keep_first(typed.dropna(subset=list(required)), key, order)


def derive(
    df: DataFrame, number: str, year: str, awarded: str, estimated: str, company: str,
    durations: dict[str, tuple[str, str]],
) -> DataFrame:
    """Final value, record id, company id digits and format, durations in days."""
    return df.withColumns({
        "valor_final": F.coalesce(awarded, estimated),
        "licitacao_id": F.concat_ws("-", F.col(number).cast("string"), F.col(year).cast("string")),
        "cnpj": normalize_cnpj(F.col(company)),
        "cnpj_formatado": format_cnpj(F.col(company)),
        **{name: F.datediff(last, first) for name, (first, last) in durations.items()},
    })


@dataclass(frozen=True)
class Side:
    """A table joined to the records; the first row per key counts."""

    table: DataFrame
    on: dict[str, str]
    order: Sequence[str]
    columns: dict[str, str]


def integrate(records: DataFrame, sides: Sequence[Side]) -> DataFrame:
    """Left-join every side after reducing it to one row per key, so row counts do not change."""
    out = records
    for i, side in enumerate(sides):
        first = keep_first(side.table, list(side.on.values()), side.order)
        keys = {ours: f"__{i}_{theirs}" for ours, theirs in side.on.items()}
        first = first.select(
            *(F.col(theirs).alias(keys[ours]) for ours, theirs in side.on.items()),
            *(F.col(c).alias(name) for name, c in side.columns.items()),
        )
        out = out.join(first, [F.col(o) == F.col(k) for o, k in keys.items()], "left").drop(*keys.values())
    return out


def zscores(df: DataFrame, keys: Sequence[str], value: str, name: str = "z") -> DataFrame:
    """Standard score within the group; null where the deviation is zero or undefined.

    Group statistics are aggregated and joined back: no window gathers a group.
    """
    stats = df.groupBy(*(F.col(k).alias(f"__g{i}") for i, k in enumerate(keys))).agg(
        F.avg(value).alias("__mean"), F.stddev_samp(value).alias("__sd"))
    same = [F.col(k).eqNullSafe(F.col(f"__g{i}")) for i, k in enumerate(keys)]
    joined = df.join(stats, same, "left")
    z = F.when(F.col("__sd") > 0, (F.col(value) - F.col("__mean")) / F.col("__sd"))
    return joined.select(*df.columns, z.alias(name))


def normalise_prices(
    df: DataFrame, category: str, value: str, identical: Sequence[str], order: Sequence[str], limit: float = 3.0
) -> DataFrame:
    """Unify category names, drop outliers, keep one of identical products."""
    unified = df.withColumn(category, normal_text(F.col(category)))
    scored = zscores(unified, [category], value, "__z")
    kept = scored.where(F.col("__z").isNull() | (F.abs("__z") <= limit)).drop("__z")
    return keep_first(kept, identical, order)
