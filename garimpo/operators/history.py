"""What was known before each record: company and buyer history, sanctions, overlaps.

All of it uses ``totals_before`` with one bucket per day, so a company that owns a third of all
records is spread over as many tasks as it has days. Rows without a key have no history: counts
are zero and everything else is null. ``totals`` replaces the running totals over the given rows, as
``operators/carried.py`` does to start from what earlier runs have gathered.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from garimpo.operators.nested import ROWS_BYTES, parts_for
from garimpo.operators.running import totals_before


def day_bucket(at: Column, within: Column | None = None) -> Column:
    """One bucket per day, or several when ``within`` grows along the order inside a day."""
    number = F.unix_date(F.to_date(at))
    return number if within is None else F.struct(number.alias("day"), within.alias("part"))


def company_history(
    df: DataFrame, company: str, start: str, ident: str, value: Column, won: Column, end: str,
    totals: Callable[..., DataFrame] = totals_before,
) -> DataFrame:
    """Earlier records of the company, their value and win rate, its age and running contracts.

    Ends of contracts enter the running total as -1 on the day after, so open contracts need no
    self-join. A contract that ends before it starts is never running; one without a start has no
    day and therefore no end either.
    """
    runs = F.col(end).isNull() | (F.to_date(end) >= F.to_date(start))
    records = df.withColumns({
        "__kind": F.lit(1), "__at": F.to_date(start), "__value": value, "__won": won.cast("int"),
        "__delta": F.coalesce(runs, F.lit(False)).cast("int"), "__id": F.col(ident),
    })
    ends = df.where(F.col(end).isNotNull() & runs & F.col(company).isNotNull()).select(
        company, F.lit(0).alias("__kind"), F.date_add(F.to_date(end), 1).alias("__at"),
        F.lit(-1).alias("__delta"), F.lit(None).cast(df.schema[ident].dataType).alias("__id"),
    )
    both = records.unionByName(ends, allowMissingColumns=True)
    is_record = F.col("__kind") == 1
    known = totals(
        both, [company], ["__at", "__kind", "__id"],
        {
            "previous_count": ("sum", F.col("__kind")),
            "previous_value": ("sum", F.col("__value")),
            "__wins": ("sum", F.col("__won")),
            "__first": ("min", F.when(is_record, F.col("__at"))),
            "__last": ("max", F.when(is_record, F.col("__at"))),
            "active_contracts": ("sum", F.col("__delta")),
        },
        day_bucket(F.col("__at")),
    ).where(is_record)
    has_key = F.col(company).isNotNull()
    out = known.withColumns({
        "previous_count": F.when(has_key, F.col("previous_count")).otherwise(0),
        "previous_value": F.when(has_key, F.coalesce("previous_value", F.lit(0))),
        "win_rate": F.when(has_key, F.try_divide(F.col("__wins"), F.col("previous_count"))),
        "age_years": F.when(has_key, F.months_between("__at", "__first", False) / 12),
        "days_since_previous": F.when(has_key, F.datediff("__at", "__last")),
        "active_contracts": F.when(has_key, F.col("active_contracts")).otherwise(0),
    })
    return out.select(
        *df.columns, "previous_count", "previous_value", "win_rate", "age_years", "days_since_previous",
        "active_contracts",
    )


def buyer_history(
    df: DataFrame, buyer: str, order: Sequence[str], at: str, value: Column, suspicious: Column,
    totals: Callable[..., DataFrame] = totals_before,
) -> DataFrame:
    """Earlier records of the buyer: count, mean value and share of suspicious ones."""
    known = totals(
        df, [buyer], order,
        {
            "buyer_previous_count": ("count", F.lit(1)),
            "__value": ("sum", value),
            "__flags": ("sum", suspicious.cast("int")),
        },
        day_bucket(F.col(at)),
    )
    has_key = F.col(buyer).isNotNull()
    n = F.when(has_key, F.col("buyer_previous_count")).otherwise(0)
    return known.select(
        *df.columns, n.alias("buyer_previous_count"),
        F.when(has_key, F.try_divide(F.col("__value").cast("double"), F.col("buyer_previous_count"))).alias("buyer_mean_value"),
        F.when(has_key, F.try_divide(F.col("__flags"), F.col("buyer_previous_count"))).alias("buyer_suspicion_rate"),
    )


def target_encoding(
    df: DataFrame, category: str, order: Sequence[str], at: str, label: Column, name: str,
    within: Column | None = None, totals: Callable[..., DataFrame] = totals_before,
) -> DataFrame:
    """Mean label of earlier records of the category, else of all earlier records, else null.

    The second mean runs over all records, so a day may hold very many of them: ``within`` (not
    decreasing along the order inside a day, like a range of the id) cuts a day further.
    """
    measures = {"__n": ("count", label), "__sum": ("sum", label.cast("long"))}
    own = totals(df, [category], order, measures, day_bucket(F.col(at), within))
    own = own.withColumn("__own", F.try_divide(F.col("__sum"), F.col("__n"))).drop("__n", "__sum")
    every = totals(
        own.withColumn("__all", F.lit(0)), ["__all"], order, measures, day_bucket(F.col(at), within))
    return every.select(*df.columns, F.coalesce("__own", F.try_divide(F.col("__sum"), F.col("__n"))).alias(name))


def active_at(
    df: DataFrame, company: str, at: str, sanctions: DataFrame, start: str, end: str, name: str
) -> DataFrame:
    """Whether the company is under sanction on the record's day, ends included, open ends for ever.

    A sanction adds one on its first day and takes it back on the day after its last; the running
    total on a record's day is the number of sanctions in force. No record meets a sanction pairwise.
    Sanctions without a first day, or with an end before it, are never in force. Steps and days of records are
    reduced to one row per company and day first, so a company is as many rows as it has days, whatever it owns.
    """
    sanctions = sanctions.where(
        F.col(company).isNotNull() & F.col(start).isNotNull()
        & (F.col(end).isNull() | (F.to_date(end) >= F.to_date(start))))

    def step(day: Column, delta: int) -> Column:
        return F.struct(day.alias("__day"), F.lit(delta).cast("long").alias("__delta"))

    # Both steps of a sanction come from one reading of it.
    steps = sanctions.select(F.col(company).alias("__company"), F.explode(F.array(
        step(F.to_date(start), 1), step(F.date_add(F.to_date(end), 1), -1))).alias("__step"))
    steps = steps.select("__company", "__step.*").where(F.col("__day").isNotNull())
    asked = df.where(F.col(company).isNotNull()).select(
        F.col(company).alias("__company"), F.to_date(at).alias("__day"), F.lit(None).cast("long").alias("__delta"))
    days = steps.unionByName(asked).groupBy("__company", "__day").agg(
        F.sum("__delta").alias("__delta"), F.max(F.col("__delta").isNull()).alias("__asked"))
    upto = Window.partitionBy("__company").orderBy("__day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = days.withColumn("__open", F.sum("__delta").over(upto)).where(F.col("__asked") & (F.col("__open") > 0))
    known = known.select("__company", F.col("__day").alias("__on"))
    met = (F.col(company) == F.col("__company")) & (F.to_date(at) == F.col("__on"))
    # Company and day shrink much in a shuffle: sent to every task, what looks small would fill its memory.
    dealt = df.repartition(parts_for(df, ROWS_BYTES), F.col(company), F.to_date(at))
    joined = dealt.join(known.hint("merge"), met, "left")
    return joined.select(*(F.col(c) for c in df.columns), F.col("__company").isNotNull().alias(name))


def overlaps_earlier(
    df: DataFrame, keys: Sequence[str], start: str, end: str, ident: str, name: str,
    totals: Callable[..., DataFrame] = totals_before,
) -> DataFrame:
    """Whether an earlier record of the same keys is still running when this one starts.

    The latest end among earlier records decides, so overlapping pairs are never formed.
    """
    known = totals(
        df, keys, [start, ident], {"__until": ("max", F.to_date(end))}, day_bucket(F.col(start)))
    still = F.coalesce(F.col("__until") >= F.to_date(start), F.lit(False))
    return known.select(*df.columns, still.alias(name))
