"""Coverage and details reports, run totals, shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from garimpo.functions.cleaning import has_text
from garimpo.operators.filters import as_utc_timestamp

# First existing column wins.
DATE_COLUMNS = ("dataInicioVigencia", "dataPublicacaoPncp", "ingestion_timestamp")


def report_date(df: DataFrame, candidates: Sequence[str] = DATE_COLUMNS) -> Column:
    """Timestamp of the first candidate column the frame has; null timestamps when none."""
    found = next((c for c in candidates if c in df.columns), None)
    return F.lit(None).cast("timestamp_ntz") if found is None else as_utc_timestamp(df, found)


def report_id(df: DataFrame) -> Column | None:
    """Control number, else company and sequence joined by a dash, else nothing.

    Absent parts of the fallback show as the text ``None``.
    """
    if "numeroControlePNCP" in df.columns:
        return F.col("numeroControlePNCP")
    if "sequencialCompra" in df.columns:
        return composite_id(F.col("orgaoEntidade.cnpj"), F.col("sequencialCompra"))
    return None


def composite_id(*parts: Column) -> Column:
    return F.concat_ws("-", *(F.coalesce(p.cast("string"), F.lit("None")) for p in parts))


def coverage(
    df: DataFrame, at: Column, record_id: Column | None, detailed: bool = False
) -> DataFrame:
    """Records and exact distinct ids in total, by year, by month and, if asked, by day.

    Ids are first reduced to one row per (day, id), which the map side combines. Along the days of an id
    every row knows whether it is the id's first at all, of its year and of its month, so an id moves once
    per day and counts become sums: only one row per day reaches the grouping sets. Dates that did not parse
    form a group with null parts (``grain`` tells it apart from the total).
    """
    ident = F.lit(None).cast("string") if record_id is None else record_id
    per_id = df.select(F.to_date(at).alias("day"), ident.alias("id")).groupBy("day", "id").agg(F.count("*").alias("n"))
    # Plain dates travel through the grouping; they become texts on the few result rows.
    parts = {"year": F.year("day"), "year_month": F.trunc("day", "month"), "day": F.col("day")}
    names = ["year", "year_month"] + (["day"] if detailed else [])
    columns = [F.col(c) for c in names]
    sets = [columns[:i] for i in range(len(columns) + 1)]
    records = F.sum("n")
    if record_id is None:
        firsts, per_day = [], per_id.groupBy("day").agg(records.alias("n"))
    else:
        firsts = ["__first", *(f"__first_{name}" for name in names)]
        days = Window.partitionBy("id").orderBy("day")
        marked = per_id.select("day", "id", "n", F.lag("day").over(days).alias("__last"), F.row_number().over(days).alias("__rn"))
        # The days of a year or month lie together; rows without a day come first.
        begins = {"__first": F.col("__rn") == 1}
        for name in names:
            part = parts[name]
            before = F.year("__last") if name == "year" else F.trunc("__last", "month") if name == "year_month" else F.col("__last")
            begins[f"__first_{name}"] = begins["__first"] | ~part.eqNullSafe(before)
        counted = [F.sum((F.col("id").isNotNull() & begins[f]).cast("long")).alias(f) for f in firsts]
        per_day = marked.groupBy("day").agg(records.alias("n"), *counted)
    per_day = per_day.select(*(parts[name].alias(name) for name in names), "n", *firsts)
    # grouping_id has one bit per column, set when the column is rolled up.
    grain, unique = F.lit("total"), F.sum(firsts[0]) if firsts else records
    for i, name in enumerate(("year", "month", "day")[: len(names)]):
        here = F.grouping_id() == 2 ** (len(names) - 1 - i) - 1
        grain = F.when(here, name).otherwise(grain)
        unique = F.when(here, F.sum(firsts[i + 1])).otherwise(unique) if firsts else records
    grouped = per_day.groupingSets(sets, *columns).agg(
        grain.alias("grain"), records.alias("records"), unique.alias("unique_ids")
    )
    texts = {"year_month": F.date_format("year_month", "yyyy-MM")}
    if detailed:
        texts["day"] = F.date_format("day", "yyyy-MM-dd")
    return grouped.withColumns(texts)


def file_count(df: DataFrame) -> DataFrame:
    """Distinct data files behind a file-based frame."""
    return df.select(F.col("_metadata.file_path").alias("file")).agg(F.countDistinct("file").alias("total_files"))


def records_per_id(report: DataFrame) -> DataFrame:
    """Mean records per id, only where there are more records than ids."""
    mean = F.col("records") / F.col("unique_ids")
    return report.withColumn("avg_records", F.when(F.col("records") > F.col("unique_ids"), mean))


def details_summary(df: DataFrame, items: Column, documents: Column) -> DataFrame:
    """Record, item and document totals with averages; zeros for an empty frame."""
    totals = df.agg(
        F.count("*").alias("total_contratacoes"),
        F.coalesce(F.sum(items), F.lit(0)).alias("total_itens"),
        F.coalesce(F.sum(documents), F.lit(0)).alias("total_arquivos"),
    )

    def mean(name: str) -> Column:
        return F.coalesce(F.round(F.try_divide(F.col(name), F.col("total_contratacoes")), 2), F.lit(0.0))

    return totals.withColumns({
        "avg_itens_per_contratacao": mean("total_itens"),
        "avg_arquivos_per_contratacao": mean("total_arquivos"),
    })


def frequency(df: DataFrame, label: Column, name: str = "label", weight: str | None = None) -> DataFrame:
    """Counts per label, missing labels as ``Unknown``; rows that stand for several say so in ``weight``."""
    n = F.count("*") if weight is None else F.sum(weight)
    return df.groupBy(F.coalesce(label, F.lit("Unknown")).alias(name)).agg(n.alias("n"))


def document_label(name: Column, description: Column) -> Column:
    """Type name when filled, else the description, else ``Unknown``."""
    return F.coalesce(F.when(has_text(name), name), description, F.lit("Unknown"))


def with_share(freq: DataFrame, name: str = "label", top: int | None = None) -> DataFrame:
    """Percent of the total, largest first, ties by label; ``top`` cuts the listing.

    The total is a scalar subquery over the same aggregate, so no window gathers all labels.
    """
    total = freq.agg(F.sum("n")).scalar()
    shared = freq.withColumn("share_pct", F.col("n") * 100.0 / total)
    return shared.orderBy(F.desc("n"), name).limit(top) if top else shared


def daily_breakdown(df: DataFrame, published: Column, items: Column, documents: Column) -> DataFrame:
    """Records, items and documents per publication day; rows without a date stay out."""
    return (
        df.where(has_text(published))
        .groupBy(F.substring(published.cast("string"), 1, 10).alias("date"))
        .agg(
            F.count("*").alias("contratacoes"),
            F.coalesce(F.sum(items), F.lit(0)).alias("itens"),
            F.coalesce(F.sum(documents), F.lit(0)).alias("arquivos"),
        )
    )


def transformation_summary(original: DataFrame, final: DataFrame) -> DataFrame:
    """Row counts before and after, rows removed and removal rate in percent."""
    sides = original.select(F.lit(1).alias("o"), F.lit(0).alias("f")).unionAll(
        final.select(F.lit(0).alias("o"), F.lit(1).alias("f"))
    )
    counts = sides.agg(
        F.coalesce(F.sum("o"), F.lit(0)).alias("original_count"),
        F.coalesce(F.sum("f"), F.lit(0)).alias("final_count"),
    )
    removed = F.col("original_count") - F.col("final_count")
    return counts.withColumns({
        "records_removed": removed,
        "removal_rate": F.when(F.col("original_count") > 0, removed / F.col("original_count") * 100).otherwise(0.0),
    })


def backfill_totals(flagged: DataFrame, day: str, is_new: str) -> DataFrame:
    """Per day and in total: fetched, new and duplicate rows, files and efficiency.

    A day writes one file set only when it brought something new, hence ``files`` is 0 or 1
    per day. The total row has a null day.
    """
    daily = flagged.groupBy(day).agg(
        F.count("*").alias("fetched"), F.sum(F.col(is_new).cast("long")).alias("new_records")
    ).withColumn("files", (F.col("new_records") > 0).cast("long"))
    rolled = daily.rollup(day).agg(
        F.sum("fetched").alias("fetched"),
        F.sum("new_records").alias("new_records"),
        F.sum("files").alias("files"),
    )
    duplicates = F.col("fetched") - F.col("new_records")
    return rolled.withColumns({
        "duplicates": duplicates,
        "efficiency_rate": F.when(F.col("fetched") > 0, duplicates / F.col("fetched") * 100).otherwise(0.0),
    })
