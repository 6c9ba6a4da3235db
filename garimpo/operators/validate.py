"""Record validation, its report, and the gates that close an ingestion run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from garimpo.functions.cleaning import has_text
from garimpo.functions.timeparts import iso_timestamp

ID = "numeroControlePNCP"
PUBLISHED = "dataPublicacaoPncp"


def record_errors(df: DataFrame, id_col: str = ID, date_col: str = PUBLISHED) -> Column:
    """Array of error texts of a row, empty when the row is valid."""
    checks = [F.when(~has_text(F.col(id_col)), F.lit(f"Missing required field '{id_col}'"))]
    if date_col in df.columns:
        at = F.col(date_col)
        # A number is no ISO text, whatever its digits look like; 0 counts as absent.
        if isinstance(df.schema[date_col].dataType, T.NumericType):
            wrong = F.coalesce(at != 0, F.lit(False))
        else:
            wrong = has_text(at) & iso_timestamp(at.cast("string")).isNull()
        checks.append(F.when(wrong, F.lit(f"Invalid date format in '{date_col}'")))
    return F.filter(F.array(*checks), lambda e: e.isNotNull())


def with_errors(df: DataFrame, id_col: str = ID, date_col: str = PUBLISHED) -> DataFrame:
    return df.withColumn("errors", record_errors(df, id_col, date_col))


def validation_report(checked: DataFrame) -> DataFrame:
    valid = F.coalesce(F.sum((F.size("errors") == 0).cast("long")), F.lit(0))
    return checked.agg(
        F.count("*").alias("total_records"),
        valid.alias("valid_records"),
        (F.count("*") - valid).alias("invalid_records"),
    )


def first_messages(checked: DataFrame, position: str, n: int = 10) -> DataFrame:
    """The first n messages in record order; a row may bring two."""
    # At most n rows have messages that count, so only those are taken apart.
    wrong = checked.where(F.size("errors") > 0).select(F.col(position).alias("idx"), "errors").orderBy("idx").limit(n)
    top = wrong.select("idx", F.posexplode("errors").alias("part", "error")).orderBy("idx", "part").limit(n)
    return top.select(
        "idx", "part", F.concat(F.lit("Record "), F.col("idx").cast("string"), F.lit(": "), F.col("error")).alias("message")
    )


def ingestion_gate(metrics: DataFrame) -> DataFrame:
    """Decide a run from its one-row metrics frame.

    Expects ``total_input, new_records, record_count, uploaded, key, invalid_records``. A run
    without input, or with nothing but known records, passes as "no data".
    """
    no_input = F.col("total_input") == 0
    all_known = ~no_input & (F.col("new_records") == 0)
    checks = F.struct(
        (F.col("record_count") > 0).alias("has_data"),
        F.coalesce(F.col("uploaded"), F.lit(False)).alias("upload_succeeded"),
        has_text(F.col("key")).alias("s3_key_exists"),
        (F.coalesce(F.col("invalid_records"), F.lit(0)) == 0).alias("validation_passed"),
    )
    judged = metrics.withColumn("checks", checks).withColumn("no_data", no_input | all_known)
    passed = F.col("no_data") | (
        F.col("checks.has_data") & F.col("checks.upload_succeeded")
        & F.col("checks.s3_key_exists") & F.col("checks.validation_passed")
    )
    reason = F.when(no_input, "no_data_from_api").when(all_known, "all_duplicates")
    return judged.withColumns({"validated": passed, "reason": reason})


# Reasons that explain an empty details run without making it a failure.
ACCEPTED_REASONS = ("no_data", "all_duplicates", "all_processed")


def details_gate(metrics: DataFrame, accepted: Sequence[str] = ACCEPTED_REASONS) -> DataFrame:
    """``has_data`` runs pass; others pass only for an accepted ``reason``."""
    ok = F.coalesce(F.col("has_data"), F.lit(False))
    return metrics.withColumn("validated", ok | F.coalesce(F.col("reason").isin(*accepted), F.lit(False)))


def require(gate: DataFrame) -> None:
    """Fail the run unless the gate's single row says validated."""
    row = gate.first()
    if row is None or not row["validated"]:
        raise ValueError(f"ingestion gate failed: {row.asDict(recursive=True) if row else 'no result'}")
