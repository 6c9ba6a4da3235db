"""Business dates: UTC instants seen from the local zone, day parts, ISO-8601 parsing.

Everything works on TIMESTAMP_NTZ holding UTC, so no result depends on the session zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LOCAL_ZONE = "America/Sao_Paulo"

# ISO-8601 forms that count as a date: extended or compact calendar or week date, optional time,
# optional offset.
_TIME = r"(?:[01]\d|2[0-3])(?:(?::[0-5]\d(?::[0-5]\d(?:[.,]\d+)?)?)|(?:[0-5]\d(?:[0-5]\d(?:[.,]\d+)?)?))?"
_OFFSET = r"(?:Z|[+-](?:[01]\d|2[0-3])(?::?[0-5]\d(?::?[0-5]\d)?)?)"
_CLOCK = rf"(?:[T ]{_TIME}{_OFFSET}?)?$"
ISO_PATTERN = rf"^(?!0000)\d{{4}}(-?)\d{{2}}\1\d{{2}}{_CLOCK}"
# A week without a day means its Monday.
ISO_WEEK_PATTERN = rf"^(?!0000)\d{{4}}(-?)W(?:0[1-9]|[1-4]\d|5[0-3])(?:\1[1-7])?{_CLOCK}"
EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def to_local(utc: Column, zone: str = LOCAL_ZONE) -> Column:
    """Local wall clock of a UTC TIMESTAMP_NTZ."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc.cast("timestamp_ntz"))


def to_utc(local: Column, zone: str = LOCAL_ZONE) -> Column:
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), local.cast("timestamp_ntz"))


def day_key(utc: Column, zone: str = LOCAL_ZONE) -> Column:
    """``yyyyMMdd`` of the local business day."""
    return F.date_format(to_local(utc, zone), "yyyyMMdd")


def run_stamp(utc: Column, zone: str = LOCAL_ZONE) -> Column:
    """``yyyyMMdd_HHmmss`` in local time."""
    return F.date_format(to_local(utc, zone), "yyyyMMdd_HHmmss")


def partition_parts(utc: Column, zone: str = LOCAL_ZONE) -> dict[str, Column]:
    """Zero-padded partition strings of the local business day."""
    local = to_local(utc, zone)
    return {
        "year": F.date_format(local, "yyyy"),
        "month": F.date_format(local, "MM"),
        "day": F.date_format(local, "dd"),
    }


def parse_day_key(key: Column, zone: str = LOCAL_ZONE) -> Column:
    """UTC instant of local midnight for a ``yyyyMMdd`` text; null when it is no date."""
    dashed = F.regexp_replace(key, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")
    midnight = F.when(key.rlike(r"^\d{8}$"), dashed).try_cast("timestamp_ntz")
    return to_utc(midnight, zone)


def utc_wall_clock(instant: Column) -> Column:
    """UTC TIMESTAMP_NTZ of an instant, whatever the session zone."""
    seconds = F.unix_micros(instant).cast("decimal(20,0)") / F.lit(1000000)
    zero = F.lit(0)
    return F.expr(EPOCH) + F.make_dt_interval(zero, zero, zero, seconds.cast("decimal(18,6)"))


def _calendar_instant(text: Column) -> Column:
    """Instant of a text that begins with a calendar date; the cast checks the calendar."""
    dashed = F.regexp_replace(text, r"^(\d{4})(\d{2})(\d{2})", "$1-$2-$3")
    minutes = F.regexp_replace(dashed, r"([T ]\d{2})(\d{2})", "$1:$2")
    seconds = F.regexp_replace(minutes, r"([T ]\d{2}:\d{2})(\d{2})", "$1:$2")
    padded = F.regexp_replace(seconds, r"([T ]\d{2})([Z+-]|$)", "$1:00$2")
    full = F.translate(F.regexp_replace(padded, r"([T ]\d{2}:\d{2})([Z+-]|$)", "$1:00$2"), ",", ".")
    zoned = (
        F.when(F.length(full) <= 10, F.concat(full, F.lit("T00:00:00Z")))
        .when(full.rlike(r":\d{2}[0-9.]*[Z+-]"), full)
        .otherwise(F.concat(full, F.lit("Z")))
    )
    return zoned.try_cast("timestamp")


def _week_as_calendar(text: Column) -> Column:
    """The text with its week date written as a calendar date; null when the year has no such week.

    Week 1 holds January 4th, and a week belongs to the year of its Thursday.
    """
    year = F.substring(text, 1, 4).cast("int")
    week = F.regexp_extract(text, r"W(\d{2})", 1).cast("int")
    weekday = F.coalesce(F.regexp_extract(text, r"W\d{2}-?([1-7])", 1).try_cast("int"), F.lit(1))
    fourth = F.make_date(year, F.lit(1), F.lit(4))
    monday = F.date_add(fourth, (week - 1) * 7 - F.weekday(fourth))
    day = F.when(F.year(F.date_add(monday, 3)) == year, F.date_add(monday, weekday - 1))
    return F.concat(F.date_format(day, "yyyy-MM-dd"), F.regexp_extract(text, r"([T ].*)?$", 0))


def iso_timestamp(text: Column) -> Column:
    """UTC TIMESTAMP_NTZ of an ISO-8601 text, null when the text is not one.

    Spark's own cast is both laxer ("2024", " 2024-1-2") and stricter ("20241022", "2024-W43-2"), so
    patterns decide what is accepted; compact forms and weeks are spelled out for the cast, which then
    only checks the calendar. Without an offset the text means UTC.
    """
    instant = F.when(text.rlike(ISO_PATTERN), _calendar_instant(text))
    return utc_wall_clock(instant.when(text.rlike(ISO_WEEK_PATTERN), _calendar_instant(_week_as_calendar(text))))


def date_spine(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per calendar day, both ends included."""
    bounds = spark.range(1).select(F.to_date(F.lit(start)).alias("a"), F.to_date(F.lit(end)).alias("b"))
    return bounds.select(F.explode(F.sequence("a", "b")).alias("day"))


def last_days(end: Column, n: int) -> tuple[Column, Column]:
    """First and last day of "the last n days": n + 1 calendar dates, both ends included."""
    return F.date_sub(end, n), end


def fill_missing_days(daily: DataFrame, day: str, start: Column, end: Column, counts: list[str]) -> DataFrame:
    """Left-join daily counts to the full run of days so that missing days show as zero.

    ``start`` and ``end`` are aggregates over ``daily``, e.g. ``F.min(day)``.
    """
    days = daily.agg(F.explode(F.sequence(start, end)).alias(day))
    return days.join(daily, day, "left").fillna(0, counts)
