"""Landed API pages: envelopes to rows, page sequences, pull windows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows per full page of the item and document endpoints.
CHILD_PAGE_SIZE = 100


def read_pages(
    spark: SparkSession, path: str, record: T.StructType, keys: T.StructType, multi_line: bool = True
) -> DataFrame:
    """One row per landed page: key columns, ``data``, ``paginasRestantes``.

    Key columns (the pull and the page number) come from the page document or from
    ``key=value`` folders. A page that is no valid JSON keeps its row with null ``data`` and its
    text in ``corrupt``; an empty file brings no row.
    """
    envelope = T.StructType([
        *keys.fields,
        T.StructField("data", T.ArrayType(record)),
        T.StructField("totalRegistros", T.LongType()),
        T.StructField("totalPaginas", T.IntegerType()),
        T.StructField("paginasRestantes", T.IntegerType()),
        T.StructField("corrupt", T.StringType()),
    ])
    reader = spark.read.schema(envelope).option("mode", "PERMISSIVE")
    reader = reader.option("multiLine", multi_line).option("columnNameOfCorruptRecord", "corrupt")
    pages = reader.json(path)
    typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in keys.fields]
    return pages.select(*typed, *[c for c in pages.columns if c not in keys.names])


def read_child_pages(
    spark: SparkSession, path: str, entry: T.StructType, keys: T.StructType, whole_file: bool = True
) -> DataFrame:
    """Item or document pages, each a bare list or ``{"data": [...]}``.

    Either one page per file with the keys in folder names, or, without ``whole_file``, one JSON
    object per line with the keys and the page's text as ``body``: many small pages share a file.
    """
    if whole_file:
        raw = spark.read.option("wholetext", True).schema(
            T.StructType([T.StructField("value", T.StringType()), *keys.fields])
        ).text(path)
    else:
        raw = spark.read.schema(T.StructType([*keys.fields, T.StructField("body", T.StringType())])).json(path)
        raw = raw.withColumnRenamed("body", "value")
    bare = F.from_json("value", T.ArrayType(entry))
    wrapped = F.from_json("value", T.StructType([T.StructField("data", T.ArrayType(entry))]))["data"]
    body = F.when(F.ltrim("value").startswith("["), bare).otherwise(wrapped)
    return raw.select(*keys.names, body.alias("data"))


def is_last_page(data: str = "data", remaining: str = "paginasRestantes") -> Column:
    """Stop after an empty page or when no pages remain; an absent count means none remain."""
    empty = F.coalesce(F.size(data), F.lit(0)) <= 0
    return empty | (F.coalesce(F.col(remaining), F.lit(0)) == 0)


def is_short_page(data: str = "data", full: int = CHILD_PAGE_SIZE) -> Column:
    return F.coalesce(F.size(data), F.lit(0)) < full


def reachable_pages(
    pages: DataFrame, keys: Sequence[str], page: str, stop: Column, max_pages: int | None = None
) -> DataFrame:
    """Pages up to and including the first stop page of their sequence.

    The first stop page is a map-side combined minimum, so a long sequence is never gathered.
    """
    if max_pages is not None:
        pages = pages.where(F.col(page) <= max_pages)
    first = pages.where(stop).groupBy(*keys).agg(F.min(page).alias("__stop"))
    joined = pages.join(first, list(keys), "left")
    return joined.where(F.col("__stop").isNull() | (F.col(page) <= F.col("__stop"))).drop("__stop")


def page_rows(pages: DataFrame, keep: Sequence[str], data: str = "data", position: str = "pos") -> DataFrame:
    """Records of the pages with their place inside the page."""
    rows = pages.select(*keep, F.posexplode(data).alias(position, "__r"))
    return rows.select(*keep, position, "__r.*")


@dataclass(frozen=True)
class PullWindow:
    """Days and page limit of a pull; ``max_pages`` None means all pages."""

    start: date
    end: date
    max_pages: int | None = None


def pull_window(mode: str, today: date, start: date | None = None, end: date | None = None,
                max_pages: int | None = None) -> PullWindow:
    """Window of a pull mode; ``today`` is the local business day of the run."""
    if mode == "hourly":
        return PullWindow(today, today, max_pages)
    if mode == "daily":
        return PullWindow(today, today)
    if mode == "yesterday":
        return PullWindow(today - timedelta(days=1), today - timedelta(days=1))
    if mode == "last_30_days":
        return PullWindow(today - timedelta(days=30), today)
    if mode in ("backfill", "custom"):
        if start is None or end is None:
            raise ValueError(f"{mode} needs start and end")
        return PullWindow(start, end, max_pages if mode == "custom" else None)
    raise ValueError(f"unknown pull mode {mode!r}")


def pull(pages: DataFrame, keys: Sequence[str], page: str, day: str, window: PullWindow) -> DataFrame:
    """Reachable pages of the pulls whose day lies in the window."""
    chosen = pages.where(F.col(day).between(F.lit(window.start), F.lit(window.end)))
    return reachable_pages(chosen, keys, page, is_last_page(), window.max_pages)
