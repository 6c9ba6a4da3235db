"""Row predicates, date ranges and run metadata."""

from __future__ import annotations

import json
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from garimpo.functions.cleaning import present, sanitize_frame
from garimpo.functions.timeparts import iso_timestamp

# Column set of an enriched frame that has no rows.
DETAILS_SCHEMA = (
    "cnpj string, anoCompra int, sequencialCompra int, numeroControlePNCP string, "
    "itens array<struct<numeroItem int, descricao string, valorUnitarioEstimado double, quantidade double, "
    "situacaoCompraItem int, situacaoCompraItemNome string, itemCategoriaId int, itemCategoriaNome string, "
    "criterioJulgamentoId int, materialOuServico string>>, "
    "arquivos array<struct<tipoDocumentoId int, tipoDocumentoNome string, tipoDocumentoDescricao string, "
    "titulo string, url string, statusAtivo boolean>>, "
    "metadata struct<total_itens int, total_arquivos int, fetch_timestamp string, api_calls int, fetch_error string>"
)


def with_id(df: DataFrame, id_col: str) -> DataFrame:
    return df.where(present(df, F.col(id_col)))


def record_key(id_col: Column) -> Column:
    """The id when it is a non-empty text, else null."""
    return F.when(F.length(id_col) > 0, id_col)


def as_utc_timestamp(df: DataFrame, column: str) -> Column:
    """UTC TIMESTAMP_NTZ of a date, timestamp or ISO text column."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.StringType):
        return iso_timestamp(F.col(column))
    if isinstance(kind, T.TimestampType):
        return F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col(column).cast("timestamp_ntz"))
    return F.col(column).cast("timestamp_ntz")


def date_range(df: DataFrame, start: str, end: str, column: str) -> DataFrame:
    """Rows dated from ``start`` to ``end``, the end day included; unparsable dates drop.

    On a timestamp column the bounds are literals, so they reach the Parquet scan.
    """
    if column not in df.columns:
        return df
    at = as_utc_timestamp(df, column)
    first = F.lit(start).cast("date")
    after = F.date_add(F.lit(end).cast("date"), 1)
    return df.where((at >= first.cast("timestamp_ntz")) & (at < after.cast("timestamp_ntz")))


def add_metadata(df: DataFrame, metadata: dict | None = None, at: Column | None = None) -> DataFrame:
    """``ingestion_timestamp`` plus one constant ``meta_<key>`` column per entry."""
    def constant(value) -> Column:
        if isinstance(value, (set, tuple, frozenset)):
            value = sorted(value, key=str) if not isinstance(value, tuple) else list(value)
        if isinstance(value, (list, dict)):
            return F.lit(json.dumps(value, default=str, ensure_ascii=False))
        if isinstance(value, (datetime, date)):
            return F.lit(value.isoformat())
        return F.lit(value)

    stamp = F.current_timestamp() if at is None else at
    return df.withColumns({
        "ingestion_timestamp": F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
        **{f"meta_{k}": constant(v) for k, v in (metadata or {}).items()},
    })


def take_batch(df: DataFrame, order: list[str | Column], batch_size: int | None, max_records: int | None) -> DataFrame:
    """First N rows in order; without a batch size the test limit applies, without both all rows."""
    limit = batch_size or max_records
    return df.orderBy(*order).limit(limit) if limit else df


def batch_progress(available: DataFrame, batch: DataFrame) -> DataFrame:
    """Available, processed and remaining counts as one row."""
    tagged = available.select(F.lit(1).alias("a"), F.lit(0).alias("p")).unionAll(
        batch.select(F.lit(0).alias("a"), F.lit(1).alias("p"))
    )
    counts = tagged.agg(
        F.coalesce(F.sum("a"), F.lit(0)).alias("available"),
        F.coalesce(F.sum("p"), F.lit(0)).alias("processed"),
    )
    return counts.withColumn("remaining", F.col("available") - F.col("processed"))


def nested_frame(df: DataFrame) -> DataFrame:
    """Cleaned nested records; a frame without columns becomes the empty details schema."""
    if not df.columns:
        return df.sparkSession.createDataFrame([], DETAILS_SCHEMA)
    return sanitize_frame(df)
