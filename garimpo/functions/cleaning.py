"""Schema-driven value clean-up and truthiness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def has_text(col: Column) -> Column:
    """Never null: true when the value is present and its text is not empty."""
    return F.coalesce(col.cast("string") != "", F.lit(False))


def present(df: DataFrame, col: Column) -> Column:
    """A filter for rows where the value is there and not empty text.

    Plain comparisons on the column's own type, so the Parquet scan can apply them.
    """
    kind = df.select(col.alias("c")).schema[0].dataType
    return col.isNotNull() & (col != "") if isinstance(kind, T.StringType) else col.isNotNull()


def sanitize(col: Column, dtype: T.DataType) -> Column:
    """NaN becomes null and time values become ISO text, at any nesting depth."""
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(col), col)
    if isinstance(dtype, T.DateType):
        return F.date_format(col, "yyyy-MM-dd")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        whole = F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss")
        micros = F.date_format(col, "SSSSSS")
        return F.when(micros == "000000", whole).otherwise(F.concat(whole, F.lit("."), micros))
    if isinstance(dtype, T.ArrayType):
        return F.transform(col, lambda x: sanitize(x, dtype.elementType)) if _dirty(dtype) else col
    if isinstance(dtype, T.MapType):
        return F.transform_values(col, lambda _, v: sanitize(v, dtype.valueType)) if _dirty(dtype) else col
    if isinstance(dtype, T.StructType):
        if not _dirty(dtype):
            return col
        fields = [sanitize(col[f.name], f.dataType).alias(f.name) for f in dtype.fields]
        return F.when(col.isNotNull(), F.struct(*fields))
    return col


def _dirty(dtype: T.DataType) -> bool:
    """Whether a type holds anything that sanitize would change."""
    if isinstance(dtype, T.ArrayType):
        return _dirty(dtype.elementType)
    if isinstance(dtype, T.MapType):
        return _dirty(dtype.valueType)
    if isinstance(dtype, T.StructType):
        return any(_dirty(f.dataType) for f in dtype.fields)
    return isinstance(dtype, (T.FloatType, T.DoubleType, T.DateType, T.TimestampType, T.TimestampNTZType))


def sanitize_frame(df: DataFrame) -> DataFrame:
    return df.select(*(sanitize(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields))
