"""Landed JSON whose fields change type: records as VARIANT, typed by the reader, wrong types as errors.

A schema given to the JSON reader turns a value of another type into null, which cannot be told from a value that
was never sent. Here a record stays a VARIANT until ``typed`` takes its fields out: a value of the wrong kind
brings null and an error that names what was found. ``kinds_found`` counts the kinds of every field, so a drift is seen
before a schema is changed. All of it is column expressions on one scan; counts are combined on the map side.

A line that is no JSON keeps its row, with a null record and its text in ``corrupt``. Absent fields and JSON nulls
are no errors. Numbers are kept exactly: a fraction in a whole-number field, or more digits than a decimal
holds, is an error, not a rounded value.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ABSENT, NULL = "ABSENT", "NULL"
#: JSON kinds that a type takes as they are.
TAKES = {
    "string": ("STRING",), "boolean": ("BOOLEAN",), "double": ("BIGINT", "DECIMAL", "DOUBLE"),
    "long": ("BIGINT",), "int": ("BIGINT",), "decimal": ("BIGINT", "DECIMAL"), "array": ("ARRAY",),
}


@dataclass(frozen=True)
class Field:
    """A field of a record: its column, its JSON path and its Spark type.

    ``texts`` also takes numbers and booleans that were sent as text, if the text is one as a whole.
    """

    name: str
    path: str
    type: str
    texts: bool = False

    @property
    def family(self) -> str:
        family = self.type.partition("(")[0].partition("<")[0].strip().lower()
        if family not in TAKES:
            raise ValueError(f"field {self.name!r}: type {self.type!r} is none of {sorted(TAKES)}")
        return family


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per line: ``record`` as VARIANT, ``corrupt`` with the text of a line that is no JSON."""
    record = F.try_parse_json("value")
    lines = spark.read.text(path).where(F.length(F.trim("value")) > 0)
    return lines.select(record.alias("record"), F.when(record.isNull(), F.col("value")).alias("corrupt"))


def page_records(pages: DataFrame, keep: Sequence[str] = (), data: str = "$.data", position: str = "pos") -> DataFrame:
    """Records of landed pages (a VARIANT column ``record``) with their place; a page without a list has none."""
    entries = F.try_variant_get("record", data, "array<variant>")
    return pages.select(*keep, F.posexplode(entries).alias(position, "record"))


def kind(value: Column) -> Column:
    """ABSENT, NULL, or the JSON kind of a value: BIGINT, DECIMAL, DOUBLE, STRING, BOOLEAN, ARRAY or OBJECT."""
    found = F.substring_index(F.substring_index(F.schema_of_variant(value), "(", 1), "<", 1)
    return F.when(value.isNull(), ABSENT).when(F.is_variant_null(value), NULL).otherwise(found)


def _value(value: Column, field: Field) -> Column:
    """The value in its type, null where it does not fit without loss."""
    cast = F.try_variant_get(value, "$", field.type)
    if field.family in ("long", "int", "decimal"):
        exact = F.try_variant_get(value, "$", "decimal(38,18)")
        return F.when(cast.cast("decimal(38,18)") == exact, cast)
    return cast


def typed(records: DataFrame, fields: Sequence[Field], keep: Sequence[str] = (), errors: str = "type_errors") -> DataFrame:
    """The fields as columns and ``errors``, an array that is empty for a record of the expected types.

    A line that was no JSON, or a record without any of the fields that is no object, has one error.
    """
    # One step each for what is found, its kind, and its value: an expression used twice is computed once.
    number = range(len(fields))
    taken_out = records.select(
        *keep, F.col("record").alias("__record"),
        *(F.try_variant_get("record", f.path, "variant").alias(f"__found_{i}") for i, f in enumerate(fields)))
    kinds = taken_out.withColumns({f"__kind_{i}": kind(F.col(f"__found_{i}")) for i in number})
    values = kinds
    if fields:
        values = kinds.withColumns({
            f"__value_{i}": F.when(
                F.col(f"__kind_{i}").isin([*TAKES[f.family], *(["STRING"] if f.texts else [])]), _value(F.col(f"__found_{i}"), f))
            for i, f in enumerate(fields)})
    checks = [
        F.when(
            ~F.col(f"__kind_{i}").isin(ABSENT, NULL) & F.col(f"__value_{i}").isNull(),
            F.concat(F.lit(f"Wrong type in '{f.name}': expected {f.type}, found "), F.col(f"__kind_{i}")))
        for i, f in enumerate(fields)]
    # The kind of a whole record takes reading all of it, which a record that holds a field does not need.
    bare = F.lit(True)
    for i in number:
        bare = bare & (F.col(f"__kind_{i}") == ABSENT)
    listed = F.when(F.col("__record").isNull(), F.array(F.lit("Record is no JSON"))).when(
        bare & (kind(F.col("__record")) != "OBJECT"), F.array(F.concat(F.lit("Record is no object but "), kind(F.col("__record"))))
    ).otherwise(F.array_compact(F.array(*checks)))
    return values.select(*keep, *(F.col(f"__value_{i}").alias(f.name) for i, f in enumerate(fields)), listed.alias(errors))


def kinds_found(records: DataFrame, fields: Sequence[Field], by: Sequence[str] = ()) -> DataFrame:
    """How often each kind stands in each field: ``by``, ``field``, ``kind``, ``records``. Lines that are no JSON are left out."""
    found = F.array(*(
        F.struct(F.lit(f.name).alias("field"), F.try_variant_get("record", f.path, "variant").alias("value")) for f in fields))
    rows = records.where(F.col("record").isNotNull()).select(*by, F.explode(found).alias("__each"))
    rows = rows.select(*by, F.struct("__each.field", kind(F.col("__each.value")).alias("kind")).alias("__found"))
    return rows.groupBy(*by, F.col("__found.field").alias("field"), F.col("__found.kind").alias("kind")).agg(
        F.count("*").alias("records"))
