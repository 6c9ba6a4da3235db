"""Shared pieces of the training-data operators: written tables, code shipping, Arrow texts."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from contextlib import contextmanager
from contextvars import ContextVar
from weakref import WeakKeyDictionary

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from garimpo.session import fresh_path, remove_path

#: Spark removes the shuffle files of an execution when it ends, not when the driver's heap is next collected.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

_shipped: set[str] = set()
_folders: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
_passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application, as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="garimpo-"), "garimpo_code.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(top)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """The session with other settings; what it had before is restored."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def written(df: DataFrame, label: str, batch_rows: int | None = None) -> DataFrame:
    """``df`` as a Parquet table below the shared folder: cuts lineage, survives lost executors.

    Its shuffle files go as soon as it is written, since nothing reads ``df`` itself again. ``batch_rows`` are the
    rows that Python workers get at once.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    with settings(spark, {CLEANUP: "true"} | ({BATCH_ROWS: str(batch_rows)} if batch_rows else {})):
        df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    _folders[table] = path
    if _passing.get() is not None:
        _passing.get().append(path)
    return table


def discard(*tables: DataFrame) -> None:
    """Remove tables of ``written`` that no result reads any more, so that their disk is free for the next ones."""
    for table in tables:
        path = _folders.pop(table, None)
        if path is not None:
            remove_path(table.sparkSession, path)


@contextmanager
def passing(spark: SparkSession):
    """Tables of ``written`` made within the block go at its end, but for those given to what it yields."""
    made, kept = [], set()
    before = _passing.set(made)

    def keep(table: DataFrame) -> DataFrame:
        kept.add(_folders[table])
        return table

    try:
        yield keep
    finally:
        _passing.reset(before)
        for path in made:
            if path not in kept:
                remove_path(spark, path)


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id long, text string); a null text counts as empty, other columns are left out."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all strings of an Arrow column and the offsets of each string; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    n = len(column)
    if n == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int):
    """Index ranges (a, b) of strings with about ``limit`` bytes together; one string is never cut."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


def pieces(batches, column: int, limit: int):
    """Arrow batches cut, without a copy, to about ``limit`` bytes of the strings in ``column``; one string is never cut."""
    for batch in batches:
        for a, b in slices(utf8(batch.column(column))[1], limit):
            yield batch.slice(a, b - a)


def lean(run):
    """``run`` for mapInArrow; a worker, which Spark keeps for later tasks, gives back the memory that it has freed."""
    def task(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return task
