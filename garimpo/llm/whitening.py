"""Embedding whitening by spectral divide and conquer on the covariance (operator 12)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from garimpo.llm import spectral
from garimpo.llm.common import ship, written
from garimpo.llm.vectors import finite_vectors, matrix

#: Components of a row.
COMPONENTS = 4
#: Entries become floor(GRID * entry).
GRID = 256
#: Entries beyond so much are refused: the grid would no longer be exact.
LARGEST = float(1 << 44)
#: Partial covariances are added up in so many groups of tasks first.
GROUPS = 64


def _added_rows(partial: DataFrame, width: int) -> np.ndarray:
    """Sum of small tables (row, c0...) that tasks made: first by groups of tasks, then over the groups."""
    columns = [f"c{j}" for j in range(width)]
    sums = partial.groupBy("row", "part").agg(*[F.sum(c).alias(c) for c in columns])
    found = sums.groupBy("row").agg(*[F.sum(c).alias(c) for c in columns]).orderBy("row").toPandas()
    return found[columns].to_numpy(np.float64)


def _moments(fitted: DataFrame, project, width: int) -> np.ndarray:
    """(width + 1) x width: sum of y and of y outer y over the fit list, y = project(x) for a matrix x of rows."""

    def run(batches):
        total = np.zeros((width + 1, width))
        seen = 0
        for batch in batches:
            if batch.num_rows:
                y = project(matrix(batch.column(0)))
                total[0] += y.sum(axis=0)
                total[1:] += y.T @ y
                seen += 1
        if seen:
            from pyspark import TaskContext

            part = TaskContext.get().partitionId() % GROUPS
            columns = [pa.array(np.arange(width + 1, dtype=np.int32)), pa.array(np.full(width + 1, part, np.int32))]
            yield pa.RecordBatch.from_arrays(
                columns + [pa.array(total[:, j]) for j in range(width)],
                names=["row", "part"] + [f"c{j}" for j in range(width)])

    schema = "row int, part int, " + ", ".join(f"c{j} double" for j in range(width))
    return _added_rows(fitted.mapInArrow(run, schema), width)


def fit_list(vectors: DataFrame) -> DataFrame:
    """(x array<long>): each distinct gridded vector once; copies meet within tasks before they are shuffled."""
    return vectors.select(gridded(F.col("v")).alias("x")).distinct()


def gridded(vector):
    """floor(GRID * entry) as long; an entry beyond LARGEST raises."""
    return F.transform(vector, lambda c: F.when(F.abs(c) <= LARGEST, F.floor(GRID * c)).otherwise(
        F.raise_error(F.lit(f"an entry is beyond {LARGEST:.0f}"))).cast("long"))


def whitened(
    embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS,
) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row per vector and component.

    Null vectors and those with null or non-finite entries are dropped, and so are empty ones and lengths
    other than the usual one (``vectors.finite_vectors``). Statistics are over each distinct gridded vector
    once (n of them), so a vector that a third of all rows hold counts once; it meets itself within tasks
    first. What reaches the driver is the sum vector and the covariance, dimensions squared numbers, which
    tasks add up to partial tables first. Components come from ``spectral.eigen`` there, by projectors from
    QDWH polar decompositions, and go to the executors as dimensions x components numbers.

    Equal eigenvalues share their space in an arbitrary, fixed basis. A component without variance to double
    precision (fewer distinct vectors than components, say) has no whitened value: it is null, as is
    ``explained`` where all vectors are equal; it does not count in ``identity_error``, which is 0 if no
    component is left. ``deviation`` is null where it does not fit a long. Repeated rows and null ids give
    rows like others; an empty table gives none. Other input columns are ignored, whatever their names.
    """
    spark = embeddings.sparkSession
    ship(spark)
    rows = finite_vectors(embeddings, id_col, vector_col)
    fitted = written(fit_list(rows), "whitening-fit")
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    sums = fitted.select(F.posexplode("x").alias("j", "c")).groupBy("j").agg(
        F.sum(F.col("c").cast("decimal(38,0)")).alias("s"), F.count("*").alias("n")).orderBy("j").collect()
    if not sums:
        return spark.createDataFrame([], schema)
    n, total = sums[0].n, [int(r.s) for r in sums]
    mean = np.array([s / n for s in total])
    covariance = _moments(fitted, lambda x: x - mean, len(mean))[1:] / n
    values, axes = spectral.eigen(covariance, components)
    trace = float(np.trace(covariance))
    real = values > len(mean) * spectral.EPS * max(values[0], 0.0)
    scaled = np.where(real, axes / np.sqrt(np.where(real, values, 1.0)), 0.0)
    explained = values / trace if trace > 0 else np.full(len(values), np.nan)
    moments = _moments(fitted, lambda x: (x - mean) @ scaled, len(values)) / n
    error = np.abs(moments[1:] - np.outer(moments[0], moments[0]) - np.eye(len(values)))[np.ix_(real, real)]
    error = float(error.max()) if error.size else 0.0

    def run(batches):
        for batch in batches:
            x = matrix(batch.column(1), np.int64)
            count, k = len(x), len(values)
            if not count:
                continue
            y = (x - mean) @ scaled
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(batch.column(0).to_pandas(integer_object_nulls=True).to_numpy(object), k), pa.int64()),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), count)),
                pa.array(np.full(count * k, n, np.int64)),
                pa.array(np.repeat(np.array(deviations(x, n, total), object), k), pa.int64()),
                pa.array(y.ravel(), pa.float64(), mask=np.tile(~real, count)),
                pa.array(np.tile(explained, count), pa.float64(), mask=np.tile(np.isnan(explained), count)),
                pa.array(np.full(count * k, error)),
            ], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select("vec_id", gridded(F.col("v")).alias("x")).mapInArrow(run, schema)


def deviations(x: np.ndarray, n: int, total: list[int]) -> list[int | None]:
    """Sum over dimensions of (n * x - total)**2 for each row, exact; None where it exceeds a long."""
    largest = max([n * int(np.abs(x).max()) + max(map(abs, total))]) if x.size else 0
    if largest ** 2 * x.shape[1] < 1 << 63:
        return ((n * x - np.array(total, np.int64)) ** 2).sum(axis=1).tolist()
    exact = [sum((n * int(c) - s) ** 2 for c, s in zip(row, total)) for row in x]
    return [d if d < 1 << 63 else None for d in exact]
