"""Whitened embeddings by shifted CholeskyQR.

1. Components become whole numbers x = floor(``SCALE`` * c) + ``OFFSET``. The fit list is each distinct x
   vector once; its count n and sums S are exact, and n*x - S is, so rows are centred without rounding.
2. A pass adds up the Gram matrix of the centred rows inside the tasks. The first one's diagonal is
   shifted, which makes its Cholesky factor exist whatever the condition; the next passes solve each
   row against the triangular factors found so far and factor the Gram matrix of what comes out, until
   that is the identity. The rows themselves are never rewritten.
3. The product of the factors is the R of the centred rows. Its singular values and right vectors, found on the
   driver from a matrix of the vectors' length, give the covariance's eigenvalues and components.

Tasks hold one batch and one length x length matrix. What is shuffled per pass is one such matrix a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from hourgrid.llm.frames import stage
from hourgrid.llm.vectors import double_sums, exact_sums, in_long, matrix, usable

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 16
# Passes over the rows at most; rows of full rank need three.
PASSES = 6
ORTHOGONAL = 1e-12
# Eigenvalues below this share of the largest are rounding noise: no variance.
NO_VARIANCE = 1e-18
# Scaled components are cut off at this magnitude, so that x is a long.
FARTHEST = 2.0**61
UNIT = float(np.finfo(np.float64).eps) / 2
BLOCK = 32


def whole(vector: Column) -> Column:
    """x = floor(``SCALE`` * c) + ``OFFSET`` of every component, as longs."""
    scaled = lambda c: F.least(F.greatest(c.cast("double") * SCALE, F.lit(-FARTHEST)), F.lit(FARTHEST))
    return F.transform(vector, lambda c: F.floor(scaled(c)).cast("long") + F.lit(OFFSET).cast("long"))


@dataclass
class Centre:
    """Count, exact sums and largest magnitude of the fit list."""

    n: int
    sums: list[int]
    largest: int

    def numerators(self, x: np.ndarray) -> np.ndarray:
        """n*x - S as longs, or as Python's whole numbers where those could overflow."""
        if self.n * (self.largest + 1) < 1 << 61:
            return self.n * x.astype(np.int64) - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)

    def rows(self, x: np.ndarray) -> np.ndarray:
        """Centred rows as doubles."""
        return (self.numerators(x) / self.n).astype(np.float64)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The sum over dimensions of (n*x - S)**2, NULL beyond a long."""
        above = self.numerators(x)
        if above.dtype == object or float(np.abs(above).max(initial=0)) ** 2 * x.shape[1] >= 2.0**62:
            return [in_long(e) for e in (above.astype(object) ** 2).sum(axis=1).tolist()]
        return (above**2).sum(axis=1).tolist()


def solve_rows(rows: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """The y with y @ factor = rows, for an upper triangular factor, by blocks of columns."""
    solved = np.empty_like(rows)
    for begin in range(0, rows.shape[1], BLOCK):
        end = min(begin + BLOCK, rows.shape[1])
        rest = rows[:, begin:end] - solved[:, :begin] @ factor[:begin, begin:end]
        for j in range(begin, end):
            solved[:, j] = (rest[:, j - begin] - solved[:, begin:j] @ factor[begin:j, j]) / factor[j, j]
    return solved


def _centre(fit_list: DataFrame, length: int, largest: int) -> Centre:
    def add(batches: Iterator[pa.RecordBatch]) -> list[int]:
        totals = np.zeros(length + 1, object)
        for batch in batches:
            x = matrix(batch.column(0), length)
            x = x.astype(np.int64 if largest < 1 << 40 else object)
            totals += np.array([*x.sum(axis=0).tolist(), len(x)], object)
        return totals.tolist()

    *sums, n = exact_sums(fit_list, length + 1, add)
    return Centre(n, sums, largest)


def _gram(fit_list: DataFrame, centre: Centre, factors: list[np.ndarray]) -> np.ndarray:
    """The Gram matrix of the centred rows after the triangular solves."""
    length = len(centre.sums)
    upper = np.triu_indices(length)

    def add(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros((length, length))
        for batch in batches:
            rows = centre.rows(matrix(batch.column(0), length))
            for factor in factors:
                rows = solve_rows(rows, factor)
            total += rows.T @ rows
        return total[upper]

    gram = np.zeros((length, length))
    gram[upper] = double_sums(fit_list, len(upper[0]), add)
    return gram + np.triu(gram, 1).T


def _factor(gram: np.ndarray, n: int, shifted: bool) -> np.ndarray:
    """The upper Cholesky factor; of the shifted matrix if asked for or if there is none without."""
    if not shifted:
        try:
            return np.linalg.cholesky(gram).T
        except np.linalg.LinAlgError:
            pass
    length = len(gram)
    shift = 11 * (n * length + length * (length + 1)) * UNIT * np.linalg.norm(gram, 2)
    return np.linalg.cholesky(gram + shift * np.eye(length)).T


def triangular_factor(fit_list: DataFrame, centre: Centre) -> np.ndarray:
    """R of the centred rows; a zero matrix if all rows are the same."""
    length = len(centre.sums)
    factors: list[np.ndarray] = []
    whole_factor = np.eye(length)
    for _ in range(PASSES):
        gram = _gram(fit_list, centre, factors)
        if not factors and not gram.any():
            return np.zeros((length, length))
        if factors and np.abs(gram - np.eye(length)).max() <= ORTHOGONAL:
            break
        factors.append(_factor(gram, centre.n, not factors))
        whole_factor = factors[-1] @ whole_factor
    return whole_factor


@dataclass
class Whitening:
    """``directions``: one column per component, over the root of its eigenvalue; NaN where there is no variance."""

    centre: Centre
    directions: np.ndarray
    explained: list[float]
    identity_error: float | None


def fit(vectors: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """Centre, components and eigenvalues of the distinct x vectors; None without a usable vector.

    Duplicates are removed by a grouping whose tasks reduce their own copies first, so a vector that is
    a third of all rows is one row per task there.
    """
    good, length = usable(vectors.select(vector_col), vector_col)
    if not length:
        return None
    x = good.select(whole(F.col(vector_col)).alias("x"))
    largest = x.agg(F.max(F.greatest(F.array_max("x"), -F.array_min("x")))).first()[0]
    # Half the bytes to shuffle and store where the numbers are small, as they are for usual embeddings.
    narrow = "array<int>" if largest < 1 << 31 else "array<bigint>"
    fit_list = stage(x.select(F.col("x").cast(narrow).alias("x")).distinct())
    centre = _centre(fit_list, length, largest)
    _, singular, right = np.linalg.svd(triangular_factor(fit_list, centre))
    values, count = singular**2 / centre.n, min(components, length)
    trace = values.sum()
    there = values[:count] > NO_VARIANCE * values[0]
    with np.errstate(divide="ignore", invalid="ignore"):
        directions = np.where(there, right[:count].T / np.sqrt(values[:count]), np.nan)
    explained = [float(v / trace) if trace else 0.0 for v in values[:count]]
    model = Whitening(centre, directions, explained, None)
    model.identity_error = _identity_error(fit_list, model, there)
    return model


def _identity_error(fit_list: DataFrame, model: Whitening, there: np.ndarray) -> float | None:
    """The largest entry of the whitened rows' covariance minus the identity, over components with variance."""
    length, count = len(model.centre.sums), int(there.sum())
    if not count:
        return None

    def add(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros((count + 1, count + 1))
        for batch in batches:
            rows = model.centre.rows(matrix(batch.column(0), length)) @ model.directions[:, there]
            rows = np.concatenate([rows, np.ones((len(rows), 1))], axis=1)
            total += rows.T @ rows
        return total.ravel()

    total = double_sums(fit_list, (count + 1) ** 2, add).reshape(count + 1, count + 1) / model.centre.n
    mean = total[count, :count]
    return float(np.abs(total[:count, :count] - np.outer(mean, mean) - np.eye(count)).max())


def whiten(vectors: DataFrame, model: Whitening | None, vector_col: str = "embedding") -> DataFrame:
    """Usable rows with ``whitened``, an array with one number per component, and ``deviation``.

    A component without variance has NULL. ``deviation`` is NULL beyond a long. Rows whose vector is
    NULL, has a NULL or non-finite component, or another length than the fitted ones, go. Equal rows have equal
    results; other columns stay, those named ``whitened`` or ``deviation`` are replaced; an empty table stays empty.
    """
    kept = [f for f in vectors.schema.fields if f.name not in ("whitened", "deviation")]
    new = [T.StructField("whitened", T.ArrayType(T.DoubleType())), T.StructField("deviation", T.LongType())]
    schema = T.StructType([*kept, *new])
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    arrow, length = to_arrow_schema(schema), len(model.centre.sums)
    good, _ = usable(vectors, vector_col)
    rows = good.where(F.size(vector_col) == length).withColumn("__x", whole(F.col(vector_col)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(batch.schema.get_field_index("__x")), length)
            projected = model.centre.rows(x) @ model.directions
            flat = pa.array(projected.ravel(), pa.float64(), mask=np.isnan(projected.ravel()))
            offsets = np.arange(0, projected.size + 1, projected.shape[1], dtype=np.int32)
            deviation = pa.array(model.centre.deviations(x), pa.int64())
            columns = [batch.column(batch.schema.get_field_index(f.name)).cast(arrow.field(f.name).type) for f in kept]
            made = pa.ListArray.from_arrays(offsets, flat).cast(arrow.field("whitened").type)
            yield pa.RecordBatch.from_arrays([*columns, made, deviation], schema=arrow)

    return rows.mapInArrow(run, schema)


def whitened_components(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error), one row per usable row and component.

    Components are numbered from 1 by falling eigenvalue, at most ``COMPONENTS``. Rows that share an id each have
    their rows; a vector of another than the most frequent length goes; further columns are ignored.
    """
    model = fit(vectors, vector_col)
    rows = whiten(vectors.select(id_col, vector_col), model, vector_col)
    explained = F.array(*[F.lit(e) for e in model.explained]) if model else F.array().cast("array<double>")
    listed = rows.select(id_col, "deviation", F.posexplode("whitened").alias("_at", "whitened"))
    return listed.select(
        id_col,
        (F.col("_at") + 1).cast("int").alias("component"),
        F.lit(model.centre.n if model else None).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("_at")).alias("explained"),
        F.lit(model.identity_error if model else None).cast("double").alias("identity_error"),
    )
