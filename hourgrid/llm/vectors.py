"""What the operators on embedding vectors share: usable rows and whole-number components."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction
from math import floor

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Whole numbers below this bound are handled as longs: squares of differences, and sums of up to 2**8 of them, fit.
EXACT = 1 << 26
# Sums travel as digits of this base: a long holds the sum of 2**23 tasks' digits.
DIGIT_BITS = 40


def is_finite(vector: Column) -> Column:
    """The vector is there and so is each component, a finite number."""
    good = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return vector.isNotNull() & F.coalesce(F.forall(vector, good), F.lit(False))


def usable(df: DataFrame, vector_col: str) -> tuple[DataFrame, int]:
    """Rows with finite vectors of the usual length, and that length (0 without such rows).

    The usual length is the most frequent one, the larger one of two as frequent.
    """
    finite = df.where(is_finite(F.col(vector_col)))
    lengths = finite.groupBy(F.size(vector_col).alias("length")).count()
    most = lengths.orderBy(F.desc("count"), F.desc("length")).first()
    length = most["length"] if most else 0
    return finite.where(F.size(vector_col) == length), length


def matrix(column: pa.Array, length: int) -> np.ndarray:
    """The vectors of an Arrow list column, one row each."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, length)


def floors(values: np.ndarray, factor: int) -> np.ndarray:
    """floor(factor * value) of finite values, exactly: longs, or Python's whole numbers if one is beyond ``EXACT``."""
    scaled = values.astype(np.float64) * factor  # a power of two: exact, or infinite
    if not scaled.size or np.abs(scaled).max() < EXACT:
        return np.floor(scaled).astype(np.int64)
    flat = [floor(Fraction(v) * factor) for v in values.astype(np.float64).ravel().tolist()]
    out = np.empty(len(flat), object)
    out[:] = flat
    return out.reshape(values.shape)


def in_long(number: int) -> int | None:
    return int(number) if -(1 << 63) <= number < 1 << 63 else None


def _digits(number: int) -> Iterator[tuple[int, int]]:
    sign, rest, place = (-1 if number < 0 else 1), abs(number), 0
    while rest:
        rest, digit = rest >> DIGIT_BITS, rest & ((1 << DIGIT_BITS) - 1)
        if digit:
            yield place, sign * digit
        place += 1


def exact_sums(rows: DataFrame, count: int, add: Callable[[Iterator[pa.RecordBatch]], list[int]]) -> list[int]:
    """``count`` sums of whole numbers of any size over all rows; ``add`` gives those of one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [(at, *digit) for at, number in enumerate(add(batches)) for digit in _digits(int(number))]
        columns = list(zip(*found, strict=True)) or [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["at", "digit", "value"])

    made = rows.mapInArrow(run, "at long, digit long, value long")
    totals = [0] * count
    for at, digit, value in made.groupBy("at", "digit").agg(F.sum("value").alias("value")).collect():
        totals[at] += value << (DIGIT_BITS * digit)
    return totals


def double_sums(rows: DataFrame, count: int, add: Callable[[Iterator[pa.RecordBatch]], np.ndarray]) -> np.ndarray:
    """``count`` sums of doubles over all rows; ``add`` gives those of one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = add(batches)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(count)), pa.array(found, pa.float64())], ["at", "value"])

    made = rows.mapInArrow(run, "at long, value double")
    totals = np.zeros(count)
    for at, value in made.groupBy("at").agg(F.sum("value").alias("value")).collect():
        totals[at] = value
    return totals
