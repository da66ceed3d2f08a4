"""Small numeric and text helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def zero_fill(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def clip(value: Column, low: float | None = None, high: float | None = None) -> Column:
    """Bound a column; NULL stays NULL."""
    bounded = value
    if low is not None:
        bounded = F.when(value < low, F.lit(low)).otherwise(bounded)
    if high is not None:
        bounded = F.when(value > high, F.lit(high)).otherwise(bounded)
    return bounded


def abs_error(truth: Column, predicted: Column) -> Column:
    return F.abs(truth.cast("double") - predicted.cast("double"))


def sq_error(truth: Column, predicted: Column) -> Column:
    gap = truth.cast("double") - predicted.cast("double")
    return gap * gap


def truncate_text(text: Column, length: int) -> Column:
    return F.substring(text, 1, length)


def reindex(df: DataFrame, names: list[str], fill: float | None = None) -> DataFrame:
    """Exactly ``names``, in that order; an absent column is ``fill`` (NULL by default)."""
    present = set(df.columns)
    return df.select(
        *[F.col(n) if n in present else F.lit(fill).cast("double").alias(n) for n in names]
    )
