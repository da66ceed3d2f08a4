"""Predictions that are existing columns or column expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ExpressionModel:
    """``yhat`` as an expression over the feature columns."""

    expression: Column

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("yhat", self.expression.cast("double"))


def _present(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn("yhat", F.col(column).cast("double")).where(F.col("yhat").isNotNull())


def baseline_lag(df: DataFrame, hours: int = 24) -> DataFrame:
    """The count ``hours`` earlier, where there is one."""
    return _present(df, f"lag_{hours}h")


def baseline_roll(df: DataFrame, hours: int = 24) -> DataFrame:
    """The rolling mean; it includes the scored hour itself in the stored table."""
    return _present(df, f"roll_{hours}h")


def stacked_baselines(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Rows of several baselines from one pass: ``model_name`` and ``yhat`` per named column."""
    each = [F.struct(F.lit(n).alias("model_name"), F.col(c).cast("double").alias("yhat")) for n, c in columns.items()]
    return df.withColumn("_m", F.explode(F.array(*each))).select("*", "_m.*").drop("_m").where("yhat IS NOT NULL")
