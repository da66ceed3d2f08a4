"""Selective reads of stored tables and generated hours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.functions.clock import hours_between, ntz


def scan_table(
    spark: SparkSession,
    table: str,
    predicate: Column | None = None,
    names: list[str] | None = None,
    order: list[str] | None = None,
) -> DataFrame:
    """Filter and projection reach the Parquet scan; order only for display."""
    df = spark.table(table)
    if predicate is not None:
        df = df.where(predicate)
    if names:
        df = df.select(*names)
    return df.orderBy(*order) if order else df


def hour_grid(bounds: DataFrame, start: Column, end_inclusive: Column) -> DataFrame:
    """Every hour between two columns (or literals) of ``bounds``."""
    return bounds.select(
        F.explode(hours_between(ntz(start), ntz(end_inclusive))).alias("hour_start")
    )


def ingest_status(spark: SparkSession, table: str, state: DataFrame, n: int = 5) -> tuple[DataFrame, DataFrame]:
    """Row count of the raw table, and the ``n`` most recently started loads."""
    count = spark.table(table).agg(F.count(F.lit(1)).alias("row_count"))
    newest = state.orderBy(F.desc("started_at"), "dataset", "year", "month").limit(n)
    return count, newest
