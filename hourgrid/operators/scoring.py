"""Filters, joins and aggregates for training splits and forecast errors."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from hourgrid.functions import clock
from hourgrid.functions.measures import abs_error, sq_error
from hourgrid.schemas import TARGET


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """Runs one small job: raise when ``df`` has no row."""
    if df.isEmpty():
        raise RuntimeError(message)
    return df


def complete(df: DataFrame, names: list[str]) -> Column:
    """True where every named column is present; NaN counts as absent."""
    keep = F.lit(True)
    for name in names:
        keep = keep & F.col(name).isNotNull()
        if isinstance(df.schema[name].dataType, (DoubleType, FloatType)):
            keep = keep & ~F.isnan(name)
    return keep


def drop_nulls(df: DataFrame, names: list[str]) -> DataFrame:
    return df.where(complete(df, names))


def before(df: DataFrame, cut: Column | str | dt.datetime) -> DataFrame:
    return df.where(F.col("hour_start") < clock.ntz(cut))


def from_hour(df: DataFrame, cut: Column | str | dt.datetime) -> DataFrame:
    return df.where(F.col("hour_start") >= clock.ntz(cut))


def within_horizon(df: DataFrame, start: Column | str | dt.datetime, hours: int) -> DataFrame:
    return from_hour(df, start).where(F.col("hour_start") < clock.add_hours(clock.ntz(start), hours))


def within_history(df: DataFrame, end: Column | str | dt.datetime, hours: int = 168) -> DataFrame:
    """The ``hours`` hours that end just before ``end``."""
    end = clock.ntz(end)
    return df.where(F.col("hour_start").between(clock.add_hours(end, -hours), clock.add_hours(end, -1)))


def of_zone(df: DataFrame, zone: int) -> DataFrame:
    return df.where(F.col("pu_location") == zone)


def of_run(
    df: DataFrame, run_ts: Column | str | dt.datetime, model_name: str | None = None
) -> DataFrame:
    kept = df.where(F.col("run_ts") == clock.instant(run_ts))
    return kept if model_name is None else kept.where(F.col("model_name") == model_name)


def join_truth(
    predictions: DataFrame, truth: DataFrame, collapse_truth: bool = False
) -> DataFrame:
    """Predictions with the observed count of the same zone-hour.

    A prediction without truth is left out. The truth of a zone-hour can come
    from two ingest months and then gives two rows; ``collapse_truth`` adds
    them up first.
    """
    keys = ["hour_start", "pu_location"]
    observed = truth.select(*keys, TARGET)
    if collapse_truth:
        observed = observed.groupBy(*keys).agg(F.sum(TARGET).cast("int").alias(TARGET))
    return predictions.join(observed, keys, "inner")


def mae_rmse(scored: DataFrame, by: list[str] | None = None, truth: str = TARGET, predicted: str = "yhat") -> DataFrame:
    """Row count, mean absolute error and root mean squared error in one pass."""
    y, p = F.col(truth), F.col(predicted)
    return scored.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).cast("int").alias("rows_joined"),
        F.avg(abs_error(y, p)).alias("mae"),
        F.sqrt(F.avg(sq_error(y, p))).alias("rmse"),
    )


def zone_errors(scored: DataFrame, truth: str = TARGET, predicted: str = "yhat") -> DataFrame:
    return scored.groupBy("pu_location").agg(
        F.avg(abs_error(F.col(truth), F.col(predicted))).alias("abs_err")
    )


def worst_zones(scored: DataFrame, n: int = 20, truth: str = TARGET, predicted: str = "yhat") -> DataFrame:
    """Zones with the largest mean absolute error; ties by zone."""
    return zone_errors(scored, truth, predicted).orderBy(F.desc("abs_err"), "pu_location").limit(n)


def latest_run(predictions: DataFrame, model_name: str | None = None) -> DataFrame:
    """One row with the newest ``run_ts`` (NULL when there is none)."""
    runs = predictions if model_name is None else predictions.where(F.col("model_name") == model_name)
    return runs.agg(F.max("run_ts").alias("run_ts"))


def model_comparison(df: DataFrame, candidates: dict[str, str], truth: str = TARGET) -> DataFrame:
    """Errors of several prediction columns, each over the rows where it is present.

    The columns are stacked into (model, yhat) rows in the same scan; with
    map-side aggregation only one row per model and task is shuffled.
    """
    stacked = df.select(
        F.col(truth),
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(name).alias("model"), F.col(column).cast("double").alias("yhat"))
                    for name, column in candidates.items()
                ]
            )
        ).alias("_p"),
    ).select(truth, "_p.model", "_p.yhat")
    return mae_rmse(drop_nulls(stacked, [truth, "yhat"]), by=["model"], truth=truth)


def zone_series(df: DataFrame, zone: int | DataFrame, names: list[str], n: int | None = None) -> DataFrame:
    """Aligned columns of one zone in hour order, optionally the first ``n`` rows.

    ``zone`` is a number, or a one-row frame with ``pu_location``.
    """
    if isinstance(zone, DataFrame):
        rows = df.join(zone.select("pu_location"), "pu_location", "left_semi")
    else:
        rows = of_zone(df, zone)
    ordered = rows.select("pu_location", "hour_start", *names).orderBy("hour_start")
    return ordered if n is None else ordered.limit(n)
