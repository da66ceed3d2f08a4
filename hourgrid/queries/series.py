"""Lag, rolling and calendar features on the filled grid."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.functions.clock import ntz
from hourgrid.operators import demand, scoring, series
from hourgrid.queries import inputs
from hourgrid.queries.inputs import (
    CLEAN_SQL,
    FILLED_SQL,
    MART_SQL,
    SPLIT,
    TWO_MONTHS_SQL,
    features_sql,
    rounded,
    show_month,
    with_features,
)
from hourgrid.queries.registry import query
from hourgrid.schemas import BOOSTING_FEATURES, TARGET

ROLLS = ["roll_6h", "roll_24h", "roll_168h"]
MONTH = "CAST(ingest_month AS VARCHAR) AS ingest_month"
ROLLS_OUT = "round(roll_6h, 6) AS roll_6h, round(roll_24h, 6) AS roll_24h, round(roll_168h, 6) AS roll_168h"
FEATURES_OUT = f"""SELECT {MONTH}, hour_start, pu_location, trip_count, lag_1h, lag_24h, lag_168h,
       {ROLLS_OUT}, pickup_hour, pickup_dow, is_weekend FROM features"""


@query("lag_features", sql=with_features(f"SELECT {MONTH}, hour_start, pu_location, trip_count, lag_1h, lag_24h, lag_168h FROM features"))
def lag_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return show_month(series.lags(inputs.filled(spark, sf_dir)))


@query("rolling_inclusive", sql=with_features(f"SELECT {MONTH}, hour_start, pu_location, trip_count, {ROLLS_OUT} FROM features"))
def rolling_inclusive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(show_month(series.rolling_means(inputs.filled(spark, sf_dir))), ROLLS)


@query(
    "rolling_exclusive",
    sql=with_features(
        f"SELECT {MONTH}, hour_start, pu_location, trip_count, {ROLLS_OUT} FROM features", include_current=False
    ),
)
def rolling_exclusive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(show_month(series.rolling_means(inputs.filled(spark, sf_dir), include_current=False)), ROLLS)


@query("demand_features", sql=with_features(FEATURES_OUT))
def demand_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(show_month(inputs.features(spark, sf_dir)), ROLLS)


def _two_months_sql(partition: str) -> str:
    more = features_sql(partition)
    return f"WITH {TWO_MONTHS_SQL},{CLEAN_SQL},{MART_SQL},{FILLED_SQL}{more}\n{FEATURES_OUT}"


def _two_months_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = inputs.two_months(inputs.clean(spark, sf_dir))
    return inputs.filled_from(inputs.cut_lineage(demand.zone_hour_demand(both)))


@query("demand_features_month_scoped", sql=_two_months_sql("ingest_month, pu_location"))
def demand_features_month_scoped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(show_month(series.demand_features(_two_months_filled(spark, sf_dir))), ROLLS)


@query("demand_features_across_months", sql=_two_months_sql("pu_location"))
def demand_features_across_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = series.demand_features(_two_months_filled(spark, sf_dir), across_months=True)
    return rounded(show_month(rows), ROLLS)


@query(
    "train_split_counts",
    sql=with_features(
        f"""SELECT CASE WHEN hour_start < TIMESTAMP '{SPLIT}' THEN 'train' ELSE 'valid' END AS part,
       count(*) AS n_rows,
       count(*) FILTER (WHERE lag_1h IS NOT NULL AND lag_24h IS NOT NULL AND lag_168h IS NOT NULL) AS n_complete,
       CAST(sum(trip_count) AS BIGINT) AS total_trips
FROM features GROUP BY 1"""
    ),
)
def train_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows before and from the split, and how many have every feature: one pass."""
    rows = inputs.features(spark, sf_dir)
    part = F.when(F.col("hour_start") < ntz(SPLIT), "train").otherwise("valid")
    return rows.groupBy(part.alias("part")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(scoring.complete(rows, [*BOOSTING_FEATURES, TARGET])).alias("n_complete"),
        F.sum(TARGET).alias("total_trips"),
    )


@query(
    "history_window",
    sql=with_features(
        f"""SELECT hour_start, pu_location, trip_count FROM features
WHERE hour_start >= TIMESTAMP '{SPLIT}' - INTERVAL 168 HOUR AND hour_start <= TIMESTAMP '{SPLIT}' - INTERVAL 1 HOUR"""
    ),
)
def history_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scoring.within_history(inputs.filled(spark, sf_dir), SPLIT)
    return rows.select("hour_start", "pu_location", "trip_count")


@query(
    "horizon_window",
    sql=with_features(
        f"""SELECT hour_start, pu_location, trip_count, lag_168h FROM features
WHERE hour_start >= TIMESTAMP '{SPLIT}' AND hour_start < TIMESTAMP '{SPLIT}' + INTERVAL 24 HOUR
  AND lag_1h IS NOT NULL AND lag_24h IS NOT NULL AND lag_168h IS NOT NULL"""
    ),
)
def horizon_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scoring.within_horizon(inputs.features(spark, sf_dir), SPLIT, 24)
    return scoring.drop_nulls(rows, BOOSTING_FEATURES).select("hour_start", "pu_location", "trip_count", "lag_168h")
