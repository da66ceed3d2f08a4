"""Models and forecasts. Trained models have no SQL counterpart."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.functions.clock import ntz
from hourgrid.models.baselines import ExpressionModel
from hourgrid.models.boosting import PoissonBoosting
from hourgrid.models.glm import fit_poisson_glm
from hourgrid.operators import scoring
from hourgrid.operators.series import demand_features
from hourgrid.plans import forecast
from hourgrid.queries import inputs
from hourgrid.queries.inputs import SPLIT, TRAIN_END, rounded, with_features
from hourgrid.queries.registry import query
from hourgrid.schemas import BOOSTING_FEATURES, GLM_NUMERIC_FEATURES, TARGET
from hourgrid.session import shared_folder

HISTORY_SQL = f""",
history AS (
  SELECT pu_location, list(CAST(trip_count AS DOUBLE) ORDER BY hour_start) AS buf
  FROM features
  WHERE hour_start >= TIMESTAMP '{TRAIN_END}' - INTERVAL 168 HOUR AND hour_start < TIMESTAMP '{TRAIN_END}'
  GROUP BY 1
)"""


@query(
    "history_buffers",
    sql=with_features(
        "SELECT pu_location, CAST(unnest(range(168)) AS INTEGER) AS place, unnest(buf) AS trips FROM history",
        HISTORY_SQL,
    ),
)
def history_buffers(spark: SparkSession, sf_dir: str) -> DataFrame:
    buffers = forecast.history_buffers(inputs.filled(spark, sf_dir), TRAIN_END)
    return buffers.select("pu_location", F.posexplode("buf").alias("place", "trips"))


@query(
    "history_buffers_short",
    sql=with_features(
        """SELECT pu_location, CAST(unnest(range(168)) AS INTEGER) AS place,
       unnest(list_concat(list_resize(CAST([] AS DOUBLE[]), 168 - len(s), 0.0::DOUBLE), s)) AS trips
FROM (SELECT pu_location, list(CAST(trip_count AS DOUBLE) ORDER BY hour_start) AS s FROM mart
      WHERE hour_start >= TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 168 HOUR AND hour_start < TIMESTAMP '2024-01-30 00:00:00'
      GROUP BY 1)"""
    ),
)
def history_buffers_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Histories with missing hours: short ones are padded on the left."""
    buffers = forecast.history_buffers(inputs.mart(spark, sf_dir), TRAIN_END)
    return buffers.select("pu_location", F.posexplode("buf").alias("place", "trips"))


@query(
    "history_buffers_strict",
    sql=with_features(
        f"""SELECT f.pu_location,
       CAST((epoch_us(f.hour_start) - epoch_us(TIMESTAMP '{TRAIN_END}')) // 3600000000 + 168 AS INTEGER) AS place,
       CAST(f.trip_count AS DOUBLE) AS trips
FROM filled f JOIN (SELECT DISTINCT pu_location FROM mart
  WHERE hour_start >= TIMESTAMP '{TRAIN_END}' - INTERVAL 168 HOUR AND hour_start < TIMESTAMP '{TRAIN_END}') z USING (pu_location)
WHERE f.hour_start >= TIMESTAMP '{TRAIN_END}' - INTERVAL 168 HOUR AND f.hour_start < TIMESTAMP '{TRAIN_END}'"""
    ),
)
def history_buffers_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same histories with every value at its own hour."""
    buffers = forecast.history_buffers(inputs.mart(spark, sf_dir), TRAIN_END, strict_hours=True)
    return buffers.select("pu_location", F.posexplode("buf").alias("place", "trips"))


@query(
    "buffer_features",
    sql=with_features(
        f"""SELECT pu_location, buf[168] AS lag_1h, buf[145] AS lag_24h, buf[1] AS lag_168h,
       round(list_avg(buf[163:168]), 6) AS roll_6h, round(list_avg(buf[145:168]), 6) AS roll_24h,
       round(list_avg(buf), 6) AS roll_168h,
       CAST(hour(TIMESTAMP '{TRAIN_END}') AS SMALLINT) AS pickup_hour,
       CAST(dayofweek(TIMESTAMP '{TRAIN_END}') AS SMALLINT) AS pickup_dow,
       dayofweek(TIMESTAMP '{TRAIN_END}') IN (0, 6) AS is_weekend
FROM history""",
        HISTORY_SQL,
    ),
)
def buffer_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = forecast.history_buffers(inputs.filled(spark, sf_dir), TRAIN_END)
    rows = forecast.features_from_buffer(state, TRAIN_END).drop("buf")
    return rounded(rows, ["roll_6h", "roll_24h", "roll_168h"])


def weighted_history() -> Column:
    """A fixed formula over the features; goes below zero at quiet hours."""
    return (
        0.45 * F.col("lag_24h")
        + 0.25 * F.col("roll_6h")
        + 0.2 * F.col("roll_168h")
        + 0.1 * F.col("lag_1h")
        - 0.02 * F.col("pickup_hour")
        + F.when(F.col("is_weekend"), 0.3).otherwise(0.0)
        + 0.001 * F.col("pu_location")
    )


def _recursive_sql(horizon: int) -> str:
    hour = f"TIMESTAMP '{TRAIN_END}' + to_hours(CAST(step AS INTEGER))"
    yhat = f"""0.45::DOUBLE * buf[len(buf) - 23] + 0.25::DOUBLE * list_avg(buf[len(buf) - 5 : len(buf)])
      + 0.2::DOUBLE * list_avg(buf[len(buf) - 167 : len(buf)]) + 0.1::DOUBLE * buf[len(buf)]
      - 0.02::DOUBLE * hour({hour}) + CASE WHEN dayofweek({hour}) IN (0, 6) THEN 0.3::DOUBLE ELSE 0.0::DOUBLE END
      + 0.001::DOUBLE * pu_location"""
    body = f""",
steps AS (
  SELECT pu_location, 0 AS step, buf FROM history
  UNION ALL
  SELECT pu_location, step + 1, list_append(buf, greatest({yhat}, 0.0::DOUBLE)) FROM steps WHERE step < {horizon}
)"""
    text = with_features(
        f"""SELECT TIMESTAMP '{TRAIN_END}' + to_hours(CAST(step - 1 AS INTEGER)) AS hour_start, pu_location,
       round(buf[len(buf)], 6) AS yhat FROM steps WHERE step > 0""",
        HISTORY_SQL + body,
    )
    return text.replace("WITH", "WITH RECURSIVE", 1)


@query("recursive_forecast_expr", sql=_recursive_sql(24))
def recursive_forecast_expr(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = ExpressionModel(weighted_history())
    return rounded(forecast.recursive_forecast(inputs.filled(spark, sf_dir), model, TRAIN_END, 24), ["yhat"])


@query("recursive_forecast_two_days", sql=_recursive_sql(48))
def recursive_forecast_two_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = ExpressionModel(weighted_history())
    return rounded(forecast.recursive_forecast(inputs.filled(spark, sf_dir), model, TRAIN_END, 48), ["yhat"])


@query("latest_train_end", sql=with_features("SELECT max(hour_start) + INTERVAL 1 HOUR AS train_end FROM features"))
def latest_train_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    end = forecast.latest_train_end(inputs.filled(spark, sf_dir))
    return spark.range(1).select(ntz(end).alias("train_end"))


def _serving_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of earlier hours only, as a forecast sees them; read from files."""
    filled = inputs.filled(spark, sf_dir)
    return inputs.cut_lineage(demand_features(filled, include_current=False))


def _models(spark: SparkSession) -> str:
    """Models of this session: queries of the same training rows share one fit."""
    return f"{shared_folder(spark)}/models/{spark.sparkContext.applicationId}"


@query("recursive_forecast_boosted")
def recursive_forecast_boosted(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _serving_features(spark, sf_dir)
    model = forecast.stored_model(scoring.before(rows, TRAIN_END), PoissonBoosting(), _models(spark))
    return forecast.recursive_forecast(rows, model, TRAIN_END, 24)


@query("replay_forecast_boosted")
def replay_forecast_boosted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast.replay_forecast(_serving_features(spark, sf_dir), TRAIN_END, 24, models=_models(spark))


@query("boosting_comparison")
def boosting_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boosted model and baseline on the rows after the split."""
    rows = _serving_features(spark, sf_dir)
    model = forecast.stored_model(scoring.before(rows, SPLIT), PoissonBoosting(), _models(spark))
    valid = scoring.drop_nulls(scoring.from_hour(rows, SPLIT), [*BOOSTING_FEATURES, TARGET])
    return scoring.model_comparison(model.transform(valid), {"lag_24h": "lag_24h", "poisson_boosting": "yhat"})


def _fitted_glm(spark: SparkSession, sf_dir: str):
    rows = _serving_features(spark, sf_dir)
    return rows, fit_poisson_glm(scoring.before(rows, SPLIT))


@query("poisson_glm")
def poisson_glm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Poisson regression and baseline on the rows after the split."""
    rows, model = _fitted_glm(spark, sf_dir)
    valid = scoring.drop_nulls(scoring.from_hour(rows, SPLIT), [*GLM_NUMERIC_FEATURES, "pu_location", TARGET])
    return scoring.model_comparison(model.transform(valid), {"lag_24h": "lag_24h", "poisson_glm": "yhat"})


@query("glm_coefficients")
def glm_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, model = _fitted_glm(spark, sf_dir)
    return model.coefficients()
