"""Baselines, stored runs joined with observed demand, and their errors."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.functions.clock import instant
from hourgrid.models.baselines import baseline_lag, baseline_roll, stacked_baselines
from hourgrid.operators import explore, scoring
from hourgrid.operators.grid import filled_demand
from hourgrid.operators.series import demand_features
from hourgrid.plans import evaluate
from hourgrid.plans.forecast import as_predictions
from hourgrid.queries import inputs
from hourgrid.queries.inputs import SPLIT, rounded, with_features
from hourgrid.queries.registry import query

VALID_SQL = f", valid AS (SELECT * FROM features WHERE hour_start >= TIMESTAMP '{SPLIT}')"
SPLIT_TIME = dt.datetime.fromisoformat(SPLIT)
HORIZON = 168
# Two stored runs, one per baseline; the second is the newer one.
RUNS = {
    "lag_24h": dt.datetime(2024, 2, 1, 6, 0),
    "roll_24h": dt.datetime(2024, 2, 1, 7, 30),
}
PREDICTIONS_SQL = f""",
predictions AS (
  SELECT TIMESTAMP '{RUNS["lag_24h"]}' AS run_ts, hour_start, pu_location, CAST(lag_24h AS DOUBLE) AS yhat,
         'lag_24h' AS model_name
  FROM features WHERE lag_24h IS NOT NULL
    AND hour_start >= TIMESTAMP '{SPLIT}' AND hour_start < TIMESTAMP '{SPLIT}' + INTERVAL {HORIZON} HOUR
  UNION ALL
  SELECT TIMESTAMP '{RUNS["roll_24h"]}', hour_start, pu_location, roll_24h, 'roll_24h'
  FROM features WHERE roll_24h IS NOT NULL
    AND hour_start >= TIMESTAMP '{SPLIT}' AND hour_start < TIMESTAMP '{SPLIT}' + INTERVAL {HORIZON} HOUR
)"""


def errors_sql(source: str, pred: str, extra: str = "") -> str:
    return f"""SELECT {extra}CAST(count(*) AS INTEGER) AS rows_joined,
       round(avg(abs(trip_count - {pred})), 6) AS mae,
       round(sqrt(avg((trip_count - {pred}) * (trip_count - {pred}))), 6) AS rmse
FROM {source}"""


def _valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.from_hour(inputs.features(spark, sf_dir), SPLIT)


def predictions(features: DataFrame) -> DataFrame:
    rows = scoring.within_horizon(features, SPLIT, HORIZON)
    both = stacked_baselines(rows, {"lag_24h": "lag_24h", "roll_24h": "roll_24h"})
    run = F.coalesce(*[F.when(F.col("model_name") == n, instant(ts)) for n, ts in RUNS.items()])
    return as_predictions(both, run, F.col("model_name"), SPLIT_TIME, HORIZON)


def _mart_and_predictions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    mart = inputs.stored_mart(spark, sf_dir)
    filled = filled_demand(mart, *inputs.month_bounds(mart))
    return mart, filled, predictions(demand_features(filled))


def _shown(df: DataFrame) -> DataFrame:
    return df.withColumn("run_ts", F.col("run_ts").cast("timestamp_ntz")) if "run_ts" in df.columns else df


@query("baseline_lag24", sql=with_features(errors_sql("valid WHERE lag_24h IS NOT NULL", "lag_24h"), VALID_SQL))
def baseline_lag24(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(scoring.mae_rmse(baseline_lag(_valid(spark, sf_dir))), ["mae", "rmse"])


@query("baseline_roll24", sql=with_features(errors_sql("valid WHERE roll_24h IS NOT NULL", "roll_24h"), VALID_SQL))
def baseline_roll24(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(scoring.mae_rmse(baseline_roll(_valid(spark, sf_dir))), ["mae", "rmse"])


@query(
    "model_comparison",
    sql=with_features(
        " UNION ALL ".join(
            errors_sql(f"valid WHERE {c} IS NOT NULL", c, f"'{c}' AS model, ") for c in ("lag_24h", "lag_168h", "roll_24h", "roll_168h")
        ),
        VALID_SQL,
    ),
)
def model_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    candidates = {c: c for c in ("lag_24h", "lag_168h", "roll_24h", "roll_168h")}
    return rounded(scoring.model_comparison(_valid(spark, sf_dir), candidates), ["mae", "rmse"])


@query(
    "row_errors",
    sql=with_features(
        """SELECT hour_start, pu_location, CAST(abs(trip_count - lag_24h) AS DOUBLE) AS abs_err,
       CAST((trip_count - lag_24h) * (trip_count - lag_24h) AS DOUBLE) AS sq_err
FROM valid WHERE lag_24h IS NOT NULL""",
        VALID_SQL,
    ),
)
def row_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    y, p = F.col("trip_count"), F.col("yhat")
    return baseline_lag(_valid(spark, sf_dir)).select(
        "hour_start",
        "pu_location",
        scoring.abs_error(y, p).alias("abs_err"),
        scoring.sq_error(y, p).alias("sq_err"),
    )


@query(
    "worst_zones",
    sql=with_features(
        """SELECT pu_location, round(avg(abs(trip_count - lag_24h)), 6) AS abs_err
FROM valid WHERE lag_24h IS NOT NULL GROUP BY 1 ORDER BY avg(abs(trip_count - lag_24h)) DESC, pu_location LIMIT 20""",
        VALID_SQL,
    ),
)
def worst_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(scoring.worst_zones(baseline_lag(_valid(spark, sf_dir))), ["abs_err"])


JOINED_OUT = "p.run_ts, p.model_name, p.hour_start, p.pu_location, round(p.yhat, 6) AS yhat, t.trip_count"


def _joined(joined: DataFrame) -> DataFrame:
    return rounded(
        _shown(joined.select("run_ts", "model_name", "hour_start", "pu_location", "yhat", "trip_count")), ["yhat"]
    )


@query(
    "prediction_truth_join",
    sql=with_features(f"SELECT {JOINED_OUT} FROM predictions p JOIN mart t USING (hour_start, pu_location)", PREDICTIONS_SQL),
)
def prediction_truth_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart, _, stored = _mart_and_predictions(spark, sf_dir)
    return _joined(scoring.join_truth(stored, mart))


@query(
    "prediction_truth_zero_filled",
    sql=with_features(f"SELECT {JOINED_OUT} FROM predictions p JOIN filled t USING (hour_start, pu_location)", PREDICTIONS_SQL),
)
def prediction_truth_zero_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, filled, stored = _mart_and_predictions(spark, sf_dir)
    return _joined(scoring.join_truth(stored, filled))


STRAY_SQL = """,
strays AS (
  SELECT ingest_month, hour_start, pu_location, trip_count FROM mart
  UNION ALL
  SELECT CAST(ingest_month + INTERVAL 1 MONTH AS DATE), hour_start, pu_location, trip_count FROM mart
)"""


def _with_strays(mart: DataFrame) -> DataFrame:
    """Every zone-hour a second time, from the next month's file."""
    return mart.unionByName(mart.withColumn("ingest_month", F.add_months("ingest_month", 1)))


@query(
    "prediction_truth_fan_out",
    sql=with_features(
        f"SELECT {JOINED_OUT} FROM predictions p JOIN strays t USING (hour_start, pu_location)", PREDICTIONS_SQL + STRAY_SQL
    ),
)
def prediction_truth_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart, _, stored = _mart_and_predictions(spark, sf_dir)
    return _joined(scoring.join_truth(stored, _with_strays(mart)))


@query(
    "prediction_truth_collapsed",
    sql=with_features(
        f"""SELECT {JOINED_OUT} FROM predictions p JOIN (
  SELECT hour_start, pu_location, CAST(sum(trip_count) AS INTEGER) AS trip_count FROM strays GROUP BY 1, 2
) t USING (hour_start, pu_location)""",
        PREDICTIONS_SQL + STRAY_SQL,
    ),
)
def prediction_truth_collapsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart, _, stored = _mart_and_predictions(spark, sf_dir)
    return _joined(scoring.join_truth(stored, _with_strays(mart), collapse_truth=True))


@query(
    "latest_run",
    sql=with_features(
        """SELECT 'any' AS scope, max(run_ts) AS run_ts FROM predictions
UNION ALL SELECT 'lag_24h', max(run_ts) FROM predictions WHERE model_name = 'lag_24h'""",
        PREDICTIONS_SQL,
    ),
)
def latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, stored = _mart_and_predictions(spark, sf_dir)
    newest = scoring.latest_run(stored).select(F.lit("any").alias("scope"), "run_ts")
    of_lag = scoring.latest_run(stored, "lag_24h").select(F.lit("lag_24h").alias("scope"), "run_ts")
    return _shown(newest.unionByName(of_lag))


@query(
    "run_rows",
    sql=with_features(
        f"""SELECT run_ts, model_name, hour_start, pu_location, round(yhat, 6) AS yhat FROM predictions
WHERE run_ts = TIMESTAMP '{RUNS["lag_24h"]}' AND model_name = 'lag_24h'""",
        PREDICTIONS_SQL,
    ),
)
def run_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, stored = _mart_and_predictions(spark, sf_dir)
    rows = scoring.of_run(stored, RUNS["lag_24h"], "lag_24h")
    return rounded(_shown(rows.select("run_ts", "model_name", "hour_start", "pu_location", "yhat")), ["yhat"])


@query(
    "run_metrics",
    sql=with_features(
        errors_sql(
            "predictions JOIN mart USING (hour_start, pu_location) GROUP BY 1, 2, 3, 4",
            "yhat",
            f"run_ts, model_name, TIMESTAMP '{SPLIT}' AS train_end, {HORIZON} AS horizon_hours, ",
        ),
        PREDICTIONS_SQL,
    ),
)
def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart, _, stored = _mart_and_predictions(spark, sf_dir)
    rows = evaluate.run_metrics(scoring.join_truth(stored, mart)).drop("created_at")
    return rounded(_shown(rows).withColumn("train_end", F.col("train_end").cast("timestamp_ntz")), ["mae", "rmse"])


LATEST_SQL = PREDICTIONS_SQL + """,
scored AS (
  SELECT p.pu_location, p.yhat, t.trip_count FROM predictions p JOIN mart t USING (hour_start, pu_location)
  WHERE p.run_ts = (SELECT max(run_ts) FROM predictions)
)"""


@query("evaluate_latest", sql=with_features(errors_sql("scored", "yhat"), LATEST_SQL))
def evaluate_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart, _, stored = _mart_and_predictions(spark, sf_dir)
    return rounded(evaluate.evaluate_latest(inputs.cut_lineage(stored), mart).metrics, ["mae", "rmse"])


@query(
    "evaluate_latest_worst_zones",
    sql=with_features(
        """SELECT pu_location, round(avg(abs(trip_count - yhat)), 6) AS abs_err FROM scored
GROUP BY 1 ORDER BY avg(abs(trip_count - yhat)) DESC, pu_location LIMIT 20""",
        LATEST_SQL,
    ),
)
def evaluate_latest_worst_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart, _, stored = _mart_and_predictions(spark, sf_dir)
    return rounded(evaluate.evaluate_latest(inputs.cut_lineage(stored), mart).worst_zones, ["abs_err"])


BUSIEST_SQL = "(SELECT pu_location FROM features GROUP BY 1 ORDER BY sum(trip_count) DESC, pu_location LIMIT 1)"


@query(
    "zone_first_rows",
    sql=with_features(
        """SELECT pu_location, hour_start, trip_count, lag_24h, round(roll_24h, 6) AS roll_24h
FROM valid WHERE pu_location = 1 ORDER BY hour_start LIMIT 200""",
        VALID_SQL,
    ),
)
def zone_first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rows of a zone given by number."""
    series = scoring.zone_series(_valid(spark, sf_dir), 1, ["trip_count", "lag_24h", "roll_24h"], 200)
    return rounded(series, ["roll_24h"])


@query(
    "zone_series",
    sql=with_features(
        f"""SELECT pu_location, hour_start, trip_count, lag_24h, round(roll_24h, 6) AS roll_24h
FROM valid WHERE pu_location = {BUSIEST_SQL} ORDER BY hour_start LIMIT 240""",
        VALID_SQL,
    ),
)
def zone_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The busiest zone's observed and baseline values after the split."""
    rows = inputs.features(spark, sf_dir)
    busiest = explore.busiest_zones(rows, 1)
    series = scoring.zone_series(scoring.from_hour(rows, SPLIT), busiest, ["trip_count", "lag_24h", "roll_24h"], 240)
    return rounded(series, ["roll_24h"])


@query(
    "zone_series_of_run",
    sql=with_features(
        f"""SELECT p.pu_location, p.hour_start, t.trip_count, round(p.yhat, 6) AS yhat
FROM predictions p JOIN filled t USING (hour_start, pu_location)
WHERE p.model_name = 'roll_24h' AND p.pu_location = {BUSIEST_SQL} ORDER BY p.hour_start LIMIT 240""",
        PREDICTIONS_SQL,
    ),
)
def zone_series_of_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observed and predicted values of the busiest zone in one stored run."""
    _, filled, stored = _mart_and_predictions(spark, sf_dir)
    run = scoring.of_run(stored, RUNS["roll_24h"], "roll_24h")
    busiest = explore.busiest_zones(inputs.features(spark, sf_dir), 1)
    series = scoring.zone_series(scoring.join_truth(run, filled), busiest, ["trip_count", "yhat"], 240)
    return rounded(series, ["yhat"])
