"""Replay forecasts (features exist) and recursive forecasts (they do not yet)."""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Sequence
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid import schemas
from hourgrid.functions import clock
from hourgrid.functions.measures import clip
from hourgrid.models.boosting import PoissonBoosting, PoissonBoostingModel
from hourgrid.operators import scoring
from hourgrid.operators.series import LAG_HOURS, ROLL_HOURS
from hourgrid.schemas import BOOSTING_FEATURES, TARGET
from hourgrid.session import cut_lineage, path_exists
from hourgrid.tables.store import analyze_partitions, create_table, upsert

# Fixed value: hours of history a forecast starts from.
HISTORY_HOURS = 168
PREDICTION_PARTITIONS = ["model_name", "train_day"]
REPLAY_MODEL = "poisson_boosting_replay_v1"
RECURSIVE_MODEL = "poisson_boosting_recursive_v1"


class Model(Protocol):
    def transform(self, df: DataFrame) -> DataFrame: ...


def stored_model(
    rows: DataFrame, booster: PoissonBoosting, folder: str, features: Sequence[str] = BOOSTING_FEATURES
) -> PoissonBoostingModel:
    """The model of these training rows and settings: read from ``folder`` if it is there, else fitted and stored.

    Rows are told apart by a fingerprint of all of them, one aggregate. The folder has to be one
    that all executors share.
    """
    spark = rows.sparkSession
    own = F.xxhash64(*[F.col(c) for c in [*features, TARGET]])
    # The second sum keeps rows that cancel out in the first one apart.
    print_ = rows.agg(F.count(F.lit(1)), F.bit_xor(own), F.sum(F.pmod(own, F.lit(2_147_483_647)))).first()
    text = "|".join([booster.named(), *features, *map(str, print_)])
    path = f"{folder}/{hashlib.sha256(text.encode()).hexdigest()}"
    if path_exists(spark, f"{path}/settings/_SUCCESS"):
        return PoissonBoostingModel.load(spark, path)
    model = booster.fit(rows, features)
    model.save(spark, path)
    return model


def latest_train_end(features: DataFrame) -> dt.datetime:
    """The hour after the newest feature row. Runs one aggregate."""
    newest = features.agg(F.max("hour_start")).first()[0]
    if newest is None:
        raise RuntimeError("the feature table is empty")
    return newest + dt.timedelta(hours=1)


def history_buffers(
    features: DataFrame, train_end: dt.datetime | str, strict_hours: bool = False
) -> DataFrame:
    """(pu_location, buf): the last 168 counts before ``train_end`` per zone, oldest first.

    Zones are those with a row in that window. A short history is padded with
    zeros on the left; with ``strict_hours`` every value sits at its own hour
    and any missing hour is zero. A group holds at most the window's hours.
    """
    rows = scoring.within_history(features, train_end, HISTORY_HOURS)
    if strict_hours:
        end = clock.ntz(train_end)
        slots = clock.hours_between(clock.add_hours(end, -HISTORY_HOURS), clock.add_hours(end, -1))
        # Two ingest months may report the same hour.
        hourly = rows.groupBy("pu_location", "hour_start").agg(F.sum(F.col(TARGET).cast("double")).alias("v"))
        by_hour = hourly.groupBy("pu_location").agg(
            F.map_from_entries(F.collect_list(F.struct("hour_start", "v"))).alias("m")
        )
        filled = F.transform(slots, lambda h: F.coalesce(F.try_element_at(F.col("m"), h), F.lit(0.0)))
        return by_hour.select("pu_location", filled.alias("buf"))
    ordered = F.array_sort(F.collect_list(F.struct("hour_start", F.col(TARGET).cast("double").alias("v"))))
    series = rows.groupBy("pu_location").agg(F.transform(ordered, lambda r: r["v"]).alias("s"))
    padding = F.array_repeat(F.lit(0.0), F.lit(HISTORY_HOURS) - F.size("s"))
    padded = F.concat(padding, F.col("s"))
    return series.select("pu_location", F.slice(padded, -HISTORY_HOURS, HISTORY_HOURS).alias("buf"))


def features_from_buffer(state: DataFrame, ts: dt.datetime | str) -> DataFrame:
    """Feature columns for hour ``ts`` from the values strictly before it.

    One ``selectExpr`` per forecast hour keeps a 24-step plan quick to build.
    """
    hour = dt.datetime.fromisoformat(str(ts))
    sunday_first = hour.isoweekday() % 7
    return state.selectExpr(
        "*",
        *[f"element_at(buf, -{n}) AS lag_{n}h" for n in LAG_HOURS],
        *[f"aggregate(slice(buf, -{n}, {n}), 0D, (total, v) -> total + v) / {n}D AS roll_{n}h" for n in ROLL_HOURS],
        f"{hour.hour}S AS pickup_hour",
        f"{sunday_first}S AS pickup_dow",
        f"{str(sunday_first in (0, 6)).lower()} AS is_weekend",
    )


def recursive_forecast(
    features: DataFrame,
    model: Model,
    train_end: dt.datetime | str | None = None,
    horizon_hours: int = 24,
    clip_at_zero: bool = True,
    strict_hours: bool = False,
    steps_per_plan: int = 24,
) -> DataFrame:
    """(hour_start, pu_location, yhat) for the hours from ``train_end`` on.

    Every step only appends to each zone's own array, so a whole day of steps is
    a chain of projections over one partitioning: no shuffle and no write
    between hours. Longer horizons continue from the checkpoint folder after
    each ``steps_per_plan`` hours to keep plans small.
    """
    start = latest_train_end(features) if train_end is None else dt.datetime.fromisoformat(str(train_end))
    state = history_buffers(features, start, strict_hours)
    yhat = clip(F.col("yhat"), low=0.0) if clip_at_zero else F.col("yhat")
    longer = F.concat("buf", F.array(yhat)).alias("buf")
    for step in range(horizon_hours):
        if step and step % steps_per_plan == 0:
            state = cut_lineage(state)
        known = features_from_buffer(state, start + dt.timedelta(hours=step))
        state = model.transform(known).select("pu_location", longer)
    steps = state.select(
        "pu_location", F.posexplode(F.slice("buf", HISTORY_HOURS + 1, horizon_hours)).alias("step", "yhat")
    )
    return steps.select(
        clock.add_hours(clock.ntz(start), F.col("step")).alias("hour_start"), "pu_location", "yhat"
    )


def replay_forecast(
    features: DataFrame,
    train_end: dt.datetime | str,
    horizon_hours: int = 24,
    booster: PoissonBoosting = PoissonBoosting(),
    clip_at_zero: bool = False,
    models: str | None = None,
) -> DataFrame:
    """Train before ``train_end``, score the complete feature rows of the horizon.

    With ``models``, a shared folder, a model stored there for the same rows and settings is used again.
    """
    model = _model(features, train_end, booster, models)
    rows = scoring.drop_nulls(scoring.within_horizon(features, train_end, horizon_hours), BOOSTING_FEATURES)
    yhat = F.col("yhat")
    return model.transform(rows).select(
        "hour_start", "pu_location", (clip(yhat, low=0.0) if clip_at_zero else yhat).alias("yhat")
    )


def _model(features: DataFrame, train_end: dt.datetime | str, booster: PoissonBoosting, models: str | None) -> PoissonBoostingModel:
    rows = scoring.before(features, train_end)
    return stored_model(rows, booster, models) if models else booster.fit(rows)


def clock_day(train_end: dt.datetime | str) -> str:
    """The calendar day of ``train_end`` as given, a partition of the predictions table."""
    return dt.datetime.fromisoformat(str(train_end)).date().isoformat()


def as_predictions(
    forecast: DataFrame,
    run_ts: dt.datetime | Column,
    model_name: str | Column,
    train_end: dt.datetime,
    horizon_hours: int | None,
) -> DataFrame:
    """Forecast rows in the layout of the predictions table; one ``run_ts`` per run.

    Columns instead of values let one frame hold several runs.
    """
    return forecast.select(
        clock.instant(run_ts).alias("run_ts"),
        "hour_start",
        "pu_location",
        "yhat",
        clock.instant(train_end).alias("train_end"),
        F.lit(horizon_hours).cast("int").alias("horizon_hours"),
        F.lit(model_name).alias("model_name"),
        F.lit(clock_day(train_end)).cast("date").alias("train_day"),
    )


def write_predictions(predictions: DataFrame, table: str, keys: list[str], update_cols: list[str]) -> None:
    """Upsert one run's rows; only partitions of its model and training day are rewritten."""
    create_table(predictions.sparkSession, table, schemas.PREDICTIONS, partition_by=PREDICTION_PARTITIONS)
    upsert(predictions, table, keys, update_cols)
    analyze_partitions(predictions, table)


def already_forecast(
    predictions: DataFrame, model_name: str, train_end: dt.datetime, horizon_hours: int
) -> bool:
    """Runs one small job: is this forecast stored?"""
    stored = predictions.where(
        (F.col("model_name") == model_name)
        & (F.col("train_end") == clock.instant(train_end))
        & (F.col("horizon_hours") == horizon_hours)
    )
    return not stored.isEmpty()


def run_recursive(
    spark: SparkSession,
    features_table: str = "features.demand_zone_hour",
    predictions_table: str = "predictions.demand_zone_hour",
    train_end: dt.datetime | None = None,
    horizon_hours: int = 24,
    booster: PoissonBoosting = PoissonBoosting(),
    model_name: str = RECURSIVE_MODEL,
    models: str | None = None,
) -> dt.datetime | None:
    """Train, forecast and store; the run's timestamp, or None when already stored."""
    features = spark.table(features_table)
    train_end = train_end or latest_train_end(features)
    create_table(spark, predictions_table, schemas.PREDICTIONS, partition_by=PREDICTION_PARTITIONS)
    if already_forecast(spark.table(predictions_table), model_name, train_end, horizon_hours):
        return None
    run_ts = dt.datetime.now(dt.timezone.utc)
    model = _model(features, train_end, booster, models)
    scoring.require_rows(scoring.within_history(features, train_end), "no history before train_end")
    forecast = recursive_forecast(features, model, train_end, horizon_hours)
    write_predictions(
        as_predictions(forecast, run_ts, model_name, train_end, horizon_hours),
        predictions_table,
        keys=[*schemas.PREDICTION_IDENTITY_KEY, "train_day"],
        update_cols=["yhat", "run_ts"],
    )
    return run_ts


def run_replay(
    spark: SparkSession,
    train_end: dt.datetime,
    features_table: str = "features.demand_zone_hour",
    predictions_table: str = "predictions.demand_zone_hour",
    horizon_hours: int = 24,
    booster: PoissonBoosting = PoissonBoosting(),
    model_name: str = REPLAY_MODEL,
    models: str | None = None,
) -> dt.datetime:
    run_ts = dt.datetime.now(dt.timezone.utc)
    features = spark.table(features_table)
    scoring.require_rows(
        scoring.drop_nulls(scoring.within_horizon(features, train_end, horizon_hours), BOOSTING_FEATURES),
        "no complete feature rows in the forecast window",
    )
    forecast = replay_forecast(features, train_end, horizon_hours, booster, models=models)
    write_predictions(
        as_predictions(forecast, run_ts, model_name, train_end, None),
        predictions_table,
        keys=schemas.PREDICTION_RUN_KEY,
        update_cols=["yhat", "model_name", "train_end", "train_day"],
    )
    return run_ts
