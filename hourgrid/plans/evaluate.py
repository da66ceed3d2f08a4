"""Score stored runs against observed demand."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourgrid import schemas
from hourgrid.operators import scoring
from hourgrid.tables.store import create_table, upsert


@dataclass(frozen=True)
class Evaluation:
    joined: DataFrame
    metrics: DataFrame
    worst_zones: DataFrame


def evaluate_run(
    predictions: DataFrame,
    truth: DataFrame,
    run_ts: Column | str | dt.datetime,
    model_name: str | None = None,
    collapse_truth: bool = False,
    n_worst: int = 20,
) -> Evaluation:
    """Joined rows, overall errors and the worst zones of one run.

    ``truth`` is the observed mart, where hours without trips are absent and so
    not scored, or the filled grid, where they count as zero.
    """
    run = scoring.of_run(predictions, run_ts, model_name)
    joined = scoring.join_truth(run, truth, collapse_truth)
    scoring.require_rows(joined, f"no observed rows for run {run_ts}")
    return Evaluation(joined, scoring.mae_rmse(joined), scoring.worst_zones(joined, n_worst))


def evaluate_latest(
    predictions: DataFrame, truth: DataFrame, model_name: str | None = None, **options
) -> Evaluation:
    """The same for the newest run, of any model or of one."""
    newest = scoring.latest_run(predictions, model_name).select(F.unix_micros("run_ts")).first()[0]
    if newest is None:
        raise RuntimeError("no stored runs")
    return evaluate_run(predictions, truth, F.timestamp_micros(F.lit(newest)), model_name, **options)


def run_metrics(joined: DataFrame) -> DataFrame:
    """One row per stored run in ``joined`` rows, in the metrics table's layout."""
    keys = ["run_ts", "model_name", "train_end", "horizon_hours"]
    return scoring.mae_rmse(joined, by=keys).select(
        "run_ts",
        "train_end",
        F.coalesce("horizon_hours", F.lit(0)).alias("horizon_hours"),
        "rows_joined",
        "mae",
        "rmse",
        F.current_timestamp().alias("created_at"),
        "model_name",
    )


def write_run_metrics(metrics: DataFrame, table: str = "predictions.run_metrics") -> None:
    create_table(metrics.sparkSession, table, schemas.RUN_METRICS, partition_by=["model_name"])
    upsert(
        metrics,
        table,
        schemas.RUN_METRICS_KEY,
        update_cols=["train_end", "horizon_hours", "rows_joined", "mae", "rmse", "created_at"],
    )
