"""Load state per (dataset, year, month): an append-only log, newest entry wins.

Appending keeps each change a small independent write; nothing is rewritten.
"""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid import schemas
from hourgrid.functions.measures import truncate_text
from hourgrid.operators.keyed import latest_per_key
from hourgrid.session import cut_lineage, delete_folder, release
from hourgrid.tables.store import align, create_table

LOG_COLUMNS = schemas.INGESTION_STATE + ", logged_ns bigint"
# Status names and the longest error text kept.
RUNNING, SUCCESS, FAILED = "running", "success", "failed"
ERROR_LENGTH = 2000


def ensure_state(spark: SparkSession, table: str) -> None:
    create_table(spark, table, LOG_COLUMNS)


def latest_state(log: DataFrame) -> DataFrame:
    """The current row per (dataset, year, month)."""
    return latest_per_key(log, schemas.STATE_KEY, "logged_ns").select(*schemas.columns(schemas.INGESTION_STATE))


def _is(dataset: str, year: int, month: int) -> Column:
    return (F.col("dataset") == dataset) & (F.col("year") == year) & (F.col("month") == month)


def _append(df: DataFrame, table: str) -> None:
    stamped = df.withColumn("logged_ns", F.lit(time.time_ns()))
    align(stamped.coalesce(1), table).write.mode("append").insertInto(table)


def mark_running(
    spark: SparkSession, table: str, dataset: str, year: int, month: int, file_path: str, file_sha256: str
) -> None:
    """Start a load: results of an earlier load of the month are cleared."""
    row = spark.range(1).select(
        F.lit(dataset).alias("dataset"),
        F.lit(year).alias("year"),
        F.lit(month).alias("month"),
        F.lit(file_path).alias("file_path"),
        F.lit(file_sha256).alias("file_sha256"),
        F.lit(RUNNING).alias("status"),
        F.current_timestamp().alias("started_at"),
    )
    _append(row, table)


def mark_all_running(spark: SparkSession, table: str, dataset: str, files: dict[dt.date, tuple[str, str]]) -> None:
    """``mark_running`` for several months (path and SHA-256 each) by one append."""
    rows = [(dataset, m.year, m.month, path, sha, RUNNING) for m, (path, sha) in files.items()]
    listed = spark.createDataFrame(rows, "dataset string, year int, month int, file_path string, file_sha256 string, status string")
    _append(listed.withColumn("started_at", F.current_timestamp()), table)


def mark_all_finished(
    spark: SparkSession, table: str, dataset: str, counts: dict[dt.date, int], errors: dict[dt.date, str]
) -> None:
    """Success with a row count, or failure with its error, for several months by one append."""
    ended = [(m.year, m.month, SUCCESS, n, None) for m, n in counts.items()]
    ended += [(m.year, m.month, FAILED, None, text) for m, text in errors.items()]
    listed = spark.createDataFrame(ended, "year int, month int, _status string, _count bigint, _error string")
    own = latest_state(spark.table(table).where(F.col("dataset") == dataset))
    changes = {
        "status": F.col("_status"),
        "row_count": F.col("_count"),
        "error_message": truncate_text(F.col("_error"), ERROR_LENGTH),
        "finished_at": F.current_timestamp(),
    }
    changed = own.join(F.broadcast(listed), ["year", "month"]).withColumns(changes)  # one row per month of a range
    _append(changed.drop("_status", "_count", "_error"), table)


def compact_log(spark: SparkSession, table: str) -> int:
    """Rewrite the log's files to one with the newest entry per key; the number of entries.

    The newest entries are appended once more, then the files from before are deleted: an entry that is there twice
    counts once, so a reader finds a whole log at every moment, and entries appended meanwhile stay.
    """
    log = spark.table(table)
    files = log.inputFiles()
    kept = cut_lineage(latest_per_key(log, schemas.STATE_KEY, "logged_ns"))
    align(kept.coalesce(1), table).write.mode("append").insertInto(table)
    for path in files:
        delete_folder(spark, path)
    spark.catalog.refreshTable(table)
    count = kept.count()
    release(kept)
    return count


def update_by_key(
    spark: SparkSession, table: str, dataset: str, year: int, month: int, changes: dict[str, Column]
) -> None:
    """Change columns of one current row; no row, no change."""
    log = spark.table(table).where(_is(dataset, year, month))
    _append(latest_state(log).withColumns(changes), table)


def mark_success(spark: SparkSession, table: str, dataset: str, year: int, month: int, row_count: int) -> None:
    update_by_key(
        spark, table, dataset, year, month,
        {"status": F.lit(SUCCESS), "row_count": F.lit(row_count), "finished_at": F.current_timestamp()},
    )


def mark_failed(spark: SparkSession, table: str, dataset: str, year: int, month: int, error: str) -> None:
    update_by_key(
        spark, table, dataset, year, month,
        {
            "status": F.lit(FAILED),
            "error_message": truncate_text(F.lit(error), ERROR_LENGTH),
            "finished_at": F.current_timestamp(),
        },
    )


def already_loaded(state: DataFrame, dataset: str, year: int, month: int, file_sha256: str) -> bool:
    """Runs one small job: was this very file loaded successfully last?"""
    done = state.where(_is(dataset, year, month)).where(
        (F.col("status") == SUCCESS) & (F.col("file_sha256") == file_sha256)
    )
    return not done.isEmpty()


def pending_files(fingerprints: DataFrame, state: DataFrame) -> DataFrame:
    """Fingerprinted months (dataset, year, month, file_sha256) still to be loaded."""
    done = state.where(F.col("status") == SUCCESS).select(*schemas.STATE_KEY, "file_sha256")
    return fingerprints.join(done, [*schemas.STATE_KEY, "file_sha256"], "left_anti")
