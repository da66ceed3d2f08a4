"""Load monthly files into the raw table, once per file content."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from hourgrid.sources.trip_files import (
    FILE_NAME,
    file_fingerprints,
    lower_columns,
    month_fingerprints,
    month_path,
    month_paths,
    months_by_layout,
    require_columns,
    scan_month,
)
from hourgrid.tables import state
from hourgrid.tables.store import (
    align,
    analyze,
    analyze_months,
    create_like,
    empty_text_to_null,
    replace_partition,
    replace_partitions,
)

# Fixed value: the data set name in the load state.
DATASET = "yellow"


def load_month(
    spark: SparkSession,
    folder: str,
    year: int,
    month: int,
    raw_table: str = "raw.trips",
    state_table: str = "raw.ingestion_state",
    dataset: str = DATASET,
    schema_mode: str = "strict",
    pattern: str = FILE_NAME,
) -> int | None:
    """Row count loaded, or None when this very file is loaded already.

    A failure is recorded and raised again; the month's old rows stay.
    """
    state.ensure_state(spark, state_table)
    path = month_path(folder, year, month, pattern)
    sha256 = file_fingerprints(spark, path).first().file_sha256
    key = (dataset, year, month)
    if state.already_loaded(state.latest_state(spark.table(state_table)), *key, sha256):
        return None
    state.mark_running(spark, state_table, *key, path, sha256)
    try:
        rows = empty_text_to_null(scan_month(spark, folder, year, month, pattern))
        create_like(rows, raw_table)
        first_day = dt.date(year, month, 1)
        count = replace_partition(rows, raw_table, first_day, schema_mode)
        analyze(spark, raw_table, first_day)
    except Exception as error:
        state.mark_failed(spark, state_table, *key, str(error))
        raise
    state.mark_success(spark, state_table, *key, count)
    return count


def load_range(
    spark: SparkSession,
    folder: str,
    first: dt.date,
    last: dt.date,
    raw_table: str = "raw.trips",
    state_table: str = "raw.ingestion_state",
    dataset: str = DATASET,
    schema_mode: str = "strict",
    pattern: str = FILE_NAME,
) -> dict[dt.date, int | None]:
    """Load every month of the range that is not loaded yet; rows per month, None where the file is known.

    The number of jobs does not depend on the number of months: all files are fingerprinted in one, pending
    months are found by one anti join, written by one dynamic overwrite and counted on the way, and
    each change of state is one append. A month whose file lacks a required column, or has a column that the
    table does not take, is recorded as failed and the others are loaded; then its error is raised. A failure of the write
    itself is recorded for every month it was to replace.
    """
    state.ensure_state(spark, state_table)
    paths = month_paths(folder, first, last, pattern)
    known = state.latest_state(spark.table(state_table))
    waiting = state.pending_files(month_fingerprints(spark, paths, dataset), known)
    # One row per month of the range.
    pending = {dt.date(r["year"], r["month"], 1): r["file_sha256"] for r in waiting.collect()}
    result: dict[dt.date, int | None] = dict.fromkeys(paths)
    if not pending:
        return result
    state.mark_all_running(spark, state_table, dataset, {m: (paths[m], sha) for m, sha in pending.items()})
    errors: dict[dt.date, Exception] = {}
    good: list[dt.date] = []
    merged = None
    for members, df in months_by_layout(spark, {m: paths[m] for m in pending}):
        try:
            rows = require_columns(lower_columns(df))
            create_like(rows, raw_table)
            rows = align(rows, raw_table, schema_mode)
        except Exception as error:  # noqa: BLE001
            errors |= dict.fromkeys(members, error)
            continue
        good += members
        merged = rows if merged is None else merged.unionByName(rows, allowMissingColumns=True)
    good = [m for m in good if m not in errors]
    counts: dict[dt.date, int] = {}
    if good:
        try:
            own = merged.where(F.col("ingest_month").isin(*good))
            counts = replace_partitions(empty_text_to_null(own), raw_table, good, schema_mode)
            analyze_months(spark, raw_table, good)
        except Exception as error:  # noqa: BLE001
            errors |= dict.fromkeys(good, error)
            counts = {}
    state.mark_all_finished(spark, state_table, dataset, counts, {m: str(e) for m, e in errors.items()})
    if errors:
        raise errors[min(errors)]
    return result | counts
