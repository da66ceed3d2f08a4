"""Lag, rolling-mean and calendar columns on the filled grid.

Row offsets equal hour offsets only because the grid has no holes. All windows
share one partitioning and one sort. A partition is one zone-month, at most 744
rows. With ``across_months`` the last hours of a month also go, to be looked back on only, to the
zone's next month: at most ``LOOK_BACK`` rows more, so a zone's years are spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType
from pyspark.sql.window import WindowSpec

from hourgrid.functions import clock
from hourgrid.schemas import DEMAND_KEY, TARGET

# Offsets and window lengths, in hours.
LAG_HOURS = (1, 24, 168)
ROLL_HOURS = (6, 24, 168)


# Rows of an earlier month that a row can look back on: the longest lag or window.
LOOK_BACK = max(*LAG_HOURS, *ROLL_HOURS)
SEGMENT = "_segment"


def series_window(segmented: bool = False) -> WindowSpec:
    return Window.partitionBy(SEGMENT if segmented else "ingest_month", "pu_location").orderBy("hour_start")


def with_look_back(df: DataFrame, hours: int = LOOK_BACK) -> DataFrame:
    """``df`` with the month that each row serves in ``_segment``: its own, and the next one's look-back too.

    Only rows of a month's last ``hours`` are there twice; no shuffle.
    """
    own = F.col("ingest_month")
    following = F.add_months(own, 1)
    late = F.col("hour_start") >= clock.add_hours(following.cast("timestamp_ntz"), -hours)
    served = F.when(late, F.array(own, following)).otherwise(F.array(own))
    return df.select("*", F.explode(served).alias(SEGMENT))


def own_rows(df: DataFrame) -> DataFrame:
    """Only the rows of each segment's own month."""
    return df.where(F.col(SEGMENT) == F.col("ingest_month")).drop(SEGMENT)


def lags(
    df: DataFrame,
    hours: Sequence[int] = LAG_HOURS,
    value: str = TARGET,
    across_months: bool = False,
) -> DataFrame:
    """Value ``n`` rows back in the series; NULL before its start."""
    if across_months:
        return own_rows(_lags(with_look_back(df, max(hours)), hours, value, series_window(True)))
    return _lags(df, hours, value, series_window())


def _lags(df: DataFrame, hours: Sequence[int], value: str, w: WindowSpec) -> DataFrame:
    return df.withColumns({f"lag_{n}h": F.lag(value, n).over(w) for n in hours})


def rolling_means(
    df: DataFrame,
    hours: Sequence[int] = ROLL_HOURS,
    value: str = TARGET,
    include_current: bool = True,
    across_months: bool = False,
) -> DataFrame:
    """Mean of the last ``n`` values, with or without the current row.

    Shorter at the start of a series; without the current row the first mean is
    NULL. Whole-number columns use differences of a running sum (exact, constant
    work per row however long the window); others use a sliding frame.
    """
    if across_months:
        return own_rows(_rolling_means(with_look_back(df, max(hours)), hours, value, include_current, series_window(True)))
    return _rolling_means(df, hours, value, include_current, series_window())


def _rolling_means(df: DataFrame, hours: Sequence[int], value: str, include_current: bool, w: WindowSpec) -> DataFrame:
    if not isinstance(df.schema[value].dataType, IntegralType):
        frame = (lambda n: w.rowsBetween(1 - n, 0)) if include_current else (lambda n: w.rowsBetween(-n, -1))
        return df.withColumns({f"roll_{n}h": F.avg(value).over(frame(n)) for n in hours})

    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    newest = 0 if include_current else 1

    def between(total: str, n: int) -> Column:
        upper = F.lag(total, newest, 0).over(w) if newest else F.col(total)
        return upper - F.lag(total, n + newest, 0).over(w)

    summed = df.withColumns(
        {"_sum": F.sum(value).over(running), "_n": F.count(value).over(running)}
    ).withColumn("_sum", F.coalesce("_sum", F.lit(0)))
    means = {f"roll_{n}h": F.try_divide(between("_sum", n), between("_n", n)) for n in hours}
    return summed.withColumns(means).drop("_sum", "_n")


def calendar(df: DataFrame, ts: str = "hour_start", monday_first: bool = False) -> DataFrame:
    column = F.col(ts)
    return df.withColumns(
        {
            "pickup_hour": clock.hour_of_day(column),
            "pickup_dow": clock.day_of_week(column, monday_first),
            "is_weekend": clock.is_weekend(column),
        }
    )


def demand_features(
    filled: DataFrame, include_current: bool = True, across_months: bool = False
) -> DataFrame:
    """All feature columns of the filled grid.

    ``include_current=True`` gives the stored feature table; models that are later
    served recursively train with ``False``, as serving sees only earlier hours.
    """
    rows, w = (with_look_back(filled) if across_months else filled), series_window(across_months)
    with_means = _rolling_means(_lags(rows, LAG_HOURS, TARGET, w), ROLL_HOURS, TARGET, include_current, w)
    return calendar(own_rows(with_means) if across_months else with_means).select(
        *DEMAND_KEY,
        TARGET,
        *[f"lag_{n}h" for n in LAG_HOURS],
        *[f"roll_{n}h" for n in ROLL_HOURS],
        "pickup_hour",
        "pickup_dow",
        "is_weekend",
    )
