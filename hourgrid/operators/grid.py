"""The complete zone × hour grid, with explicit zeros."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourgrid.functions import clock
from hourgrid.functions.measures import zero_fill
from hourgrid.schemas import DEMAND_KEY, TARGET
from hourgrid.session import shuffle_partitions


def zone_hour_grid(
    zones: DataFrame,
    first_month: Column | str | dt.date,
    last_month: Column | str | dt.date | None = None,
    end: Column | str | dt.datetime | None = None,
) -> DataFrame:
    """Every hour of every month from ``first_month`` to ``last_month`` per zone.

    Generated per zone with ``sequence``, so there is no join. The few zone-month
    rows are spread over all shuffle partitions *before* the hours are generated;
    an adaptive plan would otherwise merge them and generate everything in one
    task. Windows by (month, zone) reuse this partitioning.

    ``end`` is an inclusive last hour that cuts the final month short.
    """
    last_month = first_month if last_month is None else last_month
    months = F.sequence(
        F.trunc(clock.as_date(first_month), "MM"),
        F.trunc(clock.as_date(last_month), "MM"),
        F.expr("interval 1 month"),
    )
    grid = (
        zones.select("pu_location", F.explode(months).alias("ingest_month"))
        .repartition(shuffle_partitions(zones.sparkSession), "ingest_month", "pu_location")
        .select(
            "ingest_month",
            F.explode(clock.month_hours(F.col("ingest_month"))).alias("hour_start"),
            "pu_location",
        )
    )
    return grid if end is None else grid.where(F.col("hour_start") <= clock.ntz(end))


def fill_gaps(grid: DataFrame, mart: DataFrame) -> DataFrame:
    """Observed counts on the grid, zero where nothing was observed.

    Joined in series order (month, zone, hour): when the mart is too large to
    broadcast, the sort of the join is also the sort of the windows after it.
    """
    keys = ["ingest_month", "pu_location", "hour_start"]
    return grid.join(mart.select(*keys, TARGET), keys, "left").select(
        *DEMAND_KEY, zero_fill(F.col(TARGET)).cast("int").alias(TARGET)
    )


def filled_demand(
    mart: DataFrame,
    first_month: Column | str | dt.date,
    last_month: Column | str | dt.date | None = None,
    zones: DataFrame | None = None,
    end: Column | str | dt.datetime | None = None,
) -> DataFrame:
    """Grid over ``zones`` (default: every zone seen in any month), gap-filled."""
    zones = mart.select("pu_location").distinct() if zones is None else zones
    return fill_gaps(zone_hour_grid(zones, first_month, last_month, end), mart)
