"""Build one month of a layer from the layer below, replacing that month."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid import schemas
from hourgrid.operators.demand import zone_hour_demand
from hourgrid.operators.grid import filled_demand
from hourgrid.operators.series import demand_features
from hourgrid.operators.trips import clean_trips, first_per_key, trip_features
from hourgrid.tables.store import analyze, create_table, replace_partition


# What the series of one zone is looked up by.
ZONE_HOURS = ("pu_location", "hour_start")


def _replace(spark: SparkSession, df, table: str, ddl: str, month: dt.date, cluster_by: tuple[str, ...] = ()) -> int:
    create_table(spark, table, ddl, partition_by=["ingest_month"])
    count = replace_partition(df, table, month, cluster_by=cluster_by)
    analyze(spark, table, month)
    return count


def build_trips(
    spark: SparkSession, month: dt.date, raw_table: str = "raw.trips", table: str = "processed.trips"
) -> int:
    return _replace(spark, clean_trips(spark.table(raw_table), month), table, schemas.TRIPS, month)


def build_demand(
    spark: SparkSession, month: dt.date, trips_table: str = "processed.trips", table: str = "marts.demand_zone_hour"
) -> int:
    return _replace(spark, zone_hour_demand(spark.table(trips_table), month), table, schemas.DEMAND, month, ZONE_HOURS)


def build_trip_features(
    spark: SparkSession, month: dt.date, trips_table: str = "processed.trips", table: str = "features.trips"
) -> int:
    rows = first_per_key(trip_features(spark.table(trips_table), month), schemas.TRIP_KEY)
    return _replace(spark, rows, table, schemas.TRIP_FEATURES, month)


def build_demand_features(
    spark: SparkSession,
    month: dt.date,
    mart_table: str = "marts.demand_zone_hour",
    table: str = "features.demand_zone_hour",
    include_current: bool = True,
    across_months: bool = False,
) -> int:
    """Feature rows of the complete grid of ``month``, over every zone of the mart."""
    rows = month_features(spark.table(mart_table), month, include_current, across_months)
    return _replace(spark, rows, table, schemas.DEMAND_FEATURES, month, ZONE_HOURS)


def month_features(
    mart: DataFrame, month: dt.date, include_current: bool = True, across_months: bool = False
) -> DataFrame:
    """One month's features; with ``across_months`` its first hours look back into the month before.

    The longest look back is 168 hours, so one preceding month is enough.
    """
    if not across_months:
        return demand_features(filled_demand(mart, month), include_current)
    before = (month.replace(day=1) - dt.timedelta(days=1)).replace(day=1)
    filled = filled_demand(mart, before, month)
    rows = demand_features(filled, include_current, across_months=True)
    return rows.where(F.col("ingest_month") == F.lit(month.replace(day=1).isoformat()).cast("date"))
