"""Zone-hour demand and the questions asked of it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourgrid.functions import clock
from hourgrid.operators.trips import MAX_TRIP_MINUTES, month_filter, within_caps


def zone_hour_demand(trips: DataFrame, month: dt.date | str | None = None) -> DataFrame:
    """Trips per (month, hour, zone) with mean minutes, distance and total.

    Counts and averages are combined on the map side, so a zone with a third
    of all trips still shuffles only one row per map task and hour. Hours are
    one-hour windows, which are plain integer arithmetic on zone-less times.
    """
    source = trips if month is None else month_filter(trips, month)
    minutes = clock.duration_minutes(F.col("pickup_ts"), F.col("dropoff_ts"))
    return (
        source.where(
            F.col("pickup_ts").isNotNull() & F.col("pu_location").isNotNull() & within_caps()
        )
        .where(clock.lasts_between(F.col("pickup_ts"), F.col("dropoff_ts"), above=0, at_most=60 * MAX_TRIP_MINUTES))
        .withColumn("trip_minutes", minutes)
        .groupBy("ingest_month", F.window("pickup_ts", "1 hour")["start"].alias("hour_start"), "pu_location")
        .agg(
            F.count(F.lit(1)).cast("int").alias("trip_count"),
            F.avg("trip_minutes").alias("avg_trip_minutes"),
            F.avg("trip_distance").alias("avg_trip_distance"),
            F.avg("total_amount").alias("avg_total_amount"),
        )
    )


def rows_per_month(mart: DataFrame) -> DataFrame:
    return mart.groupBy("ingest_month").agg(F.count(F.lit(1)).alias("n_rows"))


def hour_bounds(mart: DataFrame) -> DataFrame:
    return mart.agg(F.min("hour_start").alias("min_hour"), F.max("hour_start").alias("max_hour"))


def distinct_zones(df: DataFrame) -> DataFrame:
    return df.select("pu_location").distinct()


def top_zone_hours(mart: DataFrame, n: int = 20) -> DataFrame:
    """Busiest zone-hours; ties by hour, then zone, then month."""
    return (
        mart.select("ingest_month", "hour_start", "pu_location", "trip_count")
        .orderBy(F.desc("trip_count"), "hour_start", "pu_location", "ingest_month")
        .limit(n)
    )
