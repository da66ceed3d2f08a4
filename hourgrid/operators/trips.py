"""Trip rows: typing, cleaning, one row per natural key, trip-level features."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourgrid import schemas
from hourgrid.functions import clock, guards


def month_filter(df: DataFrame, month: dt.date | str) -> DataFrame:
    """Compares the DATE partition column itself, so partitions are pruned."""
    return df.where(F.col("ingest_month") == clock.as_date(month))


def type_trips(raw: DataFrame) -> DataFrame:
    """Raw columns, typed or text, to the fixed trip columns."""

    def typed(guard, source: str, name: str) -> Column:
        return guard(F.col(source), raw.schema[source].dataType).alias(name)

    return raw.select(
        F.col("ingest_month").cast("date").alias("ingest_month"),
        typed(guards.safe_timestamp, "tpep_pickup_datetime", "pickup_ts"),
        typed(guards.safe_timestamp, "tpep_dropoff_datetime", "dropoff_ts"),
        typed(guards.safe_uint, "pulocationid", "pu_location"),
        typed(guards.safe_uint, "dolocationid", "do_location"),
        typed(guards.safe_udouble, "trip_distance", "trip_distance"),
        typed(guards.safe_double, "fare_amount", "fare_amount"),
        typed(guards.safe_double, "total_amount", "total_amount"),
    )


def keep_clean(trips: DataFrame) -> DataFrame:
    """Complete keys, positive distance and total; the fare may be anything."""
    return trips.where(
        F.col("pickup_ts").isNotNull()
        & F.col("dropoff_ts").isNotNull()
        & F.col("pu_location").isNotNull()
        & F.col("do_location").isNotNull()
        & (F.col("trip_distance") > 0)
        & (F.col("total_amount") > 0)
    )


def first_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """One whole row per key: the smallest by the remaining columns, NULLs first.

    An aggregate rather than a ranking window: each map task reduces its own
    copies before the shuffle, so a key with a third of all rows sends one row
    per map task instead of filling one reduce task.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    first = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_first"))
    return first.select(*[F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns])


def clean_trips(raw: DataFrame, month: dt.date | str | None = None) -> DataFrame:
    """Raw month to typed, cleaned, key-unique trips."""
    source = raw if month is None else month_filter(raw, month)
    return first_per_key(keep_clean(type_trips(source)), schemas.TRIP_KEY)


# Sanity caps of the mart and feature layers.
MAX_TRIP_MINUTES = 360
MAX_TRIP_SECONDS = 6 * 3600
MAX_DISTANCE = 100
MAX_TOTAL = 500
MAX_SPEED = 80


def within_caps() -> Column:
    """Distance and total caps, on stored columns: pushed down to the scan."""
    return (
        (F.col("trip_distance") > 0)
        & (F.col("trip_distance") <= MAX_DISTANCE)
        & (F.col("total_amount") > 0)
        & (F.col("total_amount") <= MAX_TOTAL)
    )


def trip_features(trips: DataFrame, month: dt.date | str | None = None) -> DataFrame:
    """Duration, speed and calendar columns of every trip within the caps."""
    source = trips if month is None else month_filter(trips, month)
    seconds = F.col("trip_seconds")
    pickup = F.col("pickup_ts")
    return (
        source.where(within_caps())
        # Whole seconds round half away from zero: 1 … MAX as an interval test.
        .where(
            clock.lasts_between(
                pickup, F.col("dropoff_ts"), above=0.499999, at_most=MAX_TRIP_SECONDS + 0.499999
            )
        )
        .withColumn("trip_seconds", clock.duration_seconds(pickup, F.col("dropoff_ts")))
        .withColumn("speed_mph", clock.speed_mph(F.col("trip_distance"), seconds))
        .where(F.col("speed_mph").isNull() | (F.col("speed_mph") <= MAX_SPEED))
        .select(
            *schemas.TRIP_KEY,
            "trip_distance",
            "total_amount",
            "trip_seconds",
            (seconds / 60.0).alias("trip_minutes"),
            "speed_mph",
            clock.hour_of_day(pickup).alias("pickup_hour"),
            clock.day_of_week(pickup).alias("pickup_dow"),
            clock.is_weekend(pickup).alias("is_weekend"),
        )
    )
