"""The demand mart, the hour grid and the gap-filled grid."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.functions.clock import add_hours, month_floor, ntz
from hourgrid.operators import demand, grid
from hourgrid.queries import inputs
from hourgrid.queries.inputs import (
    FILLED_SQL,
    MART_SQL,
    CLEAN_SQL,
    TWO_MONTHS_SQL,
    rounded,
    show_month,
    table,
    with_filled,
    with_mart,
)
from hourgrid.queries.registry import query
from hourgrid.sources.scans import hour_grid

AVERAGES = ["avg_trip_minutes", "avg_trip_distance", "avg_total_amount"]
# The averaged amounts have at most four decimals, so that means over a few trips
# often end in an exact 5 at the seventh; nine digits stay clear of such ties.
DIGITS = 9

MART_OUT = """SELECT CAST(ingest_month AS VARCHAR) AS ingest_month, hour_start, pu_location, trip_count,
       round(avg_trip_minutes, 9) AS avg_trip_minutes, round(avg_trip_distance, 9) AS avg_trip_distance,
       round(avg_total_amount, 9) AS avg_total_amount
FROM mart"""


@query("zone_hour_demand", sql=with_mart(MART_OUT))
def zone_hour_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(show_month(inputs.mart(spark, sf_dir)), AVERAGES, DIGITS)


@query(
    "zone_hour_demand_month",
    sql=f"WITH {TWO_MONTHS_SQL},{CLEAN_SQL},{MART_SQL}\n{MART_OUT} WHERE ingest_month = DATE '2024-02-01'",
)
def zone_hour_demand_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One of two months, chosen by the month filter."""
    both = inputs.two_months(inputs.clean(spark, sf_dir))
    return rounded(show_month(demand.zone_hour_demand(both, "2024-02-01")), AVERAGES, DIGITS)


@query(
    "rows_per_month",
    sql="""
SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS ingest_month, count(*) AS n_rows
FROM orders GROUP BY 1
""",
)
def rows_per_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(month_floor(F.col("o_orderdate")).alias("ingest_month"))
    return show_month(demand.rows_per_month(orders))


@query("mart_rows_per_month", sql=with_mart("SELECT CAST(ingest_month AS VARCHAR) AS ingest_month, count(*) AS n_rows FROM mart GROUP BY 1"))
def mart_rows_per_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return show_month(demand.rows_per_month(inputs.mart(spark, sf_dir)))


@query("hour_bounds", sql=with_mart("SELECT min(hour_start) AS min_hour, max(hour_start) AS max_hour FROM mart"))
def hour_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return demand.hour_bounds(inputs.mart(spark, sf_dir))


@query("distinct_zones", sql=with_mart("SELECT DISTINCT pu_location FROM mart"))
def distinct_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return demand.distinct_zones(inputs.mart(spark, sf_dir))


@query(
    "top_zone_hours",
    sql=with_mart(
        """SELECT CAST(ingest_month AS VARCHAR) AS ingest_month, hour_start, pu_location, trip_count
FROM mart ORDER BY trip_count DESC, hour_start, pu_location, ingest_month LIMIT 20"""
    ),
)
def top_zone_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return show_month(demand.top_zone_hours(inputs.mart(spark, sf_dir)))


@query(
    "hour_grid",
    sql="""
SELECT unnest(generate_series(date_trunc('month', min(ts))::TIMESTAMP,
  date_trunc('month', max(ts))::TIMESTAMP + INTERVAL 1 MONTH - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS hour_start
FROM events
""",
)
def all_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounds = table(spark, sf_dir, "events").agg(F.min("ts").alias("first"), F.max("ts").alias("last"))
    end = add_hours(ntz(F.add_months(month_floor(F.col("last")), 1)), -1)
    return hour_grid(bounds, month_floor(F.col("first")), end)


@query(
    "zone_hour_grid",
    sql=with_filled("SELECT CAST(ingest_month AS VARCHAR) AS ingest_month, hour_start, pu_location FROM grid"),
)
def zone_hour_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = inputs.stored_mart(spark, sf_dir)
    return show_month(grid.zone_hour_grid(demand.distinct_zones(mart), *inputs.month_bounds(mart)))


@query(
    "zone_hour_grid_short",
    sql=with_filled(
        """SELECT CAST(ingest_month AS VARCHAR) AS ingest_month, hour_start, pu_location FROM grid
WHERE hour_start <= TIMESTAMP '2024-01-31 00:00:00'"""
    ),
)
def zone_hour_grid_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grid that stops at the first hour of the month's last day."""
    mart = inputs.stored_mart(spark, sf_dir)
    zones = demand.distinct_zones(mart)
    return show_month(grid.zone_hour_grid(zones, *inputs.month_bounds(mart), end="2024-01-31 00:00:00"))


FILLED_OUT = "SELECT CAST(ingest_month AS VARCHAR) AS ingest_month, hour_start, pu_location, trip_count FROM filled"


@query("zone_hour_filled", sql=with_filled(FILLED_OUT))
def zone_hour_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return show_month(inputs.filled(spark, sf_dir))


@query(
    "zone_hour_filled_two_months",
    sql=f"WITH {TWO_MONTHS_SQL},{CLEAN_SQL},{MART_SQL},{FILLED_SQL}\n{FILLED_OUT}",
)
def zone_hour_filled_two_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = inputs.two_months(inputs.clean(spark, sf_dir))
    return show_month(inputs.filled_from(inputs.cut_lineage(demand.zone_hour_demand(both))))
