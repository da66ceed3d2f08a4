"""The given tables seen as trips, demand, grid and features, in Spark and SQL.

``events`` plays the trip file: one event is one trip, its user the pickup zone,
its value the duration in minutes and the fare.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.functions.clock import month_floor
from hourgrid.operators.demand import zone_hour_demand
from hourgrid.operators.grid import filled_demand
from hourgrid.operators.series import demand_features
from hourgrid.operators.trips import first_per_key, keep_clean
from hourgrid.schemas import TRIP_KEY
from hourgrid.session import cut_lineage

SPLIT = "2024-01-25 00:00:00"
TRAIN_END = "2024-01-30 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    return table(spark, sf_dir, "events").select(
        month_floor(F.col("ts")).alias("ingest_month"),
        F.col("ts").alias("pickup_ts"),
        (F.col("ts") + F.make_dt_interval(secs=F.round(F.col("value") * 60).cast("decimal(18,6)"))).alias("dropoff_ts"),
        (F.col("user_id") % 50).cast("int").alias("pu_location"),
        k.cast("int").alias("do_location"),
        (F.col("value") * (F.lit(1.0) + k.cast("double") / 100.0)).alias("trip_distance"),
        F.col("value").alias("fare_amount"),
        (F.col("value") * 1.2).alias("total_amount"),
    )


def two_months(rows: DataFrame) -> DataFrame:
    """The trips, and the same trips one month later under the next ingest month."""
    later = rows.withColumns(
        {
            "ingest_month": F.add_months("ingest_month", 1),
            "pickup_ts": F.col("pickup_ts") + F.expr("interval 31 days"),
            "dropoff_ts": F.col("dropoff_ts") + F.expr("interval 31 days"),
        }
    )
    return rows.unionByName(later)


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_per_key(keep_clean(trips(spark, sf_dir)), TRIP_KEY)


def mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zone_hour_demand(clean(spark, sf_dir))


def stored_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The demand mart as its readers see it: built once, then read from files."""
    return cut_lineage(mart(spark, sf_dir))


def month_bounds(rows: DataFrame) -> tuple:
    return (
        rows.agg(F.min("ingest_month")).scalar(),
        rows.agg(F.max("ingest_month")).scalar(),
    )


def filled_from(demand: DataFrame) -> DataFrame:
    return filled_demand(demand, *month_bounds(demand))


def filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filled_from(stored_mart(spark, sf_dir))


def features(spark: SparkSession, sf_dir: str, include_current: bool = True) -> DataFrame:
    return demand_features(filled(spark, sf_dir), include_current)


def show_month(df: DataFrame) -> DataFrame:
    """Months as text, the same in every engine's result format."""
    return df.withColumn("ingest_month", F.col("ingest_month").cast("string"))


def rounded(df: DataFrame, names: Sequence[str], digits: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


# --- the same inputs in SQL ---------------------------------------------------

TRIPS_SQL = """
trips AS (
  SELECT CAST(date_trunc('month', ts) AS DATE) AS ingest_month,
         ts AS pickup_ts,
         ts + to_seconds(CAST(round(value * 60) AS BIGINT)) AS dropoff_ts,
         CAST(user_id % 50 AS INTEGER) AS pu_location,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS do_location,
         value * (1.0::DOUBLE + CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100.0::DOUBLE) AS trip_distance,
         value AS fare_amount,
         value * 1.2::DOUBLE AS total_amount
  FROM events
)"""

TWO_MONTHS_SQL = TRIPS_SQL.replace("trips AS", "one_month AS", 1) + """,
trips AS (
  SELECT * FROM one_month
  UNION ALL
  SELECT CAST(ingest_month + INTERVAL 1 MONTH AS DATE), pickup_ts + INTERVAL 31 DAY,
         dropoff_ts + INTERVAL 31 DAY, pu_location, do_location, trip_distance, fare_amount, total_amount
  FROM one_month
)"""

CLEAN_SQL = """
clean AS (
  SELECT ingest_month, pickup_ts, dropoff_ts, pu_location, do_location,
         trip_distance, fare_amount, total_amount
  FROM trips
  WHERE pickup_ts IS NOT NULL AND dropoff_ts IS NOT NULL AND pu_location IS NOT NULL
    AND do_location IS NOT NULL AND trip_distance > 0 AND total_amount > 0
  QUALIFY row_number() OVER (
    PARTITION BY ingest_month, pickup_ts, dropoff_ts, pu_location, do_location
    ORDER BY trip_distance NULLS FIRST, fare_amount NULLS FIRST, total_amount NULLS FIRST) = 1
)"""

MART_SQL = """
timed AS (
  SELECT *, (epoch_us(dropoff_ts) - epoch_us(pickup_ts)) / 60000000.0::DOUBLE AS trip_minutes
  FROM clean
),
mart AS (
  SELECT ingest_month, date_trunc('hour', pickup_ts) AS hour_start, pu_location,
         CAST(count(*) AS INTEGER) AS trip_count,
         avg(trip_minutes) AS avg_trip_minutes,
         avg(trip_distance) AS avg_trip_distance,
         avg(total_amount) AS avg_total_amount
  FROM timed
  WHERE trip_minutes > 0 AND trip_minutes <= 360
    AND trip_distance > 0 AND trip_distance <= 100
    AND total_amount > 0 AND total_amount <= 500
  GROUP BY 1, 2, 3
)"""

GRID_SQL = """
months AS (
  SELECT CAST(unnest(generate_series(
    (SELECT CAST(min(ingest_month) AS TIMESTAMP) FROM mart),
    (SELECT CAST(max(ingest_month) AS TIMESTAMP) FROM mart), INTERVAL 1 MONTH)) AS DATE) AS ingest_month
),
hours AS (
  SELECT ingest_month, unnest(generate_series(
    CAST(ingest_month AS TIMESTAMP),
    CAST(ingest_month AS TIMESTAMP) + INTERVAL 1 MONTH - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS hour_start
  FROM months
),
grid AS (
  SELECT h.ingest_month, h.hour_start, z.pu_location
  FROM hours h CROSS JOIN (SELECT DISTINCT pu_location FROM mart) z
)"""

FILLED_SQL = GRID_SQL + """,
filled AS (
  SELECT g.ingest_month, g.hour_start, g.pu_location,
         CAST(coalesce(m.trip_count, 0) AS INTEGER) AS trip_count
  FROM grid g LEFT JOIN mart m USING (ingest_month, hour_start, pu_location)
)"""


def features_sql(partition: str = "ingest_month, pu_location", include_current: bool = True) -> str:
    def frame(n: int) -> str:
        first, last = (f"{n - 1} PRECEDING", "CURRENT ROW") if include_current else (f"{n} PRECEDING", "1 PRECEDING")
        return f"(PARTITION BY {partition} ORDER BY hour_start ROWS BETWEEN {first} AND {last})"

    return f""",
features AS (
  SELECT ingest_month, hour_start, pu_location, trip_count,
         lag(trip_count, 1) OVER w AS lag_1h,
         lag(trip_count, 24) OVER w AS lag_24h,
         lag(trip_count, 168) OVER w AS lag_168h,
         avg(trip_count) OVER {frame(6)} AS roll_6h,
         avg(trip_count) OVER {frame(24)} AS roll_24h,
         avg(trip_count) OVER {frame(168)} AS roll_168h,
         CAST(hour(hour_start) AS SMALLINT) AS pickup_hour,
         CAST(dayofweek(hour_start) AS SMALLINT) AS pickup_dow,
         dayofweek(hour_start) IN (0, 6) AS is_weekend
  FROM filled
  WINDOW w AS (PARTITION BY {partition} ORDER BY hour_start)
)"""


def with_trips(body: str) -> str:
    return f"WITH {TRIPS_SQL}\n{body}"


def with_clean(body: str) -> str:
    return f"WITH {TRIPS_SQL},{CLEAN_SQL}\n{body}"


def with_mart(body: str) -> str:
    return f"WITH {TRIPS_SQL},{CLEAN_SQL},{MART_SQL}\n{body}"


def with_filled(body: str, more: str = "") -> str:
    return f"WITH {TRIPS_SQL},{CLEAN_SQL},{MART_SQL},{FILLED_SQL}{more}\n{body}"


def with_features(body: str, more: str = "", include_current: bool = True) -> str:
    return with_filled(body, features_sql(include_current=include_current) + more)
