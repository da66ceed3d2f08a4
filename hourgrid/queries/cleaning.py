"""Guarded casts, cleaning, one row per key, trip features, file scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.functions import clock, guards
from hourgrid.operators import trips as ops
from hourgrid.queries import inputs
from hourgrid.queries.inputs import rounded, show_month, table, with_clean, with_trips
from hourgrid.queries.registry import query
from hourgrid.schemas import TRIP_KEY
from hourgrid.sources.trip_files import file_fingerprints, month_sequence


@query(
    "safe_casts_text",
    sql=r"""
WITH dirty AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         CASE CAST(l_partkey % 8 AS INTEGER)
           WHEN 0 THEN CAST(l_partkey AS VARCHAR)
           WHEN 1 THEN CAST(l_partkey AS VARCHAR) || '.5'
           WHEN 2 THEN '-' || CAST(l_partkey AS VARCHAR)
           WHEN 3 THEN CAST(l_partkey AS VARCHAR) || 'e3'
           WHEN 4 THEN ' ' || CAST(l_partkey AS VARCHAR)
           WHEN 5 THEN ''
           WHEN 6 THEN l_returnflag
           ELSE NULL END AS number_text,
         CASE CAST(l_suppkey % 4 AS INTEGER)
           WHEN 0 THEN strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')
           WHEN 1 THEN strftime(l_shipdate, '%Y-%m-%d')
           WHEN 2 THEN strftime(l_shipdate, '%d/%m/%Y')
           ELSE strftime(l_shipdate, '%Y') || '-13-40' END AS time_text
  FROM lineitem
)
SELECT l_orderkey, l_linenumber, number_text,
       CASE WHEN regexp_matches(number_text, '^[0-9]+(\.[0-9]+)?$')
            THEN CAST(round_even(CAST(number_text AS DOUBLE), 0) AS INTEGER) END AS as_uint,
       CASE WHEN regexp_matches(number_text, '^[0-9]+(\.[0-9]+)?$') THEN CAST(number_text AS DOUBLE) END AS as_udouble,
       CASE WHEN regexp_matches(number_text, '^-?[0-9]+(\.[0-9]+)?$') THEN CAST(number_text AS DOUBLE) END AS as_double,
       CASE WHEN regexp_matches(time_text, '^[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN TRY_CAST(time_text AS TIMESTAMP) END AS as_time
FROM dirty
""",
)
def safe_casts_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, supp = F.col("l_partkey"), F.col("l_suppkey")
    digits = part.cast("string")
    kind = part % 8
    number = (
        F.when(kind == 0, digits)
        .when(kind == 1, F.concat(digits, F.lit(".5")))
        .when(kind == 2, F.concat(F.lit("-"), digits))
        .when(kind == 3, F.concat(digits, F.lit("e3")))
        .when(kind == 4, F.concat(F.lit(" "), digits))
        .when(kind == 5, F.lit(""))
        .when(kind == 6, F.col("l_returnflag"))
    )
    ship = F.col("l_shipdate")
    time = (
        F.when(supp % 4 == 0, F.date_format(ship, "yyyy-MM-dd HH:mm:ss"))
        .when(supp % 4 == 1, F.date_format(ship, "yyyy-MM-dd"))
        .when(supp % 4 == 2, F.date_format(ship, "dd/MM/yyyy"))
        .otherwise(F.concat(F.date_format(ship, "yyyy"), F.lit("-13-40")))
    )
    dirty = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", number.alias("number_text"), time.alias("time_text")
    )
    text = dirty.schema["number_text"].dataType
    value = F.col("number_text")
    return dirty.select(
        "l_orderkey",
        "l_linenumber",
        "number_text",
        guards.safe_uint(value, text).alias("as_uint"),
        guards.safe_udouble(value, text).alias("as_udouble"),
        guards.safe_double(value, text).alias("as_double"),
        guards.safe_timestamp(F.col("time_text"), text).alias("as_time"),
    )


@query(
    "safe_casts_numeric",
    sql="""
WITH numbers AS (
  SELECT 'supplier' AS source, s_suppkey AS id, 0 AS line, s_acctbal AS x FROM supplier
  UNION ALL
  SELECT 'lineitem', l_orderkey, l_linenumber, l_discount / 1000.0 - l_tax FROM lineitem
  UNION ALL
  SELECT 'orders', o_orderkey, 0, o_totalprice * 100.0 FROM orders
)
SELECT source, id, line,
       CASE WHEN x >= 0 THEN CAST(round_even(x, 0) AS INTEGER) END AS as_uint,
       CASE WHEN x >= 0 THEN x END AS as_udouble,
       x AS as_double
FROM numbers
""",
)
def safe_casts_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    def part(name: str, id_: str, line, x) -> DataFrame:
        return table(spark, sf_dir, name).select(
            F.lit(name).alias("source"), F.col(id_).alias("id"), line.alias("line"), x.alias("x")
        )

    numbers = (
        part("supplier", "s_suppkey", F.lit(0), F.col("s_acctbal"))
        .unionByName(
            part("lineitem", "l_orderkey", F.col("l_linenumber"), F.col("l_discount") / 1000.0 - F.col("l_tax"))
        )
        .unionByName(part("orders", "o_orderkey", F.lit(0), F.col("o_totalprice") * 100.0))
    )
    kind, x = numbers.schema["x"].dataType, F.col("x")
    return numbers.select(
        "source",
        "id",
        "line",
        guards.safe_uint(x, kind).alias("as_uint"),
        guards.safe_udouble(x, kind).alias("as_udouble"),
        guards.safe_double(x, kind).alias("as_double"),
    )


CLEAN_OUT = """SELECT CAST(ingest_month AS VARCHAR) AS ingest_month, pickup_ts, dropoff_ts, pu_location, do_location,
       round(trip_distance, 6) AS trip_distance, fare_amount, round(total_amount, 6) AS total_amount
FROM clean"""


@query("clean_trips", sql=with_clean(CLEAN_OUT))
def clean_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text and number source columns, typed, cleaned and made key-unique."""
    source = inputs.trips(spark, sf_dir).select(
        "ingest_month",
        F.col("pickup_ts").cast("string").alias("tpep_pickup_datetime"),
        F.col("dropoff_ts").alias("tpep_dropoff_datetime"),
        F.concat(F.col("pu_location").cast("string"), F.lit(".0")).alias("pulocationid"),
        F.col("do_location").cast("double").alias("dolocationid"),
        "trip_distance",
        "fare_amount",
        "total_amount",
    )
    return rounded(show_month(ops.clean_trips(source)), ["trip_distance", "total_amount"])


@query(
    "dedupe_first",
    sql="""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice
FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice) = 1
""",
)
def dedupe_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"
    )
    return ops.first_per_key(rows, ["l_orderkey", "l_linenumber"])


@query(
    "trip_features",
    sql=with_clean(
        """
, seconds AS (
  SELECT *, CAST(round((epoch_us(dropoff_ts) - epoch_us(pickup_ts)) / 1000000.0::DOUBLE) AS INTEGER) AS trip_seconds
  FROM clean
)
SELECT CAST(ingest_month AS VARCHAR) AS ingest_month, pickup_ts, dropoff_ts, pu_location, do_location,
       round(trip_distance, 6) AS trip_distance, round(total_amount, 6) AS total_amount, trip_seconds,
       round(trip_seconds / 60.0::DOUBLE, 6) AS trip_minutes,
       round(trip_distance / (trip_seconds / 3600.0::DOUBLE), 6) AS speed_mph,
       CAST(hour(pickup_ts) AS SMALLINT) AS pickup_hour,
       CAST(dayofweek(pickup_ts) AS SMALLINT) AS pickup_dow,
       dayofweek(pickup_ts) IN (0, 6) AS is_weekend
FROM seconds
WHERE trip_seconds > 0 AND trip_seconds <= 21600
  AND trip_distance > 0 AND trip_distance <= 100 AND total_amount > 0 AND total_amount <= 500
  AND trip_distance / (trip_seconds / 3600.0::DOUBLE) <= 80
"""
    ),
)
def trip_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ops.trip_features(inputs.clean(spark, sf_dir))
    return rounded(show_month(rows), ["trip_distance", "total_amount", "trip_minutes", "speed_mph"])


@query(
    "calendar_features",
    sql="""
SELECT event_id, date_trunc('hour', ts) AS hour_start,
       CAST(hour(ts) AS SMALLINT) AS pickup_hour,
       CAST(dayofweek(ts) AS SMALLINT) AS dow_sunday_first,
       CAST(isodow(ts) - 1 AS SMALLINT) AS dow_monday_first,
       dayofweek(ts) IN (0, 6) AS is_weekend,
       ts + INTERVAL 25 HOUR AS a_day_later
FROM events
""",
)
def calendar_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts")
    return table(spark, sf_dir, "events").select(
        "event_id",
        clock.hour_floor(ts).alias("hour_start"),
        clock.hour_of_day(ts).alias("pickup_hour"),
        clock.day_of_week(ts).alias("dow_sunday_first"),
        clock.day_of_week(ts, monday_first=True).alias("dow_monday_first"),
        clock.is_weekend(ts).alias("is_weekend"),
        clock.add_hours(ts, 25).alias("a_day_later"),
    )


@query(
    "durations",
    sql=with_trips(
        """
SELECT pickup_ts, dropoff_ts, pu_location,
       round((epoch_us(dropoff_ts) - epoch_us(pickup_ts)) / 60000000.0::DOUBLE, 6) AS minutes,
       round((epoch_us(pickup_ts) - epoch_us(dropoff_ts)) / 60000000.0::DOUBLE, 6) AS reversed_minutes,
       CAST(round((epoch_us(dropoff_ts) - epoch_us(pickup_ts)) / 1000000.0::DOUBLE) AS INTEGER) AS seconds,
       CASE WHEN dropoff_ts > pickup_ts THEN
         round(trip_distance / (round((epoch_us(dropoff_ts) - epoch_us(pickup_ts)) / 1000000.0::DOUBLE) / 3600.0::DOUBLE), 6)
       END AS speed
FROM trips
"""
    ),
)
def durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    start, end = F.col("pickup_ts"), F.col("dropoff_ts")
    seconds = clock.duration_seconds(start, end)
    return inputs.trips(spark, sf_dir).select(
        "pickup_ts",
        "dropoff_ts",
        "pu_location",
        F.round(clock.duration_minutes(start, end), 6).alias("minutes"),
        F.round(clock.duration_minutes(end, start), 6).alias("reversed_minutes"),
        seconds.alias("seconds"),
        F.round(clock.speed_mph(F.col("trip_distance"), seconds), 6).alias("speed"),
    )


@query(
    "local_to_instant",
    sql="""
SELECT event_id, epoch_us(ts) - CAST(5 AS BIGINT) * 3600000000 AS local_us,
       epoch_us(ts) + CASE
         WHEN ts >= date_trunc('year', ts) + INTERVAL 2 MONTH
              + to_days(CAST((7 - dayofweek(date_trunc('year', ts) + INTERVAL 2 MONTH)) % 7 + 7 AS INTEGER)) + INTERVAL 2 HOUR
          AND ts < date_trunc('year', ts) + INTERVAL 10 MONTH
              + to_days(CAST((7 - dayofweek(date_trunc('year', ts) + INTERVAL 10 MONTH)) % 7 AS INTEGER)) + INTERVAL 2 HOUR
         THEN CAST(4 AS BIGINT) ELSE CAST(5 AS BIGINT) END * 3600000000 AS instant_us
FROM events
""",
)
def local_to_instant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone-less event times read as New York clock time."""
    ts = F.col("ts")
    new_york = clock.at_time_zone(ts, "America/New_York")
    utc = clock.at_time_zone(ts, "UTC")
    return table(spark, sf_dir, "events").select(
        "event_id",
        (F.unix_micros(utc) - F.lit(5 * 3_600_000_000)).alias("local_us"),
        F.unix_micros(new_york).alias("instant_us"),
    )


@query(
    "month_sequence",
    sql="""
SELECT strftime(unnest(generate_series(
  date_trunc('month', min(o_orderdate))::TIMESTAMP, date_trunc('month', max(o_orderdate))::TIMESTAMP, INTERVAL 1 MONTH)),
  '%Y-%m-%d') AS ingest_month
FROM orders
""",
)
def month_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounds = table(spark, sf_dir, "orders").agg(
        F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last")
    )
    return show_month(month_sequence(bounds, "first", "last"))


@query(
    "file_fingerprints",
    sql="""
SELECT parse_filename(filename) AS file_name, size AS n_bytes, sha256(content) AS file_sha256
FROM read_blob('/root/testdata/sf0.01/*.parquet')
""",
)
def fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = file_fingerprints(spark, f"{sf_dir}/*.parquet")
    return prints.select(F.regexp_extract("path", "[^/]+$", 0).alias("file_name"), "n_bytes", "file_sha256")


@query(
    "trip_keys_unique",
    sql=with_clean(
        """
SELECT CAST(count(*) AS BIGINT) AS n_rows,
       CAST(count(DISTINCT (ingest_month, pickup_ts, dropoff_ts, pu_location, do_location)) AS BIGINT) AS n_keys
FROM clean"""
    ),
)
def trip_keys_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_key = inputs.clean(spark, sf_dir).groupBy(*TRIP_KEY).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_keys"))
