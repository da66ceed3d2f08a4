"""Profiles of the feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.operators import explore
from hourgrid.queries import inputs
from hourgrid.queries.inputs import rounded, table, with_features, with_filled
from hourgrid.queries.registry import query
from hourgrid.queries.scores import BUSIEST_SQL


@query(
    "hourly_profile",
    sql=with_filled("SELECT CAST(hour(hour_start) AS INTEGER) AS hour_of_day, round(avg(trip_count), 6) AS mean_trips FROM filled GROUP BY 1"),
)
def hourly_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(explore.hourly_profile(inputs.filled(spark, sf_dir)), ["mean_trips"])


@query(
    "zone_mean_bottom10",
    sql=with_filled("SELECT pu_location, round(avg(trip_count), 6) AS mean_trips FROM filled GROUP BY 1 ORDER BY avg(trip_count), pu_location LIMIT 10"),
)
def zone_mean_bottom10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(explore.quietest_zones(inputs.filled(spark, sf_dir)), ["mean_trips"])


@query(
    "zone_total_top10",
    sql=with_filled("SELECT pu_location, CAST(sum(trip_count) AS BIGINT) AS total_trips FROM filled GROUP BY 1 ORDER BY sum(trip_count) DESC, pu_location LIMIT 10"),
)
def zone_total_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.busiest_zones(inputs.filled(spark, sf_dir))


@query(
    "busiest_zone",
    sql=with_filled("SELECT pu_location, CAST(sum(trip_count) AS BIGINT) AS total_trips FROM filled GROUP BY 1 ORDER BY sum(trip_count) DESC, pu_location LIMIT 1"),
)
def busiest_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.busiest_zones(inputs.filled(spark, sf_dir), 1)


@query(
    "dow_hour_pivot",
    sql=with_features(
        "SELECT CAST(isodow(hour_start) - 1 AS INTEGER) AS dow, "
        + ", ".join(
            f"round(avg(trip_count) FILTER (WHERE hour(hour_start) = {h}), 6) AS h{h:02d}" for h in range(24)
        )
        + f" FROM features WHERE pu_location = {BUSIEST_SQL} GROUP BY 1"
    ),
)
def dow_hour_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.filled(spark, sf_dir)
    pivot = explore.dow_hour_pivot(rows, explore.busiest_zones(rows, 1))
    return rounded(pivot, pivot.columns[1:])


FEATURE_COLUMNS = [
    "ingest_month", "hour_start", "pu_location", "trip_count", "lag_1h", "lag_24h", "lag_168h",
    "roll_6h", "roll_24h", "roll_168h", "pickup_hour", "pickup_dow", "is_weekend",
]


@query(
    "null_counts",
    sql=with_features(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, CAST(count(*) - count({c}) AS BIGINT) AS n_null FROM features" for c in FEATURE_COLUMNS
        )
    ),
)
def null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.null_counts(inputs.features(spark, sf_dir))


@query("table_shape", sql=with_features(f"SELECT count(*) AS n_rows, {len(FEATURE_COLUMNS)} AS n_columns FROM features"))
def table_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.table_shape(inputs.features(spark, sf_dir))


HISTOGRAM_SQL = """
counted AS (SELECT least(CAST({column} AS DOUBLE), {high}) AS value FROM {source} WHERE {column} IS NOT NULL),
bounds AS (SELECT min(value) AS lo, max(value) AS hi FROM counted),
binned AS (
  SELECT least(CAST(floor((value - lo) * 50.0::DOUBLE / (hi - lo)) AS INTEGER), 49) AS bin, count(*) AS n
  FROM counted CROSS JOIN bounds GROUP BY 1
)
SELECT CAST(b.bin AS INTEGER) AS bin, round(lo + b.bin * ((hi - lo) / 50.0::DOUBLE), 6) AS bin_start,
       round(lo + (b.bin + 1) * ((hi - lo) / 50.0::DOUBLE), 6) AS bin_end, coalesce(n, 0) AS n
FROM bounds CROSS JOIN (SELECT unnest(range(50)) AS bin) b LEFT JOIN binned ON binned.bin = b.bin
"""


@query(
    "histogram_clipped",
    sql=with_filled("", "," + HISTOGRAM_SQL.format(column="trip_count", high="200.0::DOUBLE", source="filled")),
)
def histogram_clipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    bins = explore.histogram(inputs.filled(spark, sf_dir), "trip_count", high=200)
    return rounded(bins, ["bin_start", "bin_end"])


@query(
    "histogram_values",
    sql="WITH " + HISTOGRAM_SQL.format(column="l_extendedprice", high="90000.0::DOUBLE", source="lineitem"),
)
def histogram_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A many-valued column, clipped where its tail begins."""
    bins = explore.histogram(table(spark, sf_dir, "lineitem"), "l_extendedprice", high=90000)
    return rounded(bins, ["bin_start", "bin_end"])


def profile_sql(source: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 6) AS mean,
       round(stddev_samp({c}), 6) AS std, CAST(min({c}) AS DOUBLE) AS min,
       round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS q25, round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS q50,
       round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS q75, CAST(max({c}) AS DOUBLE) AS max FROM {source}"""
        for c in columns
    )


NUMERIC = ["pu_location", "trip_count", "lag_1h", "lag_24h", "lag_168h", "roll_6h", "roll_24h", "roll_168h", "pickup_hour", "pickup_dow"]
PROFILE_DIGITS = ["mean", "std", "q25", "q50", "q75"]
SIX = ", ".join(f"round({c}, 6) AS {c}" if c.startswith("roll") else c for c in NUMERIC)


@query("profile_numeric", sql=with_features(profile_sql("exact_features", NUMERIC), f", exact_features AS (SELECT {SIX} FROM features)"))
def profile_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rounded(inputs.features(spark, sf_dir), ["roll_6h", "roll_24h", "roll_168h"])
    return rounded(explore.profile_numeric(rows, NUMERIC), PROFILE_DIGITS)


ORDER_NUMBERS = ["o_orderkey", "o_custkey", "o_totalprice"]


@query("profile_orders", sql=profile_sql("orders", ORDER_NUMBERS))
def profile_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(explore.profile_numeric(table(spark, sf_dir, "orders"), ORDER_NUMBERS), PROFILE_DIGITS)


@query(
    "profile_temporal",
    sql="""
WITH ticks AS (SELECT CAST(epoch_us(ts) AS DOUBLE) / 1000000.0::DOUBLE AS s FROM events)
SELECT 'ts' AS column_name, count(s) AS n, date_trunc('second', make_timestamp(CAST(round(avg(s)) AS BIGINT) * 1000000)) AS mean,
       (SELECT min(ts) FROM events) AS min,
       date_trunc('second', make_timestamp(CAST(floor(quantile_cont(s, 0.25)) AS BIGINT) * 1000000)) AS q25,
       date_trunc('second', make_timestamp(CAST(floor(quantile_cont(s, 0.5)) AS BIGINT) * 1000000)) AS q50,
       date_trunc('second', make_timestamp(CAST(floor(quantile_cont(s, 0.75)) AS BIGINT) * 1000000)) AS q75,
       (SELECT max(ts) FROM events) AS max
FROM ticks
""",
)
def profile_temporal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shown to the second, as the engines differ in how they add up instants."""
    profile = explore.profile_temporal(table(spark, sf_dir, "events"), ["ts"])

    def to_second(name: str, shift: str):
        moved = F.col(name) + F.expr(f"interval {shift} second")
        return moved - F.make_dt_interval(
            secs=(F.date_part(F.lit("SECOND"), moved) % 1).cast("decimal(18,6)")
        )

    return profile.withColumns(
        {"mean": to_second("mean", "0.5"), **{q: to_second(q, "0") for q in ("q25", "q50", "q75")}}
    )


CATEGORICAL = ["event_type", "props"]


@query(
    "profile_categorical",
    sql=" UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, CAST(sum(n) AS BIGINT) AS n, count(*) AS n_unique,
       arg_max(value, n * 1000000 - rank) AS top, max(n) AS freq
FROM (SELECT {c} AS value, count(*) AS n, row_number() OVER (ORDER BY {c}) AS rank FROM events GROUP BY 1)"""
        for c in CATEGORICAL
    ),
)
def profile_categorical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.profile_categorical(table(spark, sf_dir, "events"), CATEGORICAL)


@query(
    "profile_flags",
    sql=with_features(
        """SELECT 'is_weekend' AS column_name, count(is_weekend) AS n, count(DISTINCT is_weekend) AS n_unique,
       CASE WHEN count(*) FILTER (WHERE is_weekend) > count(*) FILTER (WHERE NOT is_weekend) THEN 'true' ELSE 'false' END AS top,
       greatest(count(*) FILTER (WHERE is_weekend), count(*) FILTER (WHERE NOT is_weekend)) AS freq
FROM features"""
    ),
)
def profile_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.profile_categorical(inputs.features(spark, sf_dir), ["is_weekend"])
