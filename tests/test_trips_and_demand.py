import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from hourgrid import schemas
from hourgrid.operators import demand, grid, scoring, series, trips
from hourgrid.queries import inputs

JAN = dt.date(2025, 1, 1)


def trip_rows(spark, rows):
    """Rows of (pickup, dropoff, zone, distance, fare, total), all to zone 9."""
    df = spark.createDataFrame(
        [(p, d, z, 9, float(x), float(f), float(t)) for p, d, z, x, f, t in rows],
        "p string, d string, pu_location int, do_location int, trip_distance double, fare_amount double, total_amount double",
    )
    return df.select(
        F.lit(JAN).alias("ingest_month"),
        F.col("p").cast("timestamp_ntz").alias("pickup_ts"),
        F.col("d").cast("timestamp_ntz").alias("dropoff_ts"),
        "pu_location", "do_location", "trip_distance", "fare_amount", "total_amount",
    )


def raw_rows(spark, rows):
    names = [*schemas.REQUIRED_SOURCE_COLUMNS]
    df = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    return df.withColumn("ingest_month", F.lit(JAN))


T0, T1 = "2025-01-05 10:00:00", "2025-01-05 10:10:00"


def test_clean_filter(spark):
    raw = raw_rows(
        spark,
        [
            (T0, T1, "1", "2", "0", "5", "6"),
            (T0, T1, "2", "2", "1", "5", "0"),
            (T0, T1, "3.0", "2", "1", "-5", "10"),
            (T0, T1, "4", "2", "1", "bad", "10"),
            (T0, "nope", "5", "2", "1", "5", "10"),
            (T0, T1, "-6", "2", "1", "5", "10"),
            (T0, T1, "7", None, "1", "5", "10"),
        ],
    )
    got = {r.pu_location: r.fare_amount for r in trips.clean_trips(raw, JAN).collect()}
    assert got == {3: -5.0, 4: None}
    assert trips.clean_trips(raw, "2025-02-01").isEmpty()


def test_first_per_key_takes_the_smallest_row(spark):
    rows = trip_rows(spark, [(T0, T1, 1, 2.0, 1, 1), (T0, T1, 1, 1.0, 9, 9), (T0, T1, 2, 3.0, 1, 1)])
    got = trips.first_per_key(rows, schemas.TRIP_KEY)
    assert got.columns == rows.columns
    assert sorted((r.pu_location, r.trip_distance, r.fare_amount) for r in got.collect()) == [(1, 1.0, 9.0), (2, 3.0, 1.0)]


def test_first_per_key_equals_ranking(spark, sf_dir):
    rows = inputs.table(spark, sf_dir, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    rest = [c for c in rows.columns if c not in keys]
    ranked = rows.withColumn("rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*rest))).where("rn = 1").drop("rn")
    got = trips.first_per_key(rows, keys)
    assert got.exceptAll(ranked).isEmpty() and ranked.exceptAll(got).isEmpty()


def test_mart_caps(spark):
    hour = "2025-01-05 10:00:00"
    rows = trip_rows(
        spark,
        [
            (hour, hour, 1, 1, 1, 1),
            (hour, "2025-01-05 16:00:00", 2, 1, 1, 1),
            (hour, "2025-01-05 16:00:00.6", 3, 1, 1, 1),
            (hour, T1, 4, 100, 1, 1),
            (hour, T1, 5, 100.01, 1, 1),
            (hour, T1, 6, 1, 1, 500),
            (hour, T1, 7, 1, 1, 500.01),
            (T1, hour, 8, 1, 1, 1),
        ],
    )
    assert sorted(r.pu_location for r in demand.zone_hour_demand(rows).collect()) == [2, 4, 6]


def test_mart_values(spark):
    rows = trip_rows(
        spark,
        [(T0, T1, 1, 1, 1, 10), ("2025-01-05 10:59:59.9", "2025-01-05 11:19:59.9", 1, 3, 1, 20), ("2025-01-05 11:00:00", "2025-01-05 11:10:00", 1, 1, 1, 1)],
    )
    got = {r.hour_start.hour: tuple(r)[3:] for r in demand.zone_hour_demand(rows, JAN).collect()}
    assert got[10] == (2, 15.0, 2.0, 15.0)
    assert got[11][0] == 1


def test_trip_feature_caps(spark):
    rows = trip_rows(
        spark,
        [
            (T0, "2025-01-05 16:00:00", 1, 1, 1, 1),
            (T0, "2025-01-05 16:00:01", 2, 1, 1, 1),
            (T0, "2025-01-05 11:00:00", 3, 80, 1, 1),
            (T0, "2025-01-05 11:00:00", 4, 80.01, 1, 1),
        ],
    )
    got = {r.pu_location: r for r in trips.trip_features(rows, JAN).collect()}
    assert sorted(got) == [1, 3]
    assert got[3].speed_mph == 80.0 and got[3].trip_seconds == 3600 and got[3].trip_minutes == 60.0
    assert (got[3].pickup_hour, got[3].pickup_dow, got[3].is_weekend) == (10, 0, True)


def mart_rows(spark, rows):
    df = spark.createDataFrame(rows, "m string, h string, pu_location int, trip_count int")
    return df.select(
        F.col("m").cast("date").alias("ingest_month"), F.col("h").cast("timestamp_ntz").alias("hour_start"),
        "pu_location", "trip_count",
    )


def test_grid_sizes(spark):
    zones = spark.createDataFrame([(1,), (2,)], "pu_location int")
    assert grid.zone_hour_grid(zones, JAN).count() == 2 * 744
    assert grid.zone_hour_grid(zones, JAN, end="2025-01-31 00:00:00").count() == 2 * 721
    assert grid.zone_hour_grid(zones, JAN, "2025-03-01").count() == 2 * (744 + 672 + 744)


def test_gap_fill_keeps_zones_of_other_months(spark):
    mart = mart_rows(
        spark, [("2025-01-01", "2025-01-03 05:00:00", 1, 7), ("2025-02-01", "2025-02-01 00:00:00", 2, 4)]
    )
    filled = grid.filled_demand(mart, JAN)
    assert filled.count() == 2 * 744
    totals = {r.pu_location: r.t for r in filled.groupBy("pu_location").agg(F.sum("trip_count").alias("t")).collect()}
    assert totals == {1: 7, 2: 0}


def short_series(spark, values):
    start = dt.datetime(2025, 1, 1)
    rows = [(str(JAN), str(start + dt.timedelta(hours=i)), 1, v) for i, v in enumerate(values)]
    return mart_rows(spark, rows)


def test_rolling_with_and_without_current(spark):
    rows = short_series(spark, [1, 2, 3])
    inclusive = series.rolling_means(rows, [6]).orderBy("hour_start").collect()
    exclusive = series.rolling_means(rows, [6], include_current=False).orderBy("hour_start").collect()
    assert [r.roll_6h for r in inclusive] == [1.0, 1.5, 2.0]
    assert [r.roll_6h for r in exclusive] == [None, 1.0, 1.5]


def test_running_sum_means_equal_sliding_frames(spark):
    rows = short_series(spark, [None if i % 7 == 3 else (i * 37) % 11 for i in range(400)])
    for include in (True, False):
        fast = series.rolling_means(rows, include_current=include)
        as_double = rows.withColumn("trip_count", F.col("trip_count").cast("double"))
        slow = series.rolling_means(as_double, include_current=include).withColumn("trip_count", F.col("trip_count").cast("int"))
        assert fast.exceptAll(slow).isEmpty() and slow.exceptAll(fast).isEmpty()


def test_lags_equal_shifted_self_join(spark, sf_dir):
    filled = inputs.filled(spark, sf_dir)
    lagged = series.lags(filled)
    assert lagged.where("hour_start < timestamp_ntz'2024-01-08 00:00:00' and lag_168h is not null").isEmpty()
    joined = filled
    for n in series.LAG_HOURS:
        shifted = filled.select(
            "ingest_month", (F.col("hour_start") + F.expr(f"interval {n} hours")).alias("hour_start"),
            "pu_location", F.col("trip_count").alias(f"lag_{n}h"),
        )
        joined = joined.join(shifted, schemas.DEMAND_KEY, "left")
    assert lagged.exceptAll(joined.select(*lagged.columns)).isEmpty()


def test_filled_total_equals_mart_total(spark, sf_dir):
    mart = inputs.stored_mart(spark, sf_dir)
    filled = inputs.filled_from(mart)
    assert filled.agg(F.sum("trip_count")).first()[0] == mart.agg(F.sum("trip_count")).first()[0]
    assert filled.count() == demand.distinct_zones(mart).count() * 744


def test_truth_join_fans_out_unless_collapsed(spark):
    truth = mart_rows(spark, [("2025-01-01", "2025-01-31 23:00:00", 1, 7), ("2025-02-01", "2025-01-31 23:00:00", 1, 2)])
    predicted = truth.limit(1).select("hour_start", "pu_location", F.lit(5.0).alias("yhat"))
    assert scoring.join_truth(predicted, truth).count() == 2
    collapsed = scoring.join_truth(predicted, truth, collapse_truth=True).collect()
    assert [r.trip_count for r in collapsed] == [9]


def test_prediction_without_truth(spark):
    truth = mart_rows(spark, [("2025-01-01", "2025-01-01 01:00:00", 1, 7)])
    predicted = spark.createDataFrame(
        [("2025-01-01 01:00:00", 1, 5.0), ("2025-01-01 02:00:00", 1, 3.0)], "h string, pu_location int, yhat double"
    ).select(F.col("h").cast("timestamp_ntz").alias("hour_start"), "pu_location", "yhat")
    sparse = scoring.mae_rmse(scoring.join_truth(predicted, truth)).first()
    assert (sparse.rows_joined, sparse.mae) == (1, 2.0)
    filled = scoring.mae_rmse(scoring.join_truth(predicted, grid.filled_demand(truth, JAN))).first()
    assert (filled.rows_joined, filled.mae) == (2, 2.5)


def test_years_of_one_zone_use_many_window_partitions(spark):
    from hourgrid.operators import series

    hours = spark.range(24 * 365 * 2).select(
        F.expr("timestamp_ntz'2023-01-01 00:00:00' + make_dt_interval(0, cast(id as int))").alias("hour_start"),
        F.lit(7).alias("pu_location"),
        F.pmod(F.xxhash64("id"), F.lit(50)).cast("int").alias("trip_count"),
    )
    filled = hours.withColumn("ingest_month", F.trunc(F.col("hour_start").cast("date"), "MM"))
    for current in (True, False):
        rows = series.demand_features(filled, include_current=current, across_months=True).orderBy("hour_start").toPandas()
        counts = rows.trip_count
        for n in series.LAG_HOURS:
            assert rows[f"lag_{n}h"].fillna(-1).tolist() == counts.shift(n).fillna(-1).tolist()
        for n in series.ROLL_HOURS:
            want = (counts if current else counts.shift(1)).rolling(n, min_periods=1).mean()
            assert rows[f"roll_{n}h"].fillna(-1).tolist() == pytest.approx(want.fillna(-1).tolist())
    tagged = series.with_look_back(filled)
    assert tagged.groupBy(series.SEGMENT).count().agg(F.max("count")).first()[0] == 744 + series.LOOK_BACK
    assert tagged.count() == filled.count() + 24 * series.LOOK_BACK
