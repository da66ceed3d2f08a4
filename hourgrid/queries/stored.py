"""Writers and guards as a user calls them: on stored tables of a scratch database."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid import schemas
from hourgrid.functions.clock import month_floor
from hourgrid.plans import evaluate, forecast, ingest, layers
from hourgrid.queries import inputs
from hourgrid.queries.changes import MONTHLY_SQL, _dearer, _monthly, _orders
from hourgrid.queries.inputs import TRIPS_SQL, rounded, show_month, table, with_features
from hourgrid.queries.registry import query
from hourgrid.queries.scores import PREDICTIONS_SQL, SPLIT, SPLIT_TIME, HORIZON, RUNS, _mart_and_predictions, _shown, errors_sql
from hourgrid.queries.series import ROLLS, _two_months_sql
from hourgrid.operators import demand, scoring
from hourgrid.session import ensure_checkpoint_dir, shared_folder
from hourgrid.sources import scans, trip_files
from hourgrid.tables import state, store

TWO_MONTHS = (dt.date(2024, 1, 1), dt.date(2024, 2, 1))
_databases: dict[str, str] = {}


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh database; the one of an earlier run of the same query is dropped."""
    old = _databases.pop(name, None)
    if old:
        spark.sql(f"DROP DATABASE IF EXISTS {old} CASCADE")
    database = _databases[name] = f"hourgrid_{name}_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {database}")
    return database


@query(
    "stored_bulk_append",
    sql="""
SELECT o_orderkey, o_custkey, CAST(NULL AS VARCHAR) AS o_orderpriority, CAST(NULL AS DOUBLE) AS surcharge FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT o_orderkey, o_custkey, o_orderpriority, o_totalprice * 0.5::DOUBLE FROM orders WHERE o_orderstatus <> 'F'
""",
)
def stored_bulk_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads into one table, the second with two more columns."""
    name = f"{scratch(spark, 'append')}.orders"
    orders = table(spark, sf_dir, "orders")
    first = orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey")
    store.create_like(first, name, partition_by=())
    store.bulk_append(first, name)
    second = orders.where("o_orderstatus <> 'F'").select(
        "o_orderkey", "o_custkey", "o_orderpriority", (F.col("o_totalprice") * 0.5).alias("surcharge")
    )
    store.bulk_append(second, name, schema_mode="merge")
    return spark.table(name)


@query(
    "stored_replace_partition",
    sql=f"""
WITH {MONTHLY_SQL}
SELECT CAST(ingest_month AS VARCHAR) AS ingest_month, o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority
FROM monthly WHERE ingest_month NOT IN (DATE '1996-03-01', DATE '1996-04-01')
UNION ALL
SELECT '1996-03-01', o_orderkey, o_custkey, o_orderstatus, o_totalprice * 2.0::DOUBLE, 'NEW'
FROM monthly WHERE ingest_month = DATE '1996-03-01' AND o_orderstatus = 'F'
""",
)
def stored_replace_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One month replaced by some of its rows, one by nothing."""
    name = f"{scratch(spark, 'replace')}.orders"
    monthly = _monthly(spark, sf_dir)
    store.create_like(monthly, name)
    store.bulk_append(monthly, name)
    batch = _dearer(monthly.where("ingest_month = date'1996-03-01' and o_orderstatus = 'F'"))
    store.replace_partition(batch, name, "1996-03-01")
    store.replace_partition(monthly.where("o_totalprice < 0"), name, "1996-04-01")
    return show_month(spark.table(name))


@query(
    "stored_insert_ignore",
    sql="""
WITH target AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders WHERE o_orderstatus <> 'F')
SELECT * FROM target
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice * 2.0::DOUBLE, 'NEW'
FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM target)
UNION ALL
SELECT NULL, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders WHERE o_orderstatus = 'P'
""",
)
def stored_insert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch with every key twice and with rows without a key, all of which are new."""
    name = f"{scratch(spark, 'ignore')}.orders"
    orders = _orders(spark, sf_dir)
    store.create_like(orders, name, partition_by=["o_orderstatus"])
    store.bulk_append(orders.where("o_orderstatus <> 'F'"), name)
    keyless = orders.where("o_orderstatus = 'P'").withColumn("o_orderkey", F.lit(None).cast("bigint"))
    batch = _dearer(orders, 3.0).unionByName(_dearer(orders, 2.0)).unionByName(keyless)
    store.insert_ignore(batch, name, ["o_orderkey"])
    return spark.table(name)


@query(
    "stored_upsert",
    sql="""
SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus <> 'O' THEN 'P' ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderstatus <> 'O' THEN o_totalprice * 2.0::DOUBLE ELSE o_totalprice END AS o_totalprice,
       CASE WHEN o_orderstatus = 'F' THEN 'NEW' ELSE o_orderpriority END AS o_orderpriority
FROM orders
""",
)
def stored_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal keys change price and partition; new keys come in whole."""
    name = f"{scratch(spark, 'upsert')}.orders"
    orders = _orders(spark, sf_dir)
    store.create_like(orders, name, partition_by=["o_orderstatus"])
    store.bulk_append(orders.where("o_orderstatus <> 'F'"), name)
    batch = _dearer(orders.where("o_orderstatus <> 'O'")).withColumn("o_orderstatus", F.lit("P"))
    store.upsert(batch, name, ["o_orderkey"], ["o_totalprice", "o_orderstatus"])
    return spark.table(name)


@query(
    "stored_insert_select",
    sql="SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, TRUE AS refused FROM orders",
)
def stored_insert_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two inserts with new keys; a third with stored keys is refused and changes nothing."""
    name = f"{scratch(spark, 'select')}.orders"
    orders = _orders(spark, sf_dir)
    store.create_like(orders, name, partition_by=())
    store.insert_select(orders.where("o_orderstatus = 'F'"), name, ["o_orderkey"])
    store.insert_select(orders.where("o_orderstatus <> 'F'"), name, ["o_orderkey"], ["o_custkey"])
    refused = _raises(lambda: store.insert_select(orders, name, ["o_orderkey"]))
    return spark.table(name).withColumn("refused", F.lit(refused))


def _raises(action) -> bool:
    try:
        action()
    except ValueError:
        return True
    return False


@query(
    "constraint_checks",
    sql="""
SELECT 'repeated keys' AS what, count(*) < (SELECT count(*) FROM lineitem) AS raised FROM (SELECT DISTINCT l_orderkey FROM lineitem)
UNION ALL
SELECT 'whole keys', count(*) < (SELECT count(*) FROM lineitem) FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem)
UNION ALL
SELECT 'required columns', count(*) > 0 FROM lineitem WHERE l_quantity IS NULL OR l_shipdate IS NULL
""",
)
def constraint_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem")
    found = [
        ("repeated keys", _raises(lambda: store.check_constraints(rows, keys=["l_orderkey"]))),
        ("whole keys", _raises(lambda: store.check_constraints(rows, keys=["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]))),
        ("required columns", _raises(lambda: store.check_constraints(rows, not_null=["l_quantity", "l_shipdate"]))),
    ]
    return spark.createDataFrame(found, "what string, raised boolean")


@query("table_statistics", sql="SELECT count(*) AS n_rows FROM orders")
def table_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row count that the catalog knows after the statistics were refreshed."""
    name = f"{scratch(spark, 'analyze')}.orders"
    orders = _orders(spark, sf_dir)
    store.create_like(orders, name, partition_by=())
    store.bulk_append(orders, name)
    store.analyze(spark, name, all_columns=True)
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Statistics'")
    return described.select(F.regexp_extract("data_type", r"(\d+) rows", 1).cast("bigint").alias("n_rows"))


@query(
    "stored_evolve",
    sql="SELECT event_id, epoch_us(ts) AS ts_us, CAST(NULL AS INTEGER) AS horizon_hours, CAST(CAST(date_trunc('month', ts) AS DATE) AS VARCHAR) AS ingest_month FROM events",
)
def stored_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A partitioned table gets a column and a zone-less time becomes an instant (clocks in UTC)."""
    name = f"{scratch(spark, 'evolve')}.events"
    rows = table(spark, sf_dir, "events").select("event_id", "ts", month_floor(F.col("ts")).alias("ingest_month"))
    store.create_like(rows, name)
    store.bulk_append(rows, name)
    store.evolve_table(
        spark, name, {"horizon_hours": "int"}, {"ts": F.to_utc_timestamp(F.col("ts").cast("timestamp"), "UTC")}
    )
    return show_month(spark.table(name)).withColumn("ts_us", F.unix_micros("ts")).drop("ts")


@query(
    "load_states",
    sql="""
WITH n AS (SELECT o_orderpriority, count(*) AS c FROM orders GROUP BY 1)
SELECT o_orderpriority AS dataset, 2024 AS year, 1 AS month, 'file-' || o_orderpriority AS file_path,
       CASE WHEN o_orderpriority LIKE '1%' THEN 'failed' WHEN o_orderpriority LIKE '2%' THEN 'running' ELSE 'success' END AS status,
       CASE WHEN o_orderpriority LIKE '1%' OR o_orderpriority LIKE '2%' THEN NULL ELSE c END AS row_count,
       CASE WHEN o_orderpriority LIKE '1%' THEN 'stopped' END AS error_message,
       o_orderpriority NOT LIKE '1%' AND o_orderpriority NOT LIKE '2%' AS is_loaded
FROM n ORDER BY 1 LIMIT 5
""",
)
def load_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads that start, end and fail, one per priority of the orders; the newest five by the status report."""
    name = f"{scratch(spark, 'states')}.log"
    state.ensure_state(spark, name)
    counts = table(spark, sf_dir, "orders").groupBy("o_orderpriority").count().orderBy("o_orderpriority").collect()
    for dataset, n in counts:
        state.mark_running(spark, name, dataset, 2024, 1, f"file-{dataset}", f"sha-{dataset}")
        if dataset.startswith("1"):
            state.mark_failed(spark, name, dataset, 2024, 1, "stopped")
        elif not dataset.startswith("2"):
            state.mark_success(spark, name, dataset, 2024, 1, n)
    current = state.latest_state(spark.table(name))
    loaded = [d for d, _ in counts if state.already_loaded(current, d, 2024, 1, f"sha-{d}")]
    _, newest = scans.ingest_status(spark, name, current)
    is_loaded = F.col("dataset").isin(*loaded) if loaded else F.lit(False)
    return newest.select(
        "dataset", "year", "month", "file_path", "status", "row_count", "error_message", is_loaded.alias("is_loaded")
    )


@query(
    "load_range",
    sql=f"""
WITH {TRIPS_SQL}, m AS (
  SELECT CAST('2024-01-01' AS VARCHAR) AS ingest_month, trip_distance > 3 AS used FROM trips
  UNION ALL SELECT '2024-02-01', TRUE FROM trips
  UNION ALL SELECT '2024-03-01', trip_distance > 5 FROM trips
)
SELECT ingest_month, count_if(used) AS n, 'success' AS status, count_if(used) AS row_count, ingest_month = '2024-01-01' AS loaded_again
FROM m GROUP BY 1
""",
)
def load_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three delivered months, one of them with a further column, loaded at once; then again after one has changed."""
    folder = f"{shared_folder(spark)}/months-{uuid.uuid4().hex}"
    database = scratch(spark, "load_range")
    names = {"raw_table": f"{database}.raw", "state_table": f"{database}.log", "schema_mode": "merge"}
    rows = inputs.trips(spark, sf_dir).drop("ingest_month").withColumnsRenamed(_file_names())
    rows.write.parquet(trip_files.month_path(folder, 2024, 1))
    rows.withColumn("Airport_Fee", F.col("total_amount")).write.parquet(trip_files.month_path(folder, 2024, 2))
    rows.where("trip_distance > 5").write.parquet(trip_files.month_path(folder, 2024, 3))
    last = dt.date(2024, 3, 1)
    ingest.load_range(spark, folder, TWO_MONTHS[0], last, **names)
    rows.where("trip_distance > 3").write.mode("overwrite").parquet(trip_files.month_path(folder, 2024, 1))
    again = ingest.load_range(spark, folder, TWO_MONTHS[0], last, **names)
    state.compact_log(spark, names["state_table"])
    loaded = [m for m, n in again.items() if n is not None]
    counts = spark.table(names["raw_table"]).groupBy("ingest_month").agg(F.count(F.lit(1)).alias("n"))
    states = state.latest_state(spark.table(names["state_table"]))
    states = states.select(F.make_date("year", "month", F.lit(1)).alias("ingest_month"), "status", "row_count")
    joined = counts.join(states, "ingest_month").withColumn("loaded_again", F.col("ingest_month").isin(*loaded))
    return show_month(joined)


@query(
    "scan_month",
    sql=f"""
WITH {TRIPS_SQL}
SELECT pickup_ts AS tpep_pickup_datetime, dropoff_ts AS tpep_dropoff_datetime, pu_location AS pulocationid, trip_distance,
       '2024-01-01' AS ingest_month FROM trips
""",
)
def scan_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One delivered month, with lower-cased names and its month."""
    folder = f"{shared_folder(spark)}/months-{uuid.uuid4().hex}"
    rows = inputs.trips(spark, sf_dir).drop("ingest_month").withColumnsRenamed(_file_names())
    rows.write.parquet(trip_files.month_path(folder, 2024, 1))
    one = trip_files.scan_month(spark, folder, 2024, 1)
    return show_month(one.select("tpep_pickup_datetime", "tpep_dropoff_datetime", "pulocationid", "trip_distance", "ingest_month"))


def _file_names() -> dict[str, str]:
    return {
        "pickup_ts": "tpep_pickup_datetime",
        "dropoff_ts": "TPEP_dropoff_datetime",
        "pu_location": "PULocationID",
        "do_location": "DOLocationID",
        "trip_distance": "trip_distance",
        "fare_amount": "fare_amount",
        "total_amount": "total_amount",
    }


@query(
    "scan_month_range",
    sql=f"""
WITH {TRIPS_SQL}
SELECT pickup_ts AS tpep_pickup_datetime, pu_location AS pulocationid, trip_distance, CAST(NULL AS DOUBLE) AS airport_fee,
       '2024-01-01' AS ingest_month FROM trips
UNION ALL
SELECT pickup_ts, pu_location, trip_distance, total_amount, '2024-02-01' FROM trips
""",
)
def scan_month_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two delivered months with mixed-case names, the second with a further column."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/months-{uuid.uuid4().hex}"
    rows = inputs.trips(spark, sf_dir).drop("ingest_month").withColumnsRenamed(_file_names())
    rows.write.parquet(trip_files.month_path(folder, 2024, 1))
    rows.withColumn("Airport_Fee", F.col("total_amount")).write.parquet(trip_files.month_path(folder, 2024, 2))
    months = trip_files.months_between(*TWO_MONTHS)
    both = trip_files.scan_month_range(spark, folder, months[0], months[-1])
    return show_month(both.select("tpep_pickup_datetime", "pulocationid", "trip_distance", "airport_fee", "ingest_month"))


@query(
    "stored_predictions",
    sql=with_features("SELECT hour_start, pu_location, trip_count * 2.0::DOUBLE AS yhat, 24 AS horizon_hours, TRUE AS known FROM mart"),
)
def stored_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same forecast stored twice; the later values stay, and the guard then knows it."""
    name = f"{scratch(spark, 'predictions')}.p"
    mart = inputs.stored_mart(spark, sf_dir)
    keys = [*schemas.PREDICTION_IDENTITY_KEY, "train_day"]
    for factor, run in zip((1.0, 2.0), RUNS.values(), strict=False):
        rows = mart.select("hour_start", "pu_location", (F.col("trip_count") * factor).alias("yhat"))
        made = forecast.as_predictions(rows, run, "m", SPLIT_TIME, 24)
        forecast.write_predictions(made, name, keys, ["yhat", "run_ts"])
    known = forecast.already_forecast(spark.table(name), "m", SPLIT_TIME, 24)
    return spark.table(name).select("hour_start", "pu_location", "yhat", "horizon_hours", F.lit(known).alias("known"))


@query(
    "stored_run_metrics",
    sql=with_features(
        errors_sql(
            "predictions JOIN mart USING (hour_start, pu_location) GROUP BY 1, 2, 3, 4",
            "yhat",
            f"run_ts, model_name, TIMESTAMP '{SPLIT}' AS train_end, {HORIZON} AS horizon_hours, ",
        ),
        PREDICTIONS_SQL,
    ),
)
def stored_run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors of two runs, written twice."""
    name = f"{scratch(spark, 'metrics')}.m"
    mart, _, stored = _mart_and_predictions(spark, sf_dir)
    metrics = evaluate.run_metrics(scoring.join_truth(stored, mart))
    for _ in range(2):
        evaluate.write_run_metrics(metrics, name)
    rows = _shown(spark.table(name).drop("created_at"))
    return rounded(rows.withColumn("train_end", F.col("train_end").cast("timestamp_ntz")), ["mae", "rmse"])


@query("month_features_carried_over", sql=f"SELECT * FROM ({_two_months_sql('pu_location')}) WHERE ingest_month = '2024-02-01'")
def month_features_carried_over(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second month built alone, looking back into the first."""
    both = demand.zone_hour_demand(inputs.two_months(inputs.clean(spark, sf_dir)))
    rows = layers.month_features(inputs.cut_lineage(both), TWO_MONTHS[1], across_months=True)
    return rounded(show_month(rows), ROLLS)
