"""Keyed changes, month replacement, schema drift and load state, as frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.functions.clock import at_time_zone, month_floor, ntz
from hourgrid.functions.measures import clip, reindex, truncate_text
from hourgrid.operators import keyed
from hourgrid.queries.inputs import rounded, show_month, table
from hourgrid.queries.registry import query
from hourgrid.sources import scans
from hourgrid.tables import state, store

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(*ORDER_COLUMNS)


def _dearer(df: DataFrame, by: float = 2.0) -> DataFrame:
    return df.withColumns({"o_totalprice": F.col("o_totalprice") * by, "o_orderpriority": F.lit("NEW")})


@query(
    "insert_ignore",
    sql="""
WITH target AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders WHERE o_orderstatus <> 'F')
SELECT * FROM target
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice * 2.0::DOUBLE, 'NEW'
FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM target)
""",
)
def insert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch with every key twice, into a table that holds most of the keys."""
    orders = _orders(spark, sf_dir)
    batch = _dearer(orders, 3.0).unionByName(_dearer(orders, 2.0))
    return keyed.insert_ignore_rows(orders.where("o_orderstatus <> 'F'"), batch, ["o_orderkey"])


@query(
    "upsert",
    sql="""
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderstatus <> 'O' THEN o_totalprice * 2.0::DOUBLE ELSE o_totalprice END AS o_totalprice,
       CASE WHEN o_orderstatus = 'F' THEN 'NEW' ELSE o_orderpriority END AS o_orderpriority
FROM orders
""",
)
def upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal keys change only the price; new keys come in whole."""
    orders = _orders(spark, sf_dir)
    batch = _dearer(orders.where("o_orderstatus <> 'O'"))
    return keyed.upsert_rows(orders.where("o_orderstatus <> 'F'"), batch, ["o_orderkey"], ["o_totalprice"])


@query(
    "upsert_whole_rows",
    sql="""
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderstatus <> 'O' THEN o_totalprice * 2.0::DOUBLE ELSE o_totalprice END AS o_totalprice,
       CASE WHEN o_orderstatus <> 'O' THEN 'NEW' ELSE o_orderpriority END AS o_orderpriority
FROM orders
""",
)
def upsert_whole_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir)
    batch = _dearer(orders.where("o_orderstatus <> 'O'"))
    return keyed.upsert_rows(
        orders.where("o_orderstatus <> 'F'"),
        batch,
        ["o_orderkey"],
        ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"],
    )


def _monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        month_floor(F.col("o_orderdate")).alias("ingest_month"), *ORDER_COLUMNS
    )


MONTHLY_SQL = """
monthly AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS ingest_month,
         o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority
  FROM orders
)"""


@query(
    "replace_partition",
    sql=f"""
WITH {MONTHLY_SQL}
SELECT CAST(ingest_month AS VARCHAR) AS ingest_month, o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority
FROM monthly WHERE ingest_month <> DATE '1996-03-01'
UNION ALL
SELECT '1996-03-01', o_orderkey, o_custkey, o_orderstatus, o_totalprice * 2.0::DOUBLE, 'NEW'
FROM monthly WHERE ingest_month = DATE '1996-03-01' AND o_orderstatus = 'F'
""",
)
def replace_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    monthly = _monthly(spark, sf_dir)
    batch = _dearer(monthly.where("ingest_month = date'1996-03-01' and o_orderstatus = 'F'"))
    return show_month(keyed.replace_month_rows(monthly, batch, "1996-03-01"))


@query(
    "replace_partition_empty",
    sql=f"""
WITH {MONTHLY_SQL}
SELECT CAST(ingest_month AS VARCHAR) AS ingest_month, o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority
FROM monthly WHERE ingest_month <> DATE '1996-03-01'
""",
)
def replace_partition_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    monthly = _monthly(spark, sf_dir)
    return show_month(keyed.replace_month_rows(monthly, monthly.where("o_totalprice < 0"), "1996-03-01"))


@query(
    "months_with_drift",
    sql="""
SELECT o_orderkey, o_custkey, NULL AS o_orderpriority, CAST(NULL AS DOUBLE) AS surcharge FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT o_orderkey, o_custkey, o_orderpriority, o_totalprice * 0.5::DOUBLE FROM orders WHERE o_orderstatus <> 'F'
""",
)
def months_with_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads, one without a column and one with an additional column."""
    orders = table(spark, sf_dir, "orders")
    first = orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey")
    second = orders.where("o_orderstatus <> 'F'").select(
        "o_orderkey", "o_custkey", "o_orderpriority", (F.col("o_totalprice") * 0.5).alias("surcharge")
    )
    return first.unionByName(second, allowMissingColumns=True)


@query(
    "empty_text_to_null",
    sql="""
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority, o_orderstatus FROM orders
""",
)
def empty_text_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load in which a third of the texts are empty."""
    priority = F.when(F.col("o_orderstatus") == "F", "").otherwise(F.col("o_orderpriority"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", priority.alias("o_orderpriority"), "o_orderstatus")
    return store.empty_text_to_null(orders)


@query(
    "scan_table",
    sql="""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-01-01'
""",
)
def scan_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounded filter, three columns, a total order."""
    table(spark, sf_dir, "orders").createOrReplaceTempView("hourgrid_orders")
    in_1996 = (F.col("o_orderdate") >= ntz("1996-01-01")) & (F.col("o_orderdate") < ntz("1997-01-01"))
    names = ["o_orderkey", "o_custkey", "o_totalprice"]
    return scans.scan_table(spark, "hourgrid_orders", in_1996, names, order=["o_custkey", "o_orderkey"])


@query(
    "duplicate_keys",
    sql="SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "evolve_columns",
    sql="""
SELECT event_id, epoch_us(ts) AS ts_us, CAST(NULL AS INTEGER) AS horizon_hours FROM events
""",
)
def evolve_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A new empty column, and a zone-less time retyped to an instant (clocks in UTC)."""
    evolved = keyed.evolve(
        table(spark, sf_dir, "events").select("event_id", "ts"),
        add_columns={"horizon_hours": "int"},
        retype={"ts": at_time_zone(F.col("ts"), "UTC")},
    )
    return evolved.select("event_id", F.unix_micros("ts").alias("ts_us"), "horizon_hours")


def _load_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders read as a log of loads: one entry per order, many per key."""
    day = F.col("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("dataset"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.concat(F.lit("file-"), F.col("o_custkey").cast("string")).alias("file_path"),
        F.sha2(F.col("o_custkey").cast("string"), 256).alias("file_sha256"),
        F.when(F.col("o_orderstatus") == "O", state.SUCCESS)
        .when(F.col("o_orderstatus") == "F", state.FAILED)
        .otherwise(state.RUNNING)
        .alias("status"),
        F.floor("o_totalprice").cast("bigint").alias("row_count"),
        F.when(F.col("o_orderstatus") == "F", "stopped").alias("error_message"),
        day.cast("timestamp").alias("started_at"),
        F.lit(None).cast("timestamp").alias("finished_at"),
        F.col("o_orderkey").alias("logged_ns"),
    )


LOG_SQL = """
log AS (
  SELECT o_orderpriority AS dataset, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
         'file-' || CAST(o_custkey AS VARCHAR) AS file_path, sha256(CAST(o_custkey AS VARCHAR)) AS file_sha256,
         CASE o_orderstatus WHEN 'O' THEN 'success' WHEN 'F' THEN 'failed' ELSE 'running' END AS status,
         CAST(floor(o_totalprice) AS BIGINT) AS row_count,
         CASE WHEN o_orderstatus = 'F' THEN 'stopped' END AS error_message, o_orderdate AS started_at, o_orderkey
  FROM orders
),
latest AS (
  SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY dataset, year, month ORDER BY o_orderkey DESC) = 1
)"""


@query(
    "latest_state",
    sql=f"WITH {LOG_SQL} SELECT dataset, year, month, file_path, file_sha256, status, row_count, error_message FROM latest",
)
def latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.latest_state(_load_log(spark, sf_dir)).drop("started_at", "finished_at")


@query(
    "newest_loads",
    sql=f"""WITH {LOG_SQL} SELECT dataset, year, month, status FROM latest
ORDER BY started_at DESC, dataset, year, month LIMIT 5""",
)
def newest_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "orders").createOrReplaceTempView("hourgrid_orders")
    _, newest = scans.ingest_status(spark, "hourgrid_orders", state.latest_state(_load_log(spark, sf_dir)))
    return newest.select("dataset", "year", "month", "status")


@query(
    "pending_files",
    sql=f"""WITH {LOG_SQL}
SELECT f.dataset, f.year, f.month, f.file_sha256
FROM (SELECT DISTINCT dataset, year, month, file_sha256 FROM log) f
WHERE NOT EXISTS (SELECT 1 FROM latest l WHERE l.status = 'success' AND l.dataset = f.dataset
  AND l.year = f.year AND l.month = f.month AND l.file_sha256 = f.file_sha256)
""",
)
def pending_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _load_log(spark, sf_dir)
    files = log.select("dataset", "year", "month", "file_sha256").distinct()
    return state.pending_files(files, state.latest_state(log))


@query(
    "small_helpers",
    sql="""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, substr(l_shipmode_text, 1, 5) AS first_five,
       least(greatest(l_quantity, 10.0::DOUBLE), 40.0::DOUBLE) AS clipped
FROM (SELECT *, strftime(l_shipdate, '%Y-%m-%d') AS l_shipmode_text FROM lineitem)
""",
)
def small_helpers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        truncate_text(F.date_format("l_shipdate", "yyyy-MM-dd"), 5).alias("first_five"),
        clip(F.col("l_quantity"), 10.0, 40.0).alias("clipped"),
    )


@query(
    "reindexed",
    sql="""
SELECT CAST(NULL AS DOUBLE) AS surcharge, o_totalprice, o_orderkey FROM orders
""",
)
def reindexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(reindex(table(spark, sf_dir, "orders"), ["surcharge", "o_totalprice", "o_orderkey"]), ["o_totalprice"])
