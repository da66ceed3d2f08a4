import datetime as dt

import pytest
from pyspark.sql import functions as F

from hourgrid.plans import ingest
from hourgrid.session import session_setting
from hourgrid.sources.scans import ingest_status, scan_table
from hourgrid.sources.trip_files import file_fingerprints, lower_columns, month_path, months_between, scan_month_range
from hourgrid.tables import state, store

JAN, FEB = dt.date(2025, 1, 1), dt.date(2025, 2, 1)
DDL = "k int, v double, note string, ingest_month date"


def rows(spark, data):
    return spark.createDataFrame(data, "k int, v double, note string, m string").select(
        "k", "v", "note", F.col("m").cast("date").alias("ingest_month")
    )


def content(spark, table):
    return sorted((r.k, r.v, r.note, str(r.ingest_month)) for r in spark.table(table).collect())


@pytest.fixture
def table(spark, database):
    name = f"{database}.t"
    store.create_table(spark, name, DDL, ["ingest_month"])
    store.bulk_append(rows(spark, [(1, 1.0, "a", "2025-01-01"), (2, 2.0, "b", "2025-01-01"), (3, 3.0, "c", "2025-02-01")]), name)
    return name


def test_create_is_idempotent(spark, table):
    store.create_table(spark, table, DDL, ["ingest_month"])
    assert spark.table(table).count() == 3
    assert store.partition_columns(spark, table) == ["ingest_month"]


def test_replace_partition(spark, table):
    assert store.replace_partition(rows(spark, [(9, 9.0, "z", "2025-01-01")]), table, JAN) == 1
    assert content(spark, table) == [(3, 3.0, "c", "2025-02-01"), (9, 9.0, "z", "2025-01-01")]
    again = store.replace_partition(rows(spark, [(9, 9.0, "z", "2025-01-01")]), table, JAN)
    assert again == 1 and spark.table(table).count() == 2


def test_replace_partition_with_nothing_drops_the_month(spark, table):
    assert store.replace_partition(rows(spark, []), table, JAN) == 0
    assert content(spark, table) == [(3, 3.0, "c", "2025-02-01")]


def test_replace_partition_from_itself(spark, table):
    store.replace_partition(spark.table(table).where("ingest_month = date'2025-01-01' and k = 1"), table, JAN)
    assert content(spark, table) == [(1, 1.0, "a", "2025-01-01"), (3, 3.0, "c", "2025-02-01")]


def test_failed_replace_leaves_the_old_month(spark, table):
    bad = rows(spark, [(9, 9.0, "z", "2025-01-01")]).withColumn("v", F.raise_error(F.lit("boom")).cast("double"))
    with pytest.raises(Exception, match="boom"):
        store.replace_partition(bad, table, JAN)
    assert len(content(spark, table)) == 3


def test_insert_ignore(spark, table):
    batch = rows(spark, [(1, 99.0, "new", "2025-01-01"), (4, 5.0, "d", "2025-01-01"), (4, 4.0, "d", "2025-01-01")])
    assert store.insert_ignore(batch, table, ["ingest_month", "k"]) == 1
    assert content(spark, table)[0] == (1, 1.0, "a", "2025-01-01")
    assert (4, 4.0, "d", "2025-01-01") in content(spark, table)
    assert store.insert_ignore(batch, table, ["ingest_month", "k"]) == 0


def test_upsert_keeps_other_columns(spark, table):
    batch = rows(spark, [(1, 99.0, "new", "2025-01-01"), (5, 5.0, "e", "2025-01-01")])
    store.upsert(batch, table, ["ingest_month", "k"], ["v"])
    assert content(spark, table) == [
        (1, 99.0, "a", "2025-01-01"), (2, 2.0, "b", "2025-01-01"), (3, 3.0, "c", "2025-02-01"), (5, 5.0, "e", "2025-01-01"),
    ]


def test_upsert_moves_rows_between_partitions(spark, table):
    store.upsert(rows(spark, [(3, 30.0, "c2", "2025-01-01")]), table, ["k"], ["v", "note", "ingest_month"])
    assert content(spark, table) == [
        (1, 1.0, "a", "2025-01-01"), (2, 2.0, "b", "2025-01-01"), (3, 30.0, "c2", "2025-01-01"),
    ]


def test_upsert_rejects_repeated_keys_and_plain_tables(spark, table, database):
    batch = rows(spark, [(1, 1.0, "x", "2025-01-01"), (1, 2.0, "x", "2025-01-01")])
    with pytest.raises(ValueError, match="repeated keys"):
        store.upsert(batch, table, ["ingest_month", "k"], ["v"])
    store.create_table(spark, f"{database}.plain", "k int, v double")
    with pytest.raises(ValueError, match="must be partitioned"):
        store.upsert(spark.table(f"{database}.plain"), f"{database}.plain", ["k"], ["v"])


def test_insert_select_rejects_stored_and_null_keys(spark, table):
    with pytest.raises(ValueError, match="already holds"):
        store.insert_select(rows(spark, [(1, 1.0, "x", "2025-01-01")]), table, ["ingest_month", "k"])
    with pytest.raises(ValueError, match="NULL in required"):
        store.insert_select(rows(spark, [(None, 1.0, "x", "2025-01-01")]), table, ["ingest_month", "k"])
    assert store.insert_select(rows(spark, [(7, 1.0, "x", "2025-01-01")]), table, ["ingest_month", "k"]) == 1


def test_schema_modes(spark, table):
    extra = rows(spark, [(8, 8.0, "h", "2025-02-01")]).withColumn("fee", F.lit(0.75))
    with pytest.raises(ValueError, match="fee"):
        store.bulk_append(extra, table)
    store.bulk_append(extra, table, schema_mode="merge")
    store.bulk_append(rows(spark, [(9, 9.0, "i", "2025-02-01")]).drop("note"), table)
    got = {r.k: (r.note, r.fee) for r in spark.table(table).collect()}
    assert got[1] == ("a", None) and got[8] == ("h", 0.75) and got[9] == (None, None)


def test_empty_text_is_null(spark):
    df = store.empty_text_to_null(rows(spark, [(1, 1.0, "", "2025-01-01")]))
    assert df.first().note is None


def test_analyze_and_scan(spark, table):
    store.analyze(spark, table, JAN)
    store.analyze(spark, table, dt.date(2030, 1, 1))
    store.analyze(spark, table, all_columns=True)
    got = scan_table(spark, table, F.col("ingest_month") == F.lit(JAN), ["k"], ["k"])
    assert [r.k for r in got.collect()] == [1, 2]
    assert "PartitionFilters: [isnotnull(ingest_month" in got._jdf.queryExecution().executedPlan().toString()


def test_evolve_table(spark, table):
    store.evolve_table(spark, table, add_columns={"horizon_hours": "int"})
    store.evolve_table(spark, table, add_columns={"horizon_hours": "int"})
    assert spark.table(table).where("horizon_hours is null").count() == 3
    store.evolve_table(spark, table, retype={"k": F.col("k").cast("bigint")})
    assert dict(spark.table(table).dtypes)["k"] == "bigint"
    assert store.partition_columns(spark, table) == ["ingest_month"] and spark.table(table).count() == 3


def test_state_machine(spark, database):
    log = f"{database}.state"
    state.ensure_state(spark, log)
    key = ("yellow", 2025, 1)
    state.mark_running(spark, log, *key, "/f", "sha1")
    state.mark_failed(spark, log, *key, "x" * 5000)
    row = state.latest_state(spark.table(log)).first()
    assert (row.status, len(row.error_message)) == ("failed", 2000)
    assert not state.already_loaded(state.latest_state(spark.table(log)), *key, "sha1")
    state.mark_running(spark, log, *key, "/f", "sha1")
    assert state.latest_state(spark.table(log)).first().error_message is None
    state.mark_success(spark, log, *key, 42)
    current = state.latest_state(spark.table(log)).collect()
    assert len(current) == 1
    row = current[0]
    assert (row.status, row.row_count, row.error_message, row.file_sha256) == ("success", 42, None, "sha1")
    assert row.finished_at >= row.started_at
    assert state.already_loaded(state.latest_state(spark.table(log)), *key, "sha1")
    assert not state.already_loaded(state.latest_state(spark.table(log)), *key, "sha2")
    state.mark_success(spark, log, "other", 2025, 1, 1)
    assert state.latest_state(spark.table(log)).count() == 1


def write_month(spark, folder, month, n, extra=None):
    df = spark.range(n).select(
        F.expr(f"timestamp_ntz'{month} 08:00:00' + make_dt_interval(0, 0, int(id), 0)").alias("tpep_pickup_datetime"),
        F.expr(f"timestamp_ntz'{month} 08:20:00' + make_dt_interval(0, 0, int(id), 0)").alias("tpep_dropoff_datetime"),
        F.lit(1.0).alias("PULocationID"),
        F.lit(2.0).alias("DOLocationID"),
        F.lit(1.5).alias("trip_distance"),
        F.lit(9.0).alias("fare_amount"),
        F.lit(12.0).alias("total_amount"),
        F.lit("").alias("store_and_fwd_flag"),
    )
    if extra:
        df = df.withColumn(extra, F.lit(0.75))
    path = month_path(str(folder), int(month[:4]), int(month[5:7]))
    # One plain file, as published.
    import pyarrow.parquet as pq

    pq.write_table(df.toArrow(), path)
    return path


def test_load_months_end_to_end(spark, database, tmp_path):
    raw, log = f"{database}.raw_trips", f"{database}.state"
    options = {"raw_table": raw, "state_table": log}
    write_month(spark, tmp_path, "2025-01-05", 100)
    write_month(spark, tmp_path, "2025-02-05", 50)
    assert ingest.load_range(spark, str(tmp_path), JAN, FEB, **options) == {JAN: 100, FEB: 50}
    assert ingest.load_range(spark, str(tmp_path), JAN, FEB, **options) == {JAN: None, FEB: None}
    write_month(spark, tmp_path, "2025-02-05", 30)
    assert ingest.load_month(spark, str(tmp_path), 2025, 2, **options) == 30
    stored = spark.table(raw)
    assert stored.count() == 130 and stored.where("store_and_fwd_flag is not null").isEmpty()
    count, newest = ingest_status(spark, raw, state.latest_state(spark.table(log)))
    assert count.first().row_count == 130
    assert [(r.month, r.status, r.row_count) for r in newest.collect()] == [(2, "success", 30), (1, "success", 100)]


def test_clustered_months_skip_row_groups(spark, database):
    import pyarrow.parquet as pq

    name = f"{database}.clustered"
    rows = spark.range(40_000).select(
        F.expr("timestamp_ntz'2025-01-01 00:00:00' + make_dt_interval(0, cast(id % 700 as int))").alias("hour_start"),
        F.pmod(F.xxhash64("id"), F.lit(100)).cast("int").alias("pu_location"),
        F.col("id").cast("int").alias("trip_count"),
    )
    month = rows.withColumn("ingest_month", F.lit("2025-01-01").cast("date"))
    store.create_like(month, name)
    with_size = spark.conf.get("spark.sql.shuffle.partitions")
    # So small a table would else be one file with one row group.
    with session_setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        assert store.replace_partition(rows, name, "2025-01-01", cluster_by=("pu_location", "hour_start")) == 40_000
    ranges = []
    for path in spark.table(name).inputFiles():
        file = pq.ParquetFile(path.removeprefix("file:"))
        place = file.schema_arrow.names.index("pu_location")
        for k in range(file.num_row_groups):
            stats = file.metadata.row_group(k).column(place).statistics
            ranges.append((stats.min, stats.max))
    assert 1 < len(ranges) <= int(with_size)
    # Every zone is in one or two row groups, not in all of them.
    assert max(sum(lo <= z <= hi for lo, hi in ranges) for z in range(100)) <= 2
    assert spark.table(name).where("pu_location = 7").count() == rows.where("pu_location = 7").count()


def test_stored_keys_out_of_the_batch_are_not_read(spark, database):
    name = f"{database}.keyed"
    rows = spark.range(1000).select("id", F.lit("x").alias("v"))
    store.create_like(rows, name, partition_by=())
    assert store.insert_select(rows, name, ["id"]) == 1000
    later = spark.range(1000, 1010).select("id", F.lit("y").alias("v"))
    bounded = store._within_key_ranges(spark.table(name), later, ["id"])
    plan = bounded._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(id,1000)" in plan and bounded.count() == 0
    assert store.insert_select(later, name, ["id"]) == 10
    with pytest.raises(ValueError, match="already holds"):
        store.insert_select(spark.range(1009, 1011).select("id", F.lit("z").alias("v")), name, ["id"])
    assert store.insert_ignore(spark.range(1005, 1020).select("id", F.lit("z").alias("v")), name, ["id"]) == 10
    assert store.insert_ignore(rows.where("false"), name, ["id"]) == 0
    assert spark.table(name).count() == 1020


def jobs_of(spark, action):
    group = f"g{id(action)}"
    spark.sparkContext.setJobGroup(group, group)
    result = action()
    spark.sparkContext.setJobGroup("", "")
    return result, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_a_range_loads_in_as_many_jobs_whatever_its_length(spark, database, tmp_path):
    for k in range(24):
        write_month(spark, tmp_path, f"{2023 + k // 12}-{k % 12 + 1:02d}-05", 3 + k % 2)
    days = [dt.date(2023 + k // 12, k % 12 + 1, 1) for k in range(24)]
    found = {}
    for months in (2, 24):
        options = {"raw_table": f"{database}.raw{months}", "state_table": f"{database}.log{months}"}
        found[months] = jobs_of(spark, lambda o=options, n=months: ingest.load_range(spark, str(tmp_path), days[0], days[n - 1], **o))
        assert found[months][0] == {d: 3 + i % 2 for i, d in enumerate(days[:months])}
    assert found[24][1] == found[2][1]
    log = state.latest_state(spark.table(f"{database}.log24"))
    assert log.where("status = 'success'").count() == 24
    _, again = jobs_of(spark, lambda: ingest.load_range(spark, str(tmp_path), days[0], days[-1], **options))
    assert again < found[24][1]


def test_a_range_records_the_month_that_fails(spark, database, tmp_path):
    raw, log = f"{database}.raw", f"{database}.log"
    options = {"raw_table": raw, "state_table": log}
    write_month(spark, tmp_path, "2025-01-05", 10)
    write_month(spark, tmp_path, "2025-02-05", 20, extra="zz_new_fee")
    with pytest.raises(ValueError, match="zz_new_fee"):
        ingest.load_range(spark, str(tmp_path), JAN, FEB, **options)
    rows = {r.month: r for r in state.latest_state(spark.table(log)).collect()}
    assert (rows[1].status, rows[1].row_count) == ("success", 10)
    assert rows[2].status == "failed" and "zz_new_fee" in rows[2].error_message
    assert spark.table(raw).count() == 10
    assert ingest.load_range(spark, str(tmp_path), JAN, FEB, schema_mode="merge", **options) == {JAN: None, FEB: 20}
    assert spark.table(raw).where("zz_new_fee = 0.75").count() == 20


def test_log_compaction_keeps_the_newest_entries(spark, database):
    log = f"{database}.log"
    state.ensure_state(spark, log)
    for month in (1, 2, 3):
        state.mark_running(spark, log, "d", 2025, month, "p", f"s{month}")
    state.mark_success(spark, log, "d", 2025, 1, 7)
    state.mark_failed(spark, log, "d", 2025, 2, "broken")
    before = sorted(map(tuple, state.latest_state(spark.table(log)).collect()))
    assert len(spark.table(log).inputFiles()) >= 5
    assert state.compact_log(spark, log) == 3
    assert len(spark.table(log).inputFiles()) == 1
    assert sorted(map(tuple, state.latest_state(spark.table(log)).collect())) == before
    state.mark_success(spark, log, "d", 2025, 3, 9)
    assert state.compact_log(spark, log) == 3
    assert state.already_loaded(state.latest_state(spark.table(log)), "d", 2025, 3, "s3")


def test_load_failures_are_recorded(spark, database, tmp_path):
    raw, log = f"{database}.raw_trips", f"{database}.state"
    options = {"raw_table": raw, "state_table": log}
    write_month(spark, tmp_path, "2025-01-05", 10)
    ingest.load_month(spark, str(tmp_path), 2025, 1, **options)
    write_month(spark, tmp_path, "2025-01-05", 20, extra="new_fee")
    with pytest.raises(ValueError, match="new_fee"):
        ingest.load_month(spark, str(tmp_path), 2025, 1, **options)
    row = state.latest_state(spark.table(log)).first()
    assert row.status == "failed" and "new_fee" in row.error_message
    assert spark.table(raw).count() == 10
    assert ingest.load_month(spark, str(tmp_path), 2025, 1, schema_mode="merge", **options) == 20
    row = state.latest_state(spark.table(log)).first()
    assert row.status == "success" and row.error_message is None


def test_scan_range_with_drift(spark, tmp_path):
    write_month(spark, tmp_path, "2025-01-05", 3)
    write_month(spark, tmp_path, "2025-02-05", 2, extra="new_fee")
    df = scan_month_range(spark, str(tmp_path), JAN, FEB)
    assert df.count() == 5 and df.where("new_fee is null").count() == 3
    assert df.select("ingest_month").distinct().count() == 2


def test_source_checks(spark, tmp_path):
    import hashlib

    path = write_month(spark, tmp_path, "2025-01-05", 3)
    with open(path, "rb") as f:
        assert file_fingerprints(spark, path).first().file_sha256 == hashlib.sha256(f.read()).hexdigest()
    whole, chunked = file_fingerprints(spark, path), file_fingerprints(spark, path, whole_up_to=10)
    assert whole.collect() == chunked.collect()
    with pytest.raises(ValueError, match="only by case"):
        lower_columns(spark.range(1).toDF("A").withColumn("a ", F.lit(1)).toDF("A", "a"))
    assert months_between(dt.date(2024, 11, 1), FEB) == [dt.date(2024, 11, 1), dt.date(2024, 12, 1), JAN, FEB]
    assert months_between(FEB, JAN) == []


def test_replace_checks_the_stated_month(spark, database):
    from hourgrid.tables.store import create_like, replace_partition

    rows = spark.createDataFrame([(1, JAN), (2, JAN)], "k int, ingest_month date")
    table = f"{database}.t"
    create_like(rows, table)
    assert replace_partition(rows, table, JAN) == 2
    with pytest.raises(Exception, match="outside 2025-01-01"):
        replace_partition(rows.union(spark.createDataFrame([(3, FEB)], rows.schema)), table, JAN)
    assert spark.table(table).count() == 2


def test_keyed_writes_over_many_partitions_plan_quickly(spark, database):
    import time

    from hourgrid.tables.store import _in_partitions

    rows = spark.range(6000).selectExpr("id AS p", "id % 7 AS q", "id AS v")
    started = time.time()
    chosen = _in_partitions(rows, ["p", "q"], {(k, k % 7) for k in range(5000)} | {(5999, 6)})
    assert chosen.count() == 5000
    assert _in_partitions(rows, ["p"], {(k,) for k in range(5000)}).count() == 5000
    assert time.time() - started < 30


def test_null_keys_are_never_equal(spark):
    from hourgrid.operators.keyed import new_rows

    batch = spark.createDataFrame([(None, 1), (None, 1), (1, 2), (1, 3), (2, 4)], "k int, v int")
    stored = spark.createDataFrame([(None, 9), (2, 9)], "k int, v int")
    assert sorted((r.k or 0, r.v) for r in new_rows(batch, stored, ["k"]).collect()) == [(0, 1), (0, 1), (1, 2)]


def test_writers_leave_no_stage_folder(spark, database):
    from hourgrid.session import stage_folders
    from hourgrid.tables.store import bulk_append, create_like, insert_ignore, upsert

    before = set(stage_folders())
    rows = spark.range(20).selectExpr("id AS k", "id % 3 AS p", "id AS v")
    table = f"{database}.t"
    create_like(rows, table, ["p"])
    bulk_append(rows, table)
    insert_ignore(rows.selectExpr("k + 10 AS k", "p", "v"), table, ["k", "p"])
    upsert(rows.selectExpr("k + 500 AS k", "p", "v"), table, ["k"], ["v"])
    assert set(stage_folders()) == before
