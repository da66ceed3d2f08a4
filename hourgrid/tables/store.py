"""Keyed and partition-level writes to catalog tables on plain Parquet.

Every rewrite is a dynamic partition overwrite: new files are staged and take
the place of the old partition only when the job commits, so a job that fails
before its commit leaves the old rows. The commit itself goes partition by
partition and is not atomic over several. Concurrent writers to one table are
out of scope.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from hourgrid.functions.clock import as_date
from hourgrid.operators.keyed import duplicate_keys, evolve, new_rows, upsert_rows
from hourgrid.session import cut_lineage, release, session_setting


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def create_table(spark: SparkSession, table: str, ddl: str, partition_by: Sequence[str] = ()) -> None:
    """Create an empty table from a column list, if absent."""
    create_like(spark.createDataFrame([], StructType.fromDDL(ddl)), table, partition_by)


def create_like(df: DataFrame, table: str, partition_by: Sequence[str] = ("ingest_month",)) -> None:
    """Create an empty table with the columns of ``df``, if absent."""
    spark = df.sparkSession
    if "." in table:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.rsplit('.', 1)[0]}")
    if spark.catalog.tableExists(table):
        return
    _save_as(df.limit(0), table, list(partition_by))


def align(df: DataFrame, table: str, schema_mode: str = "strict") -> DataFrame:
    """``df`` with the columns, order and types of ``table``.

    An absent column is NULL. A column the table lacks is an error with
    ``strict`` and is added to the table with ``merge``.
    """
    spark = df.sparkSession
    known = {f.name.lower(): f for f in spark.table(table).schema}
    extra = [f for f in df.schema if f.name.lower() not in known]
    if extra and schema_mode == "strict":
        raise ValueError(f"{table} has no columns {[f.name for f in extra]}")
    if extra:
        added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in extra)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({added})")
    present = {c.lower() for c in df.columns}
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name.lower() in present else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in spark.table(table).schema
        ]
    )


def empty_text_to_null(df: DataFrame) -> DataFrame:
    """Raw loads do not tell an empty text from a missing one."""
    texts = {f.name: F.nullif(F.col(f"`{f.name}`"), F.lit("")) for f in df.schema if isinstance(f.dataType, StringType)}
    return df.withColumns(texts) if texts else df


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("n_rows")), seen


def clustered(df: DataFrame, table: str, cluster_by: Sequence[str]) -> DataFrame:
    """``df`` laid out for a write: files, and the row groups in them, hold ranges of ``cluster_by`` inside each partition.

    A filter on the first of these columns then skips what cannot match, which is what an index on it would do.
    """
    if not cluster_by:
        return df
    parts = partition_columns(df.sparkSession, table)
    return df.repartitionByRange(*parts, *cluster_by).sortWithinPartitions(*parts, *cluster_by)


def _within_key_ranges(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``target`` whose keys lie between the batch's least and greatest values: no other can clash.

    The bounds reach the scan, so row groups (and partitions, for a partition column) out of range are not read.
    """
    bounds = batch.agg(*[f(k).alias(f"{n}_{i}") for i, k in enumerate(keys) for n, f in (("lo", F.min), ("hi", F.max))]).first()
    for i, k in enumerate(keys):
        lo, hi = bounds[f"lo_{i}"], bounds[f"hi_{i}"]
        if lo is None:
            return target.where(F.lit(False))
        kind = batch.schema[k].dataType
        target = target.where(F.col(k).between(F.lit(lo).cast(kind), F.lit(hi).cast(kind)))
    return target


def _overwrite_partitions(df: DataFrame, table: str) -> None:
    with session_setting(df.sparkSession, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        df.write.mode("overwrite").insertInto(table)


def bulk_append(df: DataFrame, table: str, schema_mode: str = "strict") -> int:
    """Append all rows; returns how many, counted during the write."""
    rows, seen = _counted(align(df, table, schema_mode))
    rows.write.mode("append").insertInto(table)
    return seen.get["n_rows"]


def replace_partition(
    df: DataFrame, table: str, month: dt.date | str, schema_mode: str = "strict", cluster_by: Sequence[str] = ()
) -> int:
    """Make ``df`` the whole content of one month, laid out by ``cluster_by``; returns its row count.

    ``ingest_month`` is added where it is absent; a row of another month stops the
    write before anything is replaced. A dynamic overwrite with no rows would leave
    the old month in place, so an empty result drops the partition in a second step.
    """
    spark = df.sparkSession
    if "ingest_month" in df.columns:
        stated = F.col("ingest_month").cast("date")
        stray = F.raise_error(F.concat(F.lit(f"a row outside {month}: "), stated.cast("string")))
        own = F.when(stated.eqNullSafe(as_date(month)), stated).otherwise(stray)
    else:
        own = as_date(month)
    rows = clustered(align(df.withColumn("ingest_month", own), table, schema_mode), table, cluster_by)
    rows, seen = _counted(rows)  # behind the layout, whose sampling would count rows twice
    _overwrite_partitions(rows, table)
    written = seen.get["n_rows"]
    if written == 0:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (ingest_month = DATE '{month}')")
    return written


def replace_partitions(
    df: DataFrame, table: str, months: Sequence[dt.date], schema_mode: str = "strict"
) -> dict[dt.date, int]:
    """Make ``df`` the whole content of several months by one write; rows per month, counted on the way.

    A row of another month stops the write before anything is replaced; months without rows are dropped.
    """
    spark = df.sparkSession
    stated = F.col("ingest_month").cast("date")
    stray = F.raise_error(F.concat(F.lit("a row outside the months: "), F.coalesce(stated.cast("string"), F.lit("none"))))
    own = F.when(stated.isin(*months), stated).otherwise(stray)
    seen = Observation()
    rows = align(df.withColumn("ingest_month", own), table, schema_mode)
    counts = [F.count_if(F.col("ingest_month") == F.lit(m)).alias(f"m{i}") for i, m in enumerate(months)]
    _overwrite_partitions(rows.observe(seen, *counts), table)
    written = {m: seen.get[f"m{i}"] for i, m in enumerate(months)}
    for m, n in written.items():
        if not n:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (ingest_month = DATE '{m}')")
    return written


def analyze_months(spark: SparkSession, table: str, months: Sequence[dt.date]) -> None:
    """Refresh the row counts and sizes of the given months, in one statement for all partitions if there are several."""
    if len(months) == 1:
        analyze(spark, table, months[0])
    else:
        spark.sql(f"ANALYZE TABLE {table} PARTITION (ingest_month) COMPUTE STATISTICS NOSCAN")


def _partition_values(df: DataFrame, parts: Sequence[str]) -> set[tuple]:
    """Distinct partition values; as few as the partitions the driver lists anyway."""
    return {tuple(row) for row in df.select(*parts).distinct().collect()}


def _in_partitions(df: DataFrame, parts: Sequence[str], values: set[tuple]) -> DataFrame:
    """Rows of the given partitions; others are not read.

    One list of values per partition column prunes at planning time. With several
    columns the lists admit more combinations than asked for, which a join with
    the wanted ones takes out.
    """
    for place, name in enumerate(parts):
        known = {v[place] for v in values}
        listed = F.col(name).isin(*(known - {None})) if known - {None} else F.lit(False)
        df = df.where(listed | F.col(name).isNull() if None in known else listed)
    if len(parts) > 1 and values:
        wanted = df.sparkSession.createDataFrame(list(values), df.select(*parts).schema).alias("w")
        same = [F.col(f"t.{n}").eqNullSafe(F.col(f"w.{n}")) for n in parts]
        df = df.alias("t").join(wanted, same, "left_semi")
    return df


def insert_ignore(df: DataFrame, table: str, keys: Sequence[str]) -> int:
    """Insert rows whose key is not stored yet, one per key.

    Of the table only what lies in the batch's ranges of key values is read; when the key contains
    the partition columns, only the batch's partitions.
    """
    spark = df.sparkSession
    target, parts = spark.table(table), partition_columns(spark, table)
    batch = cut_lineage(df)
    if parts and set(parts) <= set(keys):
        target = _in_partitions(target, parts, _partition_values(batch, parts))
    target = _within_key_ranges(target, batch, [k for k in keys if k not in parts])
    count = bulk_append(new_rows(batch, target, keys), table)
    release(batch)
    return count


def upsert(df: DataFrame, table: str, keys: Sequence[str], update_cols: Sequence[str]) -> None:
    """Insert, or update ``update_cols`` where the key is stored.

    The batch is written to the checkpoint folder once, because it is read
    several times and may itself come from the table. Only partitions that the
    batch, or a stored row with one of its keys, lies in are read and rewritten.
    """
    spark = df.sparkSession
    parts = partition_columns(spark, table)
    if not parts:
        raise ValueError(f"{table} must be partitioned to be updated by key")
    keys = list(keys)
    batch = cut_lineage(align(df, table))
    check_constraints(batch, keys=keys)
    target = spark.table(table)
    touched = _partition_values(batch, parts)
    stays_put = set(parts) <= set(keys)
    if not stays_put:
        # A stored row may lie in another partition than its replacement.
        touched |= _partition_values(target.join(batch.select(*keys), keys, "left_semi"), parts)
    rows = align(upsert_rows(_in_partitions(target, parts, touched), batch, keys, update_cols), table)
    if stays_put:
        _overwrite_partitions(rows, table)
        release(batch)
        return
    rows = cut_lineage(rows)
    _overwrite_partitions(rows, table)
    for value in touched - _partition_values(rows, parts):
        spec = ", ".join(f"`{name}` = '{part}'" for name, part in zip(parts, value, strict=True))
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")
    release(batch, rows)


def insert_select(df: DataFrame, table: str, keys: Sequence[str], not_null: Sequence[str] = ()) -> int:
    """Insert rows; a key that repeats in the batch or is stored already is an error.

    Of the table only what lies in the batch's ranges of key values is read.
    """
    spark = df.sparkSession
    keys = list(keys)
    batch = cut_lineage(df)
    check_constraints(batch, keys=keys, not_null=[*keys, *not_null])
    stored = _within_key_ranges(spark.table(table).select(*keys), batch, keys)
    clash = batch.join(stored, keys, "left_semi").select(*keys).limit(5).collect()
    if clash:
        raise ValueError(f"{table} already holds keys such as {clash}")
    count = bulk_append(batch, table)
    release(batch)
    return count


def check_constraints(df: DataFrame, keys: Sequence[str] = (), not_null: Sequence[str] = ()) -> None:
    """Raise when a required column is NULL or a key repeats (with examples)."""
    if not_null:
        nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in not_null]).first().asDict()
        broken = {c: n for c, n in nulls.items() if n}
        if broken:
            raise ValueError(f"NULL in required columns: {broken}")
    if keys:
        repeated = duplicate_keys(df, keys).limit(5).collect()
        if repeated:
            raise ValueError(f"repeated keys: {repeated}")


def analyze_partitions(df: DataFrame, table: str) -> None:
    """Refresh the statistics of the partitions that ``df``'s rows lie in, and of no other."""
    parts = partition_columns(df.sparkSession, table)
    for value in _partition_values(df, parts):
        spec = ", ".join(f"`{n}` = '{v}'" for n, v in zip(parts, value, strict=True))
        df.sparkSession.sql(f"ANALYZE TABLE {table} PARTITION ({spec}) COMPUTE STATISTICS")


def analyze(
    spark: SparkSession, table: str, month: dt.date | str | None = None, all_columns: bool = False
) -> None:
    """Refresh statistics: of the loaded partition only, or of the whole table."""
    if month is not None:
        if spark.sql(f"SHOW PARTITIONS {table}").where(F.col("partition") == f"ingest_month={month}").isEmpty():
            return
        spark.sql(f"ANALYZE TABLE {table} PARTITION (ingest_month = DATE '{month}') COMPUTE STATISTICS")
    else:
        spark.sql(
            f"ANALYZE TABLE {table} COMPUTE STATISTICS" + (" FOR ALL COLUMNS" if all_columns else "")
        )


def evolve_table(
    spark: SparkSession,
    table: str,
    add_columns: dict[str, str] | None = None,
    retype: dict[str, Column] | None = None,
) -> None:
    """Add columns in place; retyping rewrites the table.

    The retyped rows are written to a table beside the old one, which is dropped
    only then, and that table takes the old name. All rows are in a complete
    table at every moment, so a stopped migration loses nothing.
    """
    stored = spark.table(table)
    if not retype:
        absent = {n: t for n, t in (add_columns or {}).items() if n not in stored.columns}
        if absent:
            listed = ", ".join(f"`{n}` {t}" for n, t in absent.items())
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({listed})")
        return
    parts = partition_columns(spark, table)
    rewritten = f"{table}__rewritten"
    _save_as(evolve(stored, add_columns, retype), rewritten, parts)
    spark.sql(f"DROP TABLE {table}")
    spark.sql(f"ALTER TABLE {rewritten} RENAME TO {table}")
    if parts:
        _relocate_partitions(spark, table)


def _relocate_partitions(spark: SparkSession, table: str) -> None:
    """Point every partition at the table's folder; not every catalog does so on a rename."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'")
    folder = described.first()["data_type"]
    for (path,) in spark.sql(f"SHOW PARTITIONS {table}").collect():
        spec = ", ".join("`{}` = '{}'".format(*step.split("=", 1)) for step in path.split("/"))
        spark.sql(f"ALTER TABLE {table} PARTITION ({spec}) SET LOCATION '{folder}/{path}'")
    spark.catalog.refreshTable(table)


def _save_as(df: DataFrame, table: str, parts: list[str]) -> None:
    writer = df.write.format("parquet")
    if parts:
        writer = writer.partitionBy(*parts)
    writer.saveAsTable(table)
