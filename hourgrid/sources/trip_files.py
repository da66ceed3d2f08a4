"""Monthly Parquet trip files and their fingerprints."""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.functions.clock import as_date
from hourgrid.schemas import REQUIRED_SOURCE_COLUMNS
from hourgrid.session import ship_code

# Fixed value: the published naming of the monthly files.
FILE_NAME = "yellow_tripdata_{year:04d}-{month:02d}.parquet"


def month_path(folder: str, year: int, month: int, pattern: str = FILE_NAME) -> str:
    return f"{folder.rstrip('/')}/{pattern.format(year=year, month=month)}"


def month_sequence(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """One row per month from ``bounds[first]`` to ``bounds[last]``, both included."""
    months = F.sequence(
        F.trunc(F.col(first).cast("date"), "MM"),
        F.trunc(F.col(last).cast("date"), "MM"),
        F.expr("interval 1 month"),
    )
    return bounds.select(F.explode(months).alias("ingest_month"))


def months_between(first: dt.date, last: dt.date) -> list[dt.date]:
    """The same month list for driver-side loops over loads."""
    count = (last.year - first.year) * 12 + last.month - first.month + 1
    start = first.year * 12 + first.month - 1
    return [dt.date(n // 12, n % 12 + 1, 1) for n in range(start, start + count)]


def lower_columns(df: DataFrame) -> DataFrame:
    names = [c.lower() for c in df.columns]
    repeated = sorted({n for n in names if names.count(n) > 1})
    if repeated:
        raise ValueError(f"column names differ only by case: {repeated}")
    return df.toDF(*names)


def require_columns(df: DataFrame, required: list[str] = REQUIRED_SOURCE_COLUMNS) -> DataFrame:
    present = {c.lower() for c in df.columns}
    missing = [c for c in required if c.lower() not in present]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def with_month(df: DataFrame, month: dt.date | str) -> DataFrame:
    return df.withColumn("ingest_month", as_date(month))


def scan_month(
    spark: SparkSession, folder: str, year: int, month: int, pattern: str = FILE_NAME
) -> DataFrame:
    """One month as delivered, with lower-cased names, checked and month-tagged."""
    df = spark.read.parquet(month_path(folder, year, month, pattern))
    return with_month(require_columns(lower_columns(df)), dt.date(year, month, 1))


def scan_month_range(
    spark: SparkSession,
    folder: str,
    first: dt.date,
    last: dt.date,
    pattern: str = FILE_NAME,
) -> DataFrame:
    """All months of a range; a column absent from some months is NULL there."""
    return scan_months(spark, month_paths(folder, first, last, pattern))


def month_paths(folder: str, first: dt.date, last: dt.date, pattern: str = FILE_NAME) -> dict[dt.date, str]:
    return {m: month_path(folder, m.year, m.month, pattern) for m in months_between(first, last)}


def month_fingerprints(spark: SparkSession, paths: dict[dt.date, str], dataset: str) -> DataFrame:
    """(dataset, year, month, file_sha256) of every month from one job; a folder of part files has the digest of theirs."""
    listed = spark.createDataFrame(
        [(dataset, m.year, m.month, path.rsplit("/", 1)[1]) for m, path in paths.items()],
        "dataset string, year int, month int, name string",
    )
    parts = F.split("path", "/")
    names = F.array(F.element_at(parts, -1), F.element_at(parts, -2))
    prints = file_fingerprints(spark, list(paths.values())).select(F.explode(names).alias("name"), "file_sha256")
    digests = listed.join(prints, "name").groupBy("dataset", "year", "month").agg(F.sort_array(F.collect_list("file_sha256")).alias("d"))
    whole = F.when(F.size("d") == 1, F.get("d", F.lit(0))).otherwise(F.sha2(F.array_join("d", ""), 256))
    return digests.select("dataset", "year", "month", whole.alias("file_sha256"))


def scan_months(spark: SparkSession, paths: dict[dt.date, str]) -> DataFrame:
    """The files of the given months; a column absent from some months is NULL there.

    Months of equal layout are one read over all their files, with the month taken from
    the file's name; only another layout (a column more, or of another type) adds a union.
    """
    merged = None
    for _, df in months_by_layout(spark, paths):
        tagged = require_columns(lower_columns(df))
        merged = tagged if merged is None else merged.unionByName(tagged, allowMissingColumns=True)
    return merged


def _read_layouts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """path → the path and its column names and types, from the file's footer alone."""
    for batch in batches:
        layouts = []
        for path in batch.column("path").to_pylist():
            store, inside = fs.FileSystem.from_uri(path)
            with store.open_input_file(inside) as file:
                layouts.append(pq.read_schema(file).remove_metadata().to_string(truncate_metadata=False, show_field_metadata=False))
        yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(layouts, pa.string())], ["path", "layout"])


# Schemes of stores that tasks can open by themselves.
OPENED_IN_TASKS = ("file", "hdfs", "s3", "s3a", "gs")


def months_by_layout(spark: SparkSession, paths: dict[dt.date, str]) -> list[tuple[list[dt.date], DataFrame]]:
    """For each layout its months and their rows, tagged with ``ingest_month``.

    The footers of all files are read in the tasks of one job, and one row per layout reaches the driver. In a
    store that only Spark can open, the layouts are those that Spark finds month by month.
    """
    by_name = {path.rsplit("/", 1)[1]: m for m, path in paths.items()}
    listed = spark.read.format("binaryFile").load(list(paths.values())).select("path")
    scheme = F.regexp_extract("path", r"^([a-z0-9]+):", 1)
    if listed.where(~scheme.isin(*OPENED_IN_TASKS)).isEmpty():
        ship_code(spark)
        layouts = listed.mapInArrow(_read_layouts, "path string, layout string")
        rows = layouts.groupBy("layout").agg(F.sort_array(F.collect_set("path")).alias("paths")).collect()
        groups = [r["paths"] for r in rows]
    else:
        found: dict[str, list[str]] = {}
        for path in paths.values():
            found.setdefault(lower_columns(spark.read.parquet(path)).schema.json(), []).append(path)
        groups = list(found.values())

    # A month may be a folder of part files: its name is then one level up.
    def month_of(path: str) -> dt.date:
        above, name = path.split("/")[-2:]
        return by_name[name] if name in by_name else by_name[above]

    made = []
    months = F.map_from_arrays(
        F.array(*[F.lit(n) for n in by_name]), F.array(*[F.lit(m.isoformat()).cast("date") for m in by_name.values()])
    )
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    above = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    month = F.coalesce(F.try_element_at(months, name), F.try_element_at(months, above))
    for members in groups:
        df = spark.read.parquet(*members).withColumn("ingest_month", month)
        made.append((sorted({month_of(p) for p in members}), df))
    return sorted(made, key=lambda x: x[0])


CHUNK = 1 << 22


def _hash_in_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, n_bytes) → the same and the SHA-256, a chunk of the file in memory at a time."""
    for batch in batches:
        digests = []
        for path in batch.column("path").to_pylist():
            store, inside = fs.FileSystem.from_uri(path)
            running = hashlib.sha256()
            with store.open_input_stream(inside) as stream:
                while chunk := stream.read(CHUNK):
                    running.update(chunk)
            digests.append(running.hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("path"), batch.column("n_bytes"), pa.array(digests, pa.string())],
            ["path", "n_bytes", "file_sha256"],
        )


def file_fingerprints(
    spark: SparkSession, paths: str | list[str], whole_up_to: int = 1 << 26
) -> DataFrame:
    """SHA-256 of each file's bytes, for files of any size; nothing reaches the driver.

    Files up to ``whole_up_to`` bytes are hashed as one value by Spark's file reader.
    Larger ones are opened in the tasks and hashed in chunks of a fixed size.
    """
    files = spark.read.format("binaryFile").load(paths)
    small = files.where(F.col("length") <= whole_up_to).select(
        "path", F.col("length").alias("n_bytes"), F.sha2("content", 256).alias("file_sha256")
    )
    large = files.where(F.col("length") > whole_up_to).select("path", F.col("length").alias("n_bytes"))
    hashed = large.mapInArrow(_hash_in_chunks, "path string, n_bytes long, file_sha256 string")
    return small.unionByName(hashed)
