"""Session settings and the few session values the library reads back."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    # Instants (run_ts, train_end) are compared as UTC; trip times carry no zone.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A month reload replaces only its own partition, at job commit.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Lets the gap-fill join run on the (month, zone) partitioning that the
    # window functions after it need, instead of shuffling a second time.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def build_session(app_name: str = "hourgrid", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; keyword arguments use ``_`` for ``.``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("_", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names; fall back only in local mode."""
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    shared = context.getConf().get("spark.checkpoint.dir")
    if shared is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="hourgrid-checkpoints-")
    context.setCheckpointDir(shared)


def shared_folder(spark: SparkSession) -> str:
    ensure_checkpoint_dir(spark)
    return spark.sparkContext.getCheckpointDir()


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Give the executors this package, once per application, through Spark's file server."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = os.path.dirname(os.path.abspath(__file__))
        target = os.path.join(tempfile.mkdtemp(prefix="hourgrid-code-"), "hourgrid")
        context.addPyFile(shutil.make_archive(target, "zip", os.path.dirname(package), os.path.basename(package)))
        _shipped.add(context.applicationId)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into the checkpoint folder and continue from there.

    The rows then depend on no executor, so a lost executor cannot change or
    repeat the work above this point. Unlike RDD checkpoint files, Parquet keeps
    column pruning and known sizes for whatever is planned next.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/frames/{uuid.uuid4().hex}"
    if not _stages:
        atexit.register(_release_all, spark)
    df.write.parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    _stages[path] = staged.stage_path = path
    return staged


# Stage folders written by this process and not yet released.
_stages: dict[str, str] = {}


def release(*staged: DataFrame) -> None:
    """Delete the files of frames from ``cut_lineage`` that nothing will read any more."""
    for df in staged:
        path = _stages.pop(df.stage_path, None)
        if path:
            delete_folder(df.sparkSession, path)


def stage_folders() -> list[str]:
    return list(_stages)


def delete_folder(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def _release_all(spark: SparkSession) -> None:
    """At the end of the process, whatever a returned frame may have read until then."""
    if spark.sparkContext._jsc is None:
        return  # stopped: the cluster's cleaner of the checkpoint folder has to see to them
    for path in list(_stages):
        delete_folder(spark, _stages.pop(path))


@contextmanager
def session_setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Set one runtime setting for the enclosed block only."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
