"""Small frame helpers that the operators of this subpackage share."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from hourgrid.session import cut_lineage


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


_shipped: set[str] = set()


# Texts are long: fewer rows than usual go to a Python worker at a time.
ROWS_PER_BATCH = "1000"


def ship_code(spark: SparkSession) -> None:
    """Give the executors this package, once per application, through Spark's file server.

    Also bounds the memory of Python workers by the rows of an Arrow batch.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        target = os.path.join(tempfile.mkdtemp(prefix="hourgrid-code-"), "hourgrid")
        name = os.path.basename(package)
        context.addPyFile(shutil.make_archive(target, "zip", os.path.dirname(package), name))
        _shipped.add(context.applicationId)


class Remembered(dict):
    """Results of ``make`` for short texts met lately, in a worker.

    A full table becomes the old one and a new one is begun; what is met again moves over. So there are at most
    twice ``most`` entries, and frequent texts stay however many rare ones pass.
    """

    def __init__(self, make: Callable[[str], object], most: int, longest: int = 48) -> None:
        self.make, self.most, self.longest, self.old = make, most, longest, {}

    def __missing__(self, key: str) -> object:
        found = self.old.get(key)
        if found is None:
            found = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[key] = found
        return found


def stage(df: DataFrame) -> DataFrame:
    """Write to the shared checkpoint folder and continue from the written files."""
    return cut_lineage(df)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def unit_hash(*parts: Column) -> Column:
    """A repeatable number in (0, 1) from the given columns."""
    bits = F.shiftrightunsigned(F.xxhash64(*parts), 12)
    return (bits.cast("double") + F.lit(0.5)) / F.lit(float(2**52))


def computed(
    df: DataFrame,
    inputs: list[str],
    function: Callable[..., list],
    fields: list[T.StructField],
    drop: list[str],
) -> DataFrame:
    """``df`` without ``drop``, with ``fields`` that ``function`` computes from lists of the input columns.

    The other columns pass as Arrow data and keep their types and NULLs; those
    named like a new field are replaced.
    """
    new = {f.name for f in fields}
    kept = [f for f in df.schema.fields if f.name not in new and f.name not in drop]
    names = [f.name for f in kept]
    types = [to_arrow_type(f.dataType) for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = function(*(batch.column(c).to_pylist() for c in inputs))
            columns = [batch.column(n) for n in names] + [pa.array(m, t) for m, t in zip(made, types, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, [*names, *(f.name for f in fields)])

    wanted = list(dict.fromkeys([*names, *inputs]))
    return df.select(*[F.col(f"`{c}`") for c in wanted]).mapInArrow(run, T.StructType([*kept, *fields]))


def objects(values: list) -> pd.Series:
    """A column of lists, bytes or numbers that also converts when it is empty or holds None."""
    return pd.Series(values, dtype=object)


def in_groups(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    function: Callable[[pd.DataFrame], pd.DataFrame | None],
    schema: str,
    partitions: int | None = None,
) -> DataFrame:
    """Call ``function`` once per group of ``keys``, streaming over sorted partitions.

    The same as a grouped apply, without its cost per group: small groups share
    the Arrow batches they came in. The caller bounds the size of a group.
    """
    count = partitions or max(shuffle_partitions(df.sparkSession), df.sparkSession.sparkContext.defaultParallelism)
    dealt = df.repartition(count, *keys).sortWithinPartitions(*keys, *order)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: list[pd.DataFrame] = []
        for batch in batches:
            if not len(batch):
                continue
            changed = (batch[keys] != batch[keys].shift()).any(axis=1).to_numpy()
            changed[0] = bool(rest) and (batch[keys].iloc[0] != rest[-1][keys].iloc[0]).any()
            starts = [i for i in changed.nonzero()[0]]
            begin, out = 0, []
            for i in starts:
                piece = batch.iloc[begin:i]
                whole = pd.concat([*rest, piece]) if rest else piece
                rest, begin = [], i
                if len(whole) and (made := function(whole)) is not None:
                    out.append(made)
            rest.append(batch.iloc[begin:])
            if out:
                yield pd.concat(out, ignore_index=True)
        if rest and (made := function(pd.concat(rest))) is not None:
            yield made

    return dealt.mapInPandas(run, schema)
