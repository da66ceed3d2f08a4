"""Keyed changes as pure frames: what a table holds after the change.

The writers in ``hourgrid.tables.store`` apply the same frames to stored tables.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourgrid.functions.clock import as_date
from hourgrid.operators.trips import first_per_key


def new_rows(batch: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``batch`` to insert when existing keys are left alone: one per new key.

    A NULL in a key never equals anything, so every such row is inserted.
    """
    keys = list(keys)
    complete = F.lit(True)
    for key in keys:
        complete = complete & F.col(key).isNotNull()
    first = first_per_key(batch.where(complete), keys).join(target.select(*keys), keys, "left_anti")
    return first.unionByName(batch.where(~complete))


def insert_ignore_rows(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    return target.unionByName(new_rows(batch, target, keys), allowMissingColumns=True)


def upsert_rows(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], update_cols: Sequence[str]
) -> DataFrame:
    """``target`` after inserting ``batch`` and updating ``update_cols`` on equal keys.

    ``batch`` must be key-unique. When every other column is updated, the old
    rows of touched keys are simply dropped, and a small batch needs no shuffle
    of the target. Otherwise one full join carries the untouched columns over.
    A NULL in a key never equals anything, so such rows are inserted.
    """
    keys, update_cols = list(keys), list(update_cols)
    kept = [c for c in target.columns if c not in keys and c not in update_cols]
    incoming = set(batch.columns)
    if not kept:
        untouched = target.join(batch.select(*keys), keys, "left_anti")
        return untouched.unionByName(batch, allowMissingColumns=True).select(*target.columns)

    old = target.select(F.struct(*target.columns).alias("old"), *[F.col(k).alias(f"_k_{k}") for k in keys])
    new = batch.select(F.struct(*batch.columns).alias("new"), *[F.col(k).alias(f"_k_{k}") for k in keys])
    joined = old.alias("o").join(
        new.alias("n"), on=[F.col(f"o._k_{k}") == F.col(f"n._k_{k}") for k in keys], how="full_outer"
    )
    has_old, has_new = F.col("old").isNotNull(), F.col("new").isNotNull()

    def merged(name: str) -> Column:
        before = F.col(f"old.{name}")
        after = F.col(f"new.{name}") if name in incoming else F.lit(None)
        if name in update_cols:
            return F.when(has_new, after).otherwise(before).alias(name)
        return F.when(has_old, before).otherwise(after).alias(name)

    return joined.select(*[merged(c) for c in target.columns])


def replace_month_rows(target: DataFrame, batch: DataFrame, month: dt.date | str) -> DataFrame:
    """``target`` with its rows of ``month`` replaced by ``batch`` (which may be empty)."""
    others = target.where(~F.col("ingest_month").eqNullSafe(as_date(month)))
    return others.unionByName(batch, allowMissingColumns=True)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; a key with a NULL part is never a duplicate."""
    complete = F.lit(True)
    for key in keys:
        complete = complete & F.col(key).isNotNull()
    return df.where(complete).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def evolve(
    df: DataFrame,
    add_columns: dict[str, str] | None = None,
    retype: dict[str, Column] | None = None,
) -> DataFrame:
    """New NULL columns of the given types, and columns replaced by expressions."""
    added = {n: F.lit(None).cast(t) for n, t in (add_columns or {}).items() if n not in df.columns}
    changed = df.withColumns(retype) if retype else df
    return changed.withColumns(added) if added else changed


def latest_per_key(log: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The row with the greatest ``order`` of each key, whole.

    An aggregate, so a key with very many log entries is reduced on the map side.
    Ties of ``order`` go to the greatest remaining columns.
    """
    rest = [c for c in log.columns if c not in keys and c != order]
    newest = log.groupBy(*keys).agg(F.max(F.struct(order, *rest)).alias("_last"))
    return newest.select(*keys, *[F.col(f"_last.{c}").alias(c) for c in [order, *rest]])
