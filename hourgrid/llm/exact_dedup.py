"""Exact duplicates through an extendible-hash index on shared files.

Built-in column functions only. Steps:

1. Every row's text is normalised and hashed to a 64-bit key; the narrow rows
   (id, key, SHA-256) are written once to the shared folder.
2. The directory starts with one bucket and doubles: a bucket that holds more
   than ``bucket_keys`` distinct keys splits by the next leading bit of the key.
   All depths are read from one histogram of key prefixes. Copies share a key,
   so a group of copies of any size is one entry and never forces a split.
3. Keys that meet in a bucket are chained, and a chain link is one distinct text:
   texts are grouped by bucket, key and all their bytes. Copies are reduced in
   each map task first, so a text that fills a third of the table sends one row
   per task.
4. The index (one row per distinct text) is written range-partitioned by bucket
   and key: each owner task writes its range of keys. Rows then look up their owner.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourgrid.llm.frames import stage
from hourgrid.session import release

WHITE_SPACE = r"[\x20\x09-\x0D]+"
BUCKET_KEYS = 100_000
SPARE_BITS = 4


def normalised(text: Column) -> Column:
    """White space runs become one space; NULL counts as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE_SPACE, " ")


def directory(keys: DataFrame, rows: int, bucket_keys: int = BUCKET_KEYS) -> tuple[DataFrame, int]:
    """Slots of the directory with their bucket, and the number of leading bits.

    ``keys`` has the 64-bit column ``key``; columns out: ``slot``, ``bucket``
    (the first slot of its range), ``depth`` (local depth) and ``bucket_keys``.
    A table of N keys has about N / bucket_keys * 16 slots.
    """
    bits = max(1, math.ceil(math.log2(max(1.0, rows / bucket_keys))) + SPARE_BITS)
    slots = (
        keys.select("key")
        .distinct()
        .groupBy(F.shiftrightunsigned("key", 64 - bits).alias("slot"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    depths = slots.select(
        "n", F.col("slot"), F.explode(F.sequence(F.lit(0), F.lit(bits))).alias("depth")
    ).withColumn("start", F.expr(f"shiftleft(shiftrightunsigned(slot, {bits} - depth), {bits} - depth)"))
    nodes = depths.groupBy("depth", "start").agg(F.sum("n").alias("n"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("start").alias("parent"), F.col("n").alias("above"))
    # A node is a bucket if it fits (or no bit is left) and its parent had to split.
    leaves = (
        nodes.withColumn(
            "parent",
            F.expr(f"shiftleft(shiftrightunsigned(start, {bits} - depth + 1), {bits} - depth + 1)"),
        )
        .join(parents, ["depth", "parent"], "left")
        .where((F.col("n") <= bucket_keys) | (F.col("depth") == bits))
        .where(F.col("above").isNull() | (F.col("above") > bucket_keys))
    )
    return (
        leaves.select(
            F.explode(F.expr(f"sequence(start, start + shiftleft(1L, {bits} - depth) - 1)")).alias("slot"),
            F.col("start").alias("bucket"),
            "depth",
            F.col("n").alias("bucket_keys"),
        ),
        bits,
    )


def build_index(
    docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", bucket_keys: int = BUCKET_KEYS
) -> tuple[DataFrame, DataFrame]:
    """(rows, index), both on shared files.

    rows: ``row``, ``id``, ``key``, ``sha``, one per document. index: ``bucket``,
    ``depth``, ``key``, ``chain`` (1 for the first text of a key, more for
    colliding ones), ``sha``, ``keep_id``, ``group_size``, one per distinct text.
    """
    text = normalised(F.col(text_col))
    keyed = docs.select(F.col(id_col).alias("id"), text.alias("norm")).withColumn("key", F.xxhash64("norm"))
    rows = stage(
        keyed.select(
            F.monotonically_increasing_id().alias("row"), "id", "key", F.sha2("norm", 256).alias("sha")
        )
    )
    slots, bits = directory(rows, rows.count(), bucket_keys)
    slots = stage(slots)
    texts = (
        keyed.withColumn("slot", F.shiftrightunsigned("key", 64 - bits))
        .join(slots, "slot")
        .groupBy("bucket", "depth", "key", "norm")
        .agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("bucket", "depth", "key", F.sha2("norm", 256).alias("sha"), "keep_id", "group_size")
    )
    chained = Window.partitionBy("bucket", "key").orderBy("keep_id", "sha")
    index = texts.repartitionByRange("bucket", "key").withColumn("chain", F.row_number().over(chained))
    index = stage(index)
    release(slots)
    return rows, index


def exact_groups(
    docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", bucket_keys: int = BUCKET_KEYS
) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the smallest id stays. Defined cases: a NULL text
    equals the empty text; a NULL id loses to any other; of repeated rows with the
    same id and text exactly one is kept; an empty table gives an empty result;
    further columns of ``docs`` are ignored.
    """
    rows, index = build_index(docs, text_col, id_col, bucket_keys)
    repeated = (
        rows.groupBy("id", "key", "sha")
        .agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("first_row"))
        .where("n > 1")
        .select(F.col("id").alias("rid"), F.col("key").alias("rkey"), F.col("sha").alias("rsha"), "first_row")
    )
    found = rows.join(index.select("key", "sha", "keep_id", "group_size"), ["key", "sha"])
    same = (F.col("rkey") == F.col("key")) & (F.col("rsha") == F.col("sha")) & F.col("rid").eqNullSafe(F.col("id"))
    return found.join(repeated, same, "left").select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        (
            F.col("id").eqNullSafe(F.col("keep_id"))
            & (F.col("first_row").isNull() | (F.col("first_row") == F.col("row")))
        ).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` without the rows that ``exact_groups`` does not keep; same columns."""
    keep = exact_groups(docs, text_col, id_col).where("kept")
    keep = keep.select(F.col(id_col).alias("__dedup_id"), F.col("text_sha256").alias("__dedup_sha"))
    hashed = docs.withColumn("__dedup_text", F.sha2(normalised(F.col(text_col)), 256))
    same = (F.col("__dedup_text") == F.col("__dedup_sha")) & F.col(id_col).eqNullSafe(F.col("__dedup_id"))
    kept = hashed.join(keep, same)
    one = Window.partitionBy("__dedup_text", id_col).orderBy(F.lit(0))
    return kept.withColumn("__dedup_n", F.row_number().over(one)).where("__dedup_n = 1").select(*docs.columns)
