"""Profiles of a feature table: counts, histograms, pivots, summaries."""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourgrid.functions import clock
from hourgrid.functions.measures import clip
from hourgrid.schemas import TARGET
from hourgrid.session import cut_lineage, release, ship_code

QUARTILES = (0.25, 0.5, 0.75)


def hourly_profile(df: DataFrame, value: str = TARGET) -> DataFrame:
    hour = F.hour("hour_start").cast("int").alias("hour_of_day")
    return df.groupBy(hour).agg(F.avg(value).alias("mean_trips"))


def zone_mean(df: DataFrame, value: str = TARGET) -> DataFrame:
    return df.groupBy("pu_location").agg(F.avg(value).alias("mean_trips"))


def zone_total(df: DataFrame, value: str = TARGET) -> DataFrame:
    return df.groupBy("pu_location").agg(F.sum(value).alias("total_trips"))


def quietest_zones(df: DataFrame, n: int = 10) -> DataFrame:
    return zone_mean(df).orderBy("mean_trips", "pu_location").limit(n)


def busiest_zones(df: DataFrame, n: int = 10) -> DataFrame:
    return zone_total(df).orderBy(F.desc("total_trips"), "pu_location").limit(n)


def dow_hour_pivot(df: DataFrame, zone: int | DataFrame, value: str = TARGET) -> DataFrame:
    """Mean per weekday (Monday=0) and hour for one zone, hours as columns.

    The 24 columns are named up front, so no extra job looks for them.
    """
    if isinstance(zone, DataFrame):
        rows = df.join(zone.select("pu_location"), "pu_location", "left_semi")
    else:
        rows = df.where(F.col("pu_location") == zone)
    pivoted = (
        rows.select(
            clock.day_of_week(F.col("hour_start"), monday_first=True).cast("int").alias("dow"),
            F.hour("hour_start").alias("hour"),
            value,
        )
        .groupBy("dow")
        .pivot("hour", list(range(24)))
        .agg(F.avg(value))
    )
    return pivoted.select("dow", *[F.col(f"`{h}`").alias(f"h{h:02d}") for h in range(24)])


def table_shape(df: DataFrame) -> DataFrame:
    """Row count, with the column count beside it."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column: one pass, one row per column."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counted.unpivot([], df.columns, "column_name", "n_null")


def histogram(
    df: DataFrame,
    column: str,
    bins: int = 50,
    low: float | None = None,
    high: float | None = None,
) -> DataFrame:
    """Equal-width bins over the clipped column; the last bin is closed.

    One pass for the bounds and one for the bins; both reduce to a few rows per
    task, so no values are shuffled. Empty bins are kept.
    """
    values = df.where(F.col(column).isNotNull()).select(
        clip(F.col(column), low, high).cast("double").alias("value")
    )
    # A constant column gets a bin range of width one around it.
    bounds = (
        values.agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
        .where(F.col("lo").isNotNull())
        .select(
            F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
            F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
        )
    )
    lo = bounds.select("lo").scalar()
    hi = bounds.select("hi").scalar()
    position = F.floor((F.col("value") - lo) * F.lit(float(bins)) / (hi - lo)).cast("int")
    binned = values.groupBy(F.least(position, F.lit(bins - 1)).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    edges = bounds.select(
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"),
        F.col("lo"),
        ((F.col("hi") - F.col("lo")) / F.lit(float(bins))).alias("width"),
    )
    return edges.join(binned, "bin", "left").select(
        "bin",
        (F.col("lo") + F.col("bin") * F.col("width")).alias("bin_start"),
        (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("bin_end"),
        F.coalesce("n", F.lit(0).cast("bigint")).alias("n"),
    )


def _stacked(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """(column_name, value) rows for the given expressions, NULL and NaN left out."""
    pairs = [F.struct(F.lit(n).alias("column_name"), v.alias("value")) for n, v in values.items()]
    rows = df.select(F.explode(F.array(*pairs)).alias("_p")).select("_p.column_name", "_p.value")
    return rows.where(F.col("value").isNotNull())


# Bits of a number's image that one pass of the selection settles.
DIGIT = 16


def ordered_image(values: np.ndarray) -> np.ndarray:
    """64-bit whole numbers in the order of the doubles; both zeros have the same."""
    bits = (values + 0.0).view(np.uint64)
    negative = bits >> np.uint64(63) == 1
    return np.where(negative, ~bits, bits | np.uint64(1 << 63))


def from_image(image: int) -> float:
    bits = image & ~(1 << 63) if image >> 63 else ~image & 0xFFFF_FFFF_FFFF_FFFF
    return struct.unpack("<d", struct.pack("<Q", bits))[0]


def select_ranks(numbers: DataFrame, wanted: dict[str, Sequence[int]]) -> dict[tuple[str, int], float]:
    """The values of double columns at the wanted ranks, from 0, by radix selection.

    Each value has a 64-bit image in the same order. A pass counts, inside the tasks, the next ``DIGIT`` bits
    of the images that begin like a wanted one, and so settles these bits: four passes over the columns, whatever
    the number of distinct values, and no value is shuffled. NULL and NaN have no rank.
    """
    spark = numbers.sparkSession
    ship_code(spark)
    names = list(wanted)
    # Per column and rank: the bits so far, and the rank among the values that begin with them.
    known = {(c, r): (0, r) for c in names for r in wanted[c]}
    for shift in range(64 - DIGIT, -1, -DIGIT):
        prefixes = [(c, p) for c in names for p in sorted({known[c, r][0] for r in wanted[c]})]

        def count(batches: Iterator[pa.RecordBatch], shift: int = shift, prefixes: list = prefixes) -> Iterator[pa.RecordBatch]:
            totals = [np.zeros(1 << DIGIT, np.int64) for _ in prefixes]
            for batch in batches:
                for place, name in enumerate(names):
                    values = batch.column(place).drop_null().to_numpy(zero_copy_only=False)
                    image = ordered_image(values[~np.isnan(values)])
                    above = image >> np.uint64(shift + DIGIT) if shift + DIGIT < 64 else np.zeros(len(image), np.uint64)
                    digit = (image >> np.uint64(shift)) & np.uint64((1 << DIGIT) - 1)
                    for total, (column, prefix) in zip(totals, prefixes, strict=True):
                        if column == name:
                            total += np.bincount(digit[above == np.uint64(prefix)].astype(np.int64), minlength=1 << DIGIT)
            for number, total in enumerate(totals):
                seen = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(seen), number)), pa.array(seen), pa.array(total[seen])], ["prefix", "digit", "n"]
                )

        counts = numbers.select(*names).mapInArrow(count, "prefix long, digit long, n long")
        counts = counts.groupBy("prefix", "digit").agg(F.sum("n").alias("n"))
        # A prefix has at most 2 ** DIGIT digits, whatever it stands for.
        upto = F.sum("n").over(Window.partitionBy("prefix").orderBy("digit"))
        number = {p: i for i, p in enumerate(prefixes)}
        asked = sorted({(number[c, known[c, r][0]], known[c, r][1]) for c, r in known})
        ranks = spark.createDataFrame(asked, "prefix long, rank long")
        placed = counts.withColumn("upto", upto).join(ranks, "prefix").where("rank < upto AND rank >= upto - n")
        found = {(x["prefix"], x["rank"]): (x["digit"], x["rank"] - x["upto"] + x["n"]) for x in placed.collect()}
        for key, (prefix, rank) in known.items():
            digit, rest = found[number[key[0], prefix], rank]
            known[key] = (prefix << DIGIT | digit, rest)
    return {key: from_image(image) for key, (image, _) in known.items()}


def _numbers(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The named columns as doubles, NaN as NULL, written once: every pass reads these files."""
    number = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
    return cut_lineage(df.select(*[number(c).alias(c) for c in names]))


def _quantiles(numbers: DataFrame, counts: dict[str, int], probabilities: Sequence[float]) -> dict[tuple[str, float], float]:
    """Linear interpolation between the two values around rank ``p * (n - 1)``."""
    places = {(c, p): p * (n - 1) for c, n in counts.items() if n for p in probabilities}
    ranks: dict[str, list[int]] = {}
    for (c, _), place in places.items():
        ranks[c] = sorted({*ranks.get(c, []), math.floor(place), math.ceil(place)})
    if not ranks:
        return {}
    values = select_ranks(numbers, ranks)
    found = {}
    for (c, p), place in places.items():
        low, high = values[c, math.floor(place)], values[c, math.ceil(place)]
        found[c, p] = low + (high - low) * (place - math.floor(place))
    return found


def exact_quantiles(df: DataFrame, names: Sequence[str], probabilities: Sequence[float] = QUARTILES) -> DataFrame:
    """Exact quantiles of every named column, one row per column that has a value."""
    numbers = _numbers(df, names)
    counts = numbers.agg(*[F.count(c).alias(c) for c in names]).first().asDict()
    found = _quantiles(numbers, counts, probabilities)
    rows = [(c, *(found[c, p] for p in probabilities)) for c in names if counts[c]]
    fields = ", ".join(f"q{round(p * 100):02d} double" for p in probabilities)
    release(numbers)
    return df.sparkSession.createDataFrame(rows, f"column_name string, {fields}")


def profile_numeric(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles, max per numeric column: one scan of ``df``, further ones of the columns alone.

    One row per column, so the result is made on the driver.
    """
    numbers = _numbers(df, names)
    first = numbers.agg(
        *[f(c).alias(f"{kind}_{i}") for i, c in enumerate(names) for kind, f in (("n", F.count), ("mean", F.avg), ("min", F.min), ("max", F.max))]
    ).first()
    counts = {c: first[f"n_{i}"] for i, c in enumerate(names)}
    # Squares of the distances to the mean, which is known by now: no loss of digits.
    squares = numbers.agg(
        *[F.sum(F.pow(F.col(c) - F.lit(first[f"mean_{i}"]), F.lit(2.0))).alias(f"s_{i}") for i, c in enumerate(names)]
    ).first()
    found = _quantiles(numbers, counts, QUARTILES)
    release(numbers)
    rows = [
        (
            c, counts[c], first[f"mean_{i}"], math.sqrt(squares[f"s_{i}"] / (counts[c] - 1)) if counts[c] > 1 else None,
            first[f"min_{i}"], *(found[c, p] for p in QUARTILES), first[f"max_{i}"],
        )
        for i, c in enumerate(names)
        if counts[c]
    ]
    schema = "column_name string, n long, mean double, std double, min double, q25 double, q50 double, q75 double, max double"
    return df.sparkSession.createDataFrame(rows, schema)


EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def profile_temporal(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """count, mean, min, quartiles, max per zone-less timestamp column."""
    seconds = {
        n: (F.col(n).cast("timestamp_ntz") - F.expr(EPOCH))
        .cast("interval second")
        .cast("decimal(18,6)")
        .cast("double")
        for n in names
    }
    profile = profile_numeric(df.select([s.alias(n) for n, s in seconds.items()]), names)

    def back(name: str) -> Column:
        length = F.make_dt_interval(secs=F.round(F.col(name), 6).cast("decimal(18,6)"))
        return (F.expr(EPOCH) + length).alias(name)

    return profile.select(
        "column_name", "n", *[back(c) for c in ("mean", "min", "q25", "q50", "q75", "max")]
    )


def profile_categorical(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """count, distinct count, most frequent value (ties: smallest) and its count."""
    rows = _stacked(df, {n: F.col(n).cast("string") for n in names})
    counts = rows.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("column_name").agg(
        F.sum("n").alias("n"),
        F.count(F.lit(1)).alias("n_unique"),
        F.min(F.struct((-F.col("n")).alias("rank"), F.col("value"))).alias("_top"),
    ).select(
        "column_name",
        "n",
        "n_unique",
        F.col("_top.value").alias("top"),
        (-F.col("_top.rank")).alias("freq"),
    )
