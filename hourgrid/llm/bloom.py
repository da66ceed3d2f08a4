"""A filter of 64-bit keys, built in tasks and sent to every task.

Its size follows the number of keys up to ``MOST_BITS``; with more keys than that more
rows pass, and the exact join behind it still decides.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_BITS, MOST_BITS = 1 << 20, 1 << 28
BITS_PER_KEY = 24
GOLDEN = 0x9E3779B97F4A7C15
# Set bits travel in words of this many.
WORD = 32


def size_for(keys: int) -> int:
    """The bits of a filter: a power of two within the bounds."""
    return min(MOST_BITS, max(LEAST_BITS, 1 << (keys * BITS_PER_KEY - 1).bit_length()))


def _places(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mixed = keys.view(np.uint64) * np.uint64(GOLDEN)
    last = np.uint64(bits - 1)
    return ((mixed >> np.uint64(32)) & last).astype(np.int64), ((mixed ^ (mixed >> np.uint64(41))) & last).astype(np.int64)


def build(keys: DataFrame, column: str) -> np.ndarray:
    """The filter over all values of a long column.

    Set bits are gathered into words by an aggregate that each task starts on its own; what reaches
    the driver is the filter, ``MOST_BITS`` at most.
    """
    wanted = keys.select(F.col(column).alias("k")).where("k IS NOT NULL")
    bits = size_for(wanted.agg(F.approx_count_distinct("k")).first()[0])
    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.unique(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64))
            places = np.unique(np.concatenate(_places(values, bits)))
            word, first = np.unique(places // WORD, return_index=True)
            marks = np.bitwise_or.reduceat(np.int64(1) << (places % WORD), first) if len(places) else places
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(marks)], ["word", "marks"])

    found = wanted.mapInArrow(words, "word long, marks long").groupBy("word").agg(F.bit_or("marks").alias("marks"))
    total = np.zeros(bits // WORD, "<u4")
    for batch in found.toArrow().to_batches():
        total[batch.column(0).to_numpy()] = batch.column(1).to_numpy().astype(np.uint32)
    return total.view(np.uint8)


def of_keys(keys: Iterable[int]) -> np.ndarray:
    """The filter of a few keys at hand."""
    values = np.array(list(keys), np.int64)
    bits = size_for(len(values))
    total = np.zeros(bits // 8, np.uint8)
    for places in _places(values, bits):
        np.bitwise_or.at(total, places >> 3, np.uint8(1) << (places & 7).astype(np.uint8))
    return total


def contains(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    found = np.ones(len(keys), bool)
    for places in _places(keys, len(bits) * 8):
        found &= (bits[places >> 3] >> (places & 7).astype(np.uint8)) & 1 == 1
    return found


def single(bits: np.ndarray) -> Callable[[int], bool]:
    """``contains`` for one key at a time, given as a number without a sign."""
    raw, last = bits.tobytes(), len(bits) * 8 - 1

    def holds(key: int) -> bool:
        mixed = key * GOLDEN & 0xFFFF_FFFF_FFFF_FFFF
        place = mixed >> 32 & last
        if not raw[place >> 3] >> (place & 7) & 1:
            return False
        place = (mixed ^ mixed >> 41) & last
        return raw[place >> 3] >> (place & 7) & 1 == 1

    return holds
