"""Vectors as short codes: one small codebook per part of the vector, nearest entries by Orchard search.

1. Components become whole numbers, floor(``SCALE`` * x), and a vector is cut into ``PARTS``
   equal parts, so all distances and sums are exact and no result depends on the order of rows.
2. Each part's codebook starts as that part of the rows with the smallest ids. A round gives every
   part its nearest entry and moves each entry to the floor of its parts' mean.
3. The nearest entry is found by Orchard search. Every entry has a list of all others by distance.
   The search walks the list of its best entry so far; a better entry sends it to that entry's list;
   visited entries are not measured again; it ends where the list is further from
   its entry than twice the current distance, since no entry from there on can be as near.

A round is one scan. Tasks add up their parts per entry, so what is shuffled is at most
parts x entries x length numbers a task, and what reaches the driver is the codebook itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from hourgrid.llm.frames import stage
from hourgrid.llm.vectors import EXACT, exact_sums, floors, in_long, matrix, usable

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6


def _widened(*arrays: np.ndarray) -> list[np.ndarray]:
    """As longs where squared distances fit, else all as Python's whole numbers."""
    most = EXACT if arrays[0].shape[-1] <= 256 else EXACT * 16 // arrays[0].shape[-1]
    if all(a.dtype != object and (not a.size or np.abs(a).max() < most) for a in arrays):
        return list(arrays)
    return [a.astype(object) for a in arrays]


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ((a - b) ** 2).sum(axis=-1)


@dataclass
class Neighbours:
    """The entries of one part with, for each entry, all others and their distances, the nearest first."""

    entries: np.ndarray
    order: np.ndarray
    apart: np.ndarray

    @classmethod
    def of(cls, entries: np.ndarray) -> Neighbours:
        (wide,) = _widened(entries)
        count = len(wide)
        apart = np.stack([_squared(wide, e) for e in wide]) if count else np.zeros((0, 0), np.int64)
        order = np.array([sorted((j for j in range(count) if j != i), key=lambda j, i=i: (apart[i, j], j)) for i in range(count)])
        return cls(wide, order.reshape(count, max(0, count - 1)).astype(np.int64), apart)


def orchard_search(points: np.ndarray, book: Neighbours) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest entry (the lower of equally near ones), squared distance, and the number of distances measured.

    All points walk at once; a point leaves when its walk ends. A walk starts at
    the entry whose sum of components is nearest to the point's.
    """
    points, entries = _widened(points, book.entries)
    count = len(entries)
    sums = entries.sum(axis=1)
    by_sum = np.array(sorted(range(count), key=lambda i: sums[i]), np.int64)
    best = by_sum[np.minimum(np.searchsorted(sums[by_sum], points.sum(axis=1)), count - 1)]
    near = _squared(points, entries[best])
    visited = np.zeros((len(points), count), bool)
    visited[np.arange(len(points)), best] = True
    place = np.zeros(len(points), np.int64)
    measured, walking = len(points), np.arange(len(points) if count > 1 else 0)
    while len(walking):
        at = best[walking]
        there = book.order[at, place[walking]]
        # Distances are squared: twice the distance is four times its square. At exactly twice an entry may tie.
        going = (book.apart[at, there] <= 4 * near[walking]).astype(bool)
        walking, at, there = walking[going], at[going], there[going]
        place[walking] += 1
        fresh = ~visited[walking, there]
        seen, other = walking[fresh], there[fresh]
        visited[seen, other] = True
        far = _squared(points[seen], entries[other])
        measured += len(seen)
        better = (far < near[seen]).astype(bool) | ((far == near[seen]).astype(bool) & (other < best[seen]))
        moved = seen[better]
        best[moved], near[moved], place[moved] = other[better], far[better], 0
        walking = walking[place[walking] < count - 1]
    return best, near, measured


@dataclass
class Codebooks:
    """``books[part]`` has one row of whole numbers per entry; ``length`` is that of the vectors."""

    books: list[np.ndarray]
    length: int

    def neighbours(self) -> list[Neighbours]:
        return [Neighbours.of(b) for b in self.books]

    def digest(self) -> str:
        """SHA-256 of all components by part, entry and position, as decimal numbers with commas between."""
        numbers = (str(int(x)) for book in self.books for x in book.ravel().tolist())
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def _parts(column: pa.Array, length: int) -> list[np.ndarray]:
    """Whole-number vectors cut into parts; a length that does not divide is filled up with zeros."""
    numbers = floors(matrix(column, length), SCALE)
    fill = -length % PARTS
    if fill:
        numbers = np.concatenate([numbers, np.zeros((len(numbers), fill), numbers.dtype)], axis=1)
    return np.split(numbers, PARTS, axis=1)


def _round(vectors: DataFrame, books: Codebooks) -> Codebooks:
    """Every entry moved to the floor of its parts' mean; an entry without parts stays."""
    entries, width = books.books[0].shape
    shape = (PARTS, entries, width + 1)

    def add(batches: Iterator[pa.RecordBatch]) -> list[int]:
        searched, totals = books.neighbours(), np.zeros(shape, object)
        for batch in batches:
            if not batch.num_rows:
                continue
            for part, total, book in zip(_parts(batch.column(0), books.length), totals, searched, strict=True):
                code, _, _ = orchard_search(part, book)
                sums = np.zeros((entries, width + 1), part.dtype)
                np.add.at(sums, code, np.concatenate([part, np.ones((len(part), 1), part.dtype)], axis=1))
                total += sums.astype(object)
        return totals.ravel().tolist()

    totals = np.array(exact_sums(vectors, int(np.prod(shape)), add), object).reshape(shape)
    moved = []
    for book, total in zip(books.books, totals.tolist(), strict=True):
        means = [[s // row[-1] for s in row[:-1]] if row[-1] else old for old, row in zip(book.tolist(), total, strict=True)]
        moved.append(_array(means, width))
    return Codebooks(moved, books.length)


def _array(rows: list[list[int]], width: int) -> np.ndarray:
    fits = all(abs(x) < EXACT for row in rows for x in row)
    return np.array(rows, np.int64 if fits else object).reshape(-1, width)


def fit(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> Codebooks | None:
    """Codebooks of all usable vectors; None without one.

    The first entries are the ``ENTRIES`` rows with the smallest ids (all rows if there are fewer),
    rows without an id last, equal ids by vector. Equal entries keep their places; only the first gets parts.
    """
    kept, length = usable(vectors.select(id_col, vector_col), vector_col)
    if not length:
        return None
    first = kept.orderBy(F.asc_nulls_last(id_col), vector_col).limit(ENTRIES).select(vector_col).collect()
    column = pa.array([list(r[0]) for r in first], pa.list_(pa.float64()))
    books = Codebooks(_parts(column, length), length)
    for _ in range(ROUNDS):
        books = _round(kept.select(vector_col), books)
    return books


def encode(vectors: DataFrame, books: Codebooks | None, vector_col: str = "embedding") -> DataFrame:
    """Usable rows with ``code`` (an entry per part, two hexadecimal digits each) and ``error``.

    ``error`` is the squared distance to the coded vector, NULL beyond a long. Rows whose vector is
    NULL, has a NULL or non-finite component or another length than the codebooks have no code and are
    left out; other columns stay, those named ``code`` or ``error`` are replaced.
    """
    kept = [f for f in vectors.schema.fields if f.name not in ("code", "error")]
    schema = T.StructType([*kept, T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    if books is None:
        return vectors.sparkSession.createDataFrame([], schema)
    arrow = to_arrow_schema(schema)
    good, _ = usable(vectors, vector_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searched = books.neighbours()
        for batch in batches:
            if not batch.num_rows:
                continue
            codes, errors = [], []
            for part, book in zip(_parts(batch.column(batch.schema.get_field_index(vector_col)), books.length), searched, strict=True):
                code, near, _ = orchard_search(part, book)
                codes.append(code.astype(np.uint8))
                errors.append(near.astype(object))
            code = [row.tobytes().hex() for row in np.stack(codes, axis=1)]
            error = [in_long(e) for e in np.sum(errors, axis=0).tolist()]
            columns = [batch.column(batch.schema.get_field_index(f.name)).cast(arrow.field(f.name).type) for f in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(code, pa.string()), pa.array(error, pa.int64())], schema=arrow)

    return good.where(F.size(vector_col) == books.length).mapInArrow(run, schema)


def decode(codes: DataFrame, books: Codebooks, code_col: str = "code", vector_col: str = "decoded") -> DataFrame:
    """``codes`` with the coded vectors, the entries over ``SCALE``; codes that are no code of the books give NULL."""
    entries = [F.array(*[F.array(*[F.lit(x / SCALE) for x in e]) for e in book.tolist()]) for book in books.books]
    at = lambda p: F.conv(F.substring(F.col(code_col), 2 * p + 1, 2), 16, 10).cast("int")
    parts = F.concat(*[F.get(e, at(p)) for p, e in enumerate(entries)])
    whole = F.length(code_col) == 2 * PARTS
    return codes.withColumn(vector_col, F.when(whole, F.slice(parts, 1, books.length)))


def compress(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """(id, label, code, error, label_error, codebooks_sha256), one row per usable vector.

    ``label_error`` is the sum of the errors of equal labels, NULLs together; NULL beyond a long.
    Defined cases: rows with a NULL or non-finite component go, and so do vectors of another than
    the most frequent length; rows that share an id each have a row; a length that does not divide into
    ``PARTS`` is filled up with zeros; an empty table gives an empty table; further columns are ignored.
    """
    rows = vectors.select(id_col, label_col, vector_col)
    books = fit(rows, id_col, vector_col)
    coded = stage(encode(rows, books, vector_col).drop(vector_col))
    sums = coded.groupBy(F.col(label_col).alias("_label")).agg(F.try_sum("error").alias("_sum"), F.bool_or(F.isnull("error")).alias("_far"))
    sums = sums.select("_label", F.when(~F.col("_far"), F.col("_sum")).alias("label_error"))
    joined = coded.join(sums, F.col(label_col).eqNullSafe(F.col("_label")))
    return joined.drop("_label").withColumn("codebooks_sha256", F.lit(books.digest() if books else None).cast("string"))
