import hashlib

import duckdb
import numpy as np
import pytest

from hourgrid.llm import queries as registered
from hourgrid.llm import vector_codes
from hourgrid.llm.vector_codes import Neighbours, compress, decode, encode, fit, orchard_search

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error string"


def nearest(points, entries):
    far = [[sum((int(a) - int(b)) ** 2 for a, b in zip(p, e, strict=True)) for e in entries] for p in points]
    return [row.index(min(row)) for row in far], [min(row) for row in far]


@pytest.mark.parametrize("spread, dtype", [(3, np.int64), (5000, np.int64), (10**13, object)])
def test_orchard_search_equals_all_distances(spread, dtype):
    rng = np.random.default_rng(1)
    for count in (1, 2, 16, 40):
        entries = rng.integers(-spread, spread + 1, (count, 3)).astype(dtype)
        entries[count // 2] = entries[0]
        points = rng.integers(-spread, spread + 1, (200, 3)).astype(dtype)
        code, far, measured = orchard_search(points, Neighbours.of(entries))
        assert (code.tolist(), far.tolist()) == nearest(points.tolist(), entries.tolist())
        assert measured <= 200 * count


def test_far_entries_are_not_measured():
    rng = np.random.default_rng(2)
    centres = rng.normal(0, 100_000, (64, 8)).astype(np.int64)
    points = centres[rng.integers(0, 64, 2000)] + rng.integers(-50, 50, (2000, 8))
    code, _, measured = orchard_search(points, Neighbours.of(centres))
    assert code.tolist() == nearest(points.tolist(), centres.tolist())[0]
    assert measured < 2000 * 64 / 2


def plain(rows):
    """The contract in plain Python: (id, code, error, label error) rows and the digest."""
    rows = [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    whole = [[int(np.floor(4096 * float(x))) for x in r[1]] for r in rows]
    width = len(whole[0]) // 8
    parts = [[v[p * width : p * width + width] for v in whole] for p in range(8)]
    first = sorted(range(len(rows)), key=lambda i: rows[i][0])[:16]
    books = [[part[i] for i in first] for part in parts]
    for _ in range(6):
        for p, part in enumerate(parts):
            code, _ = nearest(part, books[p])
            for k in range(len(first)):
                own = [v for v, c in zip(part, code, strict=True) if c == k]
                if own:
                    books[p][k] = [sum(column) // len(own) for column in zip(*own, strict=True)]
    found = [nearest(part, book) for part, book in zip(parts, books, strict=True)]
    errors = [sum(f[1][i] for f in found) for i in range(len(rows))]
    labels = {r[2]: sum(e for e, o in zip(errors, rows, strict=True) if o[2] == r[2]) for r in rows}
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return {(r[0], "".join(f"{f[0][i]:02x}" for f in found), errors[i], labels[r[2]]) for i, r in enumerate(rows)}, digest


def test_equals_plain_rounds(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(0, 1, 16).tolist(), [None, 0, 1][i % 3], "x", None) for i in range(120)]
    rows += [(200 + i, rows[5][1], 7, None, None) for i in range(60)]
    rows += [(300, None, 1, None, None), (301, [None] * 16, 1, None, None), (302, [float("nan")] * 16, 1, None, None)]
    rows += [(303, [float("inf")] * 16, 1, None, None), (304, [1.0] * 8, 1, None, None), (305, [], 1, None, None)]
    frame = spark.createDataFrame(rows, SCHEMA)
    seen = {r["vec_id"]: r["embedding"] for r in frame.collect()}
    want, digest = plain([(r[0], seen[r[0]], r[2]) for r in rows if r[0] not in (304, 305)])
    got = compress(frame).collect()
    assert {(r["vec_id"], r["code"], r["error"], r["label_error"]) for r in got} == want
    assert {r["codebooks_sha256"] for r in got} == {digest} and len(got) == 180


def test_given_embeddings_equal_sql(spark, sf_dir):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    got = registered.queries()["op11_vector_codes"](spark, sf_dir)
    columns = ", ".join(got.columns)
    want = duck.execute(f"SELECT {columns} FROM ({registered.oracle_sql()['op11_vector_codes']})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 0


def test_huge_components_odd_lengths_and_equal_ids(spark):
    rows = [(1, [1e30, -1e30, 0.5], 1, None, None), (1, [1.0, 2.0, 3.0], 1, None, None), (None, [0.0, -0.0, 1.5], None, None, None)]
    got = compress(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 3 and all(r["error"] == 0 for r in got)
    wide = spark.createDataFrame([(i, [float(i) * 1e30] * 8, 0, None, None) for i in range(40)], SCHEMA)
    assert {r["error"] is None for r in compress(wide).collect()} == {True, False}


def test_codes_keep_other_columns_and_decode(spark):
    rows = [(i, [i % 4 + 0.25] * 8, i, "old", "old") for i in range(30)]
    frame = spark.createDataFrame(rows, SCHEMA)
    books = fit(frame)
    coded = encode(frame, books)
    assert coded.columns == ["vec_id", "embedding", "label", "code", "error"]
    back = decode(coded, books).collect()
    assert all(r["decoded"] == r["embedding"] and r["error"] == 0 for r in back)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert compress(empty).count() == 0 and fit(empty) is None
    assert compress(spark.createDataFrame([(1, None, 1, None, None)], SCHEMA)).count() == 0
    assert vector_codes.encode(empty, None).columns == empty.columns
