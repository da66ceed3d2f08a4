import numpy as np
import pytest

from hourgrid.llm import queries as registered
from hourgrid.llm.frames import table
from hourgrid.llm.whitening import Centre, fit, solve_rows, whiten, whitened_components

SCHEMA = "vec_id long, embedding array<double>, label int, whitened string, deviation string"


def plain(vectors):
    """x, eigenvalues and components from the covariance of the distinct x vectors."""
    x = np.floor(np.array(vectors, np.float64) * 64).astype(np.int64) + 1_000_000
    distinct = np.unique(x, axis=0)
    n, sums = len(distinct), distinct.sum(axis=0)
    centred = (n * distinct - sums) / n
    values, parts = np.linalg.eigh(centred.T @ centred / n)
    return x, n, sums, values[::-1], parts[:, ::-1]


def compare(rows, ids, vectors, count):
    x, n, sums, values, parts = plain(vectors)
    got = {i: np.zeros(count) for i in ids}
    for row in rows:
        got[row["vec_id"]][row["component"] - 1] = row["whitened"]
        at = ids.index(row["vec_id"])
        assert row["n"] == n and row["deviation"] == int(((n * x[at] - sums) ** 2).sum())
        assert abs(row["explained"] - values[row["component"] - 1] / values.sum()) <= 1e-9
        assert row["identity_error"] <= 1e-9
    want = (n * x - sums) / n @ parts[:, :count] / np.sqrt(values[:count])
    made = np.stack([got[i] for i in ids])
    signs = np.sign((want * made).sum(axis=0))
    assert len(rows) == len(ids) * count and np.abs(want * signs - made).max() < 1e-6


def test_given_embeddings_equal_the_eigenvectors(spark, sf_dir):
    rows = [r for r in table(spark, sf_dir, "embeddings", "vec_id", "embedding").collect()]
    got = registered.queries()["op13_whitening"](spark, sf_dir).collect()
    compare(got, [r["vec_id"] for r in rows], [r["embedding"] for r in rows], 16)


def test_copies_count_once_and_unusable_rows_go(spark):
    rng = np.random.default_rng(4)
    vectors = (rng.normal(0, 1, (60, 5)) * [9, 5, 3, 1, 0.5]).tolist()
    vectors += [vectors[0]] * 200
    rows = [(i, v, None, "x", "y") for i, v in enumerate(vectors)]
    bad = [None, [None] * 5, [float("nan")] * 5, [float("-inf")] * 5, [1.0, 2.0], []]
    rows += [(1000 + i, v, 1, None, None) for i, v in enumerate(bad)]
    compare(whitened_components(spark.createDataFrame(rows, SCHEMA)).collect(), list(range(260)), vectors, 5)


def test_nearly_dependent_dimensions(spark):
    """A condition whose square is far beyond what a plain Cholesky factor of the covariance bears."""
    rng = np.random.default_rng(5)
    base = rng.normal(0, 1e7, (300, 3))
    vectors = np.concatenate([base, base @ rng.normal(0, 1, (3, 2)) + rng.normal(0, 0.5, (300, 2))], axis=1).tolist()
    model = fit(spark.createDataFrame([(v,) for v in vectors], "embedding array<double>"))
    assert model.identity_error < 1e-6
    x, n, sums, *_ = plain(vectors)
    singular = np.linalg.svd((n * x - sums) / n, compute_uv=False) ** 2
    assert np.allclose(model.explained, singular / singular.sum(), rtol=1e-6)


def test_components_without_variance_are_null(spark):
    rows = [(i, [float(i % 7), 2.0, float(i % 7)], 0, None, None) for i in range(50)]
    got = whitened_components(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 150
    assert all((r["whitened"] is not None) == (r["component"] == 1) for r in got)
    assert {r["n"] for r in got} == {7} and all(r["identity_error"] < 1e-9 for r in got)
    same = whitened_components(spark.createDataFrame([(1, [0.5, 0.25], 1, None, None)] * 3, SCHEMA)).collect()
    assert len(same) == 6 and all(r["whitened"] is None and r["explained"] == 0 and r["deviation"] == 0 for r in same)


def test_huge_components(spark):
    rows = [(i, [1e300 * (i - 3), float(i), 3.4e38], 1, None, None) for i in range(8)]
    got = whitened_components(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 24 and any(r["deviation"] is None for r in got)
    assert all(np.isfinite(r["whitened"]) for r in got if r["component"] == 1)


def test_columns_and_empty_tables(spark):
    frame = spark.createDataFrame([(i, [float(i), float(i * i)], i, "a", "b") for i in range(9)], SCHEMA)
    made = whiten(frame, fit(frame))
    assert made.columns == ["vec_id", "embedding", "label", "whitened", "deviation"]
    empty = spark.createDataFrame([], SCHEMA)
    none = whitened_components(empty)
    assert none.count() == 0 and none.columns == whitened_components(frame).columns
    assert none.dtypes == whitened_components(frame).dtypes


@pytest.mark.parametrize("width", [1, 5, 32, 70])
def test_triangular_solve(width):
    rng = np.random.default_rng(6)
    factor = np.triu(rng.normal(0, 1, (width, width))) + 3 * np.eye(width)
    rows = rng.normal(0, 1, (20, width))
    assert np.allclose(solve_rows(rows, factor) @ factor, rows)


def test_deviations_are_exact_up_to_longs():
    centre = Centre(10**9, [10**15], 1 << 40)
    assert centre.deviations(np.array([[10**6 + 3], [10**6 + 4]])) == [9 * 10**18, None]
