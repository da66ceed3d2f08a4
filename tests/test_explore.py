import numpy as np
import pytest
from pyspark.sql import functions as F

from hourgrid.operators import explore
from hourgrid.queries import inputs


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(7)
    # A third of all rows is one value.
    values = np.concatenate([rng.normal(size=2000), np.full(1000, 0.25)])
    df = spark.createDataFrame([(float(v),) for v in values], "x double").repartition(7)
    row = explore.profile_numeric(df.withColumn("y", F.col("x") * -3), ["x", "y"]).where("column_name = 'x'").first()
    assert [row.q25, row.q50, row.q75] == pytest.approx(list(np.quantile(values, [0.25, 0.5, 0.75])), abs=1e-12)
    assert row.n == 3000 and row.std == pytest.approx(values.std(ddof=1))


def test_selected_ranks_equal_a_sort(spark):
    rng = np.random.default_rng(8)
    special = [0.0, -0.0, 5e-324, -5e-324, 1.7e308, -1.7e308, float("inf"), float("-inf"), 1.0, np.nextafter(1.0, 2.0)]
    values = np.concatenate([rng.normal(size=500) * 10.0 ** rng.integers(-300, 300, 500), special * 3])
    rows = [(float(v), None if i % 5 == 0 else float(-v)) for i, v in enumerate(values)] + [(float("nan"), float("nan")), (None, None)]
    numbers = spark.createDataFrame(rows, "a double, b double").repartition(5)
    got = explore.select_ranks(numbers, {"a": list(range(0, len(values), 13)), "b": [0, 200]})
    in_order, other = np.sort(values), np.sort([r[1] for r in rows[:-2] if r[1] is not None])
    assert all(got["a", r] == in_order[r] for r in range(0, len(values), 13))
    assert got["b", 0] == other[0] and got["b", 200] == other[200]


def test_profile_of_empty_and_single_columns(spark):
    df = spark.createDataFrame([(1.5, None), (float("nan"), None)], "x double, y double")
    rows = explore.profile_numeric(df, ["x", "y"]).collect()
    assert [tuple(r) for r in rows] == [("x", 1, 1.5, None, 1.5, 1.5, 1.5, 1.5, 1.5)]
    assert explore.exact_quantiles(df, ["x", "y"]).collect()[0].q50 == 1.5
    assert explore.profile_numeric(df.where("false"), ["x"]).count() == 0


def test_histogram_matches_numpy(spark, sf_dir):
    rows = inputs.table(spark, sf_dir, "lineitem")
    expected, edges = np.histogram(
        np.minimum([r[0] for r in rows.select("l_extendedprice").collect()], 90000.0), bins=50
    )
    got = explore.histogram(rows, "l_extendedprice", high=90000).orderBy("bin").collect()
    assert [r.n for r in got] == list(expected)
    assert [r.bin_start for r in got] == pytest.approx(list(edges[:-1]))


def test_histogram_of_a_constant(spark):
    got = explore.histogram(spark.range(10).withColumn("x", F.lit(3.0)), "x", bins=4).orderBy("bin").collect()
    assert [r.n for r in got] == list(np.histogram([3.0] * 10, bins=4)[0])


def test_categorical_ties_go_to_the_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "s string")
    row = explore.profile_categorical(df, ["s"]).first()
    assert (row.n, row.n_unique, row.top, row.freq) == (4, 2, "a", 2)
