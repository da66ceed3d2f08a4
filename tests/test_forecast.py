import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourgrid import schemas
from hourgrid.models import boosting
from hourgrid.models.baselines import ExpressionModel
from hourgrid.models.boosting import PoissonBoosting, PoissonBoostingModel
from hourgrid.models.glm import fit_one_hot, fit_poisson_glm
from hourgrid.operators import scoring
from hourgrid.operators.series import demand_features
from hourgrid.plans import evaluate, forecast, layers
from hourgrid.queries import inputs
from hourgrid.queries.forecasts import weighted_history
from hourgrid.tables import store

END = dt.datetime(2025, 1, 10)


def history(spark, values, end=END):
    start = end - dt.timedelta(hours=len(values))
    rows = [(str(start + dt.timedelta(hours=i)), 5, int(v)) for i, v in enumerate(values) if v is not None]
    df = spark.createDataFrame(rows, "h string, pu_location int, trip_count int")
    return df.select(F.col("h").cast("timestamp_ntz").alias("hour_start"), "pu_location", "trip_count")


def test_buffers_are_padded_and_cut(spark):
    assert forecast.history_buffers(history(spark, [1, 2, 3]), END).first().buf == [0.0] * 165 + [1.0, 2.0, 3.0]
    long = forecast.history_buffers(history(spark, range(1, 171)), END).first().buf
    assert long == [float(v) for v in range(3, 171)]


def test_strict_hours_put_values_at_their_hour(spark):
    rows = history(spark, [4, None, 6])
    assert forecast.history_buffers(rows, END).first().buf[-3:] == [0.0, 4.0, 6.0]
    assert forecast.history_buffers(rows, END, strict_hours=True).first().buf[-3:] == [4.0, 0.0, 6.0]


def test_buffer_features(spark):
    state = forecast.history_buffers(history(spark, range(1, 169)), END)
    row = forecast.features_from_buffer(state, dt.datetime(2025, 1, 5, 13)).first()
    assert (row.lag_1h, row.lag_24h, row.lag_168h) == (168.0, 145.0, 1.0)
    assert (row.roll_6h, row.roll_24h, row.roll_168h) == (165.5, 156.5, 84.5)
    assert (row.pickup_hour, row.pickup_dow, row.is_weekend) == (13, 0, True)


def test_buffer_features_equal_exclusive_grid_features(spark, sf_dir):
    """What serving sees for an hour is what training saw for it."""
    filled = inputs.cut_lineage(inputs.filled(spark, sf_dir))
    ts = "2024-01-20 07:00:00"
    served = forecast.features_from_buffer(forecast.history_buffers(filled, ts), ts)
    trained = demand_features(filled, include_current=False).where(f"hour_start = timestamp_ntz'{ts}'")
    names = schemas.BOOSTING_FEATURES
    doubles = [F.round(F.col(n).cast("double"), 9).alias(n) for n in names]
    a, b = served.select(*doubles), trained.select(*doubles)
    assert a.count() == b.count() > 0 and a.exceptAll(b).isEmpty()


def test_recursion_equals_plain_loop_and_survives_plan_cuts(spark, sf_dir):
    filled = inputs.cut_lineage(inputs.filled(spark, sf_dir))
    model = ExpressionModel(weighted_history())
    key = lambda r: (r.pu_location, r.hour_start)
    one_plan = sorted(forecast.recursive_forecast(filled, model, inputs.TRAIN_END, 9).collect(), key=key)
    cut = sorted(forecast.recursive_forecast(filled, model, inputs.TRAIN_END, 9, steps_per_plan=4).collect(), key=key)
    assert one_plan == cut
    start = dt.datetime.fromisoformat(inputs.TRAIN_END)
    expected = {}
    for row in forecast.history_buffers(filled, inputs.TRAIN_END).collect():
        buf = list(row.buf)
        for step in range(9):
            ts = start + dt.timedelta(hours=step)
            yhat = (
                0.45 * buf[-24] + 0.25 * np.mean(buf[-6:]) + 0.2 * np.mean(buf[-168:]) + 0.1 * buf[-1]
                - 0.02 * ts.hour + (0.3 if ts.weekday() >= 5 else 0.0) + 0.001 * row.pu_location
            )
            buf.append(max(yhat, 0.0))
            expected[(row.pu_location, ts)] = buf[-1]
    assert {key(r): r.yhat for r in one_plan} == pytest.approx(expected)


def test_negative_forecasts_are_clipped_on_request(spark):
    rows = history(spark, [1] * 168)
    model = ExpressionModel(F.lit(-1.0))
    assert {r.yhat for r in forecast.recursive_forecast(rows, model, END, 2).collect()} == {0.0}
    free = forecast.recursive_forecast(rows, model, END, 2, clip_at_zero=False)
    assert {r.yhat for r in free.collect()} == {-1.0}


def test_latest_train_end(spark):
    assert forecast.latest_train_end(history(spark, [1, 2])) == END
    with pytest.raises(RuntimeError, match="empty"):
        forecast.latest_train_end(history(spark, [1]).where("false"))


def count_rows(spark, n=4000, seed=3):
    rng = np.random.default_rng(seed)
    a, b, zone = rng.integers(0, 10, n), rng.normal(size=n), rng.integers(1, 12, n)
    y = rng.poisson(np.exp(0.2 * a - 0.3 * (b > 0) + 0.05 * zone - 0.5))
    return spark.createDataFrame(
        [(int(w), float(x), int(z), int(c)) for w, x, z, c in zip(a, b, zone, y)],
        "a int, b double, pu_location int, trip_count int",
    )


def test_boosting_loss_falls_and_beats_the_mean(spark):
    rows = count_rows(spark)
    model = PoissonBoosting(iterations=11, learning_rate=0.3, max_depth=3, checkpoint_every=4).fit(rows, ["a", "b", "pu_location"])
    assert model.n_trees == 11
    assert all(later < earlier for earlier, later in zip(model.train_loss, model.train_loss[1:]))
    mean = rows.agg(F.avg("trip_count")).first()[0]
    scored = model.transform(rows).withColumn("mean", F.lit(mean))
    errors = {r.model: r.rmse for r in scoring.model_comparison(scored, {"boosted": "yhat", "mean": "mean"}).collect()}
    assert errors["boosted"] < 0.9 * errors["mean"]


def test_one_round_is_a_newton_step(spark):
    rows = spark.createDataFrame([(0.0, 1)] * 60 + [(1.0, 5)] * 60, "a double, trip_count int")
    model = PoissonBoosting(iterations=1, learning_rate=1.0, max_depth=1).fit(rows, ["a"])
    mean = 3.0
    got = {r.a: r.yhat for r in model.transform(rows).distinct().collect()}
    assert got == pytest.approx({0.0: mean * math.exp((1 - mean) / mean), 1.0: mean * math.exp((5 - mean) / mean)})


def test_boosting_stops_early_on_held_out_rows(spark):
    model = PoissonBoosting(
        iterations=60, learning_rate=1.0, max_depth=5, min_leaf=1, validation_fraction=0.3, patience=2
    ).fit(count_rows(spark, 600), ["a", "b", "pu_location"])
    assert model.n_trees < 60 and len(model.held_out_loss) == model.n_trees


def plain_tree(x, gradient, curvature, leaves, depth, min_leaf, l2):
    """Splits the leaf with most gain until there are enough leaves; returns {leaf path: (rows, step)}."""

    def best(rows):
        found = None
        g, h = gradient[rows], curvature[rows]
        for f in range(x.shape[1]):
            for cut in np.unique(x[rows, f])[:-1]:
                low = x[rows, f] <= cut
                if min(low.sum(), (~low).sum()) < min_leaf:
                    continue
                parts = [(g[s].sum(), h[s].sum()) for s in (low, ~low)]
                gain = sum(a * a / (b + l2) for a, b in parts) - g.sum() ** 2 / (h.sum() + l2)
                if gain > 0 and (found is None or gain > found[0] + 1e-9):
                    found = (gain, f, cut)
        return found

    open_leaves = {"": (np.arange(len(x)), best(np.arange(len(x))))}
    while len(open_leaves) < leaves:
        able = [(split[0], path) for path, (_, split) in open_leaves.items() if split and len(path) < depth]
        if not able:
            break
        _, path = max(able)
        rows, (_, f, cut) = open_leaves.pop(path)
        low = x[rows, f] <= cut
        for turn, part in (("l", rows[low]), ("r", rows[~low])):
            open_leaves[path + turn] = (part, best(part))
    return {p: (rows, -gradient[rows].sum() / (curvature[rows].sum() + l2)) for p, (rows, _) in open_leaves.items()}


@pytest.mark.parametrize("small", [1 << 17, 700, 0])
@pytest.mark.parametrize("leaves, depth", [(6, 8), (20, 4), (2, 8)])
def test_boosting_equals_a_plain_learner(spark, monkeypatch, leaves, depth, small):
    """Round after round the same leaves, and so the same forecasts, wherever the leaves are grown."""
    monkeypatch.setattr(boosting, "SMALL", small)
    rows = count_rows(spark, 2000, seed=leaves)
    data = rows.toPandas()
    rounds, rate, min_leaf, l2 = 4, 0.3, 25, 1e-4
    # One decimal of b: few enough values for a bin of its own each.
    rows = rows.withColumn("b", F.round("b", 1))
    x = np.column_stack([data.a, np.round(data.b, 1), data.pu_location]).astype(float)
    y = data.trip_count.to_numpy(float)
    score = np.full(len(y), math.log(y.mean()))
    for _ in range(rounds):
        mean = np.exp(score)
        for part, step in plain_tree(x, mean - y, mean, leaves, depth, min_leaf, l2).values():
            score[part] += rate * step
    model = PoissonBoosting(
        iterations=rounds, learning_rate=rate, max_leaves=leaves, max_depth=depth, min_leaf=min_leaf, l2=l2, checkpoint_every=3
    ).fit(rows, ["a", "b", "pu_location"])
    got = {(r.a, r.b, r.pu_location): r.yhat for r in model.transform(rows).collect()}
    want = {(int(a), float(b), int(z)): math.exp(s) for (a, b, z), s in zip(x.tolist(), score, strict=True)}
    assert got == pytest.approx(want, rel=1e-9)
    assert model.train_loss[-1] == pytest.approx(float(np.mean(np.exp(score) - y * score)), rel=1e-9)


def test_trees_keep_to_leaves_depth_and_rows(spark):
    rows = count_rows(spark, 3000, seed=8)
    fitted = PoissonBoosting(iterations=3, max_leaves=9, max_depth=4, min_leaf=100).fit(rows, ["a", "b", "pu_location"])
    for tree in fitted.ensemble.trees:
        assert tree.numNodes <= 2 * 9 - 1 and tree.depth <= 4
    wide = PoissonBoosting(iterations=1, max_leaves=63, max_depth=8, min_leaf=1, max_bins=16).fit(rows, ["b"])
    assert 16 <= wide.ensemble.trees[0].numNodes <= 31  # quantile bins: at most sixteen leaves


def test_stored_models_give_equal_forecasts(spark, tmp_path):
    rows = count_rows(spark, 1000)
    model = PoissonBoosting(iterations=5, max_depth=3).fit(rows, ["a", "b", "pu_location"])
    model.save(spark, str(tmp_path / "m"))
    model.save(spark, str(tmp_path / "m"))
    again = PoissonBoostingModel.load(spark, str(tmp_path / "m"))
    one, two = ([r.yhat for r in m.transform(rows).orderBy("a", "b", "pu_location").collect()] for m in (model, again))
    assert one == two and again.train_loss == model.train_loss and again.n_trees == 5


def test_one_fit_serves_equal_rows_and_settings(spark, tmp_path, monkeypatch):
    rows = count_rows(spark, 500)
    fits = []
    whole_fit = PoissonBoosting.fit
    monkeypatch.setattr(PoissonBoosting, "fit", lambda self, *a: fits.append(1) or whole_fit(self, *a))
    folder, features = str(tmp_path / "models"), ["a", "b", "pu_location"]
    booster = PoissonBoosting(iterations=2, max_depth=2)
    first = forecast.stored_model(rows, booster, folder, features)
    second = forecast.stored_model(rows.repartition(3), booster, folder, features)
    assert len(fits) == 1 and first.train_loss == second.train_loss
    forecast.stored_model(rows.where("a > 2"), booster, folder, features)
    forecast.stored_model(rows, PoissonBoosting(iterations=3, max_depth=2), folder, features)
    assert len(fits) == 3


def test_boosting_of_zeros_is_constant(spark):
    rows = spark.createDataFrame([(float(i), 0) for i in range(100)], "a double, trip_count int")
    assert {r.yhat for r in PoissonBoosting().fit(rows, ["a"]).transform(rows).collect()} == {0.0}
    with pytest.raises(RuntimeError, match="no complete"):
        PoissonBoosting().fit(rows.where("false"), ["a"])


def test_one_hot_drops_the_smallest_zone(spark):
    zones = spark.createDataFrame([(2,), (10,), (7,)], "pu_location int")
    encoder = fit_one_hot(zones)
    assert encoder.names == ["pu_location_7", "pu_location_10"]
    asked = spark.createDataFrame([(2,), (7,), (10,), (99,)], "pu_location int")
    got = {r.pu_location: list(r.zone_vector.toArray()) for r in encoder.transform(asked).collect()}
    assert got == {2: [0, 0], 7: [1, 0], 10: [0, 1], 99: [0, 0]}


def test_glm_reaches_the_penalised_optimum(spark):
    rows = count_rows(spark, 1500)
    alpha = 0.05
    model = fit_poisson_glm(rows, numeric=["a", "b"], alpha=alpha)
    data = rows.toPandas()
    zones = sorted(data.pu_location.unique())
    x = np.column_stack([data.a, data.b, *[(data.pu_location == z) for z in zones[1:]]]).astype(float)
    y = data.trip_count.to_numpy(float)
    design = np.column_stack([np.ones(len(y)), x])
    penalty = np.diag([0.0] + [alpha] * x.shape[1])
    beta = np.zeros(design.shape[1])
    beta[0] = np.log(y.mean())
    for _ in range(50):
        mu = np.exp(design @ beta)
        gradient = design.T @ (mu - y) / len(y) + penalty @ beta
        beta -= np.linalg.solve(design.T @ (design * mu[:, None]) / len(y) + penalty, gradient)
    assert list(model.regression.coefficients) == pytest.approx(list(beta[1:]), abs=1e-5)
    assert model.regression.intercept == pytest.approx(beta[0], abs=1e-5)
    table = model.coefficients(spark).collect()
    assert [r.coefficient for r in table] == sorted((r.coefficient for r in table), reverse=True)
    assert len(table) == 2 + len(zones) - 1


def raw_trips(spark, sf_dir):
    trips = inputs.two_months(inputs.trips(spark, sf_dir))
    return trips.select(
        F.col("pickup_ts").alias("tpep_pickup_datetime"), F.col("dropoff_ts").alias("tpep_dropoff_datetime"),
        F.col("pu_location").alias("pulocationid"), F.col("do_location").alias("dolocationid"),
        "trip_distance", "fare_amount", "total_amount", "ingest_month",
    )


def test_layers_forecasts_and_evaluation_end_to_end(spark, sf_dir, database):
    names = {n: f"{database}.{n}" for n in ("raw", "trips", "mart", "trip_features", "features", "predictions", "metrics")}
    raw = raw_trips(spark, sf_dir)
    store.create_like(raw, names["raw"])
    store.bulk_append(raw, names["raw"])
    jan = dt.date(2024, 1, 1)
    for _ in range(2):  # running a stage again changes nothing
        n_trips = layers.build_trips(spark, jan, names["raw"], names["trips"])
        n_mart = layers.build_demand(spark, jan, names["trips"], names["mart"])
        n_trip_features = layers.build_trip_features(spark, jan, names["trips"], names["trip_features"])
        n_features = layers.build_demand_features(spark, jan, names["mart"], names["features"], include_current=False)
        assert spark.table(names["trips"]).count() == n_trips == 1000
        assert spark.table(names["mart"]).count() == n_mart
        assert spark.table(names["trip_features"]).count() == n_trip_features
        assert spark.table(names["features"]).count() == n_features == 744 * spark.table(names["mart"]).select("pu_location").distinct().count()

    train_end = dt.datetime(2024, 1, 29)
    booster = PoissonBoosting(iterations=2, max_depth=3)
    run_ts = forecast.run_recursive(spark, names["features"], names["predictions"], train_end, 6, booster)
    assert run_ts is not None
    assert forecast.run_recursive(spark, names["features"], names["predictions"], train_end, 6, booster) is None
    replay_ts = forecast.run_replay(spark, train_end, names["features"], names["predictions"], 6, booster)
    stored = spark.table(names["predictions"])
    zones = n_features // 744
    assert {r.model_name: r["count"] for r in stored.groupBy("model_name").count().collect()} == {
        forecast.RECURSIVE_MODEL: 6 * zones, forecast.REPLAY_MODEL: 6 * zones,
    }
    # The first recursive hour knows exactly what the replay row knows.
    first = stored.where("hour_start = timestamp_ntz'2024-01-29 00:00:00'").groupBy("pu_location").agg(
        (F.max("yhat") - F.min("yhat")).alias("gap")
    )
    assert first.agg(F.max("gap")).first()[0] < 1e-9

    truth = spark.table(names["features"])
    latest = evaluate.evaluate_latest(stored, truth)
    assert latest.metrics.first().rows_joined == 6 * zones
    assert latest.joined.select("run_ts").distinct().first().run_ts.timestamp() == pytest.approx(replay_ts.timestamp())
    of_model = evaluate.evaluate_latest(stored, truth, forecast.RECURSIVE_MODEL)
    assert of_model.worst_zones.count() == min(20, zones)
    for _ in range(2):
        evaluate.write_run_metrics(evaluate.run_metrics(of_model.joined), names["metrics"])
    evaluate.write_run_metrics(evaluate.run_metrics(latest.joined), names["metrics"])
    assert spark.table(names["metrics"]).count() == 2
    with pytest.raises(RuntimeError, match="no observed rows"):
        evaluate.evaluate_run(stored, truth, dt.datetime(2000, 1, 1))
    with pytest.raises(RuntimeError, match="no stored runs"):
        evaluate.evaluate_latest(stored.where("false"), truth)


def test_recursive_upsert_replaces_the_same_forecast(spark, database):
    table = f"{database}.predictions"
    rows = history(spark, [2] * 168)
    args = (forecast.RECURSIVE_MODEL, END, 2)
    for run, value in ((dt.datetime(2025, 1, 10, 1), 1.0), (dt.datetime(2025, 1, 10, 2), 3.0)):
        made = forecast.recursive_forecast(rows, ExpressionModel(F.lit(value)), END, 2)
        forecast.write_predictions(
            forecast.as_predictions(made, run, *args), table, schemas.PREDICTION_IDENTITY_KEY, ["yhat", "run_ts"]
        )
    stored = spark.table(table).collect()
    assert len(stored) == 2 and {r.yhat for r in stored} == {3.0}
    assert forecast.already_forecast(spark.table(table), *args)
    assert not forecast.already_forecast(spark.table(table), forecast.RECURSIVE_MODEL, END, 24)


def test_second_run_leaves_the_files_of_the_first(spark, database):
    from hourgrid.plans import forecast

    table = f"{database}.p"
    rows = spark.createDataFrame(
        [(dt.datetime(2025, 1, 25, 0), 1, 2.0)], "hour_start timestamp_ntz, pu_location int, yhat double"
    )
    files = []
    for day in (25, 26):
        end = dt.datetime(2025, 1, day)
        run = dt.datetime(2025, 2, day, tzinfo=dt.timezone.utc)
        made = forecast.as_predictions(rows, run, "m", end, 24)
        keys = [*forecast.schemas.PREDICTION_IDENTITY_KEY, "train_day"]
        forecast.write_predictions(made, table, keys, ["yhat", "run_ts"])
        files.append(set(spark.table(table).inputFiles()))
    assert spark.table(table).count() == 2 and files[0] < files[1]


def test_strict_history_adds_up_repeated_hours(spark):
    from hourgrid.plans import forecast

    hour = dt.datetime(2025, 1, 24, 23)
    rows = spark.createDataFrame([(hour, 1, 2), (hour, 1, 3)], "hour_start timestamp_ntz, pu_location int, trip_count int")
    buf = forecast.history_buffers(rows, dt.datetime(2025, 1, 25), strict_hours=True).first()["buf"]
    assert buf[-1] == 5.0 and sum(buf) == 5.0


def test_glm_of_many_zones_has_no_limit(spark):
    zones = 10_000
    rows = spark.range(40_000).select(
        (F.col("id") % zones).cast("int").alias("pu_location"),
        (F.col("id") % 7).cast("double").alias("a"),
        F.pmod(F.xxhash64("id"), F.lit(9)).cast("int").alias("trip_count"),
    )
    model = fit_poisson_glm(rows, numeric=["a"], alpha=0.01)
    table = model.coefficients()
    assert table.count() == zones
    with pytest.raises(ValueError, match="DataFrame"):
        model.regression.coefficients  # noqa: B018
    # At the optimum the residuals of a zone balance its penalty.
    scored = model.transform(rows)
    n = rows.count()
    balance = scored.groupBy("pu_location").agg(F.sum(F.col("yhat") - F.col("trip_count")).alias("g")).join(model.regression.effects, "pu_location")
    worst = balance.where("pu_location > 0").agg(F.max(F.abs(F.col("g") / n + 0.01 * F.col("effect")))).first()[0]
    assert worst < 1e-9
    total = scored.agg(F.sum(F.col("yhat") - F.col("trip_count"))).first()[0]
    assert abs(total / n) < 1e-9


def test_glm_equals_sparks_regression_on_fifty_zones(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GeneralizedLinearRegression

    rng = np.random.default_rng(9)
    zone, a = rng.integers(1, 51, 5000), rng.normal(size=5000)
    y = rng.poisson(np.exp(0.3 * a + 0.02 * zone))
    rows = spark.createDataFrame(
        [(float(x), int(z), int(c)) for x, z, c in zip(a, zone, y, strict=True)], "a double, pu_location int, trip_count int"
    )
    alpha = 0.02
    mean = rows.agg(F.avg("trip_count")).first()[0]
    ready = VectorAssembler(inputCols=["a", "zone_vector"], outputCol="features").transform(fit_one_hot(rows).transform(rows))
    spark_own = GeneralizedLinearRegression(
        family="poisson", link="log", labelCol="trip_count", regParam=alpha / mean, maxIter=200, tol=1e-12
    ).fit(ready)
    model = fit_poisson_glm(rows, numeric=["a"], alpha=alpha)
    assert model.regression.coefficients == pytest.approx(list(spark_own.coefficients), abs=1e-6)
    assert model.regression.intercept == pytest.approx(spark_own.intercept, abs=1e-6)


def test_one_hot_of_many_zones(spark):
    frame = spark.range(20_000).select((F.col("id") * 3).cast("int").alias("pu_location"))
    encoder = fit_one_hot(frame)
    asked = spark.createDataFrame([(0,), (3,), (59_997,), (1,), (None,)], "pu_location int")
    got = {r.pu_location: r.zone_vector for r in encoder.transform(asked).collect()}
    assert all(v.size == 19_999 for v in got.values())
    assert list(got[3].indices) == [0] and list(got[59_997].indices) == [19_998]
    assert all(not len(got[z].indices) for z in (0, 1, None))


def test_glm_edge_cases(spark):
    one_zone = spark.createDataFrame([(float(i % 3), 4, i % 5) for i in range(50)], "a double, pu_location int, trip_count int")
    model = fit_poisson_glm(one_zone, numeric=["a"])
    assert {r.effect for r in model.regression.effects.collect()} == {0.0}
    assert model.transform(one_zone.withColumn("yhat", F.lit("x"))).where("yhat > 0").count() == 50
    zeros = one_zone.withColumn("trip_count", F.lit(0))
    assert {r.yhat for r in fit_poisson_glm(zeros, numeric=["a"]).transform(zeros).collect()} == {0.0}
    with pytest.raises(RuntimeError, match="no complete"):
        fit_poisson_glm(one_zone.where("false"), numeric=["a"])
