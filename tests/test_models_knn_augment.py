import math

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from geotrace.operators import augment as A
from geotrace.operators import knn
from geotrace.operators.models import MultiTargetRegressor, builder, mean_baseline, stacking_builder
from geotrace.operators.validation import metrics_full


def _linear_toy(spark, n=200):
    # hashed pseudo-noise, deterministic
    df = spark.range(n).select(
        F.col("id").cast("string").alias("trajectory_id"),
        *[((F.xxhash64(F.lit(j), "id") % 1000) / 1000.0).alias(f"x{j}") for j in range(3)])
    noise = (F.xxhash64(F.lit(9), "trajectory_id") % 100) / 10000.0
    df = df.withColumn("dx", 2 * F.col("x0") - F.col("x1") + 0.5 + noise)
    df = df.withColumn("dy", F.col("x2") * 3 - 1 + noise)
    return VectorAssembler(inputCols=["x0", "x1", "x2"], outputCol="features").transform(df)


def test_ridge_matches_closed_form(spark):
    df = _linear_toy(spark)
    m = MultiTargetRegressor(builder("Ridge"), ("dx", "dy")).fit(df)
    pdf = df.select("x0", "x1", "x2", "dx").toPandas()
    X = pdf[["x0", "x1", "x2"]].to_numpy()
    y = pdf["dx"].to_numpy()
    Xc, yc = X - X.mean(0), y - y.mean()
    w = np.linalg.solve(Xc.T @ Xc + 1.0 * np.eye(3), Xc.T @ yc)   # sklearn Ridge(alpha=1)
    got = np.array(m.models[0].coefficients)
    assert np.allclose(got, w, rtol=1e-6, atol=1e-8)


def test_models_predict_finite_and_beat_baseline(spark):
    df = _linear_toy(spark)
    for name, over in [("RandomForest", dict(numTrees=10, maxDepth=5)), ("GradientBoosting", dict(maxIter=10)),
                       ("Lasso", {}), ("BaggedGB", dict(maxIter=5)), ("KNN", {})]:
        p = MultiTargetRegressor(builder(name, None, over), ("dx", "dy")).fit(df).transform(df)
        rows = p.select("dx", "pred_dx").collect()
        assert len(rows) == 200 and all(math.isfinite(r["pred_dx"]) for r in rows)
        if name != "Lasso":   # alpha=1 lasso shrinks everything on this scale, as in the reference
            mse = np.mean([(r["dx"] - r["pred_dx"]) ** 2 for r in rows])
            var = np.var([r["dx"] for r in rows])
            assert mse < var, name


def test_stacking_runs(spark):
    df = _linear_toy(spark, 120)
    st = stacking_builder([builder("Ridge"), builder("LinearRegression")], k=3)
    p = MultiTargetRegressor(st, ("dx", "dy")).fit(df).transform(df)
    assert p.where(F.col("pred_dx").isNull()).count() == 0


def test_knn_matches_brute_force(spark):
    rng = np.random.default_rng(0)
    ref = rng.normal(size=(300, 3))
    qry = rng.normal(size=(40, 3))
    y = rng.normal(size=300)
    r = spark.createDataFrame([(f"r{i:03d}", ref[i].tolist(), float(y[i])) for i in range(300)],
                              "rid string, vec array<double>, y double")
    q = spark.createDataFrame([(f"q{i}", qry[i].tolist()) for i in range(40)], "qid string, vec array<double>")
    got = {r_["qid"]: r_["y"] for r_ in knn.knn_predict(q, r, 5, "qid", "rid", "vec", ("y",)).collect()}
    # small blocks force many (query block, reference block) pairs
    got_blocked = {r_["qid"]: r_["y"] for r_ in knn.knn_candidates(q, r, 5, "qid", "rid", "vec", ("y",),
                                                                   block_rows=37)
                   .groupBy("qid").agg(F.avg("y").alias("y")).collect()}
    for i in range(40):
        d = ((ref - qry[i]) ** 2).sum(1)
        want = y[np.argsort(d, kind="stable")[:5]].mean()
        assert got[f"q{i}"] == pytest.approx(want)
        assert got_blocked[f"q{i}"] == pytest.approx(want)


def test_baseline_and_metrics(spark, traj_df):
    train = traj_df([("a", [1.0, 2.0], [1.0, 2.0], 10.0, 20.0), ("b", [1.0, 2.0], [1.0, 2.0], 20.0, 40.0)])
    test = traj_df([("c", [1.0], [1.0], None, None)], split="test")
    b = mean_baseline(train, test).first()
    assert (b["latitude_pred"], b["longitude_pred"]) == (15.0, 30.0)
    pred = spark.createDataFrame([("a", 0.0, 0.0, 0.0, 0.0), ("b", 1.0, 1.0, 1.0, 2.0)],
                                 "trajectory_id string, lat_true double, lon_true double, lat_pred double, "
                                 "lon_pred double")
    m = metrics_full(pred).first()
    assert m["n_samples"] == 2 and m["mse_latitude"] == 0.0 and m["r2_latitude"] == 1.0


def test_augment_keeps_rows_and_ends(traj_df):
    rows = [(f"t{i}", [39.9 + 0.001 * k for k in range(8)], [116.4 + 0.002 * k for k in range(8)], 40.0, 116.5)
            for i in range(40)] + [("empty", [], [], 40.0, 116.5)]
    df = traj_df(rows)
    out = A.augment(df, p=1.0, seed=7)
    got = {r["trajectory_id"]: r for r in out.collect()}
    assert len(got) == 41 and got["empty"]["method"] is None and got["empty"]["path_lat"] == []
    methods = {r["method"] for r in got.values() if r["method"]}
    assert methods == {"jitter", "drop", "rotate"}
    for r in got.values():
        assert r["dest_lat"] == 40.0
        if r["method"] == "drop":
            assert r["path_lat"][0] == 39.9 and r["path_lat"][-1] == pytest.approx(39.907)
            assert 2 <= len(r["path_lat"]) <= 8
        if r["method"] in ("jitter", "rotate"):
            assert len(r["path_lat"]) == 8
    again = {r["trajectory_id"]: r["path_lat"] for r in A.augment(df.repartition(3), p=1.0, seed=7).collect()}
    assert again == {k: v["path_lat"] for k, v in got.items()}


def test_score_and_sample_check(spark):
    from geotrace.operators.models import score
    from geotrace.operators.quality import sample_id_check
    df = _linear_toy(spark)
    m = MultiTargetRegressor(builder("LinearRegression"), ("dx", "dy")).fit(df)
    assert score(m, df) > 0.99
    sub = spark.createDataFrame([("a",), ("b",)], "trajectory_id string")
    sample = spark.createDataFrame([("b",), ("c",)], "trajectory_id string")
    got = {(r["trajectory_id"], r["side"]) for r in sample_id_check(sub, sample).collect()}
    assert got == {("c", "missing_in_submission"), ("a", "not_in_sample")}
    assert sample_id_check(sub, None) is None


def test_grid_knn_hot_cell_and_sparse_queries(spark):
    rng = np.random.default_rng(5)
    hot = rng.normal(0, 0.01, size=(400, 2))            # a third-or-more of the rows in one spot
    spread = rng.uniform(-5, 5, size=(300, 2))
    ref = np.vstack([hot, spread])
    y = rng.normal(size=len(ref))
    qry = np.vstack([rng.normal(0, 0.01, size=(30, 2)), rng.uniform(-5, 5, size=(30, 2)),
                     [[40.0, 40.0], [-30.0, 12.0]]])    # far away: must fall back to the full search
    r = spark.createDataFrame([(f"r{i:04d}", ref[i].tolist(), float(y[i])) for i in range(len(ref))],
                              "rid string, vec array<double>, y double")
    q = spark.createDataFrame([(f"q{i}", qry[i].tolist()) for i in range(len(qry))], "qid string, vec array<double>")
    for block_rows in (20_000, 50):
        c = knn.grid_knn_candidates(q, r, 5, "qid", "rid", "vec", ("y",), block_rows=block_rows)
        got = {row["qid"]: row["y"] for row in c.groupBy("qid").agg(F.avg("y").alias("y")).collect()}
        assert len(got) == len(qry)
        for i in range(len(qry)):
            d = ((ref - qry[i]) ** 2).sum(1)
            order = sorted(range(len(ref)), key=lambda j: (d[j], f"r{j:04d}"))[:5]
            assert got[f"q{i}"] == pytest.approx(y[order].mean()), (i, block_rows)


def test_parameter_resolver_and_model_list():
    from geotrace.operators.models import create_all_models, model_params, tree_count
    assert [tree_count(n) for n in (None, 999, 1000, 4999, 5000)] == [100, 50, 100, 100, 200]
    assert model_params("RandomForest", 10)["numTrees"] == 200          # at least 200 trees for the forest
    assert model_params("HistGradientBoosting", 3000)["maxIter"] == 100
    models = create_all_models(["Ridge", "SVR", "GradientBoosting", "NoSuchModel", "Lasso"], 500,
                               {"GradientBoosting": {"maxIter": 7}}, ensemble=True)
    assert [m.name for m in models] == ["Ridge", "GradientBoosting", "Lasso", "EnsembleVoting"]
