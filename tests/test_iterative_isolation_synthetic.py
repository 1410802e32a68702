import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from geotrace.operators.isolation import add_isolation_mask
from geotrace.operators.iterative import AdaBoostR2, BayesianRidge
from geotrace.sources.synthetic import create_sample_data


def _toy(spark, n=300):
    df = spark.range(n).select(
        F.col("id").cast("string").alias("trajectory_id"),
        *[((F.xxhash64(F.lit(j), "id") % 1000) / 500.0).alias(f"x{j}") for j in range(3)])
    df = df.withColumn("y", 3 * F.col("x0") - 2 * F.col("x1") + 0.5 * F.col("x2") + 1.0
                       + (F.xxhash64(F.lit(7), "trajectory_id") % 100) / 10000.0)
    return VectorAssembler(inputCols=["x0", "x1", "x2"], outputCol="features").transform(df)


def test_bayesian_ridge_recovers_linear_signal(spark):
    df = _toy(spark)
    m = BayesianRidge(labelCol="y").fit(df)
    assert np.allclose(m.coef, [3.0, -2.0, 0.5], atol=1e-2)
    pdf = df.select("x0", "x1", "x2", "y").toPandas()
    X = pdf[["x0", "x1", "x2"]].to_numpy()
    # the evidence-optimal penalty is tiny here, so the fit is close to least squares
    ols = np.linalg.lstsq(np.c_[X, np.ones(len(X))], pdf["y"].to_numpy(), rcond=None)[0]
    assert np.allclose(m.coef, ols[:3], atol=1e-3)
    p = m.transform(df).select("y", "prediction").toPandas()
    assert np.abs(p["y"] - p["prediction"]).max() < 0.05


def test_adaboost_beats_the_mean(spark):
    df = _toy(spark, 200)
    m = AdaBoostR2(labelCol="y", n_estimators=8).fit(df)
    p = m.transform(df).select("y", "prediction").toPandas()
    assert p["prediction"].notna().all()
    assert ((p["y"] - p["prediction"]) ** 2).mean() < p["y"].var()
    assert len(m.trees) == len(m.weights) >= 1


def test_isolation_forest_flags_planted_outliers(spark):
    rows = [(f"n{i}", float(i % 7), float(i % 5)) for i in range(300)]
    rows += [("far1", 100.0, 100.0), ("far2", -90.0, 120.0), ("far3", 80.0, -110.0)]
    df = spark.createDataFrame(rows, "trajectory_id string, a double, b double")
    out = add_isolation_mask(df, ["a", "b"], contamination=0.01)
    flagged = {r["trajectory_id"] for r in out.where("is_features_isolation").collect()}
    assert {"far1", "far2", "far3"} <= flagged
    assert len(flagged) <= 6
    assert out.count() == 303


def test_synthetic_sample_rules(spark):
    df = create_sample_data(spark, 50, 10, seed=42)
    rows = df.collect()
    train = [r for r in rows if r["split"] == "train"]
    test = [r for r in rows if r["split"] == "test"]
    assert len(train) == 50 and len(test) == 10
    assert train[0]["trajectory_id"].startswith("train_") and test[0]["trajectory_id"].startswith("test_")
    for r in rows:
        n = len(r["path_lat"])
        assert 5 <= n <= 19 and len(r["path_lon"]) == n
        assert 38 <= r["path_lat"][0] <= 42 and -75 <= r["path_lon"][0] <= -71
        steps = np.diff(r["path_lat"])
        assert ((steps >= -0.01 - 1e-12) & (steps <= 0.02 + 1e-12)).all()
    for r in train:
        lo = r["path_lat"][-1] + 1 * (r["path_lat"][-1] - r["path_lat"][0])
        hi = r["path_lat"][-1] + 3 * (r["path_lat"][-1] - r["path_lat"][0])
        assert min(lo, hi) - 1e-9 <= r["dest_lat"] <= max(lo, hi) + 1e-9
    assert all(r["dest_lat"] is None for r in test)
    again = create_sample_data(spark, 50, 10, seed=42, num_partitions=3).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))
    assert pytest is not None


def test_mlp_learns_linear_signal(spark):
    from geotrace.operators.mlp import MLPRegressor
    df = _toy(spark, 200)
    m = MLPRegressor(labelCol="y", hidden=(16, 8), learning_rate=0.01, max_iter=60).fit(df)
    p = m.transform(df).select("y", "prediction").toPandas()
    assert p["prediction"].notna().all()
    assert ((p["y"] - p["prediction"]) ** 2).mean() < 0.5 * p["y"].var()


def test_mlp_beats_the_mean_at_default_settings_on_targets_in_metres(spark):
    import numpy as np
    from pyspark.ml.feature import VectorAssembler

    from geotrace.operators.mlp import MLPRegressor
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 3))
    y = 4000 * np.abs(x[:, 0]) - 2500 * x[:, 1] + 9000 + rng.normal(size=600) * 100
    df = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y, strict=True)], "a double, b double, c double, y double")
    df = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)
    rows = MLPRegressor(labelCol="y").fit(df).transform(df).select("y", "prediction").collect()
    error = np.mean([(r.y - r.prediction) ** 2 for r in rows])
    assert error < 0.05 * np.var(y)


def test_partition_sums_are_whole_with_and_without_the_middle_level(spark):
    import numpy as np

    from geotrace.operators.partsum import summed
    df = spark.range(0, 1000, 1, 40).selectExpr("id * 1.0 AS x")

    def part(it):
        return np.array([sum(float(p["x"].sum()) for p in it), 1.0])
    for tree in (True, False):
        assert summed(df, part, 2, tree).tolist() == [499500.0, 40.0]
    assert summed(df.where("x < 0"), part, 2).tolist() == [0.0, 40.0]
