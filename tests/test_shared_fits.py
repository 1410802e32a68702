"""Work that several targets, folds or nodes share is done once."""
import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from geotrace.operators import ensembles as E
from geotrace.operators import knn, pivot_knn
from geotrace.operators import trees as K
from geotrace.operators.mlp import MLPBuilder
from geotrace.operators.models import MultiTargetRegressor, TreeBuilder, builder


def frame(spark, n=240, p=4):
    rng = np.random.default_rng(11)
    X = np.round(rng.normal(size=(n, p)), 2)
    Y = np.c_[X[:, 0] * 3 + (X[:, 1] > 0.3) * 5 + rng.normal(0, 0.1, n), X[:, 2] * 10 - X[:, 3] ** 2]
    rows = [(f"t{i}", i % 3, X[i].tolist(), *map(float, Y[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "trajectory_id string, fold int, x array<double>, dx double, dy double")
    return df.withColumn("features", array_to_vector("x")).repartition(4, "trajectory_id")


def counted_jobs(spark, tag, run):
    spark.sparkContext.setJobGroup(tag, "")
    out = run()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(tag))


@pytest.mark.parametrize("g", [K.Grower("boost", 4, 5, 0.3, min_leaf=3), K.Grower("boost", 3, leaves=9, rate=0.3, min_leaf=4),
                               K.Grower("boost", 3, 4, 0.3, l1=0.5, l2=1.5, min_weight=3.0, tree_features=0.7, bags=2)])
def test_only_the_smaller_child_is_summed_from_its_rows(monkeypatch, g):
    rng = np.random.default_rng(2)
    n = 3000
    X = rng.normal(size=(n, 5))
    Y = np.c_[X[:, 0] * 3 + (X[:, 1] > 0.3) * 5 + rng.normal(0, 0.1, n)]
    edges = [np.quantile(x, np.arange(1, 64) / 64) for x in X.T]
    B, ids, values = E.bin_rows(X, edges), rng.integers(0, 1 << 60, n).astype(np.uint64), np.tile(np.arange(256.0), (5, 1))
    largest = float(np.abs(Y).max())
    rows, summed = [], K.dense_sums

    def counted(B, some, *rest):
        rows.append(len(some))
        return summed(B, some, *rest)

    monkeypatch.setattr(K, "dense_sums", counted)
    found, total = [], []
    for kept in (0, K.KEPT_CELLS):
        monkeypatch.setattr(K, "KEPT_CELLS", kept)
        rows.clear()
        found.append(K.fitted(g, ids, B, K.rounded_targets(Y, largest), largest, values))
        total.append(sum(rows))
    assert total[1] < 0.8 * total[0]
    for a, b in zip(found[0].trees, found[1].trees, strict=True):
        assert all((getattr(a, c) == getattr(b, c)).all() for c in ("feature", "cut", "left", "value")) and len(a.feature) > 5


def test_parts_share_copies_of_the_rows(spark, monkeypatch):
    d = E.design(frame(spark), "features", ("dx", "dy"), "fold")
    jobs = [E.Job(g, f) for g in (K.Grower("boost", 3, 3, 0.3, bags=4), K.Grower("bag", 60, 4, joint=True)) for f in (0, 1, None)]
    parts = E.parts_of(jobs, 2)
    dealt = E._dealt(parts, 4, 5)
    assert sorted(i for x in dealt for i in x) == list(range(len(parts))) and len(dealt) == 5 and all(dealt)
    apart = E.fit_many(d, jobs)
    monkeypatch.setattr(E, "COPIED_BYTES", 1)
    monkeypatch.setattr(E, "GROUPS_A_CORE", 1)
    shared = E.fit_many(d, jobs)
    a, b = (sorted((r["job"], r["row"], r["p0"], r["p1"]) for r in x.out.collect()) for x in (apart, shared))
    assert len(a) == 4 * 80 and np.allclose(a, b, rtol=1e-12)
    assert apart.pieces.keys() == shared.pieces.keys() == {2, 5}


def test_adaboost_in_waves_is_that_of_tasks(spark, monkeypatch):
    df = frame(spark)
    d = E.design(df, "features", ("dx", "dy"), "fold")
    jobs = [E.Job(K.Grower("adaboost", 12, 3, 1.0)), E.Job(K.Grower("adaboost", 3, 2, 0.5), 1), E.Job(K.Grower("boost", 2, 3, 0.3))]
    near, far = E.fit_many(d, jobs), E.fit_many(d, jobs, memory_rows=0)
    for i in near.pieces:
        for a, b in zip(near.pieces[i], far.pieces[i], strict=True):
            assert len(a.ensemble.trees) == len(b.ensemble.trees) > 1
            assert (a.ensemble.weights is None) == (i == 2) and np.allclose(a.ensemble.weights or 0, b.ensemble.weights or 0, rtol=1e-6)
            for x, y in zip(a.ensemble.trees, b.ensemble.trees, strict=True):
                assert (x.feature == y.feature).all() and (x.cut == y.cut).all() and np.allclose(x.value, y.value, rtol=1e-6, atol=1e-6)
    a, b = (sorted((r["row"], r["p0"], r["p1"]) for r in x.out.collect()) for x in (near, far))
    assert len(a) == 80 and np.allclose(a, b, rtol=1e-6)
    # beyond memory the query's estimator takes the same way
    build = TreeBuilder("AdaBoost", dict(n_estimators=5, learning_rate=1.0))
    small = MultiTargetRegressor(build).fit(df).transform(df).select("trajectory_id", "pred_dx", "pred_dy").orderBy("trajectory_id").collect()
    monkeypatch.setattr(E, "MEMORY_ROWS", 0)
    large = MultiTargetRegressor(build).fit(df).transform(df).select("trajectory_id", "pred_dx", "pred_dy").orderBy("trajectory_id").collect()
    assert np.allclose([r[1:] for r in small], [r[1:] for r in large], rtol=1e-6)


def test_both_nets_train_in_the_same_jobs(spark):
    df = frame(spark)
    build = MLPBuilder(dict(hidden=(8, 4), max_iter=4))
    one, jobs_of_one = counted_jobs(spark, "one", lambda: build(df, "dx").setPredictionCol("pred_dx").fit(df))
    both, jobs_of_both = counted_jobs(spark, "both", lambda: MultiTargetRegressor(build).fit(df))
    assert jobs_of_both == jobs_of_one
    other = build(df, "dy").setPredictionCol("pred_dy").fit(df)
    alone = other.transform(one.transform(df)).select("trajectory_id", "pred_dx", "pred_dy").orderBy("trajectory_id").collect()
    assert alone == both.transform(df).select("trajectory_id", "pred_dx", "pred_dy").orderBy("trajectory_id").collect()


def test_one_search_serves_both_targets(spark, monkeypatch):
    df = frame(spark)
    searches, find = [], pivot_knn.pivot_knn_candidates
    monkeypatch.setattr(pivot_knn, "pivot_knn_candidates", lambda *a, **k: searches.append(1) or find(*a, **k))
    rows = MultiTargetRegressor(builder("KNN")).fit(df).transform(df).select("x", "dx", "dy", "pred_dx", "pred_dy").collect()
    assert len(searches) == 1
    X, Y = np.array([r["x"] for r in rows]), np.array([[r["dx"], r["dy"]] for r in rows])
    near = np.argsort(((X[:, None] - X[None]) ** 2).sum(axis=2), axis=1, kind="stable")[:, :5]
    assert np.allclose([[r["pred_dx"], r["pred_dy"]] for r in rows], Y[near].mean(axis=1))


@pytest.mark.parametrize("kind", ["plain", "far", "copies", "missing"])
def test_nearest_by_products_are_the_exact_ones(kind, monkeypatch):
    rng = np.random.default_rng(4)
    r, q = rng.normal(size=(900, 9)), rng.normal(size=(70, 9))
    if kind == "far":
        r[::7] *= 1e9
        q[::5] += 1e7
    if kind == "copies":
        r, q = np.round(r[:, :2]), np.round(q[:, :2])
    if kind == "missing":
        r[3, 2], r[5, 1] = np.nan, np.inf
    d2 = np.zeros((len(q), len(r)))
    for j in range(r.shape[1]):
        diff = q[:, j][:, None] - r[None, :, j]
        d2 += diff * diff
    want = np.argsort(d2, axis=1, kind="stable")[:, :6]
    pairs, exact = [], knn._exact
    monkeypatch.setattr(knn, "_exact", lambda a, b: pairs.append(len(a)) or exact(a, b))
    idx, got = knn._nearest(q, r, 6)
    assert (idx == want).all() and np.array_equal(got, np.take_along_axis(d2, want, 1), equal_nan=True)
    if kind == "plain":
        assert sum(pairs) < d2.size / 20


def test_queries_that_reach_most_cells_meet_all_rows_in_blocks(spark, monkeypatch):
    rng = np.random.default_rng(6)
    X = rng.normal(size=(400, 12))
    df = spark.createDataFrame([(f"r{i:03d}", x.tolist(), float(i)) for i, x in enumerate(X)], "rid string, vec array<double>, y double")
    blocks, find = [], pivot_knn.knn_candidates
    monkeypatch.setattr(pivot_knn, "knn_candidates", lambda *a, **k: blocks.append(1) or find(*a, **k))
    got = pivot_knn.pivot_knn_candidates(df.select(F.col("rid").alias("qid"), "vec"), df, 3, block_rows=150)
    rows = sorted((r["qid"], r["rank"], r["rid"]) for r in got.collect())
    near = np.argsort(((X[:, None] - X[None]) ** 2).sum(axis=2), axis=1, kind="stable")[:, :3]
    assert blocks and rows == [(f"r{i:03d}", k + 1, f"r{j:03d}") for i, x in enumerate(near) for k, j in enumerate(x)]
