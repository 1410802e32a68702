import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from geotrace.operators import ensembles as E
from geotrace.operators import trees as K


def table(seed=0, n=300, p=6):
    rng = np.random.default_rng(seed)
    X = np.round(rng.normal(size=(n, p)), 2)
    X[:, 5] = X[:, 0]  # a copy: ties between features
    Y = np.c_[X[:, 0] * 3 + (X[:, 1] > 0.3) * 5 + rng.normal(0, 0.1, n), X[:, 2] * 10 - X[:, 3] ** 2]
    edges = [np.unique(x) for x in X.T]
    values = np.zeros((p, K.BINS))
    for j, e in enumerate(edges):
        values[j, :len(e)], values[j, len(e):] = e, e[-1]
    B = E.bin_rows(X, edges)
    assert B.max() < K.BINS
    return X, Y, B, edges, values


def plain_gain(g, rows, Y):
    def part(y):
        G, W = -y.sum(axis=0), len(y)
        t = np.maximum(np.abs(G) - g.l1, 0)
        return (t ** 2).sum() / (W + g.l2)
    return lambda left: part(Y[rows[left]]) + part(Y[rows[~left]]) - part(Y[rows])


def plain_best(g, X, Y, rows):
    """Best (gain, feature, cut value) by trying every value of every feature."""
    best = (g.min_gain + 1e-9, None, None)
    gain = plain_gain(g, rows, Y)
    for j in range(X.shape[1]):
        for c in np.unique(X[rows, j])[:-1]:
            left = X[rows, j] <= c
            if min(left.sum(), (~left).sum()) >= max(g.min_leaf, g.min_weight) and len(rows) >= g.min_split and gain(left) > best[0] + 1e-9:
                best = gain(left), j, c
    return best


def plain_tree(g, X, Y):
    """{leaf rows} of a tree grown best first with plain loops (all leaves if ``g.leaves`` is 0)."""
    leaves = [(plain_best(g, X, Y, np.arange(len(X))), np.arange(len(X)), 0)]
    done = []
    while leaves:
        at = max(range(len(leaves)), key=lambda i: leaves[i][0][0] if leaves[i][0][1] is not None and leaves[i][2] < g.depth else -1)
        (_, j, c), rows, depth = leaves[at]
        if j is None or depth >= g.depth or (g.leaves and len(leaves) + len(done) >= g.leaves):
            done.append(leaves.pop(at)[1])
            continue
        leaves.pop(at)
        for part in (rows[X[rows, j] <= c], rows[X[rows, j] > c]):
            leaves.append((plain_best(g, X, Y, part), part, depth + 1))
    return {tuple(sorted(r.tolist())) for r in done}


def leaf_sets(tree, B):
    leaf = tree.leaf(B)
    return {tuple(np.flatnonzero(leaf == x).tolist()) for x in np.unique(leaf)}


@pytest.mark.parametrize("g", [
    K.Grower("boost", 1, 3), K.Grower("boost", 1, 4, min_leaf=8, min_split=20), K.Grower("boost", 1, 8, leaves=9, min_leaf=5),
    K.Grower("boost", 1, 4, l1=0.5, l2=1.5, min_gain=0.2, min_weight=3), K.Grower("bag", 1, 5, joint=True, min_leaf=4)])
def test_trees_equal_plain_learner(g):
    X, Y, B, _, values = table()
    Y = Y if g.joint else Y[:, :1]
    Y = K.rounded_targets(Y, np.abs(Y).max())
    e = K.fitted(g, np.arange(len(X), dtype=np.uint64), B, Y, np.abs(Y).max(), values)
    centred = Y - Y.mean(axis=0)
    assert leaf_sets(e.trees[0], B) == plain_tree(g, X, centred)
    for leaf in leaf_sets(e.trees[0], B):
        G = centred[list(leaf)].sum(axis=0)
        want = np.sign(G) * np.maximum(np.abs(G) - g.l1, 0) / (len(leaf) + g.l2) * (g.rate if g.kind == "boost" else 1)
        assert np.allclose(e.trees[0].predict(B)[list(leaf)], want, atol=1e-5)


def test_symmetric_tree_takes_the_best_split_of_each_level():
    X, Y, B, _, values = table()
    g = K.Grower("boost", 1, 3, 0.1, symmetric=True, l2=3.0)
    Y = K.rounded_targets(Y[:, :1], np.abs(Y).max())
    t = K.fitted(g, np.arange(len(X), dtype=np.uint64), B, Y, np.abs(Y).max(), values).trees[0]
    y, groups = Y[:, 0] - Y[:, 0].mean(), [np.arange(len(X))]
    for _ in range(3):
        def both(j, c):
            return sum(y[r[s]].sum() ** 2 / (s.sum() + 3) for r in groups for s in (X[r, j] <= c, X[r, j] > c))
        _, j, c = max(((both(j, c), -j, -c) for j in range(6) for c in np.unique(X[:, j])[:-1]), key=lambda x: (round(x[0], 6), x[1], x[2]))
        groups = [r[s] for r in groups for s in (X[r, -j] <= -c, X[r, -j] > -c)]
    assert leaf_sets(t, B) == {tuple(r.tolist()) for r in groups if len(r)}


def test_random_cuts_lie_between_the_nodes_extremes_and_repeat():
    X, Y, B, _, values = table()
    g = K.Grower("bag", 4, joint=True, random_cuts=True, node_features="sqrt", min_leaf=2, min_split=5)
    Y = K.rounded_targets(Y, np.abs(Y).max())
    ids = np.arange(len(X), dtype=np.uint64)
    a, order = K.fitted(g, ids, B, Y, np.abs(Y).max(), values), np.random.default_rng(1).permutation(len(X))
    b = K.fitted(g, ids[order], B[order], Y[order], np.abs(Y).max(), values)
    assert all((x.feature == y.feature).all() and (x.cut == y.cut).all() and (x.value == y.value).all() for x, y in zip(a.trees, b.trees, strict=True))
    t = a.trees[0]
    root = K.Tree(K.tree_key(g, 0, 0), 2)
    j = int(t.feature[0])
    assert j in root.features(g, 6)[0]
    u = float(root.cut_draws(np.array([0]), np.array([j]))[0])
    drawn = X[:, j].min() + u * (X[:, j].max() - X[:, j].min())
    assert ((X[:, j] <= drawn) == (B[:, j] <= t.cut[0])).all()
    assert len({x.feature[0] for x in a.trees} | {int(x.cut[0]) for x in a.trees}) > 2  # trees differ


def test_sums_of_parts_are_those_of_the_whole_for_wide_and_narrow_keys():
    rng = np.random.default_rng(2)
    for space in (1000, 10**9):
        keys, v = rng.integers(0, space, 5000), rng.integers(-2**30, 2**30, 5000).astype(float)
        whole = K.keyed_sums(keys, [v], space)
        halves = [K.keyed_sums(keys[s], [v[s]], space) for s in (slice(0, 1700), slice(1700, None))]
        again = E._merged(halves)
        assert (whole[0] == again[0]).all() and (whole[1][0] == again[1][0]).all()
        assert whole[1][0].sum() == v.sum()


GROWERS = [K.Grower("bag", 3, 6, joint=True, node_features="sqrt", bootstrap="poisson", min_leaf=4, min_split=10),
           K.Grower("bag", 2, joint=True, random_cuts=True, node_features="sqrt", min_leaf=2, min_split=5),
           K.Grower("boost", 11, 3, 0.1, node_features="log2", rows=0.7, min_leaf=8), K.Grower("boost", 2, 2, 0.1, bags=2),
           K.Grower("boost", 3, 4, 0.05, rows=0.85, tree_features=0.85, l1=0.5, l2=1.5, min_gain=0.2, min_weight=3),
           K.Grower("boost", 3, 8, 0.1, leaves=7, min_leaf=20), K.Grower("boost", 3, 3, 0.1, symmetric=True, l2=3, bootstrap="bayes")]


def frame(spark, n=300):
    X, Y, _, _, _ = table(n=n)
    rows = [(f"t{i}", X[i].tolist(), float(Y[i, 0]), float(Y[i, 1]), i % 3) for i in range(n)]
    df = spark.createDataFrame(rows, "trajectory_id string, x array<double>, dx double, dy double, fold int").repartition(5)
    return df.select("trajectory_id", array_to_vector("x").alias("features"), "dx", "dy", "fold")


def test_waves_grow_the_trees_that_tasks_grow(spark):
    d = E.design(frame(spark), "features", ("dx", "dy"), "fold")
    jobs = [E.Job(g, fold) for g in GROWERS for fold in (None, 1)]
    near, far = E.fit_many(d, jobs), E.fit_many(d, jobs, memory_rows=0)
    assert set(near.pieces) == set(far.pieces) == set(range(0, 2 * len(GROWERS), 2))
    for i in near.pieces:
        for a, b in zip(near.pieces[i], far.pieces[i], strict=True):
            for x, y in zip(a.ensemble.trees, b.ensemble.trees, strict=True):
                assert (x.feature == y.feature).all() and (x.cut == y.cut).all() and np.allclose(x.value, y.value, rtol=1e-9, atol=1e-9), i
    rows = [{(r["job"], r["row"]): (r["p0"], r["p1"]) for r in f.out.collect()} for f in (near, far)]
    assert rows[0].keys() == rows[1].keys() and len(rows[0]) == len(GROWERS) * 100
    assert all(np.allclose(rows[0][k], rows[1][k], atol=1e-6) for k in rows[0])


@pytest.mark.parametrize("subtree_rows", [0, 40])
def test_subtrees_finished_in_tasks_are_those_of_waves_and_tasks(spark, subtree_rows):
    d = E.design(frame(spark), "features", ("dx", "dy"), "fold")
    jobs = [E.Job(g) for g in GROWERS]
    near, far = E.fit_many(d, jobs), E.fit_many(d, jobs, memory_rows=0, subtree_rows=subtree_rows)
    for i in near.pieces:
        for a, b in zip(near.pieces[i], far.pieces[i], strict=True):
            for x, y in zip(a.ensemble.trees, b.ensemble.trees, strict=True):
                assert all((getattr(x, c) == getattr(y, c)).all() for c in ("feature", "cut", "left")) and np.allclose(x.value, y.value, rtol=1e-9, atol=1e-9), i


def test_whole_histograms_give_the_cuts_of_keys():
    _, Y, B, _, _ = table()
    Y, B = np.tile(Y, (7, 1))[:2000], np.tile(B, (7, 1))[:2000]
    rng, features = np.random.default_rng(3), np.broadcast_to(np.arange(6), (3, 6))
    slot, rows = rng.integers(0, 3, 1500), np.sort(rng.permutation(2000)[:1500])
    weight, grads = rng.integers(0, 3, 2000).astype(float), [np.rint(Y[:, 0] * 64), np.rint(Y[:, 1] * 64)]
    for g in (K.Grower("boost", 1, 3), K.Grower("boost", 1, 3, min_leaf=30, l1=0.5, l2=1.5, min_gain=0.2, min_weight=3.0), K.Grower("boost", 1, 3, min_split=400)):
        keys, sums = K.wave_sums(B, rows, slot, features, weight, grads)
        a = K.best_by_segment(g, keys, sums, 6)
        grid = K.dense_sums(K.by_feature(B), rows, slot, features, weight, grads)
        assert all((x == y).all() for x, y in zip([keys, *sums], [K.sparse(grid)[0], *K.sparse(grid)[1]], strict=True))
        for b in (K.dense_cuts(g, grid), K.dense_cuts(g, K.whole_grid(keys, sums, 3, 6))):
            on = a.gain > -np.inf
            assert on.any() and (a.gain == b.gain).all() and (a.total == b.total).all()
            assert (a.cut[on] == b.cut[on]).all() and (a.left[on] == b.left[on]).all()


def test_held_out_rows_are_never_learned_and_jobs_do_not_grow_with_models(spark):
    df = frame(spark)
    d = E.design(df, "features", ("dx", "dy"), "fold")
    wild = E.design(df.withColumn("dx", F.when(F.col("fold") == 1, 1e3).otherwise(F.col("dx"))), "features", ("dx", "dy"), "fold")
    wild.largest = d.largest
    g = K.Grower("boost", 5, 3, 0.3)
    a, b = ({r["row"]: r["p0"] for r in E.fit_many(x, [E.Job(g, 1)]).out.collect()} for x in (d, wild))
    assert a == b and len(a) == 100
    status = spark.sparkContext.statusTracker()
    counts = []
    for jobs in ([E.Job(g, 0)], [E.Job(g, f) for f in range(3)] * 4):
        spark.sparkContext.setJobGroup(f"g{len(jobs)}", "")
        E.fit_many(d, jobs, memory_rows=0).out.count()
        counts.append(len(status.getJobIdsForGroup(f"g{len(jobs)}")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert counts[0] == counts[1]


def test_empty_and_constant_tables(spark):
    df = frame(spark, 30)
    for part in (df.where("false"), df.withColumns({"dx": F.lit(2.0), "dy": F.lit(None).cast("double")})):
        d = E.design(part, "features", ("dx", "dy"), "fold")
        assert d.count == 0 and E.fit_many(d, [E.Job(GROWERS[2], 0)]).out.count() == 0
    d = E.design(df.withColumns({"dx": F.lit(2.0), "dy": F.lit(-1.0)}), "features", ("dx", "dy"), "fold")
    for g in [*GROWERS, K.Grower("adaboost", 5, 3, 1.0)]:
        got = E.fit_many(d, [E.Job(g, 0)]).out.collect()
        assert len(got) == 10 and all(abs(r["p0"] - 2) < 1e-6 and abs(r["p1"] + 1) < 1e-6 for r in got)
