import numpy as np
from pyspark.sql import functions as F

from geotrace.operators import dbscan as D
from geotrace.operators.dbscan import dbscan


def brute_dbscan(X, eps, min_samples):
    """Index-order DBSCAN: clusters numbered as found, border points to the first cluster reaching them."""
    n = len(X)
    d2 = ((X[:, None, :] - X[None, :, :]) ** 2).sum(-1)
    nb = [np.flatnonzero(d2[i] <= eps * eps) for i in range(n)]
    core = np.array([len(x) >= min_samples for x in nb])
    lab = np.full(n, -1)
    c = 0
    for i in range(n):
        if lab[i] != -1 or not core[i]:
            continue
        lab[i] = c
        stack = [i]
        while stack:
            j = stack.pop()
            for k in nb[j]:
                if lab[k] == -1:
                    lab[k] = c
                    if core[k]:
                        stack.append(k)
        c += 1
    return lab


def test_dbscan_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    blobs = [rng.normal(loc, 0.15, size=(60, 4)) for loc in ([0, 0, 0, 0], [2, 2, 0, 0], [0, 3, 1, 0])]
    X = np.vstack([*blobs, rng.uniform(-2, 5, size=(30, 4))])
    X = X[rng.permutation(len(X))]
    ids = [f"p{i:04d}" for i in range(len(X))]
    df = spark.createDataFrame([(ids[i], i, X[i].tolist()) for i in range(len(X))],
                               "trajectory_id string, ingest_seq long, vec array<double>")
    want = brute_dbscan(X, 0.5, 5)
    for block_rows in (4000, 7):          # one block per cell, then many small blocks per cell
        got = {r["trajectory_id"]: r["cluster"] for r in
               dbscan(df, "vec", "trajectory_id", "ingest_seq", 0.5, 5, block_rows=block_rows).collect()}
        assert len(got) == len(X)
        assert [got[i] for i in ids] == want.tolist()
    assert want.max() >= 2 and (want == -1).any()


def test_dbscan_of_copies_and_far_outliers(spark):
    """Outliers squeeze everything else together on the first coordinates, and one point has many copies."""
    rng = np.random.default_rng(4)
    X = np.vstack([rng.normal(0, 0.01, (300, 5)) * [1, 1, 1, 60, 60], np.full((90, 5), 0.3), [[50.0, 50, 50, 0, 0]] * 4])
    X = X[rng.permutation(len(X))]
    rows = [(f"p{i:04d}", i, x.tolist()) for i, x in enumerate(X)]
    rows += [("nan", 900, [float("nan")] + [0.0] * 4), ("null", 901, [None] + [0.0] * 4)]
    df = spark.createDataFrame(rows, "trajectory_id string, ingest_seq long, vec array<double>")
    want = brute_dbscan(X, 0.25, 5).tolist() + [-1, -1]
    got = {r["trajectory_id"]: r["cluster"] for r in
           dbscan(df, "vec", "trajectory_id", "ingest_seq", 0.25, 5, block_rows=30).collect()}
    assert [got[r[0]] for r in rows] == want
    assert max(want) >= 1


def test_blocks_are_bounded_without_spread_on_the_first_coordinates(spark):
    """A grid on three coordinates put all of these in one cell, whose block pairs grow with the square of the rows."""
    rng = np.random.default_rng(5)
    X = np.c_[np.zeros((2000, 3)), rng.uniform(0, 40, (2000, 2))]
    pts = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(X)], "rid long, v array<double>")
    blocks = D._blocks(pts, 200)
    sizes = [r["count"] for r in blocks.groupBy("block").count().collect()]
    assert sum(sizes) == 2000 and max(sizes) <= 250
    visits = D._visits(blocks.withColumn("tag", F.lit(0).cast("long")), D._boxes(blocks), 0.5).count()
    assert visits < 1000


def test_within_is_exact_at_the_border():
    V = np.array([[1e6 + 0.1 * i, 0.3 * i] for i in range(50)])
    for eps in (0.1, 0.3, float(np.hypot(0.1, 0.3)), float(np.sqrt(((V[0] - V[1]) ** 2).sum()))):
        want = ((V[:, None] - V[None]) ** 2).sum(-1) <= eps * eps
        assert (D.within(V, V, eps) == want).all()
