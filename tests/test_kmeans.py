import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from geotrace.operators import clustering as C
from geotrace.operators import kmeans as M


def points(seed=0):
    rng = np.random.default_rng(seed)
    return np.round(np.vstack([rng.normal(c, 0.3, (60, 2)) for c in ((0, 0), (4, 0), (0, 4), (4, 4))]), 3)


def plain(X, centres, max_iter=300, tol=1e-4):
    centres, still = centres.copy(), tol * X.var(axis=0).mean()
    for _ in range(max_iter):
        own = ((X[:, None] - centres[None]) ** 2).sum(2).argmin(1)
        new = np.array([X[own == j].mean(0) if (own == j).any() else centres[j] for j in range(len(centres))])
        moved = ((new - centres) ** 2).sum()
        centres = new
        if moved <= still:
            break
    return centres, ((X[:, None] - centres[None]) ** 2).sum(2).min(1).sum()


def frame(spark, X):
    return spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(X)], "id long, x array<double>").repartition(4)


def test_joint_runs_equal_separate_runs_and_jobs_do_not_grow_with_restarts(spark):
    X, status, jobs = points(), spark.sparkContext.statusTracker(), []
    rows = frame(spark, X)
    rng = np.random.default_rng(1)
    starts = [X[rng.choice(len(X), k, replace=False)] for k in (2, 3, 4, 5, 4, 4)]
    runs = M.lloyd(rows, [M.Run(len(c), 0, c.copy()) for c in starts])
    for r, c in zip(runs, starts, strict=True):
        centres, cost = plain(X, c)
        assert np.allclose(r.centres, centres) and np.isclose(r.cost, cost)
    for n in (1, 6):
        spark.sparkContext.setJobGroup(f"lloyd{n}", "")
        M.lloyd(rows, [M.Run(4, 0, starts[2].copy()) for _ in range(n)])
        jobs.append(len(status.getJobIdsForGroup(f"lloyd{n}")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1]


def test_first_centres_are_rows_far_apart_and_do_not_depend_on_partitions(spark):
    X = points(2)
    a, b = (M.first_centres(frame(spark, X).repartition(n), [(4, s) for s in range(20)]) for n in (1, 7))
    assert all((x.centres == y.centres).all() for x, y in zip(a, b, strict=True))
    groups = [len({(round(x / 4), round(y / 4)) for x, y in r.centres}) for r in a]
    assert np.mean(groups) > 3.3 and {tuple(c) for r in a for c in r.centres} <= {tuple(x) for x in X}


def test_few_and_equal_rows(spark):
    same = np.tile([[1.0, 2.0]], (9, 1))
    r = M.lloyd(frame(spark, same), M.first_centres(frame(spark, same), [(3, 1)]))[0]
    assert r.centres.tolist() == [[1.0, 2.0]] and r.cost == 0
    assert M.lloyd(frame(spark, same).limit(0), M.first_centres(frame(spark, same).limit(0), [(3, 1)]))[0].centres.size == 0


def test_choose_k_finds_the_planted_groups(spark):
    vec = frame(spark, points(3)).select(F.col("id").cast("string").alias("trajectory_id"), array_to_vector("x").alias("features"))
    k, table = C.choose_k(vec, max_k=6, n_init=4)
    assert k == 4 and [r["k"] for r in table.collect()] == [2, 3, 4, 5, 6]
    best = C.best_of_kmeans(vec, 4)
    assert sorted(r["count"] for r in C.cluster_sizes(best.labeled).collect()) == [60] * 4


def test_distances_are_row_sums_of_squares_in_little_memory():
    import tracemalloc

    from geotrace.operators import kmeans
    rng = np.random.default_rng(5)
    for width in (1, 3, 7, 8, 13, 16, 40):
        X, C = rng.normal(size=(301, width)), rng.normal(size=(57, width))
        assert (kmeans._distances(X, C) == ((X[:, None, :] - C[None]) ** 2).sum(axis=2)).all(), width
    assert kmeans._distances(X[:0], C).shape == (0, 57) and kmeans._distances(X[:, :0], C[:, :0]).tolist() == np.zeros((301, 57)).tolist()
    X, C = rng.normal(size=(3000, 13)), rng.normal(size=(100, 13))
    tracemalloc.start()
    kmeans._distances(X, C)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2 * 8 * 3000 * 100  # the distances, not the differences of all coordinates
