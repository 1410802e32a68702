import numpy as np
from pyspark.sql import functions as F

from geotrace.operators import clustering, kmeans
from geotrace.operators import prepare as P


def test_correlations_are_those_of_spark(spark):
    rng = np.random.default_rng(3)
    X = rng.normal(size=(500, 5)) * 1000
    X[:, 3] = 7.0
    rows = [(*(None if (i + j) % 50 == 0 else float(v) for j, v in enumerate(x)), None, None if i % 40 == 0 else float(x[0] * 2 + i)) for i, x in enumerate(X)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double, f double, y double").repartition(3)
    cols = list("abcdef")
    n, got = P.correlations(df, cols, "y")
    want = df.agg(*[F.corr(c, "y").alias(c) for c in "abce"]).first()
    assert n == 500 and got[3] is None and got[5] is None
    assert np.allclose([got[i] for i in (0, 1, 2, 4)], [want[c] for c in "abce"], rtol=1e-13)
    assert P.correlations(df.where("a > 1e9"), cols, "y") == (0, [None] * 6)
    one = df.coalesce(1)
    assert P.correlations(one, ["a", "b"], "y")[1] == list(one.agg(F.corr("a", "y"), F.corr("b", "y")).first())


def test_values_are_counted_once(spark, monkeypatch):
    made, count = [], P.ValueCounts
    monkeypatch.setattr(P, "ValueCounts", lambda *a: made.append(1) or count(*a))
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(f"t{i}", *map(float, rng.normal(size=3)), 40.0, 116.0, 40.1, 116.1 + i / 999) for i in range(80)],
                               "trajectory_id string, a double, b double, c double, start_lat double, start_lon double, dest_lat double, dest_lon double")
    p = P.prepare(df, df, ["a", "b", "c"])
    alone = P.fit_scaler(df, ["a", "b", "c"])
    assert len(made) == 1 and p.scaler.centre == alone.centre and p.scaler.scale == alone.scale


def test_nearest_centres_by_products_are_the_exact_ones(monkeypatch):
    rng = np.random.default_rng(5)
    X = np.round(rng.normal(size=(400, 13)), 1)
    runs = [X[rng.choice(400, k)] for k in (2, 5, 9)] + [np.repeat(X[:1], 3, axis=0)]
    runs[1][2] = runs[1][0]  # ties
    exact, rows = kmeans._distances, []
    monkeypatch.setattr(kmeans, "_distances", lambda x, c: rows.append(len(x)) or exact(x, c))
    for x in (X, X * 1e9, np.where(X > 2, np.inf, X)):
        with np.errstate(invalid="ignore"):
            assert all((a == exact(x, c).argmin(axis=1)).all() for a, c in zip(kmeans._nearest(x, runs), runs, strict=True))
    rows.clear()
    kmeans._nearest(X, runs[:1])
    assert sum(rows) < 20


def test_clustering_rows_are_spread_over_the_cores(spark):
    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(0, clustering.ROWS_A_CORE * cores, numPartitions=1)
    assert clustering.compact(rows).rdd.getNumPartitions() == cores
    assert clustering.compact(spark.range(0, 600, numPartitions=3)).rdd.getNumPartitions() == 1
