"""Trajectory clustering (K1-K4, K6-K8).

Cluster features are a subset of the shared feature aggregate. Scaling uses the
population standard deviation (Spark ML's StandardScaler uses the sample one), from
a 1-row aggregate. K-means runs all restarts (and all k) together, see ``kmeans.py``; the lowest
cost is kept. k is chosen by silhouette with ``ClusteringEvaluator`` (squared Euclidean, O(n k),
instead of the O(n^2) plain Euclidean score of the reference, so the chosen k may differ).

DBSCAN (K5) is ``method="dbscan"``: exact, on k-d tree blocks (operators/dbscan.py).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geotrace.operators import kmeans
from geotrace.operators.features import extract_features
from geotrace.session import ensure_checkpoint_dir, stored

ROWS_PER_PARTITION = 50_000
#: Rows that a core should have at least before fewer cores do the work.
ROWS_A_CORE = 2_000
CLUSTER_FEATURES = ["start_lat", "start_lon", "end_lat", "end_lon", "centroid_lat", "centroid_lon",
                    "lat_range", "lon_range", "total_distance", "straight_distance", "straightness",
                    "num_points", "bearing"]


def cluster_features(traj: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """K1: 13 features per trajectory; rows with < 2 points are dropped (K2's dropna)."""
    t = traj.withColumn("_n", F.size("path_lat"))
    f = extract_features(t, CLUSTER_FEATURES, keep=["_n", *(keep or [])])
    return f.where(F.col("_n") >= 2).drop("_n")


def standardize(df: DataFrame, cols: list[str], suffix: str = "") -> DataFrame:
    """K2: z-score with population sigma (sigma 0 -> 1), statistics from one aggregate row."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}")]
    row = df.agg(*aggs).first()
    return df.withColumns({c + suffix: (F.col(c) - F.lit(row[f"m_{c}"] or 0.0)) / F.lit(row[f"s_{c}"] or 1.0) for c in cols})


def assemble(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="keep").transform(df)


@dataclass
class KMeansResult:
    k: int
    cost: float
    centres: np.ndarray
    labeled: DataFrame


def best_of_kmeans(vec: DataFrame, k: int, seed: int = 42, n_init: int = 10, max_iter: int = 300,
                   features: str = "features") -> KMeansResult:
    """K3: ``n_init`` K-means runs with derived seeds; lowest training cost wins (first on ties)."""
    return best_of_all(vec, [k], seed, n_init, max_iter, features)[k]


def best_of_all(vec: DataFrame, ks: list[int], seed: int = 42, n_init: int = 10, max_iter: int = 300,
                features: str = "features") -> dict[int, KMeansResult]:
    """The best of ``n_init`` runs for each k, all runs in the same jobs."""
    key = F.xxhash64("trajectory_id") if "trajectory_id" in vec.columns else F.xxhash64(vector_to_array(features))
    rows = stored(vec.select(key.alias("id"), vector_to_array(features).alias("x")))
    runs = kmeans.lloyd(rows, kmeans.first_centres(rows, [(k, seed + i) for k in ks for i in range(n_init)]), max_iter)
    best = {k: min((r for r in runs if r.k == k), key=lambda r: r.cost) for k in ks}
    out = {}
    for k, r in best.items():
        labeled = kmeans.assigned(vec, vector_to_array(features), {"cluster": r.centres}) if len(r.centres) else vec.withColumn("cluster", F.lit(0))
        out[k] = KMeansResult(k, r.cost, r.centres, labeled)
    return out


def compact(vec: DataFrame) -> DataFrame:
    """The vectors written once, in as many partitions as their number and the cores ask for (many fits read them)."""
    ensure_checkpoint_dir(vec.sparkSession)
    stored = vec.checkpoint()
    n, cores = stored.count(), vec.sparkSession.sparkContext.defaultParallelism
    parts = max(1, -(-n // ROWS_PER_PARTITION), min(cores, n // ROWS_A_CORE))
    few = stored.rdd.getNumPartitions() < parts
    return (stored.repartition(parts) if few else stored.coalesce(parts)).checkpoint()


def choose_k(vec: DataFrame, seed: int = 42, max_k: int = 10, n_init: int = 10,
             features: str = "features") -> tuple[int, DataFrame]:
    """K4: k in [2, min(max_k, n - 1)] with the highest silhouette; first best wins.

    Returns the chosen k and a table ``k, silhouette, cost``.
    """
    n = vec.count()
    ev = ClusteringEvaluator(featuresCol=features, predictionCol="cluster", metricName="silhouette",
                             distanceMeasure="squaredEuclidean")
    rows, best_k, best_s = [], 2, -1.0
    for k, r in best_of_all(vec, list(range(2, min(max_k + 1, n))), seed, n_init, features=features).items():
        s = ev.evaluate(r.labeled)
        rows.append((k, float(s), float(r.cost)))
        if s > best_s:
            best_s, best_k = s, k
    spark = vec.sparkSession
    return best_k, spark.createDataFrame(rows, "k int, silhouette double, cost double")


def fit_predict(traj: DataFrame, k: int | None = None, seed: int = 42, n_init: int = 10,
                max_k: int = 10, method: str = "kmeans", eps: float = 0.5, min_samples: int = 5) -> DataFrame:
    """Cluster labels per trajectory: ``trajectory_id, cluster`` (K1-K5).

    Trajectories without cluster features (< 2 points) get no label (D21).
    """
    cf = cluster_features(traj, keep=["ingest_seq"] if "ingest_seq" in traj.columns else None)
    z = standardize(cf, CLUSTER_FEATURES, "_z")
    if method == "dbscan":
        from geotrace.operators.dbscan import dbscan
        v = z.select("trajectory_id", F.array(*[F.col(c + "_z") for c in CLUSTER_FEATURES]).alias("vec"),
                     *(["ingest_seq"] if "ingest_seq" in z.columns else []))
        return dbscan(v, "vec", "trajectory_id", "ingest_seq" if "ingest_seq" in v.columns else None,
                      eps, min_samples)
    if method != "kmeans":
        raise ValueError(f"unknown clustering method {method!r}")
    vec = assemble(z, [c + "_z" for c in CLUSTER_FEATURES]).select("trajectory_id", "features")
    vec = compact(vec)
    if k is None:
        k, _ = choose_k(vec, seed, max_k, n_init)
    labeled = best_of_kmeans(vec, k, seed, n_init).labeled
    return labeled.select("trajectory_id", F.col("cluster").cast("int").alias("cluster"))


def cluster_sizes(labels: DataFrame) -> DataFrame:
    """K7: rows per cluster."""
    return labels.groupBy("cluster").agg(F.count(F.lit(1)).alias("count"))


def largest_cluster(traj: DataFrame, labels: DataFrame, ignore_noise: bool = False) -> DataFrame:
    """K6: keep rows of the biggest cluster (ties: lowest label; -1 ignored when asked).

    The winner is a 1-row aggregate used as a scalar subquery; labels are joined on id.
    Trajectories without a label are dropped, as they are not in the largest cluster.
    If there is no valid cluster at all, every row is kept.
    """
    sizes = cluster_sizes(labels)
    if ignore_noise:
        sizes = sizes.where(F.col("cluster") != -1)
    winner = sizes.select(F.min_by("cluster", F.struct(-F.col("count"), F.col("cluster")))).scalar()
    j = traj.join(labels, "trajectory_id", "left")
    return j.where((F.col("cluster") == winner) | winner.isNull()).drop("cluster")


def cluster_map_data(traj: DataFrame, labels: DataFrame) -> DataFrame:
    """K8: start point and label per trajectory (the data behind the cluster map)."""
    t = traj.select("trajectory_id", F.get(F.col("path_lon"), F.lit(0)).alias("start_lon"),
                    F.get(F.col("path_lat"), F.lit(0)).alias("start_lat"))
    return t.join(labels, "trajectory_id")
