"""Seeded synthetic trajectories (S5), generated on the executors.

``spark.range`` gives the rows; every draw is a hash of (seed, split, row, point,
tag), so the table is the same for any partitioning. Paths are cumulative sums of
per-step draws, computed inside the row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geotrace.functions.hashrand import uniform_range

# Fixed values of the sample generator: start box, step range, points, destination stretch.
START_LAT, START_LON, START_SPREAD = 40.0, -73.0, 2.0
STEP_LO, STEP_HI = -0.01, 0.02
MIN_POINTS, MAX_POINTS = 5, 19
STRETCH_LO, STRETCH_HI = 1.0, 3.0


def _table(spark: SparkSession, n: int, split: str, seed: int, num_partitions: int | None) -> DataFrame:
    r = spark.range(0, n, numPartitions=num_partitions) if num_partitions else spark.range(0, n)
    key = F.concat(F.lit(split), F.lit(":"), F.col("id").cast("string"))
    npts = (F.lit(MIN_POINTS) + F.floor(uniform_range(0, 1, seed, key, tag="n") * (MAX_POINTS - MIN_POINTS + 1))
            ).cast("int")
    df = r.select(
        F.col("id"), key.alias("_k"), npts.alias("_n"),
        uniform_range(START_LAT - START_SPREAD, START_LAT + START_SPREAD, seed, key, tag="lat0").alias("_a0"),
        uniform_range(START_LON - START_SPREAD, START_LON + START_SPREAD, seed, key, tag="lon0").alias("_o0"))
    idx = F.sequence(F.lit(0), F.col("_n") - 1)

    def path(start, tag):
        steps = F.transform(idx, lambda i: F.when(i == 0, F.lit(0.0)).otherwise(
            uniform_range(STEP_LO, STEP_HI, seed, F.col("_k"), i, tag=tag)))
        return F.transform(idx, lambda i: F.col(start) + F.aggregate(
            F.slice(steps, 1, i + 1), F.lit(0.0), lambda a, x: a + x))

    df = df.withColumn("path_lat", path("_a0", "dlat")).withColumn("path_lon", path("_o0", "dlon"))
    ident = F.concat(F.lit(f"{split}_"), F.lpad(F.col("id").cast("string"), 4, "0"))
    out = df.select(ident.alias("trajectory_id"), F.lit(split).alias("split"), "path_lat", "path_lon",
                    F.col("id").alias("ingest_seq"), "_k")
    if split == "train":
        last_a, last_o = F.element_at("path_lat", -1), F.element_at("path_lon", -1)
        first_a, first_o = F.element_at("path_lat", 1), F.element_at("path_lon", 1)
        out = out.withColumn("dest_lat", last_a + (last_a - first_a) * uniform_range(
            STRETCH_LO, STRETCH_HI, seed, F.col("_k"), tag="sa"))
        out = out.withColumn("dest_lon", last_o + (last_o - first_o) * uniform_range(
            STRETCH_LO, STRETCH_HI, seed, F.col("_k"), tag="so"))
    else:
        out = out.withColumn("dest_lat", F.lit(None).cast("double")).withColumn("dest_lon", F.lit(None).cast("double"))
    return out.select("trajectory_id", "split", "path_lat", "path_lon", "dest_lat", "dest_lon", "ingest_seq")


def create_sample_data(spark: SparkSession, n_train: int = 1000, n_test: int = 200, seed: int = 42,
                       num_partitions: int | None = None) -> DataFrame:
    """Train (``train_0000``...) and test (``test_0000``...) trajectories in one frame with ``split``."""
    return _table(spark, n_train, "train", seed, num_partitions).unionByName(
        _table(spark, n_test, "test", seed, num_partitions))
