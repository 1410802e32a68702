"""Trajectory tables derived from the driver's ``events`` table.

The test data hold no GPS. Trajectories are built from ``events`` by an integer
recipe (see FIXTURES.md §3): trajectory = user x 6-day bucket, positions are running
sums of integer micro-degree steps, divided by 1e6 only at the end, so Spark and
DuckDB produce bit-identical doubles.

Running sums are computed in two levels so that a user holding a large share of
all events never lands in one window task:

1. events are cut into (trajectory, hour) chunks; each chunk is summed with a
   partial aggregate;
2. a window over the small chunk table gives each chunk its offset (count and sums
   of all earlier chunks of the trajectory);
3. a window partitioned by (trajectory, chunk) finishes the running sum inside
   each chunk and adds the offset.

Only step 2 is partitioned by trajectory alone, and it sees one row per chunk.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Fixed values of the derivation recipe (FIXTURES.md §3).
EPOCH = "2024-01-01"
BUCKET_DAYS = 6
TEST_BUCKET = 4
LAT_BASE_DEFAULT = 39900000
LAT_BASE_NORTH = 60000000
NORTH_USER_MOD, NORTH_USER_REM = 41, 7
LAT_USER_MULT, LON_USER_MULT, USER_SPREAD, USER_SHIFT = 104729, 130363, 200001, 100000
LON_BASE = 116400000
LAT_STEP_MULT, LAT_STEP_ADD, LON_STEP_MULT, LON_STEP_ADD = 7919, 13, 6101, 29
STEP_MOD, STEP_SHIFT = 1201, 400
JUMP_EVERY, JUMP_SIZE = 499, 3000000
MICRO = 1e6

CHUNK_SECONDS = 3600


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _steps(events: DataFrame, chunk_seconds: int = CHUNK_SECONDS) -> DataFrame:
    e = events.select("event_id", "ts", "user_id")
    bucket = F.floor(F.datediff(F.to_date("ts"), F.lit(EPOCH).cast("date")) / F.lit(BUCKET_DAYS)).cast("long")
    uid = F.col("user_id")
    eid = F.col("event_id")
    lat0 = (F.when(uid % NORTH_USER_MOD == NORTH_USER_REM, F.lit(LAT_BASE_NORTH)).otherwise(F.lit(LAT_BASE_DEFAULT))
            + (uid * LAT_USER_MULT) % USER_SPREAD - USER_SHIFT)
    lon0 = F.lit(LON_BASE) + (uid * LON_USER_MULT) % USER_SPREAD - USER_SHIFT
    step_lat = ((eid * LAT_STEP_MULT + LAT_STEP_ADD) % STEP_MOD - STEP_SHIFT
                + F.when(eid % JUMP_EVERY == 0, F.lit(JUMP_SIZE)).otherwise(F.lit(0)))
    step_lon = (eid * LON_STEP_MULT + LON_STEP_ADD) % STEP_MOD - STEP_SHIFT
    return (e.withColumn("bucket", bucket)
            .select(F.concat(uid.cast("string"), F.lit("_"), F.col("bucket").cast("string")).alias("trajectory_id"),
                    "user_id", "bucket", "event_id", "ts",
                    lat0.cast("long").alias("lat0"), lon0.cast("long").alias("lon0"),
                    step_lat.cast("long").alias("step_lat"), step_lon.cast("long").alias("step_lon"),
                    F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(chunk_seconds * 1_000_000))
                    .alias("chunk")))


def raw_positions(spark: SparkSession, sf_dir: str, chunk_seconds: int = CHUNK_SECONDS) -> DataFrame:
    """Every event as a numbered position: ``trajectory_id, user_id, bucket, pos1 (1-based), n, lat, lon``.

    ``chunk_seconds`` only changes how the work is split, never the result.
    """
    s = _steps(read_table(spark, sf_dir, "events"), chunk_seconds)
    chunk_stats = (s.groupBy("trajectory_id", "chunk")
                   .agg(F.count(F.lit(1)).alias("c_n"), F.sum("step_lat").alias("c_lat"),
                        F.sum("step_lon").alias("c_lon")))
    before = Window.partitionBy("trajectory_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("trajectory_id")
    offsets = chunk_stats.select(
        "trajectory_id", "chunk",
        F.coalesce(F.sum("c_n").over(before), F.lit(0)).alias("o_n"),
        F.coalesce(F.sum("c_lat").over(before), F.lit(0)).alias("o_lat"),
        F.coalesce(F.sum("c_lon").over(before), F.lit(0)).alias("o_lon"),
        F.sum("c_n").over(whole).alias("n"))
    inner = Window.partitionBy("trajectory_id", "chunk").orderBy("ts", "event_id")
    running = inner.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = s.select("trajectory_id", "chunk", "user_id", "bucket", "lat0", "lon0",
                     F.row_number().over(inner).alias("r"),
                     F.sum("step_lat").over(running).alias("s_lat"),
                     F.sum("step_lon").over(running).alias("s_lon"))
    j = local.join(offsets, ["trajectory_id", "chunk"])
    return j.select(
        "trajectory_id", "user_id", "bucket",
        (F.col("o_n") + F.col("r")).cast("int").alias("pos1"),
        F.col("n").cast("int").alias("n"),
        ((F.col("lat0") + F.col("o_lat") + F.col("s_lat")) / F.lit(MICRO)).alias("lat"),
        ((F.col("lon0") + F.col("o_lon") + F.col("s_lon")) / F.lit(MICRO)).alias("lon"))


def gps_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long path table ``trajectory_id, pos (0-based), lat, lon`` (points with ``pos1 <= n - 2``)."""
    p = raw_positions(spark, sf_dir)
    return p.where(F.col("pos1") <= F.col("n") - 2).select(
        "trajectory_id", (F.col("pos1") - 1).alias("pos"), "lat", "lon")


def gps_trajectories(spark: SparkSession, sf_dir: str, chunk_seconds: int = CHUNK_SECONDS) -> DataFrame:
    """One row per trajectory, the reference's input model.

    ``trajectory_id, split, path_lat, path_lon, dest_lat, dest_lon, ingest_seq``; paths
    with no point are ``[]``; the last bucket is the test split (dest NULL).
    """
    p = raw_positions(spark, sf_dir, chunk_seconds)
    in_path = F.col("pos1") <= F.col("n") - 2
    is_dest = F.col("pos1") == F.col("n")
    pt = F.struct(F.col("pos1"), F.col("lat"), F.col("lon"))
    g = p.groupBy("trajectory_id").agg(
        F.any_value("user_id").alias("user_id"), F.any_value("bucket").alias("bucket"),
        F.sort_array(F.collect_list(F.when(in_path, pt))).alias("pts"),
        F.max(F.when(is_dest, F.col("lat"))).alias("d_lat"),
        F.max(F.when(is_dest, F.col("lon"))).alias("d_lon"))
    is_test = F.col("bucket") == TEST_BUCKET
    return g.select(
        "trajectory_id",
        F.when(is_test, F.lit("test")).otherwise(F.lit("train")).alias("split"),
        F.col("pts.lat").alias("path_lat"), F.col("pts.lon").alias("path_lon"),
        F.when(is_test, F.lit(None).cast("double")).otherwise(F.col("d_lat")).alias("dest_lat"),
        F.when(is_test, F.lit(None).cast("double")).otherwise(F.col("d_lon")).alias("dest_lon"),
        (F.col("user_id") * 5 + F.col("bucket")).alias("ingest_seq"))


def gps_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As :func:`gps_trajectories` but with paths as list text, the CSV form."""
    t = gps_trajectories(spark, sf_dir)
    return t.select("trajectory_id", "split", F.to_json("path_lat").alias("path_lat"),
                    F.to_json("path_lon").alias("path_lon"), "dest_lat", "dest_lon", "ingest_seq")


def gps_raw_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`gps_raw` with dirt by integer rule on ``s = ingest_seq``, so that every cleaning rule removes rows.

    Excluded ids (s % 13 = 3), malformed (s % 23 = 9), tuple (s % 29 = 11), one-point (s % 31 = 2) and empty
    (s % 37 = 4) path text, text (s % 17 = 5) and NULL (s % 19 = 7) targets, out-of-range (s % 41 = 6) and text
    (s % 43 = 8) starts, and later duplicates with other targets (s % 11 = 0). The first rule that fits a path wins.
    """
    t = gps_trajectories(spark, sf_dir)
    s = F.col("ingest_seq")

    def text(path: str):
        whole = F.to_json(path)
        return (F.when(s % 23 == 9, "[1.0, 2.0").when(s % 29 == 11, F.translate(whole, "[]", "()"))
                .when(s % 31 == 2, F.to_json(F.slice(path, 1, 1))).when(s % 37 == 4, "[]").otherwise(whole))

    lat = F.when((F.col("split") == "train") & (s % 17 == 5), "abc").otherwise(F.col("dest_lat").cast("string"))
    lon = F.when(s % 19 != 7, F.col("dest_lon").cast("string"))
    start = F.when(s % 41 == 6, "95.5").when(s % 43 == 8, "n/a").otherwise("10")
    rows = t.select(F.when(s % 13 == 3, "128_20090222093321").otherwise(F.col("trajectory_id")).alias("trajectory_id"), "split",
                    text("path_lat").alias("path_lat"), text("path_lon").alias("path_lon"), lat.alias("dest_lat"),
                    lon.alias("dest_lon"), start.alias("start_lat"), "ingest_seq")
    again = rows.where(s % 11 == 0).withColumns({"dest_lat": F.lit("1.5"), "ingest_seq": s + 1_000_000})
    return rows.unionByName(again)


def train_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gps_trajectories(spark, sf_dir).where(F.col("split") == "train")


def test_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gps_trajectories(spark, sf_dir).where(F.col("split") == "test")
