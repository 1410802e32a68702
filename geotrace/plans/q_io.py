"""Registered write-and-read queries (S1, S2, S6, S7, X3, E11): files go to the shared checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from geotrace.operators.quality import sample_id_check
from geotrace.operators.validation import read_best_params, write_best_params
from geotrace.plans import oracle
from geotrace.plans.common import clean_split
from geotrace.plans.q_eval import _BASELINE, baseline
from geotrace.plans.registry import register
from geotrace.plans.rounding import rnd, round_sql
from geotrace.session import ensure_checkpoint_dir
from geotrace.sources import io
from geotrace.sources.fixtures import gps_trajectories


def _folder(spark) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/io-{uuid.uuid4().hex}"


@register("csv_round_trip", oracle.with_derived() + f"""
SELECT trajectory_id, split, n_path AS num_points, {round_sql('dest_lat', 'coord')} AS dest_lat, {round_sql('dest_lon', 'coord')} AS dest_lon,
  CAST(row_number() OVER (ORDER BY split DESC, ingest_seq) - 1 AS BIGINT) AS ingest_seq FROM trj""")
def csv_round_trip(spark, sf_dir):
    """S6 then S1: both splits written in source order as CSV (several files) and loaded again."""
    t, base = gps_trajectories(spark, sf_dir), _folder(spark)
    for split in ("train", "test"):
        rows = t.where(F.col("split") == split).repartitionByRange(3, "ingest_seq").sortWithinPartitions("ingest_seq")
        columns = ["trajectory_id", "path_lat", "path_lon", *(["dest_lat", "dest_lon"] if split == "train" else [])]
        io.save_trajectories_csv(rows.select(*columns), f"{base}/{split}")
    back = io.load_data(spark, f"{base}/train", f"{base}/test")
    return back.select("trajectory_id", "split", F.size("path_lat").cast("long").alias("num_points"),
                       rnd(F.col("dest_lat").cast("double"), "coord").alias("dest_lat"),
                       rnd(F.col("dest_lon").cast("double"), "coord").alias("dest_lon"), "ingest_seq")


@register("submission_round_trip", _BASELINE)
def submission_round_trip(spark, sf_dir):
    """X3 then S7: an older submission is written first; the newest one comes back."""
    base, sub = _folder(spark), baseline(spark, sf_dir)
    io.write_submission(sub.limit(0), base, "older")
    io.write_submission(sub, base, "baseline")
    back = io.latest_submission(spark, f"{base}/submission_*.csv")
    return back.select("trajectory_id", rnd("latitude_pred", "coord").alias("latitude_pred"), rnd("longitude_pred", "coord").alias("longitude_pred"))


@register("sample_ids", oracle.with_derived() + """
SELECT trajectory_id, 'missing_in_submission' AS side FROM trj WHERE split = 'test' AND ingest_seq % 10 = 9
UNION ALL SELECT trajectory_id, 'not_in_sample' FROM trj WHERE split = 'test' AND ingest_seq % 3 = 1 AND ingest_seq % 10 <> 9""")
def sample_ids(spark, sf_dir):
    """The sample lacks some ids of the submission and has some that it lacks."""
    base, test = _folder(spark), clean_split(spark, sf_dir, "test")
    lines = test.where("ingest_seq % 3 <> 1 OR ingest_seq % 10 = 9").select("trajectory_id", F.lit(0.0).alias("latitude_pred"), F.lit(0.0).alias("longitude_pred"))
    lines.write.option("header", True).csv(f"{base}/sample")
    sample = io.read_optional_csv(spark, f"{base}/sample", io.SUBMISSION_SCHEMA)
    assert io.read_optional_csv(spark, f"{base}/none", io.SUBMISSION_SCHEMA) is None
    return sample_id_check(test.where("ingest_seq % 10 <> 9"), sample)


@register("best_params", oracle.with_derived() + "\nSELECT split, CAST(count(*) AS BIGINT) AS rows FROM trj GROUP BY split")
def best_params(spark, sf_dir):
    """A parameter file written from the tables' own counts and read back."""
    base = _folder(spark)
    counts = {r["split"]: {"rows": r["count"]} for r in gps_trajectories(spark, sf_dir).groupBy("split").count().collect()}
    write_best_params(spark, counts, f"{base}/best")
    back = read_best_params(spark, f"{base}/best")
    return spark.createDataFrame([(k, v["rows"]) for k, v in back.items()], "split string, rows long")
