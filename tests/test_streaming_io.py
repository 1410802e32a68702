import os
import time

from pyspark.sql import functions as F

from geotrace.operators import prepare as P
from geotrace.operators.features import FEATURE_NAMES, LEAKY_FEATURES, extract_features
from geotrace.operators.models import MultiTargetRegressor, builder
from geotrace.operators.validation import read_best_params, write_best_params
from geotrace.sources.fixtures import gps_trajectories
from geotrace.sources.io import latest_submission, write_submission
from geotrace.streaming.scoring import score_stream
from tests.conftest import SF001


def test_stream_scores_every_arriving_trajectory(spark, tmp_path):
    t = gps_trajectories(spark, SF001)
    train = t.where("split = 'train' AND size(path_lat) >= 2")
    test = t.where("split = 'test'")
    cols = [c for c in FEATURE_NAMES if c not in LEAKY_FEATURES]
    keep = ["dest_lat", "dest_lon", "ingest_seq"]
    prep = P.prepare(extract_features(train, keep=keep), extract_features(test, keep=keep), cols)
    model = MultiTargetRegressor(builder("Ridge"), prep.target_cols).fit(prep.train)
    src, sink = str(tmp_path / "in"), str(tmp_path / "out")
    test.select("trajectory_id", "path_lat", "path_lon").write.parquet(src)
    q = score_stream(spark, src, sink, model, prep, name=f"t{int(time.time())}")
    q.awaitTermination(120)
    out = spark.read.parquet(sink)
    assert out.count() == test.count()
    assert out.where(F.col("latitude_pred").isNull() & (F.col("trajectory_id").isNotNull())).count() <= \
        test.where("size(path_lat) = 0").count()


def test_latest_submission_and_params(spark, tmp_path):
    import datetime as dt
    a = spark.createDataFrame([("x", 1.0, 2.0)], "trajectory_id string, latitude_pred double, longitude_pred double")
    b = spark.createDataFrame([("y", 3.0, 4.0), ("z", 5.0, 6.0)],
                              "trajectory_id string, latitude_pred double, longitude_pred double")
    base = str(tmp_path)
    write_submission(a, base, "m1", dt.datetime(2024, 1, 1, 0, 0, 0))
    time.sleep(1.1)
    p2 = write_submission(b, base, "m2", dt.datetime(2024, 1, 2, 0, 0, 0))
    assert os.path.basename(p2) == "submission_m2_20240102_000000.csv"
    got = sorted(r["trajectory_id"] for r in latest_submission(spark, f"{base}/submission_*.csv").collect())
    assert got == ["y", "z"]
    write_best_params(spark, {"GradientBoosting": {"maxIter": 50}}, str(tmp_path / "best"))
    assert read_best_params(spark, str(tmp_path / "best")) == {"GradientBoosting": {"maxIter": 50}}
