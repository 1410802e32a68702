import math

import pytest
from pyspark.sql import functions as F

from geotrace.functions import geo
from geotrace.operators import quality
from geotrace.sources.io import parse_path

# Known city pairs used by the reference's self-checks.
SAO_PAULO = (-23.550520, -46.633308)
RIO = (-22.906847, -43.172897)
BRASILIA = (-15.793889, -47.882778)


def test_haversine_known_pairs(spark):
    df = spark.createDataFrame([(*SAO_PAULO, *SAO_PAULO), (*SAO_PAULO, *RIO), (*SAO_PAULO, *BRASILIA)],
                               "a1 double, o1 double, a2 double, o2 double")
    d = [r[0] for r in df.select(geo.haversine_km("a1", "o1", "a2", "o2")).collect()]
    assert d[0] == 0.0
    assert 338 <= d[1] <= 378
    assert 852 <= d[2] <= 892


def test_antipodal_and_antimeridian_are_finite(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 180.0), (10.0, 179.9, 10.0, -179.9), (90.0, 0.0, -90.0, 0.0)],
                               "a1 double, o1 double, a2 double, o2 double")
    d = [r[0] for r in df.select(geo.haversine_km("a1", "o1", "a2", "o2")).collect()]
    assert all(math.isfinite(x) for x in d)
    assert d[0] == pytest.approx(math.pi * 6371.0)
    assert d[1] < 25


def test_local_xy_roundtrip(spark):
    df = spark.createDataFrame([(39.9, 116.4, 40.1, 116.2), (-23.5, -46.6, -23.6, -46.0)],
                               "a0 double, o0 double, a double, o double")
    dx, dy = geo.to_local_xy("a0", "o0", "a", "o")
    la, lo = geo.from_local_xy("a0", "o0", dx, dy)
    for r in df.select(la.alias("la"), lo.alias("lo"), "a", "o").collect():
        assert r["la"] == pytest.approx(r["a"], abs=1e-9)
        assert r["lo"] == pytest.approx(r["o"], abs=1e-9)


def test_bearing_degrees(spark):
    df = spark.createDataFrame([(0.0, 0.0, 1.0, 0.0), (0.0, 0.0, 0.0, 1.0), (0.0, 0.0, -1.0, 0.0),
                                (0.0, 0.0, 0.0, -1.0)], "a1 double, o1 double, a2 double, o2 double")
    b = [r[0] for r in df.select(geo.bearing_deg(geo.bearing("a1", "o1", "a2", "o2"))).collect()]
    assert b == pytest.approx([0.0, 90.0, 180.0, 270.0])


@pytest.mark.parametrize("text,expected", [
    ("[1.5, 2]", [1.5, 2.0]), ("(1.0, 2)", [1.0, 2.0]), ("[1,]", [1.0]), ("  [3]  ", [3.0]),
    ("", []), (None, []), ("[1,", []), ("[NaN, 1]", []), ("[1, null]", []), ("7", []), ("[]", []),
])
def test_parse_rules(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(parse_path("t")).first()[0] == expected


def test_cleaning_rules(spark):
    rows = [
        ("a", "train", [1.0, 2.0], [1.0, 2.0], "10", "20", 1),
        ("a", "train", [5.0, 6.0], [5.0, 6.0], "11", "21", 0),       # same id, earlier -> wins
        ("128_20090222093321", "train", [1.0, 2.0], [1.0, 2.0], "1", "1", 2),   # excluded in train
        ("128_20090222093321", "test", [1.0, 2.0], [1.0, 2.0], None, None, 3),  # kept in test
        ("short", "train", [1.0], [1.0], "1", "1", 4),                 # < 2 points
        ("nodest", "train", [1.0, 2.0], [1.0, 2.0], "x", "1", 5),      # 'x' -> NULL -> dropped
        ("t1", "test", None, None, None, None, 6),                     # NULL path -> []
    ]
    df = spark.createDataFrame(rows, "trajectory_id string, split string, path_lat array<double>, "
                                     "path_lon array<double>, dest_lat string, dest_lon string, ingest_seq long")
    out = {(r["split"], r["trajectory_id"]): r for r in quality.clean(df).collect()}
    assert set(out) == {("train", "a"), ("test", "128_20090222093321"), ("test", "t1")}
    assert out[("train", "a")]["path_lat"] == [5.0, 6.0]
    assert out[("train", "a")]["dest_lat"] == 11.0
    assert out[("test", "t1")]["path_lat"] == []


def test_null_profile_and_summary(spark, traj_df):
    df = traj_df([("a", [1.0], [1.0], None, None), ("b", [], [], 1.0, 1.0)])
    p = quality.null_profile(df).first()
    assert p["rows"] == 2 and p["null_cells"] == 2 and p["empty_paths"] == 1
    s = quality.data_summary(df).first()
    assert s["has_target"] is True


def test_validate_submission(spark):
    sub = spark.createDataFrame([("a", 10.0, 200.0), ("a", None, 1.0)],
                                "trajectory_id string, latitude_pred double, longitude_pred double")
    r = quality.validate_submission(sub).first()
    assert r["duplicate_ids"] == 1 and r["null_lat"] == 1 and r["lon_in_range"] is False
    with pytest.raises(quality.MissingColumnsError):
        quality.validate_submission(sub.drop("latitude_pred"))


def test_csv_roundtrip(spark, traj_df, tmp_path):
    from geotrace.sources.io import read_trajectory_csv, save_trajectories_csv
    df = traj_df([("a", [39.9, 39.91], [116.4, 116.41], 40.0, 116.5)])
    path = str(tmp_path / "train")
    save_trajectories_csv(df.select("trajectory_id", "path_lat", "path_lon", "dest_lat", "dest_lon"), path)
    back = read_trajectory_csv(spark, path, "train").first()
    assert back["path_lat"] == [39.9, 39.91] and back["dest_lat"] == "40.0"
    assert F is not None
