import json

import pytest
from pyspark.sql import functions as F

from geotrace.operators import submission as X


def test_vincenty_known_distances(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 1.0), (-23.550520, -46.633308, -22.906847, -43.172897),
                                (10.0, 10.0, 10.0, 10.0)], "a1 double, o1 double, a2 double, o2 double")
    d = [r[0] for r in df.select(X.vincenty_km("a1", "o1", "a2", "o2")).collect()]
    assert d[0] == pytest.approx(111.3195, abs=1e-3)      # one degree of longitude on the WGS-84 equator
    assert 350 < d[1] < 365 and d[2] == pytest.approx(0.0, abs=1e-9)


def test_trajectory_comparison_prefers_train(spark, traj_df):
    train = traj_df([("a", [10.0, 10.1], [20.0, 20.1], 11.0, 21.0)])
    test = traj_df([("a", [30.0, 30.1], [40.0, 40.1], None, None)], split="test")
    sub = spark.createDataFrame([("a", 10.2, 20.2)], "trajectory_id string, latitude_pred double, longitude_pred double")
    r = X.trajectory_comparison(train.unionByName(test), sub, "a").first()
    assert r["split"] == "train" and r["last_lat"] == 10.1
    assert r["mid_lat"] == pytest.approx(10.15) and r["distance_km"] == pytest.approx(15.6, abs=0.2)


def test_map_layers_geojson_and_centre(spark, traj_df):
    train = traj_df([("a", [1.0, 2.0], [3.0, 4.0], 5.0, 6.0), ("b", [7.0], [8.0], 5.0, 6.0)])
    test = traj_df([("c", [1.0, 1.5, 2.0], [3.0, 3.5, 4.0], None, None)], split="test")
    sub = spark.createDataFrame([("c", 2.5, 4.5)], "trajectory_id string, latitude_pred double, longitude_pred double")
    layers = {r["trajectory_id"]: r for r in X.map_layers(train, test, sub).collect()}
    assert "b" not in layers                              # a single point draws no line
    g = json.loads(layers["a"]["geojson"])
    assert g["geometry"] == {"type": "LineString", "coordinates": [[3.0, 1.0], [4.0, 2.0]]}
    assert layers["c"]["layer"] in ("test", "prediction")
    centre = spark.range(1).select(X.map_centre(train).alias("c")).first()["c"]
    assert (centre["lat"], centre["lon"]) == pytest.approx((10.0 / 3, 5.0))
    empty = train.where(F.lit(False))
    centre = spark.range(1).select(X.map_centre(empty).alias("c")).first()["c"]
    assert (centre["lat"], centre["lon"]) == (39.9, 116.4)
