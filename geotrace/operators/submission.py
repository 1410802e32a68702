"""Predictions, submissions, statistics and map data.

Maps are re-aimed as GeoJSON layers: one Feature per row, built with ``to_json``; the
HTML drawing itself is not rebuilt. Lookups are left joins on ``trajectory_id``;
scalar decisions (unit sniffing, map centre) are 1-row aggregates used as scalar
subqueries.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geotrace.functions import geo

# Map centre fallback and how many train rows define the centre.
DEFAULT_CENTRE = (39.9, 116.4)
CENTRE_ROWS = 100


def path_starts(traj: DataFrame) -> DataFrame:
    return traj.select("trajectory_id", F.get(F.col("path_lat"), F.lit(0)).alias("start_lat"),
                       F.get(F.col("path_lon"), F.lit(0)).alias("start_lon"))


def predict_latlon(model, design: DataFrame, targets: tuple[str, str] = ("dx", "dy"),
                   y_unit: str = "meters") -> DataFrame:
    """Model predictions back in degrees, using each row's own start point."""
    p = model.transform(design)
    t0, t1 = targets
    if y_unit == "meters":
        la, lo = geo.from_local_xy("start_lat", "start_lon", F.col(f"pred_{t0}"), F.col(f"pred_{t1}"))
    else:
        la, lo = F.col(f"pred_{t0}"), F.col(f"pred_{t1}")
    return p.select("trajectory_id", la.alias("latitude_pred"), lo.alias("longitude_pred"))


def build_submission(pred: DataFrame, traj: DataFrame, a: str = "a", b: str = "b", unit: str | None = None) -> DataFrame:
    """``trajectory_id, latitude_pred, longitude_pred`` from raw two-column predictions.

    ``unit`` is "meters" or "degrees". Without it, any absolute value over 180 means that the
    predictions are metres (dx, dy) from the path start. Metres are converted per id; ids
    without a path keep their raw values.
    """
    if unit is None:
        is_metres = pred.select(F.max(F.greatest(F.abs(F.col(a)), F.abs(F.col(b)))) > 180).scalar()
    else:
        is_metres = F.lit(unit == "meters")
    j = pred.join(path_starts(traj), "trajectory_id", "left")
    la, lo = geo.from_local_xy("start_lat", "start_lon", F.col(a), F.col(b))
    conv = is_metres & F.col("start_lat").isNotNull() & F.col("start_lon").isNotNull()
    return j.select("trajectory_id",
                    F.when(conv, la).otherwise(F.col(a)).alias("latitude_pred"),
                    F.when(conv, lo).otherwise(F.col(b)).alias("longitude_pred"))


def prediction_stats(sub: DataFrame, order: str | None = None, n_first: int = 5):
    """One-row statistics and the first ``n_first`` rows (top-k by ``order``)."""
    stats = sub.agg(F.count(F.lit(1)).alias("count"),
                    F.min("latitude_pred").alias("min_lat"), F.max("latitude_pred").alias("max_lat"),
                    F.min("longitude_pred").alias("min_lon"), F.max("longitude_pred").alias("max_lon"))
    first = sub.orderBy(order or "trajectory_id").limit(n_first)
    return stats, first


def run_report(model_name: str, n_train: int, n_test: int, n_features: int, outliers_flagged: int,
                    outliers_removed: int, best_error_km: float | None, spark) -> DataFrame:
    """One-row run report (both outlier counts, before and after the safety rule, D17)."""
    return spark.createDataFrame(
        [(model_name, n_train, n_test, n_features, outliers_flagged, outliers_removed, best_error_km)],
        "model string, train_rows long, test_rows long, feature_columns long, outliers_flagged long, "
        "outliers_removed long, best_cv_error_km double")


def _linestring(lat: str = "path_lat", lon: str = "path_lon") -> Column:
    coords = F.transform(F.arrays_zip(F.col(lon).alias("x"), F.col(lat).alias("y")),
                         lambda p: F.array(p["x"], p["y"]))
    return coords


def path_layer(traj: DataFrame, layer: str, n: int | None = None, order: str = "ingest_seq") -> DataFrame:
    """One GeoJSON LineString Feature per path (paths with <= 1 point skipped; first ``n`` by order)."""
    t = traj.where(F.size("path_lat") > 1)
    if n is not None:
        t = t.orderBy(order, "trajectory_id").limit(n)
    geom = F.struct(F.lit("LineString").alias("type"), _linestring().alias("coordinates"))
    props = F.struct(F.col("trajectory_id").alias("trajectory_id"), F.lit(layer).alias("layer"))
    feat = F.struct(F.lit("Feature").alias("type"), geom.alias("geometry"), props.alias("properties"))
    return t.select(F.lit(layer).alias("layer"), "trajectory_id", F.size("path_lat").alias("n_coords"),
                    F.get(F.col("path_lat"), F.lit(0)).alias("start_lat"),
                    F.get(F.col("path_lon"), F.lit(0)).alias("start_lon"),
                    F.element_at("path_lat", -1).alias("end_lat"), F.element_at("path_lon", -1).alias("end_lon"),
                    F.to_json(feat).alias("geojson"))


def point_layer(df: DataFrame, layer: str, lat: str, lon: str, n: int | None = None,
                order: str = "trajectory_id") -> DataFrame:
    """One GeoJSON Point Feature per row (prediction markers)."""
    t = df.where(F.col(lat).isNotNull() & F.col(lon).isNotNull())
    if n is not None:
        t = t.orderBy(order).limit(n)
    geom = F.struct(F.lit("Point").alias("type"), F.array(F.col(lon), F.col(lat)).alias("coordinates"))
    props = F.struct(F.col("trajectory_id").alias("trajectory_id"), F.lit(layer).alias("layer"))
    feat = F.struct(F.lit("Feature").alias("type"), geom.alias("geometry"), props.alias("properties"))
    return t.select(F.lit(layer).alias("layer"), "trajectory_id", F.lit(1).alias("n_coords"),
                    F.col(lat).alias("start_lat"), F.col(lon).alias("start_lon"),
                    F.col(lat).alias("end_lat"), F.col(lon).alias("end_lon"), F.to_json(feat).alias("geojson"))


def map_centre(train: DataFrame, order: str = "ingest_seq") -> Column:
    """Mean of all points of the first 100 train rows, fallback (39.9, 116.4); scalar subquery."""
    first = train.orderBy(order, "trajectory_id").limit(CENTRE_ROWS)
    pts = first.select(F.explode(F.arrays_zip("path_lat", "path_lon")).alias("p"))
    return pts.select(F.struct(F.coalesce(F.avg("p.path_lat"), F.lit(DEFAULT_CENTRE[0])).alias("lat"),
                               F.coalesce(F.avg("p.path_lon"), F.lit(DEFAULT_CENTRE[1])).alias("lon"))).scalar()


def map_layers(train: DataFrame, test: DataFrame, sub: DataFrame | None, n_train: int | None = 50,
               n_test: int | None = 50, n_pred: int | None = 50) -> DataFrame:
    """Train and test polylines and prediction markers as one GeoJSON feature table."""
    out = path_layer(train, "train", n_train).unionByName(path_layer(test, "test", n_test))
    if sub is not None:
        out = out.unionByName(point_layer(sub, "prediction", "latitude_pred", "longitude_pred", n_pred))
    return out


@F.pandas_udf(T.DoubleType())
def vincenty_km(lat1: pd.Series, lon1: pd.Series, lat2: pd.Series, lon2: pd.Series) -> pd.Series:
    """WGS-84 ellipsoidal distance (Vincenty inverse), km; haversine where it does not converge."""
    a, f = 6378137.0, 1 / 298.257223563
    b = (1 - f) * a
    p1, p2 = np.radians(lat1.to_numpy(float)), np.radians(lat2.to_numpy(float))
    L = np.radians(lon2.to_numpy(float) - lon1.to_numpy(float))
    U1, U2 = np.arctan((1 - f) * np.tan(p1)), np.arctan((1 - f) * np.tan(p2))
    sU1, cU1, sU2, cU2 = np.sin(U1), np.cos(U1), np.sin(U2), np.cos(U2)
    lam = L.copy()
    conv = np.zeros(len(L), bool)
    with np.errstate(all="ignore"):
        for _ in range(200):
            sl, cl = np.sin(lam), np.cos(lam)
            ss = np.sqrt((cU2 * sl) ** 2 + (cU1 * sU2 - sU1 * cU2 * cl) ** 2)
            cs = sU1 * sU2 + cU1 * cU2 * cl
            sig = np.arctan2(ss, cs)
            sa = np.where(ss == 0, 0.0, cU1 * cU2 * sl / np.where(ss == 0, 1, ss))
            c2a = 1 - sa ** 2
            c2sm = np.where(c2a == 0, 0.0, cs - 2 * sU1 * sU2 / np.where(c2a == 0, 1, c2a))
            C = f / 16 * c2a * (4 + f * (4 - 3 * c2a))
            prev = lam
            lam = L + (1 - C) * f * sa * (sig + C * ss * (c2sm + C * cs * (-1 + 2 * c2sm ** 2)))
            conv = np.abs(lam - prev) < 1e-12
            if conv.all():
                break
        u2 = c2a * (a * a - b * b) / (b * b)
        A = 1 + u2 / 16384 * (4096 + u2 * (-768 + u2 * (320 - 175 * u2)))
        B = u2 / 1024 * (256 + u2 * (-128 + u2 * (74 - 47 * u2)))
        ds = B * ss * (c2sm + B / 4 * (cs * (-1 + 2 * c2sm ** 2) - B / 6 * c2sm * (-3 + 4 * ss ** 2)
                                        * (-3 + 4 * c2sm ** 2)))
        s = b * A * (sig - ds) / 1000.0
        dphi, dl = p2 - p1, np.radians(lon2.to_numpy(float) - lon1.to_numpy(float))
        h = np.sin(dphi / 2) ** 2 + np.cos(p1) * np.cos(p2) * np.sin(dl / 2) ** 2
        hav = 2 * 6371.0 * np.arctan2(np.sqrt(h), np.sqrt(np.maximum(1 - h, 0)))
    return pd.Series(np.where(conv & np.isfinite(s), s, hav))


def prediction_comparison(traj: DataFrame, sub: DataFrame, geodesic: bool = False) -> DataFrame:
    """X7 for all rows: last path point vs prediction, distance (km) and midpoint."""
    t = traj.where(F.size("path_lat") > 0).select(
        "trajectory_id", "split", F.element_at("path_lat", -1).alias("last_lat"),
        F.element_at("path_lon", -1).alias("last_lon"))
    j = t.join(sub, "trajectory_id", "left")
    dist = (vincenty_km("last_lat", "last_lon", "latitude_pred", "longitude_pred") if geodesic
            else geo.haversine_km("last_lat", "last_lon", "latitude_pred", "longitude_pred"))
    return j.select("trajectory_id", "split", "last_lat", "last_lon", "latitude_pred", "longitude_pred",
                    dist.alias("distance_km"),
                    ((F.col("last_lat") + F.col("latitude_pred")) / 2).alias("mid_lat"),
                    ((F.col("last_lon") + F.col("longitude_pred")) / 2).alias("mid_lon"))


def trajectory_comparison(traj: DataFrame, sub: DataFrame, trajectory_id: str, geodesic: bool = True) -> DataFrame:
    """X7 for one id: the train row if present, else the test row, with its prediction."""
    t = traj.where(F.col("trajectory_id") == trajectory_id)
    pick = t.select(F.min_by("split", F.when(F.col("split") == "train", 0).otherwise(1))).scalar()
    return prediction_comparison(t.where(F.col("split") == pick), sub, geodesic)

