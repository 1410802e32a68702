"""Stochastic path augmentation (A1-A4), row-local and deterministic.

Every draw is a hash of (seed, trajectory_id, point index, tag), so a row gets the same
augmentation wherever and however often it is computed. All work stays inside the
row (array functions), so augmentation adds no shuffle. Row count and destinations
never change; a ``method`` column records what was applied.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geotrace.functions import geo
from geotrace.functions.hashrand import uniform_md5

# Fixed values of the augmentation rules.
JITTER_SIGMA_M = 5.0
DROP_PROB = 0.1
ROTATE_MAX_DEG = 10.0
METHODS = ["jitter", "drop", "rotate"]


def _pts() -> Column:
    return F.arrays_zip(F.col("path_lat").alias("lat"), F.col("path_lon").alias("lon"))


def _normal(seed: int, i: Column, tag: str) -> Column:
    """Standard normal draw for point ``i`` of a row (Box-Muller on two hashed uniforms)."""
    u1 = F.lit(1.0) - uniform_md5(seed, tag + "1", "trajectory_id", i)  # (0, 1]
    u2 = uniform_md5(seed, tag + "2", "trajectory_id", i)
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2 * math.pi) * u2)


def jitter(seed: int, sigma_m: float = JITTER_SIGMA_M) -> tuple[Column, Column]:
    """A1: Gaussian noise of ``sigma_m`` metres per point, each point its own reference."""
    def moved(p, i):
        dx = F.lit(sigma_m) * _normal(seed, i, "jx")
        dy = F.lit(sigma_m) * _normal(seed, i, "jy")
        la, lo = geo.from_local_xy(p["lat"], p["lon"], dx, dy)
        return F.struct(la.alias("lat"), lo.alias("lon"))
    moved_pts = F.transform(_pts(), moved)
    return moved_pts["lat"], moved_pts["lon"]


def drop_points(seed: int, prob: float = DROP_PROB) -> tuple[Column, Column]:
    """A2: drop each interior point with probability ``prob``; first and last stay; <= 2 points unchanged."""
    n = F.size("path_lat")
    idx = F.transform(_pts(), lambda p, i: F.struct(p["lat"].alias("lat"), p["lon"].alias("lon"), i.alias("i")))
    kept = F.filter(idx, lambda p: (p["i"] == 0) | (p["i"] == n - 1)
                    | (uniform_md5(seed, "drop", "trajectory_id", p["i"]) >= F.lit(prob)))
    kept = F.when(n <= 2, idx).otherwise(kept)
    return kept["lat"], kept["lon"]


def rotate(seed: int, max_deg: float = ROTATE_MAX_DEG, angle_deg: Column | None = None) -> tuple[Column, Column]:
    """A3: rotate around the centroid by U(-max, max) degrees in local metres."""
    n = F.size("path_lat")
    c_lat = F.aggregate("path_lat", F.lit(0.0), lambda a, x: a + x) / n
    c_lon = F.aggregate("path_lon", F.lit(0.0), lambda a, x: a + x) / n
    if angle_deg is None:
        angle_deg = F.lit(-max_deg) + F.lit(2 * max_deg) * uniform_md5(seed, "angle", "trajectory_id")
    th = angle_deg * F.lit(math.pi / 180.0)

    def turned(p):
        dx, dy = geo.to_local_xy(c_lat, c_lon, p["lat"], p["lon"])
        rx = dx * F.cos(th) - dy * F.sin(th)
        ry = dx * F.sin(th) + dy * F.cos(th)
        la, lo = geo.from_local_xy(c_lat, c_lon, rx, ry)
        return F.struct(la.alias("lat"), lo.alias("lon"))
    out = F.transform(_pts(), turned)
    return out["lat"], out["lon"]


def augment(traj: DataFrame, methods: list[str] | None = None, p: float = 0.5, seed: int = 42) -> DataFrame:
    """A4: with probability ``p`` per row apply one method chosen uniformly; empty paths untouched."""
    methods = methods or METHODS
    u = uniform_md5(seed, "apply", "trajectory_id")
    pick = F.floor(uniform_md5(seed, "method", "trajectory_id") * len(methods)).cast("int")
    chosen = F.element_at(F.array(*[F.lit(m) for m in methods]), pick + 1)
    method = F.when((F.size("path_lat") > 0) & (u < p), chosen)
    out = traj.withColumn("method", method)
    impl = {"jitter": jitter(seed), "drop": drop_points(seed), "rotate": rotate(seed)}
    lat, lon = F.col("path_lat"), F.col("path_lon")
    for m in methods:
        la, lo = impl[m]
        lat = F.when(F.col("method") == m, la).otherwise(lat)
        lon = F.when(F.col("method") == m, lo).otherwise(lon)
    return out.withColumn("_lat", lat).withColumn("path_lon", lon).withColumn("path_lat", F.col("_lat")).drop("_lat")
