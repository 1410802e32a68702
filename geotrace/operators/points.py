"""Points and segments of trajectory rows.

A trajectory row holds its whole path, so a point's predecessors are in the same
row: ``get(path, pos - 1)``. Exploding a row therefore yields each point together
with the segment that ends at it and the turn into that segment, with no window and
no shuffle. Every later per-trajectory aggregate is partially aggregated in the same
task, so only one buffer row per trajectory crosses the exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geotrace.functions import geo


def _at(arr: str, idx: Column) -> Column:
    """0-based element, NULL when out of range (also for negative indexes)."""
    return F.get(F.col(arr), idx)


def explode_points(traj: DataFrame, keep: list[str] | None = None, outer: bool = True) -> DataFrame:
    """``trajectory_id, [keep...], n, pos, lat, lon, plat, plon, pplat, pplon``.

    ``pos`` is 0-based. ``outer`` keeps empty paths as one row with NULL pos, so that
    aggregates over the exploded rows still return one row for every trajectory.
    """
    keep = keep or []
    cols = ["trajectory_id", *keep, "path_lat", "path_lon"]
    explode = F.posexplode_outer if outer else F.posexplode
    e = traj.select(*cols, F.size("path_lat").alias("n"), explode("path_lat").alias("pos", "lat"))
    pos = F.col("pos")
    return e.select(
        "trajectory_id", *keep, "n", "pos", "lat",
        _at("path_lon", pos).alias("lon"),
        _at("path_lat", pos - 1).alias("plat"), _at("path_lon", pos - 1).alias("plon"),
        _at("path_lat", pos - 2).alias("pplat"), _at("path_lon", pos - 2).alias("pplon"))


def with_segments(points: DataFrame) -> DataFrame:
    """Add the segment ending at each point and the turn into it.

    seg (m), brg (rad), bdeg (deg 0-360): segment from point pos-1 to pos (NULL at pos 0);
    pseg, pbrg: the previous segment; acc = seg - pseg; chg = |brg - pbrg| (not wrapped,
    as defined by the feature, D18). NULL where the points do not exist.
    """
    seg = geo.haversine("plat", "plon", "lat", "lon")
    brg = geo.bearing("plat", "plon", "lat", "lon")
    pseg = geo.haversine("pplat", "pplon", "plat", "plon")
    pbrg = geo.bearing("pplat", "pplon", "plat", "plon")
    return (points
            .withColumn("seg", seg).withColumn("brg", brg)
            .withColumn("pseg", pseg).withColumn("pbrg", pbrg)
            .withColumn("bdeg", geo.bearing_deg(F.col("brg")))
            .withColumn("acc", F.col("seg") - F.col("pseg"))
            .withColumn("chg", F.abs(F.col("brg") - F.col("pbrg"))))


def points_table(traj: DataFrame) -> DataFrame:
    """Long ``trajectory_id, pos, lat, lon`` table (non-empty paths only)."""
    return explode_points(traj, outer=False).select("trajectory_id", "pos", "lat", "lon")


def segments_table(traj: DataFrame) -> DataFrame:
    """``trajectory_id, pos, seg_m, bearing`` for every segment (pos = index of its end point)."""
    s = with_segments(explode_points(traj, outer=False)).where(F.col("pos") >= 1)
    return s.select("trajectory_id", "pos", F.col("seg").alias("seg_m"), F.col("brg").alias("bearing"))
