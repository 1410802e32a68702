"""Outlier masks, combination, cap, safety rule, removal and report.

Path masks (geographic, jump/speed, target) are computed inside each trajectory row:
``array_min`` / ``array_max`` and one ``aggregate`` over the segment indexes. The
masks land on the same row as the path, so removing outliers is a filter, never a
join back. Global statistics (distribution bounds, IQR bounds, shares) are 1-row
aggregates attached as scalar subqueries; percentiles are exact at every size
(see quantiles.py).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geotrace.functions import geo
from geotrace.operators.quantiles import quantiles
from geotrace.operators.ranking import global_rank

MASKS = ["is_geographic", "is_bounds", "is_trajectory", "is_target", "is_features_iqr", "is_features_isolation"]
MASKS_OF_PATHS = ["is_geographic", "is_trajectory", "is_target"]
TYPE_NAMES = {"is_geographic": "geographic", "is_bounds": "bounds", "is_trajectory": "trajectory",
              "is_target": "target", "is_features_iqr": "features_iqr",
              "is_features_isolation": "features_isolation"}


@dataclass
class OutlierConfig:
    """Detector parameters. Defaults are the pipeline's settings (not the class defaults)."""
    lat_range: tuple[float, float] = (18.0, 54.0)
    lon_range: tuple[float, float] = (73.0, 135.0)
    max_jump_km: float = 200.0
    max_speed_kmh: float = 500.0
    problem_ratio: float = 0.1
    contamination: float = 0.03
    max_outlier_pct: float = 0.08
    iqr_factor: float = 3.0
    iqr_share: float = 0.2
    safety_share: float = 0.03

    @classmethod
    def reference_defaults(cls) -> "OutlierConfig":
        """The detector's own defaults (world box, 500 km, 800 km/h, 5 %, 20 %)."""
        return cls(lat_range=(-90.0, 90.0), lon_range=(-180.0, 180.0), max_jump_km=500.0,
                   max_speed_kmh=800.0, contamination=0.05, max_outlier_pct=0.20)


def geographic_mask(cfg: OutlierConfig) -> Column:
    """O1: empty path, or any point strictly outside the box."""
    lo_a, hi_a = cfg.lat_range
    lo_o, hi_o = cfg.lon_range
    n = F.coalesce(F.least(F.size("path_lat"), F.size("path_lon")), F.lit(0))
    out = ((F.array_min("path_lat") < lo_a) | (F.array_max("path_lat") > hi_a)
           | (F.array_min("path_lon") < lo_o) | (F.array_max("path_lon") > hi_o))
    return (n == 0) | F.coalesce(out, F.lit(False))


def trajectory_mask(cfg: OutlierConfig) -> Column:
    """O3: (#segments > max jump + #segments faster than max speed) / #segments > ratio.

    Segments are 1 s apart, so km/h = km * 3600. Paths with < 2 points are never flagged.
    """
    n = F.size("path_lat")

    def seg_km(i):
        return geo.haversine_km(F.get(F.col("path_lat"), i - 1), F.get(F.col("path_lon"), i - 1),
                                F.get(F.col("path_lat"), i), F.get(F.col("path_lon"), i))

    def bad(i):
        d = seg_km(i)
        return ((d > F.lit(cfg.max_jump_km)).cast("int")
                + (d * F.lit(3600.0) > F.lit(cfg.max_speed_kmh)).cast("int"))

    hits = F.aggregate(F.transform(F.sequence(F.lit(1), n - 1), bad), F.lit(0), lambda a, x: a + x)
    return F.when(n >= 2, (hits / (n - 1)) > F.lit(cfg.problem_ratio)).otherwise(F.lit(False))


def segment_problem_counts(traj: DataFrame, cfg: OutlierConfig) -> DataFrame:
    """Jump and speed counts per trajectory (the numbers behind O3), from exploded segments."""
    from geotrace.operators.points import segments_table
    s = segments_table(traj).withColumn("km", F.col("seg_m") / 1000.0)
    return s.groupBy("trajectory_id").agg(
        F.count_if(F.col("km") > cfg.max_jump_km).alias("large_jumps"),
        F.count_if(F.col("km") * 3600.0 > cfg.max_speed_kmh).alias("extreme_speeds"),
        F.count(F.lit(1)).alias("segments"))


def target_mask(cfg: OutlierConfig) -> Column:
    """Destination outside the box; NULL compares false."""
    lo_a, hi_a = cfg.lat_range
    lo_o, hi_o = cfg.lon_range
    bad = ((F.col("dest_lat") < lo_a) | (F.col("dest_lat") > hi_a)
           | (F.col("dest_lon") < lo_o) | (F.col("dest_lon") > hi_o))
    return F.coalesce(bad, F.lit(False))


def add_bounds_mask(traj: DataFrame) -> DataFrame:
    """O2: global p1/p99 of all points, widened by 10 % of the spread; flag paths leaving them.

    Rows with an empty path are not flagged here (they are geographic outliers already).
    """
    pts = traj.select(F.explode(F.arrays_zip("path_lat", "path_lon")).alias("p")).select("p.*")
    found = quantiles(pts, ["path_lat", "path_lon"], [0.01, 0.99])
    out = F.lit(False)
    for c, pair in found.items():
        if pair is not None:
            lo, hi = pair[0] - 0.1 * (pair[1] - pair[0]), pair[1] + 0.1 * (pair[1] - pair[0])
            out = out | (F.array_min(c) < lo) | (F.array_max(c) > hi)
    return traj.withColumn("is_bounds", F.coalesce(F.size("path_lat") > 0, F.lit(False)) & F.coalesce(out, F.lit(False)))


def add_iqr_mask(feats: DataFrame, cols: list[str], cfg: OutlierConfig | None = None) -> DataFrame:
    """Per column, outside [Q1 - f*IQR, Q3 + f*IQR] (columns with IQR = 0 skipped);
    flagged when at least ``max(1, int(share * #columns))`` columns are out.

    Adds ``iqr_hits`` (count of columns out of range) and ``is_features_iqr``.
    """
    cfg = cfg or OutlierConfig()
    row = quantiles(feats, cols, [0.25, 0.75])
    hits = F.lit(0)
    for c in cols:
        if row[c] is None:
            continue
        q1, q3 = row[c]
        iqr = q3 - q1
        if iqr == 0:
            continue
        out = (F.col(c) < F.lit(q1 - cfg.iqr_factor * iqr)) | (F.col(c) > F.lit(q3 + cfg.iqr_factor * iqr))
        hits = hits + out.cast("int")
    threshold = max(1, int(len(cols) * cfg.iqr_share))
    return feats.withColumn("iqr_hits", hits).withColumn("is_features_iqr", F.col("iqr_hits") >= threshold)


def add_path_masks(traj: DataFrame, cfg: OutlierConfig | None = None, geographic: bool = True,
                   trajectory: bool = True, target: bool = True) -> DataFrame:
    """O7 for the path-based detectors: one boolean column per selected type."""
    cfg = cfg or OutlierConfig()
    out = traj
    if geographic:
        out = out.withColumn("is_geographic", geographic_mask(cfg))
    if trajectory:
        out = out.withColumn("is_trajectory", trajectory_mask(cfg))
    if target and "dest_lat" in traj.columns:
        out = out.withColumn("is_target", target_mask(cfg))
    return out


def present_masks(df: DataFrame) -> list[str]:
    return [m for m in MASKS if m in df.columns]


def combine(df: DataFrame, method: str = "any", masks: list[str] | None = None, name: str = "is_outlier") -> DataFrame:
    """OR ('any') or AND ('all') of the mask columns."""
    masks = masks or present_masks(df)
    if not masks:
        return df.withColumn(name, F.lit(False))
    if method == "any":
        expr = reduce(lambda a, b: a | b, [F.col(m) for m in masks])
    elif method == "all":
        expr = reduce(lambda a, b: a & b, [F.col(m) for m in masks])
    else:
        raise ValueError(f"unknown method {method!r}; use 'any' or 'all'")
    return df.withColumn(name, expr)


def outlier_score(masks: list[str]) -> Column:
    """Number of types flagged + 3 x geographic + 2 x trajectory (the cap's priority)."""
    s = sum((F.col(m).cast("int") for m in masks), F.lit(0))
    if "is_geographic" in masks:
        s = s + 3 * F.col("is_geographic").cast("int")
    if "is_trajectory" in masks:
        s = s + 2 * F.col("is_trajectory").cast("int")
    return s


def cap(df: DataFrame, max_pct: float, masks: list[str] | None = None, name: str = "is_outlier",
        order: str = "ingest_seq") -> DataFrame:
    """If the flagged share exceeds ``max_pct``, keep only the top ``int(total * max_pct)``
    rows by score (ties: source order) as outliers.

    Scores take a handful of values, so counts by score find the score at the cut; only the
    order numbers of rows with that one score are ranked, and the last one kept becomes a bound.
    """
    masks = masks or present_masks(df)
    scored = df.withColumn("_score", outlier_score(masks))
    counts = scored.groupBy("_score").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(name)).alias("f")).collect()
    total, flagged = sum(r["n"] for r in counts), sum(r["f"] for r in counts)
    if total == 0 or flagged / total <= max_pct:
        return df
    left = int(total * max_pct)
    above = []
    for r in sorted(counts, key=lambda r: -r["_score"]):
        if r["n"] > left:
            break
        above.append(r["_score"])
        left -= r["n"]
    kept = F.col("_score").isin(above) if above else F.lit(False)
    if left:
        tied = global_rank(scored.where(F.col("_score") == r["_score"]).select(order), [F.col(order)], "_rank")
        last = tied.where(F.col("_rank") == left - 1).first()[order]
        kept = kept | ((F.col("_score") == r["_score"]) & (F.col(order) <= F.lit(last)))
    return scored.withColumn(name, kept).drop("_score")


def safety_rule(df: DataFrame, guard: float = 0.03, name: str = "is_outlier") -> DataFrame:
    """If more than ``guard`` of rows are flagged, fall back to geographic OR target only."""
    share = df.select(F.avg(F.col(name).cast("double"))).scalar()
    safe = F.lit(False)
    for m in ("is_geographic", "is_target"):
        if m in df.columns:
            safe = safe | F.col(m)
    return df.withColumn(name, F.when(F.coalesce(share, F.lit(0.0)) > guard, safe).otherwise(F.col(name)))


def remove(df: DataFrame, name: str = "is_outlier") -> DataFrame:
    """Drop flagged rows; if that would drop every row, keep them all."""
    kept = df.select(F.count_if(~F.col(name))).scalar()
    return df.where(~F.col(name) | (kept == 0))


def report(df: DataFrame, name: str = "is_outlier") -> DataFrame:
    """Long table ``type, count, percentage`` (total, combined, clean and each type)."""
    masks = present_masks(df)
    aggs = [F.count(F.lit(1)).alias("total"), F.count_if(F.col(name)).alias("combined")]
    aggs += [F.count_if(F.col(m)).alias(TYPE_NAMES[m]) for m in masks]
    a = df.agg(*aggs)
    names = ["combined", "clean", *[TYPE_NAMES[m] for m in masks]]
    a = a.withColumn("clean", F.col("total") - F.col("combined"))
    pairs = ", ".join(f"'{n}', {n}" for n in ["total", *names])
    long = a.selectExpr(f"stack({len(names) + 1}, {pairs}) AS (type, count)", "total")
    pct = F.when(F.col("total") > 0, F.col("count") * 100.0 / F.col("total")).otherwise(F.lit(0.0))
    return long.select("type", F.col("count").cast("long").alias("count"), pct.alias("percentage"))
