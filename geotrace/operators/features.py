"""Per-trajectory features (F1-F29): 96 numeric columns from one aggregate.

Plan: trajectory rows -> row-local values (start, end, last segments) -> explode with
predecessor points -> one ``groupBy(trajectory_id)``. The aggregate is partial
(map-side) and, because all points of a path come from the same input row, collapses
each trajectory before the exchange. Guards (minimum path length per feature) and the
NULL/NaN/inf -> 0 rule are applied in the final projection.

Semantics follow the reference definitions: distances in metres, speed = segment / 1 s,
population standard deviation, linear-interpolated percentiles, population skewness
and excess kurtosis; features that need >= 3 points are 0 below that (D1).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geotrace.functions import geo
from geotrace.operators.points import explode_points, with_segments

# Output order of the 96 features (the reference's column order).
FEATURE_NAMES = [
    "start_lat", "start_lon", "end_lat", "end_lon", "mean_lat", "mean_lon", "std_lat", "std_lon",
    "median_lat", "median_lon",
    "total_distance", "mean_distance", "std_distance", "straight_distance", "straightness",
    "lat_range", "lon_range", "area_bbox", "aspect_ratio", "centroid_lat", "centroid_lon",
    "num_points", "density",
    "avg_speed_ms", "max_speed_ms", "avg_acc_ms2", "max_acc_ms2",
    "bearing", "bearing_sin", "bearing_cos",
    "direction_variance", "avg_direction_change", "curvature",
    "seg_p10", "seg_p25", "seg_p50", "seg_p75", "seg_p90", "seg_max", "seg_mean", "seg_std",
    "bearing_p10", "bearing_p50", "bearing_p90",
    "speed_p10", "speed_p50", "speed_p90",
    "acc_p10", "acc_p50", "acc_p90",
    "total_turning_angle", "n_significant_turns",
    "last_bearing", "last_speed", "last_direction_change",
    "remaining_distance",
    "lat_slope", "lat_intercept", "lon_slope", "lon_intercept", "trend_magnitude", "trend_bearing",
    "lat_poly_a", "lat_poly_b", "lat_poly_c", "lon_poly_a", "lon_poly_b", "lon_poly_c", "poly_curvature",
    "last_segment_speed", "last_segment_bearing", "last_acceleration",
    "prev_direction_change", "direction_change_trend",
    "centroid_to_end_distance", "centroid_to_end_ratio",
    "start_end_vs_last_angle", "direction_consistency",
    "seg_p5", "seg_p15", "seg_p85", "seg_p95",
    "bearing_p5", "bearing_p15", "bearing_p85", "bearing_p95",
    "speed_p5", "speed_p15", "speed_p85", "speed_p95",
    "seg_skewness", "seg_kurtosis", "speed_skewness", "speed_kurtosis", "bearing_skewness", "bearing_kurtosis",
]
assert len(FEATURE_NAMES) == 96

# Features that read the target; excluded from model vectors unless asked for (D3).
LEAKY_FEATURES = ["remaining_distance"]

# Unit of each feature, used for comparison rounding (see plans.rounding).
FEATURE_KIND = {n: "m" for n in FEATURE_NAMES}
FEATURE_KIND.update({n: "coord" for n in [
    "start_lat", "start_lon", "end_lat", "end_lon", "mean_lat", "mean_lon", "std_lat", "std_lon",
    "median_lat", "median_lon", "lat_range", "lon_range", "centroid_lat", "centroid_lon",
    "lat_intercept", "lon_intercept", "lat_poly_c", "lon_poly_c"]})
FEATURE_KIND.update({n: "deg" for n in [
    "bearing", "bearing_p10", "bearing_p50", "bearing_p90", "total_turning_angle", "last_bearing",
    "last_direction_change", "trend_bearing", "last_segment_bearing", "prev_direction_change",
    "start_end_vs_last_angle", "direction_consistency", "bearing_p5", "bearing_p15", "bearing_p85",
    "bearing_p95"]})
FEATURE_KIND.update({n: "unit" for n in [
    "straightness", "aspect_ratio", "bearing_sin", "bearing_cos", "direction_variance",
    "avg_direction_change", "direction_change_trend", "centroid_to_end_ratio", "curvature", "density",
    "area_bbox",
    "seg_skewness", "seg_kurtosis", "speed_skewness", "speed_kurtosis", "bearing_skewness",
    "bearing_kurtosis"]})
FEATURE_KIND.update({n: "small" for n in [
    "lat_slope", "lon_slope", "trend_magnitude", "lat_poly_a", "lat_poly_b", "lon_poly_a",
    "lon_poly_b", "poly_curvature"]})
FEATURE_KIND.update({"num_points": "count", "n_significant_turns": "count"})

# Fixed values of the feature definitions.
SIGNIFICANT_TURN_DEG = 30.0
CURVATURE_EPS = 1e-6
SEG_PCTS = [0.05, 0.10, 0.15, 0.25, 0.50, 0.75, 0.85, 0.90, 0.95]
BRG_PCTS = [0.05, 0.10, 0.15, 0.50, 0.85, 0.90, 0.95]
ACC_PCTS = [0.10, 0.50, 0.90]

_RAD2DEG = 180.0 / math.pi


def _pt(arr: str, idx: Column) -> Column:
    return F.get(F.col(arr), idx)


RL_FIELDS = ["n", "s_lat", "s_lon", "e_lat", "e_lon", "straight", "brg_se", "b1", "b2", "b3", "seg1", "seg2",
             "remaining", "planar_se"]


def _quantile(sorted_arr: Column, m: Column, p: float) -> Column:
    """Linear-interpolated quantile of an ascending array of length ``m`` (NULL when empty)."""
    h = (m - 1).cast("double") * F.lit(p)
    lo = F.floor(h).cast("int")
    hi = F.ceil(h).cast("int")
    a_lo, a_hi = F.get(sorted_arr, lo), F.get(sorted_arr, hi)
    return F.when(m > 0, a_lo + (h - lo) * (a_hi - a_lo))


def _row_values(traj: DataFrame, keep: list[str]) -> DataFrame:
    """Values fixed per row, as scalar columns ``rl_*`` and ``q_*``.

    Start, end, the last three segments, dest distance and planar direction come from
    element access; the lat/lon medians from the sorted path arrays. None of it needs a
    lambda, so the projection is codegen'd. ``keep`` columns ride along in a struct key,
    so targets and split never need a join back to the trajectory table.
    """
    n = F.size("path_lat")

    def p(k):  # point k from the end (1 = last)
        return _pt("path_lat", n - k), _pt("path_lon", n - k)

    s_lat, s_lon = _pt("path_lat", F.lit(0)), _pt("path_lon", F.lit(0))
    (e_lat, e_lon), (l2a, l2o), (l3a, l3o), (l4a, l4o) = p(1), p(2), p(3), p(4)
    rl = {
        "n": n, "s_lat": s_lat, "s_lon": s_lon, "e_lat": e_lat, "e_lon": e_lon,
        "straight": geo.haversine(s_lat, s_lon, e_lat, e_lon),
        "brg_se": geo.bearing(s_lat, s_lon, e_lat, e_lon),
        "b1": geo.bearing(l2a, l2o, e_lat, e_lon),
        "b2": geo.bearing(l3a, l3o, l2a, l2o),
        "b3": geo.bearing(l4a, l4o, l3a, l3o),
        "seg1": geo.haversine(l2a, l2o, e_lat, e_lon),
        "seg2": geo.haversine(l3a, l3o, l2a, l2o),
        "remaining": geo.haversine(e_lat, e_lon, F.col("dest_lat"), F.col("dest_lon")),
        "planar_se": F.atan2(e_lon - s_lon, e_lat - s_lat),
    }
    kp = [F.struct(*[F.col(c) for c in keep]).alias("kp")] if keep else []
    med = [_quantile(F.sort_array(F.col(a)), F.size(a), 0.5).alias(_qname(nm, 0.5))
           for nm, a in (("lat", "path_lat"), ("lon", "path_lon"))]
    return traj.select("trajectory_id", "path_lat", "path_lon", *kp, *[v.alias(f"rl_{k}") for k, v in rl.items()],
                       *med)


def _qname(name: str, p: float) -> str:
    return f"q_{name}_{int(round(p * 100)):02d}"


def _q_cols() -> list[str]:
    return [_qname("lat", 0.5), _qname("lon", 0.5)]


def trajectory_aggregates(traj: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One row per trajectory with the raw aggregates and row values (before guards)."""
    if "dest_lat" not in traj.columns:
        traj = traj.withColumn("dest_lat", F.lit(None).cast("double")).withColumn(
            "dest_lon", F.lit(None).cast("double"))
    row_cols = [f"rl_{k}" for k in RL_FIELDS] + _q_cols()
    keys = ["kp"] if keep else []
    pts = with_segments(explode_points(_row_values(traj, keep or []), keep=[*keys, *row_cols]))
    n = F.col("rl_n")
    t = F.col("pos") - (n - 1) / 2.0          # centred index: sum t = sum t^3 = 0
    ylat = F.col("lat") - F.col("rl_s_lat")  # centred values keep the digits of the fit
    ylon = F.col("lon") - F.col("rl_s_lon")
    dd = F.abs(F.col("brg") - F.col("rl_planar_se"))
    # Row values are constant per trajectory: max() returns them with a fixed-width buffer
    # (a struct buffer would force a sort-based aggregate). Per-segment percentiles sort
    # the trajectory's own values, gathered with collect_list (bounded by the path length):
    # measured 2-2.5x faster than exact percentile() buffers, and than lambdas over arrays.
    a = pts.groupBy("trajectory_id", *keys).agg(
        *[F.max(c).alias(c) for c in row_cols],
        F.avg("lat").alias("mean_lat"), F.avg("lon").alias("mean_lon"),
        F.stddev_pop("lat").alias("std_lat"), F.stddev_pop("lon").alias("std_lon"),
        F.min("lat").alias("min_lat"), F.max("lat").alias("max_lat"),
        F.min("lon").alias("min_lon"), F.max("lon").alias("max_lon"),
        F.sum("seg").alias("sum_seg"), F.avg("seg").alias("avg_seg"), F.stddev_pop("seg").alias("std_seg"),
        F.max("seg").alias("max_seg"),
        F.skewness("seg").alias("seg_skew"), F.kurtosis("seg").alias("seg_kurt"),
        F.avg("acc").alias("avg_acc"), F.max("acc").alias("max_acc"),
        F.stddev_pop("brg").alias("brg_std"),
        F.skewness("bdeg").alias("brg_skew"), F.kurtosis("bdeg").alias("brg_kurt"),
        F.avg("chg").alias("avg_chg"), F.sum("chg").alias("sum_chg"),
        F.count_if(F.col("chg") * _RAD2DEG > F.lit(SIGNIFICANT_TURN_DEG)).alias("n_sig"),
        F.avg(F.col("chg") / (F.col("seg") + F.lit(CURVATURE_EPS))).alias("curv"),
        F.avg(geo.smallest_angle(dd, 2 * math.pi)).alias("dc"),
        F.sum(ylat).alias("sy_lat"), F.sum(t * ylat).alias("sty_lat"), F.sum(t * t * ylat).alias("stty_lat"),
        F.sum(ylon).alias("sy_lon"), F.sum(t * ylon).alias("sty_lon"), F.sum(t * t * ylon).alias("stty_lon"),
        F.sort_array(F.collect_list("seg")).alias("_seg"), F.sort_array(F.collect_list("bdeg")).alias("_bdeg"),
        F.sort_array(F.collect_list("acc")).alias("_acc"),
    )

    def qs(arr, pcts):
        return F.array(*[_quantile(F.col(arr), F.size(arr), pc) for pc in pcts])
    return a.select(
        "*", F.struct(*[F.col(f"rl_{k}").alias(k) for k in RL_FIELDS]).alias("rl"),
        F.col(_qname("lat", 0.5)).alias("median_lat"), F.col(_qname("lon", 0.5)).alias("median_lon"),
        qs("_seg", SEG_PCTS).alias("seg_pct"), qs("_bdeg", BRG_PCTS).alias("brg_pct"),
        qs("_acc", ACC_PCTS).alias("acc_pct")).drop("_seg", "_bdeg", "_acc")


def _fits(a: DataFrame) -> dict[str, Column]:
    """Least-squares line and parabola in the point index from centred sums (closed form)."""
    n = F.col("rl.n").cast("double")
    m = (n - 1) / 2.0
    s2 = n * (n * n - 1) / 12.0
    s4 = n * (n * n - 1) * (n * n * 3 - 7) / 240.0
    out = {}
    for ax, y0 in (("lat", F.col("rl.s_lat")), ("lon", F.col("rl.s_lon"))):
        sy, sty, stty = F.col(f"sy_{ax}"), F.col(f"sty_{ax}"), F.col(f"stty_{ax}")
        slope = sty / s2
        out[f"{ax}_slope"] = slope
        out[f"{ax}_intercept"] = sy / n + y0 - slope * m
        qa = (n * stty - s2 * sy) / (n * s4 - s2 * s2)
        qc = (sy - s2 * qa) / n
        out[f"{ax}_poly_a"] = qa
        out[f"{ax}_poly_b"] = slope - 2 * qa * m
        out[f"{ax}_poly_c"] = qa * m * m - slope * m + qc + y0
    return out


def _feature_columns(a: DataFrame) -> dict[str, Column]:
    rl = lambda k: F.col(f"rl.{k}")
    n = rl("n")
    total = F.col("sum_seg")
    lat_range = F.col("max_lat") - F.col("min_lat")
    lon_range = F.col("max_lon") - F.col("min_lon")
    seg_p = {p: F.col("seg_pct")[i] for i, p in enumerate(SEG_PCTS)}
    brg_p = {p: F.col("brg_pct")[i] for i, p in enumerate(BRG_PCTS)}
    acc_p = {p: F.col("acc_pct")[i] for i, p in enumerate(ACC_PCTS)}
    fit = _fits(a)
    c2e = geo.haversine("mean_lat", "mean_lon", rl("e_lat"), rl("e_lon"))
    last_chg = F.abs(rl("b1") - rl("b2"))
    prev_chg = F.abs(rl("b2") - rl("b3"))
    se_deg = geo.mod360(rl("planar_se") * _RAD2DEG)

    g = {}
    ge2 = n >= 2
    ge3 = n >= 3
    ge4 = n >= 4

    def put(cond, **cols):
        for k, v in cols.items():
            g[k] = F.when(cond, v) if cond is not None else v

    put(ge2, start_lat=rl("s_lat"), start_lon=rl("s_lon"), end_lat=rl("e_lat"), end_lon=rl("e_lon"),
        mean_lat=F.col("mean_lat"), mean_lon=F.col("mean_lon"), std_lat=F.col("std_lat"),
        std_lon=F.col("std_lon"), median_lat=F.col("median_lat"), median_lon=F.col("median_lon"),
        total_distance=total, mean_distance=F.col("avg_seg"), std_distance=F.col("std_seg"),
        straight_distance=rl("straight"),
        straightness=F.when(total > 0, rl("straight") / total).otherwise(F.lit(1.0)),
        lat_range=lat_range, lon_range=lon_range, area_bbox=lat_range * lon_range,
        aspect_ratio=F.when(lon_range != 0, lat_range / lon_range).otherwise(F.lit(0.0)),
        centroid_lat=F.col("mean_lat"), centroid_lon=F.col("mean_lon"))
    put(n >= 1, num_points=n.cast("double"),
        density=F.when(total > 0, n / total).otherwise(F.lit(0.0)))
    put(ge2, avg_speed_ms=F.col("avg_seg"), max_speed_ms=F.col("max_seg"),
        avg_acc_ms2=F.coalesce(F.col("avg_acc"), F.lit(0.0)), max_acc_ms2=F.coalesce(F.col("max_acc"), F.lit(0.0)),
        bearing=geo.bearing_deg(rl("brg_se")), bearing_sin=F.sin(rl("brg_se")), bearing_cos=F.cos(rl("brg_se")))
    put(ge3, direction_variance=F.col("brg_std"), avg_direction_change=F.col("avg_chg"), curvature=F.col("curv"))
    put(ge2, seg_p10=seg_p[0.10], seg_p25=seg_p[0.25], seg_p50=seg_p[0.50], seg_p75=seg_p[0.75],
        seg_p90=seg_p[0.90], seg_max=F.col("max_seg"), seg_mean=F.col("avg_seg"), seg_std=F.col("std_seg"))
    put(ge3, bearing_p10=brg_p[0.10], bearing_p50=brg_p[0.50], bearing_p90=brg_p[0.90])
    put(ge2, speed_p10=seg_p[0.10], speed_p50=seg_p[0.50], speed_p90=seg_p[0.90])
    put(ge3, acc_p10=acc_p[0.10], acc_p50=acc_p[0.50], acc_p90=acc_p[0.90],
        total_turning_angle=F.col("sum_chg") * _RAD2DEG, n_significant_turns=F.col("n_sig").cast("double"),
        last_bearing=geo.bearing_deg(rl("b1")))
    put(ge2, last_speed=rl("seg1"))
    put(ge3, last_direction_change=last_chg * _RAD2DEG)
    put(n >= 1, remaining_distance=F.coalesce(rl("remaining"), F.lit(0.0)))
    put(ge3, lat_slope=fit["lat_slope"], lat_intercept=fit["lat_intercept"], lon_slope=fit["lon_slope"],
        lon_intercept=fit["lon_intercept"],
        trend_magnitude=F.sqrt(fit["lat_slope"] ** 2 + fit["lon_slope"] ** 2),
        trend_bearing=geo.mod360(F.atan2(fit["lon_slope"], fit["lat_slope"]) * _RAD2DEG))
    put(n >= 5, lat_poly_a=fit["lat_poly_a"], lat_poly_b=fit["lat_poly_b"], lat_poly_c=fit["lat_poly_c"],
        lon_poly_a=fit["lon_poly_a"], lon_poly_b=fit["lon_poly_b"], lon_poly_c=fit["lon_poly_c"],
        poly_curvature=F.sqrt(fit["lat_poly_a"] ** 2 + fit["lon_poly_a"] ** 2))
    put(ge3, last_segment_speed=rl("seg1"), last_segment_bearing=geo.bearing_deg(rl("b1")),
        last_acceleration=rl("seg1") - rl("seg2"))
    put(ge4, prev_direction_change=prev_chg * _RAD2DEG, direction_change_trend=last_chg - prev_chg)
    put(ge2, centroid_to_end_distance=c2e,
        centroid_to_end_ratio=F.when(total > 0, c2e / total).otherwise(F.lit(0.0)))
    put(ge3, start_end_vs_last_angle=geo.smallest_angle(F.abs(se_deg - geo.bearing_deg(rl("b1")))),
        direction_consistency=F.col("dc") * _RAD2DEG)
    put(ge2, seg_p5=seg_p[0.05], seg_p15=seg_p[0.15], seg_p85=seg_p[0.85], seg_p95=seg_p[0.95])
    put(ge3, bearing_p5=brg_p[0.05], bearing_p15=brg_p[0.15], bearing_p85=brg_p[0.85], bearing_p95=brg_p[0.95])
    put(ge2, speed_p5=seg_p[0.05], speed_p15=seg_p[0.15], speed_p85=seg_p[0.85], speed_p95=seg_p[0.95])
    put(ge4, seg_skewness=F.col("seg_skew"), seg_kurtosis=F.col("seg_kurt"),
        speed_skewness=F.col("seg_skew"), speed_kurtosis=F.col("seg_kurt"),
        bearing_skewness=F.col("brg_skew"), bearing_kurtosis=F.col("brg_kurt"))
    assert set(g) == set(FEATURE_NAMES), set(FEATURE_NAMES) ^ set(g)
    return g


def extract_features(traj: DataFrame, names: list[str] | None = None,
                     keep: list[str] | None = None) -> DataFrame:
    """``trajectory_id`` + the 96 features (or ``names``) [+ ``keep`` columns], every input row kept.

    ``traj`` needs ``trajectory_id, path_lat, path_lon`` and optionally ``dest_lat, dest_lon``;
    ids must be unique (clean with C2 first).
    """
    keep = keep or []
    a = trajectory_aggregates(traj, keep)
    cols = _feature_columns(a)
    names = names or FEATURE_NAMES
    raw = a.select("trajectory_id", *[cols[k].alias(k) for k in names],
                   *[F.col(f"kp.{c}").alias(c) for c in keep])
    # Separate projection: the optimizer keeps it apart rather than inlining the feature
    # expressions twice, which keeps the generated code small.
    return raw.select("trajectory_id", *[geo.clean_number(k).alias(k) for k in names], *keep)


def features_with_targets(traj: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Features plus the targets (and ``extra`` columns) of the same row (no join, D2)."""
    return extract_features(traj, keep=["dest_lat", "dest_lon", *(extra or [])])


def path_distance(traj: DataFrame) -> DataFrame:
    """Flagship slice: total / straight distance, straightness and point count per path."""
    return extract_features(traj, ["total_distance", "straight_distance", "straightness", "num_points"])
