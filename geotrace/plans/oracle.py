"""DuckDB SQL twins of the registered queries (the correctness oracle).

The SQL deliberately takes a different physical route from the Spark code: it works
on the long points table with ``lag`` windows, ``arg_max`` and ``quantile_cont``,
where the Spark side explodes each trajectory row. Both start from ``events`` with the
integer recipe of FIXTURES.md §3.
"""

from __future__ import annotations

import math

from geotrace.operators.features import FEATURE_KIND, FEATURE_NAMES
from geotrace.plans.rounding import round_sql

R_M = 6371000.0
R_KM = 6371.0
PI = repr(math.pi)


def hav(a1, o1, a2, o2, r=R_M) -> str:
    a = (f"(pow(sin((radians({a2}) - radians({a1})) / 2), 2) + cos(radians({a1})) * cos(radians({a2})) * "
         f"pow(sin((radians({o2}) - radians({o1})) / 2), 2))")
    return f"({r} * 2 * atan2(sqrt({a}), sqrt(greatest(1 - {a}, 0))))"


def brg(a1, o1, a2, o2) -> str:
    dl = f"(radians({o2}) - radians({o1}))"
    return (f"atan2(sin({dl}) * cos(radians({a2})), cos(radians({a1})) * sin(radians({a2})) - "
            f"sin(radians({a1})) * cos(radians({a2})) * cos({dl}))")


def m360(x) -> str:
    return f"((({x}) % 360 + 360) % 360)"


def r2d(x) -> str:
    return f"(({x}) * 180.0 / {PI})"


# --- derived trajectory tables --------------------------------------------------------

DERIVED = f"""
ev_ AS (
  SELECT event_id, ts, user_id, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) // 6 AS bucket
  FROM events),
st_ AS (
  SELECT CAST(user_id AS VARCHAR) || '_' || CAST(bucket AS VARCHAR) AS trajectory_id, user_id, bucket, event_id, ts,
    CASE WHEN user_id % 41 = 7 THEN 60000000 ELSE 39900000 END + (user_id * 104729) % 200001 - 100000 AS lat0,
    116400000 + (user_id * 130363) % 200001 - 100000 AS lon0,
    (event_id * 7919 + 13) % 1201 - 400 + CASE WHEN event_id % 499 = 0 THEN 3000000 ELSE 0 END AS step_lat,
    (event_id * 6101 + 29) % 1201 - 400 AS step_lon
  FROM ev_),
rp_ AS (
  SELECT trajectory_id, user_id, bucket,
    row_number() OVER w AS pos1,
    count(*) OVER (PARTITION BY trajectory_id) AS n,
    CAST(lat0 + sum(step_lat) OVER w AS DOUBLE) / 1e6 AS lat,
    CAST(lon0 + sum(step_lon) OVER w AS DOUBLE) / 1e6 AS lon
  FROM st_
  WINDOW w AS (PARTITION BY trajectory_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
pts AS (
  SELECT trajectory_id, CAST(pos1 - 1 AS BIGINT) AS pos, lat, lon FROM rp_ WHERE pos1 <= n - 2),
trj AS (
  SELECT trajectory_id,
    CASE WHEN any_value(bucket) = 4 THEN 'test' ELSE 'train' END AS split,
    CAST(greatest(any_value(n) - 2, 0) AS BIGINT) AS n_path,
    CASE WHEN any_value(bucket) = 4 THEN NULL ELSE max(CASE WHEN pos1 = n THEN lat END) END AS dest_lat,
    CASE WHEN any_value(bucket) = 4 THEN NULL ELSE max(CASE WHEN pos1 = n THEN lon END) END AS dest_lon,
    any_value(user_id) * 5 + any_value(bucket) AS ingest_seq
  FROM rp_ GROUP BY trajectory_id),
trj_arr AS (
  SELECT t.*, coalesce(p.path_lat, []) AS path_lat, coalesce(p.path_lon, []) AS path_lon
  FROM trj t LEFT JOIN (
    SELECT trajectory_id, list(lat ORDER BY pos) AS path_lat, list(lon ORDER BY pos) AS path_lon
    FROM pts GROUP BY trajectory_id) p USING (trajectory_id))"""


def with_derived(*ctes: str) -> str:
    return "WITH " + ",\n".join([DERIVED.strip(), *[c.strip() for c in ctes]])


# --- features ------------------------------------------------------------------------

def _feature_ctes(source_pts: str = "pts", source_trj: str = "trj") -> list[str]:
    seg = f"""
sg1_ AS (
  SELECT trajectory_id, pos, lat, lon,
    lag(lat) OVER w AS plat, lag(lon) OVER w AS plon, lag(lat, 2) OVER w AS pplat, lag(lon, 2) OVER w AS pplon
  FROM {source_pts} WINDOW w AS (PARTITION BY trajectory_id ORDER BY pos)),
sg2_ AS (
  SELECT *, {hav('plat', 'plon', 'lat', 'lon')} AS seg, {brg('plat', 'plon', 'lat', 'lon')} AS brg,
    {hav('pplat', 'pplon', 'plat', 'plon')} AS pseg, {brg('pplat', 'pplon', 'plat', 'plon')} AS pbrg
  FROM sg1_),
sg_ AS (
  SELECT *, {m360(r2d('brg'))} AS bdeg, seg - pseg AS acc, abs(brg - pbrg) AS chg,
    lag(pbrg) OVER (PARTITION BY trajectory_id ORDER BY pos) AS ppbrg,
    first_value(lat) OVER wa AS s_lat, first_value(lon) OVER wa AS s_lon,
    last_value(lat) OVER wa AS e_lat, last_value(lon) OVER wa AS e_lon,
    count(*) OVER wa AS np
  FROM sg2_ WINDOW wa AS (PARTITION BY trajectory_id ORDER BY pos
                          ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
mo_ AS (
  SELECT *, avg(seg) OVER (PARTITION BY trajectory_id) AS mseg, avg(bdeg) OVER (PARTITION BY trajectory_id) AS mb,
    (CAST(pos AS DOUBLE) - (CAST(np AS DOUBLE) - 1) / 2) AS t, lat - s_lat AS ylat, lon - s_lon AS ylon,
    atan2(e_lon - s_lon, e_lat - s_lat) AS planar
  FROM sg_)"""
    agg = f"""
ag_ AS (
  SELECT trajectory_id, CAST(any_value(np) AS DOUBLE) AS n,
    arg_min(lat, pos) AS s_lat, arg_min(lon, pos) AS s_lon, arg_max(lat, pos) AS e_lat, arg_max(lon, pos) AS e_lon,
    avg(lat) AS mean_lat, avg(lon) AS mean_lon, stddev_pop(lat) AS std_lat, stddev_pop(lon) AS std_lon,
    quantile_cont(lat, 0.5) AS median_lat, quantile_cont(lon, 0.5) AS median_lon,
    max(lat) - min(lat) AS lat_range, max(lon) - min(lon) AS lon_range,
    sum(seg) AS tot, avg(seg) AS avg_seg, stddev_pop(seg) AS std_seg, max(seg) AS max_seg,
    quantile_cont(seg, [0.05, 0.10, 0.15, 0.25, 0.50, 0.75, 0.85, 0.90, 0.95]) AS sp,
    avg(acc) AS avg_acc, max(acc) AS max_acc, quantile_cont(acc, [0.10, 0.50, 0.90]) AS ap,
    stddev_pop(brg) AS brg_std, quantile_cont(bdeg, [0.05, 0.10, 0.15, 0.50, 0.85, 0.90, 0.95]) AS bp,
    avg(chg) AS avg_chg, sum(chg) AS sum_chg, count(*) FILTER (WHERE chg * 180.0 / {PI} > 30) AS n_sig,
    avg(chg / (seg + 1e-6)) AS curv,
    avg(least(abs(brg - planar), 2 * {PI} - abs(brg - planar))) AS dc,
    regr_slope(lat, pos) AS lat_slope, regr_intercept(lat, pos) AS lat_intercept,
    regr_slope(lon, pos) AS lon_slope, regr_intercept(lon, pos) AS lon_intercept,
    sum(ylat) AS sy_lat, sum(t * ylat) AS sty_lat, sum(t * t * ylat) AS stty_lat,
    sum(ylon) AS sy_lon, sum(t * ylon) AS sty_lon, sum(t * t * ylon) AS stty_lon,
    sqrt(count(seg)) * sum(pow(seg - mseg, 3)) / nullif(pow(sum(pow(seg - mseg, 2)), 1.5), 0) AS seg_skew,
    count(seg) * sum(pow(seg - mseg, 4)) / nullif(pow(sum(pow(seg - mseg, 2)), 2), 0) - 3 AS seg_kurt,
    sqrt(count(bdeg)) * sum(pow(bdeg - mb, 3)) / nullif(pow(sum(pow(bdeg - mb, 2)), 1.5), 0) AS brg_skew,
    count(bdeg) * sum(pow(bdeg - mb, 4)) / nullif(pow(sum(pow(bdeg - mb, 2)), 2), 0) - 3 AS brg_kurt,
    arg_max(seg, pos) AS seg1, arg_max(pseg, pos) AS seg2, arg_max(brg, pos) AS b1, arg_max(pbrg, pos) AS b2,
    arg_max(ppbrg, pos) AS b3, any_value(planar) AS planar
  FROM mo_ GROUP BY trajectory_id),
pf_ AS (
  SELECT *, (n - 1) / 2 AS m, n * (n * n - 1) / 12 AS s2, n * (n * n - 1) * (3 * n * n - 7) / 240 AS s4
  FROM ag_),
pq_ AS (
  SELECT *,
    (n * stty_lat - s2 * sy_lat) / (n * s4 - s2 * s2) AS qa_lat, sty_lat / s2 AS qb_lat,
    (n * stty_lon - s2 * sy_lon) / (n * s4 - s2 * s2) AS qa_lon, sty_lon / s2 AS qb_lon
  FROM pf_),
fx_ AS (
  SELECT t.trajectory_id, t.split, t.dest_lat, t.dest_lon, t.ingest_seq, t.n_path AS np_all, p.* EXCLUDE (trajectory_id),
    p.qa_lat AS lat_poly_a, p.qb_lat - 2 * p.qa_lat * p.m AS lat_poly_b,
    p.qa_lat * p.m * p.m - p.qb_lat * p.m + (p.sy_lat - p.s2 * p.qa_lat) / p.n + p.s_lat AS lat_poly_c,
    p.qa_lon AS lon_poly_a, p.qb_lon - 2 * p.qa_lon * p.m AS lon_poly_b,
    p.qa_lon * p.m * p.m - p.qb_lon * p.m + (p.sy_lon - p.s2 * p.qa_lon) / p.n + p.s_lon AS lon_poly_c,
    {hav('p.mean_lat', 'p.mean_lon', 'p.e_lat', 'p.e_lon')} AS c2e,
    {hav('p.s_lat', 'p.s_lon', 'p.e_lat', 'p.e_lon')} AS straight,
    {brg('p.s_lat', 'p.s_lon', 'p.e_lat', 'p.e_lon')} AS brg_se,
    {hav('p.e_lat', 'p.e_lon', 't.dest_lat', 't.dest_lon')} AS remaining
  FROM {source_trj} t LEFT JOIN pq_ p USING (trajectory_id))"""
    return [seg, agg]


def _feature_exprs() -> dict[str, tuple[int, str]]:
    """feature -> (minimum path length, SQL expression over fx_)."""
    sp = {p: f"sp[{i + 1}]" for i, p in enumerate([5, 10, 15, 25, 50, 75, 85, 90, 95])}
    bp = {p: f"bp[{i + 1}]" for i, p in enumerate([5, 10, 15, 50, 85, 90, 95])}
    ap = {p: f"ap[{i + 1}]" for i, p in enumerate([10, 50, 90])}
    e = {
        "start_lat": (2, "s_lat"), "start_lon": (2, "s_lon"), "end_lat": (2, "e_lat"), "end_lon": (2, "e_lon"),
        "mean_lat": (2, "mean_lat"), "mean_lon": (2, "mean_lon"), "std_lat": (2, "std_lat"),
        "std_lon": (2, "std_lon"), "median_lat": (2, "median_lat"), "median_lon": (2, "median_lon"),
        "total_distance": (2, "tot"), "mean_distance": (2, "avg_seg"), "std_distance": (2, "std_seg"),
        "straight_distance": (2, "straight"),
        "straightness": (2, "CASE WHEN tot > 0 THEN straight / tot ELSE 1.0 END"),
        "lat_range": (2, "lat_range"), "lon_range": (2, "lon_range"), "area_bbox": (2, "lat_range * lon_range"),
        "aspect_ratio": (2, "CASE WHEN lon_range <> 0 THEN lat_range / lon_range ELSE 0.0 END"),
        "centroid_lat": (2, "mean_lat"), "centroid_lon": (2, "mean_lon"),
        "num_points": (1, "np_all"), "density": (1, "CASE WHEN tot > 0 THEN np_all / tot ELSE 0.0 END"),
        "avg_speed_ms": (2, "avg_seg"), "max_speed_ms": (2, "max_seg"),
        "avg_acc_ms2": (2, "coalesce(avg_acc, 0.0)"), "max_acc_ms2": (2, "coalesce(max_acc, 0.0)"),
        "bearing": (2, m360(r2d("brg_se"))), "bearing_sin": (2, "sin(brg_se)"), "bearing_cos": (2, "cos(brg_se)"),
        "direction_variance": (3, "brg_std"), "avg_direction_change": (3, "avg_chg"), "curvature": (3, "curv"),
        "seg_p10": (2, sp[10]), "seg_p25": (2, sp[25]), "seg_p50": (2, sp[50]), "seg_p75": (2, sp[75]),
        "seg_p90": (2, sp[90]), "seg_max": (2, "max_seg"), "seg_mean": (2, "avg_seg"), "seg_std": (2, "std_seg"),
        "bearing_p10": (3, bp[10]), "bearing_p50": (3, bp[50]), "bearing_p90": (3, bp[90]),
        "speed_p10": (2, sp[10]), "speed_p50": (2, sp[50]), "speed_p90": (2, sp[90]),
        "acc_p10": (3, ap[10]), "acc_p50": (3, ap[50]), "acc_p90": (3, ap[90]),
        "total_turning_angle": (3, r2d("sum_chg")), "n_significant_turns": (3, "n_sig"),
        "last_bearing": (3, m360(r2d("b1"))), "last_speed": (2, "seg1"),
        "last_direction_change": (3, r2d("abs(b1 - b2)")),
        "remaining_distance": (1, "coalesce(remaining, 0.0)"),
        "lat_slope": (3, "lat_slope"), "lat_intercept": (3, "lat_intercept"), "lon_slope": (3, "lon_slope"),
        "lon_intercept": (3, "lon_intercept"),
        "trend_magnitude": (3, "sqrt(lat_slope * lat_slope + lon_slope * lon_slope)"),
        "trend_bearing": (3, m360(r2d("atan2(lon_slope, lat_slope)"))),
        "lat_poly_a": (5, "lat_poly_a"), "lat_poly_b": (5, "lat_poly_b"), "lat_poly_c": (5, "lat_poly_c"),
        "lon_poly_a": (5, "lon_poly_a"), "lon_poly_b": (5, "lon_poly_b"), "lon_poly_c": (5, "lon_poly_c"),
        "poly_curvature": (5, "sqrt(lat_poly_a * lat_poly_a + lon_poly_a * lon_poly_a)"),
        "last_segment_speed": (3, "seg1"), "last_segment_bearing": (3, m360(r2d("b1"))),
        "last_acceleration": (3, "seg1 - seg2"),
        "prev_direction_change": (4, r2d("abs(b2 - b3)")), "direction_change_trend": (4, "abs(b1 - b2) - abs(b2 - b3)"),
        "centroid_to_end_distance": (2, "c2e"),
        "centroid_to_end_ratio": (2, "CASE WHEN tot > 0 THEN c2e / tot ELSE 0.0 END"),
        "start_end_vs_last_angle": (3, f"least(abs({m360(r2d('planar'))} - {m360(r2d('b1'))}), "
                                       f"360 - abs({m360(r2d('planar'))} - {m360(r2d('b1'))}))"),
        "direction_consistency": (3, r2d("dc")),
        "seg_p5": (2, sp[5]), "seg_p15": (2, sp[15]), "seg_p85": (2, sp[85]), "seg_p95": (2, sp[95]),
        "bearing_p5": (3, bp[5]), "bearing_p15": (3, bp[15]), "bearing_p85": (3, bp[85]), "bearing_p95": (3, bp[95]),
        "speed_p5": (2, sp[5]), "speed_p15": (2, sp[15]), "speed_p85": (2, sp[85]), "speed_p95": (2, sp[95]),
        "seg_skewness": (4, "seg_skew"), "seg_kurtosis": (4, "seg_kurt"), "speed_skewness": (4, "seg_skew"),
        "speed_kurtosis": (4, "seg_kurt"), "bearing_skewness": (4, "brg_skew"), "bearing_kurtosis": (4, "brg_kurt"),
    }
    assert set(e) == set(FEATURE_NAMES)
    return e


def feature_expr(name: str) -> str:
    """Guarded, cleaned (NULL/NaN/inf -> 0) SQL expression of one feature over fx_."""
    guard, expr = _feature_exprs()[name]
    v = f"CAST(CASE WHEN coalesce(np_all, 0) >= {guard} THEN {expr} END AS DOUBLE)"
    return f"(CASE WHEN {v} IS NULL OR isnan({v}) OR isinf({v}) THEN 0.0 ELSE {v} END)"


def feature_ctes() -> list[str]:
    return _feature_ctes()


def features_sql(names: list[str], where: str = "TRUE", rounded: bool = True, extra: str = "") -> str:
    cols = []
    for k in names:
        e = feature_expr(k)
        cols.append(f"{round_sql(e, FEATURE_KIND[k]) if rounded else e} AS {k}")
    sel = ", ".join(["trajectory_id", *cols]) + (f", {extra}" if extra else "")
    return with_derived(*feature_ctes()) + f"\nSELECT {sel} FROM fx_ WHERE {where}"


# --- shared blocks for train-side queries ------------------------------------------------

CLEAN_TRAIN = """
ctr AS (SELECT * FROM trj WHERE split = 'train' AND n_path >= 2 AND dest_lat IS NOT NULL AND dest_lon IS NOT NULL
        AND trajectory_id <> '128_20090222093321')"""


def feature_table_cte(name: str, where: str, names: list[str], rounded: bool) -> str:
    """CTE ``name`` with trajectory_id, dest, ingest_seq and the (optionally rounded) features."""
    cols = []
    for k in names:
        e = feature_expr(k)
        cols.append(f"{round_sql(e, FEATURE_KIND[k]) if rounded else e} AS {k}")
    return (f"{name} AS (SELECT trajectory_id, dest_lat, dest_lon, ingest_seq, {', '.join(cols)} "
            f"FROM fx_ WHERE {where})")
