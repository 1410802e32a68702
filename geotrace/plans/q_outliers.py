"""Registered outlier queries (O1-O5, O8-O12) on the cleaned training trajectories."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from geotrace.operators import outliers as O
from geotrace.operators import quality
from geotrace.operators.features import FEATURE_NAMES
from geotrace.plans import oracle
from geotrace.plans.common import materialized_features
from geotrace.plans.registry import register
from geotrace.plans.rounding import rnd
from geotrace.session import stored
from geotrace.sources.fixtures import gps_trajectories

CFG = O.OutlierConfig()          # the pipeline's settings: box 18-54 / 73-135, 200 km, 500 km/h
CAP_PCT = 0.02                    # the capped key uses 2 % so that the cap actually fires on these data


def clean_train(spark, sf_dir):
    return quality.clean(gps_trajectories(spark, sf_dir)).where(F.col("split") == "train")


# --- SQL building blocks -------------------------------------------------------------------

_CTR = """
ctr AS (SELECT * FROM trj WHERE split = 'train' AND n_path >= 2 AND dest_lat IS NOT NULL AND dest_lon IS NOT NULL
        AND trajectory_id <> '128_20090222093321'),
pl_ AS (
  SELECT trajectory_id, pos, lat, lon, lag(lat) OVER w AS plat, lag(lon) OVER w AS plon
  FROM pts WHERE trajectory_id IN (SELECT trajectory_id FROM ctr)
  WINDOW w AS (PARTITION BY trajectory_id ORDER BY pos)),
pk_ AS (SELECT *, """ + oracle.hav("plat", "plon", "lat", "lon", oracle.R_KM) + """ AS km FROM pl_),
pm_ AS (
  SELECT trajectory_id, min(lat) AS mn_a, max(lat) AS mx_a, min(lon) AS mn_o, max(lon) AS mx_o,
    count(km) AS segs,
    count(*) FILTER (WHERE km > 200.0) + count(*) FILTER (WHERE km * 3600.0 > 500.0) AS hits
  FROM pk_ GROUP BY trajectory_id),
mk_ AS (
  SELECT c.trajectory_id, c.ingest_seq, c.n_path,
    (c.n_path = 0 OR coalesce(m.mn_a < 18.0 OR m.mx_a > 54.0 OR m.mn_o < 73.0 OR m.mx_o > 135.0, FALSE))
      AS is_geographic,
    CASE WHEN c.n_path >= 2 THEN m.hits / (c.n_path - 1) > 0.1 ELSE FALSE END AS is_trajectory,
    coalesce(c.dest_lat < 18.0 OR c.dest_lat > 54.0 OR c.dest_lon < 73.0 OR c.dest_lon > 135.0, FALSE) AS is_target
  FROM ctr c LEFT JOIN pm_ m USING (trajectory_id)),
cb_ AS (SELECT *, is_geographic OR is_trajectory OR is_target AS is_outlier FROM mk_)"""


def _sql(select: str, *more: str) -> str:
    return oracle.with_derived(_CTR, *more) + "\n" + select


def _masks(spark, sf_dir):
    return O.add_path_masks(clean_train(spark, sf_dir), CFG)


@register("outlier_geographic", _sql("SELECT trajectory_id, is_geographic FROM mk_"))
def outlier_geographic(spark, sf_dir):
    return _masks(spark, sf_dir).select("trajectory_id", "is_geographic")


@register("outlier_trajectory", _sql("SELECT trajectory_id, is_trajectory FROM mk_"))
def outlier_trajectory(spark, sf_dir):
    return _masks(spark, sf_dir).select("trajectory_id", "is_trajectory")


@register("outlier_target", _sql("SELECT trajectory_id, is_target FROM mk_"))
def outlier_target(spark, sf_dir):
    return _masks(spark, sf_dir).select("trajectory_id", "is_target")


_BOUNDS = """
bq_ AS (SELECT quantile_cont(lat, [0.01, 0.99]) AS a, quantile_cont(lon, [0.01, 0.99]) AS o FROM pk_),
bb_ AS (SELECT a[1] - 0.1 * (a[2] - a[1]) AS lat_lo, a[2] + 0.1 * (a[2] - a[1]) AS lat_hi,
               o[1] - 0.1 * (o[2] - o[1]) AS lon_lo, o[2] + 0.1 * (o[2] - o[1]) AS lon_hi FROM bq_)"""


@register("outlier_bounds", _sql("""SELECT c.trajectory_id,
  coalesce(c.n_path > 0 AND (m.mn_a < b.lat_lo OR m.mx_a > b.lat_hi OR m.mn_o < b.lon_lo OR m.mx_o > b.lon_hi), FALSE)
    AS is_bounds
FROM ctr c LEFT JOIN pm_ m USING (trajectory_id), bb_ b""", _BOUNDS))
def outlier_bounds(spark, sf_dir):
    return O.add_bounds_mask(clean_train(spark, sf_dir)).select("trajectory_id", "is_bounds")


def _iqr_sql() -> str:
    feats = ", ".join(f"{oracle.feature_expr(k)} AS {k}" for k in FEATURE_NAMES)
    q = ", ".join(f"quantile_cont({k}, [0.25, 0.75]) AS q_{k}" for k in FEATURE_NAMES)
    hits = " + ".join(
        f"CASE WHEN q.q_{k}[2] - q.q_{k}[1] <> 0 AND (f.{k} < q.q_{k}[1] - 3.0 * (q.q_{k}[2] - q.q_{k}[1]) "
        f"OR f.{k} > q.q_{k}[2] + 3.0 * (q.q_{k}[2] - q.q_{k}[1])) THEN 1 ELSE 0 END" for k in FEATURE_NAMES)
    thr = max(1, int(len(FEATURE_NAMES) * 0.2))
    return oracle.with_derived(*oracle.feature_ctes(), _CTR, f"""
ff_ AS (SELECT trajectory_id, {feats} FROM fx_ WHERE trajectory_id IN (SELECT trajectory_id FROM ctr)),
fq_ AS (SELECT {q} FROM ff_)""") + f"""
SELECT trajectory_id, CAST(iqr_hits AS BIGINT) AS iqr_hits, iqr_hits >= {thr} AS is_features_iqr
FROM (SELECT f.trajectory_id, {hits} AS iqr_hits FROM ff_ f, fq_ q)"""


@register("outlier_iqr", _iqr_sql())
def outlier_iqr(spark, sf_dir):
    f = materialized_features(spark, sf_dir, "train")
    m = O.add_iqr_mask(f, FEATURE_NAMES, CFG)
    return m.select("trajectory_id", F.col("iqr_hits").cast("long").alias("iqr_hits"), "is_features_iqr")


@register("outlier_combined", _sql("SELECT trajectory_id, is_outlier FROM cb_"))
def outlier_combined(spark, sf_dir):
    return O.combine(_masks(spark, sf_dir), "any").select("trajectory_id", "is_outlier")


@register("outlier_combined_all", _sql("SELECT trajectory_id, is_geographic AND is_trajectory AND is_target AS is_outlier FROM mk_"))
def outlier_combined_all(spark, sf_dir):
    return O.combine(_masks(spark, sf_dir), "all").select("trajectory_id", "is_outlier")


def _default_masks_sql() -> str:
    d = O.OutlierConfig.reference_defaults()
    ctr = _CTR
    for own, other in (("18.0", d.lat_range[0]), ("54.0", d.lat_range[1]), ("73.0", d.lon_range[0]), ("135.0", d.lon_range[1]),
                       ("km > 200.0", f"km > {d.max_jump_km}"), ("> 500.0)", f"> {d.max_speed_kmh})")):
        ctr = ctr.replace(own, str(other))
    return oracle.with_derived(ctr) + "\nSELECT trajectory_id, is_geographic, is_trajectory, is_target FROM mk_"


@register("outlier_masks_default", _default_masks_sql())
def outlier_masks_default(spark, sf_dir):
    """O1, O3, O4 with the detector's own defaults (world box, 500 km, 800 km/h)."""
    m = O.add_path_masks(clean_train(spark, sf_dir), O.OutlierConfig.reference_defaults())
    return m.select("trajectory_id", "is_geographic", "is_trajectory", "is_target")


_CAP = f"""
sh_ AS (SELECT count(*) AS total, count(*) FILTER (WHERE is_outlier) AS flagged FROM cb_),
rk_ AS (
  SELECT cb_.*, row_number() OVER (
      ORDER BY (CAST(is_geographic AS INT) + CAST(is_trajectory AS INT) + CAST(is_target AS INT)
                + 3 * CAST(is_geographic AS INT) + 2 * CAST(is_trajectory AS INT)) DESC, ingest_seq) AS rk
  FROM cb_)"""


@register("outlier_capped", _sql(f"""SELECT trajectory_id,
  CASE WHEN sh_.flagged > {CAP_PCT} * sh_.total THEN rk <= CAST(floor(sh_.total * {CAP_PCT}) AS BIGINT)
       ELSE is_outlier END AS is_outlier
FROM rk_, sh_""", _CAP))
def outlier_capped(spark, sf_dir):
    m = stored(O.combine(_masks(spark, sf_dir), "any").select("trajectory_id", "ingest_seq", *O.MASKS_OF_PATHS, "is_outlier"))
    return O.cap(m, CAP_PCT).select("trajectory_id", "is_outlier")


_GUARD = """
gs_ AS (SELECT avg(CAST(is_outlier AS DOUBLE)) AS share FROM cb_),
gd_ AS (SELECT cb_.*, CASE WHEN gs_.share > 0.03 THEN is_geographic OR is_target ELSE is_outlier END AS flag
        FROM cb_, gs_),
gk_ AS (SELECT count(*) FILTER (WHERE NOT flag) AS kept FROM gd_)"""


@register("outlier_guarded", _sql("""SELECT trajectory_id, n_path AS num_points
FROM gd_, gk_ WHERE NOT flag OR gk_.kept = 0""", _GUARD))
def outlier_guarded(spark, sf_dir):
    m = stored(O.combine(_masks(spark, sf_dir), "any"))  # read by two statistics and the filter
    m = O.remove(O.safety_rule(m, CFG.safety_share))
    return m.select("trajectory_id", F.size("path_lat").cast("long").alias("num_points"))


_REPORT = """
rp2_ AS (SELECT count(*) AS total, count(*) FILTER (WHERE is_outlier) AS combined,
               count(*) FILTER (WHERE is_geographic) AS geographic, count(*) FILTER (WHERE is_trajectory) AS trajectory,
               count(*) FILTER (WHERE is_target) AS target FROM cb_)"""


@register("outlier_report", _sql("""SELECT type, CAST(cnt AS BIGINT) AS count,
  round(CASE WHEN total > 0 THEN CAST(cnt AS DOUBLE) * 100.0 / total ELSE 0.0 END, 9) AS percentage
FROM (SELECT total, unnest(['total', 'combined', 'clean', 'geographic', 'trajectory', 'target']) AS type,
             unnest([total, combined, total - combined, geographic, trajectory, target]) AS cnt FROM rp2_)""",
                                  _REPORT))
def outlier_report(spark, sf_dir):
    m = O.combine(_masks(spark, sf_dir), "any")
    r = O.report(m)
    return r.select("type", "count", rnd("percentage", "unit").alias("percentage"))


@register("outlier_isolation")
def outlier_isolation(spark, sf_dir):
    """O6 on the features of the cleaned training split (rows only: the forest is random)."""
    from geotrace.operators.isolation import add_isolation_mask
    f = materialized_features(spark, sf_dir, "train")
    return add_isolation_mask(f, FEATURE_NAMES, CFG.contamination).select(
        "trajectory_id", "anomaly_score", "is_features_isolation")


# --- A1-A4: every point after augmentation; the draws are MD5 bits, so SQL can repeat them ---

AUGMENT_SEED = 42


def _draw(tag: str, i: str | None = None) -> str:
    key = f"'{AUGMENT_SEED}:{tag}:' || trajectory_id" + (f" || ':' || CAST({i} AS VARCHAR)" if i else "")
    return f"(CAST('0x' || substr(md5({key}), 1, 13) AS BIGINT) / pow(2, 52))"


def _augment_sql() -> str:
    r = oracle.R_M
    normal = lambda tag: f"sqrt(-2 * ln(1 - {_draw(tag + '1', 'pos')})) * cos({2 * math.pi!r} * {_draw(tag + '2', 'pos')})"

    def back(lat0, lon0, dx, dy):
        phi = f"(radians({lat0}) + {dy} / {r})"
        return f"degrees({phi})", f"degrees(radians({lon0}) + {dx} / ({r} * cos(({phi} + radians({lat0})) / 2)))"

    j_lat, j_lon = back("lat", "lon", f"(5.0 * {normal('jx')})", f"(5.0 * {normal('jy')})")
    r_lat, r_lon = back("c_lat", "c_lon", "(dx * cos(th) - dy * sin(th))", "(dx * sin(th) + dy * cos(th))")
    return _sql(f"""SELECT trajectory_id, method, CAST(row_number() OVER (PARTITION BY trajectory_id ORDER BY pos) - 1 AS BIGINT) AS pos,
  round(CASE method WHEN 'jitter' THEN {j_lat} WHEN 'rotate' THEN {r_lat} ELSE lat END, 7) AS lat,
  round(CASE method WHEN 'jitter' THEN {j_lon} WHEN 'rotate' THEN {r_lon} ELSE lon END, 7) AS lon
FROM ap_ WHERE method IS DISTINCT FROM 'drop' OR n_path <= 2 OR pos = 0 OR pos = n_path - 1 OR {_draw('drop', 'pos')} >= 0.1""", f"""
am_ AS (SELECT *, CASE WHEN n_path > 0 AND {_draw('apply')} < 0.5 THEN
    ['jitter', 'drop', 'rotate'][CAST(floor({_draw('method')} * 3) AS INT) + 1] END AS method,
    (-10.0 + 20.0 * {_draw('angle')}) * {math.pi / 180!r} AS th FROM ctr),
ac_ AS (SELECT *, avg(lat) OVER (PARTITION BY trajectory_id) AS c_lat, avg(lon) OVER (PARTITION BY trajectory_id) AS c_lon
        FROM am_ JOIN pts USING (trajectory_id)),
ap_ AS (SELECT *, (radians(lon) - radians(c_lon)) * cos((radians(lat) + radians(c_lat)) / 2) * {r} AS dx,
               (radians(lat) - radians(c_lat)) * {r} AS dy FROM ac_)""")


@register("augment", _augment_sql())
def augment_q(spark, sf_dir):
    """A1-A4 on the cleaned training split (p = 0.5, seed 42): every point with its path's method."""
    from geotrace.operators.augment import augment
    a = augment(clean_train(spark, sf_dir), p=0.5, seed=AUGMENT_SEED)
    p = a.select("trajectory_id", "method", F.posexplode(F.arrays_zip("path_lat", "path_lon")).alias("pos", "p"))
    return p.select("trajectory_id", "method", F.col("pos").cast("long").alias("pos"),
                    F.round("p.path_lat", 7).alias("lat"), F.round("p.path_lon", 7).alias("lon"))
