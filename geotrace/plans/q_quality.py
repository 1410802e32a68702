"""Registered queries: parsing, profiling, cleaning, local coordinates."""

from __future__ import annotations

from pyspark.sql import functions as F

from geotrace.functions import geo
from geotrace.operators import quality
from geotrace.plans import oracle
from geotrace.plans.registry import register
from geotrace.plans.rounding import rnd, round_sql
from geotrace.sources.fixtures import gps_raw, gps_raw_dirty, gps_trajectories
from geotrace.sources.io import parse_trajectories

# --- S3/S4: list text -> arrays, checked point by point against the integer recipe ---------

_PARSE_SQL = oracle.with_derived() + f"""
SELECT trajectory_id, pos, {round_sql('lat', 'coord')} AS lat, {round_sql('lon', 'coord')} AS lon FROM pts"""


@register("parse_paths", _PARSE_SQL)
def parse_paths(spark, sf_dir):
    t = parse_trajectories(gps_raw(spark, sf_dir))
    p = t.select("trajectory_id", F.posexplode(F.arrays_zip("path_lat", "path_lon")).alias("pos", "p"))
    return p.select("trajectory_id", F.col("pos").cast("long").alias("pos"),
                    rnd("p.path_lat", "coord").alias("lat"), rnd("p.path_lon", "coord").alias("lon"))


# --- V1/V2/V3 ------------------------------------------------------------------------------

_NULLS_SQL = oracle.with_derived() + """
SELECT split, count(*) AS rows,
  CAST(sum(CAST(trajectory_id IS NULL AS BIGINT) + CAST(path_lat IS NULL AS BIGINT) + CAST(path_lon IS NULL AS BIGINT)
      + CAST(dest_lat IS NULL AS BIGINT) + CAST(dest_lon IS NULL AS BIGINT) + CAST(ingest_seq IS NULL AS BIGINT))
    AS BIGINT) AS null_cells,
  count(*) FILTER (WHERE len(path_lat) = 0) AS empty_paths
FROM (SELECT trajectory_id, split, path_lat, path_lon, dest_lat, dest_lon, ingest_seq FROM trj_arr)
GROUP BY split"""


@register("null_profile", _NULLS_SQL)
def null_profile(spark, sf_dir):
    return quality.null_profile(gps_trajectories(spark, sf_dir))


_SUMMARY_SQL = oracle.with_derived() + """
SELECT split, count(*) AS rows, CAST(6 AS BIGINT) AS n_columns,
  bool_or(dest_lat IS NOT NULL AND dest_lon IS NOT NULL) AS has_target
FROM trj GROUP BY split"""


@register("data_summary", _SUMMARY_SQL)
def data_summary(spark, sf_dir):
    return quality.data_summary(gps_trajectories(spark, sf_dir))


# --- C1-C8 -------------------------------------------------------------------------------

def _clean_sql(split: str) -> str:
    cond = ("n_path >= 2 AND dest_lat IS NOT NULL AND dest_lon IS NOT NULL AND trajectory_id <> '128_20090222093321'"
            if split == "train" else "TRUE")
    return oracle.with_derived() + f"""
SELECT trajectory_id, n_path AS num_points, {round_sql('dest_lat', 'coord')} AS dest_lat,
  {round_sql('dest_lon', 'coord')} AS dest_lon, ingest_seq
FROM trj WHERE split = '{split}' AND {cond}"""


def _clean_query(split):
    def build(spark, sf_dir):
        c = quality.clean(gps_trajectories(spark, sf_dir)).where(F.col("split") == split)
        return c.select("trajectory_id", F.size("path_lat").cast("long").alias("num_points"),
                        rnd("dest_lat", "coord").alias("dest_lat"), rnd("dest_lon", "coord").alias("dest_lon"),
                        "ingest_seq")
    return build


register("clean_train", _clean_sql("train"))(_clean_query("train"))
register("clean_test", _clean_sql("test"))(_clean_query("test"))


# --- the same steps on dirty input: every rule removes or changes rows --------------------

_DIRTY_ROWS = """SELECT CASE WHEN s % 13 = 3 THEN '128_20090222093321' ELSE trajectory_id END AS trajectory_id, split,
    CASE WHEN s % 23 = 9 THEN 'bad' WHEN s % 29 = 11 THEN 'all' WHEN s % 31 = 2 THEN 'one' WHEN s % 37 = 4 THEN 'none' ELSE 'all' END AS kind,
    path_lat, path_lon, {dest_lat} AS dest_lat, {null_lat} AS null_lat, CASE WHEN s % 19 <> 7 THEN dest_lon END AS dest_lon,
    CASE WHEN s % 41 = 6 THEN 95.5 WHEN s % 43 = 8 THEN NULL ELSE 10 END AS start_lat, s + {more} AS ingest_seq
  FROM (SELECT *, ingest_seq AS s FROM trj_arr) {where}"""
_DIRTY = "dr_ AS (" + _DIRTY_ROWS.format(
    dest_lat="CASE WHEN split = 'train' AND s % 17 = 5 THEN NULL ELSE dest_lat END", null_lat="dest_lat IS NULL", more=0, where="") \
    + "\n  UNION ALL\n" + _DIRTY_ROWS.format(dest_lat="1.5", null_lat="FALSE", more=1_000_000, where="WHERE s % 11 = 0") + """),
dp_ AS (SELECT * EXCLUDE (path_lat, path_lon),
    CASE kind WHEN 'all' THEN path_lat WHEN 'one' THEN path_lat[1:1] ELSE [] END AS path_lat,
    CASE kind WHEN 'all' THEN path_lon WHEN 'one' THEN path_lon[1:1] ELSE [] END AS path_lon FROM dr_)"""


@register("parse_dirty", oracle.with_derived(_DIRTY) + f"""
SELECT ingest_seq, CAST(len(path_lat) AS BIGINT) AS n_lat, CAST(len(path_lon) AS BIGINT) AS n_lon,
  {round_sql('list_sum(path_lat)', 'm')} AS sum_lat FROM dp_""")
def parse_dirty(spark, sf_dir):
    t = parse_trajectories(gps_raw_dirty(spark, sf_dir))
    total = F.when(F.size("path_lat") > 0, F.aggregate("path_lat", F.lit(0.0), lambda a, x: a + x))
    return t.select("ingest_seq", F.size("path_lat").cast("long").alias("n_lat"), F.size("path_lon").cast("long").alias("n_lon"),
                    rnd(total, "m").alias("sum_lat"))


@register("null_profile_dirty", oracle.with_derived(_DIRTY) + """
SELECT split, count(*) AS rows, CAST(sum(CAST(null_lat AS INT) + CAST(dest_lon IS NULL AS INT)) AS BIGINT) AS null_cells,
  count(*) FILTER (WHERE len(path_lat) = 0) AS empty_paths FROM dp_ GROUP BY split""")
def null_profile_dirty(spark, sf_dir):
    return quality.null_profile(parse_trajectories(gps_raw_dirty(spark, sf_dir)))


def _dirty_sql(split: str) -> str:
    more = "AND len(path_lat) >= 2 AND dest_lat IS NOT NULL AND dest_lon IS NOT NULL" if split == "train" else ""
    return oracle.with_derived(_DIRTY) + f"""
SELECT trajectory_id, CAST(len(path_lat) AS BIGINT) AS num_points, {round_sql('dest_lat', 'coord')} AS dest_lat,
  {round_sql('dest_lon', 'coord')} AS dest_lon, ingest_seq
FROM (SELECT *, row_number() OVER (PARTITION BY split, trajectory_id ORDER BY ingest_seq) AS rn FROM dp_
      WHERE NOT (split = 'train' AND trajectory_id = '128_20090222093321'))
WHERE rn = 1 AND split = '{split}' AND coalesce(start_lat BETWEEN -90 AND 90, TRUE) {more}"""


def _dirty_query(split):
    def build(spark, sf_dir):
        c = quality.clean(parse_trajectories(gps_raw_dirty(spark, sf_dir))).where(F.col("split") == split)
        return c.select("trajectory_id", F.size("path_lat").cast("long").alias("num_points"),
                        rnd("dest_lat", "coord").alias("dest_lat"), rnd("dest_lon", "coord").alias("dest_lon"), "ingest_seq")
    return build


register("clean_train_dirty", _dirty_sql("train"))(_dirty_query("train"))
register("clean_test_dirty", _dirty_sql("test"))(_dirty_query("test"))


# --- G5/G6: destination in local metres from the path start, and back ----------------------

def _xy_sql() -> str:
    lat0, lon0 = "s_lat", "s_lon"
    dx = f"((radians(dest_lon) - radians({lon0})) * cos((radians(dest_lat) + radians({lat0})) / 2) * {oracle.R_M})"
    dy = f"((radians(dest_lat) - radians({lat0})) * {oracle.R_M})"
    phi = f"(radians({lat0}) + {dy} / {oracle.R_M})"
    lam = f"(radians({lon0}) + {dx} / ({oracle.R_M} * cos(({phi} + radians({lat0})) / 2)))"
    return oracle.with_derived() + f"""
, st0 AS (SELECT trajectory_id, arg_min(lat, pos) AS s_lat, arg_min(lon, pos) AS s_lon FROM pts GROUP BY trajectory_id)
SELECT t.trajectory_id, {round_sql(dx, 'm')} AS dx, {round_sql(dy, 'm')} AS dy,
  {round_sql(f'degrees({phi})', 'coord')} AS lat_back, {round_sql(f'degrees({lam})', 'coord')} AS lon_back
FROM trj t JOIN st0 USING (trajectory_id) WHERE t.split = 'train'"""


@register("local_xy_roundtrip", _xy_sql())
def local_xy_roundtrip(spark, sf_dir):
    t = gps_trajectories(spark, sf_dir).where((F.col("split") == "train") & (F.size("path_lat") > 0))
    lat0, lon0 = F.get(F.col("path_lat"), F.lit(0)), F.get(F.col("path_lon"), F.lit(0))
    dx, dy = geo.to_local_xy(lat0, lon0, F.col("dest_lat"), F.col("dest_lon"))
    t = t.select("trajectory_id", lat0.alias("lat0"), lon0.alias("lon0"), dx.alias("dx"), dy.alias("dy"))
    la, lo = geo.from_local_xy("lat0", "lon0", "dx", "dy")
    return t.select("trajectory_id", rnd("dx", "m").alias("dx"), rnd("dy", "m").alias("dy"),
                    rnd(la, "coord").alias("lat_back"), rnd(lo, "coord").alias("lon_back"))


# --- the shared segments table (points with their predecessor) ------------------------------

_SEG_SQL = oracle.with_derived("""
sl_ AS (SELECT trajectory_id, pos, lat, lon, lag(lat) OVER w AS plat, lag(lon) OVER w AS plon
        FROM pts WINDOW w AS (PARTITION BY trajectory_id ORDER BY pos))""") + f"""
SELECT trajectory_id, pos, {round_sql(oracle.hav('plat', 'plon', 'lat', 'lon'), 'm')} AS seg_m,
  {round_sql(oracle.brg('plat', 'plon', 'lat', 'lon'), 'unit')} AS bearing
FROM sl_ WHERE pos >= 1"""


@register("segments", _SEG_SQL)
def segments(spark, sf_dir):
    from geotrace.operators.points import segments_table
    s = segments_table(gps_trajectories(spark, sf_dir))
    return s.select("trajectory_id", F.col("pos").cast("long").alias("pos"), rnd("seg_m", "m").alias("seg_m"),
                    rnd("bearing", "unit").alias("bearing"))
