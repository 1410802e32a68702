"""Registered evaluation and output queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from geotrace.functions import geo
from geotrace.operators import knn, validation
from geotrace.operators.models import mean_baseline
from geotrace.operators.quality import validate_submission
from geotrace.operators.submission import build_submission, map_layers, prediction_comparison
from geotrace.plans import oracle
from geotrace.plans.common import clean_split, clean_splits
from geotrace.plans.registry import register
from geotrace.plans.rounding import rnd, round_sql
from geotrace.session import stored

# --- E7-E9: prediction = last path point, truth = destination, cleaned train -------------

_PRED = """
lp_ AS (SELECT trajectory_id, arg_max(lat, pos) AS lat_pred, arg_max(lon, pos) AS lon_pred FROM pts
        GROUP BY trajectory_id),
pr_ AS (SELECT c.trajectory_id, c.dest_lat AS lat_true, c.dest_lon AS lon_true, l.lat_pred, l.lon_pred
        FROM ctr c JOIN lp_ l USING (trajectory_id)),
pd_ AS (SELECT *, """ + oracle.hav("lat_true", "lon_true", "lat_pred", "lon_pred", oracle.R_KM) + """ AS d FROM pr_)"""


def _pred_sql(select: str) -> str:
    return oracle.with_derived(oracle.CLEAN_TRAIN, _PRED) + "\n" + select


def last_point_predictions(spark, sf_dir):
    t = clean_split(spark, sf_dir, "train")
    return stored(t.select("trajectory_id", F.col("dest_lat").alias("lat_true"), F.col("dest_lon").alias("lon_true"),
                           F.element_at("path_lat", -1).alias("lat_pred"), F.element_at("path_lon", -1).alias("lon_pred")))


_FULL_KINDS = {"mean_haversine_km": "km", "median_haversine_km": "km", "std_haversine_km": "km",
               "mse_latitude": "unit", "mse_longitude": "unit", "mae_latitude": "unit", "mae_longitude": "unit",
               "r2_latitude": "unit", "r2_longitude": "unit", "q25_km": "km", "q50_km": "km", "q75_km": "km",
               "q90_km": "km", "q95_km": "km"}
_FULL_SQL = {
    "mean_haversine_km": "avg(d)", "median_haversine_km": "quantile_cont(d, 0.5)", "std_haversine_km": "stddev_pop(d)",
    "mse_latitude": "avg(pow(lat_true - lat_pred, 2))", "mse_longitude": "avg(pow(lon_true - lon_pred, 2))",
    "mae_latitude": "avg(abs(lat_true - lat_pred))", "mae_longitude": "avg(abs(lon_true - lon_pred))",
    "r2_latitude": "1 - sum(pow(lat_true - lat_pred, 2)) / nullif(var_pop(lat_true) * count(*), 0)",
    "r2_longitude": "1 - sum(pow(lon_true - lon_pred, 2)) / nullif(var_pop(lon_true) * count(*), 0)",
    "q25_km": "quantile_cont(d, 0.25)", "q50_km": "quantile_cont(d, 0.5)", "q75_km": "quantile_cont(d, 0.75)",
    "q90_km": "quantile_cont(d, 0.9)", "q95_km": "quantile_cont(d, 0.95)",
}


@register("metrics_full", _pred_sql("SELECT " + ", ".join(
    f"{round_sql(v, _FULL_KINDS[k])} AS {k}" for k, v in _FULL_SQL.items()) + ", count(*) AS n_samples FROM pd_"))
def metrics_full(spark, sf_dir):
    m = validation.metrics_full(last_point_predictions(spark, sf_dir))
    return m.select(*[rnd(k, v).alias(k) for k, v in _FULL_KINDS.items()], "n_samples")


_SUM_SQL = {"mean_distance_km": "avg(d)", "median_distance_km": "quantile_cont(d, 0.5)",
            "std_distance_km": "stddev_pop(d)", "min_distance_km": "min(d)", "max_distance_km": "max(d)",
            "p95_distance_km": "quantile_cont(d, 0.95)", "p99_distance_km": "quantile_cont(d, 0.99)"}


@register("metrics_summary", _pred_sql("SELECT " + ", ".join(
    f"{round_sql(v, 'km')} AS {k}" for k, v in _SUM_SQL.items()) + " FROM pd_"))
def metrics_summary(spark, sf_dir):
    m = validation.metrics_summary(last_point_predictions(spark, sf_dir))
    return m.select(*[rnd(k, "km").alias(k) for k in _SUM_SQL])


# --- R21: mean-destination baseline for every cleaned test trajectory --------------------

_CLEAN_TEST = "cte_ AS (SELECT * FROM trj WHERE split = 'test')"
_BASELINE = oracle.with_derived(oracle.CLEAN_TRAIN, _CLEAN_TEST) + f"""
SELECT t.trajectory_id, {round_sql('m.a', 'coord')} AS latitude_pred, {round_sql('m.o', 'coord')} AS longitude_pred
FROM cte_ t, (SELECT avg(dest_lat) AS a, avg(dest_lon) AS o FROM ctr) m"""


def baseline(spark, sf_dir):
    return mean_baseline(*clean_splits(spark, sf_dir))


@register("baseline_submission", _BASELINE)
def baseline_submission(spark, sf_dir):
    b = baseline(spark, sf_dir)
    return b.select("trajectory_id", rnd("latitude_pred", "coord").alias("latitude_pred"),
                    rnd("longitude_pred", "coord").alias("longitude_pred"))


@register("submission_validate", oracle.with_derived(oracle.CLEAN_TRAIN, _CLEAN_TEST) + f"""
SELECT count(*) AS rows, count(*) FILTER (WHERE trajectory_id IS NULL) AS null_ids,
  CAST(0 AS BIGINT) AS null_lat, CAST(0 AS BIGINT) AS null_lon,
  {round_sql('min(m.a)', 'coord')} AS min_lat, {round_sql('max(m.a)', 'coord')} AS max_lat,
  {round_sql('min(m.o)', 'coord')} AS min_lon, {round_sql('max(m.o)', 'coord')} AS max_lon,
  count(*) - count(DISTINCT trajectory_id) AS duplicate_ids,
  bool_and(m.a BETWEEN -90 AND 90) AS lat_in_range, bool_and(m.o BETWEEN -180 AND 180) AS lon_in_range
FROM cte_ t, (SELECT avg(dest_lat) AS a, avg(dest_lon) AS o FROM ctr) m""")
def submission_validate(spark, sf_dir):
    v = validate_submission(baseline(spark, sf_dir))
    return v.select("rows", "null_ids", "null_lat", "null_lon",
                    *[rnd(c, "coord").alias(c) for c in ("min_lat", "max_lat", "min_lon", "max_lon")],
                    "duplicate_ids", "lat_in_range", "lon_in_range")


# --- X2: predictions in metres (mean train offset) -> degrees via each test path's start ---

_LOCAL_SQL = (f"((radians(dest_lon) - radians(s_lon)) * cos((radians(dest_lat) + radians(s_lat)) / 2) "
              f"* {oracle.R_M})", f"((radians(dest_lat) - radians(s_lat)) * {oracle.R_M})")


def _submission_build_sql() -> str:
    dx, dy = _LOCAL_SQL
    phi = f"(radians(st.s_lat) + m.dy / {oracle.R_M})"
    lam = f"(radians(st.s_lon) + m.dx / ({oracle.R_M} * cos(({phi} + radians(st.s_lat)) / 2)))"
    return oracle.with_derived(oracle.CLEAN_TRAIN, _CLEAN_TEST, """
s0_ AS (SELECT trajectory_id, arg_min(lat, pos) AS s_lat, arg_min(lon, pos) AS s_lon FROM pts GROUP BY trajectory_id)""",
                               f"""
off_ AS (SELECT avg({dx}) AS dx, avg({dy}) AS dy FROM ctr JOIN s0_ USING (trajectory_id))""") + f"""
SELECT t.trajectory_id,
  {round_sql(f'CASE WHEN st.s_lat IS NULL THEN m.dx ELSE degrees({phi}) END', 'coord')} AS latitude_pred,
  {round_sql(f'CASE WHEN st.s_lat IS NULL THEN m.dy ELSE degrees({lam}) END', 'coord')} AS longitude_pred
FROM cte_ t LEFT JOIN s0_ st USING (trajectory_id), off_ m"""


@register("submission_build", _submission_build_sql())
def submission_build(spark, sf_dir):
    train, test = clean_splits(spark, sf_dir)
    s = train.select(F.get(F.col("path_lat"), F.lit(0)).alias("s_lat"), F.get(F.col("path_lon"), F.lit(0)).alias("s_lon"),
                     "dest_lat", "dest_lon")
    dx, dy = geo.to_local_xy("s_lat", "s_lon", F.col("dest_lat"), F.col("dest_lon"))
    off = s.select(F.struct(F.avg(dx).alias("dx"), F.avg(dy).alias("dy"))).scalar()
    raw = test.select("trajectory_id", off["dx"].alias("a"), off["dy"].alias("b"))
    sub = build_submission(raw, test)
    return sub.select("trajectory_id", rnd("latitude_pred", "coord").alias("latitude_pred"),
                      rnd("longitude_pred", "coord").alias("longitude_pred"))


# --- R12: KNN on path end points -> mean destination of the 5 nearest train paths ---------

KNN_K = 5


def _knn_sql() -> str:
    return oracle.with_derived(oracle.CLEAN_TRAIN, _CLEAN_TEST, """
ep_ AS (SELECT trajectory_id, arg_max(lat, pos) AS e_lat, arg_max(lon, pos) AS e_lon FROM pts GROUP BY trajectory_id),
q_ AS (SELECT t.trajectory_id, e.e_lat, e.e_lon FROM cte_ t JOIN ep_ e USING (trajectory_id)),
r_ AS (SELECT c.trajectory_id, e.e_lat, e.e_lon, c.dest_lat, c.dest_lon FROM ctr c JOIN ep_ e USING (trajectory_id)),
nn_ AS (SELECT q_.trajectory_id AS qid, r_.trajectory_id AS rid, r_.dest_lat, r_.dest_lon,
          row_number() OVER (PARTITION BY q_.trajectory_id
            ORDER BY (q_.e_lat - r_.e_lat) * (q_.e_lat - r_.e_lat) + (q_.e_lon - r_.e_lon) * (q_.e_lon - r_.e_lon),
                     r_.trajectory_id) AS rk
        FROM q_, r_)""") + f"""
SELECT qid AS trajectory_id, {round_sql('avg(dest_lat)', 'coord')} AS latitude_pred,
  {round_sql('avg(dest_lon)', 'coord')} AS longitude_pred
FROM nn_ WHERE rk <= {KNN_K} GROUP BY qid"""


@register("knn_predict", _knn_sql())
def knn_predict(spark, sf_dir):
    def ends(df):
        return df.where(F.size("path_lat") > 0).select(
            "trajectory_id", F.array(F.element_at("path_lat", -1), F.element_at("path_lon", -1)).alias("vec"),
            "dest_lat", "dest_lon")
    train, test = clean_splits(spark, sf_dir)
    q, r = ends(test), ends(train)
    p = knn.knn_predict(q, r, KNN_K, "trajectory_id", "trajectory_id", "vec", ("dest_lat", "dest_lon"))
    return p.select("trajectory_id", rnd("dest_lat", "coord").alias("latitude_pred"),
                    rnd("dest_lon", "coord").alias("longitude_pred"))


# --- X6: GeoJSON layers (first 50 per layer) ----------------------------------------------

N_LAYER = 50


def _layers_sql() -> str:
    def path_layer(name, src):
        return f"""SELECT '{name}' AS layer, trajectory_id, n_path AS n_coords, s_lat AS start_lat, s_lon AS start_lon,
  e_lat AS end_lat, e_lon AS end_lon FROM (SELECT * FROM {src} JOIN se_ USING (trajectory_id) WHERE n_path > 1
  ORDER BY ingest_seq, trajectory_id LIMIT {N_LAYER})"""
    return oracle.with_derived(oracle.CLEAN_TRAIN, _CLEAN_TEST, """
se_ AS (SELECT trajectory_id, arg_min(lat, pos) AS s_lat, arg_min(lon, pos) AS s_lon, arg_max(lat, pos) AS e_lat,
               arg_max(lon, pos) AS e_lon FROM pts GROUP BY trajectory_id),
bl_ AS (SELECT t.trajectory_id, m.a, m.o FROM cte_ t, (SELECT avg(dest_lat) AS a, avg(dest_lon) AS o FROM ctr) m)""") + f"""
SELECT layer, trajectory_id, CAST(n_coords AS BIGINT) AS n_coords, {round_sql('start_lat', 'coord')} AS start_lat,
  {round_sql('start_lon', 'coord')} AS start_lon, {round_sql('end_lat', 'coord')} AS end_lat,
  {round_sql('end_lon', 'coord')} AS end_lon FROM (
{path_layer('train', 'ctr')}
UNION ALL
{path_layer('test', 'cte_')}
UNION ALL
SELECT 'prediction', trajectory_id, 1, a, o, a, o FROM (SELECT * FROM bl_ ORDER BY trajectory_id LIMIT {N_LAYER}))"""


@register("map_layers", _layers_sql())
def map_layers_q(spark, sf_dir):
    train, test = clean_splits(spark, sf_dir)
    m = map_layers(train, test, mean_baseline(train, test), N_LAYER, N_LAYER, N_LAYER)
    return m.select("layer", "trajectory_id", F.col("n_coords").cast("long").alias("n_coords"),
                    *[rnd(c, "coord").alias(c) for c in ("start_lat", "start_lon", "end_lat", "end_lon")])


# --- X7: last path point vs prediction for every test trajectory ---------------------------

def _comparison_sql() -> str:
    d = oracle.hav("e.e_lat", "e.e_lon", "m.a", "m.o", oracle.R_KM)
    return oracle.with_derived(oracle.CLEAN_TRAIN, _CLEAN_TEST, """
ep_ AS (SELECT trajectory_id, arg_max(lat, pos) AS e_lat, arg_max(lon, pos) AS e_lon FROM pts GROUP BY trajectory_id)""") + f"""
SELECT t.trajectory_id, t.split, {round_sql('e.e_lat', 'coord')} AS last_lat, {round_sql('e.e_lon', 'coord')} AS last_lon,
  {round_sql('m.a', 'coord')} AS latitude_pred, {round_sql('m.o', 'coord')} AS longitude_pred,
  {round_sql(d, 'km')} AS distance_km,
  {round_sql('(e.e_lat + m.a) / 2', 'coord')} AS mid_lat, {round_sql('(e.e_lon + m.o) / 2', 'coord')} AS mid_lon
FROM cte_ t JOIN ep_ e USING (trajectory_id), (SELECT avg(dest_lat) AS a, avg(dest_lon) AS o FROM ctr) m"""


@register("prediction_comparison", _comparison_sql())
def prediction_comparison_q(spark, sf_dir):
    train, test = clean_splits(spark, sf_dir)
    c = prediction_comparison(test, mean_baseline(train, test))
    kinds = {"last_lat": "coord", "last_lon": "coord", "latitude_pred": "coord", "longitude_pred": "coord",
             "distance_km": "km", "mid_lat": "coord", "mid_lon": "coord"}
    return c.select("trajectory_id", "split", *[rnd(k, v).alias(k) for k, v in kinds.items()])


# --- X5: prediction statistics of the baseline submission -----------------------------------

@register("prediction_stats", oracle.with_derived(oracle.CLEAN_TRAIN, _CLEAN_TEST) + f"""
SELECT count(*) AS count, {round_sql('min(m.a)', 'coord')} AS min_lat, {round_sql('max(m.a)', 'coord')} AS max_lat,
  {round_sql('min(m.o)', 'coord')} AS min_lon, {round_sql('max(m.o)', 'coord')} AS max_lon
FROM cte_ t, (SELECT avg(dest_lat) AS a, avg(dest_lon) AS o FROM ctr) m""")
def prediction_stats_q(spark, sf_dir):
    from geotrace.operators.submission import prediction_stats
    stats, _ = prediction_stats(baseline(spark, sf_dir))
    return stats.select("count", *[rnd(c, "coord").alias(c) for c in ("min_lat", "max_lat", "min_lon", "max_lon")])


@register("prediction_first", oracle.with_derived(oracle.CLEAN_TRAIN, _CLEAN_TEST) + f"""
SELECT trajectory_id, {round_sql('m.a', 'coord')} AS latitude_pred, {round_sql('m.o', 'coord')} AS longitude_pred
FROM cte_ t, (SELECT avg(dest_lat) AS a, avg(dest_lon) AS o FROM ctr) m ORDER BY trajectory_id LIMIT 5""")
def prediction_first(spark, sf_dir):
    """The report's table of the first five predictions (a top-k report)."""
    from geotrace.operators.submission import prediction_stats
    _, first = prediction_stats(baseline(spark, sf_dir))
    return first.select("trajectory_id", rnd("latitude_pred", "coord").alias("latitude_pred"), rnd("longitude_pred", "coord").alias("longitude_pred"))


# --- X6: GeoJSON text and centre of the map -------------------------------------------------

def _geojson_sql() -> str:
    def layer(name, src):
        return f"""SELECT '{name}' AS layer, trajectory_id, '{{"type":"Feature","geometry":{{"type":"LineString","coordinates":[' || xy ||
  ']}},"properties":{{"trajectory_id":"' || trajectory_id || '","layer":"{name}"}}}}' AS geojson
FROM (SELECT * FROM {src} JOIN xy_ USING (trajectory_id) WHERE n_path > 1 ORDER BY ingest_seq, trajectory_id LIMIT {N_LAYER})"""
    return oracle.with_derived(oracle.CLEAN_TRAIN, _CLEAN_TEST, """
xy_ AS (SELECT trajectory_id, string_agg('[' || CAST(lon AS VARCHAR) || ',' || CAST(lat AS VARCHAR) || ']', ',' ORDER BY pos) AS xy
        FROM pts GROUP BY trajectory_id)""") + "\n" + layer("train", "ctr") + "\nUNION ALL\n" + layer("test", "cte_")


@register("map_geojson", _geojson_sql())
def map_geojson(spark, sf_dir):
    train, test = clean_splits(spark, sf_dir)
    return map_layers(train, test, None, N_LAYER, N_LAYER).select("layer", "trajectory_id", "geojson")


@register("map_centre", oracle.with_derived(oracle.CLEAN_TRAIN) + f"""
SELECT {round_sql('coalesce(avg(lat), 39.9)', 'coord')} AS lat, {round_sql('coalesce(avg(lon), 116.4)', 'coord')} AS lon
FROM pts JOIN (SELECT trajectory_id FROM ctr ORDER BY ingest_seq, trajectory_id LIMIT 100) USING (trajectory_id)""")
def map_centre_q(spark, sf_dir):
    """The centre is defined over the first 100 training rows."""
    from geotrace.operators.submission import map_centre
    c = map_centre(clean_split(spark, sf_dir, "train"))
    one = spark.range(1).select(c.alias("c"))
    return one.select(rnd("c.lat", "coord").alias("lat"), rnd("c.lon", "coord").alias("lon"))


# --- E7, and X7 for one id and with ellipsoidal distances ------------------------------------

_EVAL = {"mean_haversine_km": ("avg(d)", "km"), "mse_latitude": ("avg(pow(lat_true - lat_pred, 2))", "unit"),
         "mse_longitude": ("avg(pow(lon_true - lon_pred, 2))", "unit"), "mae_latitude": ("avg(abs(lat_true - lat_pred))", "unit"),
         "mae_longitude": ("avg(abs(lon_true - lon_pred))", "unit")}


@register("evaluate", _pred_sql("SELECT " + ", ".join(f"{round_sql(e, u)} AS {k}" for k, (e, u) in _EVAL.items()) + " FROM pd_"))
def evaluate_q(spark, sf_dir):
    m = validation.evaluate(last_point_predictions(spark, sf_dir))
    return m.select(*[rnd(k, u).alias(k) for k, (_, u) in _EVAL.items()])


ONE_ID = "3_4"  # a trajectory of the test split at every scale


@register("comparison_one", "SELECT * FROM (" + _comparison_sql() + f") WHERE trajectory_id = '{ONE_ID}'")
def comparison_one(spark, sf_dir):
    from geotrace.operators.submission import trajectory_comparison
    train, test = clean_splits(spark, sf_dir)
    c = trajectory_comparison(test, mean_baseline(train, test), ONE_ID, geodesic=False)
    kinds = {"last_lat": "coord", "last_lon": "coord", "latitude_pred": "coord", "longitude_pred": "coord",
             "distance_km": "km", "mid_lat": "coord", "mid_lon": "coord"}
    return c.select("trajectory_id", "split", *[rnd(k, v).alias(k) for k, v in kinds.items()])


@register("comparison_geodesic")
def comparison_geodesic(spark, sf_dir):
    """Iterative ellipsoidal distances have no SQL twin; tests hold them to known pairs."""
    train, test = clean_splits(spark, sf_dir)
    c = prediction_comparison(test, mean_baseline(train, test), geodesic=True)
    return c.select("trajectory_id", rnd("distance_km", "km").alias("distance_km"))
