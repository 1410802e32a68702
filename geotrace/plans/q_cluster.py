"""Registered clustering queries (K1-K4, K6-K8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from geotrace.operators import clustering as K
from geotrace.operators.features import FEATURE_KIND
from geotrace.plans import oracle
from geotrace.plans.common import clean_split
from geotrace.plans.registry import register
from geotrace.plans.rounding import round_frame, round_sql
from geotrace.session import stored

# The library's restarts and k range; the labelled queries take k as a parameter, as cluster_best_k chooses it.
N_INIT = 10
MAX_K = 10
K_FIXED = 3


def _cf_sql(select_cols: str, extra_cte: str = "") -> str:
    ctes = [*oracle.feature_ctes(), oracle.CLEAN_TRAIN,
            oracle.feature_table_cte("cf_", "trajectory_id IN (SELECT trajectory_id FROM ctr)",
                                     K.CLUSTER_FEATURES, rounded=False)]
    if extra_cte:
        ctes.append(extra_cte)
    return oracle.with_derived(*ctes) + "\n" + select_cols


_CF_SELECT = "SELECT trajectory_id, " + ", ".join(
    f"{round_sql(k, FEATURE_KIND[k])} AS {k}" for k in K.CLUSTER_FEATURES) + " FROM cf_"


@register("cluster_features", _cf_sql(_CF_SELECT))
def cluster_features(spark, sf_dir):
    return round_frame(K.cluster_features(clean_split(spark, sf_dir, "train")), FEATURE_KIND)


_Z = ", ".join(
    f"round(({k} - avg({k}) OVER ()) / coalesce(nullif(stddev_pop({k}) OVER (), 0), 1), 6) AS {k}"
    for k in K.CLUSTER_FEATURES)


@register("cluster_scaled", _cf_sql(f"SELECT trajectory_id, {_Z} FROM cf_"))
def cluster_scaled(spark, sf_dir):
    cf = K.cluster_features(clean_split(spark, sf_dir, "train"))
    z = K.standardize(cf, K.CLUSTER_FEATURES)
    return z.select("trajectory_id", *[F.round(c, 6).alias(c) for c in K.CLUSTER_FEATURES])


def _labels(spark, sf_dir, k=K_FIXED):
    return K.fit_predict(clean_split(spark, sf_dir, "train"), k=k, n_init=N_INIT)


@register("cluster_kmeans")
def cluster_kmeans(spark, sf_dir):
    return _labels(spark, sf_dir)


@register("cluster_best_k")
def cluster_best_k(spark, sf_dir):
    cf = K.cluster_features(clean_split(spark, sf_dir, "train"))
    z = K.standardize(cf, K.CLUSTER_FEATURES, "_z")
    vec = K.assemble(z, [c + "_z" for c in K.CLUSTER_FEATURES]).select("trajectory_id", "features")
    vec = K.compact(vec)
    _, table = K.choose_k(vec, max_k=MAX_K, n_init=N_INIT)
    return table


@register("cluster_sizes")
def cluster_sizes(spark, sf_dir):
    return K.cluster_sizes(_labels(spark, sf_dir))


@register("cluster_largest")
def cluster_largest(spark, sf_dir):
    train = clean_split(spark, sf_dir, "train")
    kept = K.largest_cluster(train, _labels(spark, sf_dir))
    return kept.select("trajectory_id", F.size("path_lat").cast("long").alias("num_points"))


@register("cluster_map")
def cluster_map(spark, sf_dir):
    train = clean_split(spark, sf_dir, "train")
    return K.cluster_map_data(train, _labels(spark, sf_dir))


@register("cluster_dbscan")
def cluster_dbscan(spark, sf_dir):
    """K5 on the standardised cluster features (eps 0.5, min_samples 5); -1 = noise."""
    return K.fit_predict(clean_split(spark, sf_dir, "train"), method="dbscan")


# --- K5-K8 on DBSCAN labels, which are deterministic -----------------------------------------

_ZV = ", ".join(f"({k} - avg({k}) OVER ()) / coalesce(nullif(stddev_pop({k}) OVER (), 0), 1)" for k in K.CLUSTER_FEATURES)
WIDE_EPS = 1.5  # the derived keys use a wider radius, so that there are clusters to count
_DBSCAN = f"""
z_ AS MATERIALIZED (SELECT trajectory_id, ingest_seq AS o, [{_ZV}] AS v FROM cf_),
nb_ AS MATERIALIZED (SELECT a.o AS a, b.o AS b FROM z_ a, z_ b WHERE list_distance(a.v, b.v) <= @eps),
core_ AS MATERIALIZED (SELECT a FROM nb_ GROUP BY a HAVING count(*) >= 5),
ed_ AS MATERIALIZED (SELECT a, b FROM nb_ WHERE a <> b AND a IN (SELECT a FROM core_) AND b IN (SELECT a FROM core_)),
rc_ AS (SELECT a, a AS b FROM core_ UNION SELECT r.a, e.b FROM rc_ r JOIN ed_ e ON r.b = e.a),
cn_ AS MATERIALIZED (SELECT a, dense_rank() OVER (ORDER BY f) - 1 AS cluster FROM (SELECT a, min(b) AS f FROM rc_ GROUP BY a)),
bo_ AS (SELECT nb_.a, min(cluster) AS cluster FROM nb_ JOIN cn_ ON nb_.b = cn_.a WHERE nb_.a NOT IN (SELECT a FROM core_) GROUP BY nb_.a),
lb_ AS MATERIALIZED (SELECT z_.trajectory_id, CAST(coalesce(cn_.cluster, bo_.cluster, -1) AS INTEGER) AS cluster
        FROM z_ LEFT JOIN cn_ ON cn_.a = z_.o LEFT JOIN bo_ ON bo_.a = z_.o),
wn_ AS (SELECT cluster FROM lb_ GROUP BY cluster ORDER BY count(*) DESC, cluster LIMIT 1)"""


def _dbscan_sql(select: str, eps: float = WIDE_EPS) -> str:
    return _cf_sql(select, _DBSCAN.strip().replace("@eps", str(eps))).replace("WITH ", "WITH RECURSIVE ", 1)


def _dbscan(spark, sf_dir, eps: float = WIDE_EPS):
    train = stored(clean_split(spark, sf_dir, "train"))
    return train, stored(K.fit_predict(train, method="dbscan", eps=eps))


@register("dbscan_labels", _dbscan_sql("SELECT trajectory_id, cluster FROM lb_", 0.5))
def dbscan_labels(spark, sf_dir):
    return _dbscan(spark, sf_dir, 0.5)[1].select("trajectory_id", "cluster")


@register("dbscan_sizes", _dbscan_sql("SELECT cluster, count(*) AS count FROM lb_ GROUP BY cluster"))
def dbscan_sizes(spark, sf_dir):
    return K.cluster_sizes(_dbscan(spark, sf_dir)[1])


@register("dbscan_largest", _dbscan_sql("""SELECT trajectory_id, n_path AS num_points FROM ctr JOIN lb_ USING (trajectory_id)
WHERE cluster = (SELECT cluster FROM wn_)"""))
def dbscan_largest(spark, sf_dir):
    train, labels = _dbscan(spark, sf_dir)
    return K.largest_cluster(train, labels).select("trajectory_id", F.size("path_lat").cast("long").alias("num_points"))


@register("dbscan_map", _dbscan_sql(f"""SELECT trajectory_id, {round_sql('start_lon', 'coord')} AS start_lon,
  {round_sql('start_lat', 'coord')} AS start_lat, cluster FROM lb_ JOIN cf_ USING (trajectory_id)"""))
def dbscan_map(spark, sf_dir):
    m = K.cluster_map_data(*_dbscan(spark, sf_dir))
    return m.select("trajectory_id", F.round("start_lon", 9).alias("start_lon"), F.round("start_lat", 9).alias("start_lat"), "cluster")
