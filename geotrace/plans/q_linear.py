"""Registered closed-form checks of the model path (R0, R8, R16, E3, E4, E6) on a two-feature table from ``events``.

``linear_toy``: one row an event, features and noise by integer rule, two targets in degrees. Least squares,
ridge, their folds, ranking, refit and average all have closed forms, so each key has a SQL twin.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geotrace.operators import validation as V
from geotrace.operators.models import MultiTargetRegressor, NamedModel, builder, voting_builder
from geotrace.plans import oracle
from geotrace.plans.registry import register
from geotrace.session import stored

TARGETS = ("lat", "lon")
FOLDS, SEED, ALPHA = 5, 42, 2000.0

_X1, _X2 = "(event_id * 7919 % 1000) / 100.0", "(event_id * 104729 % 777) / 50.0"
_LAT = "39.9 + 0.01 * x1 - 0.02 * x2 + (event_id * 6101 % 101 - 50) / 1000.0"
_LON = "116.4 + 0.03 * x1 + 0.01 * x2 + (event_id * 5003 % 89 - 44) / 1000.0"


def linear_toy(spark, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.col("event_id").cast("string").alias("trajectory_id"), "event_id", F.expr(f"cast({_X1} as double)").alias("x1"),
        F.expr(f"cast({_X2} as double)").alias("x2"))
    e = e.withColumns({"lat": F.expr(f"cast({_LAT} as double)"), "lon": F.expr(f"cast({_LON} as double)")})
    d = V.group_folds(e, FOLDS, "trajectory_id", SEED)
    return VectorAssembler(inputCols=["x1", "x2"], outputCol="features").transform(stored(d))


def _models() -> list[NamedModel]:
    return [NamedModel("LinearRegression", builder("LinearRegression")), NamedModel("Ridge", builder("Ridge", None, {"alpha": ALPHA}))]


# --- SQL: normal equations of two features, by target and fold left out ----------------------

_TOY = f"""
toy_ AS (SELECT *, CAST({_LAT} AS DOUBLE) AS lat, CAST({_LON} AS DOUBLE) AS lon,
    CAST((CAST('0x' || substr(md5('{SEED}:' || CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT)) % {FOLDS} AS INTEGER) AS fold
  FROM (SELECT event_id, CAST({_X1} AS DOUBLE) AS x1, CAST({_X2} AS DOUBLE) AS x2 FROM events)),
long_ AS (SELECT event_id, fold, x1, x2, 'lat' AS target, lat AS y FROM toy_ UNION ALL SELECT event_id, fold, x1, x2, 'lon', lon FROM toy_),
out_ AS (SELECT unnest(range(0, {FOLDS + 1})) AS left_out),
al_ AS (SELECT 'LinearRegression' AS model_name, 0.0 AS alpha UNION ALL SELECT 'Ridge', {ALPHA}),
me_ AS (SELECT left_out, target, avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my, covar_pop(x1, x1) * count(*) AS s11,
    covar_pop(x2, x2) * count(*) AS s22, covar_pop(x1, x2) * count(*) AS s12, covar_pop(x1, y) * count(*) AS s1y, covar_pop(x2, y) * count(*) AS s2y
  FROM out_ JOIN long_ ON fold <> left_out GROUP BY left_out, target),
co_ AS (SELECT *, my - b1 * m1 - b2 * m2 AS b0 FROM (
  SELECT *, (s1y * (s22 + alpha) - s2y * s12) / ((s11 + alpha) * (s22 + alpha) - s12 * s12) AS b1,
            (s2y * (s11 + alpha) - s1y * s12) / ((s11 + alpha) * (s22 + alpha) - s12 * s12) AS b2 FROM me_, al_)),
ev2_ AS (SELECT t.event_id, t.fold, a.model_name, t.lat, t.lon, a.b0 + a.b1 * x1 + a.b2 * x2 AS lat_p, o.b0 + o.b1 * x1 + o.b2 * x2 AS lon_p
  FROM toy_ t JOIN co_ a ON a.left_out = t.fold AND a.target = 'lat'
  JOIN co_ o ON o.left_out = t.fold AND o.target = 'lon' AND o.model_name = a.model_name),
fe_ AS (SELECT model_name, fold, avg({oracle.hav('lat', 'lon', 'lat_p', 'lon_p', oracle.R_KM)}) AS error_km FROM ev2_ GROUP BY model_name, fold),
all_ AS (SELECT t.event_id, a.model_name, a.b0 + a.b1 * x1 + a.b2 * x2 AS lat_p, o.b0 + o.b1 * x1 + o.b2 * x2 AS lon_p
  FROM toy_ t JOIN co_ a ON a.left_out = {FOLDS} AND a.target = 'lat'
  JOIN co_ o ON o.left_out = {FOLDS} AND o.target = 'lon' AND o.model_name = a.model_name)"""


def _sql(select: str) -> str:
    return "WITH " + _TOY.strip() + "\n" + select


@register("toy_coefficients", _sql(f"""SELECT model_name, target, round(b0, 6) AS b0, round(b1, 6) AS b1, round(b2, 6) AS b2
FROM co_ WHERE left_out = {FOLDS}"""))
def toy_coefficients(spark, sf_dir):
    """R8 and OLS through the two-target wrapper (R0): intercept and coefficients on all rows."""
    d, rows = linear_toy(spark, sf_dir), []
    for m in _models():
        for target, fitted in zip(TARGETS, MultiTargetRegressor(m.build, TARGETS).fit(d).models, strict=True):
            rows.append((m.name, target, round(fitted.intercept, 6), *[round(float(c), 6) for c in fitted.coefficients]))
    return spark.createDataFrame(rows, "model_name string, target string, b0 double, b1 double, b2 double")


def _ranked(spark, sf_dir):
    d = linear_toy(spark, sf_dir)
    return (d, *V.validate_models(d, _models(), targets=TARGETS, k=FOLDS, y_unit="degrees"))


@register("toy_cv_folds", _sql("SELECT model_name, fold, round(error_km, 6) AS error_km FROM fe_"))
def toy_cv_folds(spark, sf_dir):
    """Mean haversine km of every held-out fold."""
    _, _, results = _ranked(spark, sf_dir)
    rows = results[0].folds.unionByName(results[1].folds)
    return rows.select("model_name", "fold", F.round("error_km", 6).alias("error_km"))


@register("toy_cv_ranking", _sql("""SELECT model_name, round(avg(error_km), 6) AS mean_error, round(stddev_pop(error_km), 6) AS std_error,
  count(*) AS folds FROM fe_ GROUP BY model_name"""))
def toy_cv_ranking(spark, sf_dir):
    """E4."""
    _, ranking, _ = _ranked(spark, sf_dir)
    return ranking.select("model_name", F.round("mean_error", 6).alias("mean_error"), F.round("std_error", 6).alias("std_error"), "folds")


@register("toy_refit", _sql("""SELECT CAST(event_id AS VARCHAR) AS trajectory_id, model_name, round(lat_p, 6) AS lat, round(lon_p, 6) AS lon
FROM all_ WHERE model_name = (SELECT model_name FROM fe_ GROUP BY model_name ORDER BY avg(error_km), model_name LIMIT 1)"""))
def toy_refit(spark, sf_dir):
    """The winner refitted on all rows, its predictions."""
    d, ranking, _ = _ranked(spark, sf_dir)
    name, model = V.refit_best(d, _models(), ranking, TARGETS)
    return model.transform(d).select("trajectory_id", F.lit(name).alias("model_name"), F.round("pred_lat", 6).alias("lat"), F.round("pred_lon", 6).alias("lon"))


@register("toy_voting", _sql("""SELECT CAST(event_id AS VARCHAR) AS trajectory_id, round(avg(lat_p), 6) AS lat, round(avg(lon_p), 6) AS lon
FROM all_ GROUP BY event_id"""))
def toy_voting(spark, sf_dir):
    """Mean of the two members' predictions."""
    d = linear_toy(spark, sf_dir)
    model = MultiTargetRegressor(voting_builder([m.build for m in _models()]), TARGETS).fit(d)
    return model.transform(d).select("trajectory_id", F.round("pred_lat", 6).alias("lat"), F.round("pred_lon", 6).alias("lon"))


# --- first rounds of tree models, on the same table with coarse features ----------------------

_ALPHA, _LAMBDA, _GAMMA, _WEIGHT, _RATE = 0.5, 1.5, 0.1, 3, 0.05


def _stump_sql() -> str:
    def part(side: str, l1: float, l2: float) -> str:
        return f"power(greatest(abs(g_{side}) - {l1}, 0), 2) / (n_{side} + {l2})"

    def gain(l1: float, l2: float) -> str:
        return f"{part('l', l1, l2)} + {part('r', l1, l2)} - {part('a', l1, l2)}"

    def leaf(side: str, l1: float, l2: float, rate: float) -> str:
        return f"round(-sign(g_{side}) * greatest(abs(g_{side}) - {l1}, 0) / (n_{side} + {l2}) * {rate}, 6)"
    return f"""WITH toy_ AS (SELECT event_id, floor(x1 * 10) / 10 AS x1, floor(x2 * 2) / 2 AS x2, CAST({_LAT} AS DOUBLE) AS lat, CAST({_LON} AS DOUBLE) AS lon
  FROM (SELECT event_id, CAST({_X1} AS DOUBLE) AS x1, CAST({_X2} AS DOUBLE) AS x2 FROM events)),
long_ AS (SELECT 'lat' AS target, lat AS y, x1, x2 FROM toy_ UNION ALL SELECT 'lon', lon, x1, x2 FROM toy_),
centred_ AS (SELECT target, avg(y) OVER (PARTITION BY target) - y AS g, x1, x2 FROM long_),
by_ AS (SELECT target, feature, x, sum(g) AS g, count(*) AS n FROM (
  SELECT target, 0 AS feature, x1 AS x, g FROM centred_ UNION ALL SELECT target, 1, x2, g FROM centred_) GROUP BY ALL),
run_ AS (SELECT target, feature, x, sum(g) OVER up AS g_l, sum(n) OVER up AS n_l, sum(g) OVER alls AS g_a, sum(n) OVER alls AS n_a
  FROM by_ WINDOW up AS (PARTITION BY target, feature ORDER BY x), alls AS (PARTITION BY target, feature)),
cut_ AS (SELECT *, g_a - g_l AS g_r, n_a - n_l AS n_r FROM run_ WHERE n_a > n_l),
one_ AS (SELECT *, row_number() OVER (PARTITION BY target ORDER BY {gain(_ALPHA, _LAMBDA)} DESC, feature, x) AS place
  FROM cut_ WHERE n_l >= {_WEIGHT} AND n_r >= {_WEIGHT} AND {gain(_ALPHA, _LAMBDA)} > {2 * _GAMMA}),
sums_ AS (SELECT feature, x, sum({gain(0, 0)}) AS gain FROM cut_ GROUP BY feature, x),
both_ AS (SELECT feature, x, row_number() OVER (ORDER BY gain DESC, feature, x) AS place FROM sums_)
SELECT 'XGBoost' AS model_name, target, feature, round(x, 6) AS cut, {leaf('l', _ALPHA, _LAMBDA, _RATE)} AS left_value, {leaf('r', _ALPHA, _LAMBDA, _RATE)} AS right_value
FROM one_ WHERE place = 1
UNION ALL SELECT 'RandomForest', c.target, c.feature, round(c.x, 6), {leaf('l', 0, 0, 1.0)}, {leaf('r', 0, 0, 1.0)}
FROM cut_ c JOIN both_ b ON c.feature = b.feature AND c.x = b.x WHERE b.place = 1"""


@register("toy_first_splits", _stump_sql())
def toy_first_splits(spark, sf_dir):
    """R2: the first split of each target by the regularised second-order gain; R1: that of both targets together."""
    from geotrace.operators import ensembles
    from geotrace.operators.trees import Grower
    d = linear_toy(spark, sf_dir).select("trajectory_id", F.floor(F.col("x1") * 10).alias("a"), F.floor(F.col("x2") * 2).alias("b"), *TARGETS)
    d = d.select("trajectory_id", (F.col("a") / 10).alias("x1"), (F.col("b") / 2).alias("x2"), *TARGETS)
    design = ensembles.design(VectorAssembler(inputCols=["x1", "x2"], outputCol="features").transform(d), "features", TARGETS)
    growers = {"XGBoost": Grower("boost", 1, 1, _RATE, l1=_ALPHA, l2=_LAMBDA, min_gain=2 * _GAMMA, min_weight=_WEIGHT),
               "RandomForest": Grower("bag", 1, 1, joint=True)}
    pieces = ensembles.fit_many(design, [ensembles.Job(g) for g in growers.values()]).pieces
    rows = []
    for i, name in enumerate(growers):
        for piece in pieces[i]:
            tree = piece.ensemble.trees[0]
            feature = int(tree.feature[0])
            for at, t in enumerate(piece.targets):
                rows.append((name, TARGETS[t], feature, round(float(design.edges[feature][tree.cut[0]]), 6),
                             round(float(tree.value[1, at]), 6), round(float(tree.value[2, at]), 6)))
    return spark.createDataFrame(rows, "model_name string, target string, feature int, cut double, left_value double, right_value double")


# --- Lloyd iterations from given centres -------------------------------------------------------

_STARTS = {3: [(2.0, 1.0), (5.0, 14.0), (8.0, 7.0)], 2: [(9.0, 15.0), (1.0, 0.0)]}
_ROUNDS = 4


def _lloyd_sql() -> str:
    ctes = [f"toy_ AS (SELECT event_id, CAST({_X1} AS DOUBLE) AS x1, CAST({_X2} AS DOUBLE) AS x2 FROM events)",
            "c0_ AS (SELECT * FROM (VALUES " + ", ".join(f"({k}, {j}, CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))"
                                                         for k, cs in _STARTS.items() for j, (a, b) in enumerate(cs)) + ") t(k, cluster, a, b))"]
    for i in range(_ROUNDS + 1):
        ctes.append(f"""n{i}_ AS (SELECT event_id, x1, x2, k, min_by(cluster, (d, cluster)) AS cluster, min(d) AS d FROM (
  SELECT event_id, x1, x2, k, cluster, (x1 - a) * (x1 - a) + (x2 - b) * (x2 - b) AS d FROM toy_, c{i}_) GROUP BY ALL)""")
        ctes.append(f"c{i + 1}_ AS (SELECT c.k, c.cluster, coalesce(avg(x1), any_value(a)) AS a, coalesce(avg(x2), any_value(b)) AS b "
                    f"FROM c{i}_ c LEFT JOIN n{i}_ n ON c.k = n.k AND c.cluster = n.cluster GROUP BY c.k, c.cluster)")
    return "WITH " + ",\n".join(ctes) + f"""
SELECT c.k, c.cluster, round(a, 6) AS x1, round(b, 6) AS x2, round(cost, 4) AS cost FROM c{_ROUNDS}_ c
JOIN (SELECT k, sum(d) AS cost FROM n{_ROUNDS}_ GROUP BY k) t ON c.k = t.k"""


@register("toy_lloyd", _lloyd_sql())
def toy_lloyd(spark, sf_dir):
    """K3: two K-means runs from given centres in the same jobs, after a fixed number of iterations."""
    import numpy as np

    from geotrace.operators import kmeans
    rows = stored(linear_toy(spark, sf_dir).select(F.xxhash64("trajectory_id").alias("id"), F.array("x1", "x2").alias("x")))
    runs = kmeans.lloyd(rows, [kmeans.Run(k, 0, np.array(c)) for k, c in _STARTS.items()], max_iter=_ROUNDS, tol=0.0)
    out = [(r.k, j, round(float(c[0]), 6), round(float(c[1]), 6), round(r.cost, 4)) for r in runs for j, c in enumerate(r.centres)]
    return spark.createDataFrame(out, "k int, cluster int, x1 double, x2 double, cost double")
