"""Folds, metrics, cross-validation, ranking, refit and search.

Folds come from a hash of the group key (no global window), so a group never
straddles folds and the assignment does not depend on partitioning. The hash is the
first 32 bits of ``md5(seed:key)``, which any SQL engine can reproduce.

Cross-validation of tree ensembles and linear models fits all models' folds together (see
``ensembles.py`` and ``gram.py``): the jobs don't count models or folds. Other models are fitted fold by
fold, in parallel threads. Every fold yields one row ``model_name, fold, error_km, seconds``; ranking is a
``groupBy`` over those rows.
"""

from __future__ import annotations

import json
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geotrace.functions import geo
from geotrace.functions.hashrand import uniform
from geotrace.operators import ensembles, gram
from geotrace.operators.models import MultiTargetRegressor, NamedModel, TreeBuilder, members_of
from geotrace.operators.quantiles import quantiles
from geotrace.operators.ranking import global_rank


# --- folds ------------------------------------------------------------------------------

def hash32(key: Column | str, seed: int) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    h = F.md5(F.concat(F.lit(f"{seed}:"), k.cast("string")))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("long")


def group_folds(df: DataFrame, k: int = 10, group: str = "trajectory_id", seed: int = 42,
                name: str = "fold") -> DataFrame:
    """E2 (and E1 when the group is the row id): ``fold = hash(group) mod k``."""
    return df.withColumn(name, F.pmod(hash32(group, seed), F.lit(k)).cast("int"))


def balanced_folds(df: DataFrame, k: int = 10, order: str = "ingest_seq", seed: int = 42,
                   name: str = "fold") -> DataFrame:
    """E1 with sizes differing by at most 1: rank rows in hashed order, ``fold = rank mod k``.

    The rank is exact and distributed (see ranking.global_rank).
    """
    keys = df.select(order, hash32(order, seed).alias("_h"))  # only the unique order numbers are ranked
    r = global_rank(keys, [F.col("_h"), F.col(order)], "_r")
    return df.join(r.select(order, F.pmod(F.col("_r"), F.lit(k)).cast("int").alias(name)), order)


def balanced_group_folds(df: DataFrame, k: int = 10, group: str = "trajectory_id", seed: int = 42,
                         name: str = "fold") -> DataFrame:
    """E2, size-balanced: groups ordered by size (desc, then hash) take folds round-robin.

    The group-size table has one row per group; its order is an exact distributed rank,
    and the fold of each group is joined back on the group key.
    """
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("_gs")).withColumn("_h", hash32(group, seed))
    ranked = global_rank(sizes, [F.col("_gs").desc(), F.col("_h"), F.col(group)], "_r")
    folds = ranked.select(group, F.pmod(F.col("_r"), F.lit(k)).cast("int").alias(name))
    return df.join(folds, group)


def fold_integrity(df: DataFrame, group: str = "trajectory_id", fold: str = "fold") -> DataFrame:
    """Per fold: rows, groups, and groups that also appear in another fold (must be 0)."""
    per_group = df.groupBy(group).agg(F.count_distinct(fold).alias("_nf"), F.min(fold).alias("_f"))
    straddle = per_group.where(F.col("_nf") > 1).count()
    return df.groupBy(fold).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(group).alias("groups")) \
        .withColumn("straddling_groups", F.lit(straddle).cast("long"))


# --- metrics -----------------------------------------------------------------------------

def with_distance(pred: DataFrame, lat_true="lat_true", lon_true="lon_true", lat_pred="lat_pred",
                  lon_pred="lon_pred", name: str = "dist_km") -> DataFrame:
    return pred.withColumn(name, geo.haversine_km(lat_true, lon_true, lat_pred, lon_pred))


def evaluate(pred: DataFrame) -> DataFrame:
    """Mean haversine km, MSE and MAE per axis (one row)."""
    d = with_distance(pred)
    return d.agg(
        F.avg("dist_km").alias("mean_haversine_km"),
        F.avg(F.pow(F.col("lat_true") - F.col("lat_pred"), 2)).alias("mse_latitude"),
        F.avg(F.pow(F.col("lon_true") - F.col("lon_pred"), 2)).alias("mse_longitude"),
        F.avg(F.abs(F.col("lat_true") - F.col("lat_pred"))).alias("mae_latitude"),
        F.avg(F.abs(F.col("lon_true") - F.col("lon_pred"))).alias("mae_longitude"))


QUANTILES = [0.25, 0.5, 0.75, 0.9, 0.95]


def metrics_full(pred: DataFrame) -> DataFrame:
    """Haversine mean/median/std, MSE/MAE/R^2 per axis, quantiles, n (one row)."""
    d = with_distance(pred)
    q = quantiles(d, ["dist_km"], QUANTILES)["dist_km"] or [None] * len(QUANTILES)

    def r2(t, p):
        sse = F.sum(F.pow(F.col(t) - F.col(p), 2))
        sst = F.var_pop(t) * F.count(F.lit(1))
        return F.lit(1.0) - sse / F.nullif(sst, F.lit(0.0))

    return d.agg(
        F.avg("dist_km").alias("mean_haversine_km"), F.lit(q[QUANTILES.index(0.5)]).cast("double").alias("median_haversine_km"),
        F.stddev_pop("dist_km").alias("std_haversine_km"),
        F.avg(F.pow(F.col("lat_true") - F.col("lat_pred"), 2)).alias("mse_latitude"),
        F.avg(F.pow(F.col("lon_true") - F.col("lon_pred"), 2)).alias("mse_longitude"),
        F.avg(F.abs(F.col("lat_true") - F.col("lat_pred"))).alias("mae_latitude"),
        F.avg(F.abs(F.col("lon_true") - F.col("lon_pred"))).alias("mae_longitude"),
        r2("lat_true", "lat_pred").alias("r2_latitude"), r2("lon_true", "lon_pred").alias("r2_longitude"),
        F.count(F.lit(1)).alias("n_samples"),
        *[F.lit(v).cast("double").alias(f"q{int(p * 100)}_km") for p, v in zip(QUANTILES, q, strict=True)])


def metrics_summary(pred: DataFrame) -> DataFrame:
    """Mean, median, std, min, max, p95, p99 of the haversine km (one row)."""
    d = with_distance(pred)
    q = quantiles(d, ["dist_km"], [0.5, 0.95, 0.99])["dist_km"] or [None] * 3
    median, p95, p99 = (F.lit(v).cast("double") for v in q)
    return d.agg(F.avg("dist_km").alias("mean_distance_km"), median.alias("median_distance_km"),
                 F.stddev_pop("dist_km").alias("std_distance_km"), F.min("dist_km").alias("min_distance_km"),
                 F.max("dist_km").alias("max_distance_km"), p95.alias("p95_distance_km"), p99.alias("p99_distance_km"))


# --- cross-validation --------------------------------------------------------------------

@dataclass
class CVResult:
    model_name: str
    folds: DataFrame          # model_name, fold, error_km, seconds
    mean_error: float
    std_error: float


def predictions_latlon(pred: DataFrame, targets: tuple[str, str], y_unit: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Truth and prediction in degrees; metre targets go back through G6 from each row's start."""
    t0, t1 = targets
    if y_unit == "meters":
        la_t, lo_t = geo.from_local_xy("start_lat", "start_lon", F.col(t0), F.col(t1))
        la_p, lo_p = geo.from_local_xy("start_lat", "start_lon", F.col(f"pred_{t0}"), F.col(f"pred_{t1}"))
    else:
        la_t, lo_t, la_p, lo_p = F.col(t0), F.col(t1), F.col(f"pred_{t0}"), F.col(f"pred_{t1}")
    return pred.select("trajectory_id", *keep, la_t.alias("lat_true"), lo_t.alias("lon_true"),
                       la_p.alias("lat_pred"), lo_p.alias("lon_pred"))


def fold_error(pred: DataFrame) -> float:
    return with_distance(pred).agg(F.avg("dist_km")).first()[0]


def together(models: list[NamedModel]) -> list[NamedModel]:
    """Those of ``models`` that :func:`validate_together` can fit in the same jobs."""
    return [m for m in models if members_of(m.build)]


def held_out_predictions(design: DataFrame, models: list[NamedModel], targets: tuple[str, str] = ("dx", "dy"), k: int = 10,
                         fold_col: str = "fold", keep: tuple[str, ...] = ()) -> DataFrame:
    """``model`` (index), ``fold``, ``row``, ``y``, ``p`` (arrays by target), ``seconds`` and kept columns: every row
    of folds 0 .. k - 1 predicted by each model fitted on the other folds, all in the same jobs."""
    raw = ensembles.raw_rows(design, "features", targets, fold_col, keep)
    uses = [(i, b, w) for i, m in enumerate(models) for b, w in members_of(m.build)]
    trees, lines = [u for u in uses if isinstance(u[1], TreeBuilder)], [u for u in uses if not isinstance(u[1], TreeBuilder)]
    n, found = len(targets), []
    if trees:
        jobs = [ensembles.Job(b.grower, f) for _, b, _ in trees for f in range(k)]
        out = ensembles.fit_many(ensembles.binned(raw), jobs).out
        at = F.floor(F.col("job") / k).cast("int")
        found.append((trees, out.select(at.alias("use"), "row", *[F.col(f"p{t}") for t in range(n)], "seconds")))
    if lines:
        t0 = time.time()
        whole, parts = gram.fold_grams(raw.rows, raw.features, n, k)
        systems = [[gram.solved(b.kind, whole.less(p), b.params) for p in parts] for _, b, _ in lines]
        each = (time.time() - t0) / max(raw.count * len(lines), 1)
        out = gram.held_out(raw.rows, systems, n)
        found.append((lines, out.select(F.col("model").alias("use"), "row", *[F.col("p")[t].alias(f"p{t}") for t in range(n)], F.lit(each).alias("seconds"))))
    every = None
    for used, out in found:
        model = F.element_at(F.array(*[F.lit(i) for i, _, _ in used]), F.col("use") + 1)
        weight = F.element_at(F.array(*[F.lit(float(w)) for _, _, w in used]), F.col("use") + 1)
        out = out.select(model.alias("model"), "row", *[(F.col(f"p{t}") * weight).alias(f"p{t}") for t in range(n)], "seconds")
        every = out if every is None else every.unionByName(out)
    sums = every.groupBy("model", "row").agg(F.array(*[F.sum(f"p{t}") for t in range(n)]).alias("p"), F.sum("seconds").alias("seconds"))
    return sums.join(raw.rows.select("row", "fold", "y", *keep), "row")


def validate_together(design: DataFrame, models: list[NamedModel], targets: tuple[str, str] = ("dx", "dy"), k: int = 10,
                      fold_col: str = "fold", y_unit: str = "meters") -> "list[CVResult]":
    """E3 for several models: fit on k-1 folds, score the held-out fold by mean haversine km."""
    keep = ("start_lat", "start_lon") if y_unit == "meters" else ()
    p = held_out_predictions(design, models, targets, k, fold_col, keep)
    t0, t1 = targets
    wide = p.select("model", "fold", "seconds", F.col("row").alias("trajectory_id"), *keep,
                    *[F.col(c)[i].alias(a + t) for i, t in enumerate(targets) for c, a in (("y", ""), ("p", "pred_"))])
    la = predictions_latlon(wide, targets, y_unit, ("model", "fold", "seconds"))
    rows = with_distance(la).groupBy("model", "fold").agg(F.avg("dist_km").alias("km"), F.sum("seconds").alias("s")).collect()
    by = {(r["model"], r["fold"]): (r["km"], r["s"]) for r in rows}
    return [_result(design.sparkSession, m.name, [(m.name, f, *by.get((i, f), (None, 0.0))) for f in range(k)]) for i, m in enumerate(models)]


def _result(spark: SparkSession, name: str, rows: list[tuple]) -> CVResult:
    folds = spark.createDataFrame(rows, "model_name string, fold int, error_km double, seconds double")
    errs = [r[2] for r in rows if r[2] is not None]
    mean = sum(errs) / len(errs) if errs else float("nan")
    std = (sum((e - mean) ** 2 for e in errs) / len(errs)) ** 0.5 if errs else float("nan")
    return CVResult(name, folds, mean, std)


def cross_validate(design: DataFrame, model: NamedModel, targets: tuple[str, str] = ("dx", "dy"),
                   k: int = 10, fold_col: str = "fold", y_unit: str = "meters",
                   parallelism: int = 2, prepare=None) -> CVResult:
    """Fit on k-1 folds, score the held-out fold by mean haversine km.

    ``prepare(train, held_out)`` returns both frames with a design vector; with it (see
    :func:`fit_inside_folds`) scaler and selection never see the held-out rows."""
    if prepare is None and together([model]):
        return validate_together(design, [model], targets, k, fold_col, y_unit)[0]

    def one(f: int):
        t0 = time.time()
        tr = design.where(F.col(fold_col) != f)
        va = design.where(F.col(fold_col) == f)
        if prepare is not None:
            tr, va = prepare(tr, va)
        m = MultiTargetRegressor(model.build, targets).fit(tr)
        err = fold_error(predictions_latlon(m.transform(va), targets, y_unit))
        return (model.name, f, float(err) if err is not None else None, time.time() - t0)

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as ex:
        rows = list(ex.map(one, range(k)))
    return _result(design.sparkSession, model.name, rows)


def fit_inside_folds(cols: list[str], **options):
    """A ``prepare`` for :func:`cross_validate`: M1-M5 fitted on the k-1 folds, applied to the held-out one."""
    from geotrace.operators.prepare import local_target, prepare

    def run(train: DataFrame, held_out: DataFrame) -> tuple[DataFrame, DataFrame]:
        p = prepare(train, local_target(held_out), cols, **options)
        return p.train, p.test
    return run


def rank_models(fold_rows: DataFrame) -> DataFrame:
    """Mean / population-std of fold errors per model, ascending by mean error."""
    return (fold_rows.groupBy("model_name")
            .agg(F.avg("error_km").alias("mean_error"), F.stddev_pop("error_km").alias("std_error"),
                 F.avg("seconds").alias("mean_time"), F.count(F.lit(1)).alias("folds"))
            .orderBy("mean_error", "model_name"))


def validate_models(design: DataFrame, models: list[NamedModel], model_parallelism: int = 2,
                    **kw) -> tuple[DataFrame, list[CVResult]]:
    """CV every model (several at once), isolating failures; returns (ranking, results).

    A model that fails stays in the ranking, last, with its error text in ``error``.

    Tree ensembles and linear models share their jobs (unless one of them fails: then each runs alone). Of the
    others, the folds run in parallel too (``parallelism``).
    """
    joint: dict[int, CVResult] = {}
    same = [] if kw.get("prepare") else together(models)
    if len(same) > 1:
        options = {c: kw[c] for c in ("targets", "k", "fold_col", "y_unit") if c in kw}
        try:
            joint = {id(m): r for m, r in zip(same, validate_together(design, same, **options), strict=True)}
        except Exception:  # noqa: BLE001  each is tried alone below, and only the failing ones are lost
            joint = {}

    def one(m: NamedModel):
        if id(m) in joint:
            return joint[id(m)]
        try:
            return cross_validate(design, m, **kw)
        except Exception as e:  # noqa: BLE001  a failing model doesn't stop the others
            return (m.name, f"{type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}"[:500])

    with ThreadPoolExecutor(max_workers=max(1, model_parallelism)) as ex:
        found = list(ex.map(one, models))
    results = [r for r in found if isinstance(r, CVResult)]
    failed = [r for r in found if not isinstance(r, CVResult)]
    if not results:
        raise RuntimeError(f"no model could be validated: {failed}")
    rows = results[0].folds
    for r in results[1:]:
        rows = rows.unionByName(r.folds)
    ranking = rank_models(rows).withColumn("error", F.lit(None).cast("string"))
    if failed:
        lost = design.sparkSession.createDataFrame(failed, "model_name string, error string")
        ranking = ranking.unionByName(lost, allowMissingColumns=True)
    return ranking.orderBy(F.col("mean_error").asc_nulls_last(), "model_name"), results


def refit_best(design: DataFrame, models: list[NamedModel], ranking: DataFrame,
               targets: tuple[str, str] = ("dx", "dy")):
    """Refit the winning model (the same builder and parameters, D8) on all rows."""
    best = ranking.first()["model_name"] if ranking is not None else None
    chosen = next((m for m in models if m.name == best), models[0])
    return chosen.name, MultiTargetRegressor(chosen.build, targets).fit(design)


# --- search and stored parameters ----------------------------------------------------------

# The reference's tuning spaces, in Spark ML parameter names
# (n_estimators -> maxIter, learning_rate -> stepSize, max_depth -> maxDepth,
# min_samples_leaf -> minInstancesPerNode, subsample -> subsamplingRate,
# colsample_bytree -> treeFeatures, num_leaves -> numLeaves).
SEARCH_SPACES = {
    "LightGBM": {"maxIter": ("int", 50, 500), "stepSize": ("loguniform", 0.01, 0.2),
                 "maxDepth": ("int", 4, 7), "subsamplingRate": ("uniform", 0.6, 1.0),
                 "featureSubsetStrategy": ("fraction", 0.6, 1.0)},
    "XGBoost": {"maxIter": ("int", 50, 500), "stepSize": ("loguniform", 0.01, 0.2),
                "maxDepth": ("int", 3, 10), "subsamplingRate": ("uniform", 0.6, 1.0),
                "featureSubsetStrategy": ("fraction", 0.6, 1.0)},
    "GradientBoosting": {"maxIter": ("int", 50, 800), "stepSize": ("loguniform", 0.005, 0.2),
                         "maxDepth": ("int", 2, 8), "minInstancesPerNode": ("int", 1, 10),
                         "subsamplingRate": ("uniform", 0.5, 1.0),
                         "featureSubsetStrategy": ("choice", ["sqrt", "log2", "all"])},
}


def trial_table(spark: SparkSession, model_name: str, n_trials: int, seed: int = 42,
                space: dict[str, tuple] | None = None) -> DataFrame:
    """Seeded random-search trials, one row per trial, parameters drawn from hashed uniforms.

    ``space`` replaces ranges of the model's own space, e.g. a shorter range of rounds."""
    import math
    space = SEARCH_SPACES[model_name] | (space or {})
    t = spark.range(n_trials).withColumnRenamed("id", "trial")
    for p, spec in space.items():
        u = uniform(seed, "trial", tag=p)
        kind = spec[0]
        if kind == "int":
            expr = (F.lit(spec[1]) + F.floor(u * (spec[2] - spec[1] + 1))).cast("int")
        elif kind == "uniform":
            expr = F.lit(spec[1]) + u * (spec[2] - spec[1])
        elif kind == "loguniform":
            expr = F.exp(F.lit(math.log(spec[1])) + u * (math.log(spec[2]) - math.log(spec[1])))
        elif kind == "fraction":
            expr = F.format_number(F.lit(spec[1]) + u * (spec[2] - spec[1]), 3)
        else:
            opts = spec[1]
            expr = F.element_at(F.array(*[F.lit(o) for o in opts]), (F.floor(u * len(opts)) + 1).cast("int"))
        t = t.withColumn(p, expr)
    return t


def random_search(design: DataFrame, model_name: str, n_trials: int, make, seed: int = 42,
                  space: dict[str, tuple] | None = None, trial_parallelism: int = 3, **cv_kw) -> DataFrame:
    """CV every trial's parameters; ``trials(trial, params..., mean_error)`` ascending.

    The parameters reported are those that ran; ``make`` must not change them."""
    trials = trial_table(design.sparkSession, model_name, n_trials, seed, space).collect()  # n_trials rows
    chosen = [{k: v for k, v in t.asDict().items() if k != "trial"} for t in trials]
    models = [NamedModel(model_name, make(params)) for params in chosen]
    if not cv_kw.get("prepare") and len(together(models)) == len(models):
        options = {c: cv_kw[c] for c in ("targets", "k", "fold_col", "y_unit") if c in cv_kw}
        errors = [r.mean_error for r in validate_together(design, models, **options)]
    else:
        with ThreadPoolExecutor(max_workers=max(1, trial_parallelism)) as ex:
            errors = list(ex.map(lambda m: cross_validate(design, m, **cv_kw).mean_error, models))
    rows = [(int(t["trial"]), json.dumps(params, sort_keys=True), float(e)) for t, params, e in zip(trials, chosen, errors, strict=True)]
    spark = design.sparkSession
    return spark.createDataFrame(rows, "trial long, params string, mean_error double").orderBy("mean_error", "trial")


def write_best_params(spark: SparkSession, params: dict[str, dict], path: str) -> None:
    """Store best parameters as a one-row JSON file."""
    spark.createDataFrame([(json.dumps(params, sort_keys=True),)], "params string") \
        .coalesce(1).write.mode("overwrite").text(path)


def read_best_params(spark: SparkSession, path: str) -> dict[str, dict]:
    """Read what :func:`write_best_params` wrote ({} when absent)."""
    try:
        row = spark.read.text(path).first()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    return json.loads(row[0]) if row else {}
