"""Registered model, cross-validation and search queries.

Model outputs are not bit-comparable with another engine, so these keys have no SQL
twin (rows-only check); their invariants are tested in tests/. All run the library's
settings of ``models.model_params``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from geotrace.operators import prepare as P
from geotrace.operators import validation as V
from geotrace.operators.features import FEATURE_NAMES, LEAKY_FEATURES, extract_features
from geotrace.operators.models import (MultiTargetRegressor, NamedModel, builder, stacking_builder,
                                       voting_builder)
from geotrace.operators.submission import predict_latlon
from geotrace.plans.common import clean_splits
from geotrace.plans.registry import register
from geotrace.session import ensure_checkpoint_dir

CV_FOLDS = 10
# Fixed values of the short runs: 3 folds, and 20 trials of 3 folds for the search.
QUICK_FOLDS = 3
TRIALS = 20
COLS = [c for c in FEATURE_NAMES if c not in LEAKY_FEATURES]


def design(spark, sf_dir):
    """Prepared train/test design; the trajectories are derived once for both splits, and feature tables are
    checkpointed once (several statistics and every model fit read them, and the checkpoint cuts the lineage
    back to ``events``)."""
    ensure_checkpoint_dir(spark)
    tr, te = (extract_features(t, keep=["dest_lat", "dest_lon", "ingest_seq"]).checkpoint() for t in clean_splits(spark, sf_dir))
    return P.prepare(tr, te, COLS, use_local_target=True, scaler="robust", select=True)


def _named(name: str, n_samples: int | None = None) -> NamedModel:
    """The library's model for ``n_samples`` training rows (R18: small tables get fewer trees)."""
    return NamedModel(name, builder(name, n_samples))


def _predict_query(make):
    """``make(n_samples)`` gives the builder."""
    def build(spark, sf_dir):
        prep = design(spark, sf_dir)
        m = MultiTargetRegressor(make(prep.train.count()), prep.target_cols).fit(prep.train)
        return predict_latlon(m, prep.test, prep.target_cols, "meters")
    return build


for _key, _name in [("ridge", "Ridge"), ("lasso", "Lasso"), ("elasticnet", "ElasticNet"),
                    ("linear_ols", "LinearRegression"), ("rf", "RandomForest"), ("extra_trees", "ExtraTrees"),
                    ("gbt", "GradientBoosting"), ("xgboost_like", "XGBoost"), ("lightgbm_like", "LightGBM"),
                    ("hist_gb", "HistGradientBoosting"), ("catboost_like", "CatBoost"), ("bagged_gb", "BaggedGB"),
                    ("knn_model", "KNN")]:
    register(_key)(_predict_query(lambda n=None, name=_name: _named(name, n).build))


@register("voting")
def voting(spark, sf_dir):
    members = ("RandomForest", "XGBoost", "LightGBM")
    return _predict_query(lambda n=None: voting_builder([_named(m, n).build for m in members]))(spark, sf_dir)


@register("stacking")
def stacking(spark, sf_dir):
    members = ("Ridge", "RandomForest", "GradientBoosting")
    return _predict_query(lambda n=None: stacking_builder([_named(m, n).build for m in members]))(spark, sf_dir)


def _cv_design(spark, sf_dir, k=CV_FOLDS):
    prep = design(spark, sf_dir)
    return prep, V.group_folds(prep.train, k, "trajectory_id", 42)


@register("cv_ranking")
def cv_ranking(spark, sf_dir):
    prep, d = _cv_design(spark, sf_dir)
    n = prep.train.count()
    models = [_named(m, n) for m in ("Ridge", "RandomForest", "GradientBoosting", "BaggedGB")]
    ranking, _ = V.validate_models(d, models, model_parallelism=4, targets=prep.target_cols, k=CV_FOLDS,
                                   y_unit="meters", parallelism=3)
    return ranking


@register("cv_folds")
def cv_folds(spark, sf_dir):
    prep, d = _cv_design(spark, sf_dir)
    return V.cross_validate(d, _named("Ridge"), prep.target_cols, CV_FOLDS, y_unit="meters").folds


@register("refit_predict")
def refit_predict(spark, sf_dir):
    prep, d = _cv_design(spark, sf_dir)
    n = prep.train.count()
    models = [_named(m, n) for m in ("Ridge", "GradientBoosting")]
    ranking, _ = V.validate_models(d, models, targets=prep.target_cols, k=CV_FOLDS, y_unit="meters")
    name, fitted = V.refit_best(d, models, ranking, prep.target_cols)
    return predict_latlon(fitted, prep.test, prep.target_cols, "meters").withColumn("model_name", F.lit(name))


@register("random_search")
def random_search(spark, sf_dir):
    prep, d = _cv_design(spark, sf_dir, QUICK_FOLDS)

    def make(params):
        return builder("GradientBoosting", None, dict(params))
    return V.random_search(d, "GradientBoosting", TRIALS, make, targets=prep.target_cols, k=QUICK_FOLDS, y_unit="meters")


@register("quick_experiment")
def quick_experiment(spark, sf_dir):
    """Features -> prepare -> 3-fold CV of the priority models -> ranking."""
    prep, d = _cv_design(spark, sf_dir, QUICK_FOLDS)
    n = prep.train.count()
    models = [_named(m, n) for m in ("RandomForest", "XGBoost", "LightGBM", "GradientBoosting", "BaggedGB",
                                     "HistGradientBoosting")]
    ranking, _ = V.validate_models(d, models, model_parallelism=3, targets=prep.target_cols, k=QUICK_FOLDS,
                                   y_unit="meters", parallelism=3)
    return ranking


register("bayesian_ridge")(_predict_query(lambda n=None: _named("BayesianRidge", n).build))
register("adaboost")(_predict_query(lambda n=None: _named("AdaBoost", n).build))


@register("end_to_end")
def end_to_end(spark, sf_dir):
    """X8 end to end on the derived tables, with the library's settings (10 folds, the priority models)."""
    from geotrace.plans.end_to_end import run
    from geotrace.sources.fixtures import gps_trajectories
    return run(gps_trajectories(spark, sf_dir)).submission


@register("run_report")
def run_report(spark, sf_dir):
    """The full run's one-row report."""
    from geotrace.plans.end_to_end import run
    from geotrace.sources.fixtures import gps_trajectories
    return run(gps_trajectories(spark, sf_dir)).report


@register("mlp")
def mlp(spark, sf_dir):
    """R13 with the library's settings (at most 200 epochs of minibatch Adam)."""
    return _predict_query(lambda n=None: _named("MLP", n).build)(spark, sf_dir)
