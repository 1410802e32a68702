"""The full run (X8): clean -> outliers -> cluster -> augment -> features -> prepare -> CV -> refit
-> predict -> submission and report.

Function API instead of a command line; every stage is a DataFrame transformation, and
the only driver round-trips are 1-row statistics, the small CV result rows and model
fitting. Targets are always joined on ``trajectory_id`` (never by position, D2).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geotrace.operators import augment as A
from geotrace.operators import clustering as K
from geotrace.operators import outliers as O
from geotrace.operators import prepare as P
from geotrace.operators import quality as Q
from geotrace.operators import validation as V
from geotrace.operators.features import FEATURE_NAMES, LEAKY_FEATURES, extract_features
from geotrace.operators.models import PRIORITY_MODELS, create_all_models
from geotrace.operators.submission import build_submission, predict_latlon, run_report
from geotrace.session import ensure_checkpoint_dir
from geotrace.sources.io import write_submission


@dataclass
class PipelineConfig:
    clean: Q.CleanConfig = field(default_factory=Q.CleanConfig)
    outliers: O.OutlierConfig = field(default_factory=O.OutlierConfig)
    cluster: bool = True
    cluster_k: int | None = None
    cluster_n_init: int = 10
    cluster_max_k: int = 10
    augment: bool = True
    augment_p: float = 0.5
    seed: int = 42
    models: list[str] = field(default_factory=lambda: list(PRIORITY_MODELS))
    model_params: dict[str, dict] = field(default_factory=dict)
    ensemble: bool = False
    cv_folds: int = 10
    cv_parallelism: int = 2
    use_local_target: bool = True
    scaler: str = "robust"
    select_features: bool = True
    include_leaky: bool = False
    submit_dir: str | None = None


@dataclass
class PipelineResult:
    ranking: DataFrame
    submission: DataFrame
    report: DataFrame
    best_model: str
    feature_names: list[str]


def run(traj: DataFrame, cfg: PipelineConfig | None = None) -> PipelineResult:
    """``traj``: unioned train/test trajectories (``split`` column, parsed arrays, ``ingest_seq``)."""
    cfg = cfg or PipelineConfig()
    spark = traj.sparkSession
    ensure_checkpoint_dir(spark)

    cleaned = Q.clean(traj, cfg.clean)
    train = cleaned.where(F.col("split") == "train")
    test = cleaned.where(F.col("split") == "test")

    masked = O.combine(O.add_path_masks(train, cfg.outliers), "any")
    masked = O.cap(masked, cfg.outliers.max_outlier_pct)
    masked = masked.checkpoint()
    n_before, flagged = masked.agg(F.count(F.lit(1)), F.count_if("is_outlier")).first()
    guarded = O.safety_rule(masked, cfg.outliers.safety_share)
    train = O.remove(guarded).drop(*O.present_masks(guarded), "is_outlier")
    train = train.checkpoint()                      # cut lineage before the ML stages
    removed = n_before - train.count()

    if cfg.cluster:
        labels = K.fit_predict(train, cfg.cluster_k, cfg.seed, cfg.cluster_n_init, cfg.cluster_max_k)
        train = K.largest_cluster(train, labels).checkpoint()

    if cfg.augment:
        train = A.augment(train, p=cfg.augment_p, seed=cfg.seed).drop("method")

    keep = ["dest_lat", "dest_lon", "ingest_seq"]
    cols = [c for c in FEATURE_NAMES if cfg.include_leaky or c not in LEAKY_FEATURES]
    ftrain = extract_features(train, keep=keep).checkpoint()
    ftest = extract_features(test, keep=keep).checkpoint()

    prep = P.prepare(ftrain, ftest, cols, cfg.use_local_target, cfg.scaler, cfg.select_features)
    design = V.group_folds(prep.train, cfg.cv_folds, "trajectory_id", cfg.seed)
    n_train = design.count()
    models = create_all_models(cfg.models, n_train, cfg.model_params, cfg.ensemble)
    y_unit = "meters" if cfg.use_local_target else "degrees"
    ranking, results = V.validate_models(design, models, targets=prep.target_cols, k=cfg.cv_folds,
                                         y_unit=y_unit, parallelism=cfg.cv_parallelism)
    best_name, fitted = V.refit_best(design, models, ranking, prep.target_cols)
    pred = predict_latlon(fitted, prep.test, prep.target_cols, y_unit)
    sub = build_submission(pred.select("trajectory_id", F.col("latitude_pred").alias("a"),
                                       F.col("longitude_pred").alias("b")), test)
    if cfg.submit_dir:
        write_submission(sub, cfg.submit_dir, best_name)
    best = ranking.first()
    report = run_report(best_name, n_train, ftest.count(), len(prep.feature_names) + 3, flagged,
                             removed, float(best["mean_error"]) if best else None, spark)
    return PipelineResult(ranking, sub, report, best_name, prep.feature_names)
