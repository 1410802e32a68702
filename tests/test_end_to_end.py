from pyspark.sql import functions as F

from geotrace.plans.end_to_end import PipelineConfig, run
from geotrace.sources.fixtures import gps_trajectories
from tests.conftest import SF01


def test_end_to_end_small_config(spark):
    t = gps_trajectories(spark, SF01)
    cfg = PipelineConfig(cluster_k=3, cluster_n_init=2, models=["Ridge", "LinearRegression"], cv_folds=3,
                         augment_p=0.5)
    res = run(t, cfg)
    sub = res.submission.collect()
    n_test = t.where("split = 'test'").count()
    assert len(sub) == n_test and len({r["trajectory_id"] for r in sub}) == n_test
    assert all(r["latitude_pred"] is None or -90 <= r["latitude_pred"] <= 90 for r in sub)
    rank = res.ranking.collect()
    assert [r["model_name"] for r in rank] and rank[0]["mean_error"] <= rank[-1]["mean_error"]
    rep = res.report.first()
    assert rep["model"] == res.best_model and rep["test_rows"] == n_test
    assert rep["outliers_removed"] <= rep["train_rows"] + rep["outliers_removed"]
    assert res.submission.where(F.col("trajectory_id").isNull()).count() == 0
