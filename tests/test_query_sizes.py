import pytest

from geotrace.operators import validation as V
from geotrace.operators.models import model_params
from geotrace.plans import end_to_end, q_models
from geotrace.plans.registry import QUERIES


class Seen(Exception):
    pass


def stop(*args, **kw):
    raise Seen(args, kw)


@pytest.mark.parametrize("name", ["RandomForest", "ExtraTrees", "GradientBoosting", "XGBoost", "LightGBM",
                                  "HistGradientBoosting", "CatBoost"])
def test_queries_run_the_library_settings(spark, name):
    train = spark.createDataFrame([(0.0,), (1.0,)], "dx double")
    est = q_models._named(name).build(train, "dx")
    for p in ("numTrees", "maxDepth", "maxIter", "minInstancesPerNode"):
        if p in model_params(name):
            assert est.getOrDefault(p) == model_params(name)[p], p


@pytest.mark.parametrize("key, k", [("cv_ranking", 10), ("cv_folds", 10), ("refit_predict", 10), ("random_search", 3),
                                    ("quick_experiment", 3)])
def test_folds(monkeypatch, key, k):
    monkeypatch.setattr(q_models, "design", lambda spark, sf_dir: type("Prep", (), {"train": None, "target_cols": ()}))
    monkeypatch.setattr(V, "group_folds", stop)
    with pytest.raises(Seen) as e:
        QUERIES[key](None, "")
    assert e.value.args[0][1] == k


def test_stacking_search_and_end_to_end(monkeypatch):
    seen = {}
    monkeypatch.setattr(q_models, "stacking_builder", lambda members, k=5: seen.update(k=k))
    monkeypatch.setattr(q_models, "_predict_query", lambda make: lambda spark, sf_dir: make())
    QUERIES["stacking"](None, "")
    assert seen["k"] == 5
    monkeypatch.setattr(q_models, "_cv_design", lambda spark, sf_dir, k: (type("Prep", (), {"target_cols": ()}), None))
    monkeypatch.setattr(V, "random_search", stop)
    with pytest.raises(Seen) as e:
        QUERIES["random_search"](None, "")
    assert e.value.args[0][2] == 20 and not e.value.args[1].get("space")
    monkeypatch.setattr(end_to_end, "run", stop)
    monkeypatch.setattr("geotrace.sources.fixtures.gps_trajectories", lambda spark, sf_dir: "rows")
    with pytest.raises(Seen) as e:
        QUERIES["end_to_end"](None, "")
    assert e.value.args[0] == ("rows",)
