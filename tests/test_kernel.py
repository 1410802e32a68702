import numpy as np
import pytest

from geotrace.operators import ensembles as E
from geotrace.operators import kernel
from geotrace.operators import trees as K
from geotrace.operators.models import MultiTargetRegressor, TreeBuilder
from tests.test_shared_fits import frame

GROWERS = [
    K.Grower("boost", 4, 5, 0.3, min_leaf=3), K.Grower("boost", 3, 6, leaves=9, rate=0.3, min_leaf=4),
    K.Grower("boost", 3, 4, 0.3, l1=0.5, l2=1.5, min_weight=3.0, min_gain=0.2, tree_features=0.7, bags=2),
    K.Grower("bag", 30, 20, joint=True, node_features="sqrt", min_leaf=4, min_split=10, bootstrap="poisson"),
    K.Grower("bag", 8, joint=True, random_cuts=True, node_features="sqrt", min_leaf=2, min_split=5),
    K.Grower("boost", 3, 5, 0.1, symmetric=True, l2=3.0, bootstrap="bayes"),
    K.Grower("boost", 3, 9, 0.05, node_features="log2", rows=0.68, min_leaf=8, min_split=20)]


@pytest.mark.parametrize("kept", [kernel.KEPT_NUMBERS, 0])
def test_the_jvm_grows_the_trees_of_numpy(spark, monkeypatch, kept):
    monkeypatch.setattr(kernel, "KEPT_NUMBERS", kept)
    d = E.design(frame(spark, 700), "features", ("dx", "dy"), "fold")
    jobs = [E.Job(g, f) for g in GROWERS for f in (1, None)]
    parts = E.parts_of(jobs, 2)
    assert all(kernel.grows(x.grower, len(x.targets), 4) for x in parts)
    found = kernel.run(d, parts, E._dealt(parts, 4, 5)).collect()
    trees = {(r["part"], r["tree"]): r for r in found if r["nodes"] is not None}
    rows = d.rows.collect()
    B, ids = np.stack([np.frombuffer(r["bins"], np.uint8) for r in rows]), np.array([r["draw"] for r in rows]).view(np.uint64)
    fold, Y = np.array([r["fold"] for r in rows]), K.rounded_targets(np.array([r["y"] for r in rows]), d.largest)
    seen = 0
    for i, x in enumerate(parts):
        on = fold != x.fold if x.fold is not None else fold >= 0
        e = K.fitted(x.grower, ids[on], B[on], Y[on][:, list(x.targets)], d.largest, d.values, x.bag, x.first, x.last)
        if x.fold is not None:
            continue
        for t, a in enumerate(e.trees):
            b = kernel.decoded(bytes(trees[i, x.first + t]["nodes"]), len(x.targets))
            assert (a.feature == b.feature).all() and (a.left == b.left).all() and np.array_equal(a.value, b.value)
            assert (a.cut == b.cut)[a.feature >= 0].all() and np.allclose(trees[i, x.first + t]["p"], e.base, rtol=1e-15)
            seen += 1
    assert seen == len(trees)


def test_held_out_predictions_of_the_jvm_are_those_of_numpy(spark, monkeypatch):
    d = E.design(frame(spark), "features", ("dx", "dy"), "fold")
    jobs = [E.Job(g, f) for g in GROWERS for f in (0, 2)]
    ours = E.fit_many(d, jobs).out.orderBy("job", "row").collect()
    monkeypatch.setattr(kernel, "grows", lambda *a: False)
    theirs = E.fit_many(d, jobs).out.orderBy("job", "row").collect()
    assert len(ours) == len(jobs) * 80 and [r[:2] for r in ours] == [r[:2] for r in theirs]
    assert np.allclose([r[2:4] for r in ours], [r[2:4] for r in theirs], rtol=1e-12)


@pytest.mark.parametrize("name, params", [("RandomForest", dict(numTrees=30, maxDepth=12, featureSubsetStrategy="sqrt", bootstrap=True)),
                                          ("BaggedGB", dict(n_bags=2, maxIter=4, maxDepth=3))])
def test_large_models_stay_in_the_checkpoint_folder(spark, monkeypatch, name, params):
    df = frame(spark)
    near = MultiTargetRegressor(TreeBuilder(name, params)).fit(df).transform(df).orderBy("trajectory_id").collect()
    monkeypatch.setattr(E, "MODEL_BYTES", 500)
    monkeypatch.setattr(E, "BLOCK_ROWS", 50)
    model = MultiTargetRegressor(TreeBuilder(name, params)).fit(df)
    assert all(isinstance(x, E.FarPiece) for x in model.models[0].pieces)
    monkeypatch.setattr(E, "predictor", lambda *a: lambda c: c)  # nothing is broadcast
    far = model.transform(df).orderBy("trajectory_id").collect()
    assert len(far) == 240 and far[0].asDict().keys() == near[0].asDict().keys()
    assert np.allclose([(r["pred_dx"], r["pred_dy"]) for r in far], [(r["pred_dx"], r["pred_dy"]) for r in near], rtol=1e-12)


def test_large_values_lie_in_row_groups_of_their_own(spark):
    from pathlib import Path

    import pyarrow.parquet as pq
    from pyspark.sql import functions as F

    from geotrace.session import stored
    df = stored(spark.range(0, 12, numPartitions=1).select(F.expr("encode(array_join(transform(sequence(0, 8000), x -> sha2(string(id * 10000 + x), 512)), ''), 'UTF-8')").alias("nodes")), 1 << 20)
    files = [f.removeprefix("file:") for f in df.inputFiles()]
    assert sum(pq.ParquetFile(Path(f)).metadata.num_row_groups for f in files) >= 6


def test_adaboost_of_many_rows_grows_in_waves_beside_the_jvm(spark, monkeypatch):
    d = E.design(frame(spark), "features", ("dx", "dy"), "fold")
    jobs = [E.Job(g, f) for g in (K.Grower("adaboost", 4, 3, 1.0), GROWERS[0]) for f in (1, None)]
    near = E.fit_many(d, jobs)
    monkeypatch.setattr(E, "PYTHON_ROWS", 0)
    monkeypatch.setattr(E, "_in_python", None)
    far = E.fit_many(d, jobs)
    a, b = (sorted((r["job"], r["row"], r["p0"], r["p1"]) for r in x.out.collect()) for x in (near, far))
    assert len(a) == 160 and np.allclose(a, b, rtol=1e-6)
    assert near.pieces.keys() == far.pieces.keys() == {1, 3}
    assert [x.place for x in near.pieces[1]] == [x.place for x in far.pieces[1]]
