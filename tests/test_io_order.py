import pytest
from pyspark.sql import functions as F

from geotrace.operators.quality import clean
from geotrace.session import ensure_checkpoint_dir
from geotrace.sources.io import load_data, read_optional_csv

HEAD = "trajectory_id,path_lat,path_lon,dest_lat,dest_lon\n"


def test_first_occurrence_follows_file_names_not_sizes(spark, tmp_path):
    train, test = tmp_path / "train", tmp_path / "test"
    train.mkdir(), test.mkdir()
    (train / "a.csv").write_text(HEAD + 'x,"[1.0, 2.0]","[1.0, 2.0]",1,1\n')
    more = "".join(f'y{i},"[1.0, 2.0]","[1.0, 2.0]",3,3\n' for i in range(500))
    (train / "b.csv").write_text(HEAD + 'x,"[5.0, 6.0]","[5.0, 6.0]",2,2\n' + more)
    (test / "a.csv").write_text('trajectory_id,path_lat,path_lon\nz,"(1.0, 2.0)","[1.0"\n')
    rows = load_data(spark, str(train), str(test))
    assert sorted(r.ingest_seq for r in rows.collect()) == list(range(503))
    assert rows.where("split = 'test'").first().ingest_seq == 502
    kept = clean(rows).where("trajectory_id = 'x'").collect()
    assert len(kept) == 1 and kept[0].dest_lat == 1.0 and kept[0].ingest_seq == 0


def test_optional_file_is_none_only_if_absent(spark, tmp_path):
    assert read_optional_csv(spark, str(tmp_path / "none.csv")) is None


def test_cluster_sessions_must_name_the_checkpoint_folder():
    class Context:
        master = "spark://host:7077"

    class Session:
        sparkContext = Context()  # noqa: N815
        conf = {}
    with pytest.raises(ValueError, match="checkpoint"):
        ensure_checkpoint_dir(Session())


def test_failed_models_stay_in_the_ranking(spark):
    from geotrace.operators import validation as V
    from geotrace.operators.models import NamedModel, builder
    from pyspark.ml.feature import VectorAssembler
    rows = [(f"t{i}", i % 2, 10.0, 20.0, float(i), float(i) * 2, float(-i)) for i in range(40)]
    df = spark.createDataFrame(rows, "trajectory_id string, fold int, start_lat double, start_lon double, x double, dx double, dy double")
    d = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)

    def broken(*_):
        raise RuntimeError("no such model")
    ranking, results = V.validate_models(d, [NamedModel("bad", broken), NamedModel("Ridge", builder("Ridge"))], k=2)
    got = ranking.collect()
    assert [r.model_name for r in got] == ["Ridge", "bad"] and "no such model" in got[1].error and got[0].error is None
    assert len(results) == 1


def test_search_reports_the_parameters_that_run(spark):
    from geotrace.operators.validation import trial_table
    rows = trial_table(spark, "GradientBoosting", 50, space={"maxIter": ("int", 5, 20)}).collect()
    assert {r.maxIter for r in rows} <= set(range(5, 21)) and len({r.maxIter for r in rows}) > 5


def test_bootstrap_weights_have_no_ceiling_below_the_draw(spark):
    from geotrace.functions.hashrand import poisson1
    got = spark.range(20_000).select(poisson1(1, F.col("id")).alias("w")).agg(F.avg("w"), F.var_pop("w")).first()
    assert got[0] == pytest.approx(1, abs=0.03) and got[1] == pytest.approx(1, abs=0.05)


def test_preparation_inside_folds_never_sees_the_held_out_rows(spark):
    from geotrace.operators import validation as V
    from geotrace.operators.models import NamedModel, builder
    rows = [(f"t{i}", i % 2, 10.0 + i / 100, 20.0 + (i * 7 % 13) / 100, 10.0 + i / 99, 20.0 + i / 98, 1e6 if i == 1 else 0.0) for i in range(60)]
    df = spark.createDataFrame(rows, "trajectory_id string, fold int, start_lat double, start_lon double, dest_lat double, dest_lon double, spike double")
    seen = []

    def prepare(train, held_out):
        tr, va = V.fit_inside_folds(["start_lat", "start_lon", "spike"], select=False)(train, held_out)
        seen.append((train.agg(F.min("fold"), F.max("fold")).first(), len(tr.first()["features"])))
        return tr, va
    res = V.cross_validate(df, NamedModel("Ridge", builder("Ridge")), k=2, prepare=prepare, parallelism=1)
    assert res.mean_error < 20 and all(a == b for (a, b), _ in seen)
    assert sorted(n for _, n in seen) == [2, 3]  # the spike of fold 1 is constant, and so dropped, where only fold 0 is seen
