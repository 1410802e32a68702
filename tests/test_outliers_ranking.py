from pyspark.sql import Window
from pyspark.sql import functions as F

from geotrace.operators import outliers as O
from geotrace.operators.ranking import global_rank
from geotrace.operators.validation import balanced_folds, fold_integrity, group_folds


def test_global_rank_matches_row_number(spark):
    df = spark.range(500).select((F.col("id") * 7919 % 503).alias("k"), F.col("id"))
    want = {r["id"]: r["rn"] - 1 for r in df.select(
        "id", F.row_number().over(Window.orderBy("k", "id")).alias("rn")).collect()}
    for parts in (1, 5):
        got = {r["id"]: r["rank"] for r in global_rank(df.repartition(parts), ["k", "id"]).collect()}
        assert got == want


def test_masks_and_cap(traj_df):
    far = [60.0, 60.001]               # outside the box
    jump = [39.9, 42.0, 39.9]          # ~230 km jumps
    ok = [39.9, 39.9001, 39.9002]
    rows = [("geo", far, [116.4, 116.4], 40.0, 116.0),
            ("jump", jump, [116.4] * 3, 40.0, 116.0),
            ("dest", ok, [116.4] * 3, 95.0, 116.0),
            ("empty", [], [], 40.0, 116.0)]
    rows += [(f"ok{i}", ok, [116.4] * 3, 40.0, 116.0) for i in range(16)]
    df = O.combine(O.add_path_masks(traj_df(rows), O.OutlierConfig()), "any")
    got = {r["trajectory_id"]: r for r in df.collect()}
    assert got["geo"]["is_geographic"] and not got["geo"]["is_trajectory"]
    assert got["jump"]["is_trajectory"] and not got["jump"]["is_geographic"]
    assert got["dest"]["is_target"] and got["empty"]["is_geographic"]
    assert sum(r["is_outlier"] for r in got.values()) == 4
    capped = O.cap(df, 0.10)           # k = int(20 * 0.10) = 2
    flagged = {r["trajectory_id"] for r in capped.where("is_outlier").collect()}
    assert len(flagged) == 2
    # geographic rows score highest (1 + 3); the empty path is geographic too and comes later in order
    assert flagged == {"geo", "empty"}
    rep = {r["type"]: r["count"] for r in O.report(df).collect()}
    assert rep["total"] == 20 and rep["combined"] == 4 and rep["clean"] == 16


def test_safety_rule_and_remove(traj_df):
    rows = [("a", [60.0, 60.0], [116.0, 116.0], 40.0, 116.0),
            ("b", [39.9, 42.0, 39.9], [116.4] * 3, 40.0, 116.0),
            ("c", [39.9, 39.9], [116.4, 116.4], 40.0, 116.0)]
    df = O.combine(O.add_path_masks(traj_df(rows)), "any")
    kept = {r["trajectory_id"] for r in O.remove(O.safety_rule(df, 0.03)).collect()}
    assert kept == {"b", "c"}     # share 2/3 > 3 %: only geographic / target rows go
    all_out = df.withColumn("is_outlier", F.lit(True))
    assert O.remove(all_out).count() == 3   # never remove everything


def test_all_method_is_a_true_and(traj_df):
    df = O.add_path_masks(traj_df([("a", [60.0, 60.0], [116.0, 116.0], 95.0, 116.0)]))
    assert O.combine(df, "all", ["is_geographic", "is_target"]).first()["is_outlier"] is True


def test_group_folds_integrity(spark):
    df = spark.range(300).select(F.concat(F.lit("t"), (F.col("id") % 100).cast("string")).alias("trajectory_id"))
    f = group_folds(df, 5)
    integ = fold_integrity(f).collect()
    assert all(r["straddling_groups"] == 0 for r in integ)
    assert sum(r["rows"] for r in integ) == 300


def test_balanced_folds_sizes(spark):
    df = spark.range(103).withColumnRenamed("id", "ingest_seq")
    sizes = [r[1] for r in balanced_folds(df, 10).groupBy("fold").count().collect()]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == 103


def test_balanced_group_folds(spark):
    from geotrace.operators.validation import balanced_group_folds
    df = spark.range(1000).select(F.concat(F.lit("g"), (F.col("id") % 37).cast("string")).alias("trajectory_id"))
    f = balanced_group_folds(df, 5)
    integ = fold_integrity(f).collect()
    assert all(r["straddling_groups"] == 0 for r in integ)
    sizes = sorted(r["rows"] for r in integ)
    assert sum(sizes) == 1000 and sizes[-1] - sizes[0] <= 2 * 28
