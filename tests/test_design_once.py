from pyspark.sql import functions as F

from geotrace.plans import common, q_models


def test_design_derives_the_trajectories_once(spark, tmp_path, monkeypatch):
    """Both splits come from one written table of cleaned trajectories."""
    ev = spark.range(900).select(
        F.col("id").alias("event_id"), (F.col("id") % 12).alias("user_id"),
        F.expr("timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, CAST(id * 29 DIV 36 AS INT))").cast("timestamp_ntz").alias("ts"))
    ev.write.parquet(f"{tmp_path}/events.parquet")
    calls = []
    derive = common.gps_trajectories
    monkeypatch.setattr(common, "gps_trajectories", lambda *a: calls.append(a) or derive(*a))
    monkeypatch.setattr(q_models.P, "prepare", lambda tr, te, *a, **k: (tr, te))
    train, test = ({r[0] for r in df.select("trajectory_id").collect()} for df in q_models.design(spark, str(tmp_path)))
    assert train == {f"{u}_{b}" for u in range(12) for b in range(5) if b != 4} and test == {f"{u}_4" for u in range(12)}
    assert len(calls) == 1
