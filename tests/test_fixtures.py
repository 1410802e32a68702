from pyspark.sql import Window
from pyspark.sql import functions as F

from geotrace.sources import fixtures as X
from tests.conftest import SF001


def _single_window(spark):
    """The plain recipe: one running-sum window over each whole trajectory."""
    s = X._steps(X.read_table(spark, SF001, "events"))
    w = Window.partitionBy("trajectory_id").orderBy("ts", "event_id")
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return s.select("trajectory_id", F.row_number().over(w).alias("pos1"),
                    ((F.col("lat0") + F.sum("step_lat").over(run)) / 1e6).alias("lat"),
                    ((F.col("lon0") + F.sum("step_lon").over(run)) / 1e6).alias("lon"))


def test_positions_do_not_depend_on_chunk_width(spark):
    want = sorted(_single_window(spark).collect())
    for secs in (60, 3600, 30 * 86400):
        got = sorted(X.raw_positions(spark, SF001, secs).select("trajectory_id", "pos1", "lat", "lon").collect())
        assert got == want, secs


def test_trajectory_table_shape(spark):
    t = X.gps_trajectories(spark, SF001)
    rows = t.collect()
    assert len(rows) == 75
    assert {r["split"] for r in rows} == {"train", "test"}
    for r in rows:
        assert len(r["path_lat"]) == len(r["path_lon"])
        assert (r["dest_lat"] is None) == (r["split"] == "test")
    assert len({r["ingest_seq"] for r in rows}) == 75
