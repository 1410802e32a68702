"""Score trajectory files as they arrive.

A trajectory row is complete on arrival, so every micro-batch is scored on its own
with the batch steps: features (F29), the fitted scaler and selection (M3-M5), the
fitted two-target model (X1) and the submission rules (X2). Each batch is written to
its own ``epoch=<id>`` Parquet folder (idempotent on replay); the stream's checkpoint
lives under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geotrace.operators.features import extract_features
from geotrace.operators.prepare import Prepared
from geotrace.operators.submission import build_submission, predict_latlon
from geotrace.session import ensure_checkpoint_dir
from geotrace.sources.io import parse_trajectories

TRAJECTORY_SCHEMA = T.StructType([
    T.StructField("trajectory_id", T.StringType()),
    T.StructField("path_lat", T.ArrayType(T.DoubleType())),
    T.StructField("path_lon", T.ArrayType(T.DoubleType())),
])


def score_batch(batch: DataFrame, model, prep: Prepared) -> DataFrame:
    """Submission rows for one batch of trajectories with the fitted model and preparation."""
    t = parse_trajectories(batch)
    f = extract_features(t)
    s = prep.scaler.transform(f, "_s")
    va = VectorAssembler(inputCols=[c + "_s" for c in prep.feature_names], outputCol="features",
                         handleInvalid="keep")
    pred = predict_latlon(model, va.transform(s), prep.target_cols,
                          "meters" if prep.target_cols == ("dx", "dy") else "degrees")
    raw = pred.select("trajectory_id", F.col("latitude_pred").alias("a"), F.col("longitude_pred").alias("b"))
    return build_submission(raw, t, unit="degrees")  # not sniffed: one wild row must not re-scale its batch


def score_stream(spark: SparkSession, source_dir: str, sink_dir: str, model, prep: Prepared,
                 schema: T.StructType = TRAJECTORY_SCHEMA, name: str = "trajectory-scoring",
                 available_now: bool = True):
    """Start the stream; returns the ``StreamingQuery`` (``available_now`` processes what is there, then stops)."""
    ck = ensure_checkpoint_dir(spark).rstrip("/") + f"/streams/{name}"
    src = spark.readStream.schema(schema).parquet(source_dir)

    def write(batch: DataFrame, epoch_id: int) -> None:
        # One folder per epoch, overwritten: a batch replayed after a failure rewrites the
        # same output instead of appending duplicates (foreachBatch is at-least-once).
        score_batch(batch, model, prep).write.mode("overwrite").parquet(
            f"{sink_dir.rstrip('/')}/epoch={epoch_id}")

    w = src.writeStream.foreachBatch(write).option("checkpointLocation", ck).queryName(name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
