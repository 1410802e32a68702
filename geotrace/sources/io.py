"""Readers and writers.

CSV trajectory files hold paths as list text (``"[40.1, 40.2]"``). They are read with
an explicit schema (never inferred) and parsed once with ``from_json``; everything
downstream works on ``array<double>`` columns and should be stored as Parquet.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAW_SCHEMA = T.StructType([
    T.StructField("trajectory_id", T.StringType()),
    T.StructField("path_lat", T.StringType()),
    T.StructField("path_lon", T.StringType()),
    T.StructField("dest_lat", T.StringType()),
    T.StructField("dest_lon", T.StringType()),
])
SUBMISSION_SCHEMA = T.StructType([
    T.StructField("trajectory_id", T.StringType()),
    T.StructField("latitude_pred", T.DoubleType()),
    T.StructField("longitude_pred", T.DoubleType()),
])
SUBMISSION_COLUMNS = ["trajectory_id", "latitude_pred", "longitude_pred"]


def parse_path(text) -> Column:
    """List text -> ``array<double>``; anything unparseable -> ``[]`` (S3).

    Accepts ``[..]`` and tuple text ``(..)`` (also with a trailing comma), as a Python
    literal parser would. A list holding a non-number (``null``, ``NaN``) is rejected
    as a whole, like the literal parser does.
    """
    c = F.col(text) if isinstance(text, str) else text
    t = F.trim(F.translate(c.cast("string"), "()", "[]"))
    t = F.regexp_replace(t, r",\s*\]$", "]")
    arr = F.from_json(t, T.ArrayType(T.DoubleType()), {"allowNonNumericNumbers": "false"})
    ok = arr.isNotNull() & ~F.exists(arr, lambda x: x.isNull())
    return F.when(ok, arr).otherwise(F.array().cast("array<double>"))


def parse_trajectories(df: DataFrame) -> DataFrame:
    """Parse ``path_lat`` / ``path_lon`` text columns in place when they are strings."""
    out = df
    for c in ("path_lat", "path_lon"):
        if c in df.columns and isinstance(df.schema[c].dataType, T.StringType):
            out = out.withColumn(c, parse_path(c))
    return out


def _read_raw_csv(spark: SparkSession, path: str, split: str) -> DataFrame:
    """Text columns of a train or test CSV with the place of each row: file, block and row number."""
    header = spark.read.option("header", True).csv(path).columns
    fields = [f for f in RAW_SCHEMA.fields if f.name in header]
    df = (spark.read.schema(T.StructType(fields)).option("header", True).option("quote", '"')
          .option("escape", '"').option("mode", "PERMISSIVE").csv(path))
    df = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"))
    for c in ("dest_lat", "dest_lon"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    return df.withColumn("split", F.lit(split)).withColumn("_row", F.monotonically_increasing_id())


def _in_source_order(raw: DataFrame) -> DataFrame:
    """Dense ``ingest_seq`` by (train before test, file name, position): Spark reads larger files first, so
    the scan's own numbering doesn't follow file order. Row numbers rise inside a block, so one row for each
    (file, block) with its count gives the offsets; that table has as many rows as the input has splits."""
    place = ["split", "_file", "_block"]
    blocks = raw.groupBy(*place).agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(F.col("split").desc(), "_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(*place, "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    seq = F.col("_offset") + F.col("_row") - F.col("_first")
    return parse_trajectories(raw.join(offsets, place).withColumn("ingest_seq", seq).drop("_file", "_block", "_row", "_first", "_offset"))


def read_trajectory_csv(spark: SparkSession, path: str, split: str) -> DataFrame:
    """Read a train or test CSV with header (S1). Test files have no ``dest_*`` columns.

    ``ingest_seq`` numbers the rows from 0 by file name and position in the file, which gives "first
    occurrence" rules (C2) the same meaning for every layout of files and splits.
    """
    return _in_source_order(_read_raw_csv(spark, path, split))


def load_data(spark: SparkSession, train_path: str, test_path: str) -> DataFrame:
    """Train and test as one frame with a ``split`` column (S1); test rows are numbered after train rows."""
    return _in_source_order(_read_raw_csv(spark, train_path, "train").unionByName(_read_raw_csv(spark, test_path, "test")))


def read_optional_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """Read a CSV only if it exists (S2); None otherwise."""
    r = spark.read.option("header", True)
    r = r.schema(schema) if schema is not None else r
    try:
        return r.csv(path)  # resolves the path
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def save_trajectories_csv(df: DataFrame, path: str) -> None:
    """Write trajectories as CSV with paths re-encoded as list text."""
    out = df
    for c in ("path_lat", "path_lon"):
        if c in df.columns and not isinstance(df.schema[c].dataType, T.StringType):
            out = out.withColumn(c, F.to_json(c))
    out.write.mode("overwrite").option("header", True).csv(path)


def submission_path(base_dir: str, model_name: str, when: _dt.datetime | None = None) -> str:
    when = when or _dt.datetime.now()
    return f"{base_dir.rstrip('/')}/submission_{model_name}_{when.strftime('%Y%m%d_%H%M%S')}.csv"


def write_submission(pred: DataFrame, base_dir: str, model_name: str, when: _dt.datetime | None = None) -> str:
    """Write ``trajectory_id, latitude_pred, longitude_pred`` as CSV with header.

    The output is a directory named like the reference's file; its part files together
    are one submission.
    """
    path = submission_path(base_dir, model_name, when)
    pred.select(*SUBMISSION_COLUMNS).write.mode("overwrite").option("header", True).csv(path)
    return path


def latest_submission(spark: SparkSession, pattern: str) -> DataFrame:
    """Rows of the newest submission among the paths matching ``pattern``.

    A Spark-written submission is a directory of part files. The newest path (by modification time, then by
    name) is chosen from the file listing, and only that one is read.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    if not found:
        raise FileNotFoundError(pattern)
    newest = max(found, key=lambda s: (s.getModificationTime(), s.getPath().toString()))
    return spark.read.schema(SUBMISSION_SCHEMA).option("header", True).csv(newest.getPath().toString()).select(*SUBMISSION_COLUMNS)


def save_trajectory_table(df: DataFrame, table: str, buckets: int, path: str | None = None) -> None:
    """Store parsed trajectories bucketed and sorted by ``trajectory_id``.

    Every per-trajectory step (the feature aggregate, dedup by id, joins on id) then reads
    the data already clustered by its key, so those plans need no exchange.
    """
    w = df.write.mode("overwrite").format("parquet").bucketBy(buckets, "trajectory_id").sortBy("trajectory_id")
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)
