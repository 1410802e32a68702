"""Spark session helpers.

Library code never creates a session of its own; callers pass one in. These helpers
exist for tests, the bench and command-line use.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The 96-column per-trajectory feature projection is too wide for one generated
    # method; skipping codegen for stages with >= 90 fields avoids a failing compile
    # attempt (~1 s per query). The per-point stages (~40 fields) keep whole-stage codegen.
    "spark.sql.codegen.maxFields": "90",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "8g", app: str = "geotrace") -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", driver_memory))
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting names a shared folder and is used as is; without it a cluster
    session raises, because a machine-local folder would lose checkpoints with its machine.
    Only a local master (tests) gets a scratch folder of its own. The folder is set once a
    session, not on every use.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="geotrace-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", path)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(path)
    return path


def stored(df: DataFrame, row_group: int | None = None) -> DataFrame:
    """``df`` written once as Parquet under the checkpoint folder and read back.

    Later scans read only the columns they need, know the size, and never derive the rows again. Tables with large
    values need row groups of about ``row_group`` bytes: a reader holds a whole one.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/table-{uuid.uuid4().hex}"
    small = {"parquet.block.size": row_group, "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 100} if row_group else {}
    df.write.options(**small).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
