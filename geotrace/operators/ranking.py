"""Exact global rank without a single-task window.

``row_number()`` over an un-partitioned window, or ``orderBy(...).limit(k)`` with a
large ``k``, funnel every row through one task. Instead we range-sort (distributed),
checkpoint the sorted rows to the shared checkpoint folder so that both passes below
see identical partitions, count rows per partition (one row per partition), and turn
the counts into offsets. The offsets table has one row per partition, a size fixed by
configuration, so broadcasting it is safe.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geotrace.session import ensure_checkpoint_dir


def global_rank(df: DataFrame, order: list[Column | str], name: str = "rank") -> DataFrame:
    """Add ``name``: 0-based position of each row in ``ORDER BY order`` (order must be total)."""
    ensure_checkpoint_dir(df.sparkSession)
    s = (df.orderBy(*order)
         .withColumn("_pid", F.spark_partition_id())
         .withColumn("_mid", F.monotonically_increasing_id())
         .checkpoint(eager=True))
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_c"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_c").over(w), F.lit(0)).alias("_off"))
    base = F.col("_pid").cast("long") * F.lit(1 << 33)
    return (s.join(F.broadcast(offsets), "_pid")
            .withColumn(name, F.col("_off") + F.col("_mid") - base)
            .drop("_pid", "_mid", "_off"))
