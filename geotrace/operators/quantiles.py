"""Exact quantiles and distinct counts of many columns at every size, without one task that holds all values.

The columns are brought into long form ``(column, value)`` and counted (partially aggregated, so repeated
values collapse map-side), range-partitioned by (column, value) and written once. Counts by (partition,
column) give each partition the rank at which it begins; only the rows whose rank interval holds one of the
wanted ranks come back to the driver: at most two for each column and probability.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geotrace.session import ensure_checkpoint_dir, stored


class ValueCounts:
    """Distinct values of some columns with their counts, ordered over partitions. Nulls are left out.

    ``partitions`` overrides the number of range partitions (tests use many tiny ones).
    """

    def __init__(self, df: DataFrame, cols: list[str], partitions: int | None = None):
        ensure_checkpoint_dir(df.sparkSession)
        self.cols = list(cols)
        values = F.array(*[F.col(c).cast("double") for c in self.cols])
        long = df.select(F.posexplode(values).alias("col", "value")).where(F.col("value").isNotNull())
        counted = stored(long.groupBy("col", "value").agg(F.count(F.lit(1)).alias("n")))  # the range cuts sample it
        by = [F.col("col"), F.col("value")]
        ranged = counted.repartitionByRange(partitions, *by) if partitions else counted.repartitionByRange(*by)
        self.table = ranged.withColumn("part", F.spark_partition_id()).checkpoint()
        self.parts = self.table.groupBy("part", "col").agg(F.sum("n").alias("n"))

    def distinct(self) -> dict[str, int]:
        """Number of distinct values of each column (0 for a column of nulls)."""
        found = {r["col"]: r["n"] for r in self.table.groupBy("col").agg(F.count(F.lit(1)).alias("n")).collect()}
        return {c: found.get(i, 0) for i, c in enumerate(self.cols)}

    def quantiles(self, probs: list[float]) -> dict[str, list[float] | None]:
        """Linearly interpolated quantiles (rank ``p * (n - 1)``); None for a column without values."""
        totals = {r["col"]: r["n"] for r in self.parts.groupBy("col").agg(F.sum("n").alias("n")).collect()}
        if not totals:
            return dict.fromkeys(self.cols)
        ranks = {i: sorted({r for p in probs for x in [p * (n - 1)] for r in (math.floor(x), math.ceil(x))})
                 for i, n in totals.items()}
        wanted = self.table.sparkSession.createDataFrame([(i, list(map(int, r))) for i, r in ranks.items()], "col int, ranks array<long>")
        before = Window.partitionBy("col").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        starts = self.parts.select("part", "col", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"), "n")
        # only partitions that hold a wanted rank are sorted and summed up
        holding = starts.join(wanted, "col").withColumn("ranks", F.filter("ranks", lambda r: (r >= F.col("start")) & (r < F.col("start") + F.col("n"))))
        holding = holding.where(F.size("ranks") > 0).select("part", "col", "start", "ranks")
        run = Window.partitionBy("part", "col").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        rows = self.table.join(holding, ["part", "col"]).withColumn("end", F.col("start") + F.sum("n").over(run))
        rows = rows.select("col", "value", F.explode(F.filter("ranks", lambda r: (r < F.col("end")) & (r >= F.col("end") - F.col("n")))).alias("rank"))
        at = {(r["col"], r["rank"]): r["value"] for r in rows.collect()}
        out: dict[str, list[float] | None] = {}
        for i, c in enumerate(self.cols):
            out[c] = [self._between(at, i, p * (totals[i] - 1)) for p in probs] if i in totals else None
        return out

    @staticmethod
    def _between(at: dict, col: int, x: float) -> float:
        low, high = math.floor(x), math.ceil(x)
        a, b = at[col, low], at[col, high]
        return a if low == high or a == b else (high - x) * a + (x - low) * b


def quantiles(df: DataFrame, cols: list[str], probs: list[float]) -> dict[str, list[float] | None]:
    """Exact quantiles of several columns; see :class:`ValueCounts`."""
    return ValueCounts(df, cols).quantiles(probs)
