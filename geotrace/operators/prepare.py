"""Preparation for training (M1-M5).

All statistics (distinct counts, deviations, quantiles, correlations) come from one
aggregate row per step, fitted on train and applied to train and test as column
expressions. Distinct counts and quantiles are exact at every size (see quantiles.py).
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geotrace.functions import geo
from geotrace.operators.quantiles import ValueCounts, quantiles

# Fixed values of the reference's preparation rules.
QUASI_CONSTANT_SHARE = 0.02
MIN_STD = 1e-8
MIN_K = 50
K_SHARE = 0.7


def low_variance_stats(train: DataFrame, cols: list[str], counts: ValueCounts | None = None) -> DataFrame:
    """M1 statistics, long form: ``feature, n_unique, std, dropped``.

    Distinct counts come from the long (column, value) counts (``counts``, if they are there already), so no row is copied once a column."""
    row = train.agg(F.count(F.lit(1)).alias("_n"), *[F.stddev_samp(c).alias(f"s_{c}") for c in cols]).first()
    unique = (counts or ValueCounts(train, cols)).distinct()
    n = row["_n"]
    rows = []
    for c in cols:
        u, s = unique[c], row[f"s_{c}"]
        dropped = u <= 1 or (u / max(1, n)) < QUASI_CONSTANT_SHARE or (s is not None and s <= MIN_STD)
        rows.append((c, int(u), s, bool(dropped)))
    return train.sparkSession.createDataFrame(rows, "feature string, n_unique long, std double, dropped boolean")


def drop_low_variance(train: DataFrame, cols: list[str], counts: ValueCounts | None = None) -> list[str]:
    """M1: names of the columns to keep."""
    stats = low_variance_stats(train, cols, counts)
    dropped = {r["feature"] for r in stats.where("dropped").collect()}
    return [c for c in cols if c not in dropped]


def local_target(df: DataFrame, ref_lat: str = "start_lat", ref_lon: str = "start_lon") -> DataFrame:
    """M2: (dx, dy) metres of the destination from the path start; NULL target -> (0, 0)."""
    dx, dy = geo.to_local_xy(F.col(ref_lat), F.col(ref_lon), F.col("dest_lat"), F.col("dest_lon"))
    has = F.col("dest_lat").isNotNull() & F.col("dest_lon").isNotNull()
    return (df.withColumn("dx", F.when(has, dx).otherwise(F.lit(0.0)))
            .withColumn("dy", F.when(has, dy).otherwise(F.lit(0.0))))


@dataclass
class Scaler:
    """Fitted per-column centre and scale; ``transform`` is pure column algebra."""
    kind: str
    centre: dict[str, float] = field(default_factory=dict)
    scale: dict[str, float] = field(default_factory=dict)

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        return df.withColumns({c + suffix: (F.col(c) - F.lit(self.centre[c])) / F.lit(self.scale[c]) for c in self.centre})


def fit_scaler(train: DataFrame, cols: list[str], kind: str = "robust", counts: ValueCounts | None = None) -> Scaler:
    """M3: robust ``(x - median) / IQR`` or standard ``(x - mean) / sigma_pop``; zero scale -> 1. ``counts`` may be of more columns."""
    if kind == "robust":
        row = counts.quantiles([0.25, 0.5, 0.75]) if counts else quantiles(train, cols, [0.25, 0.5, 0.75])
        centre = {c: row[c][1] if row[c] else None for c in cols}
        scale = {c: row[c][2] - row[c][0] if row[c] else None for c in cols}
    elif kind == "standard":
        row = train.agg(*[F.avg(c).alias(f"m_{c}") for c in cols],
                        *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]).first()
        centre = {c: row[f"m_{c}"] for c in cols}
        scale = {c: row[f"s_{c}"] for c in cols}
    else:
        raise ValueError(f"unknown scaler {kind!r}")
    scale = {c: (1.0 if (v is None or v == 0) else v) for c, v in scale.items()}
    centre = {c: (0.0 if v is None else v) for c, v in centre.items()}
    return Scaler(kind, centre, scale)


def correlations(df: DataFrame, cols: list[str], target: str) -> tuple[int, list[float | None]]:
    """Rows, and Pearson's r of each column with ``target`` (None without variance), by the running sums of Spark's ``corr``:
    rows update all columns at once, and the partitions' sums are merged in their order."""
    src = df.select(F.array(*[F.col(c).cast("double") for c in cols]).alias("x"), F.col(target).cast("double").alias("y"))

    def sums(batches):
        rows, s = 0, np.zeros((6, len(cols)))  # n, means, co-moment, moments
        for b in batches:
            flat = b.column(0).flatten()
            X, given = flat.to_numpy(zero_copy_only=False).astype(float).reshape(b.num_rows, -1), ~np.asarray(flat.is_null()).astype(bool).reshape(b.num_rows, -1)
            Y, on = b.column(1).to_numpy(zero_copy_only=False).astype(float), ~np.asarray(b.column(1).is_null()).astype(bool)
            rows += b.num_rows
            for i in range(b.num_rows):
                if not on[i]:
                    continue
                whole = given[i].all()
                n, mx, my, ck, xk, yk = old = s
                n = n + 1.0
                dx, dy = X[i] - mx, Y[i] - my
                mx, my = mx + dx / n, my + dy / n
                rest = Y[i] - my
                new = np.stack([n, mx, my, ck + dx * rest, xk + dx * (X[i] - mx), yk + dy * rest])
                s = new if whole else np.where(given[i], new, old)
        yield pa.RecordBatch.from_arrays([pa.array([rows], pa.int64()), pa.array([s.tobytes()], pa.binary())], names=["n", "s"])

    parts = src.mapInArrow(sums, "n long, s binary").withColumn("part", F.spark_partition_id())
    rows, total = 0, np.zeros((6, len(cols)))
    with np.errstate(all="ignore"):
        for r in sorted(parts.collect(), key=lambda r: r["part"]):  # 6 numbers a column and partition
            n, mx, my, ck, xk, yk = np.frombuffer(r["s"]).reshape(6, -1)
            m, ax, ay, ak, bx, by = total
            every = m + n
            dx, dy = mx - ax, my - ay
            dxn, dyn = np.where(every == 0, 0.0, dx / every), np.where(every == 0, 0.0, dy / every)
            total = np.stack([every, ax + dxn * n, ay + dyn * n, ak + ck + dx * dyn * m * n, bx + xk + dx * dxn * m * n, by + yk + dy * dyn * m * n])
            rows += r["n"]
        n, _, _, ck, xk, yk = total
        scale = np.sqrt(xk * yk)
    return rows, [None if n[i] < 2 or scale[i] == 0 else float(ck[i] / scale[i]) for i in range(len(cols))]


def f_scores(train: DataFrame, cols: list[str], target: str = "dx") -> DataFrame:
    """M4 statistics: univariate regression F = r^2 / (1 - r^2) * (n - 2) per column, with rank.

    Rank orders by F descending (NULL last), then by column position.
    """
    n, found = correlations(train, cols, target)
    rows = []
    for i, c in enumerate(cols):
        r = found[i]
        if r is None or r != r:
            f = None
        elif abs(r) >= 1.0:
            f = float("inf")
        else:
            f = r * r / (1 - r * r) * (n - 2)
        rows.append((c, i, f))
    order = sorted(rows, key=lambda x: (x[2] is None, -(x[2] or 0.0), x[1]))
    ranked = [(c, f, rank) for rank, (c, i, f) in enumerate(order, 1)]
    return train.sparkSession.createDataFrame(ranked, "feature string, f_score double, rank int")


def select_k_best(train: DataFrame, cols: list[str], target: str = "dx") -> list[str]:
    """M4: keep ``min(p, max(50, int(0.7 p)))`` columns with the highest F (original order kept)."""
    k = min(len(cols), max(MIN_K, int(K_SHARE * len(cols))))
    top = {r["feature"] for r in f_scores(train, cols, target).where(F.col("rank") <= k).collect()}
    return [c for c in cols if c in top]


@dataclass
class Prepared:
    """M5: design matrices as DataFrames with a ``features`` vector, and their metadata."""
    train: DataFrame
    test: DataFrame
    feature_names: list[str]
    scaler: Scaler
    target_cols: tuple[str, str]
    group_col: str = "trajectory_id"


def prepare(train: DataFrame, test: DataFrame, cols: list[str], use_local_target: bool = True,
            scaler: str = "robust", select: bool = True) -> Prepared:
    """M1-M5 in the reference's order: low-variance drop, targets, scaling, K-best, assemble."""
    counts = ValueCounts(train, cols)
    keep = drop_low_variance(train, cols, counts)
    if use_local_target:
        train = local_target(train)
        targets = ("dx", "dy")
    else:
        targets = ("dest_lat", "dest_lon")
    sc = fit_scaler(train, keep, scaler, counts)
    tr, te = sc.transform(train, "_s"), sc.transform(test, "_s")
    names = keep
    if select:
        names = select_k_best(tr.select(*[F.col(c + "_s").alias(c) for c in keep], targets[0]), keep, targets[0])
    va = VectorAssembler(inputCols=[c + "_s" for c in names], outputCol="features", handleInvalid="keep")
    return Prepared(va.transform(tr), va.transform(te), names, sc, targets)
