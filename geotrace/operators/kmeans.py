"""Lloyd iterations of many K-means runs at once (K3, K4).

All restarts of all k keep their centres in one broadcast, and one aggregate an iteration sums the rows of every
cluster of every run that still moves, so the jobs count the longest run's iterations, not the runs. The first
centres are drawn as in k-means++, again for all runs together: each step draws a row with probability in
proportion to its squared distance from the run's centres, as the least of ``-ln(u) / distance`` over hashed u,
which is one more aggregate and needs no row on the driver but the centres.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Distances computed at once in a task.
BLOCK = 1 << 22
#: Distances whose running sums are held at once.
CACHED = 1 << 13
#: Bound of the error of a distance by products, times the squares of both vectors (some 2**-48 for 13 coordinates).
PRODUCT_ERROR = 2.0 ** -40


@dataclass
class Run:
    """One K-means run: its number of clusters, seed, centres and the cost of the last assignment."""

    k: int
    seed: int
    centres: np.ndarray
    cost: float = float("inf")
    moving: bool = True


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _distances(X: np.ndarray, C: np.ndarray) -> np.ndarray:
    """Squared distances, from the differences themselves (no cancellation).

    Coordinate by coordinate over a few rows, whose sums stay in the cache. Eight running sums are added up in pairs, as in
    numpy's sum along a row, so that costs keep their last digits."""
    out = np.empty((len(X), len(C)))
    columns, width = np.ascontiguousarray(C.T), C.shape[1]
    whole = width - width % 8 
    step = max(1, CACHED // max(1, len(C)))
    for at in range(0, len(X), step):
        x = X[at:at + step]

        def square(j, x=x):
            gap = x[:, j][:, None] - columns[j]
            gap *= gap
            return gap

        run = [square(j) for j in range(min(8, whole))]
        for j in range(8, whole):
            run[j % 8] += square(j)
        while len(run) > 1:
            run = [np.add(a, b, out=a) for a, b in zip(run[::2], run[1::2])]
        total = run[0] if run else np.zeros((len(x), len(C)))
        for j in range(whole, width):
            total += square(j)
        out[at:at + step] = total
    return out


def _nearest(X: np.ndarray, runs: list[np.ndarray]) -> list[np.ndarray]:
    """Index of each row's nearest centre in each run (ties: the lowest), as by :func:`_distances`.

    Matrix products with an error bound leave the few rows whose distances are compared from the differences themselves."""
    C = np.concatenate(runs)
    cc = (C * C).sum(axis=1)
    with np.errstate(over="ignore", invalid="ignore"):
        far = cc[:, None] - 2.0 * (C @ X.T)
        slack = PRODUCT_ERROR * ((X * X).sum(axis=1) + cc.max())
    if not (np.isfinite(slack).all() and np.isfinite(far).all()):
        return [_distances(X, c).argmin(axis=1) for c in runs]
    out, at = [], 0
    for c in runs:
        d = far[at:at + len(c)]
        at += len(c)
        own = d.argmin(axis=0)
        close = np.flatnonzero((d <= d.min(axis=0) + slack).sum(axis=0) > 1)
        if len(close):
            own[close] = _distances(X[close], c).argmin(axis=1)
        out.append(own)
    return out


def _blocks(batches, centres: int, x_at: int):
    for b in batches:
        if b.num_rows:
            X = _matrix(b.column(x_at))
            step = max(1, BLOCK // max(1, centres * X.shape[1]))
            for at in range(0, len(X), step):
                yield b.slice(at, step), X[at:at + step]


def first_centres(rows: DataFrame, runs: list[tuple[int, int]]) -> list[Run]:
    """k-means++ centres of each (k, seed); ``rows`` has (id long, x array<double>), ids are hashes of the rows' keys.

    With fewer distinct rows than k a run has as many centres as there are distinct rows."""
    from geotrace.operators.trees import key_of, uniform

    spark, found = rows.sparkSession, [Run(k, seed, np.zeros((0, 0))) for k, seed in runs]
    for step in range(max((k for k, _ in runs), default=0)):
        todo = [i for i, r in enumerate(found) if len(r.centres) == step and r.k > step]
        if not todo:
            break
        given = spark.sparkContext.broadcast([(i, found[i].seed, found[i].centres) for i in todo])

        def race(batches, step=step, given=given):
            best: dict[int, tuple] = {}
            for b, X in _blocks(batches, max(1, sum(len(c) for _, _, c in given.value)), 1):
                ids = b.column(0).to_numpy().view(np.uint64)
                for i, seed, centres in given.value:
                    weight = _distances(X, centres).min(axis=1) if len(centres) else np.ones(len(X))
                    u = uniform(key_of(seed, 7, step), ids)
                    with np.errstate(divide="ignore"):
                        key = np.where(weight > 0, -np.log1p(-u) / weight, np.inf)
                    at = int(key.argmin())
                    if key[at] < np.inf and (i not in best or (key[at], int(ids[at])) < best[i][:2]):
                        best[i] = float(key[at]), int(ids[at]), X[at].tolist()
            yield pa.table({"run": pa.array(list(best), pa.int32()), "key": pa.array([v[0] for v in best.values()], pa.float64()),
                            "x": pa.array([v[2] for v in best.values()], pa.list_(pa.float64()))}).to_batches(max_chunksize=1 << 20)[0] if best else \
                pa.RecordBatch.from_arrays([pa.array([], pa.int32()), pa.array([], pa.float64()), pa.array([], pa.list_(pa.float64()))], names=["run", "key", "x"])

        drawn = rows.select("id", "x").mapInArrow(race, "run int, key double, x array<double>")
        for r in drawn.groupBy("run").agg(F.min(F.struct("key", "x")).alias("b")).collect():  # one row a run
            run = found[r["run"]]
            run.centres = np.array([*run.centres.tolist(), r["b"]["x"]], float)
    return found


def lloyd(rows: DataFrame, runs: list[Run], max_iter: int = 300, tol: float = 1e-4) -> list[Run]:
    """Iterate all ``runs`` until their centres move by ``tol`` times the mean variance at most, or ``max_iter`` times.

    Empty clusters keep their centres. Ties go to the lower cluster. ``cost`` is that of the centres returned
    (one more assignment).
    """
    spark = rows.sparkSession
    width = max((r.centres.shape[1] for r in runs if len(r.centres)), default=0)
    stats = rows.agg(F.count("*"), *[F.var_pop(F.col("x")[i]) for i in range(width)]).first()
    still = tol * float(np.mean([v or 0.0 for v in stats[1:]] or [0.0]))
    for r in runs:
        r.moving = bool(len(r.centres)) and max_iter > 0
    for _ in range(max_iter):
        todo = [i for i, r in enumerate(runs) if r.moving]
        if not todo:
            break
        for i, (count, total, _) in _sums(spark, rows, runs, todo, False).items():
            r = runs[i]
            new = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], r.centres)
            r.moving = float(((new - r.centres) ** 2).sum()) > still
            r.centres = new
    placed = [i for i, r in enumerate(runs) if len(r.centres)]
    for i, (_, _, cost) in (_sums(spark, rows, runs, placed) if placed else {}).items():
        runs[i].cost = cost
    return runs


def _sums(spark, rows: DataFrame, runs: list[Run], todo: list[int], costs: bool = True) -> dict[int, tuple]:
    """(count, sums, cost) by cluster of each run in ``todo``: one aggregate. Without ``costs`` they are 0."""
    given = spark.sparkContext.broadcast([(i, runs[i].centres) for i in todo])

    def part(batches):
        total: dict[int, list] = {}
        for _, X in _blocks(batches, sum(len(c) for _, c in given.value), 0):
            if costs:
                every, at, owns = _distances(X, np.concatenate([c for _, c in given.value])), 0, []
                for _, c in given.value:
                    owns.append(every[:, at:at + len(c)].argmin(axis=1))
                    at += len(c)
            else:
                owns = _nearest(X, [c for _, c in given.value])
            at = 0
            for (i, c), own in zip(given.value, owns):
                one = np.zeros((len(X), len(c)))
                one[np.arange(len(X)), own] = 1.0
                s = total.setdefault(i, [np.zeros(len(c)), np.zeros(c.shape), 0.0])
                s[0] += one.sum(axis=0)
                s[1] += one.T @ X
                s[2] += float(every[np.arange(len(X)), at + own].sum()) if costs else 0.0
                at += len(c)
        out = [(i, j, float(n[j]), s[j].tolist(), cost if j == 0 else 0.0) for i, (n, s, cost) in total.items() for j in range(len(n))]
        cols = list(zip(*out)) if out else [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.float64()),
                                          pa.array(cols[3], pa.list_(pa.float64())), pa.array(cols[4], pa.float64())], names=["run", "cluster", "n", "s", "cost"])

    d = runs[todo[0]].centres.shape[1]
    added = rows.select("x").mapInArrow(part, "run int, cluster int, n double, s array<double>, cost double")
    got = added.groupBy("run", "cluster").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("s")[i]) for i in range(d)]).alias("s"), F.sum("cost").alias("cost")).collect()
    out = {i: (np.zeros(len(runs[i].centres)), np.zeros(runs[i].centres.shape), 0.0) for i in todo}
    for r in got:  # one row a cluster
        n, s, cost = out[r["run"]]
        n[r["cluster"]], s[r["cluster"]] = r["n"], r["s"]
        out[r["run"]] = n, s, cost + r["cost"]
    return out


def assigned(df: DataFrame, x, runs: dict[str, np.ndarray]) -> DataFrame:
    """``df`` with a column of the nearest centre's index for each name in ``runs``; ``x`` is an array column."""
    given = df.sparkSession.sparkContext.broadcast(list(runs.values()))

    def nearest(v):
        import pandas as pd
        X = np.stack(v.to_numpy()) if len(v) else np.zeros((0, 1))
        cols = [_distances(X, c).argmin(axis=1) if len(X) else np.zeros(0, int) for c in given.value]
        return pd.Series(list(np.stack(cols, 1).astype(np.int32)) if len(X) else [])

    out = df.withColumn("_near", F.pandas_udf(nearest, T.ArrayType(T.IntegerType()))(x))
    return out.withColumns({c: F.col("_near")[i] for i, c in enumerate(runs)}).drop("_near")
