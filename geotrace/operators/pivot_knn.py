"""Exact k nearest neighbours above two dimensions by a pivot-partitioned join.

Reference rows go to the cell of their nearest pivot (a hashed sample of reference rows). A query first visits
its nearest cells until those hold ``k`` rows, which bounds its k-th distance by ``theta``. Then it visits
just the other cells that the bound reaches (or all rows in blocks, if those cells hold a quarter of all pairs): a row s of cell j has
``d(q, s) >= d(q, p_j) - radius_j``, ``d(q, s) >= inner_j - d(q, p_j)`` and, as s is no nearer to the query's own pivot p,
``d(q, s) >= (d(q, p_j)^2 - d(q, p)^2) / (2 d(p, p_j))``. Only queries are copied, to the cells they visit.
Cells above ``block_rows`` are cut into blocks on both sides, so no task holds more than a block of each.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geotrace.operators.knn import BLOCK_ROWS, _top_k_kernel, knn_candidates
from geotrace.session import stored

MAX_PIVOTS = 256
SLACK = 1e-9
#: Share of all pairs beyond which cells spare less than the copies of queries cost.
MOST_REACHED = 0.25


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _distances(X: np.ndarray, P: np.ndarray) -> np.ndarray:
    out = np.zeros((len(X), len(P)))
    for j in range(X.shape[1]):
        out += (X[:, j][:, None] - P[None, :, j]) ** 2
    return np.sqrt(out)


def _in_cells(df: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``df`` with the nearest pivot's index (ties: the lowest) and the distance to it."""
    at = df.columns.index("vec")
    given = df.sparkSession.sparkContext.broadcast(pivots)

    def add(batches):
        for b in batches:
            d = _distances(_matrix(b.column(at)), given.value) if b.num_rows else np.zeros((0, 1))
            cell = d.argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell.astype(np.int32)), pa.array(d[np.arange(len(d)), cell])],
                                             names=[*b.schema.names, "cell", "far"])

    return df.mapInArrow(add, T.StructType([*df.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("far", T.DoubleType())]))


def _visits(q: DataFrame, pivots: np.ndarray, cells: dict[str, np.ndarray], k: int, bounded: bool, counted: bool = False) -> DataFrame:
    """(qid, vec, cell): the nearest cells that hold ``k`` rows together, or else all others that ``theta`` reaches.

    ``counted``: instead of the visits, ``met``, the pairs of queries and references that meet in them."""
    names = q.columns
    vec_at, theta_at = names.index("vec"), names.index("theta") if bounded else -1
    between = _distances(pivots, pivots)
    given = q.sparkSession.sparkContext.broadcast((pivots, cells, between))

    def visit(batches):
        pivots, cells, between = given.value
        for whole in batches:
            for lo in range(0, whole.num_rows, 512):
                b = whole.slice(lo, 512)
                d = _distances(_matrix(b.column(vec_at)), pivots)
                order = np.argsort(d, axis=1, kind="stable")
                held = np.cumsum(cells["n"][order], axis=1)
                first = np.zeros(d.shape, bool)
                np.put_along_axis(first, order, held - cells["n"][order] < k, axis=1)
                go = first
                if bounded:
                    theta = b.column(theta_at).to_numpy()[:, None] * (1 + SLACK) + 1e-300
                    own = order[:, 0]
                    near = np.take_along_axis(d, own[:, None], 1)
                    apart = between[own]
                    plane = np.where(apart > 0, (d * d - near * near) / (2 * np.where(apart > 0, apart, 1.0)), 0.0)
                    scale = SLACK * (d + near)
                    go = ~first & (d - cells["radius"] <= theta + scale) & (cells["inner"] - d <= theta + scale) & (plane <= theta + scale)
                row, cell = np.nonzero(go & (cells["n"] > 0))
                if counted:
                    yield pa.RecordBatch.from_arrays([pa.array([int(cells["n"][cell].sum())])], names=["met"])
                    continue
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays([b.column(names.index("qid")).take(take), b.column(vec_at).take(take), pa.array(cell.astype(np.int32))],
                                                 names=["qid", "vec", "cell"])

    if counted:
        return q.mapInArrow(visit, "met long")
    return q.mapInArrow(visit, T.StructType([q.schema["qid"], q.schema["vec"], T.StructField("cell", T.IntegerType())]))


def _met(visits: DataFrame, r: DataFrame, cells: dict[str, np.ndarray], k: int, labels: list[str], block_rows: int) -> DataFrame:
    """At most ``k`` candidates of each visit and block of references."""
    spark = r.sparkSession
    asked = {x["cell"]: x["n"] for x in visits.groupBy("cell").agg(F.count("*").alias("n")).collect()}  # at most MAX_PIVOTS rows
    rows = [(c, math.ceil(int(cells["n"][c]) / block_rows), math.ceil(n / block_rows)) for c, n in asked.items()]
    blocks = F.broadcast(spark.createDataFrame(rows, "cell int, nr int, nq int"))
    of = lambda side, key, c: F.pmod(F.xxhash64(F.lit(side), F.col(key)), F.col(c)).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    qv = visits.join(blocks, "cell").withColumn("qb", of("q", "qid", "nq")).withColumn("rb", every("nr")).drop("nr", "nq")
    rv = r.drop("far").join(blocks, "cell").withColumn("rb", of("r", "rid", "nr")).withColumn("qb", every("nq")).drop("nr", "nq")
    schema = "qid string, rid string, d2 double, " + ", ".join(f"{c} double" for c in labels)
    key = ["cell", "qb", "rb"]
    return qv.groupBy(*key).cogroup(rv.groupBy(*key)).applyInPandas(_top_k_kernel(k, labels), schema)


def pivot_knn_candidates(query: DataFrame, ref: DataFrame, k: int, q_id: str = "qid", r_id: str = "rid", vec: str = "vec",
                         label_cols: tuple[str, ...] = ("y",), block_rows: int = BLOCK_ROWS, pivots: int | None = None,
                         report: dict | None = None) -> DataFrame:
    """Best ``k`` neighbours per query: ``qid, rid, d2, <labels>, rank`` (rank 1 = nearest, ties by id).

    ``report`` gets ``visited`` (pairs of queries and references that met in a cell) and ``pairs`` (all of them).
    Without references there are no rows; with fewer than ``k``, all of them are neighbours.
    """
    labels = list(label_cols)
    r = stored(ref.select(F.col(r_id).cast("string").alias("rid"), F.col(vec).alias("vec"), *[F.col(c).cast("double").alias(c) for c in labels]))
    q = stored(query.select(F.col(q_id).cast("string").alias("qid"), F.col(vec).alias("vec")))
    n_ref, n_query = r.count(), q.count()
    if report is not None:
        report |= {"visited": 0, "pairs": n_ref * n_query}
    if not n_ref or not n_query:
        rank = F.lit(0).cast("int").alias("rank")
        return q.join(r.drop("vec"), F.lit(False)).select("qid", "rid", F.lit(0.0).alias("d2"), *labels, rank)
    m = pivots or min(MAX_PIVOTS, math.ceil(math.sqrt(n_ref)))
    drawn = r.select("vec", F.xxhash64(F.lit("pivot"), "rid").alias("h"), "rid").orderBy("h", "rid").limit(m).collect()
    P = np.unique(np.array([x["vec"] for x in drawn], float), axis=0)
    r = stored(_in_cells(r, P))
    cells = {"n": np.zeros(len(P), np.int64), "radius": np.zeros(len(P)), "inner": np.zeros(len(P))}
    for x in r.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("radius"), F.min("far").alias("inner")).collect():
        for c in cells:
            cells[c][x["cell"]] = x[c]
    best = Window.partitionBy("qid").orderBy("d2", "rid")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    visits = stored(_visits(q, P, cells, k, False))
    near = stored(ranked(_met(visits, r, cells, k, labels, block_rows)))
    theta = near.groupBy("qid").agg(F.sqrt(F.max("d2")).alias("theta"))
    bounded = q.join(theta, "qid").select("qid", "vec", "theta")
    reached = _visits(bounded, P, cells, k, True, True).agg(F.sum("met")).first()[0] or 0
    if reached > n_ref * n_query * MOST_REACHED:
        if report is not None:
            report["visited"] = n_ref * n_query
        return knn_candidates(q, r.drop("cell", "far"), k, "qid", "rid", "vec", tuple(labels), block_rows)
    more = stored(_visits(bounded, P, cells, k, True))
    if report is not None:
        counts = visits.union(more).groupBy("cell").count().collect()
        report["visited"] = sum(int(cells["n"][x["cell"]]) * x["count"] for x in counts)
    return ranked(near.drop("rank").unionByName(_met(more, r, cells, k, labels, block_rows)))
