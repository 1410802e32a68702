"""Exact k-nearest-neighbour regression by blocked search.

Queries and reference rows are hashed into ``Q`` and ``B`` blocks sized so that one
block of each fits comfortably in a task. Query rows are replicated ``B`` times and
reference rows ``Q`` times, so every (query block, reference block) pair meets in
exactly one ``cogroup`` group; inside it numpy computes the distances in chunks and
returns at most ``k`` candidates per query. A final ``groupBy(query)`` keeps the best
``k`` of at most ``k * B`` candidates. No group ever holds more than one block of
each side, and no pair rows are emitted. Ties are broken by reference id.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 20_000


def _block(id_col: str, n_blocks: int, salt: str):
    return F.pmod(F.xxhash64(F.lit(salt), F.col(id_col)), F.lit(n_blocks)).cast("int")


QUERIES_AT_ONCE = 256
GROUP = 64
PAIRS_AT_ONCE = 1 << 18


def _exact(q: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Squared distances of pairs, added up coordinate by coordinate."""
    d2 = np.zeros(len(q))
    for j in range(q.shape[1]):
        diff = q[:, j] - r[:, j]
        d2 += diff * diff
    return d2


def _near_pairs(qv: np.ndarray, rv: np.ndarray, rn: np.ndarray, mean: np.ndarray, kk: int):
    """Pairs (query, reference) that hold each query's ``kk`` smallest exact distances; None if norms overflow.

    A matrix product gives ``|r|^2 - 2 q r`` with an error below ``c (|q|^2 + |r|^2)``. The ``kk``-th smallest of group
    minima is no less than the ``kk``-th smallest of all, so pairs beyond it by more than the errors can be left out."""
    c = 8 * (qv.shape[1] + 16) * np.finfo(float).eps
    x = qv - mean
    qn = (x * x).sum(axis=1)
    if not np.isfinite(qn).all():
        return None
    high = (-2.0 * x) @ (rv - mean).T
    high += rn * (1 + c)
    n = high.shape[1]
    if n // GROUP >= kk:
        least = high[:, :n // GROUP * GROUP].reshape(len(x), -1, GROUP).min(axis=2)
    else:
        least = high
    reach = np.partition(least, kk - 1, axis=1)[:, kk - 1] + 2 * c * qn
    high -= 2 * c * rn
    return np.nonzero(high <= reach[:, None])


def _nearest(qv: np.ndarray, rv: np.ndarray, kk: int) -> tuple[np.ndarray, np.ndarray]:
    """Indexes and squared distances of the ``kk`` nearest rows of ``rv`` (ties: the first), for each query."""
    with np.errstate(over="ignore", invalid="ignore"):
        mean = rv.mean(axis=0)
        centred = rv - mean
        rn = (centred * centred).sum(axis=1)
        pairs = _near_pairs(qv, rv, rn, mean, kk) if np.isfinite(rn).all() else None
    if pairs is None:  # infinite or missing coordinates: every pair
        d2 = np.zeros((len(qv), len(rv)))
        for j in range(rv.shape[1]):
            diff = qv[:, j][:, None] - rv[None, :, j]
            d2 += diff * diff
        # stable sort on distance keeps the id order for ties
        idx = np.argsort(d2, axis=1, kind="stable")[:, :kk]
        return idx, np.take_along_axis(d2, idx, 1)
    row, col = pairs
    d2 = np.concatenate([_exact(qv[row[s:s + PAIRS_AT_ONCE]], rv[col[s:s + PAIRS_AT_ONCE]]) for s in range(0, len(row), PAIRS_AT_ONCE)])
    order = np.lexsort((col, d2, row))
    first = np.searchsorted(row, np.arange(len(qv)))  # rows ascend, before and after the sort
    at = order[(first[:, None] + np.arange(kk)).ravel()]
    return col[at].reshape(-1, kk), d2[at].reshape(-1, kk)


def _top_k_kernel(k: int, labels: list[str]):
    """numpy kernel for one (query block, reference block) group: at most k rows per query."""

    def top_k(qp: pd.DataFrame, rp: pd.DataFrame) -> pd.DataFrame:
        if qp.empty or rp.empty:
            return pd.DataFrame({"qid": pd.Series([], dtype=object), "rid": pd.Series([], dtype=object),
                                 **{c: pd.Series([], dtype="float64") for c in ["d2", *labels]}})
        rp = rp.sort_values("rid", kind="stable")
        rv = np.stack(rp["vec"].to_numpy()).astype(float)
        rids = rp["rid"].to_numpy()
        out = []
        kk = min(k, len(rp))
        for s in range(0, len(qp), QUERIES_AT_ONCE):
            qs = qp.iloc[s:s + QUERIES_AT_ONCE]
            idx, d2 = _nearest(np.stack(qs["vec"].to_numpy()).astype(float), rv, kk)
            rows = np.repeat(np.arange(len(qs)), kk)
            cols = idx.ravel()
            part = pd.DataFrame({"qid": qs["qid"].to_numpy()[rows], "rid": rids[cols],
                                 "d2": d2.ravel()})
            for c in labels:
                part[c] = rp[c].to_numpy()[cols].astype(float)
            out.append(part)
        return pd.concat(out, ignore_index=True)
    return top_k


def knn_candidates(query: DataFrame, ref: DataFrame, k: int, q_id: str = "qid", r_id: str = "rid",
                   vec: str = "vec", label_cols: tuple[str, ...] = ("y",),
                   block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Best ``k`` neighbours per query: ``qid, rid, d2, rank, <labels>`` (rank 1 = nearest).

    ``vec`` is an ``array<double>`` column on both sides.
    """
    nq, nr = query.count(), ref.count()
    qb = max(1, math.ceil(nq / block_rows))
    rb = max(1, math.ceil(nr / block_rows))
    q = (query.select(F.col(q_id).alias("qid"), F.col(vec).alias("vec"))
         .withColumn("qb", _block("qid", qb, "q"))
         .withColumn("rb", F.explode(F.sequence(F.lit(0), F.lit(rb - 1)))))
    r = (ref.select(F.col(r_id).alias("rid"), F.col(vec).alias("vec"), *[F.col(c) for c in label_cols])
         .withColumn("rb", _block("rid", rb, "r"))
         .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(qb - 1)))))
    labels = list(label_cols)
    schema = "qid string, rid string, d2 double, " + ", ".join(f"{c} double" for c in labels)

    top_k = _top_k_kernel(k, labels)

    cand = q.groupBy("qb", "rb").cogroup(r.groupBy("qb", "rb")).applyInPandas(top_k, schema)
    w = Window.partitionBy("qid").orderBy("d2", "rid")
    return cand.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


GRID_POINTS_PER_CELL = 16
WIDEN = 8  # each ring round multiplies the cell width by this


def _cells(df: DataFrame, cell: float) -> DataFrame:
    return df.withColumns({c: F.floor(F.col("vec")[i] / F.lit(cell)).cast("long") for i, c in enumerate(("cx", "cy"))})


def _ring(q: DataFrame, r: DataFrame, cell: float, top, schema: str, block_rows: int) -> DataFrame:
    """Candidates of each query from the 3 x 3 cells around its own.

    Block counts come from the histograms of each cell: a query is copied to the occupied cells around it and
    once for each block of references there, a reference once for each block of queries that visit its own
    cell. Cells without references or without visitors get nothing.
    """
    offs = F.array(*[F.lit(o) for o in (-1, 0, 1)])
    visits = _cells(q, cell).withColumn("ox", F.explode(offs)).withColumn("oy", F.explode(offs)).withColumns(
        {"cx": F.col("cx") + F.col("ox"), "cy": F.col("cy") + F.col("oy")}).drop("ox", "oy")
    refs = _cells(r, cell)
    n = lambda df, name: df.groupBy("cx", "cy").agg(F.ceil(F.count(F.lit(1)) / F.lit(block_rows)).cast("int").alias(name))
    blocks = n(refs, "nr").join(n(visits, "nq"), ["cx", "cy"])
    of = lambda side, key, c: F.pmod(F.xxhash64(F.lit(side), F.col(key)), F.col(c)).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    qv = visits.join(blocks, ["cx", "cy"]).withColumn("qb", of("q", "qid", "nq")).withColumn("rb", every("nr")).drop("nr", "nq")
    rv = refs.join(blocks, ["cx", "cy"]).withColumn("rb", of("r", "rid", "nr")).withColumn("qb", every("nq")).drop("nr", "nq")
    key = ["cx", "cy", "qb", "rb"]
    return qv.groupBy(*key).cogroup(rv.groupBy(*key)).applyInPandas(top, schema)


def grid_knn_candidates(query: DataFrame, ref: DataFrame, k: int, q_id: str = "qid", r_id: str = "rid",
                        vec: str = "vec", label_cols: tuple[str, ...] = ("y",), cell: float | None = None,
                        block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Exact k nearest neighbours with a grid on the first two coordinates and a widening ring.

    Reference rows go to grid cells (about ``16 k`` per cell in the bulk of the data: the width comes from
    the 5 % and 95 % quantiles, so far points don't stretch it); each query meets only the 3 x 3 cells around
    its own. A query is finished when it has ``k`` candidates and the k-th is within one cell width: any row
    outside the 3 x 3 square is farther than that. The others go on with wider cells. If the ring leaves
    more than half of the queries (many dimensions, where two of them prune little) or the cells have
    outgrown the data, the rest is searched by :func:`knn_candidates`.
    """
    from geotrace.session import ensure_checkpoint_dir
    spark = query.sparkSession
    ensure_checkpoint_dir(spark)
    labels = list(label_cols)
    r = ref.select(F.col(r_id).cast("string").alias("rid"), F.col(vec).alias("vec"),
                   *[F.col(c).cast("double").alias(c) for c in labels]).checkpoint()
    q = query.select(F.col(q_id).cast("string").alias("qid"), F.col(vec).alias("vec")).checkpoint()
    x, y = F.col("vec")[0], F.col("vec")[1]
    st = r.agg(F.count(F.lit(1)).alias("n"), F.percentile_approx(x, [0.05, 0.95]).alias("x"), F.percentile_approx(y, [0.05, 0.95]).alias("y"),
               F.greatest(F.max(x) - F.min(x), F.max(y) - F.min(y)).alias("extent")).first()
    if not st["n"]:
        return knn_candidates(query, ref, k, q_id, r_id, vec, label_cols, block_rows)
    if cell is None:
        wide, high = st["x"][1] - st["x"][0], st["y"][1] - st["y"][0]
        area = wide * high or max(wide, high, 1e-12) ** 2 / st["n"]
        cell = max(math.sqrt(area * GRID_POINTS_PER_CELL * k / st["n"]), 1e-12)
    k_eff = min(k, st["n"])
    schema = "qid string, rid string, d2 double, " + ", ".join(f"{c} double" for c in labels)
    top = _top_k_kernel(k, labels)
    w = Window.partitionBy("qid").orderBy("d2", "rid")
    out, left = None, q.count()
    while left:
        cand = _ring(q, r, cell, top, schema, block_rows)
        best = cand.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).checkpoint()
        done = (best.groupBy("qid").agg(F.count(F.lit(1)).alias("c"), F.max("d2").alias("kth"))
                .where((F.col("c") >= k_eff) & (F.col("kth") <= F.lit((cell * (1 - 1e-9)) ** 2))).select("qid"))
        exact = best.join(done, "qid", "left_semi")
        out = exact if out is None else out.unionByName(exact)
        q = q.join(done, "qid", "left_anti").checkpoint()
        before, left = left, q.count()
        if left and (2 * left > before or cell > st["extent"]):
            out = out.unionByName(knn_candidates(q, r, k, "qid", "rid", "vec", tuple(labels), block_rows).select(*out.columns))
            break
        cell *= WIDEN
    return out if out is not None else knn_candidates(q, r, k, "qid", "rid", "vec", tuple(labels), block_rows)


def knn_predict(query: DataFrame, ref: DataFrame, k: int, q_id: str, r_id: str, vec: str,
                label_cols: tuple[str, ...], grid: bool = True) -> DataFrame:
    """Uniform-weight mean of the labels of the ``k`` nearest reference rows, per query id.

    ``grid`` (default) searches neighbouring grid cells first (exact, see :func:`grid_knn_candidates`), or
    in more than two dimensions the cells of pivots that a query's bound reaches (exact, see ``pivot_knn.py``);
    otherwise every block pair is searched.
    """
    find = grid_knn_candidates if grid else knn_candidates
    if grid and (ref.select(F.max(F.size(vec))).first()[0] or 0) > 2:
        from geotrace.operators.pivot_knn import pivot_knn_candidates as find
    c = find(query, ref, k, q_id, r_id, vec, label_cols)
    return c.groupBy(F.col("qid").alias(q_id)).agg(*[F.avg(l).alias(l) for l in label_cols])


class KNNRegressor(Estimator):
    """Spark ML wrapper: features vector, labels that share one search; ids from ``trajectory_id``."""

    def __init__(self, k: int = 5, labelCol: str = "label", labels: tuple[str, ...] | None = None):
        super().__init__()
        self.k, self.labels, self.features, self.pred = k, labels or (labelCol,), "features", "prediction"

    def setFeaturesCol(self, c):
        self.features = c
        return self

    def setPredictionCol(self, c):
        self.pred = c
        return self

    def _fit(self, df: DataFrame) -> "KNNModel":
        ref = df.select(F.col("trajectory_id").alias("rid"), vector_to_array(self.features).alias("vec"),
                        *[F.col(c).cast("double").alias(f"y{i}") for i, c in enumerate(self.labels)])
        preds = (self.pred,) if len(self.labels) == 1 else tuple(f"pred_{c}" for c in self.labels)
        return KNNModel(ref, self.k, self.features, preds)


class KNNModel(Model):
    def __init__(self, ref: DataFrame, k: int, features: str, preds: tuple[str, ...]):
        super().__init__()
        self.ref, self.k, self.features, self.preds = ref, k, features, preds

    def _transform(self, df: DataFrame) -> DataFrame:
        q = df.select(F.col("trajectory_id").alias("qid"), vector_to_array(self.features).alias("vec"))
        labels = tuple(f"y{i}" for i in range(len(self.preds)))
        p = knn_predict(q, self.ref, self.k, "qid", "rid", "vec", labels)
        return df.join(p.select(F.col("qid").alias("trajectory_id"), *[F.col(c).alias(name) for c, name in zip(labels, self.preds)]),
                       "trajectory_id", "left")


@dataclass
class KNNBuilder:
    """Builder of a nearest-neighbour model; all targets are averaged over the neighbours of one search."""

    k: int = 5

    def __call__(self, train: DataFrame, label: str) -> Estimator:
        return KNNRegressor(self.k, label)

    def of_all(self, targets: tuple[str, ...], features: str) -> Estimator:
        est = KNNRegressor(self.k, labels=targets).setFeaturesCol(features)
        return est.setPredictionCol(f"pred_{targets[0]}")


def knn_builder(k: int = 5) -> KNNBuilder:
    return KNNBuilder(k)
