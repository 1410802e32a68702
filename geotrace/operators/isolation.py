"""Isolation-forest feature outliers.

Numeric columns are NULL -> 0 and standardised (population sigma). Each of the 100
trees is grown on an executor from at most 256 rows; the rows are picked by a hash
draw per (tree, row), so only about 2 x 256 rows per tree are exploded and grouped,
never the table. The forest (100 small trees) is broadcast and every row is scored in
Arrow batches with ``mapInPandas``. Rows whose anomaly score is above the
(1 - contamination) quantile of all scores are flagged.
"""

from __future__ import annotations

import math
import pickle

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geotrace.functions.hashrand import uniform
from geotrace.operators.clustering import standardize
from geotrace.operators.quantiles import quantiles
from geotrace.session import ensure_checkpoint_dir

N_TREES = 100
SAMPLE = 256


def _c(n: float) -> float:
    """Average path length of an unsuccessful search in a binary tree of n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n


def _grow(X: np.ndarray, rng: np.random.Generator, limit: int):
    """Tree as parallel arrays: feature, threshold, left, right, size (leaf when feature = -1)."""
    feat, thr, left, right, size = [], [], [], [], []

    def node(idx, depth):
        me = len(feat)
        feat.append(-1), thr.append(0.0), left.append(-1), right.append(-1), size.append(len(idx))
        if depth >= limit or len(idx) <= 1:
            return me
        lo, hi = X[idx].min(0), X[idx].max(0)
        cand = np.flatnonzero(hi > lo)
        if cand.size == 0:
            return me
        f = int(rng.choice(cand))
        t = float(rng.uniform(lo[f], hi[f]))
        feat[me], thr[me] = f, t
        l_idx, r_idx = idx[X[idx, f] < t], idx[X[idx, f] >= t]
        left[me] = node(l_idx, depth + 1)
        right[me] = node(r_idx, depth + 1)
        return me

    node(np.arange(len(X)), 0)
    return tuple(np.array(a) for a in (feat, thr, left, right, size))


def _path_lengths(X: np.ndarray, tree) -> np.ndarray:
    feat, thr, left, right, size = tree
    node = np.zeros(len(X), dtype=int)
    depth = np.zeros(len(X))
    active = feat[node] >= 0
    while active.any():
        i = np.flatnonzero(active)
        go_left = X[i, feat[node[i]]] < thr[node[i]]
        node[i] = np.where(go_left, left[node[i]], right[node[i]])
        depth[i] += 1
        active = feat[node] >= 0
    return depth + np.array([_c(s) for s in size[node]])


def isolation_scores(df: DataFrame, cols: list[str], id_col: str = "trajectory_id", n_trees: int = N_TREES,
                     sample: int = SAMPLE, seed: int = 42) -> DataFrame:
    """``id, anomaly_score`` (higher = more anomalous, in (0, 1])."""
    z = standardize(df.select(id_col, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in cols]),
                    cols)
    n = z.count()
    psi = min(sample, n)
    frac = min(1.0, 2.0 * psi / max(n, 1))
    picks = F.filter(F.sequence(F.lit(0), F.lit(n_trees - 1)),
                     lambda t: uniform(seed, F.col(id_col), t, tag="iforest") < F.lit(frac))
    # about 2 x psi rows per tree
    drawn = z.select(*cols, F.explode(picks).alias("_t"), uniform(seed, F.col(id_col), tag="order").alias("_o"))
    limit = int(math.ceil(math.log2(max(psi, 2))))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        part = pdf.sort_values(["_o", *cols]).head(psi)
        t = int(part["_t"].iloc[0])
        tree = _grow(part[cols].to_numpy(float), np.random.default_rng([seed, t]), limit)
        return pd.DataFrame({"t": [t], "tree": [pickle.dumps((tree, len(part)))]})

    grown = drawn.groupBy("_t").applyInPandas(grow, "t int, tree binary").collect()  # n_trees small trees
    forest = [pickle.loads(r["tree"]) for r in sorted(grown, key=lambda r: r["t"])]
    if not forest:
        forest = [(_grow(np.zeros((1, len(cols))), np.random.default_rng(seed), 0), 1)]
    bc = df.sparkSession.sparkContext.broadcast(forest)

    def score(it):
        trees = bc.value
        for pdf in it:
            X = pdf[cols].to_numpy(float)
            h = np.zeros(len(X))
            for tree, m in trees:
                h += _path_lengths(X, tree)
            h /= len(trees)
            norm = _c(trees[0][1]) or 1.0
            yield pd.DataFrame({id_col: pdf[id_col], "anomaly_score": np.power(2.0, -h / norm)})

    return z.mapInPandas(score, f"{id_col} string, anomaly_score double")


def add_isolation_mask(df: DataFrame, cols: list[str], contamination: float = 0.03, id_col: str = "trajectory_id",
                       seed: int = 42) -> DataFrame:
    """``anomaly_score`` and ``is_features_isolation`` joined back on the id."""
    s = isolation_scores(df, cols, id_col, seed=seed)
    ensure_checkpoint_dir(df.sparkSession)
    s = s.checkpoint()                 # scored once, read by the quantile and the join
    thr = quantiles(s, ["anomaly_score"], [1.0 - contamination])["anomaly_score"][0]
    s = s.withColumn("is_features_isolation", F.col("anomaly_score") > F.lit(thr))
    return df.join(s, id_col, "left")
