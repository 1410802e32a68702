"""Iterative regressors built from distributed passes.

* ``AdaBoostR2``: each round fits a Spark ML ``DecisionTreeRegressor`` with the current
  row weights, then two 1-row aggregates (max error, weighted mean loss) decide the
  estimator weight and the new row weights, which are a column expression. Lineage is
  cut with ``checkpoint()`` every few rounds. Prediction is the weighted median of the
  rounds' predictions, computed per row with array functions.
* ``BayesianRidge``: one distributed pass computes X'X, X'y, y'y, n and the sums
  (per-partition Gram blocks, summed with a partial aggregate over their entries);
  the evidence iterations then run on the p x p matrices on the driver.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geotrace.operators.gram import evidence
from geotrace.operators.partsum import summed
from geotrace.session import ensure_checkpoint_dir


class AdaBoostR2(Estimator):
    """AdaBoost.R2 with linear loss; base learner a depth-3 regression tree."""

    def __init__(self, labelCol: str = "label", n_estimators: int = 50, learning_rate: float = 1.0,
                 max_depth: int = 3, seed: int = 42, checkpoint_every: int = 5):
        super().__init__()
        self.label, self.n, self.lr, self.depth, self.seed = labelCol, n_estimators, learning_rate, max_depth, seed
        self.every = checkpoint_every
        self.features, self.pred = "features", "prediction"

    def setFeaturesCol(self, c):
        self.features = c
        return self

    def setPredictionCol(self, c):
        self.pred = c
        return self

    def _fit(self, df: DataFrame) -> "AdaBoostR2Model":
        ensure_checkpoint_dir(df.sparkSession)
        d = df.select(self.features, F.col(self.label).cast("double").alias("_y"))
        n = d.count()
        d = d.withColumn("_w", F.lit(1.0 / max(n, 1))).checkpoint()
        trees, weights = [], []
        for t in range(self.n):
            tree = DecisionTreeRegressor(featuresCol=self.features, labelCol="_y", weightCol="_w",
                                         maxDepth=self.depth, seed=self.seed + t, predictionCol="_p").fit(d)
            p = tree.transform(d).withColumn("_e", F.abs(F.col("_y") - F.col("_p")))
            max_err = p.agg(F.max("_e")).first()[0] or 0.0
            if max_err <= 0:                       # perfect fit: keep it with weight 1 and stop
                trees.append(tree)
                weights.append(1.0)
                break
            loss = F.col("_e") / F.lit(max_err)
            err = p.agg((F.sum(F.col("_w") * loss) / F.sum("_w"))).first()[0]
            if err >= 0.5:
                if not trees:
                    trees.append(tree)
                    weights.append(1.0)
                break
            beta = err / (1.0 - err)
            trees.append(tree)
            weights.append(self.lr * math.log(1.0 / beta) if beta > 0 else 1.0)
            d = p.withColumn("_w", F.col("_w") * F.pow(F.lit(beta), (F.lit(1.0) - loss) * self.lr))
            total = d.agg(F.sum("_w")).first()[0]
            d = d.withColumn("_w", F.col("_w") / F.lit(total)).select(self.features, "_y", "_w")
            if (t + 1) % self.every == 0:
                d = d.checkpoint()
        return AdaBoostR2Model(trees, weights, self.features, self.pred)


class AdaBoostR2Model(Model):
    def __init__(self, trees, weights, features, pred):
        super().__init__()
        self.trees, self.weights, self.features, self.pred = trees, weights, features, pred

    def _transform(self, df: DataFrame) -> DataFrame:
        out = df
        cols = []
        for i, tr in enumerate(self.trees):
            c = f"_ab{i}"
            out = tr.copy().setPredictionCol(c).transform(out)
            cols.append(c)
        pw = F.array_sort(F.array(*[F.struct(F.col(c).alias("p"), F.lit(w).alias("w"))
                                    for c, w in zip(cols, self.weights)]))
        half = 0.5 * sum(self.weights)
        init = F.struct(F.lit(0.0).alias("cum"), F.lit(None).cast("double").alias("val"))

        def step(acc, x):
            cum = acc["cum"] + x["w"]
            val = F.when(acc["val"].isNull() & (cum >= F.lit(half)), x["p"]).otherwise(acc["val"])
            return F.struct(cum.alias("cum"), val.alias("val"))
        med = F.aggregate(pw, init, step)["val"]
        return out.withColumn(self.pred, med).drop(*cols)


def gram(df: DataFrame, features: str, label: str) -> dict:
    """Distributed X'X, X'y, y'y, sums and n of a vector column and a label (one pass)."""
    p = len(df.select(features).first()[0])
    a = df.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"))

    def blocks(it):
        xx = np.zeros((p, p))
        xy = np.zeros(p)
        sx = np.zeros(p)
        yy = sy = n = 0.0
        for pdf in it:
            if pdf.empty:
                continue
            X = np.stack(pdf["x"].to_numpy()).astype(float)
            y = pdf["y"].to_numpy(float)
            xx += X.T @ X
            xy += X.T @ y
            sx += X.sum(0)
            yy += float(y @ y)
            sy += float(y.sum())
            n += len(y)
        return np.concatenate([xx.ravel(), xy, sx, [yy, sy, n]])

    v = summed(a, blocks, p * p + 2 * p + 3)
    k = p * p
    return {"xx": v[:k].reshape(p, p), "xy": v[k:k + p], "sx": v[k + p:k + 2 * p],
            "yy": v[k + 2 * p], "sy": v[k + 2 * p + 1], "n": v[k + 2 * p + 2]}


class BayesianRidge(Estimator):
    """Evidence-maximising ridge (300 iterations, tol 1e-3, Gamma priors 1e-6)."""

    def __init__(self, labelCol: str = "label", max_iter: int = 300, tol: float = 1e-3,
                 alpha_1: float = 1e-6, alpha_2: float = 1e-6, lambda_1: float = 1e-6, lambda_2: float = 1e-6):
        super().__init__()
        self.label, self.max_iter, self.tol = labelCol, max_iter, tol
        self.a1, self.a2, self.l1, self.l2 = alpha_1, alpha_2, lambda_1, lambda_2
        self.features, self.pred = "features", "prediction"

    def setFeaturesCol(self, c):
        self.features = c
        return self

    def setPredictionCol(self, c):
        self.pred = c
        return self

    def _fit(self, df: DataFrame) -> "LinearVectorModel":
        g = gram(df, self.features, self.label)
        n = g["n"]
        mx, my = g["sx"] / n, g["sy"] / n
        xx = g["xx"] - n * np.outer(mx, mx)                  # centred Gram
        xy = g["xy"] - n * mx * my
        yy = g["yy"] - n * my * my
        coef = evidence(xx, xy, yy, n, self.max_iter, self.tol, self.a1, self.a2, self.l1, self.l2)
        return LinearVectorModel(coef, float(my - mx @ coef), self.features, self.pred)


class LinearVectorModel(Model):
    """Prediction ``x . coef + intercept`` as an array expression (no Python per row)."""

    def __init__(self, coef, intercept, features, pred):
        super().__init__()
        self.coef, self.intercept, self.features, self.pred = np.asarray(coef, float), intercept, features, pred

    def _transform(self, df: DataFrame) -> DataFrame:
        w = F.array(*[F.lit(float(c)) for c in self.coef])
        dot = F.aggregate(F.zip_with(vector_to_array(self.features), w, lambda a, b: a * b), F.lit(0.0),
                          lambda s, x: s + x)
        return df.withColumn(self.pred, dot + F.lit(self.intercept))
