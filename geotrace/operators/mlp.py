"""Multi-layer perceptron regressor (R13): hidden layers (100, 50), ReLU, Adam.

Data-parallel minibatch training on the standardised targets, a network for each. Each epoch
broadcasts the weights and Adam moments; every partition runs one epoch of minibatch Adam on its
rows with numpy, and the partitions' states are averaged by their rows. With one partition that
is plain minibatch Adam. The networks of all targets train in the same jobs until each has
converged. The driver holds only the states (about 45k numbers for 96 inputs). The rows are
checkpointed once and cached as arrays, so that epochs neither derive nor convert them again.
Prediction is an Arrow ``pandas_udf`` with the broadcast weights.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geotrace.session import ensure_checkpoint_dir

ROWS_PER_PARTITION = 20_000


def _shapes(p: int, hidden: tuple[int, ...]) -> list[tuple[int, int]]:
    dims = [p, *hidden, 1]
    return [(dims[i], dims[i + 1]) for i in range(len(dims) - 1)]


def _unpack(theta: np.ndarray, shapes):
    out, k = [], 0
    for a, b in shapes:
        w = theta[k:k + a * b].reshape(a, b)
        k += a * b
        bias = theta[k:k + b]
        k += b
        out.append((w, bias))
    return out


def _forward(X, layers):
    acts = [X]
    h = X
    for i, (w, b) in enumerate(layers):
        h = h @ w + b
        if i < len(layers) - 1:
            h = np.maximum(h, 0.0)
        acts.append(h)
    return acts


def _grad(X, y, layers):
    """Gradient of 0.5 * sum((f(X) - y)^2) over this block (summed, not averaged)."""
    acts = _forward(X, layers)
    delta = acts[-1][:, 0] - y
    d = delta[:, None]
    grads = []
    for i in range(len(layers) - 1, -1, -1):
        w, _ = layers[i]
        grads.append((acts[i].T @ d, d.sum(0)))
        if i > 0:
            d = (d @ w.T) * (acts[i] > 0)
    grads.reverse()
    return np.concatenate([np.concatenate([gw.ravel(), gb]) for gw, gb in grads]), 0.5 * float(delta @ delta)


class MLPRegressor(Estimator):
    def __init__(self, labelCol: str = "label", hidden: tuple[int, ...] = (100, 50), learning_rate: float = 1e-3,
                 alpha: float = 1e-4, max_iter: int = 200, tol: float = 1e-4, seed: int = 42,
                 beta_1: float = 0.9, beta_2: float = 0.999, epsilon: float = 1e-8, batch: int = 200,
                 labels: tuple[str, ...] | None = None):
        super().__init__()
        self.labels, self.hidden, self.lr, self.alpha, self.max_iter, self.tol = \
            labels or (labelCol,), hidden, learning_rate, alpha, max_iter, tol
        self.seed, self.b1, self.b2, self.eps, self.batch = seed, beta_1, beta_2, epsilon, batch
        self.features, self.pred = "features", "prediction"

    def setFeaturesCol(self, c):
        self.features = c
        return self

    def setPredictionCol(self, c):
        self.pred = c
        return self

    def _fit(self, df: DataFrame) -> "MLPModel":
        spark = df.sparkSession
        ensure_checkpoint_dir(spark)
        names = [f"y{i}" for i in range(len(self.labels))]
        data = df.select(vector_to_array(self.features).alias("x"), *[F.col(c).cast("double").alias(y) for c, y in zip(self.labels, names)]) \
            .checkpoint()
        n, *found = data.agg(F.count(F.lit(1)), *[f(y) for y in names for f in (F.avg, F.stddev_pop)]).first()
        scales = [(mean or 0.0, sd or 1.0) for mean, sd in zip(found[::2], found[1::2])]  # the nets learn standardised targets
        wanted = max(1, -(-n // ROWS_PER_PARTITION))
        data = data.coalesce(wanted)
        p = len(data.first()["x"])
        shapes = _shapes(p, self.hidden)
        rng = np.random.default_rng(self.seed)
        parts = []
        for a, b in shapes:          # Glorot-uniform initialisation
            lim = np.sqrt(6.0 / (a + b))
            parts += [rng.uniform(-lim, lim, a * b), rng.uniform(-lim, lim, b)]
        theta = np.concatenate(parts)
        size = len(theta)
        states = [np.concatenate([theta, np.zeros(2 * size)]) for _ in names]   # weights and the two Adam moments
        steps, best, stall = [0] * len(names), [np.inf] * len(names), [0] * len(names)
        lr, alpha, b1, b2, eps, batch, seed = self.lr, self.alpha, self.b1, self.b2, self.eps, self.batch, self.seed

        def arrays(batches):
            """The partition's rows as one pair of arrays."""
            had = [b.to_pandas() for b in batches if b.num_rows]
            if had:
                X = np.concatenate([np.stack(pdf["x"].to_numpy()) for pdf in had]).astype(float)
                Y = np.concatenate([pdf[names].to_numpy(float) for pdf in had])
                yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps((X, Y), 5)], pa.binary())], names=["block"])

        blocks = data.mapInArrow(arrays, "block binary").rdd.map(lambda r: pickle.loads(r[0])).persist(StorageLevel.MEMORY_AND_DISK)
        live = list(range(len(names)))
        for epoch in range(self.max_iter):
            bc = spark.sparkContext.broadcast([(i, states[i], steps[i], *scales[i]) for i in live])

            def run(part, held, bc=bc, epoch=epoch):
                """One epoch of minibatch Adam over the partition for each net; its states count by its rows."""
                out = np.zeros((len(bc.value), 3 * size + 3))
                for X, Y in held:
                    for at, (i, state, steps, mean, sd) in enumerate(bc.value):
                        y = (Y[:, i] - mean) / sd
                        theta, m, v = (state[c * size:(c + 1) * size].copy() for c in range(3))
                        order = np.random.default_rng([seed, epoch, part]).permutation(len(y))
                        loss, t = 0.0, steps
                        for lo in range(0, len(y), batch):
                            rows = order[lo:lo + batch]
                            g, part_loss = _grad(X[rows], y[rows], _unpack(theta, shapes))
                            loss += part_loss + 0.5 * alpha * float(theta @ theta)
                            g = (g + alpha * theta) / len(rows)
                            t += 1
                            m = b1 * m + (1 - b1) * g
                            v = b2 * v + (1 - b2) * g * g
                            theta = theta - lr * (m / (1 - b1 ** t)) / (np.sqrt(v / (1 - b2 ** t)) + eps)
                        out[at] = np.concatenate([np.concatenate([theta, m, v]) * len(y), [loss, len(y), len(y) * (t - steps)]])
                yield out

            sums = blocks.mapPartitionsWithIndex(run)
            totals = sums.treeReduce(np.add) if wanted > 32 else sums.reduce(np.add)
            bc.unpersist()
            for at, i in enumerate(list(live)):
                total = totals[at]
                states[i] = total[:3 * size] / total[-2]       # partitions' states averaged by their rows
                steps[i] += int(round(total[-1] / total[-2]))
                loss = total[3 * size] / total[-2]
                stall[i] = 0 if loss < best[i] - self.tol else stall[i] + 1
                best[i] = min(best[i], loss)
                if stall[i] >= 10:
                    live.remove(i)
            if not live:
                break
        blocks.unpersist()
        preds = (self.pred,) if len(names) == 1 else tuple(f"pred_{c}" for c in self.labels)
        return MLPModel([s[:size] for s in states], shapes, self.features, preds, scales)


@dataclass
class MLPBuilder:
    """Builder of multi-layer perceptrons; the nets of all targets train in the same jobs."""

    params: dict

    def __call__(self, train: DataFrame, label: str) -> Estimator:
        return MLPRegressor(labelCol=label, **self.params)

    def of_all(self, targets: tuple[str, ...], features: str) -> Estimator:
        return MLPRegressor(labels=targets, **self.params).setFeaturesCol(features).setPredictionCol(f"pred_{targets[0]}")


class MLPModel(Model):
    def __init__(self, thetas, shapes, features, preds, scales):
        super().__init__()
        self.thetas, self.shapes, self.features, self.preds, self.scales = thetas, shapes, features, preds, scales

    def _transform(self, df: DataFrame) -> DataFrame:
        bc = df.sparkSession.sparkContext.broadcast(self.thetas)
        out = df
        for i, name in enumerate(self.preds):
            out = out.withColumn(name, _predictor(bc, i, self.shapes, *self.scales[i])(vector_to_array(self.features)))
        return out


def _predictor(bc, i: int, shapes, mean: float, sd: float):
    """A pandas UDF: raw feature array -> the ``i``-th net's prediction."""
    @F.pandas_udf("double")
    def predict(x: pd.Series) -> pd.Series:
        X = np.stack(x.to_numpy()).astype(float) if len(x) else np.zeros((0, shapes[0][0]))
        return pd.Series(_forward(X, _unpack(bc.value[i], shapes))[-1][:, 0] * sd + mean)
    return predict
