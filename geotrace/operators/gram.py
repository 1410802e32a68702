"""Linear models from Gram matrices by fold (R8-R11 in E3, E4, E6, E10, R17).

One pass sums X'X, X'Y, Y'Y and the sums of every fold. The training system of a fold is the total less the
fold's own part, so all folds of all linear models cost that one pass; the small systems are solved on the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geotrace.operators.partsum import summed

KINDS = ("Ridge", "Lasso", "ElasticNet", "LinearRegression", "BayesianRidge")


@dataclass
class Gram:
    n: float
    sx: np.ndarray
    sy: np.ndarray
    xx: np.ndarray
    xy: np.ndarray
    yy: np.ndarray

    @staticmethod
    def of(v: np.ndarray, p: int, k: int) -> "Gram":
        at = np.cumsum([1, p, k, p * p, p * k])
        n, sx, sy, xx, xy, yy = np.split(v, at)
        return Gram(float(n[0]), sx, sy, xx.reshape(p, p), xy.reshape(p, k), yy)

    def less(self, part: "Gram") -> "Gram":
        return Gram(*[a - b for a, b in zip(self.__dict__.values(), part.__dict__.values())])

    def centred(self) -> tuple[np.ndarray, ...]:
        """Means of x and y, and the sums of squares and products about them."""
        mx, my = self.sx / self.n, self.sy / self.n
        return mx, my, self.xx - self.n * np.outer(mx, mx), self.xy - self.n * np.outer(mx, my), self.yy - self.n * my * my


def fold_grams(rows: DataFrame, p: int, k: int, folds: int) -> tuple[Gram, list[Gram]]:
    """The Gram sums of all ``rows`` (fold, x, y) and of each fold 0 .. folds - 1."""
    size = 1 + p + k + p * p + p * k + k

    def sums(it):
        total = np.zeros((folds + 1, size))
        for pdf in it:
            if pdf.empty:
                continue
            X, Y, fold = np.stack(pdf["x"].to_numpy()).astype(float), np.stack(pdf["y"].to_numpy()).astype(float), pdf["fold"].to_numpy()
            for f in range(folds + 1):
                at = fold == f if f < folds else (fold < 0) | (fold >= folds)
                x, y = X[at], Y[at]
                total[f] += np.concatenate([[len(x)], x.sum(0), y.sum(0), (x.T @ x).ravel(), (x.T @ y).ravel(), (y * y).sum(0)])
        return total.ravel()

    # centring about the whole mean first would need a second pass; the features are scaled already
    v = summed(rows.select("fold", "x", "y"), sums, (folds + 1) * size).reshape(folds + 1, size)
    return Gram.of(v.sum(axis=0), p, k), [Gram.of(x, p, k) for x in v[:folds]]


def solved(kind: str, g: Gram, params: dict) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients (features, targets) and intercepts; an empty system predicts 0."""
    p, k = g.xy.shape
    if g.n <= 0:
        return np.zeros((p, k)), np.zeros(k)
    mx, my, xx, xy, yy = g.centred()
    alpha, share = params.get("alpha", 1.0), params.get("l1_ratio", 0.5)
    if kind == "Ridge":
        w = np.linalg.solve(xx + alpha * np.eye(p), xy)
    elif kind == "LinearRegression":
        scale = np.sqrt(np.clip(np.diag(xx), 0, None))
        scale = np.where(scale > 0, scale, 1.0)
        w = np.linalg.pinv(xx / np.outer(scale, scale), rcond=1e-10, hermitian=True) @ (xy / scale[:, None]) / scale[:, None]
    elif kind == "BayesianRidge":
        w = np.stack([evidence(xx, xy[:, t], yy[t], g.n, **params) for t in range(k)], 1)
    else:
        l1 = alpha * g.n * (1.0 if kind == "Lasso" else share)
        l2 = 0.0 if kind == "Lasso" else alpha * g.n * (1 - share)
        w = np.stack([descent(xx, xy[:, t], l1, l2, params.get("maxIter", 1000)) for t in range(k)], 1)
    return w, my - mx @ w


def descent(xx: np.ndarray, xy: np.ndarray, l1: float, l2: float, sweeps: int, tol: float = 1e-9) -> np.ndarray:
    """Cyclic coordinate descent of ``w'xx w / 2 - xy'w + l1 |w| + l2 w'w / 2``."""
    w, diag = np.zeros(len(xy)), np.diag(xx)
    for _ in range(sweeps):
        most = 0.0
        for j in np.flatnonzero(diag > 0):
            rest = xy[j] - xx[j] @ w + diag[j] * w[j]
            new = np.sign(rest) * max(abs(rest) - l1, 0.0) / (diag[j] + l2)
            most = max(most, abs(new - w[j]) * np.sqrt(diag[j]))
            w[j] = new
        if most <= tol * max(np.abs(w * np.sqrt(np.clip(diag, 0, None))).max(), 1e-300):
            break
    return w


def evidence(xx, xy, yy, n, max_iter: int = 300, tol: float = 1e-3, alpha_1: float = 1e-6, alpha_2: float = 1e-6,
             lambda_1: float = 1e-6, lambda_2: float = 1e-6) -> np.ndarray:
    """Coefficients that maximise the evidence of a Gaussian prior and noise (centred sums)."""
    eig, vec = np.linalg.eigh(xx)
    eig = np.clip(eig, 0, None)
    alpha, lam, coef, proj = 1.0 / (yy / n + np.finfo(float).eps), 1.0, np.zeros(len(xy)), vec.T @ xy
    for _ in range(max_iter):
        new = vec @ (proj / (eig + lam / alpha))
        rss = yy - 2 * new @ xy + new @ xx @ new
        gamma = float(np.sum(alpha * eig / (lam + alpha * eig)))
        lam = (gamma + 2 * lambda_1) / (float(new @ new) + 2 * lambda_2)
        alpha = (n - gamma + 2 * alpha_1) / (max(rss, 0.0) + 2 * alpha_2)
        moved = np.sum(np.abs(coef - new))
        coef = new
        if moved < tol:
            break
    return vec @ (proj / (eig + lam / alpha))


def held_out(rows: DataFrame, models: list[list[tuple[np.ndarray, np.ndarray]]], k: int) -> DataFrame:
    """(model, row, p): predictions of each row of ``rows`` (row, fold, x) by each model's system of the row's fold."""
    given = rows.sparkSession.sparkContext.broadcast(models)

    def work(batches):
        for b in batches:
            fold, row = b.column(1).to_numpy(), b.column(0).to_numpy()
            X = b.column(2).flatten().to_numpy(zero_copy_only=False).reshape(len(b.column(2)), -1)
            for m, systems in enumerate(given.value):
                for f, (w, c) in enumerate(systems):
                    at = np.flatnonzero(fold == f)
                    if len(at):
                        p = np.ascontiguousarray(X[at] @ w + c)
                        lists = pa.ListArray.from_arrays(np.arange(len(at) + 1, dtype=np.int32) * k, pa.array(p.ravel()))
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), m, np.int32)), pa.array(row[at]), lists], names=["model", "row", "p"])

    return rows.select("row", "fold", "x").mapInArrow(work, "model int, row long, p array<double>")


def linear_column(x: str, coef: np.ndarray, intercept: float):
    """``x . coef + intercept`` of an array column, without Python per row."""
    w = F.array(*[F.lit(float(c)) for c in coef])
    return F.aggregate(F.zip_with(x, w, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v) + F.lit(float(intercept))
