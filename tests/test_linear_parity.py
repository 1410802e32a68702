import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler

from geotrace.operators.models import builder


def descent(X, y, alpha, rho, sweeps=5000):
    """Coordinate descent for |y - Xb - b0|^2 / 2n + alpha (rho |b|_1 + (1 - rho) / 2 |b|^2)."""
    n, p = X.shape
    xm, ym = X.mean(0), y.mean()
    X, y, b = X - xm, y - ym, np.zeros(p)
    for _ in range(sweeps):
        for j in range(p):
            g = X[:, j] @ (y - X @ b + X[:, j] * b[j]) / n
            b[j] = np.sign(g) * max(abs(g) - alpha * rho, 0) / (X[:, j] @ X[:, j] / n + alpha * (1 - rho))
    return ym - xm @ b, b


@pytest.mark.parametrize("name, params, alpha, rho", [("Lasso", {"alpha": 0.3}, 0.3, 1.0), ("ElasticNet", {"alpha": 0.4, "l1_ratio": 0.3}, 0.4, 0.3)])
def test_penalised_fits_minimise_the_stated_objective(spark, name, params, alpha, rho):
    rng = np.random.default_rng(8)
    X = rng.normal(size=(300, 4)) * [1, 2, 0.5, 1] + [0, 3, -1, 2]
    y = X @ [2.0, -1.0, 0.0, 0.05] + 7 + rng.normal(size=300) * 0.5
    df = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(X, y, strict=True)], "a double, b double, c double, d double, y double")
    df = VectorAssembler(inputCols=["a", "b", "c", "d"], outputCol="features").transform(df)
    model = builder(name, None, params)(df, "y").fit(df)
    b0, b = descent(X, y, alpha, rho)
    assert model.intercept == pytest.approx(b0, abs=2e-3) and list(model.coefficients) == pytest.approx(list(b), abs=2e-3)
