import numpy as np
import pytest

from geotrace.operators.quantiles import ValueCounts, quantiles


@pytest.mark.parametrize("partitions", [None, 1, 40])
def test_quantiles_and_distinct_counts_equal_numpy(spark, partitions):
    rng = np.random.default_rng(4)
    a, b = rng.normal(size=700), rng.integers(0, 5, 700).astype(float)
    rows = [(float(x), float(y), None, None if i % 3 else 2.0) for i, (x, y) in enumerate(zip(a, b, strict=True))]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(7)
    counts = ValueCounts(df, ["a", "b", "c", "d"], partitions)
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    got = counts.quantiles(probs)
    assert got["a"] == pytest.approx(np.quantile(a, probs)) and got["b"] == pytest.approx(np.quantile(b, probs))
    assert got["c"] is None and got["d"] == [2.0] * 6
    assert counts.distinct() == {"a": 700, "b": 5, "c": 0, "d": 1}


def test_no_partition_holds_all_values(spark):
    counts = ValueCounts(spark.range(20_000).selectExpr("id * 1.0 AS a"), ["a"], 20)
    sizes = [r["count"] for r in counts.table.groupBy("part").count().collect()]
    assert len(sizes) > 10 and max(sizes) < 4000


def test_empty_table(spark):
    assert quantiles(spark.range(0).selectExpr("id * 1.0 AS a"), ["a"], [0.5]) == {"a": None}
