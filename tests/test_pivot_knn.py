import numpy as np

from geotrace.operators.pivot_knn import pivot_knn_candidates


def frames(spark, ref, qry, y):
    r = spark.createDataFrame([(f"r{i:04d}", x.tolist(), float(y[i])) for i, x in enumerate(ref)], "rid string, vec array<double>, y double")
    q = spark.createDataFrame([(f"q{i:03d}", x.tolist()) for i, x in enumerate(qry)], "qid string, vec array<double>")
    return q.repartition(3), r.repartition(4)


def test_equals_brute_force_and_visits_few_pairs_in_many_dimensions(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 10, (12, 30))
    ref = np.vstack([c + rng.normal(0, 1, (50, 30)) for c in centres] + [np.tile(centres[0], (200, 1))])  # a hot spot of equal rows
    qry = np.vstack([centres[rng.integers(0, 12, 60)] + rng.normal(0, 1, (60, 30)), ref[:20], np.full((2, 30), 80.0)])
    y = rng.normal(size=len(ref))
    q, r = frames(spark, ref, qry, y)
    for block_rows in (20_000, 37):
        report = {}
        got = {}
        for x in pivot_knn_candidates(q, r, 5, block_rows=block_rows, report=report).collect():
            got.setdefault(x["qid"], []).append((x["rank"], x["rid"]))
        for i, v in enumerate(qry):
            d = np.zeros(len(ref))
            for j in range(30):
                d += (v[j] - ref[:, j]) ** 2
            want = sorted(range(len(ref)), key=lambda n: (d[n], f"r{n:04d}"))[:5]
            assert [rid for _, rid in sorted(got[f"q{i:03d}"])] == [f"r{n:04d}" for n in want], (i, block_rows)
        assert report["pairs"] == len(ref) * len(qry) and report["visited"] < report["pairs"] / 2


def test_few_and_no_references(spark):
    rng = np.random.default_rng(2)
    q, r = frames(spark, rng.normal(size=(3, 4)), rng.normal(size=(5, 4)), np.ones(3))
    assert pivot_knn_candidates(q, r, 5).count() == 15
    assert pivot_knn_candidates(q, r.limit(0), 5).count() == 0 and pivot_knn_candidates(q.limit(0), r, 5).count() == 0
