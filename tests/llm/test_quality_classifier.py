import numpy as np
import pytest

from geotrace.llm import quality_classifier as C


def test_held_out_accuracy_on_given_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    out, told = C.scored(docs.select("doc_id", "text"), labels)
    from geotrace.llm.common import held_out
    rows = out.join(labels, "doc_id").where(held_out(out.doc_id, 4, 2)).collect()
    assert told and len(rows) > 50
    assert sum((r.score >= 0.7) == (r.quality == 1) for r in rows) / len(rows) >= 0.95


def test_random_features_approximate_the_gaussian_kernel():
    rng = np.random.default_rng(0)
    d = len(C.STATS)
    model = C.Model(np.zeros(d), np.ones(d), rng.normal(size=(d, 4000)) / np.sqrt(d), rng.uniform(0, 2 * np.pi, 4000), np.zeros(4001), np.zeros(0), np.zeros(0))
    x = rng.normal(size=(6, d))
    z = model.features(x)[:, :-1]
    kernel = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / (2 * d))
    assert np.abs(z @ z.T - kernel).max() < 0.06


def test_whole_fit_equals_plain_numpy(spark):
    rng = np.random.default_rng(6)
    d, k = len(C.STATS), 24
    stats = rng.normal(size=(700, d)).astype(np.float32)
    stats[:, 3] = 2.5  # a constant statistic
    y = (np.sin(stats[:, 0] * 2) + stats[:, 1] + rng.normal(0, 0.3, 700) > 0).astype(float)
    calibrate = rng.random(700) < 0.3
    df = spark.createDataFrame([(s.tolist(), float(b), bool(c)) for s, b, c in zip(stats, y, calibrate, strict=True)],
                               "s array<float>, y double, c boolean").repartition(7)
    model = C.fit(df, "s", "y", "c", features=k, ridge=1e-3, seed=5)
    X, t = stats[~calibrate].astype(float), y[~calibrate]
    same = np.random.default_rng(5)
    weights = same.normal(size=(d, k)) / np.sqrt(d)
    phase = same.uniform(0, 2 * np.pi, k)
    scale = np.where(X.std(0) < 1e-6, 1.0, X.std(0))

    def features(x):
        return np.hstack([np.sqrt(2 / k) * np.cos(np.clip((x - X.mean(0)) / scale, -6, 6) @ weights + phase), np.ones((len(x), 1))])
    Z = features(X)
    # the normal equations as a least-squares problem: rows of sqrt(ridge * n) * identity below the design
    big = np.vstack([Z, np.sqrt(1e-3 * len(X)) * np.eye(k + 1)])
    coef = np.linalg.lstsq(big, np.r_[t, np.zeros(k + 1)], rcond=None)[0]
    assert np.allclose(model.coef, coef, rtol=1e-6, atol=1e-8)
    raw = features(stats[calibrate].astype(float)) @ coef
    bins = np.clip(np.floor(raw * C.BINS), -C.BINS, 2 * C.BINS)
    blocks = [[b, y[calibrate][bins == b].sum(), (bins == b).sum()] for b in np.unique(bins)]
    blocks = [[(b + 0.5) / C.BINS * n, g, n] for b, g, n in blocks]
    while True:  # merge the first pair that falls or is level, until none does
        at = next((i for i in range(len(blocks) - 1) if blocks[i][1] / blocks[i][2] >= blocks[i + 1][1] / blocks[i + 1][2] - 1e-15), None)
        if at is None:
            break
        blocks[at:at + 2] = [[p + q for p, q in zip(blocks[at], blocks[at + 1], strict=True)]]
    want = np.interp(features(stats.astype(float)) @ coef, [b[0] / b[2] for b in blocks], [b[1] / b[2] for b in blocks])
    assert np.allclose(model.score(stats.astype(float)), np.clip(want, 0, 1), atol=1e-6)


def test_isotonic_is_the_best_monotone_fit():
    x, good, n = np.arange(6.0), np.array([1, 0, 2, 1, 3, 3.0]), np.array([2, 2, 2, 2, 3, 3.0])
    knots, values = C.isotonic(x, good, n)
    assert (np.diff(values) > 0).all() and len(knots) == len(values)
    assert values == pytest.approx([0.25, 0.75, 1.0])


def test_odd_texts_labels_and_tables(spark):
    texts = [None, "", " ", "x", "漢字 é", "a " * 50_000, "!!! ###", "\n\n"] + [f"word{i} and more words here {i}." for i in range(80)] + ["bad!! " * 30] * 40
    docs = spark.createDataFrame([(i % 120, t, "own") for i, t in enumerate(texts)], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, None if i == 9 else int(i < 88)) for i in range(8, 128)] + [(10, 1), (None, 1)], "doc_id long, quality int")
    out, told = C.scored(docs, labels)
    rows = out.collect()
    assert told and len(rows) == len(texts) and all(0 <= r.score <= 1 for r in rows)
    none, told = C.scored(docs, labels.limit(0))
    assert not told and {r.score for r in none.collect()} == {0.5}
    assert C.accepted(docs, labels.limit(0)).count() == len(texts)
    kept = C.accepted(docs, labels)
    assert kept.columns == docs.columns and {r.score for r in kept.collect()} == {"own"}
    assert C.scored(docs.limit(0), labels)[0].count() == 0
    assert all(len(C.doc_stats(t.encode() if t else None)) == len(C.STATS) for t in texts)
