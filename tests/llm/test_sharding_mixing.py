import hashlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from geotrace.llm import mixing, sharding


def bits_of(i):
    return f"{int(hashlib.md5(('' if i is None else str(i)).encode()).hexdigest()[:15], 16):060b}"


def test_shards_are_the_shortest_prefixes_that_fit(spark):
    rows = [(i, "x" * (i * 37 % 400)) for i in range(500)] + [(None, None), (1000, "y" * 5000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sharding.sharded(df, 3000).collect()
    size = defaultdict(lambda: [0, 0])
    for i, t in rows:
        for d in range(61):
            size[bits_of(i)[:d]][0] += len(t or "")
            size[bits_of(i)[:d]][1] += 1
    assert len(got) == len(rows)
    for r in got:
        want = next(bits_of(r.doc_id)[:d] for d in range(61) if size[bits_of(r.doc_id)[:d]][0] <= 3000 or size[bits_of(r.doc_id)[:d]][1] == 1)
        assert (r.shard, r.shard_bytes, r.shard_rows) == (want, *size[want])
        assert r.over_limit == (r.doc_id == 1000) and r.n_bytes == len(r.text or "")


def test_a_key_with_a_third_of_all_rows_is_split(spark):
    df = spark.createDataFrame([(7 if i % 3 == 0 else i, "é" * 50, "s") for i in range(300)], "doc_id long, text string, shard string")
    rows = sharding.sharded(df, 1000)
    assert rows.count() == 300
    shards = {r.shard: r for r in sharding.directory(rows).collect()}
    assert all(r.shard_bytes <= 1000 for r in shards.values()) and sum(r.shard_rows for r in shards.values()) == 300
    assert not any(a != b and b.startswith(a) for a in shards for b in shards)
    assert sharding.sharded(df.limit(0), 1000).count() == 0


def test_raking_meets_all_marginals_and_equals_numpy(spark):
    rng = np.random.default_rng(3)
    n = rng.integers(1, 1000, (4, 3, 2))
    cells = spark.createDataFrame([(f"s{a}" if a else None, f"l{b}", f"t{c}", int(n[a, b, c])) for a in range(4) for b in range(3) for c in range(2)],
                                  "s string, l string, t string, n long")
    targets = {"s": {None: 0.4, "s1": 0.3, "s2": 0.2, "s3": 0.1}, "l": {"l0": 0.5, "l1": 0.25, "l2": 0.25}, "t": {"t0": 0.9}}
    got = mixing.raked(cells, ["s", "l", "t"], "n", targets).collect()
    w, goals = n.astype(float), [np.array([0.4, 0.3, 0.2, 0.1]), np.array([0.5, 0.25, 0.25]), np.array([0.9, 0.1])]
    for _ in range(200):
        for axis, g in enumerate(goals):
            other = tuple(i for i in range(3) if i != axis)
            shape = [1, 1, 1]
            shape[axis] = -1
            w *= (g / w.sum(axis=other)).reshape(shape)
    for r in got:
        a, b, c = 0 if r.s is None else int(r.s[1]), int(r.l[1]), int(r.t[1])
        assert r.n * r.factor == pytest.approx(w[a, b, c], rel=1e-6)


def test_probabilities_draws_and_odd_rows(spark):
    rows = [(i, "ab"[i % 3 == 0], [None, "en", "fr"][i % 3], "w " * (i % 50)) for i in range(3000)] + [(5, "z", "en", None), (None, None, None, "x @")]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, text string").withColumn("kept", F.lit("own"))
    out = mixing.mixed(mixing.with_topic(df)).collect()
    assert len(out) == len(rows) and all(0 < r.probability <= 1 for r in out) and max(r.probability for r in out) == 1
    for r in out:
        draw = int(hashlib.md5(f"42:{'' if r.doc_id is None else r.doc_id}".encode()).hexdigest()[:12], 16) / 2**48
        assert r.kept == (draw < r.probability)
    picked = mixing.sampled(df)
    assert picked.columns == df.columns and picked.count() == sum(r.kept for r in out)
    assert mixing.sampled(df.limit(0)).count() == 0


def test_kept_tokens_come_near_the_targets(spark):
    df = spark.range(40_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 4)).alias("source"),
                                    F.lit("en").alias("lang"), F.lit("prose").alias("topic"), F.lit(10).cast("long").alias("n_tokens"))
    out = mixing.mixed(df, targets={"source": {"hot": 0.1}}).where("kept").groupBy("source").count().collect()
    total = sum(r["count"] for r in out)
    assert {r.source: r["count"] for r in out}["hot"] / total == pytest.approx(0.1, abs=0.01)


def test_one_stray_document_does_not_lower_the_rest(spark):
    import corpus_pipeline
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("source"),
                                  F.when(F.col("id") % 5 == 0, "fr").otherwise("en").alias("lang"), F.lit("w " * 10).alias("text"))
    stray = spark.createDataFrame([(9999, "new", "xx", "w " * 10)], "doc_id long, source string, lang string, text string")
    alone, beside = ({r.doc_id for r in corpus_pipeline.mix(spark, d, "").collect()} for d in (df, df.union(stray)))
    assert 9999 in beside and len(alone ^ (beside - {9999})) <= 10
    assert len(alone) / 4000 == pytest.approx(corpus_pipeline.KEEP, abs=0.03)


def test_a_budget_is_kept_and_rare_values_give_all(spark):
    cells = spark.createDataFrame([("a", "x", 600), ("a", "y", 200), ("b", "x", 100), ("b", "y", 90), ("c", "y", 10)], "s string, l string, n long")
    got = {(r.s, r.l): (r.n, r.factor) for r in mixing.raked(cells, ["s", "l"], "n", {"s": {"a": 0.5, "b": 0.3, "c": 0.2}}, keep=0.5).collect()}
    assert sum(n * p for n, p in got.values()) == pytest.approx(500, rel=1e-6) and got["c", "y"][1] == pytest.approx(1)
    kept = {s: sum(n * p for (v, _), (n, p) in got.items() if v == s) for s in "abc"}
    assert kept["b"] == pytest.approx(490 * 0.3 / 0.8, rel=1e-6) and max(p for _, p in got.values()) <= 1
