import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from geotrace.llm import vector_codes as vc
from geotrace.llm.skew import salted_join


def brute(rows, parts, entries, rounds=2):
    """rows: (id, list of ints, label) in id order; plain loops over Python integers."""
    width = len(rows[0][1]) // parts
    cut = [[tuple(v[p * width:(p + 1) * width]) for p in range(parts)] for _, v, _ in rows]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def assign(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), i) for i, e in enumerate(book))
    for _ in range(rounds):
        for p, book in enumerate(books):
            members = {}
            for c in cut:
                members.setdefault(assign(c[p], book)[1], []).append(c[p])
            books[p] = [tuple(sum(x) // len(x) for x in zip(*members[i], strict=True)) if i in members else e for i, e in enumerate(book)]
    out, by_label = {}, {}
    for (key, _, label), c in zip(rows, cut, strict=True):
        best = [assign(c[p], books[p]) for p in range(parts)]
        out[key] = ("".join(f"{i:02x}" for _, i in best), sum(d for d, _ in best), label)
        by_label[label] = by_label.get(label, 0) + out[key][1]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return {k: (c, e, by_label[label], sha) for k, (c, e, label) in out.items()}


def run(spark, rows, **more):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    out, _ = vc.compressed(df.repartition(3), **more)
    return {r["vec_id"]: (r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in out.collect()}


@pytest.mark.parametrize("scale", [1, 1e5])  # the second is beyond the 64-bit path
def test_equals_brute_force(spark, scale):
    rng = np.random.default_rng(1)
    v = np.round(rng.normal(0, 4, (400, 12)), 1) / 8 * scale
    v[::3] = v[0]  # one vector holds a third of the rows
    rows = [(i, v[i].tolist(), None if i % 7 == 0 else i % 3) for i in range(400)]
    whole = [(i, [int(x) for x in np.floor(256 * v[i])], label) for i, _, label in rows]
    assert run(spark, rows, parts=4, entries=9) == brute(whole, 4, 9)


def test_trie_equals_all_distances_with_ties():
    rng = np.random.default_rng(2)
    parts, at, count = vc.distinct_parts(rng.integers(-3, 4, (20000, 5)))
    assert count.sum() == 20000 and (np.diff(np.lexsort(parts.T[::-1])) == 1).all()
    entries = rng.integers(-3, 4, (40, 5))
    gaps = ((parts[:, None, :] - entries[None]) ** 2).sum(-1)
    best, far = vc.nearest(parts, entries)
    assert (best == gaps.argmin(1)).all() and (far == gaps.min(1)).all()


def test_unusable_vectors_go_and_few_rows_make_few_entries(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(5, [1.0, 2.0], 1), (3, [-0.001, 0.5], None), (1, None, 1), (2, [None, 1.0], 1), (4, [nan, 1.0], 1), (6, [inf, 1.0], 1), (7, [], 1), (8, [1.0], 1)]
    assert run(spark, rows, parts=2) == brute([(3, [-1, 128], None), (5, [256, 512], 1)], 2, 64)
    assert run(spark, []) == {} and run(spark, rows[2:5]) == {}


def test_repeated_and_null_ids_extra_columns_and_uneven_parts(spark):
    rows = [(None, [1.0, 2.0, 3.0], 1), (1, [1.0, 2.0, 3.0], 1), (1, [0.0, 0.0, 1e300], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumns(
        {c: F.lit("x") for c in ("code", "error", "label_error", "codebooks_sha256", "group_", "n", "n_", "other")})
    out, books = vc.compressed(df, parts=2, entries=2)
    assert {r["other"] for r in out.collect()} == {"x"} and out.count() == 3 and books.cuts == [0, 2, 3]
    assert {r["error"] for r in out.collect()} <= {0, vc.LONG_MAX}


def test_salted_join_loses_and_repeats_no_row(spark):
    rows = spark.range(30000).select(F.when(F.col("id") % 3 > 0, F.col("id") % 50).alias("k"), "id")
    keyed = spark.range(60).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")).union(spark.sql("SELECT CAST(NULL AS LONG), -1L"))
    out = salted_join(rows, keyed, "k", rows.groupBy("k").agg(F.count("*").alias("n")), least=100)
    assert out.count() == 30000 and out.select("id").distinct().count() == 30000
    assert out.where("v <> coalesce(k * 2, -1)").count() == 0 and out.where("k IS NULL").count() == 10000
