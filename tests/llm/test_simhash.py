import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from geotrace.llm import simhash
from geotrace.llm.components import components


def brute(texts, shingle=4):
    out = {}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        h = [xxhash.xxh64_intdigest(b" ".join(w[j:j + shingle]), 42) for j in range(max(1, len(w) - shingle + 1))] if w else []
        out[i] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    return out


def groups(codes, near):
    root = {c: c for c in codes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(codes):
        for b in codes[:i]:
            if near(a, b):
                ra, rb = find(a), find(b)
                root[max(ra, rb)] = min(ra, rb)
    return {c: find(c) for c in codes}


def dense(seed, centres, each, flips):
    rng = np.random.default_rng(seed)
    out = set()
    for c in rng.integers(0, 2**63, centres, dtype=np.uint64):
        for _ in range(each):
            x = int(c)
            for j in rng.integers(0, 64, rng.integers(0, flips)):
                x ^= 1 << int(j)
            out.add(x)
    return sorted(out)


def test_gray_rank_orders_by_one_bit_steps():
    rank = simhash.gray_rank(np.arange(1024, dtype=np.uint64))
    ordered = np.argsort(rank)
    assert all((int(a) ^ int(b)).bit_count() == 1 for a, b in zip(ordered, ordered[1:], strict=False))


def test_forest_finds_exactly_the_links_of_each_bucket():
    codes = dense(1, 6, 80, 9)
    bucket = np.random.default_rng(2).integers(0, 3, len(codes))
    a, b = simhash.forest(np.array(codes, np.uint64), bucket, 4)
    of = dict(zip(codes, bucket.tolist(), strict=True))
    want = groups(codes, lambda x, y: of[x] == of[y] and (x ^ y).bit_count() <= 4)
    pairs = {(int(x), int(y)) for x, y in zip(a, b, strict=True)}
    got = groups(codes, lambda x, y: (x, y) in pairs or (y, x) in pairs)
    assert len({*got.values()}) == len({*want.values()})
    assert all((got[x] == got[y]) == (want[x] == want[y]) for x in codes[::7] for y in codes)


@pytest.mark.parametrize("limit", [2048, 3])
def test_links_are_whole_also_when_buckets_are_routed_on(spark, limit):
    codes = dense(3, 4, 40, 8)
    df = spark.createDataFrame([(c - (1 << 64) if c >> 63 else c,) for c in codes], "code long")
    got = {r.vertex: r.root for r in components(simhash.links(df, "code", 4, limit), "a", "b").collect()}
    want = groups(codes, lambda x, y: (x ^ y).bit_count() <= 4)
    root = {c: got.get(s, s) for c in codes for s in [c - (1 << 64) if c >> 63 else c]}
    for x in codes:
        for y in codes[::5]:
            assert (root[x] == root[y]) == (want[x] == want[y])


def test_groups_of_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(300))
    rows = [(5, long, "a"), (3, long, "b"), (3, long, "b"), (None, long, "c"), (9, None, None), (8, "  \n\t", "d"), (7, "Ab cD", "e"),
            (6, "aB\tCd", "f"), (4, long + " tail", "g"), (2, "É é", "h")]
    df = spark.createDataFrame(rows, "doc_id long, text string, Fingerprint string")
    got = simhash.near_groups(df).collect()
    fp = brute({i: r[1] for i, r in enumerate(rows)})
    want = groups(sorted({*fp.values()}), lambda x, y: (x ^ y).bit_count() <= 4)
    for r in got:
        same = [x[0] for i, x in enumerate(rows) if want[fp[i]] == want[int(r.fingerprint, 16)] and x[0] is not None]
        assert r.component_id == (min(same) if same else None)
    assert sorted(r.fingerprint for r in got) == sorted(f"{x:016x}" for x in fp.values())
    assert sum(r.is_representative for r in got) == len({*want.values()})
    kept = simhash.deduplicated(df)
    assert kept.columns == df.columns and kept.count() == len({*want.values()})
    assert kept.where("text = '%s'" % long).count() <= 1


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_groups(df).count() == 0 and simhash.deduplicated(df).count() == 0


def test_components_of_a_long_chain(spark):
    n = 200
    edges = spark.range(n - 1).select(F.col("id").alias("x"), (F.col("id") + 1).alias("y"))
    got = components(edges, "x", "y").collect()
    assert {r.vertex for r in got} == set(range(1, n)) and {r.root for r in got} == {0}
