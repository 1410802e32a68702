import numpy as np
import pytest
from pyspark.sql import functions as F

from geotrace.llm import minhash


def brute(rows, shingle=4, percent=80):
    sets = []
    for key, text in rows:
        w = [x for x in (text or "").encode().lower().split()]
        sets.append((key, {b" ".join(w[i:i + shingle]) for i in range(max(1, len(w) - shingle + 1))} if w else set()))
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(sets):
        least[find(i)] = min(least.get(find(i), (True, 0)), (key is None, key or 0))
    return sorted(((key, len(s), (None if least[find(i)][0] else least[find(i)][1]) if s else key)
                   for i, (key, s) in enumerate(sets)), key=repr)


def run(spark, rows, **more):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in minhash.near_groups(df, shingle=4, **more).collect()), key=repr)


def family(rng, size, length, edits, vocabulary=5000):
    base = [f"w{x}" for x in rng.integers(0, vocabulary, length)]
    out = []
    for _ in range(size):
        w = list(base)
        for _ in range(int(rng.integers(0, edits))):
            w[int(rng.integers(0, len(w)))] = f"x{rng.integers(0, 10**9)}"
        out.append(" ".join(w))
    return out


def corpus(seed):
    rng = np.random.default_rng(seed)
    passage = " ".join(f"p{x}" for x in rng.integers(0, 5000, 60))
    texts = family(rng, 120, 200, 9)  # similarities on both sides of the limit
    texts += family(rng, 60, 30, 3) + family(rng, 40, 6, 2)
    texts += [passage + " " + " ".join(f"q{x}" for x in rng.integers(0, 10**6, int(n))) for n in rng.integers(5, 80, 60)]  # shared passage
    texts += texts[:30] + [texts[0]] * 40  # copies
    texts += [t.upper() for t in texts[5:9]] + ["", "  \n\t ", None, None, "a", "A", "a b", "a b c", "a b c d", "a b c d e", "b c d e f"]
    order = rng.permutation(len(texts))
    return [(int(i), texts[i]) for i in order]


@pytest.mark.parametrize("seed, long, shingles", [(1, 4096, 1 << 20), (2, 16, 3000)])  # the second deals lists and components over blocks
def test_equals_brute_force(spark, monkeypatch, seed, long, shingles):
    monkeypatch.setattr(minhash, "LIST", long)
    monkeypatch.setattr(minhash, "SHINGLES", shingles)
    rows = corpus(seed)
    assert run(spark, rows) == brute(rows)


def test_long_lists_meet_in_every_pair_of_blocks_but_not_inside_the_main_component():
    ids = np.arange(50)
    component, cells = np.where(ids < 30, 7, ids), np.zeros(50, np.int64)
    main = {"cell": np.array([0]), "most": np.array([7]), "inside": np.array([30]), "outside": np.array([20])}
    met, copies = set(), np.zeros(50, int)
    by_part = {}
    for k, part in minhash._cells(ids, component, cells, main, 4):
        for i, p in zip(k.tolist(), part.tolist(), strict=True):
            by_part.setdefault(p, set()).add(i)
            copies[i] += 1
    for group in by_part.values():
        met |= {(a, b) for a in group for b in group if a < b}
    assert {(a, b) for a in range(50) for b in range(a + 1, 50) if b >= 30} <= met
    assert copies[:30].max() == 5 and copies[30:].max() == 13  # blocks outside; all blocks


def test_forests_are_linear_and_complete(spark):
    rng = np.random.default_rng(3)
    sign = rng.integers(0, 1 << 32, minhash.COORDINATES, dtype=np.uint64).astype("<u4").tobytes()
    df = spark.createDataFrame([(i, 10, bytearray(sign)) for i in range(50)], "class long, n long, signature binary")  # every list has all
    counts = spark.sparkContext.broadcast(minhash.pair_counts(df))
    pairs = minhash.candidate_forest(minhash.posted_once(df, counts, 4096), 80).collect()
    assert len(pairs) == 49 and {r["b"] for r in pairs} == set(range(1, 50))
    sets = [np.sort(rng.choice(60, 40, replace=False)).astype(np.uint64) for _ in range(80)]
    label = minhash._linked(sets, 60)
    root = list(range(80))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(80):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 60 * (80 - both):
                root[max(find(i), find(j))] = min(find(i), find(j))
    assert label.tolist() == [find(i) for i in range(80)] and len(set(label.tolist())) > 1


def test_wide_and_long_texts_extra_columns_and_repeated_ids(spark):
    text = " ".join(f"w{i}" for i in range(120_000))
    rows = [(3, text), (1, text + " more"), (1, "x " + text), (None, text), (2, None)]
    assert run(spark, rows) == brute(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in (
        "n", "n_", "set_key", "set_key_", "signature_", "class", "hot", "salt", "other", "component_id", "values", "first", "root")})
    out = minhash.near_groups(df)
    assert set(out.columns) == {*df.columns} - {"text"} | {"n_shingles"} and {r["other"] for r in out.collect()} == {"x"}


def test_empty_table_and_null_ids(spark):
    assert run(spark, []) == []
    rows = [(None, "a b c d e"), (None, "a b c d e"), (None, ""), (4, "a b c d e")]
    assert run(spark, rows) == brute(rows)


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(4)
    u = rng.integers(0, 1 << 63, 1200, dtype=np.uint64)
    same = [(minhash.signature(np.unique(rng.permutation(u)[:1000])) == minhash.signature(u)).mean() for _ in range(60)]
    assert abs(np.mean(same) - 1000 / 1200) < 0.03
