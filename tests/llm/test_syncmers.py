import hashlib

import pytest
from pyspark.sql import functions as F

from geotrace.llm import syncmers as S


def test_edits_and_next_documents_follow_descending_ids(spark):
    texts = {i: " ".join(f"w{(i * j) % 131}" for j in range(i * 7 % 90 + 1)) for i in range(0, 400, 3)}
    texts |= {1: "", 4: "x", 7: "漢字 é" * 9}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r for r in S.edited_pairs(df).collect()}
    order = sorted(texts, reverse=True)
    for i, a in enumerate(order):
        t, n = texts[a], texts[order[(i + 1) % len(order)]]
        edited = t[: len(t) - len(t) // 2] + n[: len(t) // 2]
        assert got[a].n_chars == len(t) and got[a].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert got[order[(i + 1) % len(order)]].fingerprint != got[a].fingerprint or got[a].near_next == 1
        assert (got[a].fingerprint == got[a].edited_fingerprint) == (got[a].near_edited == 1)
        assert 0 <= got[a].near_edited <= 1 and 0 <= got[a].near_next <= 1


def brute_anchors(spark, words, k=S.K, s=S.S):
    """By definition: the least hash of the inner s-word substrings lies at an edge."""
    inner = spark.createDataFrame([(i, words[i], words[i + 1]) for i in range(len(words) - s + 1)], "i int, a string, b string")
    h = {r.i: r.h for r in inner.select("i", F.xxhash64(F.xxhash64("a"), F.xxhash64("b")).alias("h")).collect()}
    out = []
    for i in range(len(words) - k + 1):
        own = [h[j] for j in range(i, i + k - s + 1)]
        if min(own) in (own[0], own[-1]):
            out.append(i)
    return out


def test_anchors_are_closed_syncmers_and_context_free(spark):
    words = [f"w{i * i % 89}" for i in range(60)]
    passage = " ".join(words)
    df = spark.createDataFrame([(0, passage), (1, "before it all " + passage + " and after"), (2, None), (3, "a b"), (4, "a b c d e")],
                               "doc_id long, text string")
    got = {r.doc_id: r.a for r in df.select("doc_id", S.anchors(F.col("text")).alias("a")).collect()}
    assert [a.position for a in got[0]] == brute_anchors(spark, words)
    assert {(a.position + 3, a.hash) for a in got[0]} <= {(a.position, a.hash) for a in got[1]}
    assert got[2] == [] and len(got[3]) == 1 and len(got[4]) <= 1


def test_likeness_of_equal_empty_and_half_changed_texts(spark):
    a, b = " ".join(f"a{i}" for i in range(2000)), " ".join(f"b{i}" for i in range(2000))
    df = spark.createDataFrame([(a, a), (a, b), ("", ""), ("", a), (a, a[: len(a) // 2] + b[: len(b) // 2])], "x string, y string")
    got = [r[0] for r in df.select(S.likeness(S.sketch(F.col("x")), S.sketch(F.col("y")))).collect()]
    assert got[:4] == [1, 0, 1, 0] and got[4] == pytest.approx(1 / 3, abs=0.12)


def test_next_rows_over_ties_nulls_and_many_cuts(spark):
    rows = [(None, "n")] + [(i % 17, f"t{i:03}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = sorted((a[1], b[1]) for a, b in zip(order, order[1:] + order[:1], strict=True))
    for chunks in (1, 7, 64):
        got = S.with_next(df, "doc_id", ["text"], chunks).collect()
        assert sorted((r.text, r.next_text) for r in got) == want
    assert S.edited_pairs(df.limit(0)).count() == 0
    assert S.edited_pairs(df.limit(1)).first().near_next == 1


def test_long_texts_share_a_short_passage_exactly(spark):
    passage = " ".join(f"p{i}" for i in range(50))
    a, b = (" ".join(f"{c}{i}" for i in range(3000)) + " " + passage for c in "ab")
    df = spark.createDataFrame([(2, a), (1, b)], "doc_id long, text string")
    codes = {r.doc_id: {h.hash >> 33 & 0x7FFFFFFF for h in r.a} for r in df.select("doc_id", S.anchors(F.col("text")).alias("a")).collect()}
    want = len(codes[1] & codes[2]) / len(codes[1] | codes[2])
    got = {r.doc_id: r for r in S.edited_pairs(df).collect()}
    assert want > 0 and got[1].near_next == got[2].near_next == pytest.approx(want)
    assert len(got[1].fingerprint) == 8 * len(codes[1]) > 8 * S.SIZE
