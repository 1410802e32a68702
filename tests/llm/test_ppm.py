import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from geotrace.llm import ppm


def trained(texts):
    counts = [defaultdict(Counter) for _ in range(ppm.ORDER + 1)]
    for t in texts:
        s = ppm.PAD + ppm.normalised((t or "").encode())
        for j in range(ppm.ORDER, len(s)):
            for k in range(ppm.ORDER + 1):
                counts[k][s[j - k : j]][s[j]] += 1
    return counts


def log_p(counts, context, byte):
    out, gone = 0.0, set()
    for k in range(ppm.ORDER, -1, -1):
        left = {b: n for b, n in counts[k].get(context[ppm.ORDER - k :], {}).items() if b not in gone}
        if left:
            room = sum(left.values())
            if byte in left:
                return out + math.log10((left[byte] - 0.5) / room)
            out += math.log10(0.5 * len(left) / room)
            gone |= set(left)
    return out - math.log10(256 - len(gone))


TEXTS = {i: " ".join(f"{'the of and is'.split()[i * j % 4]} Wörd{(i * j) % 13}{'.!'[j % 2]}" for j in range(i % 23)) for i in range(80)}
TEXTS |= {100: None, 101: "", 102: " \n ", 103: "\x00 ÿ 漢字 zzz", 104: "x" * 3000}


def test_scores_equal_brute_force(spark):
    rows = list(TEXTS.items()) + [(7, TEXTS[7]), (None, "the of")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    held = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in rows}
    counts = trained([t for i, t in rows if not held[i]])
    words = {i: [*(t or "").encode().lower().split(), b"\n"] for i, t in rows}
    c = Counter(w for i, _ in rows if not held[i] for w in words[i])
    n, v = sum(c.values()), len(c)
    got = ppm.scored(df).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(words[r.doc_id]), sum(w in c for w in words[r.doc_id]), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words[r.doc_id]))
        s = ppm.PAD + ppm.normalised((dict(rows)[r.doc_id] or "").encode())
        assert r.score == pytest.approx(sum(log_p(counts, s[j - ppm.ORDER : j], s[j]) for j in range(ppm.ORDER, len(s))))


def test_probabilities_after_a_context_sum_to_one():
    counts = trained(TEXTS.values())
    code = []
    for context in (b" the ", b"zzzzz", b"\n\n\n\n\n", b"xxxxx", b"\xff\xfe\xfd\xfc\xfb"):
        code += [int.from_bytes(context, "big") << 8 | b for b in range(256)]
    text = [ppm.normalised((t or "").encode()) for t in TEXTS.values()]
    own, start = ppm.codes_of(text)
    seen, n = np.unique(own[ppm._own(own, start)], return_counts=True)
    low = ppm._merge([seen & 0xFFFF], [n])
    both, counts_ = ppm._merge([seen, np.unique(code)], [n, np.zeros(len(set(code)), np.int64)])
    value = dict(zip(both.tolist(), ppm.log_probabilities(both, counts_, low), strict=True))
    for at in range(0, len(code), 256):
        assert sum(10 ** value[c] for c in code[at : at + 256]) == pytest.approx(1)
    context = b" the "
    assert value[int.from_bytes(context, "big") << 8 | ord("w")] == pytest.approx(log_p(counts, context, ord("w")))


def test_lookup_finds_all_and_raises_for_strangers():
    key = np.unique(np.random.default_rng(1).integers(0, 1 << 48, 5000))
    table = ppm.Lookup(key, key / 7)
    assert (table(key[::-1].copy()) == key[::-1] / 7).all()
    with pytest.raises(KeyError):
        table(np.array([key[0] + 1 if key[1] != key[0] + 1 else key[0] - 1]))


def test_adaptive_code_length_falls_with_repetition(spark):
    df = spark.createDataFrame([(1, "abc " * 200), (2, "".join(chr(97 + i * i * 7 % 26) for i in range(800))), (3, None)], "doc_id long, text string")
    got = {r.doc_id: r.score for r in ppm.scored_adaptive(df).collect()}
    assert got[2] < got[1] < 0 and got[3] == pytest.approx(-math.log10(256))


def test_blocks_of_any_size_and_empty_tables(spark, monkeypatch):
    df = spark.createDataFrame(list(TEXTS.items()), "doc_id long, text string").coalesce(1)
    whole = sorted(map(tuple, ppm.scored(df).collect()))
    schema = "block long, doc_ids array<long>, held array<boolean>, body binary, shard int, keys binary, counts binary"
    monkeypatch.setattr(ppm, "BLOCK", 3000)
    rows = df.selectExpr("doc_id", "false AS held", "text").mapInArrow(lambda b: ppm._blocks(b, 5), schema).collect()
    assert sorted(i for r in rows if r.shard is None for i in r.doc_ids) == sorted(TEXTS)
    assert {r.block for r in rows if r.shard is None} == {r.block for r in rows if r.shard is not None}
    again = sorted(map(tuple, ppm.scored(df.repartition(9)).collect()))
    assert [r[:5] for r in whole] == [r[:5] for r in again]
    assert np.allclose([r[5:] for r in whole], [r[5:] for r in again])
    assert ppm.scored(df.limit(0)).count() == 0
