import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from public_tokenizers import path
from tokenizers import Tokenizer

from geotrace.llm import packing
from geotrace.llm.tokens import Encoder

FILE = path("word_bpe_49k.json")
PLAIN = Tokenizer.from_file(FILE)


def ids_of(text, end=2):
    return [*PLAIN.encode(text or "", add_special_tokens=False).ids, end]


def check(pieces, docs, window):
    """Each id lies in one piece; sequences are gapless, and full but for power-of-two lengths."""
    texts = {i: ids_of(t) for i, t in docs}
    copies = Counter(i for i, _ in docs)
    spent, fill = Counter(), defaultdict(list)
    for p in pieces:
        own = texts[p.doc_id][p.start : p.start + p.length]
        assert p.length == len(own) > 0 and p.doc_tokens == len(texts[p.doc_id])
        assert p.ids_crc32 == zlib.crc32(np.array(own, "<u4").tobytes())
        assert "ids" not in p or list(p.ids) == own
        spent.update((p.doc_id, j) for j in range(p.start, p.start + p.length))
        fill[p.sequence_id].append((p.offset, p.length))
    assert spent == Counter({(i, j): copies[i] for i in copies for j in range(len(texts[i]))})
    for spans in fill.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at == window or at < window and at & (at - 1) == 0


DOCS = [(i, [None, "a", "b"][i % 3], " ".join(f"word{(i * j) % 71}{'é!'[j % 2]}" for j in range(i * 11 % 140))) for i in range(90)]
DOCS += [(200, "a", None), (201, "rare", ""), (202, "rare", "don't ♥ ١٢٣ 漢字\x1c!\x1c x y"), (203, "b", "x" * 5000), (203, "b", "x" * 5000)]


@pytest.mark.parametrize("window, targets", [(256, None), (512, {"a": 0.6, None: 0.1}), (64, {"a": 0.001})])
def test_every_token_lies_in_one_piece(spark, window, targets):
    df = spark.createDataFrame(DOCS, "doc_id long, source string, text string").repartition(5, "doc_id")
    pieces = packing.pack(df, FILE, window, targets=targets).collect()
    check(pieces, [(d[0], d[2]) for d in DOCS], window)
    source = {d[0]: d[1] for d in DOCS}
    assert all(p.source == source[p.doc_id] for p in pieces)


def test_windows_hold_the_target_shares(spark):
    df = spark.createDataFrame([(i, "ab"[i % 2], "word " * 200) for i in range(80)], "doc_id long, source string, text string")
    pieces = packing.pack(df, FILE, 256, targets={"a": 0.75}).collect()
    for w in range(20):
        got = Counter()
        for p in pieces:
            if p.sequence_id == w:
                got[p.source] += p.length
        assert got == {"a": 192, "b": 64}


def test_schedule_spends_all_and_stays_within_a_token_of_the_shares():
    rng = np.random.default_rng(5)
    for _ in range(30):
        left = rng.integers(0, 9000, rng.integers(1, 9)).tolist()
        shares = (rng.random(len(left)) + 0.05).tolist()
        segments = packing.schedule(left, shares, 128)
        spent = [0] * len(left)
        for first, n, base, edges in segments:
            assert base.tolist() == spent
            shift = 33 - (128).bit_length()
            before = [(n * int(b) >> shift) - (n * int(a) >> shift) for a, b in zip(edges, edges[1:], strict=False)]
            assert min(before) >= 0
            spent = [s + x for s, x in zip(spent, before, strict=True)]
        assert spent == left


def test_many_small_sources_share_a_queue(spark):
    df = spark.createDataFrame([(i, f"s{i}", "some words here") for i in range(150)] + [(999, "big", "w " * 9000)],
                               "doc_id long, source string, text string").repartition(4)
    rows = df.collect()
    check(packing.pack(df, FILE, 64).collect(), [(r.doc_id, r.text) for r in rows], 64)


def test_sequences_and_empty_table(spark):
    df = spark.createDataFrame(DOCS, "doc_id long, source string, text string")
    whole = packing.sequences(packing.pack(df, FILE, 128)).collect()
    assert sum(len(r.ids) for r in whole) == sum(len(ids_of(d[2])) for d in DOCS)
    assert packing.pack(df.limit(0), FILE).count() == 0


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_equals_the_tokenizer(name, monkeypatch):
    monkeypatch.setattr("geotrace.llm.tokens.CACHED", 40)
    own, plain = Encoder(path(name)), Tokenizer.from_file(path(name))
    texts = [d[2] or "" for d in DOCS] + ["It's WE'RE 'S a's! --x-- \r\n\x0b  ÀÉ ǅ İstanbul ΣΑΣ ﬁ é <|endoftext|>z", "  ", "\n"]
    for t in texts:
        assert np.frombuffer(own.encode(t), own.type).tolist() == plain.encode(t, add_special_tokens=False).ids


def shares_by_span(pieces, span):
    got = defaultdict(Counter)
    for p in pieces:
        got[p.sequence_id // span][p.source] += p.length
    return got


def test_pooled_sources_keep_their_shares_over_spans_of_windows(spark):
    rows = [(i, f"s{i // 60}", "word " * 9) for i in range(2400)]  # 40 sources one after the other, each below 2 of 64 tokens
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").coalesce(2)
    pieces = packing.pack(df, FILE, 64).collect()
    check(pieces, [(i, t) for i, _, t in rows], 64)
    spans = shares_by_span(pieces, 50)
    for k in sorted(spans)[:-1]:
        assert len(spans[k]) == 40 and all(abs(n / 3200 - 1 / 40) <= 10 / 3200 for n in spans[k].values())


def test_small_targets_are_honoured(spark):
    rows = [(i, "rare" if i < 300 else "big", "word " * 9) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").coalesce(2)
    spans = shares_by_span(packing.pack(df, FILE, 64, targets={"rare": 0.02}).collect(), 100)
    for k in range(3):
        assert spans[k]["rare"] / 6400 == pytest.approx(0.02, abs=0.005)
