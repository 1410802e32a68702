import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from geotrace.llm import spelling


def brute(rows, min_length=7, min_count=2, ratio=10):
    words = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            if len(run) >= min_length:
                words[run] += 1
    words = {w: n for w, n in words.items() if n >= min_count}

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))
    out = {}
    for w, n in words.items():
        found = sorted((-m, v) for v, m in words.items() if near(w, v))
        form = found[0] if found and -found[0][0] >= ratio * n else None
        out[w] = (form and form[1], n, len(found), form and -form[0])
    result = {}
    for w, (form, n, n_near, form_n) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        result[w] = (form, root, n, n_near, form_n)
    return result


def run(spark, rows, **more):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in spelling.variants(df, **more).collect()}


def test_equals_brute_force_with_chains_ties_and_latin_letters(spark):
    rng = np.random.default_rng(5)
    stems = ["caminhos", "Trajetória", "posições", "ÀÉÎÕÜßÿabc", "abcdefgh", "zzzzzzzz"]
    rows = []
    for i in range(300):
        words = []
        for _ in range(40):
            w = stems[min(int(rng.exponential(1.5)), len(stems) - 1)]
            for _ in range(int(rng.integers(0, 8) == 0) + int(rng.integers(0, 30) == 0)):
                at, c = int(rng.integers(0, len(w))), "aeé÷×"[int(rng.integers(0, 5))]
                w = [w[:at] + w[at + 1:], w[:at] + c + w[at:], w[:at] + c + w[at + 1:]][int(rng.integers(0, 3))]
            words.append(w)
        rows.append((i, " ".join(words)))
    rows += [(1000, "centers" * 1 + " " + "centers " * 300), (1001, "centerss " * 20), (1002, "centersss centersss"), (None, None), (7, ""), (7, "ab cd")]
    got, want = run(spark, rows), brute(rows)
    assert got == want
    assert any(v[0] and v[1] != v[0] for v in want.values())  # a chain of two forms


def test_neighbourhood_holds_every_reduced_one_edit_word():
    table = spelling._symbol_table()
    rng = np.random.default_rng(3)
    letters = [chr(c) for c in [*range(97, 123), *range(0xc0, 0x100)]]

    def value(w):
        s = spelling._reduced(w, table)
        return int((s * spelling._powers(len(s))).sum(dtype=np.uint64))
    for _ in range(50):
        w = "".join(rng.choice(letters, int(rng.integers(7, 20))))
        near = {int(x) for x in spelling.neighbourhood(spelling._reduced(w, table))}
        at, c = int(rng.integers(0, len(w))), str(rng.choice(letters))
        assert {value(w), value(w[:at] + w[at + 1:]), value(w[:at] + c + w[at:]), value(w + c), value(w[:at] + c + w[at + 1:])} <= near
        assert len(near) <= 1 + len(w) * (1 + 7) + (len(w) + 1) * 8


def test_very_long_words_and_very_common_ones(spark):
    long = "abcdefghij" * 4000
    rows = [(i, long + " " + "frequent " * 5000) for i in range(5)] + [(9, f"{long[:-1]} {long[:-1]}"), (10, f"{long[:20000]}x{long[20000:]} " * 3)]
    assert run(spark, rows, drop_every=1 << 40) == {
        "frequent": (None, "frequent", 25000, 0, None), long: (None, long, 5, 2, None),
        long[:-1]: (None, long[:-1], 2, 1, None), f"{long[:20000]}x{long[20000:]}": (None, f"{long[:20000]}x{long[20000:]}", 3, 1, None)}


def test_empty_tables_repeated_rows_and_clashing_columns(spark):
    assert run(spark, []) == {}
    rows = [(1, "balloons")] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {c: F.lit("x") for c in ("word", "form", "root", "n", "id", "reduced")})
    assert [(r["word"], r["n"], r["root"]) for r in spelling.variants(df).collect()] == [("balloons", 3, "balloons")]
