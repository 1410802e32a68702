import re

import pytest

from geotrace.llm import quality_rules as Q

COLUMNS = [*Q.STATS, "base_failed", "kept"]


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = {}
    for i in range(len(w) - 2):
        seen.setdefault(tuple(w[i:i + 3]), []).append(i)
    repeat = {p for at in seen.values() if len(at) > 1 for i in at for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeat))


TEXTS = [None, "", " \n\t ", "one", "a b", "a b c", "a b c a b c", "a a a a a", "x y\nx y\n\nx y ", "é ü ß 漢字 #*$ <a>|b&c %",
         "a b c d a b c e b c d", " ".join(f"w{i}" for i in range(60)), "dup line\n" * 40, " ".join("ab" for _ in range(500)),
         " ".join(f"w{i % 97}" for i in range(20_000))]


def test_counts_equal_brute_force(spark):
    df = spark.createDataFrame([(i, "h", t, 1.5) for i, t in enumerate(TEXTS)], "doc_id long, source string, text string, n_words double")
    got = {r.doc_id: r for r in Q.judged(df).collect()}
    for i, t in enumerate(TEXTS):
        want = brute(t)
        assert tuple(got[i][c] for c in Q.STATS) == want, (i, want)
        assert got[i].base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])


def test_host_verdict_is_shrunk_and_joined_back(spark):
    good, bad = " ".join(f"w{i}" for i in range(60)), "short"
    rows = [("g", good)] * 60 + [("g", bad)] * 2 + [("b", bad)] * 40 + [("b", good)] * 3 + [(None, good)] * 5 + [("one", good)]
    df = spark.createDataFrame([(i, s, t) for i, (s, t) in enumerate(rows)], "doc_id long, source string, text string")
    got = Q.judged(df).collect()
    assert {(r.source, r.kept) for r in got if not r.base_failed} == {("g", True), ("b", False), (None, True), ("one", True)}
    assert not any(r.kept for r in got if r.base_failed)
    rates = {r.host: r for r in Q.host_rates(Q.judged(df), "source").collect()}
    raw, n = {}, {}
    for s in ("g", "b", None, "one"):
        mine = [t == bad for h, t in rows if h == s]
        raw[s], n[s] = sum(mine) / len(mine), len(mine)
    mean = sum(raw.values()) / 4
    var = sum((x - mean) ** 2 for x in raw.values()) / 4 - mean * (1 - mean) * sum(1 / x for x in n.values()) / 4
    strength = max(mean * (1 - mean) / var - 1, 1)
    assert all(r.rate_base == pytest.approx((raw[h] * n[h] + mean * strength) / (n[h] + strength)) for h, r in rates.items())


def test_a_host_that_fails_one_rule_far_more_than_others_goes_and_chance_alone_makes_none_go(spark):
    good, odd = " ".join(f"w{i}" for i in range(60)), " ".join(f"w{i}" for i in range(60)) + " ########"
    rows = [(f"h{i % 30}", odd if i % 30 == 7 and i % 2 or i % 61 == 0 else good) for i in range(3000)]
    df = spark.createDataFrame([(i, s, t) for i, (s, t) in enumerate(rows)], "doc_id long, source string, text string")
    got = Q.judged(df).collect()
    assert not any(r.base_failed for r in got) and {r.source for r in got if not r.kept} == {"h7"}
    even = df.withColumn("source", df.doc_id.cast("int").cast("string").substr(-1, 1))
    assert all(r.kept for r in Q.judged(even).collect())


def test_sql_twin_rejects_the_same_hosts(spark):
    import duckdb
    good, odd, short = " ".join(f"w{i}" for i in range(60)), " ".join(f"w{i}" for i in range(60)) + " #########", "short text"
    rows = [(i, None if i % 23 == 5 else f"h{i % 23}", odd if i % 23 == 7 else short if i % 23 == 9 and i % 3 else good if i % 17 else odd) for i in range(900)]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, source VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    want = {r[0]: r[1] for r in con.execute(f"WITH {Q.rules_sql()} SELECT doc_id, kept FROM judged").fetchall()}
    got = {r.doc_id: r.kept for r in Q.judged(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()}
    assert got == want and {s for i, s, _ in rows if not got[i] and s != "h9"} >= {"h7"}


def test_accepted_returns_the_columns_as_they_came(spark):
    good = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(1, "a", good, "x", 7), (1, "a", good, "x", 7), (2, "a", "no", "y", 8)],
                               "doc_id long, source string, text string, kept string, n_words int")
    assert sorted(map(tuple, Q.accepted(df).collect())) == [(1, "a", good, "x", 7)] * 2
    assert Q.accepted(df.limit(0)).count() == 0 and Q.judged(df.limit(0)).count() == 0
