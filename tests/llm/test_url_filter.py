import itertools
import math
import re

import pytest
from pyspark.sql import functions as F

from geotrace.llm import url_filter as U

URLS = [None, "", "no host", "http://", "http://a.net", "http://A.Net/", "http://a.net?x/y", "http://www.Example.NET/en/x#y", "http://xexample.net/en/x",
        "http://example.net/en", "https://m.example.com/de/1?q", "http://example.com/DE/1", "http://b.org/fr/", "http://org/fr/a://b", "x://y.org/fr?/",
        "http://cheapcasino.example.com/en/1", "http://free-bets.example.org/a", "http://u:p@a.net:80/", "mailto:x", "//a.net/", "a\nb://c.net/d\ne"]


def brute(url):
    _, found, rest = (url or "").partition("://")
    host = re.match(r"[^/?#]*", rest)[0] if found else ""
    path = re.match(r"[^?#]*", rest[len(host):])[0] if found else ""
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = []
    for said, rule in U.RULES:
        name, _, tail = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + tail):
            fits.append((len(rule), rule, said))
    return host, path, *(max(fits)[1:] if fits else (None, None))


def test_hosts_paths_and_rules(spark):
    df = spark.createDataFrame([(i, u, None, "own") for i, u in enumerate(URLS)], "page_id long, url string, html string, verdict string")
    clean = spark.range(100, 3000).selectExpr("id", "concat('https://blog', id % 7, '.example.org/en/page/', id)", "'<title>a blog page</title>'", "'own'")
    got = {r.page_id: r for r in U.judged(df.union(clean)).collect()}
    assert {got[i].verdict for i in range(100, 3000)} == {"allow"}
    for i, u in enumerate(URLS):
        host, path, rule, said = brute(u)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), u
        assert got[i].verdict == (said or ("block" if got[i].score > 0 else "allow"))
    assert got[15].verdict == got[16].verdict == "block" and got[0].verdict == got[11].verdict == "allow"
    assert U.judged(df.limit(0)).count() == 0


def test_viterbi_is_the_best_of_all_splits():
    counts, total = {"the": 50, "re": 9, "here": 4, "there": 2, "fore": 3, "e": 1, "for": 7}, 76

    def score(words):
        return sum(math.log((counts[w] if w in counts else 10 * 10.0 ** -len(w)) / total) for w in words)
    for run in ("therefore", "xxthe", "forere", "a"):
        known = [(i, n, counts[run[i : i + n]]) for i in range(len(run)) for n in range(1, len(run) - i + 1) if run[i : i + n] in counts]
        got = U.viterbi(run, *(zip(*known, strict=True) if known else ((), (), ())), total)
        splits = [[run[a:b] for a, b in zip((0, *c), (*c, len(run)), strict=True)] for k in range(len(run)) for c in itertools.combinations(range(1, len(run)), k)]
        assert "".join(got) == run and score(got) == pytest.approx(max(map(score, splits)))


@pytest.mark.parametrize("rules", [(), U.RULES])
def test_naive_bayes_scores_equal_brute_force_with_repeated_words(spark, rules):
    hosts = ["casino-win.com", "win-big.com", "good-news.com", "news-blog.com", "blog.biz"]
    urls = [f"http://{hosts[i % 5]}/{['shop', 'read', 'shop/read/shop'][i % 3]}/{'shop/' * (i % 4)}{i}" for i in range(40)]
    df = spark.createDataFrame([(i, u, "<title>casino win big good news blog</title>") for i, u in enumerate(urls)], "page_id long, url string, html string")
    got = U.judged(df, rules=rules, seed_block=("casino",), seed_weight=2, prior=-0.25).collect()
    stop = {w for _, r in rules for w in re.findall("[a-z]+", r)}
    tokens = [[w for w in re.findall("[a-z]+", u.split("//")[1].partition("/")[0]) + re.findall("[a-z]+", u.split("//")[1].partition("/")[2]) if w not in stop] + ["0"]
              for u in urls]
    block, allow = {"casino": 2}, {}
    for words in tokens:
        for w in words:
            side = block if "casino" in words else allow
            side[w] = side.get(w, 0) + 1
    nb, na = sum(block.values()), sum(allow.values())

    def weight(w):
        x, y = block.get(w, 0), allow.get(w, 0)
        base = (x + y) * U.SMOOTHING / (nb + na)
        return math.log((x + base) / (nb + U.SMOOTHING)) - math.log((y + base) / (na + U.SMOOTHING))
    for r in got:
        assert r.score == pytest.approx(-0.25 + sum(map(weight, tokens[r.page_id])))
    assert {r.verdict for r in got if "casino" in r.host} == {"block"} and {r.verdict for r in got if "news" in r.host} == {"allow"}


def test_a_repeated_path_word_counts_again_and_the_prior_does_not_follow_the_table(spark):
    rows = [(0, "http://a.biz/spam", None), (1, "http://b.biz/ok", None), (2, "http://b.biz/ok/ok/ok/ok", None), *[(i, None, None) for i in range(3, 40)]]
    clean = spark.range(100, 3000).selectExpr("id", "concat('https://blog', id % 7, '.example.biz/en/page/', id)", "'<title>a blog page</title>'")
    df = spark.createDataFrame(rows, "page_id long, url string, html string").union(clean)
    got = {r.page_id: r for r in U.judged(df, rules=()).collect()}
    assert got[0].verdict == "block" and got[2].score < got[1].score < 0
    assert {got[i].verdict for i in range(3, 40)} == {"allow"} and {got[i].score for i in range(3, 40)} == {0.0}


def test_segmentation_joins_only_known_words(spark):
    names = spark.createDataFrame([("freebets",), ("zzz",), ("b" * 70,)], "run string")
    words = spark.createDataFrame([("free", 5), ("bets", 4), ("bet", 9)], "word string, n long")
    got = {r.run: r.words for r in U.segment(names, "run", words).collect()}
    assert got["freebets"] == ["free", "bets"] and "".join(got["b" * 70]) == "b" * 70
    assert U.segment(names.where(F.lit(False)), "run", words).count() == 0


def test_rare_spam_beside_a_large_vocabulary_stays_blocked(spark):
    word = "translate(cast(id % 20000 as string), '0123456789', 'abcdefghij')"
    clean = spark.range(60_000).selectExpr(
        "id", f"concat('http://www.', {word}, 'site.com/index.html/', {word}, '/', id)", f"concat('<title>', {word}, ' site index</title>')")
    hosts = ["casino-win", "bets-now", "poker-room", "best-pills", "xxx-tube"]
    spam = spark.createDataFrame([(100_000 + i, f"http://www.{h}.com/index.html/{i}", None) for i, h in enumerate(hosts)],
                                 "id long, url string, html string")
    df = clean.toDF("page_id", "url", "html").unionAll(spam.toDF("page_id", "url", "html"))
    got = U.judged(df, rules=()).groupBy((F.col("page_id") >= 100_000).alias("spam"), "verdict").count().collect()
    assert {(r.spam, r.verdict): r["count"] for r in got} == {(True, "block"): 5, (False, "allow"): 60_000}
