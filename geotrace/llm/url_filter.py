"""URL verdicts: list rules first, else naive Bayes over segmented host and path words.

* Rules: ``host/path`` strings. A rule fits its host and all subdomains if the url's path starts with the
  rule's; the longest wins (of equally long ones the alphabetically first).
* Segmentation: host labels are cut into letter runs; every substring of each distinct run meets the word
  counts of page titles and url paths in a join, and a Viterbi search over the unigram probabilities picks
  the best split. Unknown words of n letters have probability 10 / (N * 10^n), so any run can be split.
* Naive Bayes (multinomial) over host and path words of all urls. Its labels are weak: a url with a
  ``seed_block`` word among its segmented words counts as block, any other as allow, and each seed is added
  ``seed_weight`` times as a block observation, so words that go with seeds gain weight too. Both classes are
  smoothed with ``SMOOTHING`` tokens spread as the words of all urls are: a word that a rare class has not met is
  as likely there as anywhere, whatever the vocabulary's size, and a word met in one class only outweighs the
  prior. Words of the rules are left out of the tokens: a rule decides by policy, and its words say nothing
  about other urls.

Null urls and urls without ``://`` have empty host and path, and get the prior's verdict. Repeated rows are
judged each. An empty table gives an empty one. A tie is allowed.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geotrace.llm.common import ascii_lower, stored, without

RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: Words that mark spam hosts in common block lists.
SEED_BLOCK = ("ads", "adult", "bet", "bets", "betting", "casino", "gambling", "jackpot", "loan", "loans", "pills", "poker",
              "porn", "slots", "spam", "viagra", "xxx")
MAX_WORD = 24
SMOOTHING = 10  # tokens of the base distribution added to each class


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def first_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest fitting rule, else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, text in sorted(rules, key=lambda r: (-len(r[1]), r[1]), reverse=True):  # the last one set wins
        name, _, rest = text.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{rest}")
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, said).otherwise(verdict)
    return rule, verdict


def runs(c: Column) -> Column:
    """Letter runs of a lower-cased text, digits as the run ``0``."""
    return F.regexp_extract_all(F.regexp_replace(F.lower(c), r"\p{N}+", " 0 "), F.lit(r"\p{L}+|0"), F.lit(0))


def viterbi(run: str, starts: Sequence[int], lengths: Sequence[int], counts: Sequence[int], total: int) -> list[str]:
    """Best split of ``run``; the i-th known word starts at starts[i] and occurred counts[i] times."""
    known = {(s, n): c for s, n, c in zip(starts, lengths, counts, strict=True)}
    base = math.log(max(total, 1))
    best, cut = [0.0] + [-math.inf] * len(run), [0] * (len(run) + 1)
    for end in range(1, len(run) + 1):
        for start in range(max(0, end - MAX_WORD), end):
            n = end - start
            c = known.get((start, n))
            score = best[start] + (math.log(c) - base if c else math.log(10) - base - n * math.log(10))
            if score > best[end]:
                best[end], cut[end] = score, start
    words, end = [], len(run)
    while end:
        words.append(run[cut[end] : end])
        end = cut[end]
    return words[::-1]


def segment(names: DataFrame, name: str, vocabulary: DataFrame) -> DataFrame:
    """(name, words) for a table of distinct letter runs; vocabulary: (word, n). Both may be of any size."""
    total = int(vocabulary.agg(F.sum("n")).first()[0] or 0)
    length = F.length(name)
    parts = names.select(F.col(name).alias("run"), F.explode(F.sequence(F.lit(1), length)).alias("start")).select(
        "run", "start", F.explode(F.sequence(F.lit(1), F.least(F.lit(MAX_WORD), F.length("run") - F.col("start") + 1))).alias("len"))
    parts = parts.withColumn("word", F.substring("run", F.col("start"), F.col("len")))
    known = parts.join(vocabulary, "word").groupBy("run").agg(
        F.collect_list(F.struct(F.col("start") - 1, "len", "n")).alias("known"))
    rows = names.select(F.col(name).alias("run")).join(known, "run", "left")

    @F.pandas_udf("array<string>")
    def split(run: pd.Series, known: pd.Series) -> pd.Series:
        return pd.Series([viterbi(r, *zip(*[tuple(k.values()) for k in ks], strict=True), total) if ks is not None and len(ks)
                          else viterbi(r, (), (), (), total) for r, ks in zip(run, known, strict=True)])

    return rows.select(F.col("run").alias(name), split("run", "known").alias("words"))


def judged(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
           rules: Sequence[tuple[str, str]] = RULES, seed_block: Sequence[str] = SEED_BLOCK,
           seed_weight: int = 5, prior: float = 0.0) -> DataFrame:
    """(id, host, path, rule, verdict, score): score is the log odds of block by the method, for every url.

    ``prior`` is the log odds of block before a word is seen. It is a setting, not the tables' share of spam,
    so the same url has the same prior in a table of any size. Words count as often as they occur.
    """
    pages = without(pages, "host", "path", "rule", "verdict", "score")
    url, html = F.col(url_col), F.coalesce(F.col(html_col), F.lit(""))
    title = F.regexp_extract(html, r"(?i)<title[^>]*>([^<]*)", 1)
    rows = pages.select(F.col(id_col), host_of(url).alias("host"), path_of(url).alias("path"), runs(title).alias("title"))
    rule, said = first_rule(F.col("host"), F.col("path"), rules)
    stop = sorted({w for _, r in rules for w in re.findall(r"[^\W\d_]+", r.lower())})
    path_words = F.filter(runs(F.col("path")), lambda w: ~w.isin(stop)) if stop else runs(F.col("path"))  # repeats stay
    rows = stored(rows.withColumns({"rule": rule, "said": said, "path_words": path_words}), "urls")

    # word counts of titles, paths and seeds: what the segmentation knows of the language
    seeds = rows.sparkSession.createDataFrame([(w, seed_weight) for w in seed_block], "word string, n long")
    heard = rows.select(F.explode(F.concat("title", "path_words")).alias("word")).where("word <> '0'").groupBy("word").agg(
        F.count("*").alias("n"))
    vocabulary = stored(heard.unionByName(seeds).groupBy("word").agg(F.sum("n").alias("n")), "vocabulary")
    hosts = stored(rows.select("host").distinct().select("host", runs(F.col("host")).alias("runs")), "hosts")
    names = hosts.select(F.explode("runs").alias("run")).distinct()
    split = segment(names.where("run <> '0'"), "run", vocabulary)
    by_host = hosts.select("host", F.explode("runs").alias("run")).join(split, "run").select(
        "host", F.explode("words").alias("word"))
    if stop:
        by_host = by_host.where(~F.col("word").isin(stop))
    host_words = by_host.groupBy("host").agg(F.sort_array(F.collect_list("word")).alias("host_words"))

    # equal (host, path words) are counted before anything is exploded or joined
    kinds = rows.groupBy("host", "path_words").agg(F.count("*").alias("n")).join(host_words, "host", "left")
    words = F.concat(F.coalesce("host_words", F.array().cast("array<string>")), "path_words")
    spam = F.arrays_overlap("words", F.array(*[F.lit(w) for w in seed_block])) if seed_block else F.lit(False)
    kinds = stored(kinds.select("host", "path_words", "n", words.alias("words")).withColumn("spam", spam), "kinds")
    b, a = (F.sum(F.when(c, F.col("n")).otherwise(0)) for c in (F.col("spam"), ~F.col("spam")))
    told = kinds.select(F.explode("words").alias("word"), "spam", "n").unionByName(seeds.withColumn("spam", F.lit(True)))
    tokens = stored(told.groupBy("word").agg(b.alias("block"), a.alias("allow")), "tokens")
    n_block, n_allow = (x or 0 for x in tokens.agg(F.sum("block"), F.sum("allow")).first())
    base = (F.col("block") + F.col("allow")) * (SMOOTHING / max(n_block + n_allow, 1))
    weight = F.log((F.col("block") + base) / (n_block + SMOOTHING)) - F.log((F.col("allow") + base) / (n_allow + SMOOTHING))
    scores = kinds.select("host", "path_words", F.explode(F.array_distinct("words")).alias("word"), "words").distinct().join(
        tokens.select("word", weight.alias("weight")), "word").groupBy("host", "path_words").agg(
        F.sum(F.col("weight") * F.size(F.filter("words", lambda w: w == F.col("word")))).alias("evidence"))
    out = rows.join(scores, ["host", "path_words"], "left").withColumn("score", F.coalesce("evidence", F.lit(0.0)) + prior)
    verdict = F.coalesce("said", F.when(F.col("score") > 0, "block").otherwise("allow"))
    return out.select(id_col, "host", "path", "rule", verdict.alias("verdict"), "score")
