"""Quality rules with host-level verdicts, in DataFrame functions only.

Each text gets word, symbol, duplicate-line and repeated-window counts, a base verdict and the rules it fails
(``RULES``). Each rule's failures are summed by host, and each host's failure rate of each rule is shrunk
towards that rule's empirical beta prior: the mean of the rates of all hosts, and their variance less what
sampling alone makes of it. A host fails if its shrunk rate of any rule lies over ``spread`` of the prior's
deviations above the prior's mean, or if its shrunk rate of base failures is over ``max_host_rate``. The
verdicts are joined back: a document stays if it passes the base rules and its host doesn't fail. Where
hosts differ by no more than chance, the priors have no deviation and no host stands out.

Null texts count as empty (they fail the base rules); documents without a host share one group. Repeated
rows count as often as they occur. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geotrace.llm.common import SPACES, fresh, let, stored, without, words_of

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
LOW32 = 0xFFFFFFFF
#: Rules whose failures are summed by host, as expressions over ``STATS`` that Spark and DuckDB read alike; the base verdict is the first.
RULES = {"base": "base_failed", "repeats": "100 * n_repeat_words > 50 * n_words", "symbols": "10 * n_symbols > n_words",
         "lines": "n_dup_lines >= 3", "lengths": "word_chars < 3 * n_words OR word_chars > 10 * n_words"}


def repeat_words(words: Column, window: int = 3) -> Column:
    """Words in ``window``-word spans that occur twice or more in the text (the first one included).

    Spans are compared by 64-bit hashes. A primitive sort of (upper 32 hash bits, position) finds the
    candidates, and only those are compared by the whole hash, so texts without repeats stay cheap.
    """
    def equal_neighbour(items: Column, key) -> Column:
        same = lambda x, other: F.coalesce(key(other) == key(x), F.lit(False))
        return F.filter(items, lambda x, i: same(x, F.get(items, i - 1)) | same(x, F.get(items, i + 1)))

    def covered(hashes: Column, candidates: Column) -> Column:
        at = lambda x: x.bitwiseAND(F.lit(LOW32)).cast("int")
        pairs = F.array_sort(F.transform(candidates, lambda x: F.struct(F.get(hashes, at(x)).alias("h"), at(x).alias("i"))))
        dup = let(pairs, lambda p: equal_neighbour(p, lambda x: x["h"]))
        spans = F.flatten(F.transform(dup, lambda p: F.sequence(p["i"], p["i"] + window - 1)))
        return F.size(F.array_distinct(spans))

    def from_spans(hashes: Column) -> Column:
        packed = F.sort_array(F.transform(hashes, lambda h, i: h.bitwiseAND(F.lit(~LOW32)).bitwiseOR(i.cast("long"))))
        candidates = let(packed, lambda p: equal_neighbour(p, lambda x: F.shiftright(x, 32)))
        return let(candidates, lambda c: F.when(F.size(c) == 0, 0).otherwise(covered(hashes, c)))

    def from_hashes(h: Column) -> Column:
        spans = F.transform(F.sequence(F.lit(0), F.size(h) - window), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(window)]))
        return F.when(F.size(h) < window, 0).otherwise(let(spans, from_spans))

    return let(F.transform(words, lambda w: F.xxhash64(w)), from_hashes)


def text_stats(df: DataFrame, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """``df`` with the columns of ``STATS`` (longs); input columns of those names are replaced."""
    df = without(df, *STATS)
    text = F.coalesce(F.col(text_col), F.lit(""))
    both = fresh(df, "by_word")
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, SPACES, "") != "")
    by_word = let(words_of(text), lambda w: F.struct(F.size(w).alias("n"), repeat_words(w).alias("repeat")))
    out = df.select(
        *[F.col(f"`{c}`") for c in df.columns if keep_text or c != text_col], by_word.alias(both),
        F.length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))
    return out.withColumns({"n_words": F.col(both)["n"].cast("long"),
                            "n_repeat_words": F.col(both)["repeat"].cast("long")}).drop(both)


def base_failed(min_words: int = 50, max_repeat_percent: int = 50) -> Column:
    """The base verdict over the columns of ``STATS``."""
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))


def host_rates(df: DataFrame, host_col: str, max_rate: float = 0.5, spread: float = 3.0) -> DataFrame:
    """(host, n, rate_<rule>..., host_failed) of a table with ``STATS`` and ``base_failed``.

    A prior's strength is mean * (1 - mean) / variance - 1, at least 1; without variance, every rate is the mean.
    """
    host = fresh(df, "host_")
    sums = [F.sum(F.expr(c).cast("long")).alias(f"failed_{r}") for r, c in RULES.items()]
    raw = stored(df.withColumn(host, F.col(f"`{host_col}`")).groupBy(host).agg(F.count("*").alias("n"), *sums), "hosts")
    rate = {r: F.col(f"failed_{r}") / F.col("n") for r in RULES}
    stats = raw.agg(F.avg(F.lit(1.0) / F.col("n")), *[f(x) for x in rate.values() for f in (F.avg, F.var_pop)]).first()
    failed, shrunk = F.lit(False), {}
    for i, r in enumerate(RULES):
        mean, var = stats[1 + 2 * i] or 0.0, stats[2 + 2 * i] or 0.0
        var = var - mean * (1 - mean) * (stats[0] or 0.0)
        if var > 0:
            strength = max(mean * (1 - mean) / var - 1, 1.0)
            shrunk[r] = (F.col(f"failed_{r}") + mean * strength) / (F.col("n") + strength)
            failed = failed | (shrunk[r] > mean + spread * var ** 0.5)
        else:
            shrunk[r] = F.lit(float(mean))
    failed = failed | (shrunk["base"] > max_rate)
    return raw.select(F.col(host).alias("host"), "n", *[v.alias(f"rate_{r}") for r, v in shrunk.items()], failed.alias("host_failed"))


def judged(df: DataFrame, host_col: str = "source", text_col: str = "text", keep_text: bool = False,
           min_words: int = 50, max_repeat_percent: int = 50, max_host_rate: float = 0.5, spread: float = 3.0) -> DataFrame:
    """Rows of ``df`` (without the text unless ``keep_text``) with ``STATS``, ``base_failed`` and ``kept``.

    Texts are read once: the row table with its statistics is written, summed by host, and met again by
    the failing hosts only (a table Spark broadcasts if it is small, and sort-merges if not).
    """
    df = without(df, *STATS, "base_failed", "kept")
    rows = text_stats(df, text_col, keep_text).withColumn("base_failed", base_failed(min_words, max_repeat_percent))
    rows = stored(rows, "judged")
    bad, failing = fresh(rows, "bad_host"), fresh(rows, "host_failed")
    hosts = host_rates(rows, host_col, max_host_rate, spread).where("host_failed")
    hosts = stored(hosts.select(F.col("host").alias(bad), F.col("host_failed").alias(failing)), "bad_hosts")
    out = rows.join(hosts, F.col(f"`{host_col}`").eqNullSafe(F.col(bad)), "left")
    return out.withColumn("kept", ~F.col("base_failed") & F.col(failing).isNull()).drop(bad, failing)


def accepted(df: DataFrame, host_col: str = "source", text_col: str = "text", **rules) -> DataFrame:
    """The documents that pass, with the columns of ``df`` as they came."""
    clash = [c for c in df.columns if c.lower() in {*STATS, "base_failed", "kept"}]
    renamed = df.withColumnsRenamed({c: fresh(df, f"own_{c}") for c in clash})
    host_col, text_col = (fresh(df, f"own_{c}") if c in clash else c for c in (host_col, text_col))
    out = judged(renamed, host_col, text_col, True, **rules).where("kept")
    return out.select(*[F.col(f"`{n}`").alias(c) for n, c in zip(renamed.columns, df.columns, strict=True)])


def rules_sql(min_words: int = 50, max_repeat_percent: int = 50, max_host_rate: float = 0.5, spread: float = 3.0,
              table: str = "documents") -> str:
    """CTEs of the DuckDB twin, ending in ``judged`` (doc_id, source, counts, base_failed, kept)."""
    failed = ", ".join(f"sum(CAST({c} AS INT)) AS f_{r}" for r, c in RULES.items())
    priors = ", ".join(f"avg(f_{r} / n) AS m_{r}, var_pop(f_{r} / n) - avg(f_{r} / n) * (1 - avg(f_{r} / n)) * avg(1.0 / n) AS v_{r}" for r in RULES)

    def shrunk(r: str) -> str:
        strength = f"greatest(m_{r} * (1 - m_{r}) / v_{r} - 1, 1)"
        return f"(CASE WHEN v_{r} > 0 THEN (f_{r} + m_{r} * {strength}) / (n + {strength}) ELSE m_{r} END)"
    beyond = " OR ".join(f"(v_{r} > 0 AND {shrunk(r)} > m_{r} + {spread} * sqrt(greatest(v_{r}, 0)))" for r in RULES)
    space = r"[\x20\x09-\x0D]"
    return rf"""
t AS (SELECT doc_id, source, coalesce(text, '') AS text,
             [x FOR x IN regexp_split_to_array(coalesce(text, ''), '{space}+') IF x <> ''] AS w,
             [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS l
      FROM {table}),
tri AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM t WHERE len(w) >= 3)),
dup AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM tri) WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM dup) GROUP BY doc_id),
stats AS (SELECT t.doc_id, source, CAST(len(w) AS BIGINT) AS n_words,
                 CAST(length(regexp_replace(text, '{space}', '', 'g')) AS BIGINT) AS word_chars,
                 CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                 CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
                 CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words
          FROM t LEFT JOIN cov ON t.doc_id = cov.doc_id),
base AS (SELECT *, n_words < {min_words} OR 100 * n_repeat_words > {max_repeat_percent} * n_words AS base_failed FROM stats),
host AS (SELECT source, count(*) AS n, {failed} FROM base GROUP BY source),
prior AS (SELECT {priors} FROM host),
bad AS (SELECT source FROM host, prior WHERE {shrunk("base")} > {max_host_rate} OR {beyond}),
judged AS (SELECT base.*, NOT base_failed AND NOT EXISTS (SELECT 1 FROM bad WHERE base.source IS NOT DISTINCT FROM bad.source) AS kept
           FROM base)"""
