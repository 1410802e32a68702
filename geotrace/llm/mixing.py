"""Mixing to target weights by iterative proportional fitting, in DataFrame functions only.

Documents are summed into cells, one for each combination of the dimensions' values. Raking multiplies the
cells of each value by target share / current share, dimension after dimension, until all marginals hold at
once. A document is then kept with probability factor / largest factor of its cell, so expected token shares
are the targets and the most wanted cell keeps all. With ``keep``, the share of all tokens to be kept, raking goes on
probabilities instead: each value aims at its part of that budget, but at no more tokens than it has (what it
lacks goes to the others of its dimension), and no probability exceeds 1. A rare cell then keeps all it has and
lowers no other cell. The draw is a hash of seed and id: repeatable, the same
for repeated ids, and independent of partitions.

Without ``targets`` a dimension aims at its tempered shares, token share ** ``temper``, normalised. Null
values are values of their own; null texts have no tokens. A value without tokens keeps factor 1. An empty
table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geotrace.llm.common import fresh, stored, without, words_of

#: Topics in order of precedence: (name, kind of test, pattern).
TOPICS = (("contact", "has", "@"), ("legal", "matches", "(?i)licen[cs]e|copyright"), ("tabular", "has", " | "),
          ("numeric", "matches", "[0-9]{7}"))
DIMS = ("source", "lang", "topic")


def topic_of(text: Column, topics: Sequence[tuple[str, str, str]] = TOPICS) -> Column:
    """The first topic whose test the whole text passes, else ``prose``."""
    text, out = F.coalesce(text, F.lit("")), F.lit("prose")
    for name, kind, pattern in reversed(topics):
        out = F.when(text.contains(pattern) if kind == "has" else text.rlike(pattern), name).otherwise(out)
    return out


def _level(cells: DataFrame, dim: str, goal: str, tokens: str, budget: float) -> float:
    """The level at which sum(least(tokens, level * goal)) over the values of ``dim`` is the budget."""
    values = stored(cells.groupBy(dim).agg(F.sum(tokens).cast("double").alias("own"), F.first(goal).alias("g")).where("own > 0"), "values")
    level, full = budget, -1
    while True:  # each turn finds more values that give all, or ends
        short = F.col("own") <= F.col("g") * level
        n, spent, rest = values.agg(F.count_if(short), F.sum(F.when(short, F.col("own"))), F.sum(F.when(~short, F.col("g")))).first()
        if n <= full or not rest:
            return level
        full, level = n, max(level, (budget - (spent or 0.0)) / rest)


def raked(cells: DataFrame, dims: Sequence[str], tokens: str, targets: Mapping[str, Mapping] | None = None, temper: float = 0.9,
          tolerance: float = 1e-11, sweeps: int = 5, rounds: int = 20, keep: float | None = None) -> DataFrame:
    """``cells`` (one row for each combination of values) with ``factor``; sum(tokens * factor) = 1.

    With ``keep`` the factor is a probability, at most 1, and sum(tokens * factor) = keep * sum(tokens).

    Values missing in a dimension's ``targets`` share what these leave, by their tokens. Rounds of
    ``sweeps`` sweeps run until no marginal is off by more than ``tolerance``, or ``rounds`` are over (with
    cells that make the targets impossible, raking never gets there).
    """
    def goal(dim: str) -> Column:
        own = F.sum(F.col(tokens)).over(Window.partitionBy(dim)) / total
        wanted = (targets or {}).get(dim)
        if not wanted:
            return F.pow(own, F.lit(temper))
        said = F.lit(None).cast("double")
        for value, share in wanted.items():
            said = F.when(F.col(dim).eqNullSafe(F.lit(value)), float(share)).otherwise(said)
        rest = cells.agg(F.sum(F.when(said.isNull(), F.col(tokens)))).first()[0] or 1
        return F.coalesce(said, own * (total / float(rest) * max(0.0, 1 - sum(wanted.values()))))

    bound = (lambda f: f) if keep is None else (lambda f: F.least(f, F.lit(1.0)))
    total = float(cells.agg(F.sum(tokens)).first()[0] or 1)
    names = [f"goal_{i}" for i in range(len(dims))]
    for name, dim in zip(names, dims, strict=True):
        cells = cells.withColumn(name, goal(dim))
    cells = stored(cells.withColumn("factor", F.lit(1.0)), "cells")
    # shares over the values present sum to one: each value counts once, not once a cell
    for name, dim in zip(names, dims, strict=True):
        norm = cells.where(F.col(tokens) > 0).groupBy(dim).agg(F.first(name).alias("g")).agg(F.sum("g")).first()[0] or 1.0
        cells = cells.withColumn(name, F.col(name) / norm)
        if keep is not None:
            own = F.sum(tokens).over(Window.partitionBy(dim))
            cells = cells.withColumn(name, F.least(own.cast("double"), F.col(name) * _level(cells, dim, name, tokens, keep * total)))
    if keep is not None:
        cells = cells.withColumn("factor", F.lit(min(float(keep), 1.0)))
    scale = 1.0 if keep is None else total
    for _ in range(rounds):
        for _ in range(sweeps):
            for name, dim in zip(names, dims, strict=True):
                now = F.sum(F.col(tokens) * F.col("factor")).over(Window.partitionBy(dim))
                cells = cells.withColumn("factor", F.when(now > 0, bound(F.col("factor") * F.col(name) / now)).otherwise(F.col("factor")))
        cells = stored(cells, "raked")
        off = [F.max(F.abs(F.col(f"off_{i}"))) for i in range(len(dims))]
        gaps = cells.select(*[(F.sum(F.col(tokens) * F.col("factor")).over(Window.partitionBy(d)) - F.col(n)).alias(f"off_{i}")
                              for i, (n, d) in enumerate(zip(names, dims, strict=True))]).agg(*off).first()
        if all(g is None or g <= tolerance * scale for g in gaps):
            break
    return cells.drop(*names)


def mixed(rows: DataFrame, dims: Sequence[str] = DIMS, tokens: str = "n_tokens", id_col: str = "doc_id", seed: int = 42,
          probability: str = "probability", kept: str = "kept", **params) -> DataFrame:
    """``rows`` with the sampling probability (6 decimals) and the decision; clashing input columns are replaced."""
    rows = without(rows, probability, kept)
    cells = rows.groupBy(*dims).agg(F.sum(tokens).alias("_tokens")).select(
        *[F.col(d).alias(f"_{i}") for i, d in enumerate(dims)], "_tokens")
    cells = raked(stored(cells, "sums"), [f"_{i}" for i in range(len(dims))], "_tokens",
                  targets={f"_{i}": (params.get("targets") or {}).get(d) for i, d in enumerate(dims)},
                  **{k: v for k, v in params.items() if k != "targets"})
    top = 1.0 if params.get("keep") is not None else cells.where("_tokens > 0").agg(F.max("factor")).first()[0] or 1.0
    p = F.round(F.when(F.col("_tokens") > 0, F.least(F.col("factor") / top, F.lit(1.0))).otherwise(1.0), 6)
    cells = stored(cells.select(*[f"_{i}" for i in range(len(dims))], p.alias("_p")), "probabilities")
    same = None
    for i, d in enumerate(dims):
        one = F.col(d).eqNullSafe(F.col(f"_{i}"))
        same = one if same is None else same & one
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))), 1, 12)
    draw = F.conv(digits, 16, 10).cast("double") / float(1 << 48)
    return rows.join(cells, same).drop(*[f"_{i}" for i in range(len(dims))]).withColumnRenamed("_p", probability).withColumn(
        kept, draw < F.col(probability))


def with_topic(docs: DataFrame, text_col: str = "text", topic: str = "topic", tokens: str = "n_tokens") -> DataFrame:
    """``docs`` with topic and word count."""
    return docs.withColumns({topic: topic_of(F.col(text_col)), tokens: F.size(words_of(F.col(text_col))).cast("long")})


def sampled(docs: DataFrame, source_col: str = "source", lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text",
            **params) -> DataFrame:
    """The sampled documents, with their columns as they came."""
    topic, tokens, p, kept = (fresh(docs, n) for n in ("topic_", "tokens_", "probability_", "kept_"))
    out = mixed(with_topic(docs, text_col, topic, tokens), (source_col, lang_col, topic), tokens, id_col,
                probability=p, kept=kept, **params)
    return out.where(F.col(kept)).select(*[F.col(f"`{c}`") for c in docs.columns])


def mixing_sql(seed: int = 42, temper: float = 0.9, sweeps: int = 60, table: str = "documents") -> str:
    """DuckDB twin: the same raking, unrolled."""
    tests = "".join(f" WHEN {'contains' if kind == 'has' else 'regexp_matches'}(coalesce(text, ''), '{pattern}') THEN '{name}'"
                    for name, kind, pattern in TOPICS)
    sql = rf"""WITH d AS (SELECT doc_id, source, lang, CASE{tests} ELSE 'prose' END AS topic,
  CAST(len([x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> '']) AS BIGINT) AS n_tokens
  FROM {table}),
c0 AS MATERIALIZED (SELECT source, lang, topic, CAST(sum(n_tokens) AS DOUBLE) AS n, 1.0::DOUBLE AS f FROM d GROUP BY ALL)"""
    for dim in DIMS:
        sql += f""",
g_{dim} AS MATERIALIZED (SELECT {dim}, pow(s, {temper}) / sum(pow(s, {temper})) OVER () AS goal
  FROM (SELECT {dim}, sum(n) / (SELECT sum(n) FROM c0) AS s FROM c0 GROUP BY {dim}))"""
    k = 0
    for _ in range(sweeps):
        for dim in DIMS:
            sql += f""",
c{k + 1} AS MATERIALIZED (SELECT c.source, c.lang, c.topic, n, CASE WHEN now > 0 THEN f * goal / now ELSE f END AS f
  FROM (SELECT *, sum(n * f) OVER (PARTITION BY {dim}) AS now FROM c{k}) c JOIN g_{dim} g ON c.{dim} IS NOT DISTINCT FROM g.{dim})"""
            k += 1
    return sql + f""",
p AS (SELECT source, lang, topic, round(CASE WHEN n > 0 THEN least(f / (SELECT max(f) FROM c{k} WHERE n > 0), 1) ELSE 1 END, 6) AS probability FROM c{k})
SELECT doc_id, d.topic, n_tokens, probability,
  CAST('0x' || substr(md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12) AS BIGINT) / pow(2, 48) < probability AS kept
FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source AND d.lang IS NOT DISTINCT FROM p.lang AND d.topic = p.topic"""
