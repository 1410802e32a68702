"""Spelling variants: words one edit apart, found over one-edit neighbourhoods of reduced words.

1. ``vocabulary``: letter runs of all texts, counted with map-side partial sums.
2. Each letter hashes to one of ``SYMBOLS`` symbols, which makes a word a reduced word. Words one edit apart
   have reduced words at most one edit apart. A reduced word is kept as its polynomial value modulo 2**64,
   and so are all members of its full one-edit neighbourhood (itself, every deletion, replacement and
   insertion): prefix sums give each in constant time, so a word of any length costs memory in proportion.
3. The neighbourhoods of the distinct reduced values join the reduced vocabulary. A clash of values only adds
   a candidate: every candidate pair is verified on its two original strings.
4. A word's form is its most frequent near word, if that is ``ratio`` times as frequent; ``root`` follows
   forms by pointer doubling. Counts grow ``ratio``-fold along a chain, so chains are short and have no cycle.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geotrace.llm.common import ascii_lower, bit_filter, stored

SYMBOLS = 8
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
#: The filter has 16 bits a word, 32 MB at most.
MOST_BITS = 28
WORDS_A_TASK = 20_000
#: Letters of the contract: A-Z a-z and U+00C0 to U+00FF.
LETTERS = r"[A-Za-zÀ-ÿ]"


def _symbol_table() -> np.ndarray:
    """Symbol 1 .. SYMBOLS of each code point below 256, by a hash of the letter."""
    return np.array([zlib.crc32(chr(c).encode()) % SYMBOLS + 1 for c in range(256)], np.uint64)


def _powers(n: int) -> np.ndarray:
    out = np.full(n, BASE, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _reduced(word: str, table: np.ndarray) -> np.ndarray:
    return table[np.frombuffer(word.encode("latin-1"), np.uint8)]


def neighbourhood(symbols: np.ndarray) -> np.ndarray:
    """Distinct values of a reduced word and of all its one-edit neighbours."""
    n = len(symbols)
    power = _powers(n + 2)
    term = symbols * power[:n]
    before = np.r_[np.zeros(1, np.uint64), np.cumsum(term, dtype=np.uint64)]
    whole = before[-1]
    every = np.arange(1, SYMBOLS + 1, dtype=np.uint64)
    less = before[:-1] + (whole - before[1:]) * np.uint64(INVERSE)
    other = (whole + (every[None, :] - symbols[:, None]) * power[:n, None]).ravel()
    more = ((before + (whole - before) * np.uint64(BASE))[:, None] + every[None, :] * power[: n + 1, None]).ravel()
    return np.unique(np.concatenate([np.array([whole], np.uint64), less, other, more]))


def _values(words: pd.Series) -> pd.DataFrame:
    """Polynomial value of each reduced word, and that mixed for the filter."""
    table = _symbol_table()
    out = np.zeros(len(words), np.uint64)
    for i, w in enumerate(words):
        s = _reduced(w, table)
        out[i] = (s * _powers(len(s))).sum(dtype=np.uint64)
    return pd.DataFrame({"reduced": out.view(np.int64), "mixed": (out * np.uint64(BASE)).view(np.int64)})


def _bit(values, bits: int):
    """The filter's bit of reduced values: their upper bits after a multiplication."""
    return (values.view(np.uint64) * np.uint64(BASE)) >> np.uint64(64 - bits)


def _neighbours(known, bits: int):
    """(reduced value, value of a neighbour) rows of each reduced word, as far as the filter may know the neighbour."""
    def work(batches):
        table = _symbol_table()
        for pdf in batches:
            own, probes = [], []
            for reduced, word in zip(pdf["reduced"], pdf["word"]):
                near = neighbourhood(_reduced(word, table)).view(np.int64)
                at = _bit(near, bits)
                near = near[(known.value[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1]
                own.append(np.full(len(near), reduced))
                probes.append(near)
            if own:
                yield pd.DataFrame({"reduced": np.concatenate(own), "probe": np.concatenate(probes)})
    return work


def vocabulary(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 7, min_count: int = 2,
               drop_every: int = 31) -> DataFrame:
    """(word, n): lower-cased (A-Z only) letter runs of whole texts with ``min_length`` code points and ``min_count`` uses.

    Of runs whose crc32 of ``id:run`` is divisible by ``drop_every`` one code point goes, which plants slips;
    a null id counts as the empty text there. Null and empty texts have no runs.
    """
    run = F.explode(F.regexp_extract_all(F.col(text_col), F.lit(f"{LETTERS}{{{min_length},}}"), F.lit(0))).alias("run")
    runs = df.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), run).select("id", ascii_lower(F.col("run")).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("h") % drop_every == 0, cut).otherwise(F.col("run"))
    words = runs.withColumn("h", h).select(word.alias("word")).where(F.length("word") >= min_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def near_pairs(vocab: DataFrame) -> DataFrame:
    """(id, other_id) of all pairs of words of ``vocab`` (id, word, reduced, mixed) one edit apart, in both directions.

    A bit filter over the reduced vocabulary, of ``MOST_BITS`` at most, drops most neighbours that are no word before
    they are shuffled; what it lets through the join removes.
    """
    spark, rows = vocab.sparkSession, vocab.count()
    bits = min(MOST_BITS, max(20, (16 * rows).bit_length()))
    shifted = vocab.withColumn("bit", F.shiftrightunsigned(F.col("mixed"), 64 - bits))
    filled = spark.sparkContext.broadcast(bit_filter(shifted, F.col("bit"), bits))
    forms = vocab.repartition(rows // WORDS_A_TASK + 1, "reduced").groupBy("reduced").agg(F.min("word").alias("word"))  # one spelling stands for a reduced word
    probes = forms.mapInPandas(_neighbours(filled, bits), "reduced long, probe long")
    known = vocab.select(F.col("reduced").alias("probe"), F.col("id").alias("other_id"), F.col("word").alias("other"))
    joined = probes.join(forms.select(F.col("reduced").alias("probe")), "probe", "left_semi")
    joined = stored(joined, "near-forms")
    candidates = vocab.select("id", "word", "reduced").join(joined, "reduced").join(known, "probe")
    apart = F.abs(F.length("word") - F.length("other")) <= 1
    return candidates.where(apart & (F.col("id") != F.col("other_id")) & (F.levenshtein("word", "other", 1) == 1)).select("id", "other_id")


def variants(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 7, min_count: int = 2,
             ratio: int = 10, drop_every: int = 31) -> DataFrame:
    """word, form, root, n, n_near, form_n of the whole vocabulary.

    A form is the near word of largest n (ties: smallest in code-point order) if that is at least ``ratio``
    times the word's n, else null; root is the end of the chain of forms, the word itself without one.
    Texts without words and empty tables give no rows; other columns of ``df`` don't matter.
    """
    if ratio < 2:
        raise ValueError("ratio must be 2 at least, else chains of forms could have cycles")
    words = vocabulary(df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "doc_id", "text", min_length, min_count, drop_every)
    kind = T.StructType([T.StructField("reduced", T.LongType()), T.StructField("mixed", T.LongType())])
    value = F.pandas_udf(_values, kind)("word").alias("value")
    vocab = stored(words.select("word", "n", F.monotonically_increasing_id().alias("id"), value).select("word", "n", "id", "value.*"), "vocabulary")
    pairs = near_pairs(vocab)
    by = vocab.select(F.col("id").alias("other_id"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("word"), F.col("other_id").alias("id")))
    near = pairs.join(by, "other_id").groupBy("id").agg(F.count("*").alias("n_near"), best.alias("best"))
    out = vocab.select("id", "word", "n").join(near, "id", "left")
    good = -F.col("best.less") >= ratio * F.col("n")
    out = stored(out.select("id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(good, F.col("best.word")).alias("form"),
                            F.when(good, F.col("best.id")).alias("form_id"), F.when(good, -F.col("best.less")).alias("form_n")), "forms")
    ends = _ends(out.where("form_id IS NOT NULL").select("id", F.col("form_id").alias("to"), F.col("form").alias("root")))
    return out.join(ends.select("id", "root"), "id", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _ends(steps: DataFrame) -> DataFrame:
    """(id, to, root): the last word that is reached; each round doubles the length of the steps."""
    while True:
        steps = stored(steps, "steps")
        on = steps.select(F.col("id").alias("to"), F.col("to").alias("next"), F.col("root").alias("further"))
        more = steps.join(on, "to")
        if more.isEmpty():
            return steps
        steps = steps.join(on, "to", "left").select(
            "id", F.coalesce("next", "to").alias("to"), F.coalesce("further", "root").alias("root"))


def variants_sql(min_length: int = 7, min_count: int = 2, ratio: int = 10, drop_every: int = 31) -> str:
    """The same in SQL: crc32 from its defining polynomial, near words by patterns with one place left open."""
    table = "list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))"
    points = "list_transform(string_split(concat(coalesce(CAST(doc_id AS VARCHAR), ''), ':', run), ''), lambda c: ord(c))"
    octets = f"flatten(list_transform({points}, lambda o: CASE WHEN o < 128 THEN [CAST(o AS BIGINT)] ELSE [195, CAST(o - 64 AS BIGINT)] END))"
    return f"""WITH RECURSIVE polynomial AS MATERIALIZED (SELECT {table} AS t),
runs AS (SELECT doc_id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS r FROM documents) WHERE length(r) >= {min_length}),
hashed AS (SELECT run, xor(list_reduce(list_prepend(4294967295, {octets}), lambda c, o: xor(c >> 8, t[(xor(c, o) & 255) + 1])), 4294967295) AS h
  FROM runs, polynomial),
words AS (SELECT CASE WHEN h % {drop_every} = 0 THEN concat(left(run, CAST(h % length(run) AS INTEGER)), substr(run, CAST(h % length(run) AS INTEGER) + 2)) ELSE run END AS word FROM hashed),
vocab AS MATERIALIZED (SELECT word, count(*) AS n FROM words WHERE length(word) >= {min_length} GROUP BY word HAVING count(*) >= {min_count}),
places AS MATERIALIZED (SELECT word, i, concat(left(word, i - 1), substr(word, i + 1)) AS rest
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM vocab)),
pairs AS (SELECT a.word, b.word AS other FROM places a JOIN places b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT p.word, v.word FROM places p JOIN vocab v ON p.rest = v.word
  UNION SELECT v.word, p.word FROM places p JOIN vocab v ON p.rest = v.word),
near AS (SELECT p.word, o.word AS other, o.n AS other_n, row_number() OVER (PARTITION BY p.word ORDER BY o.n DESC, o.word) AS place,
  count(*) OVER (PARTITION BY p.word) AS n_near FROM pairs p JOIN vocab o ON p.other = o.word),
forms AS MATERIALIZED (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= {ratio} * v.n THEN other END AS form,
  CASE WHEN other_n >= {ratio} * v.n THEN other_n END AS form_n FROM vocab v LEFT JOIN near m ON v.word = m.word AND place = 1),
chain AS (SELECT word, coalesce(form, word) AS root FROM forms
  UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON c.root = f.word WHERE f.form IS NOT NULL AND c.word <> c.root),
ends AS (SELECT word, root FROM chain WHERE root IN (SELECT word FROM forms WHERE form IS NULL))
SELECT f.word, form, root, n, n_near, form_n FROM forms f JOIN ends USING (word)"""
