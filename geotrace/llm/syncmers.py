"""Document fingerprints from closed syncmers, in DataFrame functions only.

A k-mer of ``K`` words is an anchor if the least hash of its inner ``S``-word substrings lies at its first
or last place. Whether a k-mer is chosen depends on nothing but its own words (context-free), so equal
passages give equal anchors wherever they stand. ``anchors`` has them with positions. A fingerprint is all
distinct anchor hashes of a text, and ``likeness`` of two is the Jaccard similarity of the anchor sets.
``sketch`` with a ``size`` keeps the least hashes only (a bottom-k sketch), for an estimate.

Null and blank texts have no anchors and the empty fingerprint; two empty fingerprints have likeness 1, an
empty and another one 0. A text of fewer than ``K`` words has one anchor, its whole word sequence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geotrace.llm.common import let, words_of

K, S, SIZE = 5, 2, 128


def _chosen(words: Column, k: int, s: int, make) -> Column:
    """``make(position, hash)`` of each anchor of a word array, in text order."""
    edge = k - s  # the last s-mer of a k-mer starts here

    def pick(h: Column, inner: Column) -> Column:
        def at(i: Column) -> Column:
            middle = [F.get(inner, i + j) for j in range(1, edge)]
            ends = F.least(F.get(inner, i), F.get(inner, i + edge))
            code = F.xxhash64(*[F.get(inner, i + j) for j in range(0, edge + 1, s)], F.get(inner, i + edge))
            return F.when(ends <= F.least(*middle) if len(middle) > 1 else ends <= middle[0], make(i, code))
        found = F.transform(F.sequence(F.lit(0), F.size(h) - k), at)
        return F.filter(found, lambda x: x.isNotNull())

    def hashed(h: Column) -> Column:
        inner = F.transform(F.sequence(F.lit(0), F.size(h) - s), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(s)]))
        whole = F.array(make(F.lit(0), F.xxhash64(h)))
        return F.when(F.size(h) >= k, let(inner, lambda m: pick(h, m))).when(F.size(h) > 0, whole).otherwise(
            F.filter(whole, lambda x: F.lit(False)))

    return let(F.transform(words, lambda w: F.xxhash64(w)), hashed)


def anchors(text: Column, k: int = K, s: int = S) -> Column:
    """array<struct<position, hash>>: every closed syncmer of the text with the index of its first word."""
    return _chosen(words_of(text), k, s, lambda i, h: F.struct(i.alias("position"), h.alias("hash")))


def sketch(text: Column, k: int = K, s: int = S, size: int | None = SIZE) -> Column:
    """The ``size`` least distinct anchor hashes (31 bits, ascending); None: all of them."""
    found = _chosen(words_of(text), k, s, lambda i, h: F.shiftrightunsigned(h, 33).cast("int"))
    found = F.sort_array(F.array_distinct(found))
    return found if size is None else F.slice(found, 1, size)


def as_text(codes: Column) -> Column:
    """A sketch as text: 8 lowercase hex digits for each hash."""
    return F.lower(F.array_join(F.transform(codes, lambda v: F.lpad(F.hex(v), 8, "0")), ""))


def likeness(a: Column, b: Column, size: int | None = SIZE) -> Column:
    """Jaccard similarity, 0 to 1: of two sketches estimated by the least hashes of their union, of whole
    fingerprints (``size`` None) exact."""
    if size is None:
        return let(F.size(F.array_union(a, b)), lambda n: F.when(n == 0, F.lit(1.0)).otherwise(
            F.size(F.array_intersect(a, b)) / n))

    def share(union: Column) -> Column:
        return F.size(F.array_intersect(F.array_intersect(union, a), b)) / F.size(union)
    union = F.slice(F.sort_array(F.array_union(a, b)), 1, size)
    return let(union, lambda u: F.when(F.size(u) == 0, F.lit(1.0)).otherwise(share(u)))


def with_next(df: DataFrame, id_col: str, columns: list[str], chunks: int | None = None) -> DataFrame:
    """``df`` (id, ``columns``) with ``next_<column>`` of the row with the next smaller id; the last meets the first.

    No global window: ids are cut into ranges at approximate quantiles, which are ids themselves. Each
    range is one window; the row on a cut also goes to the range above as its last neighbour. Only ids
    are read to find the cuts (at most 4096). Repeated ids are ordered by their columns; null ids are last.
    """
    spark = df.sparkSession
    key = F.coalesce(F.col(id_col), F.lit(-(1 << 63)).cast("long"))
    n = min(4096, chunks or 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = df.agg(F.percentile_approx(key, [i / n for i in range(1, n)] or [0.5], 20 * n), F.max(key)).first()
    top = cuts[1]
    bounds = sorted({*(cuts[0] or []), top}) if top is not None else [0]
    lit = F.array(*[F.lit(b).cast("long") for b in bounds])
    chunk = let(lit, lambda bs: F.size(F.filter(bs, lambda b: b < key)))  # ranges are (cut, next cut]
    above = F.when(key == bounds[-1], F.lit(0)).when(F.array_contains(lit, key), F.col("_chunk") + 1)
    rows = df.select(id_col, *columns, chunk.alias("_chunk"))
    rows = rows.withColumn("_in", F.filter(F.array(
        F.struct(F.col("_chunk").alias("chunk"), F.lit(0).alias("tail")),
        F.struct(above.alias("chunk"), F.lit(1).alias("tail"))), lambda x: x["chunk"].isNotNull()))
    rows = rows.select(id_col, *columns, F.inline("_in"))
    order = Window.partitionBy("chunk").orderBy("tail", F.col(id_col).desc_nulls_last(), *columns)
    out = rows.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in columns])
    return out.where("tail = 0").drop("chunk", "tail")


def edited_pairs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Whole fingerprints of each text and of its edited text, with exact likenesses.

    Edited: the last floor(n_chars / 2) code points give way to the first as many (or all) of the next
    document's. A single document is its own next one.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(F.col(id_col).alias("doc_id"), text.alias("text")).withColumn("codes", sketch(F.col("text"), size=None))
    rows = with_next(rows, "doc_id", ["text", "codes"])
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring("next_text", F.lit(1), half))
    rows = rows.select("doc_id", F.length("text").cast("long").alias("n_chars"), "codes", "next_codes", edited.alias("edited"))
    pair = let(sketch(F.col("edited"), size=None), lambda e: F.struct(as_text(e).alias("text"), likeness(F.col("codes"), e, None).alias("near")))
    rows = rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "codes", "next_codes", pair.alias("pair"))
    return rows.select("doc_id", "n_chars", "edited_sha256", as_text(F.col("codes")).alias("fingerprint"),
                       F.col("pair.text").alias("edited_fingerprint"), F.col("pair.near").alias("near_edited"),
                       likeness(F.col("codes"), F.col("next_codes"), None).alias("near_next"))
