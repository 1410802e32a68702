"""SimHash near-duplicates over a Gray-order hierarchical index.

1. ``fingerprints``: 64 majority bits over the XXH64 (seed 42) values of a text's word shingles.
2. ``links``: equal fingerprints are collapsed first (so thousands of copies cost one row). Two codes at
   most ``max_bits`` apart agree on one of ``max_bits + 1`` bands, so each code goes to that many buckets
   ``(mask, code & mask)``; buckets above ``bucket_limit`` are routed on by bands of their free bits.
   Nothing is dropped: a bucket that cannot be split further is searched whole.
3. Inside a task the buckets are sorted by Gray rank and indexed bottom-up: 16 neighbours share an upper
   node holding the bits they agree on (pattern and mask). A search walks down with the differences
   accumulated so far and prunes every group beyond ``max_bits``. Only a spanning forest of the links
   leaves a bucket, never all pairs of a group.
4. ``components`` merges the forests.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geotrace.llm.common import fresh, stored, without
from geotrace.llm.components import components
from geotrace.llm.skew import salted_join

FAN = 16
PAIRS_AT_ONCE = 1 << 21


def simhash(text: bytes | None, shingle: int = 4, seed: int = 42) -> int:
    """Unsigned 64-bit fingerprint; 0 for a text without words (null and blank ones too)."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    body = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    start = end - size
    if len(words) > shingle:
        start, end = start[: len(words) - shingle + 1], end[shingle - 1 :]
    else:
        start, end = start[:1], end[-1:]
    counts, one = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(start), 1 << 17):
        spans = zip(start[at : at + (1 << 17)].tolist(), end[at : at + (1 << 17)].tolist(), strict=True)
        h = np.array([one(body[a:b], seed) for a, b in spans], np.uint64)
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(start)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(df: DataFrame, text_col: str = "text", out: str = "fingerprint_bits", shingle: int = 4,
                 seed: int = 42, keep_text: bool = True) -> DataFrame:
    """``df`` with the fingerprint as a signed long in ``out`` (an input column of that name is replaced)."""
    df = without(df, out)
    text_at = df.columns.index(text_col)
    kept = [f for f in df.schema.fields if keep_text or f.name != text_col]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_at).cast(pa.large_binary())
            codes = np.fromiter((simhash(t.as_py(), shingle, seed) for t in texts), np.uint64, len(texts))
            columns = [batch.column(i) for i, f in enumerate(batch.schema) if keep_text or i != text_at]
            names = [f.name for i, f in enumerate(batch.schema) if keep_text or i != text_at]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(codes.view(np.int64))], names=[*names, out])

    return df.mapInArrow(add, T.StructType([*kept, T.StructField(out, T.LongType())]))


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each uint64 code in the reflected Gray sequence."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def _levels(codes: np.ndarray, bucket: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """Bottom-up (pattern, mask, bucket, first child, children) of nodes over codes sorted by bucket and rank."""
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    levels = [(codes, np.full(len(codes), full), bucket, None, None)]
    while True:
        pattern, mask, owner, _, _ = levels[-1]
        first_of = np.r_[True, owner[1:] != owner[:-1]]
        begin = np.flatnonzero(first_of)
        if len(begin) == len(owner):
            return levels
        within = np.arange(len(owner)) - np.repeat(begin, np.diff(np.r_[begin, len(owner)]))
        start = np.flatnonzero(within % FAN == 0)
        ones = np.bitwise_and.reduceat(pattern & mask, start)
        zeros = np.bitwise_and.reduceat(~pattern & mask, start)
        levels.append((ones, ones | zeros, owner[start], start, np.diff(np.r_[start, len(owner)])))


def _spans(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flattened ranges first[i] .. first[i]+count[i]-1 with the i of each."""
    row = np.repeat(np.arange(len(first)), count)
    return row, np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + first[row]


def _union(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the trees of a[i] and b[i] in the parent array (roots are the least members)."""
    while True:
        ra, rb = label[a], label[b]
        open_ = ra != rb
        if not open_.any():
            return
        a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
        np.minimum.at(label, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def forest(codes: np.ndarray, bucket: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest (code, root code) of the links at most ``max_bits`` apart inside each bucket."""
    order = np.lexsort((gray_rank(codes), bucket))
    codes, bucket = codes[order], bucket[order]
    levels = _levels(codes, bucket)
    label = np.arange(len(codes))
    top = levels[-1]
    root_of = np.searchsorted(top[2], bucket)  # one top node for each bucket
    sizes = np.bincount(root_of, minlength=len(top[2]))
    step = max(1, PAIRS_AT_ONCE // int(min(FAN * FAN, sizes.max(initial=1))))
    for at in range(0, len(codes), step):
        todo = [(np.arange(at, min(at + step, len(codes))), root_of[at : at + step], None, len(levels) - 1, None)]
        while todo:
            query, node, spent, level, known = todo.pop()
            if len(query) > PAIRS_AT_ONCE:  # depth first in halves: memory stays bounded
                for part in (slice(None, len(query) // 2), slice(len(query) // 2, None)):
                    todo.append((query[part], node[part], None if spent is None else spent[part], level,
                                 None if known is None else known[part]))
                continue
            pattern, mask, _, first, count = levels[level]
            new = mask[node] if known is None else mask[node] & ~known  # bits the upper nodes didn't hold
            gap = np.bitwise_count((codes[query] ^ pattern[node]) & new).astype(np.int64)
            spent = gap if spent is None else spent + gap
            keep = spent <= max_bits
            query, node, spent, path = query[keep], node[keep], spent[keep], mask[node[keep]]
            if level == 0:
                later = node > query
                _union(label, query[later], node[later])
                continue
            row, child = _spans(first[node], count[node])
            todo.append((query[row], child, spent[row], level - 1, path[row]))
    tied = label != np.arange(len(codes))
    return codes[tied], codes[label[tied]]


def _bands(free: int, parts: int) -> list[int]:
    """Split the set bits of ``free`` into ``parts`` contiguous masks (signed, as Spark's longs)."""
    bits = [b for b in range(63, -1, -1) if free >> b & 1]
    cut = [round(i * len(bits) / parts) for i in range(parts + 1)]
    return [sum(1 << b for b in bits[cut[i] : cut[i + 1]]) for i in range(parts)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(codes: DataFrame, code: str, max_bits: int = 4, bucket_limit: int = 2048, levels: int = 3) -> DataFrame:
    """Forest edges (a, b) whose closure links exactly the distinct codes at most ``max_bits`` apart."""
    every = (1 << 64) - 1
    masks, done = {0: [b for b in _bands(every, max_bits + 1)]}, []
    active = codes.select(F.col(code).alias("code"), F.lit(0).cast("long").alias("mask"))
    for level in range(levels):
        step = F.create_map(*[x for m, bands in masks.items() for x in (
            F.lit(_signed(m)), F.array(*[F.lit(_signed(m | b)) for b in bands]))])
        routed = active.select("code", F.explode(F.element_at(step, F.col("mask"))).alias("mask"))
        routed = routed.withColumn("part", F.col("code").bitwiseAND(F.col("mask")))
        if level == levels - 1:
            done.append(routed)
            break
        routed = stored(routed, "routed")
        hot = stored(routed.groupBy("mask", "part").count().where(F.col("count") > bucket_limit)
                     .select("mask", "part"), "hot")
        if hot.isEmpty():
            done.append(routed)
            break
        done.append(routed.join(hot, ["mask", "part"], "left_anti"))
        active = routed.join(hot, ["mask", "part"], "left_semi").select("code", "mask")
        masks = {m | b: _bands(every & ~(m | b), max_bits + 1) for m, bands in masks.items() for b in bands}

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry = None
        for batch in _ahead(batches):
            table = batch if carry is None else (carry if batch is None else pa.concat_batches([carry, batch]))
            if table is None or not table.num_rows:
                continue
            c, m, p = (table.column(i).to_numpy() for i in range(3))
            change = np.r_[True, (m[1:] != m[:-1]) | (p[1:] != p[:-1])]
            cut = len(c) if batch is None else int(np.flatnonzero(change)[-1])  # the last bucket may go on
            carry = table.slice(cut)
            if cut:
                a, b = forest(c[:cut].view(np.uint64), np.cumsum(change[:cut]), max_bits)
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))],
                                                 names=["a", "b"])

    out = None
    for buckets in done:
        ready = buckets.select("code", "mask", "part").repartition("mask", "part").sortWithinPartitions("mask", "part")
        edges = ready.mapInArrow(search, "a long, b long")
        out = edges if out is None else out.union(edges)
    return out


def _ahead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    """The batches, then None."""
    yield from batches
    yield None


def near_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_bits: int = 4,
                keep_text: bool = False, fingerprint: str = "fingerprint", component: str = "component_id",
                representative: str = "is_representative") -> DataFrame:
    """Rows of ``df`` (without the text unless ``keep_text``) with fingerprint, component and representative flag.

    ``component`` is the least id reachable over links (nulls count last); exactly one row of each
    component, the first by (id, row), is its representative, also when ids repeat or are null. Texts
    without words have fingerprint zero and link like any other. An empty table gives an empty one.
    Input columns with the names of the three outputs are replaced.
    """
    df = without(df, fingerprint, component, representative)
    bits, uid = fresh(df, "bits"), fresh(df, "uid")
    rows = fingerprints(df, text_col, bits, shingle, keep_text=keep_text)
    rows = stored(rows.withColumn(uid, F.monotonically_increasing_id()), "fingerprints")
    first = F.min(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col(uid).alias("uid")))
    codes = stored(rows.groupBy(F.col(bits).alias("code")).agg(first.alias("first"), F.count("*").alias("n")), "codes")
    roots = components(links(codes, "code", max_bits), "a", "b")
    member = stored(codes.join(roots, F.col("code") == F.col("vertex"), "left").select(
        "code", "first", F.coalesce("root", "code").alias("root")), "members")
    least = stored(member.groupBy("root").agg(F.min("first").alias("least"), F.count("*").alias("n")), "least")
    # a component or a fingerprint may hold a third of all rows: both joins split such keys
    top = fresh(rows, "least")
    where = salted_join(member.select("code", "root"), least.select("root", "least"), "root", least.select("root", "n"))
    where = stored(where.select(F.col("code").alias(bits), F.col("least").alias(top)), "groups")
    out = salted_join(rows, where, bits, codes.select(F.col("code").alias(bits), "n"))
    return out.select(
        *[F.col(f"`{c}`") for c in rows.columns if c not in (bits, uid)],
        F.lower(F.lpad(F.hex(bits), 16, "0")).alias(fingerprint), F.col(f"{top}.id").alias(component),
        (F.col(f"{top}.uid") == F.col(uid)).alias(representative))


def deduplicated(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                 max_bits: int = 4) -> DataFrame:
    """One row of each near-duplicate group, with the columns of ``df`` as they came."""
    named = [fresh(df, n) for n in ("fp_", "component_", "first_")]
    out = near_groups(df, id_col, text_col, shingle, max_bits, True, *named)
    return out.where(F.col(named[2])).select(*[F.col(f"`{c}`") for c in df.columns])
