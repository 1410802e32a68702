"""Vector codes: integer product codes whose entries are trained over a lexicographic trie of distinct parts.

Each task deals with ``BLOCK`` vectors at a time. At each part position the distinct parts, with their
counts, are sorted lexicographically; runs with an equal prefix are the nodes of a trie. A depth-first walk
carries the squared distances of a prefix to all entries down to its children, so a prefix that many parts
share is measured once; a leaf takes the least distance, and its count weighs the sums of the new entries.
Nothing but those sums is shuffled: (part, entry, component) rows, added up map-side by Spark. The driver
holds the codebooks only (``entries`` vectors). Each round is one scan of the input.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geotrace.llm.common import fresh, stored, without
from geotrace.llm.skew import salted_join

BLOCK = 1 << 15
NODES_AT_ONCE = 4096
#: Scaled components beyond this magnitude count as it, so that sums fit a 38-digit decimal.
FAR = 10**24
LONG_MAX = (1 << 63) - 1
#: Up to this magnitude, sums of squares over any part fit 64-bit integers; beyond, Python integers are used.
SMALL = 1 << 24


@dataclass
class Codebooks:
    """``entries[p]`` is the integer matrix (entry, component) of part position ``p``; ``cuts`` are the parts' borders."""

    entries: list[np.ndarray]
    cuts: list[int]

    def sha256(self) -> str:
        """Of all components as decimal integers by part, entry and position, joined by commas."""
        return hashlib.sha256(",".join(str(int(x)) for e in self.entries for x in e.ravel()).encode()).hexdigest()


def scaled(values: np.ndarray) -> np.ndarray:
    """floor(256 x) as 64-bit integers, or as Python integers where those could overflow."""
    x = np.floor(values.astype(np.float64) * 256)
    if not x.size or np.abs(x).max() <= SMALL:
        return x.astype(np.int64)
    return np.array([min(max(int(v), -FAR), FAR) for v in np.clip(x, -1e300, 1e300).ravel()], object).reshape(x.shape)


def _same_kind(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (a.astype(object), b.astype(object)) if object in (a.dtype, b.dtype) else (a, b)


def distinct_parts(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lexicographically sorted distinct rows, the index of each row among them, and their counts."""
    if not parts.shape[1]:
        return parts[:1], np.zeros(len(parts), np.int64), np.array([len(parts)])
    order = np.lexsort(parts.T[::-1]) if parts.dtype != object else np.array(sorted(range(len(parts)), key=lambda i: tuple(parts[i])), np.int64)
    rows = parts[order]
    new = np.r_[True, (rows[1:] != rows[:-1]).any(axis=1)]
    at = np.empty(len(parts), np.int64)
    at[order] = np.cumsum(new) - 1
    start = np.flatnonzero(new)
    return rows[start], at, np.diff(np.r_[start, len(rows)])


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sorted distinct ``parts``: the nearest entry (least index among ties) and its squared distance."""
    parts, entries = _same_kind(parts, entries)
    n, width = parts.shape
    best, far = np.zeros(n, np.int64), np.zeros(n, parts.dtype)
    if not width:
        return best, far
    differs = np.zeros(n, bool)
    differs[:1] = True
    starts = []  # by depth: the first row of each node
    for d in range(width):
        differs[1:] |= parts[1:, d] != parts[:-1, d]
        starts.append(np.flatnonzero(differs))
    parent = [np.searchsorted(starts[d - 1], starts[d], "right") - 1 if d else np.zeros(len(starts[0]), np.int64) for d in range(width)]
    below = [np.searchsorted(starts[d + 1], np.r_[starts[d], n]) for d in range(width - 1)]
    root = np.zeros((1, len(entries)), parts.dtype)
    todo = [(0, 0, len(starts[0]), root, 0)]  # depth, nodes from .. to, the parents' distances, first parent
    while todo:
        depth, lo, hi, above, first = todo.pop()
        if hi - lo > NODES_AT_ONCE:
            todo.append((depth, lo + NODES_AT_ONCE, hi, above, first))
            hi = lo + NODES_AT_ONCE
        gap = parts[starts[depth][lo:hi], depth][:, None] - entries[:, depth]
        spent = above[parent[depth][lo:hi] - first] + gap * gap
        if depth == width - 1:
            best[lo:hi] = spent.argmin(axis=1)  # leaves are the rows themselves
            far[lo:hi] = spent[np.arange(hi - lo), best[lo:hi]]
        else:
            todo.append((depth + 1, int(below[depth][lo]), int(below[depth][hi]), spent, lo))
    return best, far


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``BLOCK`` rows."""
    held, rows = [], 0
    for b in batches:
        held.append(b)
        rows += b.num_rows
        if rows >= BLOCK:
            yield pa.concat_batches(held)
            held, rows = [], 0
    if rows:
        yield pa.concat_batches(held)


def _vectors(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return scaled(flat.reshape(len(column), -1))


def usable(df: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is neither null nor empty nor holds null or non-finite components, with the commonest length.

    Of equally common lengths the longest counts; vectors of another length can't be cut like the others and go.
    """
    v = F.col(vector)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    good = df.where(v.isNotNull() & (F.size(v) > 0) & fine)
    width = good.groupBy(F.size(v).alias("w")).count().orderBy(F.desc("count"), F.desc("w")).first()
    return good.where(F.size(v) == F.lit(width["w"] if width else 0))


def first_codebooks(rows: DataFrame, id_col: str, vector: str, parts: int, entries: int) -> Codebooks | None:
    """The parts of the ``entries`` rows of least id (nulls last, ties by vector); None without rows."""
    top = rows.select(id_col, vector).orderBy(F.col(id_col).asc_nulls_last(), vector).limit(entries).collect()
    if not top:
        return None
    m = scaled(np.array([r[1] for r in top], np.float64))
    size, more = divmod(m.shape[1], parts)
    cuts = [p * size + min(p, more) for p in range(parts + 1)]
    return Codebooks([m[:, a:b] for a, b in zip(cuts, cuts[1:])], cuts)


def refined(rows: DataFrame, vector: str, books: Codebooks) -> Codebooks:
    """One round: entries become the floor of their parts' component means; unused entries stay."""
    kind = pa.decimal128(38, 0)

    def part_sums(batches):
        total, used = [e.astype(object) * 0 for e in books.entries], [np.zeros(len(e), np.int64) for e in books.entries]
        for batch in _blocks(batches):
            x = _vectors(batch.column(0))
            for p, e in enumerate(books.entries):
                rows_, _, count = distinct_parts(x[:, books.cuts[p]:books.cuts[p + 1]])
                best, _ = nearest(rows_, e)
                sums = np.zeros(e.shape, rows_.dtype)  # at most 2**24 * BLOCK
                np.add.at(sums, best, rows_ * count[:, None])
                total[p] = total[p] + sums
                used[p] += np.bincount(best, count, len(e)).astype(np.int64)
        rows_ = [(p, e, at, int(total[p][e, at]), int(used[p][e])) for p in range(len(used))
                 for e in np.flatnonzero(used[p]) for at in range(total[p].shape[1])]
        if rows_:
            p, e, at, s, n = zip(*rows_)
            yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(at, pa.int32()),
                                              pa.array(s, kind), pa.array(n, pa.int64())], names=["part", "entry", "at", "s", "n"])

    sums = rows.select(vector).mapInArrow(part_sums, "part int, entry int, at int, s decimal(38,0), n long")
    new = [e.astype(object) for e in books.entries]
    for r in sums.groupBy("part", "entry", "at").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect():  # at most the codebooks
        new[r["part"]][r["entry"], r["at"]] = int(r["s"]) // int(r["n"])
    small = all(abs(x) <= SMALL for e in new for x in e.ravel())
    return Codebooks([e.astype(np.int64) if small else e for e in new], books.cuts)


def trained(rows: DataFrame, id_col: str, vector: str, parts: int = 16, entries: int = 64, rounds: int = 2) -> Codebooks | None:
    books = first_codebooks(rows, id_col, vector, parts, entries)
    for _ in range(rounds if books else 0):
        books = refined(rows, vector, books)
    return books


def coded(df: DataFrame, books: Codebooks, vector: str, code: str = "code", error: str = "error") -> DataFrame:
    """``df`` (usable rows) without the vector, with the hexadecimal code and the squared error (at most a long's maximum)."""
    df = without(df, code, error)
    at = df.columns.index(vector)
    rest = [i for i in range(len(df.columns)) if i != at]
    names = [df.columns[i] for i in rest]

    def add(batches):
        for batch in _blocks(batches):
            x = _vectors(batch.column(at))
            codes, spent = np.empty((len(x), len(books.entries)), np.uint8), np.zeros(len(x), object)
            for p, e in enumerate(books.entries):
                rows_, where, _ = distinct_parts(x[:, books.cuts[p]:books.cuts[p + 1]])
                best, far = nearest(rows_, e)
                codes[:, p] = best[where]
                spent = spent + far[where]
            text = codes.tobytes().hex()
            w = 2 * codes.shape[1]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in rest], pa.array([text[i * w:(i + 1) * w] for i in range(len(x))], pa.string()),
                 pa.array([min(int(s), LONG_MAX) for s in spent], pa.int64())], names=[*names, code, error])

    schema = T.StructType([*[df.schema.fields[i] for i in rest], T.StructField(code, T.StringType()), T.StructField(error, T.LongType())])
    return df.mapInArrow(add, schema)


def compressed(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = 16,
               entries: int = 64, rounds: int = 2) -> tuple[DataFrame, Codebooks | None]:
    """(``df``'s usable rows without the vector and with ``code``, ``error``, ``label_error``, ``codebooks_sha256``; the codebooks).

    ``entries`` is at most 256. Rows with unusable vectors (see :func:`usable`) are left out. Repeated and
    null ids are rows like any other; a null label is a label of its own. With fewer than ``entries`` rows
    there are as many entries as rows. Dimensions that ``parts`` doesn't divide make the first parts longer by
    one; components whose 256-fold is beyond 10**24 count as that; sums beyond a long are its maximum.
    An empty table gives an empty one. Other columns stay; those named like an output are replaced.
    """
    outputs = ("code", "error", "label_error", "codebooks_sha256")
    df = without(df, *outputs)
    good = usable(df, vector)
    books = trained(good, id_col, vector, parts, entries, rounds)
    if books is None:
        out = good.drop(vector).select("*", *[F.lit(None).cast(t).alias(c) for c, t in zip(outputs, ("string", "long", "long", "string"))])
        return out, None
    rows = stored(coded(good, books, vector), "codes")
    group, n = fresh(rows, "group_"), fresh(rows, "n_")
    sums = rows.groupBy(F.col(label).alias(group)).agg(
        F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONG_MAX)).cast("long").alias("label_error"), F.count("*").alias(n))
    sums = stored(sums, "labels")
    out = salted_join(rows.withColumn(group, F.col(label)), sums.drop(n), group, sums.select(group, n), n, "inner")
    return out.drop(group).withColumn("codebooks_sha256", F.lit(books.sha256())), books


def codes_sql(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    """The same in SQL, for dimensions that ``parts`` divides, one id a row and sums below 2**53."""
    steps = [f"""kept AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cut AS MATERIALIZED (SELECT vec_id, label, p, list_slice(v, p * (len(v) // {parts}) + 1, (p + 1) * (len(v) // {parts})) AS part
  FROM kept, (SELECT unnest(range({parts})) AS p)),
book0 AS MATERIALIZED (SELECT p, e, part AS entry FROM (SELECT p, part, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e FROM cut) WHERE e < {entries})"""]

    def assign(k: int) -> str:
        gap = "list_sum(list_transform(list_zip(part, entry), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
        return (f"got{k} AS MATERIALIZED (SELECT vec_id, any_value(label) AS label, p, any_value(part) AS part, min({gap} * 256 + e) AS best "
                f"FROM cut JOIN book{k} USING (p) GROUP BY vec_id, p)")
    for k in range(rounds):
        steps += [assign(k), f"""mean{k} AS (SELECT p, e, list(m ORDER BY i) AS entry FROM (
  SELECT p, best % 256 AS e, i, CAST(floor(sum(part[i]) / count(*)) AS BIGINT) AS m FROM (
    SELECT p, best, part, unnest(range(1, len(part) + 1)) AS i FROM got{k}) GROUP BY ALL) GROUP BY p, e)""",
                  f"book{k + 1} AS MATERIALIZED (SELECT p, e, coalesce(m.entry, b.entry) AS entry FROM book{k} b LEFT JOIN mean{k} m USING (p, e))"]
    steps += [assign(rounds), f"""done AS (SELECT vec_id, any_value(label) AS label, string_agg(lpad(lower(printf('%x', CAST(best % 256 AS INTEGER))), 2, '0'), '' ORDER BY p) AS code,
  CAST(sum(best // 256) AS BIGINT) AS error FROM got{rounds} GROUP BY vec_id),
sha AS (SELECT sha256(string_agg(array_to_string(entry, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds})"""]
    return ("WITH " + ",\n".join(steps) + "\nSELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, "
            "codebooks_sha256 FROM done, sha")
