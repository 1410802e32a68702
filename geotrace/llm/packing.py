"""Mixture-controlled packing by deficit round-robin over source queues.

Every source is a queue, its documents' tokens one after the other. Each window of ``window`` tokens gives
queue q its quantum ``window * share_q``; what rounding leaves over is carried to the next window, so after i
windows a queue is never more than a token from its share of them. In closed form, with running sums of the
shares A_q, queue q has spent ``floor(i A_q) - floor(i A_(q-1))`` tokens after i windows. A task therefore
places its documents in their windows by arithmetic alone, once it knows where in its queue each partition
begins: the carried state is one number for each queue and partition. No window waits for another one, and
no source is gathered in one task.

A queue that runs dry gets what it has left, its remaining quantum goes to the others in turn, and the next
segment of windows runs on the shares of those left. The tail of less than a window becomes sequences of
power-of-two lengths, so no sequence needs padding at all.

Steps: (1) each partition tokenizes its documents once and writes ids, counts and each document's place
among the tokens of its source in that partition; (2) sums by (source, partition) become queue positions by
two windows over that small table; (3) the written ids meet their positions and are cut.

Null texts count as empty; a document always has its end id. Null sources form a queue of their own. Rows
are packed each, also repeated ones. An empty table gives an empty one.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geotrace.llm.common import stored
from geotrace.llm.tokens import encoder

LONGEST = 1 << 30  # windows of a segment: keeps all products within 63 bits


def tokenized(docs: DataFrame, tokenizer: str, id_col: str, text_col: str, source_col: str | None, end_id: int) -> DataFrame:
    """(doc_id, key, part, begin, n, ids): ``begin`` counts the tokens of the same key before it in the partition."""
    source = F.col(source_col).cast("string") if source_col else F.lit("")
    key = F.coalesce(F.concat(F.lit("="), source), F.lit("null"))  # a null source is not the source "null"
    rows = docs.select(F.col(id_col).alias("doc_id"), key.alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, spent = encoder(tokenizer), TaskContext.get().partitionId(), {}
        end = np.array([end_id], coder.type).tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                some = batch.slice(at, 1000)
                ids = [coder.encode(t.as_py()) + end for t in some.column(2)]
                n = [len(x) // coder.width for x in ids]
                begin = []
                for k, c in zip(some.column(1).to_pylist(), n, strict=True):
                    begin.append(spent.get(k, 0))
                    spent[k] = begin[-1] + c
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(1), pa.array([part] * len(n), pa.int32()), pa.array(begin, pa.int64()),
                     pa.array(n, pa.int64()), pa.array(ids, pa.binary())], names=["doc_id", "key", "part", "begin", "n", "ids"])

    kind = docs.schema[id_col].dataType
    return rows.mapInArrow(run, T.StructType([
        T.StructField("doc_id", kind), T.StructField("key", T.StringType()), T.StructField("part", T.IntegerType()),
        T.StructField("begin", T.LongType()), T.StructField("n", T.LongType()), T.StructField("ids", T.BinaryType())]))


def schedule(tokens: list[int], shares: list[float], window: int = 4096) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """Segments (first window, windows, tokens spent before by queue, running quanta by queue << shift).

    The running quanta have a leading 0. The last segment may be one window of less than ``window`` tokens.
    """
    shift = 33 - window.bit_length()
    left, spent, out, first = [int(t) for t in tokens], [0] * len(tokens), [], 0
    while total := sum(left):
        open_share = sum(s for s, t in zip(shares, left, strict=True) if t)
        quantum = [window * s / open_share if t else 0.0 for s, t in zip(shares, left, strict=True)]
        edges = [0, *(round(x * (1 << shift)) for x in np.cumsum(quantum))]
        last = max(i for i, t in enumerate(left) if t)
        edges[last + 1 :] = [window << shift] * (len(left) - last)
        taken = lambda i: [(i * b >> shift) - (i * a >> shift) for a, b in zip(edges, edges[1:], strict=False)]  # noqa: E731, B023
        n = min([LONGEST, total // window, *(((t + 1) << shift) // (b - a) for t, a, b in zip(left, edges, edges[1:], strict=False) if b > a)])
        while n and any(x > t for x, t in zip(taken(n), left, strict=True)):
            n -= 1
        if n:
            use = taken(n)
        else:  # some queue has less than its quantum: it gives all, the others fill the window in turn
            n = 1
            use = [min(x, t) for x, t in zip(taken(1), left, strict=True)]
            room = min(window, total) - sum(use)
            for q in range(len(left)):
                more = min(room, left[q] - use[q])
                use[q] += more
                room -= more
            edges = [0, *(int(x) << shift for x in np.cumsum(use))]
        out.append((first, n, np.array(spent, np.int64), np.array(edges, np.int64)))
        first += n
        left = [t - x for t, x in zip(left, use, strict=True)]
        spent = [t + x for t, x in zip(spent, use, strict=True)]
    return out


def _expand(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and values of the ranges first[i] .. last[i]."""
    count = last - first + 1
    row = np.repeat(np.arange(len(first)), count)
    return row, np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + first[row]


def cut(segments: list[tuple[int, int, np.ndarray, np.ndarray]], queue: np.ndarray, begin: np.ndarray, n: np.ndarray,
        window: int, total: int) -> tuple[np.ndarray, ...]:
    """Pieces (row, start, length, sequence, offset) of documents at ``begin`` in their queues, in row order."""
    shift = np.int64(33 - window.bit_length())
    found = []
    spent = np.stack([s[2] for s in segments])
    for q in np.unique(queue):
        rows = np.flatnonzero(queue == q)
        a, e, base = begin[rows], begin[rows] + n[rows], spent[:, q]
        at, seg = _expand(np.searchsorted(base, a, "right") - 1, np.searchsorted(base, e, "left") - 1)
        for s in np.unique(seg):
            first, windows, _, edges = segments[s]
            lo, hi = edges[q], edges[q + 1]
            taken = lambda i: (i * hi >> shift) - (i * lo >> shift)  # noqa: E731, B023
            mine = at[seg == s]
            j, end = np.maximum(a[mine] - base[s], 0), np.minimum(e[mine] - base[s], taken(np.int64(windows)))
            whole = end > j
            mine, j, end = mine[whole], j[whole], end[whole]

            def holding(token: np.ndarray) -> np.ndarray:
                i = np.clip((token * (float(1 << shift) / float(hi - lo))).astype(np.int64), 0, windows - 1)
                while (late := taken(i) > token).any():
                    i -= late
                while (early := taken(i + 1) <= token).any():
                    i += early
                return i
            if not len(mine):
                continue
            k, i = _expand(holding(j), holding(end - 1))
            start, stop = np.maximum(j[k], taken(i)), np.minimum(end[k], taken(i + 1))
            ok = stop > start
            k, i, start, stop = k[ok], i[ok], start[ok], stop[ok]
            before = ((i + 1) * lo >> shift) - (i * lo >> shift)
            row = rows[mine[k]]
            found.append((row, start + base[s] - begin[row], stop - start, first + i, before + start - taken(i)))
    row, start, length, sequence, offset = (np.concatenate(x) for x in zip(*found, strict=True))
    full, rest = divmod(total, window)
    tail = np.flatnonzero(sequence == full)
    if rest & (rest - 1) and len(tail):  # the tail becomes sequences of power-of-two lengths
        edges = np.cumsum([0] + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1])
        k, part = _expand(np.searchsorted(edges, offset[tail], "right") - 1,
                          np.searchsorted(edges, offset[tail] + length[tail], "left") - 1)
        t = tail[k]
        a, e = np.maximum(offset[t], edges[part]), np.minimum(offset[t] + length[t], edges[part + 1])
        keep = sequence != full
        row, start, length, sequence, offset = (np.concatenate(x) for x in (
            (row[keep], row[t]), (start[keep], start[t] + a - offset[t]), (length[keep], e - a),
            (sequence[keep], full + part), (offset[keep], a - edges[part])))
    order = np.lexsort((start, row))
    return row[order], start[order], length[order], sequence[order], offset[order]


def interleaved(rows: DataFrame, units: DataFrame, weights: DataFrame) -> DataFrame:
    """(key, part, begin, place): where each document of the pooled sources begins in the pool queue.

    ``weights`` (key, n, weight): tokens and wanted share of each pooled source. A document's turn comes when its
    source, spending at the rate of its weight, has spent the tokens up to a point inside the document; that point
    is the same fraction of all documents of a source, hashed, so that sources of one document spread evenly. The
    order is a range sort; partition sums give the places, so no task holds the whole pool.
    """
    before = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = units.select("key", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("from"))
    phase = F.pmod(F.xxhash64("key"), F.lit(1 << 20)) / float(1 << 20)
    turn = (F.col("from") + F.col("begin") + phase * F.col("n")) / F.col("weight")
    docs = rows.select("key", "part", "begin", "n").join(bases, ["key", "part"]).join(weights.select("key", "weight"), "key")
    docs = docs.select("key", "part", "begin", "n", turn.alias("turn")).repartitionByRange("turn", "key", "part", "begin")
    docs = stored(docs.withColumn("range", F.spark_partition_id()), "pool")
    sums = docs.groupBy("range").agg(F.sum("n").alias("n")).select("range", F.coalesce(F.sum("n").over(
        Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))  # one row a partition
    inside = Window.partitionBy("range").orderBy("turn", "key", "part", "begin").rowsBetween(Window.unboundedPreceding, -1)
    return docs.join(sums, "range").select("key", "part", "begin", (
        F.col("base") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("place"))


def pack(docs: DataFrame, tokenizer: str, window: int = 4096, end_id: int = 2, id_col: str = "doc_id",
         text_col: str = "text", source_col: str | None = "source", targets: Mapping[str | None, float] | None = None,
         with_ids: bool = True) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source, ids) of all documents.

    ``targets``: token share wanted of each source in every window; None: the share the source has of all
    tokens, so that all queues end together. Sources without a target share what is left as they come.
    Queues that would get less than two tokens a window go into one pool queue, so there are at most
    ``window / 2`` queues whatever the number of sources. Inside the pool the sources' documents are interleaved
    by their running shares (see ``interleaved``), small targets included. ``ids`` (array of int) only if ``with_ids``.
    """
    spark = docs.sparkSession
    rows = stored(tokenized(docs, tokenizer, id_col, text_col, source_col, end_id), "tokens")
    units = stored(rows.groupBy("key", "part").agg(F.sum("n").alias("n")), "units")
    total = units.agg(F.sum("n")).first()[0] or 0
    wanted = {"null" if s is None else f"={s}": w for s, w in (targets or {}).items()}
    sums = units.groupBy("key").agg(F.sum("n").alias("n"))
    large = F.col("n") * window >= 2 * total
    own = {r.key: r.n for r in sums.where(F.col("key").isin(list(wanted)) if wanted else large).collect()}
    if wanted:
        shares = {k: wanted[k] for k in own if wanted[k] * window >= 2}
        pool_share = max(1 - sum(shares.values()), 2 / window)
    else:
        shares = {k: n / max(total, 1) for k, n in own.items()}
        pool_share = 1 - sum(shares.values())
    pooled = total - sum(own[k] for k in shares)
    while shares and 0 < pooled and pool_share * window < 2:  # a pool too small joins the smallest queue
        least = min(shares, key=lambda k: (shares[k], k))
        pooled, pool_share = pooled + own[least], pool_share + shares.pop(least)
    keys = sorted(shares)
    segments = schedule([own[k] for k in keys] + [pooled], [shares[k] for k in keys] + [pool_share], window)

    queues = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "key string, queue int")
    own_units = units.join(queues, "key")
    before = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    places = stored(own_units.select("key", "part", "queue", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "places")
    columns = ["doc_id", F.when(F.col("key") != "null", F.expr("substring(key, 2)")).alias("source"), "queue", "begin", "n", "ids"]
    placed = rows.join(places, ["key", "part"]).withColumn("begin", F.col("base") + F.col("begin")).select(*columns)
    if pooled:
        small = sums.join(queues, "key", "left_anti")
        untold = ~F.col("key").isin(list(wanted)) if wanted else F.lit(True)
        rest = max(1 - sum(wanted.values()), 2 / window) if wanted else 1.0
        theirs = (small.where(untold).agg(F.sum("n")).first()[0] or 1) if wanted else total
        weight = F.col("n") * (rest / theirs)
        for k, w in wanted.items():
            if w > 0:
                weight = F.when(F.col("key") == k, float(w)).otherwise(weight)
        small = stored(small.withColumn("weight", weight.cast("double")), "pooled")
        loose = rows.join(small.select("key"), "key", "left_semi")
        order = stored(interleaved(loose, units.join(small.select("key"), "key", "left_semi"), small), "order")
        placed = placed.unionByName(loose.join(order, ["key", "part", "begin"]).withColumn("begin", F.col("place")).withColumn(
            "queue", F.lit(len(keys))).select(*columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = encoder(tokenizer).type
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                some = batch.slice(at, 2000)
                queue, begin, n = (some.column(i).to_numpy() for i in (2, 3, 4))
                row, start, length, sequence, offset = cut(segments, queue, begin, n, window, total)
                raw = [np.frombuffer(x.as_buffer(), width).astype("<u4") for x in some.column(5)]
                views = [memoryview(x).cast("B") for x in raw]
                crc = [zlib.crc32(views[r][4 * a : 4 * (a + m)]) for r, a, m in zip(row.tolist(), start.tolist(), length.tolist(), strict=True)]
                columns = [some.column(0).take(pa.array(row)), pa.array(start), pa.array(length), pa.array(crc, pa.int64()),
                           pa.array(n[row]), pa.array(sequence), pa.array(offset), some.column(1).take(pa.array(row))]
                if with_ids:  # pieces are in row and start order, so the ids follow one another
                    flat = np.concatenate(raw).view(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(length)], pa.int32()), pa.array(flat)))
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in kind.fields])

    kind = T.StructType([
        T.StructField("doc_id", docs.schema[id_col].dataType), *[T.StructField(c, T.LongType()) for c in (
            "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")], T.StructField("source", T.StringType())])
    if with_ids:
        kind = kind.add("ids", T.ArrayType(T.IntegerType()))
    return placed.mapInArrow(run, kind)


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids): the whole sequences, at most a window of ids each."""
    parts = pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"))
