"""Prediction by partial matching over bytes: escape estimation (method D) and symbol exclusion.

A text is its lower-cased words, each followed by a space, then an end byte (line feed). The model of order
``ORDER`` codes each byte after the longest context that the training texts know, and escapes to the next
shorter one if the byte is new there. At a shorter context the bytes already seen at the longer one are
excluded; below order 0 all bytes left are equally likely. A byte seen n of N times has probability
(n - 1/2) / N, the escape takes the halves. So the probabilities after any context sum to 1.

Pretrained scoring as Spark jobs (nothing but the order-1 counts, at most 65,536 numbers, passes the driver):

1. Each partition cuts its documents into blocks of ``BLOCK`` bytes and writes the normalised texts (compressed
   some hundred at a time) and, for each block, its distinct byte strings of ORDER + 1 bytes and its distinct words with training counts,
   as sorted arrays dealt to shards by a hash of the key (two shards for each shuffle partition, so their
   number follows the input, and a frequent key adds one entry a block at most).
2. Shards sum the counts. Of the sums, contexts that end in the same two bytes, of all orders of 2 and more,
   meet in one partition; there the code length of every byte string that occurs anywhere is computed.
3. The shards answer the blocks that asked (a join by shard, then by block), and each block adds up its texts.

Null texts count as empty: they have the end alone. An empty table gives an empty one. Repeated ids are
scored each. Words are told apart by 63-bit hashes.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geotrace.llm.common import held_out, stored

ORDER = 5
BLOCK = 32 << 20  # bytes of text that share one list of keys
CHUNK = 2 << 20  # bytes handled at a time
END = b"\n"
PAD = END * ORDER


def normalised(text: bytes | None) -> bytes:
    words = (text or b"").lower().split()
    return b" ".join([*words, END])


def codes_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(code of each byte with its ORDER predecessors, first position of each text), texts one after another."""
    data = np.frombuffer(PAD + PAD.join(texts), np.uint8).astype(np.int64)
    code = data[ORDER:].copy()
    for i in range(1, ORDER + 1):
        code |= data[ORDER - i : len(data) - i] << (8 * i)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    start = np.cumsum(size + ORDER) - size - ORDER
    return code, start


def _own(code: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Mask of the positions that belong to texts, not to the padding before the next one."""
    own = np.ones(len(code), bool)
    for i in range(1, ORDER + 1):
        own[start[1:] - i] = False
    return own


def word_key(word: bytes) -> int:
    """Odd signed 64-bit key; the keys of byte strings are even."""
    return (xxhash.xxh64_intdigest(word) | 1) - (1 << 63)


def _merge(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    code, at = np.unique(np.concatenate(codes), return_inverse=True)
    return code, np.bincount(at, np.concatenate(counts), len(code)).astype(np.int64)


_ROW = pa.schema([("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("body", pa.binary()),
                  ("shard", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])


def _rows(size: int, **columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(size, f.type)) for f in _ROW], schema=_ROW)


def _dealt(key: np.ndarray, shards: int) -> np.ndarray:
    return ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % shards


def _block_keys(block: int, texts: list[bytes], held: list[bool], shards: int) -> Iterator[pa.RecordBatch]:
    codes, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    words: Counter[bytes] = Counter()
    for told in (True, False):
        some, size = [], 0
        mine = [t for t, h in zip(texts, held, strict=True) if h != told]
        for i, text in enumerate(mine):
            if told:
                words.update(text.split())
                words[END] += 1
            else:
                words.update(dict.fromkeys([*text.split(), END], 0))
            some.append(text)
            size += len(text)
            if size >= CHUNK or i == len(mine) - 1:
                code, start = codes_of(some)
                code, n = np.unique(code[_own(code, start)], return_counts=True)
                codes.append(code)
                counts.append(n if told else np.zeros(len(n), np.int64))
                some, size = [], 0
                if len(codes) > 8:
                    codes, counts = ([x] for x in _merge(codes, counts))
    code, n = _merge(codes, counts)
    key = np.concatenate([code << 1, np.fromiter(map(word_key, words), np.int64, len(words))])
    n = np.concatenate([n, np.fromiter(words.values(), np.int64, len(words))])
    shard = _dealt(key, shards)
    order = np.lexsort((key, shard))
    key, n, shard = key[order], n[order], shard[order]
    first = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]])
    yield _rows(len(first), block=pa.array([block] * len(first), pa.int64()), shard=pa.array(shard[first], pa.int32()),
                keys=pa.array([x.tobytes() for x in np.split(key, first[1:])], pa.binary()),
                counts=pa.array([x.tobytes() for x in np.split(n, first[1:])], pa.binary()))


def _blocks(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    """Rows of some texts (doc_ids, held, body) and of keys (shard, keys, counts), each with its block."""
    block, texts, held, size = TaskContext.get().partitionId() << 32, [], [], 0
    for batch in batches:
        bodies = [normalised(t.as_py()) for t in batch.column(2).cast(pa.large_binary())]
        for at in range(0, len(bodies), 500):
            some, flags = bodies[at : at + 500], batch.column(1).slice(at, 500)
            flags = flags.to_pylist()
            yield _rows(1, block=pa.array([block], pa.int64()), doc_ids=pa.array([batch.column(0).slice(at, 500).to_pylist()], _ROW.field("doc_ids").type),
                        held=pa.array([flags], _ROW.field("held").type),
                        body=pa.array([zstandard.compress(b"".join(some))], pa.binary()))
            texts += some
            held += flags
            size += sum(map(len, some))
            if size >= BLOCK:
                yield from _block_keys(block, texts, held, shards)
                block, texts, held, size = block + 1, [], [], 0
    if texts:
        yield from _block_keys(block, texts, held, shards)


class Level:
    """Counts of one order: codes (context bytes, then the byte) ascending, with totals of each context."""

    def __init__(self, code: np.ndarray, n: np.ndarray):
        self.code, self.n = code, n
        self.context, first = np.unique(code >> 8, return_index=True)
        self.total = np.add.reduceat(n, first) if len(code) else np.zeros(0, np.int64)
        self.distinct = np.diff(np.r_[first, len(code)])

    @staticmethod
    def find(where: np.ndarray, what: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(where):
            return np.zeros(len(what), np.int64), np.zeros(len(what), bool)
        at = np.minimum(np.searchsorted(where, what), len(where) - 1)
        return at, where[at] == what

    def after(self, longer: Level, order: int) -> tuple[np.ndarray, np.ndarray]:
        """For each context of the longer level: count and distinct bytes left here after exclusion."""
        at, _ = self.find(self.code, longer.code & ((1 << 8 * (order + 1)) - 1))
        owner = np.repeat(np.arange(len(longer.context)), longer.distinct)
        gone = np.bincount(owner, self.n[at], len(longer.context)) if len(at) else np.zeros(len(longer.context))
        here, _ = self.find(self.context, longer.context & ((1 << 8 * order) - 1))
        if not len(longer.context):
            return np.zeros(0), np.zeros(0)
        return self.total[here] - gone, (self.distinct[here] - longer.distinct).astype(float)


def log_probabilities(code: np.ndarray, n: np.ndarray, low: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """log10 probability of each code's last byte after its context.

    ``code``/``n``: all byte strings (n = 0: not in training) of complete sets of contexts that share their
    last two bytes; ``low``: the order-1 codes and counts of the whole training text.
    """
    levels, seen = {}, n > 0
    for order in range(2, ORDER + 1):
        levels[order] = Level(*_merge([code[seen] & ((1 << 8 * (order + 1)) - 1)], [n[seen]]))
    levels[1] = Level(*low)
    levels[0] = Level(*_merge([low[0] & 255], [low[1]]))
    out, open_ = np.zeros(len(code)), np.ones(len(code), bool)
    longer = np.full(len(code), -1)  # index of the known context one order up
    for order in range(ORDER, -1, -1):
        level = levels[order]
        at, known = Level.find(level.context, (code >> 8) & ((1 << 8 * order) - 1))
        if not len(level.context):
            continue
        total, distinct = level.total[at].astype(float), level.distinct[at].astype(float)
        if order < ORDER:
            left, kinds = level.after(levels[order + 1], order)
            cut = longer >= 0
            total[cut], distinct[cut] = left[longer[cut]], kinds[longer[cut]]
        here, found = Level.find(level.code, code & ((1 << 8 * (order + 1)) - 1))
        live = open_ & known & (total > 0)
        hit, miss = live & found, live & ~found
        out[hit] += np.log10((level.n[here[hit]] - 0.5) / total[hit])
        out[miss] += np.log10(0.5 * distinct[miss] / total[miss])
        open_ &= ~hit
        longer = np.where(known, at, -1)
    out[open_] -= math.log10(256 - len(levels[0].code))
    return out


class Lookup:
    """Open-addressing table from codes to values (faster than a binary search for many millions of look-ups)."""

    def __init__(self, key: np.ndarray, value: np.ndarray):
        self.bits = max(4, int(2 * max(len(key), 1)).bit_length())
        self.key = np.full(1 << self.bits, -1, np.int64)
        self.value = np.zeros(1 << self.bits)
        slot, todo = self._slot(key), np.arange(len(key))
        while len(todo):
            free = self.key[slot[todo]] == -1
            self.key[slot[todo[free]]] = key[todo[free]]  # of several claims one stays
            done = self.key[slot[todo]] == key[todo]
            self.value[slot[todo[done]]] = value[todo[done]]
            todo = todo[~done]
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, key: np.ndarray) -> np.ndarray:
        """Values of the keys; a key that isn't there raises."""
        slot = self._slot(key)
        held = self.key[slot]
        out = self.value[slot]
        todo = np.flatnonzero(held != key)
        while len(todo):
            if (self.key[slot[todo]] == -1).any():
                raise KeyError("a byte string of the block is missing from its values")
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)
            out[todo] = self.value[slot[todo]]
            todo = todo[self.key[slot[todo]] != key[todo]]
        return out


def _scores(texts: list[bytes], key: np.ndarray, value: np.ndarray, tokens: int, kinds: int) -> tuple[np.ndarray, ...]:
    """(n_tokens, n_known, base_score, score) of the texts of one block from the values of its keys."""
    gram = (key & 1) == 0
    cost = Lookup(key[gram] >> 1, value[gram])
    order = np.argsort(key[~gram])
    words_key, words_n = key[~gram][order], value[~gram][order]
    count: dict[bytes, float] = {}
    n_tokens, n_known, base, score = [], [], [], []
    some, size = [], 0
    for i, text in enumerate(texts):
        words = text.split()
        words.append(END)
        new = [w for w in set(words) if w not in count]
        if new:
            at = np.searchsorted(words_key, np.fromiter(map(word_key, new), np.int64, len(new)))
            count.update(zip(new, words_n[at].tolist(), strict=True))
        c = np.array([count[w] for w in words])
        n_tokens.append(len(words))
        n_known.append(int((c > 0).sum()))
        base.append(float(np.log10(c + 1).sum() - len(words) * math.log10(tokens + kinds + 1)))
        some.append(text)
        size += len(text)
        if size >= CHUNK or i == len(texts) - 1:
            code, start = codes_of(some)
            own = _own(code, start)
            costs = np.zeros(len(code))
            costs[own] = cost(code[own])
            score += np.add.reduceat(costs, start).tolist()
            some, size = [], 0
    return n_tokens, n_known, base, score


def scored(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", modulus: int = 7, remainder: int = 2) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), learnt from documents whose crc32 of the
    id has another remainder. ``base_score`` is an add-one word unigram model, ``score`` the PPM model; both in log10."""
    shards = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(F.col(id_col), modulus, remainder).alias("held"),
                       F.col(text_col))
    rows = stored(rows.mapInArrow(lambda b: _blocks(b, shards), "block long, doc_ids array<long>, held array<boolean>, body binary, "
                                  "shard int, keys binary, counts binary"), "blocks")
    texts = rows.where("shard IS NULL").select(F.col("block").alias("of"), "doc_ids", "held", "body")
    lists = rows.where("shard IS NOT NULL")

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for batch in batches:
            for k, c in zip(batch.column(0), batch.column(1), strict=True):
                keys.append(np.frombuffer(k.as_buffer(), np.int64))
                counts.append(np.frombuffer(c.as_buffer(), np.int64))
            if sum(map(len, keys[1:])) > (1 << 22):
                keys, counts = ([x] for x in _merge(keys, counts))
        key, n = _merge(keys, counts)
        yield pa.RecordBatch.from_arrays([pa.array(_dealt(key, shards), pa.int32()), pa.array(key), pa.array(n)],
                                         names=["shard", "key", "n"])

    sums = stored(lists.select("shard", "keys", "counts").repartition("shard").select("keys", "counts")
                  .mapInArrow(total, "shard int, key long, n long"), "sums")
    even = F.col("key").bitwiseAND(F.lit(1)) == 0
    tokens, kinds = (int(x or 0) for x in sums.where(~even & (F.col("n") > 0)).agg(F.sum("n"), F.count("*")).first())
    grams = sums.where(even).select("shard", F.shiftright("key", 1).alias("code"), "n")
    low = grams.where("n > 0").groupBy(F.col("code").bitwiseAND(F.lit(0xFFFF)).alias("code")).agg(F.sum("n").alias("n"))
    low = sorted(tuple(r) for r in low.collect())  # at most 65,536 rows
    low = (np.array([c for c, _ in low], np.int64), np.array([n for _, n in low], np.int64))

    def model(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [[b.column(i).to_numpy() for i in range(3)] for b in batches if b.num_rows]
        if parts:
            shard, code, n = (np.concatenate(x) for x in zip(*parts, strict=True))
            value = log_probabilities(code, n, low)
            yield pa.RecordBatch.from_arrays([pa.array(shard), pa.array(code << 1), pa.array(value)], names=["of_shard", "key", "value"])

    ending = F.shiftright("code", 8).bitwiseAND(F.lit(0xFFFF))
    costs = grams.repartition(ending).mapInArrow(model, "of_shard int, key long, value double")
    values = stored(costs.union(sums.where(~even).select("shard", "key", F.col("n").cast("double"))), "values")

    def answer(asked: pa.Table, known: pa.Table) -> pa.Table:
        key, value = (known.column(c).to_numpy() for c in ("key", "value"))
        order = np.argsort(key)
        key, value = key[order], value[order]
        found = []
        for k in asked.column("keys"):
            k = np.frombuffer(k.as_buffer(), np.int64)
            v = value[np.searchsorted(key, k)]
            # 4-byte code lengths halve what goes back; word counts (odd keys) follow as whole numbers
            found.append(v.astype(np.float32).tobytes() + v[k & 1 == 1].astype(np.int64).tobytes())
        return pa.table([asked.column("block"), asked.column("keys"), pa.array(found, pa.binary())], names=["block", "keys", "values"])

    answers = lists.select("block", "shard", "keys").groupBy("shard").cogroup(values.groupBy("of_shard")).applyInArrow(
        answer, "block long, keys binary, values binary")

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        keys, values = [], []
        for k, v in zip(right.column("keys"), right.column("values"), strict=True):
            keys.append(np.frombuffer(k.as_buffer(), np.int64))
            values.append(np.frombuffer(v.as_buffer(), np.float32, len(keys[-1])).astype(np.float64))
            values[-1][keys[-1] & 1 == 1] = np.frombuffer(v.as_buffer(), np.uint8)[4 * len(keys[-1]):].view(np.int64)
        key, value = np.concatenate(keys), np.concatenate(values)
        texts = [t for body in left.column("body") for t in zstandard.decompress(body.as_py()).splitlines(keepends=True)]
        found = _scores(texts, key, value, tokens, kinds)
        ids, held = (left.column(c).combine_chunks().flatten() for c in ("doc_ids", "held"))
        return pa.table([ids, held, pa.array(found[0], pa.int64()), pa.array(found[1], pa.int64()),
                         pa.array([tokens] * len(ids), pa.int64()), pa.array(found[2], pa.float64()),
                         pa.array(found[3], pa.float64())], names=[f.name for f in kind.fields])

    kind = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("held_out", T.BooleanType()),
                         *[T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known", "train_tokens")],
                         *[T.StructField(c, T.DoubleType()) for c in ("base_score", "score")]])
    return texts.groupBy("of").cogroup(answers.groupBy("block")).applyInArrow(score, kind)


def adaptive_log10(text: bytes | None, order: int = ORDER) -> float:
    """log10 probability of one text under a model that starts empty and learns each byte after coding it."""
    counts: dict[bytes, dict[int, int]] = {}
    history, total = PAD, 0.0
    for byte in normalised(text):
        excluded: set[int] = set()
        for k in range(order, -1, -1):
            seen = counts.get(history[len(history) - k :])
            left = {b: c for b, c in seen.items() if b not in excluded} if seen else {}
            if not left:
                continue
            room = sum(left.values())
            if byte in left:
                total += math.log10((left[byte] - 0.5) / room)
                break
            total += math.log10(0.5 * len(left) / room)
            excluded.update(left)
        else:
            total -= math.log10(256 - len(excluded))
        for k in range(order + 1):
            followers = counts.setdefault(history[len(history) - k :], {})
            followers[byte] = followers.get(byte, 0) + 1
        history = (history + bytes([byte]))[-order:] if order else b""
    return total


def scored_adaptive(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER) -> DataFrame:
    """(id, score): each text coded by its own adaptive model. One pass, no shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [adaptive_log10(t.as_py(), order) for t in batch.column(1).cast(pa.large_binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=[id_col, "score"])

    kind = T.StructType([docs.schema[id_col], T.StructField("score", T.DoubleType())])
    return docs.select(id_col, text_col).mapInArrow(run, kind)
