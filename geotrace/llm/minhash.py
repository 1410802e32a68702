"""MinHash near-duplicates by an inverted join of signature coordinates.

1. ``sketches``: per text the distinct word shingles (XXH64), their number, a 128-bit key of the set and a
   signature of ``COORDINATES`` minima. Equal sets are one class from here on, so copies cost one row.
2. Posting: a class is posted under (coordinate, value) pairs. Two signatures with ``MATCHES`` equal
   coordinates share one of the first ``COORDINATES - MATCHES + 1`` pairs of each in any common order, so only
   that prefix is posted. The order is rarest first, by counts hashed to ``BUCKETS`` cells (a table of fixed
   size): lists of very common pairs are skipped, and met only by comparing whole signatures.
3. Merging: the members of a list count their equal coordinates, 8 bits of each; pairs below ``MATCHES``
   drop out, and pairs that earlier ones tie together are skipped. Only a spanning forest leaves a list. The
   components of all forests hold every pair above the match threshold.
4. Confirming: the full sets of a component's classes, read again from the texts, meet in one task, which
   counts common shingles through the lists of classes by shingle and again lets out a spanning forest only:
   that of the confirmed links.

Lists and components above a limit are dealt by hash over parts first. Members of different parts then meet
in cells, one for each pair of blocks, but never members of the component that holds most of a list: once
the parts have tied a large group together, only the others are compared with it.

Links are 100 * intersection >= ``percent`` * union. At 80 % a linked pair misses ``MATCHES`` = 16 of 40
coordinates with probability 6e-9, and that shows only if nothing else ties the two together. Shingles
are compared by 64-bit and sets by 128-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geotrace.llm.common import bit_filter, fresh, stored, without
from geotrace.llm.components import components
from geotrace.llm.simhash import _union
from geotrace.llm.skew import salted_join

COORDINATES = 40
MATCHES = 16
PREFIX = COORDINATES - MATCHES + 1
BUCKETS = 1 << 18
#: Members of a list, and shingles of a component, that one task takes (or four times the mean of a count cell).
LIST = 4096
SHINGLES = 1 << 20
PAIRS_AT_ONCE = 1 << 20
#: The filter that picks texts to read again has 2**FILTER_BITS bits, 8 MB.
FILTER_BITS = 26

_RANDOM = np.random.default_rng(20240817).integers(0, 1 << 63, (2, COORDINATES), dtype=np.uint64)
_FLIPS, _FACTORS = _RANDOM[0], _RANDOM[1] | np.uint64(1)


def shingle_set(text: bytes | None, shingle: int) -> np.ndarray:
    """Sorted distinct XXH64 values of the shingles; fewer words make one shingle, none make none."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    body = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    start = end - size
    if len(words) > shingle:
        start, end = start[: len(words) - shingle + 1], end[shingle - 1:]
    else:
        start, end = start[:1], end[-1:]
    one = xxhash.xxh64_intdigest
    h = np.fromiter((one(body[a:b], 42) for a, b in zip(start.tolist(), end.tolist(), strict=True)), np.uint64, len(start))
    return np.unique(h)


def signature(values: np.ndarray) -> np.ndarray:
    """The least 32-bit hash of the set at each coordinate."""
    least = np.full(COORDINATES, np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(values), 2048):
        mixed = (values[None, at:at + 2048] ^ _FLIPS[:, None]) * _FACTORS[:, None]
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        least = np.minimum(least, mixed.min(axis=1))
    return (least >> np.uint64(32)).astype("<u4")


def sketches(df: DataFrame, text_col: str, names: dict[str, str], shingle: int) -> DataFrame:
    """``df`` without the text, with ``n``, ``set_key``, ``text_key`` and ``signature`` (null for texts without words)."""
    at = df.columns.index(text_col)
    rest = [i for i in range(len(df.columns)) if i != at]

    def add(batches):
        for batch in batches:
            n, set_key, text_key, sign = [], [], [], []
            for text in batch.column(at).cast(pa.large_binary()):
                text = text.as_py()
                values = shingle_set(text, shingle)
                n.append(len(values))
                set_key.append(xxhash.xxh3_128_digest(values.tobytes()) if len(values) else None)
                text_key.append(xxhash.xxh3_128_digest(text) if len(values) else None)
                sign.append(signature(values).tobytes() if len(values) else None)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in rest], pa.array(n, pa.int64()), *[pa.array(x, pa.binary()) for x in (set_key, text_key, sign)]],
                names=[*[batch.schema.names[i] for i in rest], *names.values()])

    new = [T.StructField(names["n"], T.LongType()), *[T.StructField(names[c], T.BinaryType()) for c in ("set_key", "text_key", "signature")]]
    return df.mapInArrow(add, T.StructType([*[df.schema.fields[i] for i in rest], *new]))


# --- posting -------------------------------------------------------------------------------

def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u4").reshape(-1, COORDINATES)


def _keys(signs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(coordinate, value) as one number, and its cell of the count table."""
    keys = signs.astype(np.uint64) | (np.arange(COORDINATES, dtype=np.uint64) << np.uint64(32))
    return keys, ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 18)).astype(np.int64)


def _prefix(signs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The keys and cells of the ``PREFIX`` rarest pairs of each signature."""
    keys, cells = _keys(signs)
    order = np.lexsort((keys, counts[cells]))[:, :PREFIX]
    return np.take_along_axis(keys, order, 1), np.take_along_axis(cells, order, 1)


def pair_counts(classes: DataFrame) -> np.ndarray:
    """Classes by cell of the count table: ``BUCKETS`` numbers, whatever the size of the input."""
    def part(batches):
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            if batch.num_rows:
                total += np.bincount(_keys(_signatures(batch.column(0)))[1].ravel(), minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], names=["cell", "n"])

    return _by_cell(classes.select("signature").mapInArrow(part, "cell int, n long"))


def _by_cell(rows: DataFrame) -> np.ndarray:
    got = rows.groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(BUCKETS, np.int64)
    out[got["cell"]] = got["n"]
    return out


def _limit(counts: np.ndarray, least: int) -> int:
    """What a task takes: cells of the table hold many rare keys where the input is very large."""
    return max(least, 4 * int(counts.sum()) // BUCKETS)


def _main_components(rows: DataFrame) -> dict[str, np.ndarray]:
    """Of (cell, component, n): by cell the component with most, and how much is in it and outside it."""
    by = rows.groupBy("cell", "component").agg(F.sum("n").alias("n"))
    top = by.groupBy("cell").agg(F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("n"))  # at most BUCKETS rows
    got = top.select("cell", F.col("top.component").alias("most"), F.col("top.n").alias("inside"), (F.col("n") - F.col("top.n")).alias("outside"))
    got = got.toPandas().sort_values("cell")
    return {c: got[c].to_numpy(np.int64) for c in ("cell", "most", "inside", "outside")}


def _mixed(ids: np.ndarray) -> np.ndarray:
    return ((ids.view(np.uint64) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(33)).astype(np.int64)


def _cells(ids, component, cells, main: dict[str, np.ndarray], limit: int, at_once: int = 256) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(which member, part) copies of members of long lists, in slices.

    Blocks of the members outside the main component meet each other and the blocks inside; blocks inside never meet.
    """
    where = np.searchsorted(main["cell"], cells)
    inside = component == main["most"][where]
    blocks_in, blocks_out = (-(-main[c][where] // limit) for c in ("inside", "outside"))
    own = _mixed(ids) % np.maximum(np.where(inside, blocks_in, blocks_out), 1)
    copies = np.where(inside, blocks_out, blocks_out + blocks_in)
    for lo in range(0, len(ids), at_once):  # bounded memory, however many cells there are
        take = np.arange(lo, min(lo + at_once, len(ids)))
        k = np.repeat(take, copies[take])
        other = np.arange(len(k)) - np.repeat(np.cumsum(copies[take]) - copies[take], copies[take])
        among = ~inside[k] & (other < blocks_out[k])
        least, most = np.minimum(own[k], other), np.maximum(own[k], other)
        width = blocks_out[k] + blocks_in[k]
        yield k, np.where(among, least * width + most, np.where(inside[k], other * width + blocks_out[k] + own[k], own[k] * width + other))


POSTING = "key long, part long, class long, n long, component long, bytes binary"


def _posted(batch: pa.RecordBatch, row: np.ndarray, key: np.ndarray, part: np.ndarray) -> pa.RecordBatch:
    """Postings of the batch's rows (class, n, signature[, component])."""
    low = _signatures(batch.column(2)).astype(np.uint8)[row]
    ids = batch.column(0).to_numpy()[row]
    component = batch.column(3).to_numpy()[row] if batch.num_columns > 3 else ids
    data = pa.FixedSizeBinaryArray.from_buffers(pa.binary(COORDINATES), len(row), [None, pa.py_buffer(np.ascontiguousarray(low))])
    return pa.RecordBatch.from_arrays(
        [pa.array(key.view(np.int64)), pa.array(part), pa.array(ids), pa.array(batch.column(1).to_numpy()[row]), pa.array(component),
         data.cast(pa.binary())], names=["key", "part", "class", "n", "component", "bytes"])


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 2048) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def posted_once(classes: DataFrame, counts, limit: int) -> DataFrame:
    """Prefix postings, long lists cut by hash into parts."""
    def post(batches):
        for batch in _slices(batches):
            keys, cells = _prefix(_signatures(batch.column(2)), counts.value)
            parts = _mixed(batch.column(0).to_numpy())[:, None] % -(-counts.value[cells] // limit)
            row, at = np.nonzero(counts.value[cells] > 1)
            yield _posted(batch, row, keys[row, at], parts[row, at])

    return classes.select("class", "n", "signature").mapInArrow(post, POSTING)


def posted_again(classes: DataFrame, counts, limit: int) -> DataFrame:
    """Postings of long lists only, in cells of members of different components (see :func:`_cells`)."""
    def count(batches):
        for batch in _slices(batches, 1 << 14):
            _, cells = _prefix(_signatures(batch.column(2)), counts.value)
            row, at = np.nonzero(counts.value[cells] > limit)
            if len(row):
                pairs, n = np.unique(np.c_[cells[row, at], batch.column(3).to_numpy()[row]], axis=0, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0], pa.int32()), pa.array(pairs[:, 1]), pa.array(n, pa.int64())], names=["cell", "component", "n"])

    rows = classes.select("class", "n", "signature", "component")
    main = classes.sparkSession.sparkContext.broadcast(_main_components(rows.mapInArrow(count, "cell int, component long, n long")))

    def post(batches):
        for batch in _slices(batches):
            keys, cells = _prefix(_signatures(batch.column(2)), counts.value)
            row, at = np.nonzero(counts.value[cells] > limit)
            if len(row):
                ids, component = (batch.column(i).to_numpy()[row] for i in (0, 3))
                for k, part in _cells(ids, component, cells[row, at], main.value, limit):
                    yield _posted(batch, row[k], keys[row[k], at[k]], part)

    return rows.mapInArrow(post, POSTING)


# --- merging -------------------------------------------------------------------------------

def _ahead(batches):
    yield from batches
    yield None


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Rows of whole (key, part) lists, sorted by these first two columns, with the starts of the lists."""
    carry = None
    for batch in _ahead(batches):
        table = batch if carry is None else (carry if batch is None else pa.concat_batches([carry, batch]))
        if table is None or not table.num_rows:
            continue
        key, part = table.column(0).to_numpy(), table.column(1).to_numpy()
        new = np.r_[True, (key[1:] != key[:-1]) | (part[1:] != part[:-1])]
        cut = table.num_rows if batch is None else int(np.flatnonzero(new)[-1])
        carry = table.slice(cut)
        if cut:
            yield table.slice(0, cut), np.flatnonzero(new[:cut])


def _grouped(postings: DataFrame, *order: str) -> DataFrame:
    return postings.repartition("key", "part").sortWithinPartitions("key", "part", *order)


def _edges(label: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    tied = np.flatnonzero(label != np.arange(len(label)))
    a, b = ids[tied], ids[label[tied]]
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])


def candidate_forest(postings: DataFrame, percent: int) -> DataFrame:
    """Forest edges (a, b) over the pairs of each list that have near sizes, ``MATCHES`` equal coordinates and different components."""
    def merge(batches):
        for table, start in _whole(batches):
            size = np.diff(np.r_[start, table.num_rows])
            keep = np.flatnonzero(np.repeat(size, size) > 1)
            if not len(keep):
                continue
            table = table.take(pa.array(keep))
            begin = np.repeat(np.cumsum(size[size > 1]) - size[size > 1], size[size > 1])
            ids, n, component = (table.column(i).to_numpy() for i in (2, 3, 4))
            data = np.frombuffer(b"".join(table.column(5).to_pylist()), np.uint8).reshape(-1, COORDINATES)
            # members are in order of n: each meets the later ones up to the greatest size that can be linked
            tag = begin.astype(np.int64) << 40  # sizes are below 2**40
            end = np.searchsorted(tag + n, tag + n * 100 // percent, "right")
            first = np.arange(len(ids)) + 1
            todo = np.maximum(end - first, 0)
            total = np.r_[0, np.cumsum(todo)]
            label, at = np.arange(len(ids)), 0
            while at < len(ids):
                to = max(at + 1, int(np.searchsorted(total, total[at] + PAIRS_AT_ONCE, "right")) - 1)
                a = np.repeat(np.arange(at, to), todo[at:to])
                b = np.arange(len(a)) - np.repeat(total[at:to] - total[at], todo[at:to]) + first[a]
                open_ = (component[a] != component[b]) & (label[a] != label[b])
                a, b = a[open_], b[open_]
                same = (data[a] == data[b]).sum(axis=1) >= MATCHES
                _union(label, a[same], b[same])
                at = to
            yield _edges(label, ids)

    return _grouped(postings, "n", "class").mapInArrow(merge, "a long, b long").distinct()


# --- confirming ----------------------------------------------------------------------------

def full_sets(texts: DataFrame, needed: DataFrame, shingle: int) -> DataFrame:
    """(class, root, values) of the classes in ``needed`` (class, root, text_key), from the texts themselves.

    A bit filter of fixed size picks the texts to work out; the join with ``needed`` removes what it lets through.
    """
    bit = F.conv(F.hex(F.substring("text_key", 1, 4)), 16, 10).cast("long").bitwiseAND((1 << FILTER_BITS) - 1)
    whole = bit_filter(needed, bit, FILTER_BITS)
    wanted = texts.sparkSession.sparkContext.broadcast(whole)

    def work(batches):
        for batch in batches:
            keys, values, seen = [], [], set()
            for text in batch.column(0).cast(pa.large_binary()):
                text = text.as_py()
                key = xxhash.xxh3_128_digest(text) if text else None
                if key and key not in seen:
                    seen.add(key)
                    at = int.from_bytes(key[:4], "big") & ((1 << FILTER_BITS) - 1)
                    if wanted.value[at >> 3] >> (at & 7) & 1:
                        keys.append(key)
                        values.append(shingle_set(text, shingle).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(values, pa.binary())], names=["text_key", "values"])

    found = texts.mapInArrow(work, "text_key binary, values binary")
    return found.join(needed, "text_key").drop("text_key")  # a class may come several times, from several copies


def _linked(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """The least tied member of each of ``sets``; members are tied if they are alike.

    Common shingles are counted over the lists of members by shingle, one member against all later ones at a time.
    """
    n = np.array([len(x) for x in sets])
    owner = np.repeat(np.arange(len(sets)), n)
    _, shingle, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = often[shingle] > 1
    owner, shingle = owner[shared], shingle[shared]
    order = np.argsort(shingle, kind="stable")
    members, begin = owner[order], np.searchsorted(shingle[order], np.arange(len(often) + 1))
    label, at = np.arange(len(sets)), np.searchsorted(owner, np.arange(len(sets) + 1))
    for x in range(len(sets) - 1):
        mine = shingle[at[x]:at[x + 1]]
        lists = begin[mine + 1] - begin[mine]
        flat = np.arange(lists.sum()) - np.repeat(np.cumsum(lists) - lists, lists) + np.repeat(begin[mine], lists)
        both = np.bincount(members[flat], minlength=len(sets))
        alike = 100 * both >= percent * (n + n[x] - both)
        y = np.flatnonzero(alike & (label != label[x]) & (np.arange(len(sets)) > x))
        if len(y):
            _union(label, np.full(len(y), x), y)
    return label


def confirmed_forest(rows: DataFrame, percent: int) -> DataFrame:
    """Forest edges (a, b) of the confirmed links inside each (key, part) group of (key, part, class, values)."""
    def check(batches):
        for table, start in _whole(batches):
            ids, values = table.column(2).to_numpy(), table.column(3)
            for lo, hi in zip(start, np.r_[start[1:], len(ids)]):
                at = lo + np.flatnonzero(np.r_[True, ids[lo + 1:hi] != ids[lo:hi - 1]])
                if len(at) > 1:
                    sets = [np.frombuffer(values[int(i)].as_buffer(), np.uint64) for i in at]
                    yield _edges(_linked(sets, percent), ids[at])

    return _grouped(rows.select("key", "part", "class", "values"), "class").mapInArrow(check, "a long, b long").distinct()


def confirmed(sets: DataFrame, percent: int) -> DataFrame:
    """Confirmed links (a, b) among the classes of each component; ``sets`` is a stored (class, root, values)."""
    spark = sets.sparkSession
    shingles = (F.length("values") / 8).cast("long")
    rows = sets.select(F.col("root").alias("key"), "class", "values", F.pmod(F.xxhash64("root"), F.lit(BUCKETS)).cast("int").alias("cell"))
    counts = _by_cell(rows.select("cell", shingles.alias("n")))
    limit = _limit(counts, SHINGLES)
    counts = spark.sparkContext.broadcast(counts)

    def once(batches):
        for b in _slices(batches):
            part = _mixed(b.column(1).to_numpy()) % -(-counts.value[b.column(3).to_numpy()] // limit)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(part), b.column(1), b.column(2)], names=["key", "part", "class", "values"])

    shape = "key long, part long, class long, values binary"
    out = stored(confirmed_forest(rows.mapInArrow(once, shape), percent), "links")
    if (counts.value <= limit).all():
        return out
    known = components(out, "a", "b").select(F.col("vertex").alias("class"), F.col("root").alias("component"))
    large = spark.createDataFrame([(int(c),) for c in np.flatnonzero(counts.value > limit)], "cell int")  # at most a quarter of BUCKETS
    long = rows.join(F.broadcast(large), "cell", "left_semi").join(known, "class", "left")
    long = long.select("key", "class", "values", "cell", F.coalesce("component", "class").alias("component"))
    main = spark.sparkContext.broadcast(_main_components(long.select("cell", "component", shingles.alias("n"))))

    def again(batches):
        for b in _slices(batches, 64):
            ids, component = b.column(1).to_numpy(), b.column(4).to_numpy()
            for k, part in _cells(ids, component, b.column(3).to_numpy(), main.value, limit, 4):
                k = pa.array(k)
                yield pa.RecordBatch.from_arrays([b.column(0).take(k), pa.array(part), b.column(1).take(k), b.column(2).take(k)], names=["key", "part", "class", "values"])

    return out.union(stored(confirmed_forest(long.mapInArrow(again, shape), percent), "links"))


def links(texts: DataFrame, classes: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Confirmed pairs (a, b) of classes whose closure is that of all pairs alike.

    ``classes`` is a stored (class, n, signature, text_key) with one row for each distinct set.
    """
    spark = classes.sparkSession
    counts = pair_counts(classes)
    limit = _limit(counts, LIST)
    given = spark.sparkContext.broadcast(counts)
    pairs = stored(candidate_forest(posted_once(classes, given, limit), percent), "candidates")
    roots = components(pairs, "a", "b")
    if (counts > limit).any():
        tied = classes.join(roots, F.col("class") == F.col("vertex"), "left")
        tied = stored(tied.select("class", "n", "signature", F.coalesce("root", "class").alias("component")), "tied")
        more = stored(candidate_forest(posted_again(tied, given, limit), percent), "candidates")
        roots = components(pairs.union(more), "a", "b")
    own = roots.select("root").distinct().select(F.col("root").alias("vertex"), "root")
    needed = roots.union(own).distinct().join(classes.select("class", "text_key"), F.col("vertex") == F.col("class"))
    needed = stored(needed.select("class", "root", "text_key"), "needed")
    return confirmed(stored(full_sets(texts, needed, shingle), "sets"), percent)


def near_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80,
                size: str = "n_shingles", component: str = "component_id") -> DataFrame:
    """Rows of ``df`` without the text, with the set's size and the least id of the row's component.

    Null, empty and blank texts have size 0 and are linked with nothing: their component is their own id.
    Nulls count as the last ids; repeated ids are rows of their own. An empty table gives an empty one.
    Input columns with the names of the two outputs are replaced.
    """
    df = without(df, size, component)
    names = {c: fresh(df, f"{c}_") for c in ("n", "set_key", "text_key", "signature")}
    n, set_key, text_key, sign = names.values()
    rows = stored(sketches(df, text_col, names, shingle), "sketches")
    first = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"))
    by_set = stored(rows.groupBy(F.col(set_key).alias("set_key")).agg(
        F.min(text_key).alias("text_key"), F.min(n).alias("n"), F.min(sign).alias("signature"), F.min(first).alias("first"),
        F.count("*").alias("rows")).withColumn("class", F.monotonically_increasing_id()), "classes")
    classes = by_set.where("set_key IS NOT NULL")
    texts = df.select(text_col)
    roots = components(links(texts, classes.select("class", "n", "signature", "text_key"), shingle, percent), "a", "b")
    member = stored(classes.select("class", "set_key", "first").join(roots, F.col("class") == F.col("vertex"), "left").select(
        "set_key", "first", F.coalesce("root", "class").alias("root")), "members")
    least = stored(member.groupBy("root").agg(F.min("first").alias("least"), F.count("*").alias("n")), "least")
    where = salted_join(member.select("set_key", "root"), least.select("root", "least"), "root", least.select("root", "n"))
    where = stored(where.select(F.col("set_key").alias(set_key), F.col("least.id").alias(component), F.lit(True).alias(text_key)), "groups")
    counts = by_set.select(F.col("set_key").alias(set_key), F.col("rows"))
    out = salted_join(rows.drop(text_key, sign), where, set_key, counts, "rows", "left")
    return out.select(*[F.col(f"`{c}`") for c in df.columns if c != text_col], F.col(n).alias(size),
                      F.when(F.col(text_key).isNull(), F.col(f"`{id_col}`")).otherwise(F.col(component)).alias(component))


def groups_sql(shingle: int = 4, percent: int = 80) -> str:
    """The same in SQL on plain shingle strings."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""WITH RECURSIVE split AS (SELECT doc_id, list_filter(regexp_split_to_array({lower}, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents),
sets AS MATERIALIZED (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {shingle} THEN [array_to_string(w, ' ')]
  ELSE list_sort(list_distinct(list_transform(range(1, len(w) - {shingle} + 2), lambda i: array_to_string(list_slice(w, i, i + {shingle - 1}), ' ')))) END AS s FROM split),
class AS MATERIALIZED (SELECT s, len(s) AS n, min(doc_id) AS c FROM sets WHERE len(s) > 0 GROUP BY s),
item AS MATERIALIZED (SELECT c, n, unnest(s) AS x FROM class),
pair AS (SELECT a.c AS a, b.c AS b FROM item a JOIN item b ON a.x = b.x AND a.c < b.c
  AND 100 * least(a.n, b.n) >= {percent} * greatest(a.n, b.n)
  GROUP BY a.c, b.c HAVING 100 * count(*) >= {percent} * (any_value(a.n) + any_value(b.n) - count(*))),
edge AS MATERIALIZED (SELECT a, b FROM pair UNION ALL SELECT b, a FROM pair),
reach AS (SELECT c AS v, c AS r FROM class UNION SELECT e.b, reach.r FROM reach JOIN edge e ON e.a = reach.v WHERE reach.r < e.b),
root AS (SELECT v, min(r) AS r FROM reach GROUP BY v)
SELECT doc_id, len(sets.s) AS n_shingles, coalesce(r, doc_id) AS component_id, doc_id = coalesce(r, doc_id) AS kept
FROM sets LEFT JOIN class ON sets.s = class.s LEFT JOIN root ON class.c = root.v"""
