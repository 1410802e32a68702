"""Exact DBSCAN on Spark (K5): spatial blocks, eps-balls that visit the blocks they reach, contracted components.

1. **Blocks.** A bounded sample of the points sets the cuts of a k-d tree; a leaf with more than ``block_rows``
   points (copies can't be cut apart) is dealt out over several blocks. The tree only says which points lie
   together: whatever the sample, every point is in one block and the result is the same.
2. **Core points.** A block counts neighbours among its own points. Only points that have fewer than
   ``min_samples`` there *visit* the other blocks whose bounding box their eps-ball reaches.
3. **Components.** A block joins its core points into local components. First :data:`SCOUTS` points of each large
   local component visit the blocks in reach, which joins most of what belongs together; then every core point
   outside the largest component found so far does. Two core points within ``eps`` are thus either in one
   component already or are compared. No pair rows are emitted: a link names two local components.
4. **Labels.** Minimum-id labels spread over the links with pointer jumping until nothing changes. Clusters are
   numbered 0.. by their first member in ``order``; border points take the smallest cluster among their core
   neighbours; the rest are -1, and so are points with a null or non-finite coordinate.

Groups are bounded: at most ``block_rows`` residents (about) and :data:`VISITORS` visitors (about) meet in a task.
Distances come from a matrix product; pairs too close to ``eps`` for its accuracy are computed again exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geotrace.operators.ranking import global_rank
from geotrace.session import ensure_checkpoint_dir, stored

BLOCK_ROWS = 4000
#: Visitors of a block that meet its residents in one group, about.
VISITORS = 1 << 17
#: Partitions of these meetings, at most.
MEETINGS = 256
#: Points of a large local component that look for links ahead of the others.
SCOUTS = 64
#: Points the cuts of the tree are taken from, at most about.
SAMPLE = 100_000
CHUNK = 1024
PAIRS = "a long, b long"


# --- numpy -------------------------------------------------------------------------------

def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


def within(R: np.ndarray, V: np.ndarray, eps: float) -> np.ndarray:
    """Which rows of ``R`` and ``V`` are at most ``eps`` apart."""
    eps2 = eps * eps
    middle = V.mean(axis=0)
    r, v = R - middle, V - middle
    r2, v2 = (r * r).sum(axis=1), (v * v).sum(axis=1)
    d2 = r2[:, None] + v2[None, :] - 2.0 * (r @ v.T)
    slack = 1e-12 * (r2.max(initial=0.0) + v2.max(initial=0.0) + eps2 + eps * np.abs(middle).max())
    hit = d2 <= eps2
    i, j = np.nonzero(np.abs(d2 - eps2) <= slack)
    hit[i, j] = ((R[i] - V[j]) ** 2).sum(-1) <= eps2
    return hit


def kd_cuts(X: np.ndarray, leaf: int) -> list[tuple[int, float, int]]:
    """Nodes (dimension, cut, first child) of a k-d tree over ``X``; leaves are (-1, 0, leaf number). The widest dimension
    is cut at the median; points on the cut go left."""
    nodes: list = [None]
    todo, leaves = [(0, np.arange(len(X)))], 0
    while todo:
        at, rows = todo.pop()
        lo, hi = (X[rows].min(axis=0), X[rows].max(axis=0)) if len(rows) else (np.zeros(1), np.zeros(1))
        d = int(np.argmax(hi - lo))
        if len(rows) <= leaf or not hi[d] > lo[d]:
            nodes[at], leaves = (-1, 0.0, leaves), leaves + 1
            continue
        x = X[rows, d]
        cut = float(np.median(x))
        cut = cut if (x > cut).any() else float(x[x < cut].max())
        nodes[at] = (d, cut, len(nodes))
        todo += [(len(nodes), rows[x <= cut]), (len(nodes) + 1, rows[x > cut])]
        nodes += [None, None]
    return nodes


def kd_leaf(X: np.ndarray, nodes: list) -> np.ndarray:
    d, cut, to = (np.array(c) for c in zip(*nodes))
    node = np.zeros(len(X), np.int64)
    rows = np.flatnonzero(d[node] >= 0)
    while len(rows):
        at = node[rows]
        node[rows] = to[at] + (X[rows, d[at]] > cut[at])
        rows = rows[d[node[rows]] >= 0]
    return to[node]


def local_components(X: np.ndarray, eps: float) -> np.ndarray:
    """For each row of a block the first row of its component under links of at most ``eps``."""
    near = np.concatenate([within(X[s:s + CHUNK], X, eps) for s in range(0, len(X), CHUNK)])
    out = np.full(len(X), -1)
    for start in range(len(X)):
        if out[start] >= 0:
            continue
        front = np.array([start])
        out[front] = start
        while len(front):
            front = np.flatnonzero(near[front].any(axis=0) & (out < 0))
            out[front] = start
    return out


# --- steps -------------------------------------------------------------------------------

def _blocks(pts: DataFrame, block_rows: int) -> DataFrame:
    """``block`` for every point."""
    spark = pts.sparkSession
    n = pts.count()
    share = min(1.0, SAMPLE / max(n, 1))
    near = pts if share == 1 else pts.where(F.pmod(F.xxhash64("rid", F.lit("sample")), F.lit(1 << 20)) < int(share * (1 << 20)))
    X = _matrix(near.select("v").toArrow()["v"]) if n else np.zeros((0, 1))
    given = spark.sparkContext.broadcast(kd_cuts(X, max(1, int(0.75 * block_rows * len(X) / max(n, 1)))))

    def add(batches):
        for b in batches:
            leaf = kd_leaf(_matrix(b.column("v")), given.value) if b.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(leaf, pa.int64())], names=[*b.schema.names, "leaf"])

    dealt = stored(pts.mapInArrow(add, "rid long, v array<double>, leaf long"))
    size = dealt.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).select("leaf", F.ceil(F.col("n") / F.lit(block_rows)).alias("parts"))
    return stored(dealt.join(F.broadcast(size), "leaf").select(
        "rid", "v", (F.col("leaf") * (1 << 20) + F.pmod(F.xxhash64("rid"), F.col("parts"))).alias("block")))


def _boxes(points: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers and bounding boxes of the blocks: one row each."""
    def box(key, table):
        X = _matrix(table["v"])
        return pa.table({"block": [key[0].as_py()], "lo": [X.min(axis=0).tolist()], "hi": [X.max(axis=0).tolist()]})

    rows = points.select("block", "v").groupBy("block").applyInArrow(box, "block long, lo array<double>, hi array<double>").collect()
    return np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows]), np.array([r[2] for r in rows])


def _visits(points: DataFrame, boxes, eps: float) -> DataFrame:
    """``points`` (rid, v, tag, block as ``home``), once for each other block whose box they may reach, as ``block``."""
    given = points.sparkSession.sparkContext.broadcast(boxes)
    reach = eps * eps * (1 + 1e-9) + 1e-12

    def go(batches):
        number, lo, hi = given.value
        for batch in batches:
            for s in range(0, batch.num_rows, CHUNK):
                b = batch.slice(s, CHUNK)
                X, home = _matrix(b.column("v")), b.column("home").to_numpy()
                if not len(number):
                    continue
                d2 = np.zeros((len(X), len(number)))
                for j in range(X.shape[1]):
                    x = X[:, j:j + 1]
                    gap = np.maximum(lo[None, :, j] - x, x - hi[None, :, j])
                    d2 += np.square(np.maximum(gap, 0.0, out=gap), out=gap)
                i, k = np.nonzero((d2 <= reach) & (number[None, :] != home[:, None]))
                for a in range(0, len(i), 1 << 16):
                    took = b.take(pa.array(i[a:a + (1 << 16)]))
                    yield pa.RecordBatch.from_arrays([*took.columns[:3], pa.array(number[k[a:a + (1 << 16)]])], names=["rid", "v", "tag", "block"])

    return points.select("rid", "v", "tag", F.col("block").alias("home")).mapInArrow(go, "rid long, v array<double>, tag long, block long")


def _meet(visitors: DataFrame, residents: DataFrame, work, salts: int, parts: int) -> DataFrame:
    """``work(visitor rid, tag, X, resident tag, Y)`` -> a, b for the visitors and residents (rid, v, tag, block) of each block.
    The partitions are given: their few bytes are much work, so Spark shall not merge them."""
    def pair(left, right):
        if not left.num_rows or not right.num_rows:
            return pa.table({c: pa.array([], pa.int64()) for c in ("a", "b")})
        return work(left["rid"].to_numpy(), left["tag"].to_numpy(), _matrix(left["v"]), right["tag"].to_numpy(), _matrix(right["v"]))

    key = ["block", "salt"]
    v = visitors.withColumn("salt", F.pmod(F.xxhash64("rid"), F.lit(salts)).cast("int")).repartition(parts, *key)
    r = residents.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).repartition(parts, *key)
    return v.groupBy(*key).cogroup(r.groupBy(*key)).applyInArrow(pair, PAIRS)


def _pairs(a, b) -> pa.Table:
    return pa.table({"a": pa.array(np.asarray(a, np.int64)), "b": pa.array(np.asarray(b, np.int64))})


def _spread(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``id, lab``: the smallest id each node (``id``) can reach over ``links`` (a, b)."""
    und = stored(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    lab = nodes.select("id", F.col("id").alias("lab")).checkpoint()
    while True:
        via = und.join(lab.withColumnRenamed("id", "b"), "b").groupBy("a").agg(F.min("lab").alias("nl"))
        new = (lab.join(via.withColumnRenamed("a", "id"), "id", "left")
               .select("id", F.least("lab", F.coalesce("nl", "lab")).alias("lab")))
        jump = new.join(new.select(F.col("id").alias("lab"), F.col("lab").alias("lab2")), "lab", "left")
        new = jump.select("id", F.least("lab", F.coalesce("lab2", "lab")).alias("lab")).checkpoint()
        changed = new.join(lab.withColumnRenamed("lab", "old"), "id").where(F.col("lab") != F.col("old")).count()
        lab = new
        if changed == 0:
            return lab


def dbscan(df: DataFrame, vec: str = "vec", id_col: str = "trajectory_id", order: str | None = None,
           eps: float = 0.5, min_samples: int = 5, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``id, cluster`` for every row (``-1`` = noise). ``vec`` is ``array<double>``."""
    ensure_checkpoint_dir(df.sparkSession)
    every = stored(df.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).cast("string").alias("id"),
                             F.col(vec).cast("array<double>").alias("v"), F.col(order or id_col).alias("_ord")))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    pts = _blocks(every.where(finite).select("rid", "v"), block_rows)
    boxes = _boxes(pts)
    salts = max(1, -(-pts.count() // VISITORS))
    parts = max(1, min(len(boxes[0]) * salts, MEETINGS))

    # neighbour counts (self included): in the own block, then where the ball of an undecided point reaches
    def own(table):
        rid, X = table["rid"].to_numpy(), _matrix(table["v"])
        n = np.concatenate([within(X[s:s + CHUNK], X, eps).sum(axis=1) for s in range(0, len(X), CHUNK)])
        return _pairs(rid, n)

    def count(rid, tag, X, _, Y):
        return _pairs(rid, np.concatenate([within(X[s:s + CHUNK], Y, eps).sum(axis=1) for s in range(0, len(X), CHUNK)]))

    mine = stored(pts.groupBy("block").applyInArrow(own, PAIRS))
    undecided = pts.join(mine.where(F.col("b") < min_samples).select(F.col("a").alias("rid"), F.col("b").alias("tag")), "rid")
    abroad = _meet(_visits(undecided, boxes, eps), pts.withColumn("tag", F.lit(0).cast("long")), count, salts, parts)
    named = every.select("rid", F.col("id").isNotNull().alias("named"))  # rows without an id count, but get no label
    counted = stored(mine.unionByName(abroad).groupBy(F.col("a").alias("rid")).agg(F.sum("b").alias("n"))
                     .join(named, "rid").select("rid", (F.col("named") & (F.col("n") >= min_samples)).alias("core")))

    # local components, numbered by one of their points
    core = stored(pts.join(counted.where("core").select("rid"), "rid").select("rid", "v", "block"))
    core_boxes = _boxes(core)

    def join(table):
        table = table.sort_by("rid")
        rid, X = table["rid"].to_numpy(), _matrix(table["v"])
        c = local_components(X, eps)
        return _pairs(rid, rid[c])

    local = stored(core.groupBy("block").applyInArrow(join, PAIRS).select(F.col("a").alias("rid"), F.col("b").alias("tag"))
                   .join(core, "rid").select("rid", "v", "tag", "block"))
    nodes = local.select(F.col("tag").alias("id")).distinct()

    def link(rid, tag, X, other, Y):
        order = np.argsort(other, kind="stable")
        other, Y = other[order], Y[order]
        start = np.flatnonzero(np.r_[True, other[1:] != other[:-1]])
        found = [np.zeros((0, 2), np.int64)]
        for s in range(0, len(X), CHUNK):
            i, j = np.nonzero(np.logical_or.reduceat(within(X[s:s + CHUNK], Y, eps), start, axis=1))
            both = np.stack([tag[s:s + CHUNK][i], other[start[j]]], 1)
            found.append(np.unique(both[both[:, 0] != both[:, 1]], axis=0))
        return _pairs(*np.unique(np.concatenate(found), axis=0).T)

    large = local.groupBy("tag").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > SCOUTS)
    scouts = local.join(large, "tag").where(F.pmod(F.xxhash64("rid", F.lit("scout")), F.col("n")) < SCOUTS).drop("n")
    ahead = _spread(nodes, stored(_meet(_visits(scouts, core_boxes, eps), local, link, salts, parts)))
    # from here on a tag is the component found so far
    known = stored(local.join(ahead.withColumnRenamed("id", "tag"), "tag").select("rid", "v", F.col("lab").alias("tag"), "block"))
    giant = known.groupBy("tag").agg(F.count(F.lit(1)).alias("n")).agg(F.max_by("tag", F.struct("n", "tag"))).first()[0]
    rest = known.where(F.col("tag") != (giant if giant is not None else -1))
    links = stored(_meet(_visits(rest, core_boxes, eps), known, link, salts, parts))
    whole = _spread(known.select(F.col("tag").alias("id")).distinct(), links)
    lab = stored(known.join(whole.withColumnRenamed("id", "tag"), "tag").select("rid", "lab"))

    # number clusters by their first member in ``order``
    first = (lab.join(every.select("rid", "id", "_ord"), "rid").groupBy("lab").agg(F.min("_ord").alias("_f"), F.min("id").alias("_id")))
    num = stored(global_rank(first, ["_f", "_id"], "cluster").select("lab", F.col("cluster").cast("long")))
    core_lab = stored(lab.join(num, "lab").select("rid", F.col("cluster").alias("tag")))

    def nearest(rid, tag, X, cluster, Y):
        none = np.iinfo(np.int64).max
        low = np.concatenate([np.where(within(X[s:s + CHUNK], Y, eps), cluster[None, :], none).min(axis=1) for s in range(0, len(X), CHUNK)])
        return _pairs(rid[low < none], low[low < none])

    border = pts.join(counted.where(~F.col("core")).select("rid"), "rid").withColumn("tag", F.lit(0).cast("long"))
    numbered = core.join(core_lab, "rid").select("rid", "v", "tag", "block")
    at_home = border.select("rid", "v", "tag", "block")
    found = _meet(at_home.unionByName(_visits(border, core_boxes, eps)), numbered, nearest, salts, parts)
    edge = found.groupBy(F.col("a").alias("rid")).agg(F.min("b").alias("bc"))
    return (every.where(F.col("id").isNotNull()).join(core_lab, "rid", "left").join(edge, "rid", "left")
            .select(F.col("id").alias(id_col), F.coalesce("tag", "bc", F.lit(-1)).cast("int").alias("cluster")))
