"""Many tree ensembles at once: all folds, targets, bags and trials of a run in the same Spark jobs.

``Design`` bins the features once (at most 255 quantile bins) and writes rows of (row, draw, fold, bins, y) to the
checkpoint folder. ``fit_many`` then grows every ensemble of a list:

* Up to ``MEMORY_ROWS`` training rows, each *part* (an ensemble's target, bag or run of independent trees) is finished
  in one task, in the JVM (see ``kernel.py``) or, up to ``PYTHON_ROWS``, in numpy, to which the rows are shuffled. One job serves all
  parts, the longest first; where the copies of the rows would pass ``COPIED_BYTES``, a task finishes several parts on one copy.
* Beyond, ensembles grow in waves: one job sums the histograms of the open nodes of *all* parts, added up
  in each task, then dealt to tasks by node or (node, feature), where the best cuts are found; only those come to the
  driver. Once a tree's open nodes are small, one more job deals their rows to tasks, which finish the subtrees. Jobs
  count the longest part's waves, whatever the number of parts. Predictions of finished trees are kept beside the rows,
  and renewed every few trees.

Both run the same functions of :mod:`trees` on sums that don't depend on the order of rows, so they grow the
same trees.
"""

from __future__ import annotations

import math
import pickle
import time
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geotrace.operators import kernel
from geotrace.operators import trees as K
from geotrace.session import stored

#: Training rows up to which a part is grown inside one task, and up to which numpy grows it there.
MEMORY_ROWS, PYTHON_ROWS = 3 << 20, 1 << 19
#: Bytes of trees up to which a fit's models come to the driver.
MODEL_BYTES = 1 << 25
#: Bytes of a row group of trees, of which one may take some MB.
ROW_GROUP = 1 << 23
#: Bytes of rows copied for parts in tasks, as long as each core has ``GROUPS_A_CORE`` tasks.
COPIED_BYTES = 1 << 31
GROUPS_A_CORE = 4
#: Independent trees a part.
TREES_A_PART = 25
#: Finished trees of all boosted runs between two writings of predictions in the waves.
TREES_A_STATE = 8
#: Rows of a block of arrays, and of a node whose subtree is finished in one task.
BLOCK_ROWS = 1 << 16
SUBTREE_ROWS = 1 << 15
#: Rows of subtrees dealt to a task in one job, on average.
SUBTREE_LOAD = 1 << 19
#: Histograms (node, feature) of a wave.
SEGMENTS_A_WAVE = 1 << 15


@dataclass
class Raw:
    """Rows with a target value, written once: row, draw, fold, x, y and kept columns."""

    rows: DataFrame
    targets: tuple[str, ...]
    largest: float              # of all |targets|
    count: int
    features: int


@dataclass
class Design:
    """Binned rows and what turns raw features into bins."""

    rows: DataFrame             # row, draw, fold, bins, y
    edges: list[np.ndarray]
    values: np.ndarray          # (features, BINS): what stands for a bin
    targets: tuple[str, ...]
    largest: float
    count: int


def raw_rows(df: DataFrame, features: str, targets: tuple[str, ...], fold: str | None = None, keep: tuple[str, ...] = ()) -> Raw:
    """Null and NaN targets can't be learned: their rows go. Draws follow the trajectory id, or else the row's values."""
    draw = F.xxhash64("trajectory_id") if "trajectory_id" in df.columns else F.xxhash64(vector_to_array(features), *targets)
    src = df.select(F.monotonically_increasing_id().alias("row"), draw.alias("draw"), (F.col(fold) if fold else F.lit(-1)).cast("int").alias("fold"),
                    vector_to_array(features).alias("x"), F.array(*[F.col(t).cast("double") for t in targets]).alias("y"), *keep)
    src = stored(src.where(F.forall("y", lambda v: v.isNotNull() & ~F.isnan(v))))
    count, largest, p = src.agg(F.count("*"), F.max(F.array_max(F.transform("y", F.abs))), F.max(F.size("x"))).first()
    return Raw(src, tuple(targets), float(largest or 0.0), int(count), p or 0)


def _edges(x: DataFrame, p: int, bins: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Upper borders of the bins of each feature: distinct quantiles at steps of 1 / bins."""
    wide = x.select(*[F.col("x")[i].alias(f"x{i}") for i in range(p)])
    probs = [i / bins for i in range(1, bins)] + [1.0]
    found = wide.approxQuantile([f"x{i}" for i in range(p)], probs, 1e-4)
    edges, values = [], np.zeros((p, K.BINS))
    for j, q in enumerate(found):
        q = np.array(q) if q else np.zeros(1)
        edges.append(np.unique(q[:-1]))
        values[j, :len(edges[j])] = edges[j]
        values[j, len(edges[j]):] = q[-1]
    return edges, values


def bin_rows(X: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, X[:, j], "left") for j, e in enumerate(edges)], 1) if len(edges) else np.zeros((len(X), 0), int)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def design(df: DataFrame, features: str, targets: tuple[str, ...], fold: str | None = None) -> Design:
    return binned(raw_rows(df, features, targets, fold))


def binned(raw: Raw, bins: int = 255) -> Design:
    src = raw.rows.select("row", "draw", "fold", "x", "y")
    edges, values = _edges(src, raw.features, bins)

    def add(batches):
        for b in batches:
            codes = bin_rows(_matrix(b.column(3)), edges).astype(np.uint8) if b.num_rows else np.zeros((0, 1), np.uint8)
            packed = pa.array([c.tobytes() for c in codes], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns[:3], packed, b.column(4)], names=["row", "draw", "fold", "bins", "y"])

    rows = src.mapInArrow(add, "row long, draw long, fold int, bins binary, y array<double>")
    return Design(stored(rows), edges, values, raw.targets, raw.largest, raw.count)


# --- what is fitted -----------------------------------------------------------------------------

@dataclass(frozen=True)
class Job:
    """An ensemble on all rows (``fold`` None) or on those outside a fold, whose rows are then predicted."""

    grower: K.Grower
    fold: int | None = None


@dataclass(frozen=True)
class Part:
    job: int
    grower: K.Grower
    fold: int | None
    targets: tuple[int, ...]
    bag: int
    first: int
    last: int


def parts_of(jobs: list[Job], k: int) -> list[Part]:
    out = []
    for i, j in enumerate(jobs):
        g = j.grower
        groups = [tuple(range(k))] if g.joint else [(t,) for t in range(k)]
        step = TREES_A_PART if g.kind == "bag" else g.trees
        out += [Part(i, g, j.fold, t, bag, at, min(at + step, g.trees)) for t in groups for bag in range(g.bags) for at in range(0, g.trees, step)]
    return out


@dataclass
class Piece:
    """A part's finished ensemble; a job's prediction is the sum of ``share`` times its pieces' predictions."""

    targets: tuple[int, ...]
    share: float
    ensemble: K.Ensemble
    place: int = 0              # among all parts

    def add_to(self, out: np.ndarray, B: np.ndarray) -> None:
        out[:, list(self.targets)] += self.share * self.ensemble.predict(B)


@dataclass
class FarPiece:
    """A part's finished trees in the checkpoint folder (:func:`kernel.run`'s rows)."""

    targets: tuple[int, ...]
    share: float
    base: np.ndarray
    rows: DataFrame
    place: int
    size: int


def _bins(column: pa.Array, p: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), p)


OUT = "job int, row long, p array<double>, piece binary, seconds double"


def _out(job: int, row, p, piece, seconds: float) -> pa.Table:
    n = len(p) if p is not None else 1
    flat = pa.array(np.ascontiguousarray(p).ravel()) if p is not None else None
    values = pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * p.shape[1], flat) if p is not None else pa.nulls(1, pa.list_(pa.float64()))
    return pa.table({"job": pa.array(np.full(n, job, np.int32)), "row": pa.array(row) if row is not None else pa.nulls(1, pa.int64()), "p": values,
                     "piece": pa.array([piece] if piece else [None] * n, pa.binary()), "seconds": pa.array(np.full(n, seconds / n))})


@dataclass
class Fitted:
    """Predictions of held-out rows (job, row, p, seconds) and the pieces of jobs on all rows."""

    design: Design
    out: DataFrame
    pieces: dict[int, list[Piece]]


def fit_many(d: Design, jobs: list[Job], memory_rows: int | None = None, subtree_rows: int | None = None) -> Fitted:
    """Fit all ``jobs`` (see the module's text). Without rows, every ensemble predicts 0."""
    parts = parts_of(jobs, len(d.targets))
    if d.count <= (MEMORY_ROWS if memory_rows is None else memory_rows):
        rows, pieces = _in_tasks(d, parts)
    else:
        done = _Waves(d, parts, subtree_rows).run()
        pieces = {}
        for part, piece in zip(parts, done):
            pieces.setdefault(part.job, []).append(piece)
        rows = stored(_held_out(d, {i: (j.fold, pieces[i]) for i, j in enumerate(jobs) if j.fold is not None}))
        pieces = {i: pieces[i] for i, j in enumerate(jobs) if j.fold is None}
    sums = [F.sum(F.col("p")[t]).alias(f"p{t}") for t in range(len(d.targets))]
    return Fitted(d, rows.groupBy("job", "row").agg(*sums, F.sum("seconds").alias("seconds")), pieces)


def _cost(part: Part, p: int) -> float:
    """About in proportion to the time that a part takes."""
    g = part.grower
    return (part.last - part.first) * min(g.depth, 20 if g.kind == "bag" else 10) * len(part.targets) * (K.subset_size(g.node_features, max(1, int(g.tree_features * p))) + 20)


def _dealt(parts: list[Part], p: int, groups: int) -> list[list[int]]:
    """Parts (indexes) of about equal cost together, the costliest first."""
    out, load = [[] for _ in range(groups)], np.zeros(groups)
    for i in sorted(range(len(parts)), key=lambda i: (-_cost(parts[i], p), i)):
        to = int(load.argmin())
        out[to].append(i)
        load[to] += _cost(parts[i], p)
    return [out[i] for i in np.argsort(-load, kind="stable")]


def _in_tasks(d: Design, parts: list[Part]) -> tuple[DataFrame, dict[int, list]]:
    """Held-out predictions and the pieces of all rows' jobs, each part grown in one task."""
    p = len(d.edges)
    fast = [i for i, x in enumerate(parts) if d.count and kernel.grows(x.grower, len(x.targets), p)]
    slow = [i for i in range(len(parts)) if i not in set(fast)]
    found, pieces = [], {}
    if fast:
        out = stored(kernel.run(d, parts, _groups(d, parts, fast)), ROW_GROUP)
        pieces |= _trees(out.where("bytes IS NOT NULL"), parts) if any(parts[i].fold is None for i in fast) else {}
        found.append(out.where("row IS NOT NULL").select("job", "row", "p", "seconds"))
    if slow and d.count > PYTHON_ROWS:
        held: dict[int, tuple[int, list]] = {}
        for i, piece in zip(slow, _Waves(d, [parts[i] for i in slow]).run()):
            piece.place = i
            if parts[i].fold is None:
                pieces.setdefault(parts[i].job, []).append(piece)
            else:
                held.setdefault(parts[i].job, (parts[i].fold, []))[1].append(piece)
        found.append(stored(_held_out(d, held)).select("job", "row", "p", "seconds"))
    elif slow:
        out = stored(_in_python(d, parts, _groups(d, parts, slow)))
        for r in out.where("piece IS NOT NULL").select("job", "piece").collect():  # as large as the models
            pieces.setdefault(r["job"], []).append(pickle.loads(r["piece"]))
        found.append(out.where("row IS NOT NULL").select("job", "row", "p", "seconds"))
    rows = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    return rows, {i: sorted(some, key=lambda x: x.place) for i, some in pieces.items()}


def _groups(d: Design, parts: list[Part], some: list[int]) -> list[list[int]]:
    """Parts that share a task and its copy of the rows."""
    p = len(d.edges)
    copies = COPIED_BYTES // max(1, d.count * (p + 8 * len(d.targets) + 32))
    count = min(len(some), max(copies, GROUPS_A_CORE * d.rows.sparkSession.sparkContext.defaultParallelism))
    return [[some[j] for j in x] for x in _dealt([parts[i] for i in some], p, count)]


def _trees(out: DataFrame, parts: list[Part]) -> dict[int, list]:
    """Pieces of the trees that the kernel wrote: at the driver, or left in the checkpoint folder if they are large."""
    pieces: dict[int, list] = {}
    sizes = out.groupBy("job", "part").agg(F.sum("bytes").alias("size"), F.first("p").alias("base")).collect()  # a row a part
    large = sum(r["size"] for r in sizes) > MODEL_BYTES
    for r in sizes:
        part = parts[r["part"]]
        if large:
            pieces.setdefault(part.job, []).append(FarPiece(part.targets, 1.0 / part.grower.bags, np.array(r["base"]), out, r["part"], r["size"]))
        else:
            pieces.setdefault(part.job, []).append(Piece(part.targets, 1.0 / part.grower.bags, K.Ensemble(np.array(r["base"]), []), r["part"]))
    if not large:
        at = {x.place: x for some in pieces.values() for x in some}
        for r in out.select("part", "tree", "nodes").orderBy("part", "tree").collect():
            at[r["part"]].ensemble.trees.append(kernel.decoded(bytes(r["nodes"]), len(parts[r["part"]].targets)))
    return pieces


def _in_python(d: Design, parts: list[Part], groups: list[list[int]]) -> DataFrame:
    """Groups of parts, each with a copy of the rows in one task (at most ``MEMORY_ROWS`` binned rows), grown by numpy."""
    spark, p = d.rows.sparkSession, len(d.edges)
    given = spark.sparkContext.broadcast((parts, groups, d.values, d.largest, p, len(d.targets)))

    def work(batches):
        parts, groups, values, largest, p, k = given.value
        had = [b for b in batches if b.num_rows]
        if not had:
            return
        table = pa.Table.from_batches(had).sort_by([("draw", "ascending"), ("row", "ascending")])
        fold, row = table["fold"].to_numpy(), table["row"].to_numpy()
        ids = table["draw"].to_numpy().view(np.uint64)
        B = _bins(table["bins"].combine_chunks(), p)
        Y = K.rounded_targets(_matrix(table["y"].combine_chunks()), largest)
        mine = groups[table["group"][0].as_py()]
        del table, had
        for i in mine:
            begun, part = time.perf_counter(), parts[i]
            held = fold == part.fold if part.fold is not None else np.zeros(len(fold), bool)
            e = K.fitted(part.grower, ids[~held], B[~held], Y[~held][:, list(part.targets)], largest, values, part.bag, part.first, part.last)
            piece = Piece(part.targets, 1.0 / part.grower.bags, e, i)
            if part.fold is None:
                yield from _out(part.job, None, None, pickle.dumps(piece), time.perf_counter() - begun).to_batches()
            elif held.any():
                out = np.zeros((int(held.sum()), k))
                piece.add_to(out, B[held])
                yield from _out(part.job, row[held], out, None, time.perf_counter() - begun).to_batches()

    # dealt by number, so that no task gets two groups
    group = F.explode(F.sequence(F.lit(0), F.lit(len(groups) - 1))).alias("group")
    return d.rows.select("row", "draw", "fold", "bins", "y", group).repartitionById(len(groups), "group").mapInArrow(work, OUT)


def _held_out(d: Design, jobs: dict[int, tuple[int, list[Piece]]]) -> DataFrame:
    given = d.rows.sparkSession.sparkContext.broadcast((jobs, len(d.edges), len(d.targets)))

    def work(batches):
        jobs, p, k = given.value
        for b in batches:
            B, fold, row = _bins(b.column(2), p), b.column(1).to_numpy(), b.column(0).to_numpy()
            for job, (held, pieces) in jobs.items():
                at = np.flatnonzero(fold == held)
                if len(at):
                    out = np.zeros((len(at), k))
                    for piece in pieces:
                        piece.add_to(out, B[at])
                    yield from _out(job, row[at], out, None, 0.0).to_batches()

    return d.rows.select("row", "fold", "bins").mapInArrow(work, OUT)


# --- waves ----------------------------------------------------------------------------------------

class _Waves:
    """The driver's side of the waves: trees under growth, finished trees, and one job for each wave of all parts.

    Rows lie in blocks of arrays, cached by the executors. Nodes of at most ``subtree_rows`` rows wait until their tree has no
    larger one open: then their rows are dealt to tasks, and each task finishes its nodes' subtrees.
    """

    def __init__(self, d: Design, parts: list[Part], subtree_rows: int | None = None):
        self.d, self.p = d, len(d.edges)
        self.small = SUBTREE_ROWS if subtree_rows is None else subtree_rows
        # independent trees grow side by side: each is a run of its own
        self.runs: list[Part] = []
        self.owner: list[int] = []
        for i, p in enumerate(parts):
            spans = [(t, t + 1) for t in range(p.first, p.last)] if p.grower.kind == "bag" else [(p.first, p.last)]
            for a, b in spans:
                self.owner.append(i)
                self.runs.append(replace(p, first=a, last=b))
        self.parts, self.step = parts, K.gradient_step(d.largest)
        self.fixed: list[list[K.Fixed]] = [[] for _ in self.runs]
        self.says: list[list[float]] = [[] for _ in self.runs]      # AdaBoost: weights of the trees in the median
        self.steps: list[list[tuple]] = [[] for _ in self.runs]     # AdaBoost: what each tree does to the rows' weights
        self.stated = [0] * len(self.runs)      # trees whose predictions the state holds
        self.older = None
        self.sc = d.rows.sparkSession.sparkContext
        self.tasks = max(self.sc.defaultParallelism, 1)

    def run(self) -> list[Piece]:
        self.blocks = self.state = self._blocks().persist(StorageLevel.MEMORY_AND_DISK)
        self.base = self._bases()
        tree = {i: K.Tree(K.tree_key(r.grower, r.bag, r.first), len(r.targets)) for i, r in enumerate(self.runs)}
        later: dict[int, list[int]] = {i: [] for i in tree}
        while tree:
            for some in self._shares(tree):
                self._step(some, later)
            ready = {i: t for i, t in tree.items() if not t.open and later[i]}
            for some in self._loads(ready, later):
                self._subtrees(some, later)
            ended = [i for i, t in tree.items() if not t.open]
            for i in ended:
                g = self.runs[i].grower
                self.fixed[i].append(tree[i].done(g, {"boost": g.rate, "adaboost": 1.0}.get(g.kind, 1.0 / g.trees)))
            over = self._reweigh([i for i in ended if self.runs[i].grower.kind == "adaboost"])
            for i in ended:
                g = self.runs[i].grower
                at = self.runs[i].first + len(self.fixed[i])
                if at < self.runs[i].last and i not in over:
                    tree[i] = K.Tree(K.tree_key(g, self.runs[i].bag, at), len(self.runs[i].targets))
                else:
                    del tree[i]
                later[i] = []
            if sum(len(self.fixed[i]) - self.stated[i] for i in tree if self.runs[i].grower.kind != "bag") >= TREES_A_STATE:
                self._write_state()
        for cached in (self.older, self.state, self.blocks):
            if cached is not None:
                cached.unpersist()
        out = []
        for i, p in enumerate(self.parts):
            mine = [j for j, o in enumerate(self.owner) if o == i]
            trees = [t for j in mine for t in self.fixed[j]]
            base = self.base[mine[0]] * (len(trees) / p.grower.trees if p.grower.kind == "bag" else 1.0)
            out.append(Piece(p.targets, 1.0 / p.grower.bags, K.Ensemble(base, trees, self.says[mine[0]] if p.grower.kind == "adaboost" else None), i))
        return out

    def _reweigh(self, ended: list[int]) -> set[int]:
        """AdaBoost.R2 after a tree of each of ``ended``: the trees' weights and the rows' new ones; the runs that are over."""
        over: set[int] = set()
        if not ended:
            return over
        given = self._given(base=self.base, fresh=[f[:-1] if i in ended else f for i, f in enumerate(self._fresh())], last={i: self.fixed[i][-1] for i in ended})

        def gaps(blocks):
            v = given.value
            out = {i: (0.0, 0.0) for i in v["last"]}
            for b in blocks:
                S, at = _predictions(v, b), _places(v["runs"])
                for i, tree in v["last"].items():
                    gap = _gap(v, i, tree, b)
                    largest = float((gap * _trained(v["runs"][i], b)).max(initial=0.0))
                    out[i] = max(out[i][0], largest), out[i][1] + float((S[:, at[i]] * gap).sum())
            yield out

        found = self.state.mapPartitions(gaps).treeReduce(lambda a, b: {i: (max(a[i][0], b[i][0]), a[i][1] + b[i][1]) for i in a})
        step = {}
        for i in ended:
            top, total = found[i]
            err = total / top if top > 0 else 0.0
            if top <= 0:
                self.says[i].append(1.0)
            elif err >= 0.5:
                if len(self.fixed[i]) > 1:
                    self.fixed[i].pop()
                else:
                    self.says[i].append(1.0)
            else:
                beta = err / (1 - err)
                self.says[i].append(self.runs[i].grower.rate * math.log(1 / beta) if beta > 0 else 1.0)
                step[i] = beta, top
                continue
            over.add(i)
            self.steps[i].append((1.0, 1.0, 1.0))

        def sums(blocks):
            v = given.value
            out = {i: 0.0 for i in step}
            for b in blocks:
                S, at = _predictions(v, b), _places(v["runs"])
                for i, (beta, top) in step.items():
                    out[i] += float((S[:, at[i]] * _factor(v, i, v["last"][i], b, beta, top)).sum())
            yield out

        if step:
            totals = self.state.mapPartitions(sums).treeReduce(lambda a, b: {i: a[i] + b[i] for i in a})
            for i, (beta, top) in step.items():
                self.steps[i].append((beta, top, totals[i]))
        given.unpersist()
        return over

    def _shares(self, tree: dict) -> list[dict]:
        """Trees with open nodes, so many at once that a task's histograms stay small."""
        out, size = [], 0
        for i, t in tree.items():
            if t.open:
                g = self.runs[i].grower
                here = len(t.open) * K.subset_size(g.node_features, self.p)
                if not out or size + here > SEGMENTS_A_WAVE:
                    out.append({})
                    size = 0
                out[-1][i] = t
                size += here
        return out

    def _loads(self, tree: dict, later: dict) -> list[dict]:
        """Trees with subtrees to be finished, so many at once that few rows are dealt out."""
        out, size = [], 0
        for i, t in tree.items():
            here = sum(int(t.stats[n][0]) for n in later[i])
            if not out or size + here > SUBTREE_LOAD * self.tasks:
                out.append({})
                size = 0
            out[-1][i] = t
            size += here
        return out

    def _step(self, tree: dict, later: dict) -> None:
        """One wave of some trees."""
        features = {i: t.features(self.runs[i].grower, self.p) for i, t in tree.items()}
        found = self._wave(tree, features)
        for i, t in tree.items():
            g = self.runs[i].grower
            if i not in found:
                t.open = []
            elif g.symmetric:
                place, *cut = found[i]
                t.grow_level(g, int(features[i][0, place]), *cut)
            else:
                t.grow(g, found[i], features[i])
                if not g.leaves:
                    later[i] += [n for n in t.open if t.stats[n][0] <= self.small]
                    t.open = [n for n in t.open if t.stats[n][0] > self.small]

    def _blocks(self):
        """The design's rows as arrays (draw, fold, bins by feature, rounded targets, state), at most ``BLOCK_ROWS`` a block."""
        p, largest = self.p, self.d.largest

        def pack(batches):
            had, rows = [], 0
            for b in batches:
                if b.num_rows:
                    had.append(b)
                    rows += b.num_rows
                if rows >= BLOCK_ROWS:
                    yield whole(had)
                    had, rows = [], 0
            if had:
                yield whole(had)

        def whole(had):
            t = pa.Table.from_batches(had).combine_chunks()
            block = (t["draw"].to_numpy().view(np.uint64), t["fold"].to_numpy(), K.by_feature(_bins(t["bins"].combine_chunks(), p)),
                     K.rounded_targets(_matrix(t["y"].combine_chunks()), largest), None)
            return pa.RecordBatch.from_arrays([pa.array([pickle.dumps(block, 5)], pa.binary())], names=["block"])

        parts = max(self.tasks, -(-self.d.count // BLOCK_ROWS))
        rows = self.d.rows.select("draw", "fold", "bins", "y").repartition(parts)
        return rows.mapInArrow(pack, "block binary").rdd.map(lambda r: pickle.loads(r[0]))

    def _given(self, **more):
        steps = [x[s:] for x, s in zip(self.steps, self.stated)]
        return self.sc.broadcast({"runs": self.runs, "step": self.step, "values": self.d.values, "steps": steps, "weight": getattr(self, "weight", None)} | more)

    def _bases(self) -> list[np.ndarray]:
        """Weighted target means of each run's training rows."""
        given, targets = self._given(), len(self.d.targets)

        def sums(blocks):
            runs = given.value["runs"]
            total = np.zeros((len(runs), 1 + targets))
            for ids, fold, _, Y, _ in blocks:
                for i, r in enumerate(runs):
                    w = K.bag_weights(r.grower, r.bag, ids) * ((fold != r.fold) if r.fold is not None else 1)
                    total[i, 0] += w.sum()
                    total[i, 1:] += (Y * w[:, None]).sum(axis=0)
            yield total

        total = self.blocks.mapPartitions(sums).treeReduce(np.add)
        self.weight = total[:, 0]
        return [total[i, 1:][list(r.targets)] / total[i, 0] if total[i, 0] else np.zeros(len(r.targets)) for i, r in enumerate(self.runs)]

    def _fresh(self) -> list[list[K.Fixed]]:
        return [f[s:] for f, s in zip(self.fixed, self.stated)]

    def _write_state(self) -> None:
        """Predictions of all finished trees of boosted runs beside the rows."""
        given = self._given(base=self.base, fresh=self._fresh())
        before = self.state
        self.state = before.map(lambda b: (*b[:4], _predictions(given.value, b))).persist(StorageLevel.MEMORY_AND_DISK)
        if self.older is not None:  # the next wave fills the new state from ``before``, which stays until then
            self.older.unpersist()
        self.older = before if before is not self.blocks else None
        self.stated = [len(f) for f in self.fixed]

    def _now(self, tree: dict, nodes: dict[int, list[int]]) -> dict:
        """What tasks need of trees under growth to find the rows of ``nodes``."""
        return {i: (t.key, *[np.array(x) for x in (t.feature, t.cut, t.left)], np.array(nodes[i])) for i, t in tree.items()}

    def _wave(self, tree: dict, features: dict) -> dict:
        """The best cuts of all open nodes of some trees, in one job."""
        parts = self.tasks
        given = self._given(base=self.base, fresh=self._fresh(), now=self._now(tree, {i: t.open for i, t in tree.items()}), trees=tree, features=features)

        def sums(blocks):
            v = given.value
            held: dict[int, list] = {}
            for b in blocks:
                for i, rows, slot, w, grads in _rows_of(v, b):
                    had = held.setdefault(i, [])
                    f = v["features"][i]
                    plain = None if len(rows) and (w[rows] == 1).all() else w
                    had.append(K.sparse(K.dense_sums(b[2], rows, slot, f, plain, grads)) if K.dense(v["runs"][i].grower, len(rows), len(f))
                               else K.wave_sums(b[2], rows, slot, f, plain, grads))
                    if len(had) > 1:
                        held[i] = [_merged(had)]
            for i, had in held.items():
                keys, s = had[0]
                m = v["features"][i].shape[1]
                segment = keys // K.BINS
                # the segments of a node meet in a task if there are many nodes; else, and in symmetric trees, those of a feature
                deal = segment % m if v["runs"][i].grower.symmetric else segment // m if len(v["features"][i]) >= 4 * parts else segment
                to = (deal + i) % parts
                for t in np.unique(to):
                    on = to == t
                    yield int(t), (i, keys[on], [x[on] for x in s])

        def best(dealt):
            v = given.value
            by: dict[int, list] = {}
            for _, (i, keys, s) in dealt:
                had = by.setdefault(i, [])
                had.append((keys, s))
                if len(had) >= 16:
                    by[i] = [_merged(had)]
            for i, had in by.items():
                keys, s = _merged(had)
                g, f = v["runs"][i].grower, v["features"][i]
                s = K.in_units(s, v["step"])
                if g.symmetric:
                    places, at = np.unique(keys // K.BINS % f.shape[1], return_inverse=True)
                    of = (keys // K.BINS // f.shape[1] * len(places) + at) * K.BINS + keys % K.BINS
                    place, *cut = K.best_of_level(g, K.whole_grid(of, s, len(f), len(places)))
                    yield i, (int(places[place]), *cut)
                elif len(keys):
                    yield i, K.best_by_slot(K.keyed_cuts(g, v["trees"][i], f, keys, s, v["values"])).rows()

        out: dict = {}
        for i, x in self.state.mapPartitions(sums).partitionBy(parts, int).mapPartitions(best).collect():  # a row for each open node and task
            out.setdefault(i, []).append(x)
        given.unpersist()
        return {i: max(x, key=lambda c: (c[2], -c[0])) if self.runs[i].grower.symmetric else K.best_by_slot(K.Splits.of(np.concatenate(x)))
                for i, x in out.items()}

    def _subtrees(self, tree: dict, later: dict) -> None:
        """Finish the small nodes of some trees: their rows are dealt to tasks by node, the largest nodes first."""
        load, to = np.zeros(self.tasks), {}
        for size, i, n in sorted(((float(t.stats[n][0]), i, n) for i, t in tree.items() for n in later[i]), key=lambda x: (-x[0], *x[1:])):
            to[i, n] = int(load.argmin())
            load[to[i, n]] += size
        roots = {(i, n): (t.key, len(self.runs[i].targets), t.path[n], t.depth[n]) for i, t in tree.items() for n in later[i]}
        given = self._given(base=self.base, fresh=self._fresh(), now=self._now(tree, later), to=to, roots=roots)

        def deal(blocks):
            v = given.value
            for b in blocks:
                for i, rows, slot, w, grads in _rows_of(v, b):
                    nodes = v["now"][i][4]
                    for at in np.unique(slot):
                        mine = rows[slot == at]
                        n = int(nodes[at])
                        yield v["to"][i, n], (i, n, b[2][mine], w[mine], [x[mine] for x in grads])

        def grow(dealt):
            v = given.value
            by: dict[tuple, list] = {}
            for _, (i, n, *rows) in dealt:
                by.setdefault((i, n), []).append(rows)
            while by:
                (i, n), had = by.popitem()
                key, targets, path, depth = v["roots"][i, n]
                t = K.Tree(key, targets, path=[path], depth=[depth])
                grads = [np.concatenate([x[2][c] for x in had]) for c in range(targets)]
                yield i, n, K.grow_tree(v["runs"][i].grower, t, K.by_feature(np.concatenate([x[0] for x in had])),
                                        np.concatenate([x[1] for x in had]), grads, v["step"], v["values"])

        found: dict[int, dict] = {}
        for i, n, t in self.state.mapPartitions(deal).partitionBy(self.tasks, int).mapPartitions(grow).collect():  # parts of the model
            found.setdefault(i, {})[n] = t
        given.unpersist()
        for i, subtrees in found.items():
            tree[i].graft(subtrees)


def _rows_of(v: dict, block: tuple):
    """For each tree under growth: its run, the block's rows in its nodes, their places among those, weights and gradients."""
    ids, fold, B, Y, _ = block
    S = _predictions(v, block)
    at = _places(v["runs"])
    weights: dict = {}
    for i, (key, feature, cut, left, nodes) in v["now"].items():
        r = v["runs"][i]
        own = r.grower.seed, r.grower.bags > 1, r.bag
        if own not in weights:
            weights[own] = K.bag_weights(r.grower, r.bag, ids)
        w = weights[own] * K.tree_weights(r.grower, key, ids)
        w = w * (fold != r.fold) if r.fold is not None else w
        if r.grower.kind == "adaboost":
            w = np.rint(S[:, at[i]] * v["weight"][i] * 2.0 ** K.WEIGHT_BITS) * 2.0 ** -K.WEIGHT_BITS
        slot_of = np.full(len(feature), -1)
        slot_of[nodes] = np.arange(len(nodes))
        rows = np.flatnonzero(w > 0)
        slot = slot_of[K.route(B, feature, cut, left, np.zeros(len(rows), np.int64), rows)]
        on = slot >= 0
        k = list(r.targets)
        Fn = S[:, at[i]:at[i] + len(k)] if r.grower.kind == "boost" else np.tile(v["base"][i], (len(B), 1))
        yield i, rows[on], slot[on], w, K.gradients(Fn, Y[:, k], w, v["step"])


def _columns(r: Part) -> int:
    return {"boost": len(r.targets), "adaboost": 1}.get(r.grower.kind, 0)


def _places(runs: list[Part]) -> np.ndarray:
    return np.r_[0, np.cumsum([_columns(r) for r in runs])]


def _trained(r: Part, block: tuple) -> np.ndarray:
    return np.ones(len(block[0])) if r.fold is None else (block[1] != r.fold).astype(float)


def _gap(v: dict, i: int, tree: K.Fixed, block: tuple) -> np.ndarray:
    return np.abs(block[3][:, v["runs"][i].targets[0]] - v["base"][i][0] - tree.predict(block[2])[:, 0])


def _factor(v: dict, i: int, tree: K.Fixed, block: tuple, beta: float, top: float) -> np.ndarray:
    """What AdaBoost.R2 multiplies the rows' weights by."""
    return beta ** ((1 - _gap(v, i, tree, block) / top) * v["runs"][i].grower.rate)


def _predictions(v: dict, block: tuple) -> np.ndarray:
    """The boosted runs' predictions, and the rows' weights of AdaBoost: the state's, changed by the trees finished since."""
    _, _, B, _, S = block
    at = _places(v["runs"])
    if S is None:
        S = np.zeros((len(B), at[-1]))
        for i, r in enumerate(v["runs"]):
            if r.grower.kind != "bag":
                S[:, at[i]:at[i + 1]] = v["base"][i] if r.grower.kind == "boost" else (_trained(r, block) / max(v["weight"][i], 1.0))[:, None]
    else:
        S = S.copy()
    for i, (r, fresh) in enumerate(zip(v["runs"], v["fresh"])):
        if r.grower.kind == "boost":
            for t in fresh:
                S[:, at[i]:at[i + 1]] += t.predict(B)
        elif r.grower.kind == "adaboost":
            for t, (beta, top, total) in zip(fresh, v["steps"][i]):
                S[:, at[i]] *= _factor(v, i, t, block, beta, top) / total
    return S


def _merged(had: list) -> tuple[np.ndarray, list[np.ndarray]]:
    keys = np.concatenate([k for k, _ in had])
    return K.keyed_sums(keys, [np.concatenate([s[c] for _, s in had]) for c in range(len(had[0][1]))], int(keys.max()) + 1 if len(keys) else 0)


def predictor(d: Design, pieces: list[Piece]):
    """A pandas UDF: raw feature array -> predictions of all targets."""
    given = d.rows.sparkSession.sparkContext.broadcast((d.edges, pieces, len(d.targets)))

    def predict(x):
        import pandas as pd
        edges, pieces, k = given.value
        out = np.zeros((len(x), k))
        if len(x):
            B = bin_rows(np.stack(x.to_numpy()), edges)
            for piece in pieces:
                piece.add_to(out, B)
        return pd.Series(list(out))

    return F.pandas_udf(predict, T.ArrayType(T.DoubleType()))


# --- models larger than a driver should hold ------------------------------------------------------

def far_predictions(d: Design, pieces: list[FarPiece], rows: DataFrame) -> DataFrame:
    """(row, p) of ``rows`` (row, x): the trees are dealt to groups of at most about ``MODEL_BYTES``, each of which adds up its
    trees for all rows, met as blocks of bins; the groups' sums are added in their order."""
    spark, p, k = rows.sparkSession, len(d.edges), len(d.targets)
    groups = max(1, math.ceil(sum(x.size for x in pieces) / MODEL_BYTES))
    base = np.zeros(k)
    for x in pieces:
        base[list(x.targets)] += x.share * x.base
    edges = spark.sparkContext.broadcast(d.edges)
    given = spark.sparkContext.broadcast({x.place: (list(x.targets), x.share) for x in pieces})

    def pack(batches):
        for b in batches:
            for lo in range(0, b.num_rows, BLOCK_ROWS):
                c = b.slice(lo, BLOCK_ROWS)
                ids, B = c.column(0).to_numpy().astype(np.int64), bin_rows(_matrix(c.column(1)), edges.value).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([pa.array(ids[:1]), pa.array([ids.tobytes()], pa.binary()), pa.array([B.tobytes()], pa.binary())], names=["at", "ids", "data"])

    def partial(batches):
        trees, order = [], -1
        for b in batches:
            for group, kind, at, part, ids, data in zip(*[c.to_pylist() for c in b.columns]):
                if not kind:
                    targets, share = given.value[part]
                    trees.append((targets, share, kernel.decoded(data, len(targets))))
                    continue
                order = group
                B = np.frombuffer(data, np.uint8).reshape(-1, p)
                total = np.zeros((len(B), k))
                for targets, share, t in trees:
                    total[:, targets] += share * t.predict(B)
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in ((order, pa.int32()), (at, pa.int64()), (ids, pa.binary()), (total.tobytes(), pa.binary()))],
                                                 names=["group", "at", "ids", "data"])

    def added(batches):
        by: dict[int, list] = {}
        for b in batches:
            for group, at, ids, data in zip(*[c.to_pylist() for c in b.columns]):
                by.setdefault(at, []).append((group, ids, data))
        for some in by.values():
            total = sum((np.frombuffer(data).reshape(-1, k) for _, _, data in sorted(some)), base)
            row = np.frombuffer(some[0][1], np.int64)
            lists = pa.ListArray.from_arrays(np.arange(len(row) + 1, dtype=np.int32) * k, pa.array(np.ascontiguousarray(total).ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(row), lists], names=["row", "p"])

    blocks = stored(rows.mapInArrow(pack, "at long, ids binary, data binary"), ROW_GROUP)
    every = F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group")
    met = blocks.select(every, "at", "ids", "data").select("group", F.lit(1).alias("kind"), "at", F.lit(-1).alias("part"), "ids", "data")
    for table in {id(x.rows): x.rows for x in pieces}.values():
        mine = [x.place for x in pieces if x.rows is table]
        group = F.pmod(F.xxhash64("part", "tree"), F.lit(groups)).cast("int").alias("group")
        met = met.unionByName(table.where(F.col("part").isin(mine)).select(group, F.lit(0).alias("kind"), F.col("tree").cast("long").alias("at"), "part", F.lit(None).cast("binary").alias("ids"), F.col("nodes").alias("data")))
    dealt = met.select("group", "kind", "at", "part", "ids", "data").repartitionById(groups, "group").sortWithinPartitions("kind", "part", "at")
    sums = dealt.mapInArrow(partial, "group int, at long, ids binary, data binary")
    return sums.repartition("at").mapInArrow(added, "row long, p array<double>")


def with_predictions(df: DataFrame, features: str, d: Design, pieces: list, name: str) -> DataFrame:
    """``df`` with the array column ``name``: the sum of the pieces' predictions of each row."""
    near, far = [x for x in pieces if isinstance(x, Piece)], [x for x in pieces if isinstance(x, FarPiece)]
    column = predictor(d, near)(vector_to_array(features))
    if not far:
        return df.withColumn(name, column)
    src = stored(df.withColumn("_row", F.monotonically_increasing_id()))
    found = far_predictions(d, far, src.select("_row", vector_to_array(features))).select(F.col("row").alias("_row"), F.col("p").alias("_far"))
    out = src.join(found, "_row").drop("_row")
    return out.withColumn(name, F.zip_with(column, "_far", lambda a, b: a + b) if near else F.col("_far")).drop("_far")
