"""Regression trees over binned features: split search on histogram sums, growth and scoring.

A tree grows in waves. A wave has the open nodes of a tree, and its histograms are sums of (count, weight,
gradients) by key ``(node slot, feature place, bin)``. :func:`keyed_sums` makes them from rows, and adding up
the sums of several partitions gives the same numbers, because gradients and weights are whole multiples of a
power of two: the result doesn't depend on how rows are dealt out. :func:`best_by_segment` finds the best cut of
each (slot, place), :meth:`Tree.grow` turns the best of each slot into children.

One gain serves all growers, with G the gradient sums, W the weight and T the soft threshold ``l1``:
``sum_k T(G_k)^2 / (W + l2)`` of both sides less that of the node. With l1 = l2 = 0 it is variance reduction.
Draws (rows, features, cuts) hash the row, the tree and the path of a node, so they can be repeated anywhere.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np

BINS = 256
#: Histogram cells whose cuts are searched at once.
DENSE_CELLS = 1 << 16
#: Histogram cells up to which a wave's sums are kept for the next one.
KEPT_CELLS = 1 << 24
#: Gradients are multiples of the largest target deviation times 2**-GRADIENT_BITS, weights of 2**-WEIGHT_BITS.
GRADIENT_BITS, WEIGHT_BITS = 26, 16
NO_LIMIT = 1 << 30
WORD = (1 << 64) - 1


@dataclass(frozen=True)
class Grower:
    """Settings of an ensemble.

    ``kind``: "bag" (mean of independent trees), "boost" (each tree fits the residuals) or "adaboost" (R2, linear
    loss, weighted median). ``leaves`` > 0 grows best leaf first, ``symmetric`` one split a level,
    ``random_cuts`` one drawn cut for each node and feature. ``bootstrap``: "none", "poisson" (bootstrap counts)
    or "bayes" (exponential weights). ``bags`` > 1 averages ensembles on bootstrap bags of all rows.
    """

    kind: str = "boost"
    trees: int = 100
    depth: int = NO_LIMIT
    rate: float = 0.1
    joint: bool = False
    leaves: int = 0
    symmetric: bool = False
    random_cuts: bool = False
    node_features: str = "all"
    tree_features: float = 1.0
    rows: float = 1.0
    bootstrap: str = "none"
    min_leaf: int = 1
    min_split: int = 2
    min_weight: float = 0.0
    l1: float = 0.0
    l2: float = 0.0
    min_gain: float = 0.0
    bags: int = 1
    bins: int = 255
    seed: int = 42


# --- draws -------------------------------------------------------------------------------

def mix(x):
    """A well-mixed 64-bit hash of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = np.asarray(x, np.uint64) + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def mix_one(x: int) -> int:
    """:func:`mix` of one number, without arrays."""
    x = (x + 0x9E3779B97F4A7C15) & WORD
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & WORD
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & WORD
    return x ^ (x >> 31)


def key_of(*parts: int) -> np.uint64:
    h = np.uint64(0)
    for p in parts:
        h = mix(h ^ mix(np.uint64(p & 0xFFFFFFFFFFFFFFFF)))
    return np.uint64(h)


def uniform(key, ids) -> np.ndarray:
    """Draws in [0, 1) for ``ids`` under ``key``."""
    return (mix(np.asarray(key, np.uint64) ^ mix(ids)) >> np.uint64(11)) * 2.0 ** -53


def poisson_cdf() -> list[float]:
    cdf, term = [], math.exp(-1)
    while term > 2.0 ** -54:
        cdf.append((cdf[-1] if cdf else 0.0) + term)
        term /= len(cdf)
    return cdf


def poisson(u: np.ndarray) -> np.ndarray:
    """Poisson(1) counts by inversion."""
    return np.searchsorted(np.array(poisson_cdf()), u, "right").astype(float)


def bag_weights(g: Grower, bag: int, ids: np.ndarray) -> np.ndarray:
    return poisson(uniform(key_of(g.seed, 1, bag), ids)) if g.bags > 1 else np.ones(len(ids))


def tree_weights(g: Grower, tree: np.uint64, ids: np.ndarray) -> np.ndarray:
    """Row weights of one tree, on top of the bag's."""
    u = uniform(mix(tree ^ np.uint64(2)), ids)
    if g.bootstrap == "poisson":
        return poisson(u)
    if g.bootstrap == "bayes":
        return np.rint(-np.log1p(-u) * 2.0 ** WEIGHT_BITS) * 2.0 ** -WEIGHT_BITS
    return (u < g.rows).astype(float) if g.rows < 1 else np.ones(len(ids))


def subset_size(rule: str, p: int) -> int:
    """Features tried at a node: all, sqrt, log2 or a share."""
    if rule == "all":
        return p
    if rule == "sqrt":
        return max(1, int(math.sqrt(p)))
    if rule == "log2":
        return max(1, int(math.log2(p)))
    return max(1, math.ceil(float(rule) * p))


# --- sums ----------------------------------------------------------------------------------

def keyed_sums(keys: np.ndarray, columns: list[np.ndarray], space: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Sorted distinct ``keys`` (below ``space``) and the sum of each column at them."""
    if not len(keys):
        return keys, columns
    if space <= 8 * len(keys) + 4096:
        count = np.bincount(keys, minlength=space)
        at = np.flatnonzero(count)
        return at, [np.bincount(keys, c, minlength=space)[at] for c in columns]
    bits = int(len(keys)).bit_length()
    if space << bits < 1 << 63:  # the row's number goes into the key: plain sorting is several times faster
        k = np.sort((keys.astype(np.int64) << bits) | np.arange(len(keys)))
        order = k & ((1 << bits) - 1)
        k >>= bits
    else:
        order = np.argsort(keys, kind="stable")
        k = keys[order]
    start = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
    return k[start], [np.add.reduceat(c[order], start) for c in columns]


def score(g: Grower, gradients: list[np.ndarray], weight: np.ndarray) -> np.ndarray:
    total = 0.0
    for x in gradients:
        t = np.maximum(np.abs(x) - g.l1, 0.0) if g.l1 else x
        total = total + t * t
    return total / np.maximum(weight + g.l2, 1e-300)


@dataclass
class Splits:
    """Best cut of each segment or slot: its key, gain, and the sums left of it and of the whole node."""

    slot: np.ndarray
    place: np.ndarray
    cut: np.ndarray
    gain: np.ndarray
    left: np.ndarray    # (n, 2 + targets): count, weight, gradients
    total: np.ndarray

    def rows(self) -> np.ndarray:
        return np.c_[self.slot, self.place, self.cut, self.gain, self.left, self.total]

    @staticmethod
    def of(rows: np.ndarray) -> "Splits":
        k = (rows.shape[1] - 4) // 2
        ints = rows[:, :3].astype(np.int64).T
        return Splits(*ints, rows[:, 3], rows[:, 4:4 + k], rows[:, 4 + k:])


def best_by_segment(g: Grower, keys: np.ndarray, sums: list[np.ndarray], places: int, cut_u=None, value_of=None) -> Splits:
    """The best cut of every (slot, place) among ``keys`` = (slot * places + place) * BINS + bin, gain -inf without a valid one.

    ``cut_u(slot, place)`` and ``value_of(slot, place, bin)`` serve random cuts.
    """
    segment, bins = keys // BINS, keys % BINS
    start = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]])
    length = np.diff(np.r_[start, len(keys)])
    of = np.repeat(np.arange(len(start)), length)
    last = start + length - 1
    run = [np.cumsum(s) for s in sums]
    base = [r[start] - s[start] for r, s in zip(run, sums)]
    left = [r - b[of] for r, b in zip(run, base)]
    total = [r[last] - b for r, b in zip(run, base)]
    right = [t[of] - x for t, x in zip(total, left)]
    slot, place = segment[start] // places, segment[start] % places
    valid = (left[0] >= g.min_leaf) & (right[0] >= g.min_leaf) & (left[1] >= g.min_weight) & (right[1] >= g.min_weight)
    valid &= (right[0] > 0) & (total[0][of] >= g.min_split)
    whole = score(g, total[2:], total[1])
    gain = score(g, left[2:], left[1]) + score(g, right[2:], right[1]) - whole[of]
    valid &= gain > g.min_gain + 1e-12 * whole[of]
    if g.random_cuts:
        values = value_of(slot[of], place[of], bins)
        lo, hi = values[start], values[last]
        drawn = lo + cut_u(slot, place) * (hi - lo)
        below = values <= drawn[of]
        picked = start + np.add.reduceat(below.astype(np.int64), start) - 1
        mask = np.zeros(len(keys), bool)
        mask[picked] = True
        valid &= mask
    gain = np.where(valid, gain, -np.inf)
    top = np.maximum.reduceat(gain, start)
    hit = np.where(gain == top[of], np.arange(len(keys)), len(keys))
    at = np.minimum.reduceat(hit, start)  # ties: the lowest bin
    return Splits(slot, place, bins[at], top, np.stack([x[at] for x in left], 1), np.stack(total, 1))


def dense_cuts(g: Grower, grid: list[np.ndarray]) -> Splits:
    """:func:`best_by_segment` of whole histograms: ``grid`` has (slots, places, BINS) arrays of count, weight, gradients.

    An empty bin has the sums of the bin before it, so the lowest bin of largest gain is never an empty one."""
    slots, places, _ = grid[0].shape
    found = []
    step = max(1, DENSE_CELLS // (places * BINS))
    for at in range(0, slots, step):
        x = [c[at:at + step].reshape(-1, BINS) for c in grid]
        x = [x[0], x[0], *x[2:]] if grid[1] is grid[0] else x
        left = [np.cumsum(c, axis=1) for c in x]
        total = [c[:, -1:].copy() for c in left]
        right = [t - c for t, c in zip(total, left)]
        valid = (left[0] >= max(g.min_leaf, 1)) & (right[0] >= max(g.min_leaf, 1)) & (total[0] >= g.min_split)
        if g.min_weight > 0:
            valid &= (left[1] >= g.min_weight) & (right[1] >= g.min_weight)
        whole = score(g, total[2:], total[1])
        gain = score(g, left[2:], left[1]) + score(g, right[2:], right[1]) - whole
        valid &= gain > g.min_gain + 1e-12 * whole
        gain[~valid] = -np.inf
        cut = gain.argmax(axis=1)
        row = np.arange(len(cut))
        on = total[0][:, 0] > 0
        slot, place = at + row // places, row % places
        each = (slot, place, cut, gain[row, cut], np.stack([c[row, cut] for c in left], 1), np.concatenate(total, 1))
        found.append([c[on] for c in each])
    return Splits(*[np.concatenate(c) for c in zip(*found)])


def side(g: Grower, gradients: list[np.ndarray], weight: np.ndarray) -> np.ndarray:
    """:func:`score` of arrays that may be overwritten."""
    out = None
    for x in gradients:
        if g.l1:
            np.abs(x, out=x)
            x -= g.l1
            np.maximum(x, 0.0, out=x)
        x *= x
        out = x if out is None else np.add(out, x, out=out)
    if g.l2:
        weight += g.l2
    np.maximum(weight, 1e-300, out=weight)
    out /= weight
    return out


def best_of_slots(g: Grower, sums: list[np.ndarray]) -> Splits:
    """The best cut of each slot (ties: the lowest place and bin) from histograms added up along the bins: (slots, places, BINS)
    arrays of count, weight and gradients of the rows up to a bin. All places of a slot have the same rows."""
    slots, places, _ = sums[0].shape
    least = max(g.min_leaf, 1)
    found = []
    step = max(1, DENSE_CELLS // (places * BINS))
    for at in range(0, slots, step):
        left = [c[at:at + step].reshape(-1, places * BINS) for c in sums]
        total = [c[:, -1:] for c in left]
        whole = score(g, total[2:], total[1])
        gain = side(g, [c.copy() for c in left[2:]], left[1].copy())
        gain += side(g, [t - c for t, c in zip(total[2:], left[2:])], total[1] - left[1])
        gain -= whole
        bad = left[0] < least
        bad |= left[0] > total[0] - least
        if g.min_weight > 0:
            bad |= left[1] < g.min_weight
            bad |= total[1] - left[1] < g.min_weight
        np.copyto(gain, -np.inf, where=bad)
        cut = gain.argmax(axis=1)
        row = np.arange(len(cut))
        top = gain[row, cut]
        good = (top > g.min_gain + 1e-12 * whole[:, 0]) & (total[0][:, 0] >= g.min_split)
        on = total[0][:, 0] > 0
        each = (at + row, cut // BINS, cut % BINS, np.where(good, top, -np.inf), np.stack([c[row, cut] for c in left], 1), np.concatenate(total, 1))
        found.append([c[on] for c in each])
    return Splits(*[np.concatenate(c) for c in zip(*found)])


def best_by_slot(s: Splits) -> Splits:
    """Of each slot the segment of largest gain (ties: the lowest place)."""
    order = np.lexsort((s.place, -s.gain, s.slot))
    first = order[np.flatnonzero(np.r_[True, s.slot[order][1:] != s.slot[order][:-1]])]
    return Splits(*[getattr(s, f)[first] for f in ("slot", "place", "cut", "gain", "left", "total")])


def best_of_level(g: Grower, grid: list[np.ndarray]):
    """For one split of a whole level, from whole histograms (slots, places, BINS): the place (ties: the lowest), the cut,
    the sum of both sides' scores over all slots, and (slots, 2 + targets) sums left of the cut and in all."""
    slots, places, _ = grid[0].shape
    top = None
    step = max(1, DENSE_CELLS // (slots * BINS))
    for at in range(0, places, step):
        left = [np.cumsum(c[:, at:at + step], axis=2) for c in grid]
        total = [c[:, :, -1:] for c in left]
        right = [t - c for t, c in zip(total, left)]
        both = (score(g, left[2:], left[1]) + score(g, right[2:], right[1])).sum(axis=0)[:, :-1]
        place, cut = divmod(int(both.argmax()), BINS - 1)
        if top is None or both[place, cut] > top[2]:
            top = at + place, cut, float(both[place, cut]), np.stack([c[:, place, cut] for c in left], 1), np.stack([c[:, place, 0] for c in total], 1)
    return top


def whole_grid(keys: np.ndarray, sums: list[np.ndarray], slots: int, places: int) -> list[np.ndarray]:
    """Sums by key as whole histograms (slots, places, BINS)."""
    grid = [np.zeros((slots, places, BINS)) for _ in sums]
    for x, c in zip(grid, sums):
        x.reshape(-1)[keys] = c
    return grid


# --- trees -----------------------------------------------------------------------------------

@dataclass
class Tree:
    """A tree under growth and its finished form: parallel arrays by node; children of i are ``left[i]`` and ``left[i] + 1``."""

    key: np.uint64
    targets: int
    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [-1])
    path: list[int] = field(default_factory=lambda: [1])
    depth: list[int] = field(default_factory=lambda: [0])
    stats: list = field(default_factory=lambda: [None])    # count, weight, gradients
    gain: list[float] = field(default_factory=lambda: [-np.inf])
    found: dict = field(default_factory=dict)               # best cut of a node that isn't split yet
    open: list[int] = field(default_factory=lambda: [0])    # nodes whose histograms are wanted

    def features(self, g: Grower, p: int) -> np.ndarray:
        """The features of each open node, ascending: (open nodes, places)."""
        every = np.arange(p)
        if g.tree_features < 1:
            m = max(1, int(g.tree_features * p))
            every = np.sort(np.argsort(uniform(mix(self.key ^ np.uint64(3)), every), kind="stable")[:m])
        m = subset_size(g.node_features, len(every))
        if m == len(every):
            return np.broadcast_to(every, (len(self.open), m))
        paths = np.array([self.path[i] for i in self.open], np.uint64)
        u = uniform(mix(self.key ^ mix(paths))[:, None], every[None, :])
        return np.sort(every[np.argpartition(u, m - 1, axis=1)[:, :m]], axis=1)

    def cut_draws(self, slot: np.ndarray, feature: np.ndarray) -> np.ndarray:
        paths = np.array([self.path[i] for i in self.open], np.uint64)[slot]
        return uniform(mix(self.key ^ mix(paths) ^ np.uint64(4)), feature)

    def _split(self, node: int, feature: int, cut: int, left, total) -> None:
        at = len(self.feature)
        self.feature[node], self.cut[node], self.left[node] = feature, cut, at
        for side, stats in ((0, left), (1, total - left)):
            self.feature.append(-1)
            self.cut.append(0)
            self.left.append(-1)
            self.path.append(mix_one((2 * self.path[node] + side) & WORD))
            self.depth.append(self.depth[node] + 1)
            self.stats.append(stats)
            self.gain.append(-np.inf)
        self.stats[node] = total

    def grow(self, g: Grower, best: Splits, features: np.ndarray) -> None:
        """Take the best cuts of the open nodes' slots, split what is to be split and open the children."""
        for i in range(len(best.slot)):
            node = self.open[best.slot[i]]
            self.stats[node] = best.total[i]
            if best.gain[i] > -np.inf and self.depth[node] < g.depth:
                self.gain[node] = float(best.gain[i])
                self.found[node] = (int(features[best.slot[i], best.place[i]]), int(best.cut[i]), best.left[i], best.total[i])
        chosen = self._best_first(g) if g.leaves else [n for n in self.open if n in self.found]
        before = len(self.feature)
        for node in chosen:
            self._split(node, *self.found.pop(node))
        self.open = [n for n in range(before, len(self.feature)) if self.depth[n] < g.depth and self.stats[n][0] >= max(g.min_split, 2 * g.min_leaf)]
        if g.leaves and not self.open:
            self._prune(g)

    def _order(self, g: Grower) -> list[int]:
        """The nodes that best-first growth splits, in its order, as far as gains are known."""
        picked, frontier = [], [0]
        while frontier and len(picked) + 1 < g.leaves:
            node = max(frontier, key=lambda n: (self.gain[n], -n))
            if self.gain[node] == -np.inf:
                break
            frontier.remove(node)
            picked.append(node)
            if self.left[node] >= 0:
                frontier += [self.left[node], self.left[node] + 1]
        return picked

    def _best_first(self, g: Grower) -> list[int]:
        return [n for n in self._order(g) if self.left[n] < 0]

    def _prune(self, g: Grower) -> None:
        keep = set(self._order(g))
        for n in range(len(self.feature)):
            if n not in keep:
                self.feature[n], self.left[n] = -1, -1

    def grow_level(self, g: Grower, feature: int, cut: int, both: float, left: np.ndarray, total: np.ndarray) -> None:
        """Split all open nodes alike, if the level gains by it."""
        nodes, self.open = self.open, []
        for node, t in zip(nodes, total):
            self.stats[node] = t
        base = score(g, [total[:, 2 + t] for t in range(self.targets)], total[:, 1]).sum()
        if both - base <= g.min_gain + 1e-12 * base or self.depth[nodes[0]] >= g.depth:
            return
        before = len(self.feature)
        for i, node in enumerate(nodes):
            self._split(node, feature, cut, left[i], total[i])
        if self.depth[before] < g.depth:
            self.open = list(range(before, len(self.feature)))

    def graft(self, subtrees: dict[int, "Tree"]) -> None:
        """Put finished subtrees in the place of their nodes and number all nodes by level, as growth without subtrees does."""
        names = "feature", "cut", "left", "path", "depth", "stats", "gain"
        out: dict[str, list] = {x: [] for x in names}
        level: list[tuple[Tree, int]] = [(self, 0)]
        placed = 0
        while level:
            below: list[tuple[Tree, int]] = []
            first = placed + len(level)
            for tree, n in level:
                tree, n = (subtrees[n], 0) if tree is self and n in subtrees else (tree, n)
                for x in names:
                    out[x].append(getattr(tree, x)[n])
                if tree.left[n] >= 0:
                    out["left"][-1] = first + len(below)
                    below += [(tree, tree.left[n]), (tree, tree.left[n] + 1)]
            placed, level = first, below
        for x in names:
            setattr(self, x, out[x])

    def done(self, g: Grower, rate: float) -> "Fixed":
        """The finished tree; leaf values are ``-T(G) / (W + l2)`` times ``rate``."""
        stats = np.array([s if s is not None else np.zeros(2 + self.targets) for s in self.stats])
        G = stats[:, 2:]
        G = np.sign(G) * np.maximum(np.abs(G) - g.l1, 0.0)
        weight = stats[:, 1:2] + g.l2
        value = np.where(weight > 0, -G / np.where(weight > 0, weight, 1.0), 0.0) * rate
        return Fixed(np.array(self.feature, np.int32), np.array(self.cut, np.int32), np.array(self.left, np.int32), value)


@dataclass
class Fixed:
    """A finished tree."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray

    def leaf(self, B: np.ndarray) -> np.ndarray:
        return route(B, self.feature, self.cut, self.left, np.zeros(len(B), np.int64))

    def predict(self, B: np.ndarray) -> np.ndarray:
        return self.value[self.leaf(B)]


def route(B: np.ndarray, feature, cut, left, node: np.ndarray, of: np.ndarray | None = None) -> np.ndarray:
    """The leaf of each row (or of the rows ``of``), from ``node`` downwards."""
    node = node.copy()
    rows = np.flatnonzero(feature[node] >= 0)
    while len(rows):
        at = node[rows]
        node[rows] = left[at] + (B[rows if of is None else of[rows], feature[at]] > cut[at])
        rows = rows[feature[node[rows]] >= 0]
    return node


def by_feature(B: np.ndarray) -> np.ndarray:
    """Bins as bytes with each feature's in one piece, as the histograms read them."""
    return np.asfortranarray(B, dtype=np.uint8)


# --- one wave over some rows ------------------------------------------------------------------

def dense(g: Grower, rows: int, slots: int) -> bool:
    """Whether whole histograms cost no more than the keys that occur."""
    return not g.random_cuts and slots * BINS <= rows + 4096


def dense_sums(B, rows, slot, features, weight, gradients) -> list[np.ndarray]:
    """:func:`wave_sums` as whole histograms: (slots, places, BINS) arrays of count, weight and gradients."""
    slots, m = features.shape
    space, every, whole = slots * BINS, len(rows) == len(B), features.strides[0] == 0
    columns = [x if every else x[rows] for x in ([] if weight is None else [weight]) + gradients]
    grid = [np.zeros((slots, m, BINS)) for _ in range(1 + len(columns))]
    base = slot * BINS
    for j in range(m):
        if whole:
            b = B[:, features[0, j]]
            b = b if every else b[rows]
        else:
            b = B[rows, features[slot, j]]
        key = base + b
        grid[0][:, j] = np.bincount(key, minlength=space).reshape(slots, BINS)
        for x, c in zip(grid[1:], columns):
            x[:, j] = np.bincount(key, c, minlength=space).reshape(slots, BINS)
    return [grid[0], grid[0], *grid[1:]] if weight is None else grid


def sparse(grid: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Whole histograms as keys that occur and their sums."""
    at = np.flatnonzero(grid[0])
    return at, [x.ravel()[at] for x in grid]


def wave_keys(B: np.ndarray, rows: np.ndarray, slot: np.ndarray, features: np.ndarray) -> np.ndarray:
    """Keys of the rows' (slot, place, bin), row by row."""
    m = features.shape[1]
    whole = features.strides[0] == 0 and m == B.shape[1]
    bins = B[rows] if whole else B[rows[:, None], features[slot]]  # bytes: the sum below widens them
    return ((slot[:, None] * m + np.arange(m)) * BINS + bins).ravel()


def counted_sums(keys: np.ndarray, columns: list[np.ndarray], space: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """:func:`keyed_sums` with the number of rows as the first sum."""
    if not len(keys) or space > 8 * len(keys) + 4096:
        return keyed_sums(keys, [np.ones(len(keys)), *columns], space)
    count = np.bincount(keys, minlength=space)
    at = np.flatnonzero(count)
    return at, [count[at].astype(float), *[np.bincount(keys, c, minlength=space)[at] for c in columns]]


def wave_sums(B, rows, slot, features, weight, gradients) -> tuple[np.ndarray, list[np.ndarray]]:
    """Histogram sums (keys, [count, weight, gradients...]) of the rows in open nodes; ``weight`` None is one each."""
    m, slots = features.shape[1], len(features)
    keys = wave_keys(B, rows, slot, features)
    columns = [np.repeat(x[rows], m) for x in ([] if weight is None else [weight]) + gradients]
    keys, sums = counted_sums(keys, columns, slots * m * BINS)
    return keys, [sums[0], sums[0], *sums[1:]] if weight is None else sums


def keyed_cuts(g: Grower, tree: Tree, features: np.ndarray, keys, sums, values: np.ndarray) -> Splits:
    """The best cut of every (slot, place) among ``keys``, from whole histograms if those aren't much larger."""
    m = features.shape[1]
    segment, at = np.unique(keys // BINS, return_inverse=True)
    if g.random_cuts or len(segment) * BINS > 4 * len(keys):
        return segment_best(g, tree, features, keys, sums, values)
    found = dense_cuts(g, whole_grid(at * BINS + keys % BINS, sums, len(segment), 1))
    found.slot, found.place = segment[found.slot] // m, segment[found.slot] % m
    return found


def running(grid: list[np.ndarray], step: float) -> list[np.ndarray]:
    """Whole histograms added up along the bins, gradients in units of the targets; they are overwritten."""
    for x in grid if grid[1] is not grid[0] else [grid[0], *grid[2:]]:
        np.cumsum(x, axis=2, out=x)
    for x in grid[2:]:
        x *= step
    return grid


def row_cuts(g: Grower, tree: "Tree", features: np.ndarray, B, rows, slot, weight, grads, step: float, values: np.ndarray) -> Splits:
    """The best cut of each open node of ``tree`` from its rows."""
    if dense(g, len(rows), len(features)):
        return best_of_slots(g, running(dense_sums(B, rows, slot, features, weight, grads), step))
    keys, sums = wave_sums(B, rows, slot, features, weight, grads)
    return best_by_slot(segment_best(g, tree, features, keys, in_units(sums, step), values))


def in_units(sums: list[np.ndarray], step: float) -> list[np.ndarray]:
    """Gradient sums in whole steps as sums in units of the targets."""
    return [*sums[:2], *[s * step for s in sums[2:]]]


def segment_best(g: Grower, tree: Tree, features: np.ndarray, keys, sums, values: np.ndarray) -> Splits:
    """:func:`best_by_segment` with the tree's draws; ``values`` (features, BINS) stand for the bins."""
    return best_by_segment(g, keys, sums, features.shape[1], lambda s, j: tree.cut_draws(s, features[s, j]),
                           lambda s, j, b: values[features[s, j], b])


# --- whole ensembles of rows in memory ----------------------------------------------------------

def gradient_step(largest: float) -> float:
    """Power of two in which gradients of targets up to ``largest`` are counted."""
    return 2.0 ** (math.ceil(math.log2(largest)) + 1 - GRADIENT_BITS) if largest > 0 else 1.0


def target_step(largest: float) -> float:
    return 2.0 ** (math.ceil(math.log2(largest)) - 30) if largest > 0 else 1.0


def rounded_targets(Y: np.ndarray, largest: float) -> np.ndarray:
    """Targets as whole multiples of a power of two (about 1e-9 of the largest), so that sums are exact."""
    step = target_step(largest)
    return np.rint(Y / step) * step


def gradients(F: np.ndarray, Y: np.ndarray, weight, step: float) -> list[np.ndarray]:
    """Whole steps of ``weight * (F - Y)`` by target."""
    return [np.rint((F[:, t] - Y[:, t]) * (1.0 if weight is None else weight) / step) for t in range(Y.shape[1])]


def grown(g: Grower, key: np.uint64, B: np.ndarray, weight: np.ndarray, grads: list[np.ndarray], step: float, values: np.ndarray,
          rate: float) -> Fixed:
    """One tree on rows in memory (those of positive weight)."""
    return grow_tree(g, Tree(key, len(grads)), B, weight, grads, step, values).done(g, rate)


def grow_tree(g: Grower, tree: Tree, B: np.ndarray, weight: np.ndarray, grads: list[np.ndarray], step: float, values: np.ndarray) -> Tree:
    """Grow ``tree`` from its root to the end on rows in memory.

    Where all nodes try the same features, only the smaller child of a node is summed from its rows: the sums of the
    other are what its parent's leave, and exact as all sums are.
    """
    rows = np.flatnonzero(weight > 0)
    plain = None if (weight[rows] == 1).all() else weight
    node = np.zeros(len(rows), np.int64)
    kept = None
    while tree.open:
        features = tree.features(g, B.shape[1])
        arrays = [np.array(x) for x in (tree.feature, tree.cut, tree.left)]
        slot_of = np.full(len(tree.feature), -1)
        slot_of[tree.open] = np.arange(len(tree.open))
        node = route(B, *arrays, node, rows) if len(tree.feature) > 1 else node
        same = features.strides[0] == 0 and not g.symmetric and not g.random_cuts
        small = _smaller(tree, kept[0]) if same and kept is not None else {}
        summed = [n for n in tree.open if n not in small] + sorted({s for _, s in small.values() if slot_of[s] < 0})
        want = slot_of.copy()
        want[summed] = 0
        on = want[node] >= 0  # rows of other leaves are never looked at again
        rows, node = (rows, node) if on.all() else (rows[on], node[on])
        if not len(rows) or not features.shape[1]:
            break
        if same and len(tree.open) * features.shape[1] * BINS <= KEPT_CELLS and dense(g, len(rows), len(tree.open)):
            sums = _wave_sums_by_rest(B, rows, node, tree, features, plain, grads, step, kept, small, summed)
            kept = {n: i for i, n in enumerate(tree.open)}, sums
            tree.grow(g, best_of_slots(g, sums), features)
            continue
        kept, slot = None, slot_of[node]
        if small:
            rows, node, slot = (x[slot >= 0] for x in (rows, node, slot))
        if g.symmetric:
            place, *found = best_of_level(g, in_units(dense_sums(B, rows, slot, features, plain, grads), step))
            tree.grow_level(g, int(features[0, place]), *found)
        else:
            tree.grow(g, row_cuts(g, tree, features, B, rows, slot, plain, grads, step, values), features)
    return tree


def _smaller(tree: Tree, kept: dict[int, int]) -> dict[int, tuple[int, int]]:
    """Open nodes whose sums are their parent's less those of a sibling with no more rows: (parent, sibling)."""
    out = {}
    opened = set(tree.open)
    for parent in kept:
        a = tree.left[parent]
        if a >= 0:
            large, little = (a, a + 1) if tree.stats[a][0] > tree.stats[a + 1][0] else (a + 1, a)
            if large in opened:
                out[large] = parent, little
    return out


def _wave_sums_by_rest(B, rows, node, tree: Tree, features, weight, grads, step: float, kept, small: dict, summed: list[int]) -> list[np.ndarray]:
    """Running sums of the open nodes: those of ``summed`` from their rows, the others from what is kept of their parents."""
    place = {n: i for i, n in enumerate(summed)}
    at = np.full(len(tree.feature), -1)
    at[summed] = np.arange(len(summed))
    slot = at[node]
    some = rows if len(summed) == len(tree.open) and not small else rows[slot >= 0]
    own = running(dense_sums(B, some, slot[slot >= 0], np.broadcast_to(features[0], (len(summed), features.shape[1])), weight, grads), step)
    if not small:
        return own
    plain = own[1] is own[0]
    out = []
    for c, x in enumerate(own):
        if c == 1 and plain:
            out.append(out[0])
            continue
        y = np.empty((len(tree.open), *x.shape[1:]))
        for i, n in enumerate(tree.open):
            if n in small:
                parent, sibling = small[n]
                np.subtract(kept[1][c][kept[0][parent]], x[place[sibling]], out=y[i])
            else:
                y[i] = x[place[n]]
        out.append(y)
    return out


@dataclass
class Ensemble:
    """A finished ensemble of some targets: ``base`` plus the trees' sum, or (AdaBoost) their weighted median."""

    base: np.ndarray
    trees: list[Fixed]
    weights: list[float] | None = None

    def predict(self, B: np.ndarray) -> np.ndarray:
        if self.weights is None:
            out = np.tile(self.base, (len(B), 1))
            for t in self.trees:
                out += t.predict(B)
            return out
        each = np.stack([t.predict(B)[:, 0] for t in self.trees], 1) + self.base[0]
        order = np.argsort(each, axis=1, kind="stable")
        run = np.cumsum(np.array(self.weights)[order], axis=1)
        at = (run < 0.5 * run[:, -1:]).sum(axis=1)
        return np.take_along_axis(each, np.take_along_axis(order, at[:, None], 1), 1)


def weighted_mean(Y: np.ndarray, w: np.ndarray) -> np.ndarray:
    total = w.sum()
    return (Y * w[:, None]).sum(axis=0) / total if total > 0 else np.zeros(Y.shape[1])


def tree_key(g: Grower, bag: int, tree: int) -> np.uint64:
    return key_of(g.seed, 5, bag, tree)


def fitted(g: Grower, ids: np.ndarray, B: np.ndarray, Y: np.ndarray, largest: float, values: np.ndarray, bag: int = 0,
           first: int = 0, last: int | None = None) -> Ensemble:
    """Trees ``first`` to ``last`` of a bag's ensemble on rows in memory; ``Y`` (rows, targets) as :func:`rounded_targets`."""
    last, step, B = g.trees if last is None else last, gradient_step(largest), by_feature(B)
    w0 = bag_weights(g, bag, ids)
    base = weighted_mean(Y, w0)
    F = np.tile(base, (len(Y), 1))
    if g.kind == "adaboost":
        return _adaboost(g, B, Y, w0, base, step, values)
    trees = []
    for t in range(first, last):
        key = tree_key(g, bag, t)
        w = w0 * tree_weights(g, key, ids)
        tree = grown(g, key, B, w, gradients(F, Y, w, step), step, values, g.rate if g.kind == "boost" else 1.0 / g.trees)
        trees.append(tree)
        if g.kind == "boost":
            F += tree.predict(B)
    return Ensemble(base if g.kind == "boost" else base * (last - first) / g.trees, trees)


def _adaboost(g: Grower, B, Y, w, base, step, values) -> Ensemble:
    """AdaBoost.R2: linear loss, weights ``beta ** ((1 - loss) * rate)``, stop at a mean loss of one half."""
    trees, weights, n = [], [], len(Y)
    for t in range(g.trees):
        w = w / w.sum()
        whole = np.rint(w * n * 2.0 ** WEIGHT_BITS) * 2.0 ** -WEIGHT_BITS
        tree = grown(g, tree_key(g, 0, t), B, whole, gradients(np.tile(base, (n, 1)), Y, whole, step), step, values, 1.0)
        gap = np.abs(Y[:, 0] - base[0] - tree.predict(B)[:, 0])
        if gap.max() <= 0:
            return Ensemble(base, [*trees, tree], [*weights, 1.0])
        loss = gap / gap.max()
        err = float((w * loss).sum())
        if err >= 0.5:
            return Ensemble(base, trees, weights) if trees else Ensemble(base, [tree], [1.0])
        beta = err / (1 - err)
        trees.append(tree)
        weights.append(g.rate * math.log(1 / beta) if beta > 0 else 1.0)
        w = w * beta ** ((1 - loss) * g.rate)
    return Ensemble(base, trees, weights)
