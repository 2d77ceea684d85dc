"""Random forests on class counts (L8b): any depth, no job per level at the bottom.

Rows are binned once into blocks of arrays (``boosting``), which all fits on a
table share.  A tree's rows are drawn by a hash of (row, tree): how often a row
counts is Poisson(1), as drawing with replacement makes it; the features tried at
a node are those of least hash of (tree, node, feature).  Splits take the greatest
drop of the Gini impurity, counts being whole numbers, so a forest depends neither
on partitioning nor on order, its first k trees are the forest of k trees, and cut
at depth d it is the forest of that depth: one fit scores every smaller forest.

* *Few rows* (``TASK_ROWS``): blocks go to tasks that grow some of the trees each.
* *Many rows*: while nodes have more rows than a task takes, passes over the blocks
  add up class counts per (tree, node, tried feature, bin); the counts of a tree
  meet in one task and the driver sees a row per node.  Then the rows of each node
  meet in one task, and its whole subtree is grown there, ``GROUP_ROWS`` rows to a
  task and ``BATCH_ROWS`` to a shuffle.

In a task all open nodes of a level advance together; nodes are pairs of a row's
bin and its node, counted densely at the top and by sorting further down, so that a
level costs its rows, not nodes x bins.  A node is a leaf when it is pure, at the
greatest depth, or no cut of its tried features helps and leaves ``least_rows`` on
both sides.  Ties go to the lower feature, then the lower bin; missing values count
as the largest.  The forest's nodes, 11 bytes each, are model state on the driver
and sent to each executor once.
"""

from __future__ import annotations

import itertools
import math
from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, share_package
from .boosting import _binned, _blocks, _mixed, bin_edges, met, picked, summed

MAX_BINS = 128
#: Rows of a node, or of a whole table, that one task takes: about 100 bytes each.
TASK_ROWS = 2_000_000
#: Rows of the nodes that meet in one task.
GROUP_ROWS = 2_000_000
#: Rows of a table up to which a core gets several tasks of a fit, each with all rows.
SPREAD_ROWS = 200_000
#: Rows of a partition of the blocks.
PART_ROWS = 200_000
#: Rows x trees of one shuffle.
BATCH_ROWS = 100_000_000
BLOCK_ROWS = 8192  # rows scored together
LEAST_GAIN = 1e-9  # drop of the impurity, per weight of the node
_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])


@dataclass(frozen=True)
class Spec:
    """One forest: its size, the features tried at a node, the class weights, and
    the fold whose rows it must not see (None: it sees all)."""
    trees: int = 100
    max_depth: int = 30
    least_rows: int = 1
    tried: int = 3
    weights: tuple = (1.0, 1.0)
    fold: int | None = None
    seed: int = 42


@dataclass
class Tree:
    """Nodes as arrays; the right child follows the left one; feature -1: leaf.
    ``value``: weighted share of class 1, of inner nodes too."""
    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    value: np.ndarray
    depth: int


# ------------------------------------------------------------------ in tasks
def _bag(rows: np.ndarray, spec: Spec, tree: int) -> np.ndarray:
    """How often each row counts in a tree."""
    lots = _mixed(rows, spec.seed * 1_000_003 + tree)
    out = np.zeros(len(lots), dtype=np.int64)
    for x in _POISSON[:4]:
        out += lots >= x
    rare = np.flatnonzero(out == 4)
    out[rare] = np.searchsorted(_POISSON, lots[rare], side="right")
    return out


def _tried(trees: np.ndarray, ids: np.ndarray, n_features: int, spec: Spec) -> np.ndarray:
    """(node, tried) features of nodes, numbered from 1 as in a heap, ascending."""
    if spec.tried >= n_features:
        return np.tile(np.arange(n_features), (len(ids), 1))
    node = (trees.astype(np.uint64) << np.uint64(32)) + ids.astype(np.uint64)
    lots = np.stack([_mixed(node, 7_919 * spec.seed + 104_729 * (f + 1)) for f in range(n_features)], axis=1)
    return np.sort(np.argsort(lots, axis=1, kind="stable")[:, :spec.tried], axis=1)


def _cells(key: np.ndarray, hits: np.ndarray, count: np.ndarray, size: int):
    """Keys in order, with the rows of class 1 and all rows of each."""
    if size <= 8 * len(key):
        total = np.bincount(key, count, size)
        at = np.flatnonzero(total)
        return at, np.bincount(key, hits, size)[at], total[at]
    order = np.argsort(key)
    key = key[order]
    at = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    return key[at], np.add.reduceat(hits[order], at), np.add.reduceat(count[order], at)


def _best(keys: np.ndarray, hits: np.ndarray, total: np.ndarray, n_nodes: int, size: int, spec: Spec):
    """Per node, of the counts of one feature by node * size + bin: greatest gain, its
    bin, and the class 1 and all rows left of it and of the whole node."""
    node = keys // size
    start = np.searchsorted(node, np.arange(n_nodes))
    cum = np.stack([np.cumsum(hits), np.cumsum(total)])
    base = np.stack([cum[0][start] - hits[start], cum[1][start] - total[start]])
    end = np.r_[start[1:], len(keys)] - 1
    whole = cum[:, end] - base
    own, every = cum - base[:, node], whole[:, node]
    rest = every - own

    def score(x):
        a, b = x[0] * spec.weights[1], (x[1] - x[0]) * spec.weights[0]
        return (a * a + b * b) / np.maximum(a + b, 1e-300)
    gain = score(own) + score(rest) - score(every)
    least = max(1, spec.least_rows)
    gain[(own[1] < least) | (rest[1] < least)] = -np.inf
    top = np.maximum.reduceat(gain, start)
    at = np.empty(n_nodes, dtype=np.int64)
    hit = np.flatnonzero(gain == top[node])[::-1]
    at[node[hit]] = hit  # the first of a node is set last
    return top, keys[at] % size, own[:, at], whole


def _helps(gain: np.ndarray, whole: np.ndarray, spec: Spec) -> np.ndarray:
    mass = whole[0] * spec.weights[1] + (whole[1] - whole[0]) * spec.weights[0]
    return gain > LEAST_GAIN * mass


def _value(hits: np.ndarray, total: np.ndarray, spec: Spec) -> np.ndarray:
    a, b = hits * spec.weights[1], (total - hits) * spec.weights[0]
    return (a / np.maximum(a + b, 1e-300)).astype(np.float32)


def _open(hits, total, depth, spec: Spec) -> np.ndarray:
    """Whether nodes may be split at all."""
    return (hits > 0) & (hits < total) & (total >= 2 * spec.least_rows) & (depth < spec.max_depth)


def _chosen(bins, rows, slot, hits, count, trees, ids, size: int, spec: Spec):
    """Best cut of every node of a level over its tried features."""
    n, m = bins.shape[1], len(ids)
    tried, flat, best = _tried(trees, ids, len(bins), spec), bins.ravel(), None
    own_cells, first = np.arange(m) * size, (tried * n).T.copy()
    for j in range(tried.shape[1]):
        key = picked(own_cells, slot) + picked(flat, picked(first[j], slot) + rows)
        gain, at, own, whole = _best(*_cells(key, hits, count, m * size), m, size, spec)
        if best is None:
            best = [gain, tried[:, j].copy(), at, own]
            continue
        more = gain > best[0]
        for old, new in zip(best, (gain, tried[:, j], at)):
            old[more] = new[more]
        best[3][:, more] = own[:, more]
    return (*best, whole)


def grow(bins: np.ndarray, y: np.ndarray, count: np.ndarray, slot: np.ndarray, trees: np.ndarray,
         ids: np.ndarray, depth: np.ndarray, size: int, spec: Spec) -> list:
    """The whole subtrees of some nodes; ``slot`` is the node of each row.  Per node
    its arrays (feature, bin, left, value), from its own root."""
    n_roots, flat, n = len(ids), bins.ravel(), bins.shape[1]
    count, hits = count.astype(float), np.where(y > 0, count, 0).astype(float)
    root = np.stack([np.bincount(slot, hits, n_roots), np.bincount(slot, count, n_roots)])
    feature, at, left = [np.full(n_roots, -1)], [np.zeros(n_roots, int)], [np.full(n_roots, -1)]
    value, owner, made = [_value(*root, spec)], [np.arange(n_roots)], n_roots
    rows, number, own_root = np.arange(n), np.arange(n_roots), np.arange(n_roots)
    may = _open(*root, depth, spec)
    while may.any():
        # rows of the nodes that may be split, nodes renumbered
        rank = np.cumsum(may) - 1
        keep = np.flatnonzero(picked(may, slot))
        rows, hits, count, slot = (picked(a, keep) for a in (rows, hits, count, slot))
        slot = picked(rank, slot)
        trees, ids, depth, number, own_root = (a[may] for a in (trees, ids, depth, number, own_root))
        gain, f, b, own, whole = _chosen(bins, rows, slot, hits, count, trees, ids, size, spec)
        split = _helps(gain, whole, spec)
        k = int(split.sum())
        if not k:
            break
        every = np.concatenate(feature), np.concatenate(at), np.concatenate(left)
        for a, new in zip(every, (f[split], b[split], made + 2 * np.arange(k))):
            a[number[split]] = new
        feature, at, left = [every[0]], [every[1]], [every[2]]
        child = np.stack([own[:, split], (whole - own)[:, split]], axis=2).reshape(2, 2 * k)
        for a, fill in ((feature, -1), (at, 0), (left, -1)):
            a.append(np.full(2 * k, fill))
        value.append(_value(*child, spec))
        keep = np.flatnonzero(picked(split, slot))
        rows, hits, count, slot = (picked(a, keep) for a in (rows, hits, count, slot))
        right = picked(flat, picked(f * n, slot) + rows) > picked(b, slot)
        slot = picked(2 * (np.cumsum(split) - 1), slot) + right
        twice = lambda a: np.repeat(a[split], 2)
        trees, depth, own_root = twice(trees), twice(depth) + 1, twice(own_root)
        ids = 2 * twice(ids) + np.tile([0, 1], k)
        owner.append(own_root)
        number = made + np.arange(2 * k)
        made += 2 * k
        may = _open(*child, depth, spec)
    feature, at, left, value, owner = (np.concatenate(a) for a in (feature, at, left, value, owner))
    # nodes by root
    order = np.argsort(owner, kind="stable")
    ends = np.cumsum(np.bincount(owner, minlength=n_roots))
    place = np.empty(made, dtype=np.int64)
    place[order] = np.arange(made) - np.repeat(np.r_[0, ends[:-1]], np.diff(np.r_[0, ends]))
    left = np.where(left >= 0, place[left], -1)
    packed = [a[order].astype(t) for a, t in zip((feature, at, left, value),
                                                 (np.int16, np.uint8, np.int32, np.float32))]
    return [tuple(a[s:e] for a in packed) for s, e in zip(np.r_[0, ends[:-1]], ends)]


def _walk(bins: np.ndarray, tree, steps: int):
    """The node of each row (a column of ``bins``) after 0, 1, ... ``steps`` steps."""
    n = bins.shape[1]
    node, flat, place = np.zeros(n, dtype=np.int64), bins.ravel(), np.arange(n)
    inner = tree.feature >= 0
    start = np.where(inner, tree.feature, 0).astype(np.int64) * n
    limit = np.where(inner, tree.bin, np.iinfo(bins.dtype).max).astype(bins.dtype)
    first = np.where(inner, tree.left, np.arange(len(tree.left))).astype(np.int64)
    yield node
    for _ in range(steps):
        node = picked(first, node) + (picked(flat, picked(start, node) + place) > picked(limit, node))
        yield node


def _last(bins, tree, steps: int) -> np.ndarray:
    for node in _walk(bins, tree, steps):
        pass
    return node


# ------------------------------------------------------------------ the model
@dataclass
class Forest:
    """A fitted forest over ``features`` cut at ``edges``."""
    spec: Spec
    features: list
    edges: list
    trees: list = field(default_factory=list)

    def shares(self, columns: list) -> np.ndarray:
        """Mean share of class 1 over the trees."""
        bins = _binned(columns, self.edges)
        out = np.zeros(bins.shape[1])
        for a in range(0, len(out), BLOCK_ROWS):
            part = np.ascontiguousarray(bins[:, a:a + BLOCK_ROWS])
            for t in self.trees:
                out[a:a + BLOCK_ROWS] += t.value[_last(part, t, t.depth)]
        return out / max(1, len(self.trees))

    def transform(self, df: DataFrame) -> DataFrame:
        """The rows with ``probability`` and ``prediction`` (vector columns left out)."""
        share_package(df.sparkSession)
        plain = df.select(*[F.col(f"`{f.name}`") for f in df.schema.fields
                            if not isinstance(f.dataType, VectorUDT)
                            and f.name not in ("probability", "prediction")])
        names = plain.columns
        wide = plain.select("*", *[F.col(f"`{c}`").cast("double").alias(f"_x{i}")
                                   for i, c in enumerate(self.features)])
        shared = df.sparkSession.sparkContext.broadcast(self)

        def run(batches):
            model = shared.value
            for b in batches:
                p = model.shares([b.column(len(names) + i).to_numpy(zero_copy_only=False)
                                  for i in range(len(model.features))])
                yield pa.RecordBatch.from_arrays(
                    [*b.columns[:len(names)], pa.array(p), pa.array((p > 0.5).astype(float))],
                    names=[*names, "probability", "prediction"])
        schema = plain.schema.add("probability", "double").add("prediction", "double")
        return wide.mapInArrow(run, schema)


# ------------------------------------------------------------------ training
class Rows:
    """The binned blocks of a training table, held for several fits."""

    def __init__(self, train: DataFrame, features: list, label: str, keys: list, edges: list | None = None):
        spark = train.sparkSession
        share_package(spark)
        ensure_checkpoint_dir(spark)
        self.sc, self.features = spark.sparkContext, list(features)
        self.edges = edges if edges is not None else bin_edges(train, features, MAX_BINS)
        self.size = max((len(e) + 1 for e in self.edges), default=1)
        self.n = train.count()
        cores = self.sc.defaultParallelism
        parts = max(1, min(max(cores, math.ceil(self.n / PART_ROWS)), math.ceil(self.n / 2_000)))
        self.blocks = _blocks(train, features, self.edges, label, keys, parts, np.zeros(0)).persist()

    def release(self) -> None:
        self.blocks.unpersist()


def _seen(block: dict, spec: Spec) -> np.ndarray:
    return np.flatnonzero(block["fold"] != spec.fold) if spec.fold is not None \
        else np.arange(len(block["y"]))


def fit(rows: Rows, spec: Spec) -> Forest:
    """One forest on the rows outside its fold."""
    model = Forest(spec, rows.features, rows.edges)
    if not rows.n:
        return model
    if rows.n <= TASK_ROWS:
        model.trees = _fit_few(rows, spec)
    else:
        step = max(1, BATCH_ROWS // rows.n)
        for a in range(0, spec.trees, step):
            model.trees += _fit_many(rows, spec, range(a, min(spec.trees, a + step)))
    return model


def _depth(feature: np.ndarray, left: np.ndarray) -> int:
    depth, level = 0, np.zeros(1, dtype=np.int64)
    while len(level := level[feature[level] >= 0]):
        level, depth = np.r_[left[level], left[level] + 1], depth + 1
    return depth


def _fit_few(rows: Rows, spec: Spec) -> list:
    """Each task gets all the rows, few as they are, and grows some of the trees."""
    cores, size = rows.sc.defaultParallelism, rows.size
    tasks = min(spec.trees, 4 * cores if rows.n <= SPREAD_ROWS else cores)

    def run(split, pairs):
        blocks = [b for _, b in pairs]
        if not blocks:
            return
        whole = {k: np.concatenate([b[k] for b in blocks], axis=-1) for k in ("y", "row", "bins")}
        for tree in range(split, spec.trees, tasks):
            count = _bag(whole["row"], spec, tree)
            used = np.flatnonzero(count)
            yield tree, grow(np.ascontiguousarray(whole["bins"][:, used]), whole["y"][used], count[used],
                             np.zeros(len(used), dtype=np.int64), np.array([tree]), np.array([1]),
                             np.array([0]), size, spec)[0]

    def deal(blocks):
        for b in blocks:
            seen = _seen(b, spec)
            own = {k: b[k][..., seen] for k in ("y", "row", "bins")}
            yield from ((i, own) for i in range(tasks))
    grown = met(rows.blocks, deal, tasks, run)
    return [Tree(f, b, x, v, _depth(f, x)) for _, (f, b, x, v) in sorted(grown, key=lambda g: g[0])]


class _Top:
    """The upper nodes of one tree, while they have too many rows for a task."""

    def __init__(self, n: int):
        self.feature, self.bin, self.left, self.ids, self.level = [-1], [0], [-1], [1], [0]
        self.hits, self.total = [None], [n]
        self.asked = [0]       # nodes to be cut by a pass
        self.waiting: list = []  # nodes whose rows go to a task

    def arrays(self):
        return Tree(np.array(self.feature), np.array(self.bin), np.array(self.left), None, max(self.level))

    def receive(self, cuts, spec: Spec) -> None:
        gain, f, b, own, whole = cuts
        helps, asked, self.asked = _helps(gain, whole, spec), self.asked, []
        for i, node in enumerate(asked):
            self.hits[node], self.total[node] = (float(x) for x in whole[:, i])
            if not helps[i] or not _open(*whole[:, i], self.level[node], spec):
                continue
            first = len(self.feature)
            self.feature[node], self.bin[node], self.left[node] = int(f[i]), int(b[i]), first
            for side, (h, t) in enumerate((own[:, i], whole[:, i] - own[:, i])):
                self.feature.append(-1), self.bin.append(0), self.left.append(-1)
                self.ids.append(2 * self.ids[node] + side)
                self.level.append(self.level[node] + 1)
                self.hits.append(float(h)), self.total.append(float(t))
                if _open(h, t, self.level[-1], spec):
                    (self.asked if t > TASK_ROWS else self.waiting).append(first + side)

    def joined(self, subtrees: dict, spec: Spec) -> Tree:
        """The tree with the subtrees of its waiting nodes in their places."""
        parts = [[np.array(self.feature, np.int16)], [np.array(self.bin, np.uint8)],
                 [np.array(self.left, np.int32)],
                 [_value(np.array(self.hits, float), np.array(self.total, float), spec)]]
        n = len(self.feature)
        for node, (f, b, x, v) in subtrees.items():
            if f[0] < 0:
                continue
            # the subtree's root takes the node's place, the others follow
            move = lambda at, n=n: np.where(at >= 0, at + n - 1, -1).astype(np.int32)
            parts[0][0][node], parts[1][0][node], parts[2][0][node] = f[0], b[0], move(x[:1])[0]
            for p, a in zip(parts, (f[1:], b[1:], move(x[1:]), v[1:])):
                p.append(a)
            n += len(f) - 1
        f, b, x, v = (np.concatenate(p) for p in parts)
        return Tree(f, b, x, v, _depth(f, x))


def _own_rows(block: dict, spec: Spec, tree: int, top: Tree, nodes: list):
    """Rows of some nodes of a tree: place, which of the nodes, how often it counts."""
    slot = np.full(len(top.feature), -1)
    slot[nodes] = np.arange(len(nodes))
    at = slot[_last(block["bins"], top, top.depth)]
    count = _bag(block["row"], spec, tree)
    if spec.fold is not None:
        count[block["fold"] == spec.fold] = 0
    use = np.flatnonzero((at >= 0) & (count > 0))
    return use, at[use], count[use]


def _fit_many(rows: Rows, spec: Spec, trees: range) -> list:
    """Some trees, the upper nodes by passes over all rows, then a task per group of
    nodes."""
    tops, size = {t: _Top(rows.n) for t in trees}, rows.size
    n_tasks = rows.blocks.getNumPartitions()
    while asked := {t: (top.arrays(), top.asked, np.array(top.ids)[top.asked])
                    for t, top in tops.items() if top.asked}:
        def count_up(blocks, asked=asked):
            out: dict = {}
            for block in blocks:
                n, flat = block["bins"].shape[1], block["bins"].ravel()
                for t, (top, nodes, ids) in asked.items():
                    use, slot, count = _own_rows(block, spec, t, top, nodes)
                    tried = _tried(np.full(len(ids), t), ids, len(block["bins"]), spec)
                    hits, cells = np.where(block["y"][use] > 0, count, 0), len(ids) * size
                    sums = []
                    for j in range(tried.shape[1]):
                        key = slot * size + flat[tried[slot, j] * n + use]
                        sums.append((np.bincount(key, hits, cells), np.bincount(key, count, cells)))
                    sums = np.array(sums).astype(np.int64)
                    out[t] = out[t] + sums if t in out else sums
            return out.items()

        def cut(_, pairs, asked=asked):
            sums: dict = {}
            for t, x in pairs:
                sums[t] = sums[t] + x if t in sums else x
            for t, x in sums.items():
                _, nodes, ids = asked[t]
                tried, best = _tried(np.full(len(ids), t), ids, len(rows_features), spec), None
                for j, (hits, total) in enumerate(x.astype(float)):
                    at = np.flatnonzero(total)
                    gain, b, own, whole = _best(at, hits[at], total[at], len(ids), size, spec)
                    if best is None:
                        best = [gain, tried[:, j].copy(), b, own]
                        continue
                    more = gain > best[0]
                    for old, new in zip(best, (gain, tried[:, j], b)):
                        old[more] = new[more]
                    best[3][:, more] = own[:, more]
                yield t, (*best, whole)
        rows_features = rows.features
        for t, cuts in met(rows.blocks, count_up, min(n_tasks, len(asked)), cut):
            tops[t].receive(cuts, spec)
    # nodes into tasks of like size
    places, groups, held = {}, [], 0
    for t, top in tops.items():
        for node in top.waiting:
            if not groups or held + top.total[node] > GROUP_ROWS:
                groups.append([])
                held = 0
            places[t, node] = len(groups) - 1, len(groups[-1])
            groups[-1].append((t, node, top.ids[node], top.level[node]))
            held += top.total[node]
    subtrees: dict = {t: {} for t in tops}
    if groups:
        uppers = {t: (top.arrays(), top.waiting, np.array([places[t, x] for x in top.waiting]))
                  for t, top in tops.items() if top.waiting}

        def deal(blocks):
            for block, (t, (top, nodes, place)) in itertools.product(blocks, uppers.items()):
                use, at, count = _own_rows(block, spec, t, top, nodes)
                code = (2 * count + (block["y"][use] > 0)).astype(np.uint8)
                # the nodes are in the order of their groups; small whole numbers sort in one go
                order = np.argsort(at.astype(np.uint16) if len(nodes) <= 1 << 16 else at, kind="stable")
                use, code = picked(use, order), picked(code, order)
                times, (group, slot) = np.bincount(at, minlength=len(nodes)), place.T
                ends = np.r_[0, np.cumsum(times)]
                for g in np.unique(group).tolist():
                    a, z = np.searchsorted(group, [g, g + 1])
                    lo, hi = ends[a], ends[z]
                    if hi > lo:
                        yield g, (slot[a:z], times[a:z], block["bins"].take(use[lo:hi], axis=1), code[lo:hi])

        def whole(g, pairs):
            chunks = [x for _, x in pairs]
            if not chunks:
                return
            slot = np.concatenate([np.repeat(w, k) for w, k, _, _ in chunks])
            code = np.concatenate([c for *_, c in chunks])
            bins = np.concatenate([b for _, _, b, _ in chunks], axis=1)
            of, node, ids, level = np.array(groups[g], dtype=np.int64).T
            made = grow(bins, code & 1, code >> 1, slot, of, ids, level, size, spec)
            yield from zip(of.tolist(), node.tolist(), made)
        for t, node, arrays in met(rows.blocks, deal, len(groups), whole):
            subtrees[t][node] = arrays
    return [tops[t].joined(subtrees[t], spec) for t in trees]


def scores(rows: Rows, model: Forest, sizes: set) -> dict:
    """(trees, depth) -> (tn, fp, fn, tp) of the held-out fold (no fold: all rows) for
    the forest cut to these sizes."""
    fold, depths = model.spec.fold, sorted({d for _, d in sizes})
    shared = rows.sc.broadcast(model.trees)

    def run(block):
        use = np.flatnonzero(block["fold"] == fold) if fold is not None else np.arange(len(block["y"]))
        out = defaultdict(lambda: np.zeros(4, dtype=np.int64))
        for a in range(0, len(use), BLOCK_ROWS):
            part = use[a:a + BLOCK_ROWS]
            bins, y = np.ascontiguousarray(block["bins"][:, part]), block["y"][part] > 0
            total = {d: np.zeros(len(part)) for d in depths}
            for i, tree in enumerate(shared.value, 1):
                steps = min(tree.depth, depths[-1])
                for step, node in enumerate(_walk(bins, tree, steps)):
                    for d in depths:
                        if step == min(d, steps):
                            total[d] += picked(tree.value, node)
                for d in depths:
                    if (i, d) in sizes:
                        p = total[d] / i > 0.5
                        out[i, d] += np.array([(~y & ~p).sum(), (~y & p).sum(), (y & ~p).sum(), (y & p).sum()])
        return list(out.items())
    counts = summed(rows.blocks, run)
    shared.unpersist()
    return {key: tuple(int(x) for x in c) for key, c in counts}
