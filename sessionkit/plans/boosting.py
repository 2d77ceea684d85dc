"""Boosted trees on gradient histograms, many models in one pass (L8c, L8d).

Training rows are binned once and packed into blocks of arrays.  A pass over
the blocks adds up, for every model and every leaf asked for, the gradients,
hessians and rows per (feature, bin); a shuffle by (model, feature) adds up the
partitions and finds each leaf's best split of that feature, and the driver,
which sees one row per (leaf, feature), takes the best of all features.  All
models given to ``fit_many`` share each pass.

* *Second order*: logistic loss, Newton leaf values -G / (H + l2), split gain
  GL^2 / (HL + l2) + GR^2 / (HR + l2) - G^2 / (H + l2), a least hessian and a
  least number of rows per child.
* *Level-wise* trees (a depth limit) split all leaves of a level in one pass.
* *Leaf-wise* trees (a limit on leaves) take the leaf of greatest gain first.
  Of the open leaves at most as many as there are splits left can ever be
  taken, those of greatest gain; a pass fetches the children of all of these,
  so that a tree needs as many passes as it has levels, not splits.
* *Subtraction*: in the task of a single partition only the smaller child's
  sums are added up, its sibling's are the parent's less those.
* *Subtrees*: passes cut the upper leaves only.  Once a leaf has few rows
  (``MOST_ROWS`` at most), its rows meet in one task, which grows all that is below
  it in place and sends the nodes.
* Gradients and hessians are rounded to multiples of 2^-24 and added as
  integers, so sums, and with them whole models, do not depend on how rows
  are partitioned or on the order of adding.
* Rows of a round and features of a tree are sampled by hashes of (row or
  feature, round); the first rounds of a fit are thus the same as a fit of
  fewer rounds, and one fit scores every smaller number of rounds.

The margins of all rows are the only state.  They are persisted per round and
checkpointed every ``CHECKPOINT_EVERY`` rounds in the shared folder (the checkpoint before
is then deleted), so a lost executor costs a few rounds of tree lookups.  Where rows x models make a single
partition (at most ``TASK_ROWS``), there are no sums to add across partitions,
and the task of that partition grows the same trees without a job per level,
keeping the rows of each leaf.  Missing values count as the largest.  Ties go to the lower feature, then the lower bin.
"""

from __future__ import annotations

import heapq
import json
import math
import pickle
from dataclasses import asdict, dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, file_system, share_package

UNIT = float(1 << 24)
MAX_BINS = 256
BLOCK_ROWS = 65_536
#: Rows x models of a fit that one task makes: about 100 bytes a row, and no job per level.
TASK_ROWS = 2_000_000
#: Bytes of a partition of the passes over more rows.
PART_BYTES = 64 << 20
#: Rows of a leaf whose subtree one task grows, at most; fewer where every core has some.
MOST_ROWS = 2_000_000
#: Rows x models of one shuffle.
BATCH_ROWS = 100_000_000
#: A partition has this many rows at least.
LEAST_ROWS = 2_000
#: Bytes of sums fetched by one pass; more leaves are fetched in several.
PASS_BYTES = 128 << 20
#: Leaves of a tree whose sums are kept for subtraction.
KEPT_LEAVES = 1024
CHECKPOINT_EVERY = 10
#: The same of a fit in one task, whose rounds take no jobs.
PLACE_EVERY = 50
LEAST_GAIN = 1e-6
#: Cells of features that are counted together, by the rows at hand.
JOINT_CELLS = (1 << 16, 1 << 12, 1 << 8)


@dataclass(frozen=True)
class Spec:
    """One model: its size, penalties and sampling, the class weights, and the
    fold whose rows it must not see (None: it sees all)."""
    rounds: int = 100
    rate: float = 0.3
    max_depth: int = 0       # 0: no limit
    max_leaves: int = 0      # 0: no limit; else leaf-wise
    l2: float = 1.0
    least_hessian: float = 1.0
    least_rows: int = 1
    row_share: float = 1.0
    feature_share: float = 1.0
    weights: tuple = (1.0, 1.0)
    fold: int | None = None


@dataclass
class Tree:
    """Nodes as arrays; the right child follows the left one; feature -1: leaf."""
    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    rows: np.ndarray
    depth: int


# ------------------------------------------------------------------ in tasks
def picked(a: np.ndarray, at: np.ndarray) -> np.ndarray:
    """``a[at]`` of places known to be inside, which spares their check (most of
    the time of an index)."""
    return a.take(at, mode="clip")


def _leaf_of(bins: np.ndarray, feature, at, left, depth: int) -> np.ndarray:
    """The node of each row (a column of ``bins``) after ``depth`` steps."""
    n = bins.shape[1]
    node = np.zeros(n, dtype=np.int64)
    if not depth:
        return node
    flat, place = bins.ravel(), np.arange(n)
    # a leaf leads to itself
    inner = feature >= 0
    start = np.where(inner, feature, 0).astype(np.int64) * n
    limit = np.where(inner, at, np.iinfo(bins.dtype).max).astype(bins.dtype)
    first = np.where(inner, left, np.arange(len(left))).astype(np.int64)
    out = node
    for step in range(1, depth + 1):
        node = picked(first, node) + (picked(flat, picked(start, node) + place) > picked(limit, node))
        if step % 3 == 0 and step < depth:
            going = np.flatnonzero(picked(inner, node))
            if 2 * len(going) < len(node):  # most rows have reached their leaf
                out[place] = node
                node, place = picked(node, going), picked(place, going)
    out[place] = node
    return out


def _mixed(rows: np.ndarray, salt: int) -> np.ndarray:
    """Uniform 53-bit hashes of row hashes and a salt, as shares of 1."""
    x = rows ^ np.uint64((salt * 0x9E3779B97F4A7C15 + 0x1234567) & (2 ** 64 - 1))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(float) / (1 << 53)


def gradients(margin: np.ndarray, y: np.ndarray, weights: tuple):
    """Gradients and hessians of the logistic loss, in units, as whole floats."""
    p = 1.0 / (1.0 + np.exp(-margin))
    w = np.where(y > 0, weights[1], weights[0]) if weights != (1.0, 1.0) else 1.0
    return np.rint((p - y) * w * UNIT), np.rint(np.maximum(p * (1 - p), 1e-16) * w * UNIT)


def _used(block: dict, spec: Spec, turn: int) -> np.ndarray:
    """The rows that a model sees in a round."""
    use = np.ones(len(block["y"]), dtype=bool)
    if spec.fold is not None:
        use &= block["fold"] != spec.fold
    if spec.row_share < 1:
        use &= _mixed(block["row"], turn) < spec.row_share
    return use


def _sums(place, g: np.ndarray, h: np.ndarray, size: int) -> np.ndarray:
    """(3, size) sums of gradient, hessian and rows by place."""
    return np.stack([np.bincount(place, g, size), np.bincount(place, h, size),
                     np.bincount(place, minlength=size)])


def _groups(widths: list, most: int) -> list:
    """The features in groups of at most ``most`` cells, narrow ones first."""
    out, cells = [], 0
    for f in sorted(range(len(widths)), key=lambda f: (widths[f], f)):
        if out and cells * widths[f] <= most:
            out[-1].append(f)
            cells *= widths[f]
        else:
            out.append([f])
            cells = widths[f]
    return out


def _joined(bins: np.ndarray, group: list, widths: list) -> np.ndarray:
    """The cell of each row in the product of a group's features."""
    if len(group) == 1:
        return bins[group[0]]
    out = bins[group[0]].astype(np.uint16)
    for f in group[1:]:
        out *= np.uint16(widths[f])
        out += bins[f].astype(np.uint16)
    return out


def _each(cells: np.ndarray, group: list, widths: list):
    """(feature, its sums) from the sums (3, leaves, cells) of a group."""
    if len(group) == 1:
        yield group[0], cells
        return
    half = len(group) // 2
    left, right = group[:half], group[half:]
    pair = cells.reshape(*cells.shape[:2], math.prod(widths[f] for f in left), -1)
    yield from _each(pair.sum(axis=3), left, widths)
    yield from _each(pair.sum(axis=2), right, widths)


class _Cells:
    """The bins of rows, and of features counted together as far as asked for."""

    def __init__(self, bins: np.ndarray):
        self.bins, self.joint = bins, {}

    def sums(self, rows, g: np.ndarray, h: np.ndarray, slot, n: int, widths: list) -> np.ndarray:
        """(3, leaves, cells) sums of gradient, hessian and rows of ``rows`` (None: all) by
        leaf; the cells of a leaf are the bins of the first feature, then those of the
        second, and so on.  Features of few bins are counted together where rows are many:
        whole numbers, so the sums per feature are the same."""
        start = np.cumsum([0, *widths])
        out = np.empty((3, n, start[-1]))
        most = next((x for x in JOINT_CELLS if 4 * n * x <= len(g)), 1)
        if most not in self.joint:
            groups = _groups(widths, most)
            self.joint[most] = [(x, _joined(self.bins, x, widths)) for x in groups]
        for group, cells in self.joint[most]:
            size = math.prod(widths[f] for f in group)
            place = cells if rows is None else picked(cells, rows)
            place = place.astype(np.intp)
            if slot is not None:
                place += slot * size
            for f, x in _each(_sums(place, g, h, n * size).reshape(3, n, size), group, widths):
                out[:, :, start[f]:start[f + 1]] = x
        return out


def _block_sums(block: dict, asked: dict, specs: list, widths: list, turn: int):
    """(model, (3, leaves, cells) sums) of a block.  Models that see the same rows share
    the cut to these."""
    alike: dict = {}
    for m in asked:
        alike.setdefault((specs[m].fold, specs[m].row_share), []).append(m)
    for models in alike.values():
        used = np.flatnonzero(_used(block, specs[models[0]], turn))
        every = len(used) == len(block["y"])
        bins, y = (block["bins"], block["y"]) if every else (block["bins"].take(used, axis=1, mode="clip"),
                                                             picked(block["y"], used))
        cells = _Cells(bins)
        for m in models:
            feature, at, left, depth, leaves = asked[m]
            slot = np.full(len(feature), -1)
            slot[leaves] = np.arange(len(leaves))
            own = picked(slot, _leaf_of(bins, feature, at, left, depth)) if depth else None
            margin, cls, rows = block["margin"][m] if every else picked(block["margin"][m], used), y, None
            if own is not None and own.min(initial=0) < 0:
                rows = np.flatnonzero(own >= 0)
                margin, cls, own = (picked(x, rows) for x in (margin, y, own))
            g, h = gradients(margin, cls, specs[m].weights)
            yield m, cells.sums(rows, g, h, own, len(leaves), widths)


def _gain(left: np.ndarray, whole: np.ndarray, spec: Spec) -> np.ndarray:
    """Gain of cuts with these sums left of them, of leaves with these sums; -inf
    where a child is too small."""
    rest = whole - left
    score = lambda g, h: (g / UNIT) ** 2 / (h / UNIT + spec.l2 + 1e-12)
    gain = score(left[0], left[1]) + score(rest[0], rest[1]) - score(whole[0], whole[1])
    for side in (left, rest):
        gain[(side[1] < spec.least_hessian * UNIT) | (side[2] < max(1, spec.least_rows))] = -np.inf
    return gain


def _best_cuts(cells: np.ndarray, spec: Spec):
    """Per leaf, of one feature's sums (3, leaves, bins): greatest gain, its bin,
    and the sums left of it and of the whole leaf."""
    whole, cum = cells.sum(axis=2), cells.cumsum(axis=2)
    gain = _gain(cum, whole[..., None], spec)
    at, every = gain.argmax(axis=1), np.arange(len(gain))
    return gain[every, at], at.astype(np.int32), cum[:, every, at], whole


def _added(a: dict, b: dict) -> dict:
    return {m: a[m] + b[m] if m in a and m in b else a.get(m, b.get(m)) for m in a.keys() | b.keys()}


def _moved(block: dict, trees: dict, specs: list) -> dict:
    """The block with the margins after one more tree of each model."""
    margin = block["margin"].copy()
    for m, t in trees.items():
        margin[m] += specs[m].rate * t.value[_leaf_of(block["bins"], t.feature, t.bin, t.left, t.depth)]
    return {**block, "margin": margin}


def _view(block: dict, fold: int | None, views: dict) -> tuple:
    """Of a model that does not see a fold: the rows it sees, their cells, the other rows
    and their bins; kept in ``views``."""
    if fold not in views:
        if fold is None:
            views[fold] = slice(None), _Cells(block["bins"]), None, None
        else:
            seen, rest = (np.flatnonzero(x) for x in (block["fold"] != fold, block["fold"] == fold))
            bins = [block["bins"].take(x, axis=1) for x in (seen, rest)]
            views[fold] = seen, _Cells(bins[0]), rest, bins[1]
    return views[fold]


class _Rows:
    """The rows of the leaves of one tree in growth, in one block."""

    def __init__(self, block: dict, m: int, spec: Spec, turn: int, views: dict | None = None):
        self.seen, self.cells, self.rest, self.rest_bins = _view(block, spec.fold, {} if views is None else views)
        self.margin = block["margin"][m]
        self.g, self.h = gradients(self.margin[self.seen], block["y"][self.seen], spec.weights)
        rows = self.left = None
        if spec.row_share < 1:
            sampled = _mixed(block["row"][self.seen], turn) < spec.row_share
            rows, self.left = np.flatnonzero(sampled), np.flatnonzero(~sampled)
        self.held = {0: rows}  # None: all

    @classmethod
    def alone(cls, bins: np.ndarray, g: np.ndarray, h: np.ndarray) -> _Rows:
        """The rows of one leaf."""
        out = cls.__new__(cls)
        out.cells, out.g, out.h, out.held = _Cells(bins), g, h, {0: None}
        return out

    def of(self, leaf: int, tree: Growth):
        if leaf not in self.held:
            parent = tree.parent[leaf]
            rows = self.of(parent, tree)
            cells = self.cells.bins[tree.feature[parent]]
            right = (cells if rows is None else picked(cells, rows)) > tree.bin[parent]
            first = tree.left[parent]
            for node, x in ((first, ~right), (first + 1, right)):
                own = np.flatnonzero(x)
                self.held[node] = own if rows is None else picked(rows, own)
            del self.held[parent]
        return self.held[leaf]

    def sums(self, leaves: list, tree: Growth) -> np.ndarray:
        """(3, leaves, cells) sums of gradient, hessian, rows."""
        held, n, widths = [self.of(x, tree) for x in leaves], len(leaves), np.diff([0, *tree.ends]).tolist()
        if n == 1 and held[0] is None:
            return self.cells.sums(None, self.g, self.h, None, 1, widths)
        rows = np.concatenate(held) if n > 1 else held[0]
        slot = np.repeat(np.arange(n), [len(x) for x in held]) if n > 1 else None
        return self.cells.sums(rows, picked(self.g, rows), picked(self.h, rows), slot, n, widths)

    def move(self, growth: Growth, tree: Tree) -> None:
        """Add a grown tree to the margins; the rows it was grown on have found their leaf."""
        spec, value, step = growth.spec, growth.leaf_values(), np.empty(len(self.g))
        for leaf in value:
            if growth.feature[leaf] < 0:
                self.of(leaf, growth)
        for node, rows in self.held.items():
            while node not in value:  # split, but not in the tree
                node = growth.parent[node]
            step[slice(None) if rows is None else rows] = value[node]
        reach = lambda bins: tree.value[_leaf_of(bins, tree.feature, tree.bin, tree.left, tree.depth)]
        if self.left is not None:
            step[self.left] = reach(self.cells.bins.take(self.left, axis=1))
        self.margin[self.seen] += spec.rate * step
        if self.rest is not None:
            self.margin[self.rest] += spec.rate * reach(self.rest_bins)


def _grow_here(tree: Growth, rows: _Rows) -> None:
    """Grow a tree whose rows are all here."""
    room = max(1, PASS_BYTES // (3 * 8 * tree.ends[-1]))
    while not tree.done:
        asked = tree.asked
        for lo in range(0, len(asked), room):
            tree.receive(asked[lo:lo + room], rows.sums(asked[lo:lo + room], tree))
        tree.advance()


def _rounds_in_place(blocks: list, specs: list, widths: list, first: int, last: int):
    """Rounds of training rows that are one partition: there is nothing to add up
    across partitions, so its task grows the trees.  The block, one from here on,
    carries them."""
    block = {k: np.concatenate([b[k] for b in blocks], axis=-1)
             for k in ("y", "fold", "row", "bins", "margin") if k in blocks[0]}
    views, grown = {}, []
    for turn in range(first, last):
        trees = {}
        for m, spec in enumerate(specs):
            if turn < spec.rounds:
                rows = _Rows(block, m, spec, turn, views)
                growth = Growth(spec, allowed_features(len(widths), spec.feature_share, turn), widths)
                _grow_here(growth, rows)
                trees[m] = growth.tree()
                rows.move(growth, trees[m])
        grown.append(trees)
    return [{**block, "grown": grown}]


def _dealt(block: dict, waiting: dict, specs: list, turn: int):
    """(group, rows of some leaves) of a block, ``waiting`` being model -> its tree so far,
    its leaves, by group, and the group of each."""
    alike: dict = {}
    for m in waiting:
        alike.setdefault((specs[m].fold, specs[m].row_share), []).append(m)
    for models in alike.values():
        used = np.flatnonzero(_used(block, specs[models[0]], turn))
        bins = block["bins"] if len(used) == len(block["y"]) else block["bins"].take(used, axis=1, mode="clip")
        for m in models:
            (feature, at, left, depth), leaves, group = waiting[m]
            slot = np.full(len(feature), len(leaves), dtype=np.uint16 if len(leaves) < 65_535 else np.int64)
            slot[leaves] = np.arange(len(leaves))
            own = picked(slot, _leaf_of(bins, feature, at, left, depth))
            order = np.argsort(own, kind="stable")
            count = np.bincount(own, minlength=len(leaves) + 1)
            ends = np.cumsum(count)
            order = order[:ends[len(leaves) - 1]]
            rows = picked(used, order)
            g, h = gradients(picked(block["margin"][m], rows), picked(block["y"], rows), specs[m].weights)
            whole = np.int32 if max(specs[m].weights) < 64 else np.int64
            for x in np.unique(group).tolist():
                a, z = np.searchsorted(group, [x, x + 1])
                lo, hi = (ends[a - 1] if a else 0), ends[z - 1]
                if hi > lo:
                    yield x, (m, leaves[a:z], count[a:z], bins.take(order[lo:hi], axis=1, mode="clip"),
                              g[lo:hi].astype(whole), h[lo:hi].astype(whole))


def _subtrees(chunks: list, roots: dict, specs: list, widths: list, turn: int):
    """(model, leaf, its subtree) of the leaves whose rows are here; ``roots``: (model,
    leaf) -> its level and path."""
    at: dict = {}
    for m, leaves, count, bins, g, h in chunks:
        ends = np.cumsum(count)
        for leaf, a, z in zip(leaves, ends - count, ends):
            if z > a:
                at.setdefault((m, leaf), []).append((bins[:, a:z], g[a:z], h[a:z]))
    for (m, leaf), parts in at.items():
        bins, g, h = (np.concatenate(x, axis=-1) for x in zip(*parts))
        level, path = roots[m, leaf]
        spec = specs[m]
        if spec.max_leaves:  # the splits above it are taken already
            spec = replace(spec, max_leaves=max(1, spec.max_leaves - level))
        tree = Growth(spec, allowed_features(len(widths), spec.feature_share, turn), widths, level, path)
        _grow_here(tree, _Rows.alone(bins, g.astype(float), h.astype(float)))
        yield m, leaf, tree.packed()


# ------------------------------------------------------------------ growing
class Growth:
    """One tree in growth: which leaves' sums are needed next, and its splits.
    ``widths``: the bins of each feature; ``level``, ``path``: of its root, where it is part
    of a tree.  ``most``: leaves of at most as many rows are not split here, their rows go to
    a task that grows what is below them (``dealt``, ``graft``); None: all are split here."""

    def __init__(self, spec: Spec, allowed: np.ndarray, widths: list, level: int = 0, path: int = 1,
                 most: int | None = None):
        self.spec, self.allowed, self.most = spec, allowed, most
        self.ends, self.of_cell = np.cumsum(widths).tolist(), np.repeat(np.arange(len(widths)), widths)
        self.feature, self.bin, self.left, self.level, self.parent = [-1], [0], [-1], [level], [-1]
        self.path = [path]                # the root 1, the children of x 2 x and 2 x + 1
        self.dealt: list = []
        self.sums: list = [None]          # (G, H, rows) in units
        self.cells: dict = {}             # open leaf -> its sums per cell (feature and bin)
        self.split: dict = {}             # leaf -> (gain, feature, bin, sums of the left child)
        self.asked, self.pending = [0], {}
        self.done = False
        self.taken: list = []

    def request(self):
        """The tree so far, and its depth."""
        arrays = [np.array(x, dtype=np.int32) for x in (self.feature, self.bin, self.left)]
        return (*arrays, max(self.level))

    def packed(self):
        """All nodes of a grown subtree, for ``graft``."""
        gain = [self.split[x][0] if x in self.split else -np.inf for x in range(len(self.feature))]
        return [np.array(x) for x in (self.feature, self.bin, self.left, gain, self.sums)]

    def graft(self, leaf: int, nodes: list) -> None:
        """Put a subtree that grew elsewhere in the place of a leaf."""
        feature, at, left, gain, sums = (x.tolist() for x in nodes)
        first = len(self.feature) - 1     # its root takes the leaf's place, the others follow
        for k in range(1, len(feature)):
            self.feature.append(-1), self.bin.append(0), self.left.append(-1)
            self.level.append(0), self.path.append(0), self.parent.append(-1)
            self.sums.append(tuple(sums[k]))
        if self.sums[leaf] is None:
            self.sums[leaf] = tuple(sums[0])
        for k, (f, b, child, top) in enumerate(zip(feature, at, left, gain)):
            node = first + k if k else leaf
            self.split[node] = (top, f, b, None)
            if f < 0:
                continue
            self.feature[node], self.bin[node], self.left[node] = f, b, first + child
            for side in (0, 1):
                x = first + child + side
                self.level[x], self.path[x] = self.level[node] + 1, 2 * self.path[node] + side
                self.parent[x] = node

    def receive(self, leaves: list, cells: np.ndarray) -> None:
        """The sums of some of the leaves asked for, in order."""
        fresh = []
        for i, leaf in enumerate(leaves):
            self.cells[leaf] = cells[:, i]
            fresh.append(leaf)
            parent, sibling = self.pending.pop(leaf, (None, None))
            if parent is not None:
                self.cells[sibling] = self.cells.pop(parent) - cells[:, i]
                fresh.append(sibling)
        if self.sums[0] is None:
            self.sums[0] = tuple(int(x) for x in self.cells[0][:, :self.ends[0]].sum(axis=1))
        self._best(fresh)
        for leaf in list(self.cells)[KEPT_LEAVES:]:
            del self.cells[leaf]  # both of its children are asked for instead

    def receive_cuts(self, leaves: list, features: list, cuts: list) -> None:
        """The best cuts of some of the leaves asked for, by feature in order."""
        gain = np.stack([c[0] for c in cuts])
        top = gain.argmax(axis=0)
        if self.sums[0] is None:
            self.sums[0] = tuple(int(x) for x in cuts[0][3][:, 0])
        for i, leaf in enumerate(leaves):
            _, at, own, _ = cuts[top[i]]
            self.split[leaf] = (float(gain[top[i], i]), features[top[i]], int(at[i]),
                                tuple(int(x) for x in own[:, i]))

    def _can_split(self, leaf: int) -> bool:
        s, (_, h, n) = self.spec, self.sums[leaf]
        return (not s.max_depth or self.level[leaf] < s.max_depth) and n >= 2 * s.least_rows \
            and h >= 2 * s.least_hessian * UNIT

    def _best(self, leaves: list) -> None:
        cells = np.stack([self.cells[x] for x in leaves], axis=1)
        whole = np.array([self.sums[x] for x in leaves], dtype=float).T
        cum = np.empty_like(cells)
        for a, z in zip([0, *self.ends], self.ends):
            np.cumsum(cells[..., a:z], axis=2, out=cum[..., a:z])
        # a cut behind an empty cell is the cut before it
        leaf, cell = np.nonzero((cells[2] > 0) & self.allowed[self.of_cell])
        own = cum[:, leaf, cell]
        gain = _gain(own, whole[:, leaf], self.spec)
        for x in leaves:
            self.split[x] = (-np.inf, 0, 0, (0, 0, 0))
        if not len(leaf):
            return
        top = np.maximum.reduceat(gain, np.flatnonzero(np.r_[True, leaf[1:] != leaf[:-1]]))
        hit = np.flatnonzero(gain == np.repeat(top, np.bincount(leaf)[np.unique(leaf)]))
        hit = hit[np.r_[True, leaf[hit][1:] != leaf[hit][:-1]]]  # the first of a leaf
        f = self.of_cell[cell[hit]]
        at = cell[hit] - np.array([0, *self.ends])[f]
        for i, *cut, sums in zip(leaf[hit].tolist(), gain[hit].tolist(), f.tolist(), at.tolist(),
                                 own[:, hit].T.astype(np.int64).tolist()):
            self.split[leaves[i]] = (*cut, tuple(sums))

    def _open(self, leaf: int) -> bool:
        return self.split.get(leaf, (0.0,))[0] > LEAST_GAIN and self._can_split(leaf)

    def _expand(self, leaves: list) -> None:
        """Make the children of ``leaves`` and ask for the sums they need."""
        self.asked = []
        for leaf in leaves:
            _, f, b, own = self.split[leaf]
            first = len(self.feature)
            self.feature[leaf], self.bin[leaf], self.left[leaf] = f, b, first
            whole = self.sums[leaf]
            for sums in (own, tuple(w - o for w, o in zip(whole, own))):
                self.feature.append(-1), self.bin.append(0), self.left.append(-1)
                self.level.append(self.level[leaf] + 1)
                self.path.append(2 * self.path[leaf] + len(self.feature) - 1 - first)
                self.parent.append(leaf)
                self.sums.append(sums)
            if not (self._can_split(first) or self._can_split(first + 1)):
                self.cells.pop(leaf, None)
                continue
            if leaf not in self.cells:
                self.asked += [x for x in (first, first + 1) if self._can_split(x)
                               and (self.most is None or self.sums[x][2] > self.most)]
                continue
            small = first + (self.sums[first + 1][2] < self.sums[first][2])
            self.pending[small] = (leaf, 2 * first + 1 - small)
            self.asked.append(small)

    def advance(self) -> None:
        """After all sums asked for: expand what is next, or end."""
        while True:
            want = self._leaf_wise() if self.spec.max_leaves else self._level_wise()
            self.asked = []
            if not want:
                self.done = True
                return
            if self.most is not None:
                many = [x for x in want if self.sums[x][2] > self.most]
                if not many:
                    self.dealt = want
                    return
                want = many
            self._expand(want)
            if self.asked:
                return

    def _unknown(self) -> list:
        """Leaves whose best split is left to the task that gets their rows."""
        return [] if self.most is None else [
            x for x in range(len(self.feature)) if self.feature[x] < 0 and x not in self.split and self._can_split(x)]

    def _level_wise(self) -> list:
        self.taken = [x for x in range(len(self.feature)) if self.feature[x] >= 0]
        return [x for x in range(len(self.feature)) if self.feature[x] < 0 and self._open(x)] + self._unknown()

    def _leaf_wise(self) -> list:
        """Take leaves by gain as far as their children are known; the leaves to
        expand before going on, or none when the tree is complete."""
        if unknown := self._unknown():
            known = sorted((-self.split[x][0], x) for x in range(len(self.feature))
                           if self.feature[x] < 0 and self._open(x))
            return unknown + [x for _, x in known[:self.spec.max_leaves - 1]]
        heap, leaves, self.taken = [], 1, []
        if self._open(0):
            heap.append((-self.split[0][0], self.path[0], 0))
        while heap and leaves < self.spec.max_leaves:
            room = self.spec.max_leaves - leaves
            if self.feature[heap[0][-1]] < 0:
                if room > 1:
                    return [x for *_, x in sorted(h for h in heap if self.feature[h[-1]] < 0)[:room]]
                self._expand([heap[0][-1]])  # the last split: no sums needed
                self.asked = []
            *_, leaf = heapq.heappop(heap)
            self.taken.append(leaf)
            leaves += 1
            for child in (self.left[leaf], self.left[leaf] + 1):
                if self._open(child):
                    heapq.heappush(heap, (-self.split[child][0], self.path[child], child))
        return []

    def leaf_values(self) -> dict:
        """Leaf of the tree -> its value."""
        taken = set(self.taken)
        leaves = [0] if not taken else [c for x in taken for c in (self.left[x], self.left[x] + 1) if c not in taken]
        return {x: self._value(x) for x in leaves}

    def _value(self, node: int) -> float:
        g, h, _ = self.sums[node]
        return -(g / UNIT) / (h / UNIT + self.spec.l2 + 1e-12)

    def tree(self) -> Tree:
        """The splits that were taken, renumbered from the root by level."""
        taken, order = set(self.taken), [0]
        left, feature, at, gain = [], [], [], []
        for node in order:
            inner = node in taken
            left.append(len(order) if inner else -1)
            feature.append(self.feature[node] if inner else -1)
            at.append(self.bin[node] if inner else 0)
            gain.append(self.split[node][0] if inner else 0.0)
            if inner:
                order += [self.left[node], self.left[node] + 1]
        value = [0.0 if x in taken else self._value(x) for x in order]
        return Tree(np.array(feature, np.int32), np.array(at, np.int32), np.array(left, np.int32),
                    np.array(value), np.array(gain), np.array([self.sums[x][2] for x in order]),
                    max((self.level[x] for x in order), default=0))


def _one_round(specs: list, widths: list, turn: int, fetch, deal, most: int) -> dict:
    """One tree of every model that has this round; ``fetch`` gives the growing
    trees what they ask for about a piece of their leaves, model -> leaves, and ``deal``
    the subtrees of the leaves whose rows go to tasks."""
    growing = {m: Growth(s, allowed_features(len(widths), s.feature_share, turn), widths, most=most)
               for m, s in enumerate(specs) if turn < s.rounds}
    room = max(1, PASS_BYTES // (3 * 8 * sum(widths)))
    open_ = dict(growing)
    while open_:
        # leaves beyond the room of a pass wait for the next
        flat = [(m, leaf) for m, g in open_.items() for leaf in g.asked]
        on = {m for m, _ in flat} or set(open_)
        for lo in range(0, len(flat), room):
            piece: dict = {}
            for m, leaf in flat[lo:lo + room]:
                piece.setdefault(m, []).append(leaf)
            fetch(open_, piece)
        if not flat:  # no tree has upper leaves left
            deal(open_)
        for m in on:
            open_[m].dealt = []
            open_[m].advance()
            if open_[m].done:
                del open_[m]
    return {m: g.tree() for m, g in growing.items()}


def allowed_features(n: int, share: float, turn: int) -> np.ndarray:
    """The features of a tree: the round(share * n) of least hash, at least one."""
    if share >= 1:
        return np.ones(n, dtype=bool)
    order = np.argsort(_mixed(np.arange(n, dtype=np.uint64), 1_000_003 + turn), kind="stable")
    out = np.zeros(n, dtype=bool)
    out[order[:max(1, round(share * n))]] = True
    return out


# ------------------------------------------------------------------ the model
@dataclass
class Boosted:
    """A fitted ensemble over ``features`` cut at ``edges``."""
    spec: Spec
    features: list
    edges: list
    base: float
    trees: list = field(default_factory=list)

    def shortened(self, rounds: int) -> Boosted:
        """The ensemble as a fit of fewer rounds gives it."""
        return Boosted(replace(self.spec, rounds=rounds), self.features, self.edges, self.base,
                       self.trees[:rounds])

    def margins(self, columns: list) -> np.ndarray:
        bins = _binned(columns, self.edges)
        out = np.full(bins.shape[1], self.base)
        for t in self.trees:
            out += self.spec.rate * t.value[_leaf_of(bins, t.feature, t.bin, t.left, t.depth)]
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        """The rows with ``probability`` and ``prediction`` (vector columns left out)."""
        share_package(df.sparkSession)
        plain = df.select(*[F.col(f"`{f.name}`") for f in df.schema.fields
                            if not isinstance(f.dataType, VectorUDT)
                            and f.name not in ("probability", "prediction")])
        names = plain.columns
        wide = plain.select("*", *[F.col(f"`{c}`").cast("double").alias(f"_x{i}")
                                   for i, c in enumerate(self.features)])
        # the ensemble is model state of fixed size, sent to each executor once
        shared = df.sparkSession.sparkContext.broadcast(self)

        def run(batches):
            model = shared.value
            for b in batches:
                m = model.margins([b.column(len(names) + i).to_numpy(zero_copy_only=False)
                                   for i in range(len(model.features))])
                yield pa.RecordBatch.from_arrays(
                    [*b.columns[:len(names)], pa.array(1.0 / (1.0 + np.exp(-m))),
                     pa.array((m > 0).astype(float))], names=[*names, "probability", "prediction"])
        schema = plain.schema.add("probability", "double").add("prediction", "double")
        return wide.mapInArrow(run, schema)

    # ------------------------------------------------------------ node table
    def node_table(self, spark: SparkSession) -> DataFrame:
        """One row per node: tree, node, feature (null: leaf), bin, threshold
        (rows at or below go left), left child, value, gain, rows."""
        rows = []
        for i, t in enumerate(self.trees):
            for k in range(len(t.feature)):
                f, b = int(t.feature[k]), int(t.bin[k])
                rows.append((i, k, self.features[f] if f >= 0 else None, b if f >= 0 else None,
                             float(self.edges[f][b]) if f >= 0 else None,
                             int(t.left[k]) if f >= 0 else None, float(t.value[k]),
                             float(t.gain[k]), int(t.rows[k])))
        return spark.createDataFrame(rows, NODE_SCHEMA)

    def save(self, spark: SparkSession, path: str) -> None:
        self.node_table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        facts = json.dumps({"spec": asdict(self.spec), "features": self.features, "base": self.base,
                            "edges": [[float(x) for x in e] for e in self.edges]})
        spark.createDataFrame([(facts,)], "facts string").coalesce(1) \
            .write.mode("overwrite").parquet(f"{path}/facts")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Boosted:
        facts = json.loads(spark.read.parquet(f"{path}/facts").first()["facts"])
        spec = Spec(**{**facts["spec"], "weights": tuple(facts["spec"]["weights"])})
        names, trees = facts["features"], []
        rows = spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").collect()
        by_tree: dict = {}
        for r in rows:
            by_tree.setdefault(r["tree"], []).append(r)
        for i in sorted(by_tree):
            part = by_tree[i]
            feature = np.array([-1 if r["feature"] is None else names.index(r["feature"])
                                for r in part], np.int32)
            left = np.array([-1 if r["left"] is None else r["left"] for r in part], np.int32)
            level = [0] * len(part)
            for k, child in enumerate(left.tolist()):
                if child >= 0:
                    level[child] = level[child + 1] = level[k] + 1
            trees.append(Tree(feature, np.array([r["bin"] or 0 for r in part], np.int32), left,
                              np.array([r["value"] for r in part]), np.array([r["gain"] for r in part]),
                              np.array([r["rows"] for r in part]), max(level)))
        return cls(spec, names, [np.array(e) for e in facts["edges"]], facts["base"], trees)


NODE_SCHEMA = ("tree int, node int, feature string, bin int, threshold double, left int, "
               "value double, gain double, rows bigint")


def importances(nodes: DataFrame, features: list) -> DataFrame:
    """Per feature, from a node table: splits, total and mean gain per split, and
    the mean gains scaled to a sum of 1 (``Importance``)."""
    spark = nodes.sparkSession
    own = nodes.filter("feature is not null").groupBy(F.col("feature").alias("Feature")).agg(
        F.count(F.lit(1)).alias("splits"), F.sum("gain").alias("total_gain"),
        F.avg("gain").alias("mean_gain"))
    names = spark.createDataFrame([(f,) for f in features], "Feature string")
    every = names.join(own, "Feature", "left").na.fill(0, ["splits", "total_gain", "mean_gain"])
    total = every.agg(F.sum("mean_gain")).first()[0] or 1.0
    return every.select("Feature", (F.col("mean_gain") / F.lit(total)).alias("Importance"),
                        "splits", "mean_gain", "total_gain").orderBy(F.desc("Importance"), "Feature")


# ------------------------------------------------------------------ training
def bin_edges(train: DataFrame, features: list, max_bins: int = MAX_BINS) -> list:
    """Cut points of each feature: its quantiles, from one aggregate of bounded
    size (exact while a feature's sample holds all rows)."""
    probs = [i / max_bins for i in range(1, max_bins)]
    row = train.agg(*[F.percentile_approx(F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)), probs,
                                          20 * max_bins).alias(f"e{i}")
                      for i, c in enumerate(features)]).first()
    return [np.unique(np.array(row[i] or [], dtype=float)) for i in range(len(features))]


def _binned(columns: list, edges: list) -> np.ndarray:
    """(feature, row) bins; missing values in the last."""
    return np.stack([np.searchsorted(e, np.where(np.isnan(c), np.inf, c), side="left")
                     for c, e in zip(columns, edges)]).astype(np.uint8 if all(
                         len(e) < 256 for e in edges) else np.int32)


def _blocks(train: DataFrame, features: list, edges: list, label: str, keys: list, parts: int,
            start: np.ndarray):
    """RDD of blocks: bins, labels, folds, row hashes, margins."""
    fold = F.col("fold") if "fold" in train.columns else F.lit(-1)
    rows = train.select(F.col(f"`{label}`").cast("double").alias("y"), fold.cast("int").alias("fold"),
                        F.xxhash64(*[F.col(f"`{k}`") for k in keys]).alias("row"),
                        *[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(features)])
    rows = rows.repartition(parts, "row")

    def pack(batches):
        def block(held):
            t = pa.Table.from_batches(held)
            columns = [t.column(i).to_numpy() for i in range(t.num_columns)]
            return pa.RecordBatch.from_arrays([pa.array([pickle.dumps({
                "y": columns[0].astype(np.int8), "fold": columns[1].astype(np.int8),
                "row": columns[2].astype(np.int64).view(np.uint64),
                "bins": _binned([c.astype(float) for c in columns[3:]], edges)})], pa.binary())],
                names=["block"])
        held, n = [], 0
        for b in batches:
            held.append(b)
            n += b.num_rows
            if n >= BLOCK_ROWS:
                yield block(held)
                held, n = [], 0
        if n:
            yield block(held)

    def unpack(r):
        block = pickle.loads(r["block"])
        return {**block, "margin": np.repeat(start[:, None], len(block["y"]), axis=1)}
    return rows.mapInArrow(pack, "block binary").rdd.map(unpack)


def met(blocks, emit, parts: int, finish) -> list:
    """What ``finish(part, pairs)`` makes of the pairs with a whole number that ``emit``
    makes of each partition's blocks; those of a number meet in one task."""
    return blocks.mapPartitions(emit).partitionBy(parts, lambda key: key) \
        .mapPartitionsWithIndex(finish).collect()


def summed(blocks, pairs) -> list:
    """The sum per key of the pairs of all blocks; few keys."""
    return blocks.flatMap(pairs).reduceByKey(lambda a, b: a + b, 1).collect()


def fit_many(train: DataFrame, features: list, specs: list, label: str, keys: list,
             edges: list | None = None, scored: dict | None = None, on_scores=None,
             task_rows: int | None = None) -> list:
    """Fit all ``specs`` on ``train`` (its ``fold`` column is read where a spec
    names a fold).  ``scored``: model -> rounds after which its held-out fold is
    scored; ``on_scores(round, {model: (tn, fp, fn, tp)})`` gets the counts.
    ``task_rows``: rows x models up to which one task makes the fit."""
    spark = train.sparkSession
    share_package(spark)
    ensure_checkpoint_dir(spark)
    scored = scored or {}
    edges = edges if edges is not None else bin_edges(train, features)
    widths = [len(e) + 1 for e in edges]
    fold = F.col("fold") if "fold" in train.columns else F.lit(None)
    seen = train.groupBy(fold.alias("fold"), F.col(f"`{label}`").cast("int").alias("y")).count().collect()
    base = []
    for s in specs:
        mass = [sum(r["count"] for r in seen if r["y"] == c and (s.fold is None or r["fold"] != s.fold))
                * s.weights[c] for c in (0, 1)]
        base.append(math.log(mass[1] / mass[0]) if min(mass) > 0 else 0.0)
    n, cores = sum(r["count"] for r in seen), spark.sparkContext.defaultParallelism
    work, parts = n * len(specs), 1
    if work > (task_rows or TASK_ROWS):  # every core has a part
        size = n * (len(features) + 10 + 8 * len(specs))
        parts = max(1, min(max(cores, math.ceil(size / PART_BYTES)), math.ceil(n / LEAST_ROWS)))
    models = [Boosted(s, list(features), edges, b) for s, b in zip(specs, base)]
    if not n:
        return models
    # what no model reads does not go through the passes
    unread = {"fold"} if all(s.fold is None for s in specs) else set()
    unread |= {"row"} if all(s.row_share >= 1 for s in specs) else set()
    state = _blocks(train, features, edges, label, keys, parts, np.array(base)) \
        .map(lambda b: {k: x for k, x in b.items() if k not in unread}).persist(StorageLevel.MEMORY_AND_DISK)
    state.checkpoint()
    held, written = [state], [state]
    most = min(MOST_ROWS, max(TASK_ROWS // 10, work // cores))

    def total(rdd, fn):
        """Sum of ``fn`` over the blocks; partitions are added up on Spark."""
        def part(blocks):
            out = None
            for b in blocks:
                x = fn(b)
                out = x if out is None else _added(out, x)
            return [] if out is None else [out]
        sums = rdd.mapPartitions(part)
        return sums.collect()[0] if parts == 1 else sums.treeReduce(_added, 2 + (parts > 64))

    def best_cuts(rdd, open_, piece, turn):
        """Give the trees the best cuts of some of their leaves: the sums of a
        (model, feature) meet in one task, which sends a row per leaf."""
        asked = {m: (*open_[m].request(), leaves) for m, leaves in piece.items()}
        allowed = {m: np.flatnonzero(open_[m].allowed).tolist() for m in piece}
        width, ends = len(features), np.cumsum(widths).tolist()

        def part(blocks):
            out: dict = {}
            for b in blocks:
                for m, x in _block_sums(b, asked, specs, widths, turn):
                    out[m] = out[m] + x if m in out else x
            for m, x in out.items():
                for f in allowed[m]:
                    yield m * width + f, x[:, :, ends[f] - widths[f]:ends[f]]

        def chosen(pairs):
            sums: dict = {}
            for key, x in pairs:
                sums[key] = sums[key] + x if key in sums else x
            return [(key, _best_cuts(x, specs[key // width])) for key, x in sums.items()]
        keys = sum(len(x) for x in allowed.values())
        found = dict(rdd.mapPartitions(part).partitionBy(min(parts, keys), lambda key: key)
                     .mapPartitions(chosen).collect())
        for m, leaves in piece.items():
            open_[m].receive_cuts(leaves, allowed[m], [found[m * width + f] for f in allowed[m]])

    def deal(rdd, open_, turn):
        """Give the trees what is below their leaves of few rows: the rows of a leaf meet
        in one task, which grows its subtree."""
        todo = sorted(((g.sums[x][2], m, x) for m, g in open_.items() for x in g.dealt), reverse=True)
        while todo:
            batch, rows = [], 0
            while todo and (not batch or rows + todo[0][0] <= BATCH_ROWS):
                batch.append(todo.pop(0))
                rows += batch[-1][0]
            load = [(0, i) for i in range(min(len(batch), max(cores, math.ceil(rows / most))))]
            places: dict = {}
            for size, m, leaf in batch:  # the largest first, to the task of least rows
                have, i = heapq.heappop(load)
                heapq.heappush(load, (have + size, i))
                places.setdefault(m, []).append((i, leaf))
            waiting, roots = {}, {}
            for m, x in places.items():
                x.sort()
                waiting[m] = open_[m].request(), [leaf for _, leaf in x], np.array([i for i, _ in x])
                roots.update({(m, leaf): (open_[m].level[leaf], open_[m].path[leaf]) for _, leaf in x})
            for m, leaf, nodes in met(
                    rdd, lambda blocks, w=waiting: (x for b in blocks for x in _dealt(b, w, specs, turn)), len(load),
                    lambda _, pairs, r=roots: _subtrees([x for _, x in pairs], r, specs, widths, turn)):
                open_[m].graft(leaf, nodes)

    last = max((s.rounds for s in specs), default=0)
    every = PLACE_EVERY if parts == 1 else CHECKPOINT_EVERY
    stops = sorted({last, *range(0, last, every), *(r for x in scored.values() for r in x)})
    for turn, stop in zip(stops, stops[1:]):
        if parts == 1:
            state = state.mapPartitions(
                lambda blocks, a=turn, z=stop: _rounds_in_place(list(blocks), specs, widths, a, z)) \
                .persist(StorageLevel.MEMORY_AND_DISK)
            state.checkpoint()
            written.append(state)
            grown = state.map(lambda b: b.get("grown")).collect()[0]
        else:
            grown = []
            for t in range(turn, stop):
                trees = _one_round(specs, widths, t, lambda open_, piece, s=state, t=t: best_cuts(s, open_, piece, t),
                                   lambda open_, s=state, t=t: deal(s, open_, t), most)
                grown.append(trees)
                _forget(spark, written)
                state = state.map(lambda b, x=trees: _moved(b, x, specs)).persist(StorageLevel.MEMORY_AND_DISK)
                if t + 1 == stop:
                    state.checkpoint()
                    written.append(state)
                while len(held) > 1:  # the state before has been read for the last time
                    held.pop(0).unpersist()
                held.append(state)
            spark.sparkContext._jvm.System.gc()  # lets Spark delete the files of dealt rows
        for trees in grown:
            for m, t in trees.items():
                models[m].trees.append(t)
        due = [m for m, rounds in scored.items() if stop in rounds]
        if due:
            counts = total(state, lambda b, d=due: {m: _outcomes(b, m, specs[m].fold) for m in d})
            on_scores(stop, {m: tuple(int(x) for x in counts[m]) for m in due})
        if parts == 1:
            held.pop().unpersist()
            held.append(state)
            _forget(spark, written)
    for s in held:
        s.unpersist()
    _forget(spark, written, 0)
    return models


def _forget(spark: SparkSession, written: list, keep: int = 1) -> None:
    """Delete the checkpoints of states before the last one that is written; ``keep=0``:
    of all."""
    while len(written) > keep and (not keep or written[1].isCheckpointed()):
        state = written.pop(0)
        if path := state.getCheckpointFile():
            fs, jpath = file_system(spark, path)
            fs.delete(jpath, True)


def _outcomes(block: dict, m: int, fold: int | None) -> np.ndarray:
    rows = block["fold"] == fold if fold is not None else np.ones(len(block["y"]), dtype=bool)
    y, p = block["y"][rows] > 0, block["margin"][m, rows] > 0
    return np.array([(~y & ~p).sum(), (~y & p).sum(), (y & ~p).sum(), (y & p).sum()])


def fit(train: DataFrame, features: list, spec: Spec, label: str, keys: list) -> Boosted:
    return fit_many(train, features, [spec], label, keys)[0]
