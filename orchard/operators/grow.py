"""Forest fitting by level histograms.

``ForestRegressor`` and ``ForestClassifier`` are pyspark.ml's random forests
with another fit and pyspark.ml's own models as result.  The rules are MLlib's:
candidate thresholds from a sample of max(10,000, bins²) rows, Poisson bootstrap
weights, features drawn per node, best gain over the candidates, leaves that
predict alike merged.  What MLlib does row by row, numpy does on blocks of
binned rows, one byte a value:

* ``_blocks`` bins the rows once and draws their weights; a tree keeps the rows
  it drew, each with the node (slot of the level) it has come to.
* A level is one pass: ``_sums`` adds up weights and labels by slot, feature and
  bin for a partition, and ``_best`` picks the splits of a stretch of slots from
  all partitions' sums.  Rows move to the children on the way; every few levels
  ``_advance`` stores where they are.
* Once the rows cost less to ship than the sums of the levels to come and no
  node is too large for one task, ``_spread`` deals the nodes out with their
  rows and ``_grow_group`` finishes them without further passes.

Labels are handled as numbers (less their mean): for the classes 0 and 1 the
Gini gain is twice the gain of variance.  What this does not cover (weights,
entropy, other classes, categorical features) is fitted by MLlib.
"""

from __future__ import annotations

import ctypes
import json
import math
import sys
import time
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orchard.session import fresh_path

# Functions of this module run in Python workers; see ``forest``.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_ROWS = 1 << 16
BLOCK_BYTES = 16 << 20
SUMS_BYTES = 256 << 20  # one task's sums; more trees than fit are done in turns
SLOTS_TOGETHER = 64  # slots whose sums travel and are compared together
ROWS_AT_HAND = 1_000_000  # largest node that one task finishes
GROUP_ROWS = 250_000  # rows that nodes are grouped up to
SLOTS_AT_HAND = 1 << 13  # slots summed at once while a task finishes its nodes
# What a byte of a dealt row and a pass of its own take, in bytes of sums.
DEALING, A_PASS = 3, 32 << 20
# Moving rows down a level again takes less than storing where they are and
# reading that back, for a few levels.
LEVELS_BETWEEN_STATES = 3
# Gains below this share of the labels' mean square are rounding.
ROUNDING = 1e-14

STATE = "place bigint, fixed binary, moving binary"


@dataclass(frozen=True)
class Rules:
    """What the workers need to know of a fit."""

    seed: int
    trees: int
    depth: int
    tried: int  # features per node
    thresholds: list[np.ndarray]
    rate: float | None  # mean of the Poisson weights; None: every row once
    centre: float
    min_rows: int

    @property
    def width(self) -> int:
        return 1 + max(len(t) for t in self.thresholds)


@dataclass(frozen=True)
class Splits:
    """Per tree and slot of a level: feature, last bin that goes left, and the
    number among the tree's slots that are split (-1: a leaf)."""

    feature: list[np.ndarray]
    last: list[np.ndarray]
    nth: list[np.ndarray]


def keep_pages() -> None:
    """Let malloc reuse its pages: numpy's temporaries of a few hundred KB would
    each be mapped and unmapped, which takes as long as the sums themselves."""
    try:
        libc = ctypes.CDLL(None)
        libc.mallopt(-3, 1 << 28)  # M_MMAP_THRESHOLD
        libc.mallopt(-1, 1 << 29)  # M_TRIM_THRESHOLD
    except (OSError, AttributeError):  # another libc
        pass


# --------------------------------------------------------------------------
# blocks of binned rows
# --------------------------------------------------------------------------


def candidate_thresholds(values: np.ndarray, bins: int) -> np.ndarray:
    """MLlib's candidates: midpoints between all distinct values, or, of more
    than ``bins``, the midpoints nearest to equal shares of the rows."""
    found, counts = np.unique(values[~np.isnan(values)], return_counts=True)
    middles = (found[:-1] + found[1:]) / 2
    if len(middles) < bins:
        return middles
    stride = counts.sum() / bins
    before = np.cumsum(counts)
    taken, target = [], stride
    for i in range(1, len(found)):
        if abs(before[i - 1] - target) < abs(before[i] - target):
            taken.append(middles[i - 1])
            target += stride
    return np.array(taken)


def _pack(n: int, by_tree: list[tuple]) -> bytes:
    """Weights of all rows, 0 for those a tree has done with, and the slots of
    the others, in as few bytes as they take."""
    top = max((int(s.max()) for _, s, _ in by_tree if len(s)), default=0)
    kind = next(k for k in (np.uint8, np.uint16, np.uint32) if top <= np.iinfo(k).max)
    weights = np.zeros((len(by_tree), n), np.uint8)
    for to, (rows, _, weight) in zip(weights, by_tree):
        to[rows] = weight
    slots = [s.astype(kind) for _, s, _ in by_tree] if top else []
    return b"".join(a.tobytes() for a in (np.array([np.dtype(kind).itemsize if top else 0], np.int64), weights, *slots))


def _unpack(n: int, trees: int, moving: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Row numbers, slots and weights, tree by tree."""
    size, at = np.frombuffer(moving, np.int64, 1)[0], 8 + n * trees
    for t in range(trees):
        dense = np.frombuffer(moving, np.uint8, n, 8 + n * t)
        rows = np.flatnonzero(dense != 0)
        slots = np.frombuffer(moving, f"u{size}", len(rows), at) if size else np.zeros(len(rows), np.intp)
        at += int(size) * len(rows)
        yield rows, slots, dense[rows]


def _fixed(block: bytes, features: int) -> tuple[np.ndarray, np.ndarray]:
    """Bins (feature by row, one run of bytes) and labels of a block."""
    n = len(block) // (features + 8)
    return np.frombuffer(block, np.uint8, features * n, 8 * n), np.frombuffer(block, np.float64, n)


def _blocks(rules: Rules):
    features = len(rules.thresholds)
    most = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (features + 8 + 3 * rules.trees)))

    def block(x: np.ndarray, y: np.ndarray, place: int) -> pa.RecordBatch:
        bins = np.stack([np.searchsorted(t, x[:, i], side="left").astype(np.uint8) for i, t in enumerate(rules.thresholds)])
        if rules.rate is None:
            weights = np.ones((rules.trees, len(y)), np.uint8)
        else:
            draws = (np.random.default_rng([rules.seed % (1 << 64), place, t]).poisson(rules.rate, len(y)) for t in range(rules.trees))
            weights = np.stack([np.minimum(d, 255).astype(np.uint8) for d in draws])
        moving = np.int64(0).tobytes() + weights.tobytes()  # all at slot 0
        return pa.RecordBatch.from_pydict({"place": pa.array([place], pa.int64()), "fixed": pa.array([(y - rules.centre).tobytes() + bins.tobytes()], pa.binary()), "moving": pa.array([moving], pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_pages()
        place, held, n = TaskContext.get().partitionId() << 24, [], 0
        for b in batches:
            y = b.column(1).to_numpy(zero_copy_only=False)
            held.append((b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(len(y), features), y))
            n += len(y)
            while n >= most:
                x, y = (np.concatenate(a) for a in zip(*held))
                yield block(x[:most], y[:most], place)
                place, held, n = place + 1, [(x[most:], y[most:])], n - most
        if n:
            yield block(*(np.concatenate(a) for a in zip(*held)), place)

    return run


# --------------------------------------------------------------------------
# sums, splits, moves: the same for blocks and for groups of nodes
# --------------------------------------------------------------------------


def mixed(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def drawn_features(rules: Rules, tree, path: np.ndarray) -> np.ndarray:
    """``tried`` features for each node, drawn by tree and path from the root
    (1; the children of i are 2i and 2i + 1): a node draws the same whatever
    other trees and levels there are, and wherever it is grown."""
    features = len(rules.thresholds)
    if rules.tried >= features:
        return np.tile(np.arange(features, dtype=np.uint8), (len(path), 1))
    step = np.uint64(0x9E3779B97F4A7C15)
    start = mixed(np.uint64(rules.seed % (1 << 64)) + step * np.atleast_1d(tree).astype(np.uint64) + step)
    lots = mixed(mixed(start + step * path.astype(np.uint64))[:, None] + step * np.arange(1, features + 1, dtype=np.uint64))
    return np.sort(np.argsort(lots, axis=1)[:, : rules.tried], axis=1).astype(np.uint8)


def children_of(path: np.ndarray, split: np.ndarray) -> np.ndarray:
    """Paths of the children of the split nodes, the left one first."""
    return np.repeat(2 * path[split], 2) + np.tile([0, 1], int(split.sum()))


def add_up(bins: np.ndarray, y: np.ndarray, rows: np.ndarray, slot: np.ndarray, weight: np.ndarray, tried: np.ndarray | None, slots: int, width: int):
    """(slots, 3) sums of weight, label and squared label; with ``tried``
    features also (slots, features, bins, 2) sums of weight and label."""
    r, s = rows.astype(np.intp, copy=False), slot.astype(np.intp, copy=False)
    w, label = weight.astype(np.float64), y.take(r, mode="clip")
    wy = w * label
    squares = np.bincount(s, wy * label, slots)
    if tried is None:
        return np.column_stack([np.bincount(s, w, slots), np.bincount(s, wy, slots), squares]), None
    first = s * width
    out = np.empty((slots, tried.shape[1], width, 2))
    for j in range(tried.shape[1]):
        at = (tried[:, j].astype(np.intp) * len(y)).take(s, mode="clip")
        at += r
        key = bins.take(at, mode="clip") + first
        for i, v in enumerate((w, wy)):
            out[:, j, :, i] = np.bincount(key, v, slots * width).reshape(slots, width)
    return np.column_stack([out[:, 0].sum(axis=1), squares]), out


def best_splits(rules: Rules, nodes: np.ndarray, sums: np.ndarray, tried: np.ndarray) -> np.ndarray:
    """One row per slot: weight, label, squared label, feature (-1: none is
    worth a split), last bin to the left, gain, weight to the left."""
    left = np.cumsum(sums, axis=2)[:, :, :-1]
    wl, sl = left[..., 0], left[..., 1]
    w, s, q = (nodes[:, i, None, None] for i in range(3))
    bins = np.array([len(t) for t in rules.thresholds])
    fits = (wl >= rules.min_rows) & (w - wl >= rules.min_rows) & (wl > 0) & (w - wl > 0) & (np.arange(left.shape[2]) < bins[tried][:, :, None])
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(fits, (sl * sl / wl + (s - sl) ** 2 / (w - wl) - s * s / w) / w, -np.inf)
    flat = gain.reshape(len(nodes), -1)
    if not flat.shape[1]:  # every feature has one value
        return np.column_stack([nodes, np.full(len(nodes), -1.0), np.zeros((len(nodes), 3))])
    top = flat.argmax(axis=1)
    each = np.arange(len(nodes))
    value = flat[each, top]
    with np.errstate(divide="ignore", invalid="ignore"):
        good = value > ROUNDING * nodes[:, 2] / nodes[:, 0]
    j, last = np.divmod(top, left.shape[2])
    return np.column_stack([nodes, np.where(good, tried[each, j].astype(np.float64), -1.0), last, np.where(good, value, -1.0), wl.reshape(len(nodes), -1)[each, top]])


def moved(bins: np.ndarray, n: int, rows: np.ndarray, slot: np.ndarray, weight: np.ndarray, feature: np.ndarray, last: np.ndarray, nth: np.ndarray):
    """The rows of split slots with the slots of the next level: two for each
    split, the left one first."""
    s = slot.astype(np.intp, copy=False)
    if (nth < 0).any():
        on = nth.take(s, mode="clip") >= 0
        rows, s, weight = rows[on], s[on], weight[on]
    at = (feature.astype(np.intp) * n).take(s, mode="clip")
    at += rows
    right = bins.take(at, mode="clip") > last.take(s, mode="clip")
    s = (2 * nth).take(s, mode="clip")
    s += right
    return rows, s, weight


def moved_on(bins: np.ndarray, n: int, tree: int, at: tuple, steps: list[Splits]) -> tuple:
    """Rows of a tree after the splits of several levels."""
    for splits in steps:
        at = moved(bins, n, *at, splits.feature[tree], splits.last[tree], splits.nth[tree])
    return at


def _advance(rules: Rules, steps: list[Splits]):
    features = len(rules.thresholds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_pages()
        for b in batches:
            for place, block, moving in zip(*(c.to_pylist() for c in b.columns)):
                bins, y = _fixed(block, features)
                new = [moved_on(bins, len(y), t, at, steps) for t, at in enumerate(_unpack(len(y), rules.trees, moving))]
                yield pa.RecordBatch.from_pydict({"place": pa.array([place], pa.int64()), "fixed": pa.array([block], pa.binary()), "moving": pa.array([_pack(len(y), new)], pa.binary())})

    return run


def _sums(rules: Rules, steps: list[Splits], slots: list[int], trees: list[int], tried: list[np.ndarray] | None):
    """Sums of a partition's rows for some trees, in stretches of slots, after
    the splits of ``steps``."""
    features = len(rules.thresholds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_pages()
        total, part = {}, TaskContext.get().partitionId()
        for b in batches:
            for block, moving in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                bins, y = _fixed(block, features)
                for t, at in enumerate(_unpack(len(y), rules.trees, moving)):
                    if t not in trees:
                        continue
                    found = add_up(bins, y, *moved_on(bins, len(y), t, at, steps), tried[t] if tried else None, slots[t], rules.width)
                    if t not in total:
                        total[t] = found
                    else:
                        for a, x in zip(total[t], found):
                            if a is not None:
                                a += x
        for t, (nodes, sums) in total.items():
            firsts = range(0, slots[t], SLOTS_TOGETHER)
            cut = [slice(i, i + SLOTS_TOGETHER) for i in firsts]
            yield pa.RecordBatch.from_pydict({
                "tree": pa.array([t] * len(cut), pa.int32()), "first": pa.array(list(firsts), pa.int32()), "part": pa.array([part] * len(cut), pa.int32()),
                "nodes": pa.array([nodes[c].tobytes() for c in cut], pa.binary()), "sums": pa.array([sums[c].tobytes() if sums is not None else b"" for c in cut], pa.binary())})

    return run


def _best(rules: Rules, tried: list[np.ndarray] | None):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        keep_pages()
        tree, first = (k.as_py() for k in key)
        table = table.sort_by("part")  # sums do not depend on the order of arrival
        nodes = sum(np.frombuffer(c.as_py(), np.float64).reshape(-1, 3) for c in table["nodes"])
        if tried is None:
            found = np.column_stack([nodes, np.full(len(nodes), -1.0), np.zeros((len(nodes), 3))])
        else:
            mine = tried[tree][first : first + len(nodes)]
            sums = sum(np.frombuffer(c.as_py(), np.float64) for c in table["sums"]).reshape(len(nodes), mine.shape[1], rules.width, 2)
            found = best_splits(rules, nodes, sums, mine)
        return pa.table({"tree": pa.array([tree], pa.int32()), "first": pa.array([first], pa.int32()), "found": pa.array([found.tobytes()], pa.binary())})

    return run


# --------------------------------------------------------------------------
# nodes that a task finishes
# --------------------------------------------------------------------------


def _spread(rules: Rules, steps: list[Splits], group: list[np.ndarray], number: list[np.ndarray]):
    """The rows of all trees, dealt by the group of the slot they move to;
    ``number`` is the slot's number in its group."""
    # Groups as numbers within a tree: sorts of two bytes take no comparisons.
    base = [int(g[0]) if len(g) else 0 for g in group]
    group = [(g - b).astype(np.uint16 if len(g) and g[-1] - b < 1 << 16 else np.int64) for g, b in zip(group, base)]
    number = [i.astype(np.uint32) for i in number]
    features = len(rules.thresholds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_pages()
        for b in batches:
            for place, block, moving in zip(*(c.to_pylist() for c in b.columns)):
                bins, y = _fixed(block, features)
                by_row = np.ascontiguousarray(bins.reshape(features, -1).T).view(f"V{features}").ravel()
                for t, at in enumerate(_unpack(len(y), rules.trees, moving)):
                    rows, slot, weight = moved_on(bins, len(y), t, at, steps)
                    if not len(rows):
                        continue
                    s = slot.astype(np.intp)
                    to = group[t].take(s, mode="clip")
                    if len(group[t]) > 1 and group[t][-1]:
                        order = np.argsort(to, kind="stable")
                        rows, s, weight, to = rows[order], s[order], weight[order], to[order]
                    starts = np.flatnonzero(np.r_[True, to[1:] != to[:-1]])
                    ends = np.r_[starts[1:], len(to)]
                    label, mine, row = y[rows], number[t].take(s, mode="clip"), by_row[rows]
                    sent = [(base[t] + int(to[a]), b"".join(v[a:z].tobytes() for v in (label, mine, weight, row))) for a, z in zip(starts, ends)]
                    yield pa.RecordBatch.from_pydict({
                        "grp": pa.array([g for g, _ in sent], pa.int32()), "tree": pa.array([t] * len(sent), pa.int32()),
                        "place": pa.array([place] * len(sent), pa.int64()), "sent": pa.array([p for _, p in sent], pa.binary())})

    return run


def grow_here(rules: Rules, level: int, tree: np.ndarray, path: np.ndarray, bins: np.ndarray, y: np.ndarray, slot: np.ndarray, weight: np.ndarray):
    """All nodes below those of ``level`` whose rows are at hand, as one array a
    level: what ``best_splits`` gives for each node."""
    n, rows, levels = len(y), np.arange(len(y), dtype=np.int64), []
    while slots := len(path):
        ends = [0, len(slot)]
        if slots > SLOTS_AT_HAND:
            turn = (slot // SLOTS_AT_HAND).astype(np.uint16)
            order = np.argsort(turn, kind="stable")
            rows, slot, weight = rows[order], slot[order], weight[order]
            ends = np.searchsorted(turn[order], np.arange(-(-slots // SLOTS_AT_HAND) + 1))
        tried = drawn_features(rules, tree, path) if level < rules.depth else None
        found = []
        for i, first in enumerate(range(0, slots, SLOTS_AT_HAND)):
            many, a, z = min(SLOTS_AT_HAND, slots - first), ends[i], ends[i + 1]
            mine = None if tried is None else tried[first : first + many]
            nodes, sums = add_up(bins, y, rows[a:z], slot[a:z] - first, weight[a:z], mine, many, rules.width)
            found.append(np.column_stack([nodes, np.full(many, -1.0), np.zeros((many, 3))]) if mine is None else best_splits(rules, nodes, sums, mine))
        found = np.concatenate(found)
        levels.append(found)
        split = found[:, 3] >= 0
        nth = np.where(split, np.cumsum(split) - 1, -1)
        rows, slot, weight = moved(bins, n, rows, slot, weight, np.maximum(found[:, 3], 0).astype(np.intp), found[:, 4], nth)
        tree, path, level = np.repeat(tree[split], 2), children_of(path, split), level + 1
    return levels


def _grow_group(rules: Rules, level: int, starts: np.ndarray, tree: np.ndarray, path: np.ndarray):
    features = len(rules.thresholds)

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        keep_pages()
        group = key[0].as_py()
        parts = []
        for c in table.sort_by([("place", "ascending"), ("tree", "ascending")])["sent"]:
            raw = c.as_py()
            k = len(raw) // (13 + features)
            parts.append((np.frombuffer(raw, np.float64, k), np.frombuffer(raw, np.uint32, k, 8 * k), np.frombuffer(raw, np.uint8, k, 12 * k), np.frombuffer(raw, np.uint8, k * features, 13 * k).reshape(k, features).T))
        y, slot, weight = (np.concatenate([p[i] for p in parts]) for i in range(3))
        bins = np.concatenate([p[3] for p in parts], axis=1).ravel()
        mine = slice(starts[group], starts[group + 1])
        levels = grow_here(rules, level, tree[mine], path[mine], bins, y, slot.astype(np.intp), weight)
        return pa.table({"grp": pa.array([group] * len(levels), pa.int32()), "depth": pa.array(range(level, level + len(levels)), pa.int32()), "found": pa.array([f.tobytes() for f in levels], pa.binary())})

    return run


# --------------------------------------------------------------------------
# the driver's side: levels, nodes, the model
# --------------------------------------------------------------------------


class Nodes:
    """A forest's nodes in the order they were found, parents before children:
    arrays of tree, depth, left child (the right one follows) and the rows of
    ``best_splits``."""

    def __init__(self):
        self.size, self.tree, self.depth, self.left, self.found = 0, [], [], [], []

    def add(self, tree: np.ndarray, depth: int, found: np.ndarray) -> np.ndarray:
        """Appends a level; its children, in order, are the next ones added
        unless ``join`` says where they are."""
        split = found[:, 3] >= 0
        left = np.full(len(found), -1, np.int64)
        left[split] = self.size + len(found) + 2 * np.arange(split.sum())
        self.tree.append(tree.astype(np.int32))
        self.depth.append(np.full(len(found), depth, np.int32))
        self.left.append(left)
        self.found.append(found)
        self.size += len(found)
        return np.repeat(tree[split], 2)

    def arrays(self):
        return tuple(np.concatenate(a) for a in (self.tree, self.depth, self.left, self.found))


def _grow(blocks: DataFrame, rules: Rules, n_rows: int):
    """(tree, depth, left child, found) of all nodes."""
    nodes, spark = Nodes(), blocks.sparkSession
    state, steps = blocks.cache(), []
    parts = state.agg(F.count_distinct(F.shiftright("place", 24))).first()[0]
    mean = rules.rate if rules.rate is not None else 1.0
    share = 1 - math.exp(-mean) if rules.rate is not None else 1.0
    slots = [1] * rules.trees
    weight = [np.full(1, n_rows * mean) for _ in slots]
    path = [np.ones(1, np.int64) for _ in slots]
    level, a_slot = 0, 16 * rules.tried * rules.width
    try:
        while any(slots):
            held = sum(float(w.sum()) for w in weight) * share / mean
            ahead = sum(A_PASS + min(sum(slots) << (k - level), held / 2) * a_slot * parts for k in range(level, rules.depth))
            if level < rules.depth and max(w.max() for w in weight if len(w)) * share / mean <= ROWS_AT_HAND and ahead > DEALING * held * (13 + len(rules.thresholds)):
                _finish(state, steps, nodes, rules, level, path, weight)
                break
            before = None
            if len(steps) == LEVELS_BETWEEN_STATES:
                before, state, steps = state, state.mapInArrow(_advance(rules, steps), STATE).cache(), []
            tried = [drawn_features(rules, t, p) for t, p in enumerate(path)] if level < rules.depth else None
            at_once = max(1, SUMS_BYTES // (max(slots) * (a_slot if tried else 24)))
            alive = [t for t, s in enumerate(slots) if s]
            found = {}
            for i in range(0, len(alive), at_once):
                trees = alive[i : i + at_once]
                sums = state.select("fixed", "moving").mapInArrow(_sums(rules, steps, slots, trees, tried), "tree int, first int, part int, nodes binary, sums binary")
                best = sums.groupBy("tree", "first").applyInArrow(_best(rules, tried), "tree int, first int, found binary")
                for r in best.collect():
                    found[r["tree"], r["first"]] = np.frombuffer(r["found"], np.float64).reshape(-1, 7)
            if before is not None:
                before.unpersist()
            by_tree = [np.concatenate([found[t, i] for i in range(0, s, SLOTS_TOGETHER)]) if s else np.empty((0, 7)) for t, s in enumerate(slots)]
            nodes.add(np.repeat(np.arange(rules.trees), slots), level, np.concatenate(by_tree))
            splits, slots, weight = next_level(by_tree)
            steps = [*steps, splits]
            path = [children_of(p, nth >= 0) for p, nth in zip(path, splits.nth)]
            level += 1
    finally:
        state.unpersist()
    return nodes.arrays()


def next_level(by_tree: list[np.ndarray]) -> tuple[Splits, list[int], list[np.ndarray]]:
    """How rows move on, the slots per tree they come to and those's weights."""
    split = [f[:, 3] >= 0 for f in by_tree]
    splits = Splits([np.maximum(f[:, 3], 0).astype(np.uint8) for f in by_tree], [f[:, 4].astype(np.uint8) for f in by_tree], [np.where(s, np.cumsum(s) - 1, -1) for s in split])
    weight = [np.column_stack([f[s, 6], f[s, 0] - f[s, 6]]).ravel() for f, s in zip(by_tree, split)]
    return splits, [2 * int(s.sum()) for s in split], weight


def _finish(state: DataFrame, steps: list[Splits], nodes: Nodes, rules: Rules, level: int, path: list[np.ndarray], weight: list[np.ndarray]) -> None:
    """Grows all slots of ``level`` to the end in groups, and adds the nodes."""
    slots = [len(p) for p in path]
    tree = np.repeat(np.arange(rules.trees), slots)
    load = np.concatenate(weight)
    group = ((np.cumsum(load) - load) // GROUP_ROWS).astype(np.int64)
    group = np.unique(group, return_inverse=True)[1]  # numbered without gaps, in the order of the slots
    sizes = np.bincount(group)
    starts = np.r_[0, np.cumsum(sizes)]
    number = np.arange(len(group)) - starts[group]
    ends = np.cumsum(slots)[:-1]
    sent = state.mapInArrow(_spread(rules, steps, np.split(group, ends), np.split(number, ends)), "grp int, tree int, place bigint, sent binary")
    # A task for every group: AQE would put many small ones together.
    grown = sent.repartition(min(2 * len(sizes), 4096), "grp").groupBy("grp").applyInArrow(_grow_group(rules, level, starts, tree, np.concatenate(path)), "grp int, depth int, found binary")
    found = {(r["grp"], r["depth"]): np.frombuffer(r["found"], np.float64).reshape(-1, 7) for r in grown.collect()}
    # Groups hold the slots in order, so do their levels one after another.
    for depth in range(level, rules.depth + 1):
        here = [found[g, depth] for g in range(len(sizes)) if (g, depth) in found]
        if not here:
            break
        tree = nodes.add(tree, depth, np.concatenate(here))


def merged(tree: np.ndarray, depth: np.ndarray, left: np.ndarray, told: np.ndarray) -> np.ndarray:
    """``left`` after siblings that are leaves and predict alike were merged
    into their parent (-1), from the bottom up; -2 for nodes that are gone."""
    left = left.copy()
    at = [np.flatnonzero(depth == d) for d in range(int(depth.max()) + 1)]
    for here in reversed(at):
        inner = here[left[here] >= 0]
        a = left[inner]
        alike = (left[a] < 0) & (left[a + 1] < 0) & (told[a] == told[a + 1])
        left[a[alike]] = left[a[alike] + 1] = -2
        left[inner[alike]] = -1
    return left


def _save(est, path: str, spark, kind: str, rules: Rules, tree, depth, left, found) -> None:
    """The forest in the format of pyspark.ml's writer."""
    w, s, q, gain = found[:, 0], found[:, 1], found[:, 2], found[:, 5]
    some = np.where(w > 0, w, 1.0)  # a tree may have drawn no row
    if kind == "classification":
        stats = np.column_stack([w - s, s])
        prediction = (s > w - s).astype(np.float64)
        impurity = np.where(w > 0, 1 - ((stats / some[:, None]) ** 2).sum(axis=1), 0.0)
        gain = 2 * gain
    else:
        c = rules.centre
        stats = np.column_stack([w, s + c * w, q + 2 * c * s + c * c * w])
        prediction = np.where(w > 0, c + s / some, 0.0)
        impurity = np.maximum(q / some - (s / some) ** 2, 0.0)
    left = merged(tree, depth, left, prediction)
    kept = np.flatnonzero(left > -2)
    kept = kept[np.argsort(tree[kept], kind="stable")]
    starts = np.searchsorted(tree[kept], np.arange(rules.trees))
    place = np.full(len(left), -1, np.int64)
    place[kept] = np.arange(len(kept)) - starts[tree[kept]]
    inner = left[kept] >= 0
    child = np.where(inner, left[kept], 0)
    feature = np.where(inner, found[kept, 3], -1).astype(np.int32)
    last = found[kept, 4].astype(np.int64)
    threshold = np.zeros(len(kept))
    for f, t in enumerate(rules.thresholds):
        threshold[feature == f] = t[last[feature == f]]
    i32 = lambda a: pa.array(a.astype(np.int32))
    lists = lambda offsets, a: pa.ListArray.from_arrays(i32(offsets), pa.array(a))
    split = pa.StructArray.from_arrays([i32(feature), lists(np.r_[0, np.cumsum(inner)], threshold[inner]), i32(np.full(len(kept), -1))], ["featureIndex", "leftCategoriesOrThreshold", "numCategories"])
    columns = {
        "id": i32(place[kept]), "prediction": pa.array(prediction[kept]), "impurity": pa.array(impurity[kept]),
        "impurityStats": lists(np.arange(len(kept) + 1) * stats.shape[1], stats[kept].ravel()), "rawCount": pa.array(np.rint(w[kept]).astype(np.int64)),
        "gain": pa.array(np.where(inner, gain[kept], -1.0)), "leftChild": i32(np.where(inner, place[child], -1)), "rightChild": i32(np.where(inner, place[child + 1], -1)), "split": split,
    }
    table = pa.table({"treeID": i32(tree[kept]), "nodeData": pa.StructArray.from_arrays(list(columns.values()), list(columns))})
    spark.createDataFrame(table).write.parquet(f"{path}/data")
    name = kind.capitalize()
    own, default = ({p.name: v for p, v in m.items()} for m in (est._paramMap, est._defaultParamMap))
    meta = {"class": f"org.apache.spark.ml.{kind}.RandomForest{name}Model", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "uid": est.uid, "paramMap": own, "defaultParamMap": default,
            "numFeatures": len(rules.thresholds), **({"numClasses": 2} if kind == "classification" else {}), "numTrees": rules.trees}
    forest_only = {"numTrees", "subsamplingRate", "featureSubsetStrategy", "bootstrap"}
    of_tree = {**meta, "class": f"org.apache.spark.ml.{kind}.DecisionTree{name}Model", **{m: {k: v for k, v in meta[m].items() if k not in forest_only} for m in ("paramMap", "defaultParamMap")}}
    trees = [(t, json.dumps({k: v for k, v in {**of_tree, "uid": f"{est.uid}_{t}"}.items() if not k.startswith("num")}), 1.0) for t in range(rules.trees)]
    spark.createDataFrame(trees, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.text(f"{path}/metadata")


def features_tried(strategy: str, features: int, trees: int, kind: str) -> int | None:
    """``featureSubsetStrategy`` as a number; None for what MLlib would refuse."""
    if strategy == "auto":
        strategy = "all" if trees == 1 else "sqrt" if kind == "classification" else "onethird"
    named = {"all": features, "sqrt": math.ceil(math.sqrt(features)), "log2": max(1, math.ceil(math.log2(features))), "onethird": math.ceil(features / 3)}
    if strategy in named:
        return named[strategy]
    try:
        if strategy.isdigit():
            return min(int(strategy), features) or None
        return math.ceil(float(strategy) * features) if 0 < float(strategy) <= 1 else None
    except ValueError:
        return None


class _Histograms:
    """``fit`` by this module, or by MLlib where it does not apply."""

    def _fit(self, dataset: DataFrame):
        return self._fit_histograms(dataset) or super()._fit(dataset)

    def _fit_histograms(self, dataset: DataFrame):
        get = lambda name: self.getOrDefault(self.getParam(name))
        kind, bins, trees = self.kind, get("maxBins"), get("numTrees")
        if self.isSet("weightCol") or get("impurity") not in ("variance", "gini") or get("minWeightFractionPerNode") or get("minInfoGain") or bins > 256:
            return None
        if not get("bootstrap") and get("subsamplingRate") < 1.0:
            return None
        told = dataset.schema[get("featuresCol")].metadata.get("ml_attr", {}).get("attrs", {})
        if set(told) - {"numeric"}:
            return None
        y = F.col(get("labelCol")).cast("double")
        rows = dataset.select(vector_to_array(F.col(get("featuresCol"))).alias("x"), y.alias("y"))
        known = rows.agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("mean"), F.max("y").alias("most"), F.count_if(F.col("y").isNull() | F.isnan("y")).alias("none"), F.count_if(~F.col("y").isin(0.0, 1.0)).alias("others")).first()
        n = known["n"]
        if not n or known["none"] or not math.isfinite(known["mean"]) or kind == "classification" and (known["others"] or known["most"] != 1.0):
            return None
        bins = min(bins, n)
        wanted = max(bins * bins, 10_000)
        some = rows if wanted >= n else rows.sample(False, wanted / n, get("seed"))
        table = some.select("x").toArrow()["x"].combine_chunks()
        if not len(table):
            return None
        values = table.flatten().to_numpy(zero_copy_only=False).reshape(len(table), -1)
        tried = features_tried(get("featureSubsetStrategy"), values.shape[1], trees, kind) if values.shape[1] else None
        if not tried:
            return None
        rules = Rules(get("seed"), trees, get("maxDepth"), tried, [candidate_thresholds(values[:, i], bins) for i in range(values.shape[1])],
                      get("subsamplingRate") if get("bootstrap") else None, known["mean"] if kind == "regression" else 0.0, get("minInstancesPerNode"))
        grown = _grow(rows.mapInArrow(_blocks(rules), STATE), rules, n)
        path = fresh_path(dataset.sparkSession, "grown")
        _save(self, path, dataset.sparkSession, kind, rules, *grown)
        return self.model.load(path)


class ForestRegressor(_Histograms, RandomForestRegressor):
    kind, model = "regression", RandomForestRegressionModel


class ForestClassifier(_Histograms, RandomForestClassifier):
    kind, model = "classification", RandomForestClassificationModel
