"""Forests and boosted trees over sparse rows (ml07-ml11 and the trees of ml13), as Spark jobs.

Spark's tree learners hold a row as one bin per slot, so rows times slots: with a slot
for each supplier that grows with the square of the input.  Here a row keeps, beside
a byte for each slot that most rows use, only the slots whose bin is not that of zero;
what lies in the zero bin is the node's total less the rest.  The method is that of ``pyspark.ml``, with its options: bins from a sample of
the rows, Poisson bags, the slots of a node drawn anew for each node, variance or Gini
impurity, one level of all trees at a time; boosting fits a tree to the negative
gradients at the margins so far, which stand in the blocks.  Without drawing (all
slots, no bags) the trees are Spark's (tested); otherwise the draws are others.

A level is one job: tasks add up (node, slot, bin) over packed blocks of rows, whose
entries lie slot by slot; a shuffle brings each slot of a node together, many slots to
a row of packed sums; and tasks pick the best cuts.  The driver
holds what it does in Spark's learner: the trees, and one candidate per node and task.
The result is Spark's own model, written in its saved form and loaded.
"""

from __future__ import annotations

import json
import math
import time
from multiprocessing.pool import ThreadPool
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, inheritable_thread_target
from pyspark.ml.base import Model
from pyspark.ml.classification import OneVsRestModel
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shipcast.functions.columns import vector_size
from shipcast.operators.oversample import _entries
from shipcast.operators.quantiles import drop_stable, stable
from shipcast.session import scratch_path

#: Rows times slots up to which Spark's own learner fits: it needs 4 bytes for each, and
#: a small table's levels take it less time.
DENSE = 1 << 28
#: Boosting is a chain of jobs, a job a level, which small tables do not fill: up to so many rows, bytes of blocks,
#: and times DENSE rows times slots, it is done in one task, where a level takes about 1.8 microseconds a row.
ALONE_ROWS, ALONE, WIDE = 1 << 18, 1 << 28, 32
#: Rows of a block.
BLOCK = 16384
#: Bins that a task adds up at a time; more nodes take more passes.
PASS = 1 << 21
#: Bins whose sums are packed into one row of the shuffle.
PART = 1 << 16
#: Nodes times slots up to which a task looks a slot up in a table.
TABLE = 1 << 22
#: Levels after which the rows' places in the trees are written down.
CUT = 4
#: Above any depth: a single tree's places are found from the root.
MOST_LEVELS = 1000
#: Boosting rounds between written margins.
ROUNDS = 10
#: Gains and impurities below this part of the root's impurity are rounding.
TINY = 1e-12
#: Slots that at least this part of the rows use are kept for every row.
FULL = 0.25

_BLOCK_SCHEMA = "id long, rows int, slots binary, ends binary, row binary, bins binary, dense binary, y binary, w binary, margin binary, nodes binary"
_BLOCK_NAMES = [c.split()[0] for c in _BLOCK_SCHEMA.split(", ")]
_TREE_SCHEMA = "turn int, tree int, loss double, feature binary, cut binary, left binary, gain binary, stats binary"
_TREE_NAMES = [c.split()[0] for c in _TREE_SCHEMA.split(", ")]


# ---------------------------------------------------------------- bins

def attributes(rows: DataFrame) -> tuple[np.ndarray, bool]:
    """(numbers of the 0/1 slots, whether some slot holds numbered categories)."""
    attrs = rows.schema["features"].metadata.get("ml_attr", {}).get("attrs", {})
    return np.array(sorted(a["idx"] for a in attrs.get("binary", [])), np.int64), bool(attrs.get("nominal"))


def cuts_of(values: np.ndarray, weights: np.ndarray, n_cuts: int) -> list[float]:
    """Cuts between distinct sorted values: all of them, or ``n_cuts`` of about equal weight."""
    middle = (values[:-1] + values[1:]) / 2
    if len(middle) <= n_cuts:
        return middle.tolist()
    stride = weights.sum() / (n_cuts + 1)
    out, target, before = [], stride, weights[0]
    for m, w in zip(middle, weights[1:]):
        if abs(before - target) < abs(before + w - target):
            out.append(float(m))
            target += stride
        before += w
    return out


def find_cuts(rows: DataFrame, n: int, hot: np.ndarray, max_bins: int, seed: int) -> tuple[dict[int, np.ndarray], list[int]]:
    """(slot -> its cuts, for the slots that are not 0/1; those of them that are full).  As in Spark's learner they come
    from a sample of the rows, which only places the cuts: every row is binned."""
    need = max(max_bins * max_bins, 10000)
    sample = stable(rows.sample(fraction=need / n, seed=seed) if n > need else rows)
    total = sample.agg(F.sum("weight")).first()[0] or 0.0

    def cells(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in it:
            row, slot, value = _entries(rb.column("features"))
            keep = (value != 0) & ~np.isin(slot, hot)
            yield pa.RecordBatch.from_arrays([pa.array(slot[keep].astype(np.int32)), pa.array(value[keep]),
                                              pa.array(rb.column("weight").to_numpy()[row[keep]])], ["slot", "value", "w"])

    def cut(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        value, w = table["value"].to_numpy(), table["w"].to_numpy()
        used = w.sum()
        zero = total - used
        if zero > 1e-9 * total:
            value, w = np.append(value, 0.0), np.append(w, zero)
        order = np.argsort(value)
        found = cuts_of(value[order], w[order], min(max_bins, n) - 1)
        return pa.table({"slot": pa.array([key[0].as_py()], pa.int32()), "cuts": pa.array([found], pa.list_(pa.float64())),
                         "full": pa.array([bool(used >= FULL * total)])})

    try:
        counted = sample.mapInArrow(cells, "slot int, value double, w double").groupBy("slot", "value").agg(F.sum("w").alias("w"))
        got = [r for r in counted.groupBy("slot").applyInArrow(cut, "slot int, cuts array<double>, full boolean").collect() if r["cuts"]]
        return {r["slot"]: np.array(r["cuts"]) for r in got}, sorted(r["slot"] for r in got if r["full"])
    finally:
        drop_stable(sample)


class Bins:
    """How a value of a slot becomes a bin.  0/1 slots have two: below 1 and from 1 on."""

    def __init__(self, size: int, hot: np.ndarray, cuts: dict[int, np.ndarray], full: list[int] = ()):
        self.size, self.cuts, self.full = size, cuts, np.array(full, np.int64)
        self.column = np.full(size, -1, np.int32)  # of a full slot in ``dense``
        self.column[self.full] = np.arange(len(full))
        self.count, self.zero = np.ones(size, np.int32), np.zeros(size, np.uint8)
        self.count[hot] = 2
        for slot, c in cuts.items():
            self.count[slot], self.zero[slot] = len(c) + 1, np.searchsorted(c, 0.0)

    def of(self, slot: np.ndarray, value: np.ndarray) -> np.ndarray:
        out = (value >= 1).astype(np.uint8)
        wide = np.isin(slot, np.fromiter(self.cuts, np.int64, len(self.cuts)))
        out[(self.count[slot] == 1)] = 0
        at = np.flatnonzero(wide)
        at = at[np.argsort(slot[at], kind="stable")]
        for part in np.split(at, np.flatnonzero(np.diff(slot[at])) + 1):
            if len(part):
                out[part] = np.searchsorted(self.cuts[slot[part[0]]], value[part])
        return out

    def cut_value(self, slot: int, at: int) -> float:
        return float(self.cuts[slot][at]) if slot in self.cuts else float(np.nextafter(1.0, 0.0))


def pack(rows: DataFrame, bins: Bins, margins: int = 0) -> DataFrame:
    """label, weight, features -> blocks of rows with so many margins of zero.  An entry is a row and a bin
    that is not zero's; ``ends`` tells where those of each slot of ``slots`` end."""
    def work(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn, base = 0, TaskContext.get().partitionId() << 32
        held, have = [], 0

        def block():
            per_row, slot, bin_, *cols = (np.concatenate([h[k] for h in held], axis=-1) for k in range(6))
            n, order = len(per_row), np.argsort(slot, kind="stable")
            slots, counts = np.unique(slot, return_counts=True)
            row = np.repeat(np.arange(n, dtype=np.uint16), per_row)
            return pa.RecordBatch.from_arrays(
                [pa.array([base + turn]), pa.array([n], pa.int32()),
                 *[pa.array([a.tobytes()], pa.binary()) for a in (slots, np.cumsum(counts).astype(np.int32), row[order], bin_[order], *cols,
                                                                  np.zeros(margins * n), np.zeros(0, np.int32))]], _BLOCK_NAMES)

        for rb in it:
            for start in range(0, rb.num_rows, BLOCK):
                part = rb.slice(start, BLOCK)
                row, slot, value = _entries(part.column("features"))
                order = np.lexsort((slot, row))
                row, slot, value = row[order], slot[order], value[order]
                bin_ = bins.of(slot, value)
                dense = np.repeat(bins.zero[bins.full][:, None], part.num_rows, 1)
                column = bins.column[slot]
                dense[column[column >= 0], row[column >= 0]] = bin_[column >= 0]
                keep = (bin_ != bins.zero[slot]) & (column < 0)
                held.append((np.bincount(row[keep], minlength=part.num_rows), slot[keep].astype(np.int32), bin_[keep], dense,
                             part.column("label").to_numpy(zero_copy_only=False).astype(float),
                             part.column("weight").to_numpy(zero_copy_only=False).astype(float)))
                have += part.num_rows
                if have >= BLOCK:
                    yield block()
                    turn, held, have = turn + 1, [], 0
        if have:
            yield block()

    return rows.select("label", "weight", "features").mapInArrow(work, _BLOCK_SCHEMA)


def spread(first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """first, first + 1, ... of every stretch, one stretch after the other."""
    return np.arange(length.sum()) + np.repeat(first - np.cumsum(length) + length, length)


class Rows:
    """A block in a task."""

    def __init__(self, r: dict, bins: Bins):
        self.id, self.n, self.bins, self.size = r["id"], r["rows"], bins, bins.size
        self.slots, ends = np.frombuffer(r["slots"], np.int32), np.frombuffer(r["ends"], np.int32)
        self.length = np.diff(ends, prepend=np.int32(0))
        self.first = ends - self.length
        self.number = np.full(self.size, -1, np.int32)  # of a slot in ``slots``
        self.number[self.slots] = np.arange(len(self.slots))
        self.row, self.bin = np.frombuffer(r["row"], np.uint16), np.frombuffer(r["bins"], np.uint8)
        self.y, self.w = np.frombuffer(r["y"]), np.frombuffer(r["w"])
        self.margin = np.frombuffer(r["margin"]).reshape(-1, self.n) if r["margin"] else None
        self.dense = np.frombuffer(r["dense"], np.uint8).reshape(-1, self.n)
        self.nodes = np.frombuffer(r["nodes"], np.int32).reshape(-1, self.n)

    def shares(self) -> np.ndarray:
        """The softmax of the margins: a row for each class."""
        power = np.exp(self.margin - self.margin.max(0))
        return power / power.sum(0)

    def loss(self) -> float:
        """The sum of the log-losses of the softmax of the margins."""
        return float(-np.log(np.maximum(self.shares()[self.y.astype(int), np.arange(self.n)], 1e-300)).sum())

    def target(self, options: dict, tree: int) -> tuple[np.ndarray, np.ndarray]:
        """What a tree is fitted to and with which weights: the label, or once there are margins their loss's
        negative gradient; by softmax the working response of the tree's class."""
        if self.margin is None:
            return self.y, self.w
        if options["loss"] == "softmax":
            p = self.shares()[tree]
            weight = np.maximum(p * (1 - p), options["floor"])
            return ((self.y == tree) - p) / weight, weight * self.w
        if options["loss"] == "squared":
            return 2 * (self.y - self.margin[0]), self.w
        return 4 * self.y / (1 + np.exp(np.minimum(2 * self.y * self.margin[0], 700))), self.w

    def entries(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of ``slots``, entry) for all entries of these slots."""
        number = self.number[slots]
        has = np.flatnonzero(number >= 0)
        first, length = self.first[number[has]], self.length[number[has]]
        return np.repeat(has, length), spread(first, length)

    def n_entries(self, slots: np.ndarray) -> int:
        number = self.number[slots]
        return int(self.length[number[number >= 0]].sum(dtype=np.int64))

    def bag(self, tree: int, seed: int, rate: float, bootstrap: bool) -> np.ndarray:
        """How often each row is in the tree's bag."""
        rng = np.random.default_rng([seed, tree, self.id])
        if bootstrap:
            return rng.poisson(rate, self.n).astype(float)
        return (rng.random(self.n) < rate).astype(float) if rate < 1 else np.ones(self.n)

    def place(self, tree: int, shape) -> np.ndarray:
        """The node of every row, from the place written down (or the root) downwards."""
        feature, cut, left = shape
        at = self.nodes[tree].copy() if len(self.nodes) else np.zeros(self.n, np.int32)
        while len(go := np.flatnonzero(left[at] >= 0)):
            node = at[go]
            slot = feature[node]
            column = self.bins.column[slot]
            right = np.zeros(self.n, bool)
            right[go] = self.bins.zero[slot] > cut[node]
            full = np.flatnonzero(column >= 0)
            right[go[full]] = self.dense[column[full], go[full]] > cut[node[full]]
            # Other slots: the rows that have an entry, and stand where it is asked for.
            inner = np.zeros(len(feature), bool)
            inner[node] = True
            asked = np.unique(feature[inner])
            asked = asked[self.bins.column[asked] < 0]
            which, entry = self.entries(asked)
            row = self.row[entry]
            place = at[row]
            hit = np.flatnonzero((feature[place] == asked[which]) & inner[place])
            right[row[hit]] = self.bin[entry[hit]] > cut[place[hit]]
            at[go] = left[node] + right[go]
        return at


def blocks_of(it: Iterator[pa.RecordBatch], bins: Bins) -> Iterator[Rows]:
    for rb in it:
        for k in range(rb.num_rows):
            yield Rows({c: rb.column(c)[k].as_py() for c in _BLOCK_NAMES}, bins)


# ---------------------------------------------------------------- sums and cuts

def stats_of(y: np.ndarray, w: np.ndarray, classes: int) -> list[np.ndarray]:
    """What is added up besides the number of rows: (w, wy, wyy), or the weight of each class."""
    return [w * (y == k) for k in range(classes)] if classes else [w, w * y, w * y * y]


def impurity(s: np.ndarray, classes: int) -> np.ndarray:
    """Of sums in the last axis; the weight must not be zero."""
    if classes:
        total = s.sum(-1)
        return 1 - (s * s).sum(-1) / (total * total)
    return np.maximum((s[..., 2] - s[..., 1] ** 2 / s[..., 0]) / s[..., 0], 0)


def weight_of(s: np.ndarray, classes: int) -> np.ndarray:
    return s.sum(-1) if classes else s[..., 0]


def draw_slots(rng: np.random.Generator, size: int, m: int) -> np.ndarray:
    """``m`` different slots, ascending."""
    return np.arange(size) if m >= size else np.sort(rng.choice(size, m, replace=False, shuffle=False))


class Pass:
    """The nodes of one job: (tree, node) and the slots that were drawn for each."""

    def __init__(self, nodes: list[tuple[int, int]], slots: list[np.ndarray], totals: np.ndarray, bins: Bins):
        self.size, self.bins = bins.size, bins
        self.tree = np.array([t for t, _ in nodes])
        self.node = np.array([v for _, v in nodes])
        self.totals = totals
        self.everything = len(slots[0]) == bins.size
        self.first = np.arange(len(nodes) + 1, dtype=np.int64) * len(slots[0])
        # Keys ascend: nodes in turn, slots ascending in each.
        self.key_node = np.repeat(np.arange(len(nodes)), [len(x) for x in slots])
        self.key_slot = np.concatenate(slots)
        self.start = np.concatenate([[0], np.cumsum(bins.count[self.key_slot], dtype=np.int64)])
        # The first key of every part of the shuffle.
        self.parts = np.append(np.unique(self.start[:-1] // PART, return_index=True)[1], len(self.key_slot))
        # The full slots among the keys.
        self.full = np.flatnonzero(bins.column[self.key_slot] >= 0)
        self.table = None

    def of_tree(self, rows: Rows, own: np.ndarray, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        """(key, entry) for the entries of the rows in the nodes from ``first`` up to ``last`` whose slot was drawn there."""
        low, high = self.first[first], self.first[last]
        slots = self.key_slot[low:high]
        if not self.everything and rows.n_entries(slots) <= 2 * len(rows.row):
            which, entry = rows.entries(slots)
            hit = np.flatnonzero(own[rows.row[entry]] == self.key_node[low + which])
            return low + which[hit], entry[hit]
        node = own[rows.row]
        entry = np.flatnonzero(node >= 0)
        node, slot = node[entry], np.repeat(rows.slots, rows.length)[entry]
        if self.everything:
            return node * self.size + slot, entry
        if len(self.tree) * self.size <= TABLE:
            if self.table is None:
                self.table = np.full(len(self.tree) * self.size, -1, np.int32)
                self.table[self.key_node * self.size + self.key_slot] = np.arange(len(self.key_slot))
            at = self.table[node * self.size + slot]
            hit = np.flatnonzero(at >= 0)
            return at[hit], entry[hit]
        keys, asked = self.key_node[low:high] * self.size + slots, node * self.size + slot
        at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
        hit = np.flatnonzero(keys[at] == asked)
        return low + at[hit], entry[hit]


def add_full(sums: np.ndarray, todo: Pass, rows: Rows, own: np.ndarray, first: int, last: int, x: list[np.ndarray]) -> None:
    """Adds the slots kept for every row, column by column."""
    low, high = np.searchsorted(todo.full, [todo.first[first], todo.first[last]])
    if low == high:
        return
    keys = todo.full[low:high]
    column, node = todo.bins.column[todo.key_slot[keys]], todo.key_node[keys] - first
    order = np.argsort(column, kind="stable")
    inside = np.flatnonzero(own >= 0)
    local, x = own[inside] - first, [v[inside] for v in x]
    whole = len(inside) == rows.n
    for own_keys in np.split(order, np.flatnonzero(np.diff(column[order])) + 1):
        slot = todo.key_slot[keys[own_keys[0]]]
        wide = int(todo.bins.count[slot])
        # Where the slot was not drawn, the rows go to one node more, which is left out.
        drawn = np.full(last - first, len(own_keys))
        drawn[node[own_keys]] = np.arange(len(own_keys))
        bin_ = rows.dense[column[own_keys[0]]]
        index = (drawn * wide)[local] + (bin_ if whole else bin_[inside])
        to = todo.start[keys[own_keys]][:, None] + np.arange(wide)
        for k, v in enumerate(x):
            sums[k, to] += np.bincount(index, v, (len(own_keys) + 1) * wide)[:len(own_keys) * wide].reshape(-1, wide)


def add_tree(sums: np.ndarray, todo: Pass, rows: Rows, own: np.ndarray, first: int, last: int, x: list[np.ndarray]) -> None:
    """Adds a tree's rows, which stand in the nodes ``own`` (-1: none) from ``first`` up to ``last``."""
    at, entry = todo.of_tree(rows, own, first, last)
    index, row = todo.start[at] + rows.bin[entry], rows.row[entry]
    add_full(sums, todo, rows, own, first, last, x)
    # Of a tree only the touched stretch is added to, or single bins of a long one.
    low, high = (index.min(), index.max() + 1) if len(index) else (0, 0)
    for k, v in enumerate(x):
        if high - low > 8 * len(index):
            np.add.at(sums[k], index, v[row])
        else:
            sums[k, low:high] += np.bincount(index - low, v[row], high - low)


def add_up(blocks: DataFrame, shared, options: dict) -> DataFrame:
    """part, at, s: the bins of a part that a task has met, and their sums (rows first)."""
    classes = options["classes"]

    def work(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        todo, shapes = shared.value
        sums = np.zeros((1 + (classes or 3), int(todo.start[-1])))
        trees, firsts = np.unique(todo.tree, return_index=True)
        lasts = np.append(firsts[1:], len(todo.tree))
        for rows in blocks_of(it, todo.bins):
            for tree, first, last in zip(trees, firsts, lasts):
                place = np.full(len(shapes[tree][0]), -1, np.int64)
                place[todo.node[first:last]] = np.arange(first, last)
                times = rows.bag(tree, options["seed"], options["rate"], options["bootstrap"])
                own = place[rows.place(tree, shapes[tree])]
                own[times == 0] = -1
                y, w = rows.target(options, tree)
                x = [times, *stats_of(y, w * times, classes)]
                add_tree(sums, todo, rows, own, first, last, x)
        for part, (low, high) in enumerate(zip(todo.start[todo.parts[:-1]], todo.start[todo.parts[1:]])):
            met = np.flatnonzero(sums[0, low:high])
            if len(met):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), pa.array([met.astype(np.int32).tobytes()], pa.binary()),
                     pa.array([sums[:, low + met].tobytes()], pa.binary())], ["part", "at", "s"])

    return blocks.mapInArrow(work, "part int, at binary, s binary")


def cuts_in(todo: Pass, part: int, x: np.ndarray, classes: int, least: int) -> Iterator[tuple]:
    """(node, slot, cut, gain, left) arrays: the best cut of every (node, slot) of a part whose sums are ``x``."""
    width = len(x)
    keys = np.arange(todo.parts[part], todo.parts[part + 1])
    first = todo.start[keys] - todo.start[keys[0]]
    count = todo.bins.count[todo.key_slot[keys]]
    for narrow in (True, False):
        some_keys = np.flatnonzero((count == 2) if narrow else (count > 2))
        wide = 2 if narrow else int(count.max())
        step = max(1, (1 << 20) // (wide * width))
        for low in range(0, len(some_keys), step):
            some = some_keys[low:low + step]
            inside = np.arange(wide) < count[some][:, None]
            at = np.where(inside, first[some][:, None] + np.arange(wide), 0)
            cube = np.where(inside, x[:, at], 0).transpose(1, 2, 0)
            met = cube[..., 0].any(1)
            some, cube = some[met], cube[met]
            node, slot = todo.key_node[keys[some]], todo.key_slot[keys[some]]
            total, here = todo.totals[node], np.arange(len(some))
            cube[here, todo.bins.zero[slot]] += total - cube.sum(1)
            left = cube.cumsum(1)[:, :-1]
            right = total[:, None] - left
            ok = (left[..., 0] >= least) & (right[..., 0] >= least) & (np.arange(wide - 1) < count[some][:, None] - 1)
            with np.errstate(all="ignore"):
                wl, wr = weight_of(left[..., 1:], classes), weight_of(right[..., 1:], classes)
                ok &= (wl > 0) & (wr > 0)
                gain = (impurity(total[:, None, 1:], classes)
                        - (wl * impurity(left[..., 1:], classes) + wr * impurity(right[..., 1:], classes)) / (wl + wr))
            gain = np.where(ok, gain, -1.0)
            cut = gain.argmax(1)
            yield node, slot, cut, gain[here, cut], left[here, cut]


def best_of(found: list[tuple]) -> list[np.ndarray]:
    """The best of the cuts of ``cuts_in`` for each node that has one; the first slot of equals."""
    node, slot, cut, gain, left = (np.concatenate([f[k] for f in found]) for k in range(5))
    order = np.lexsort((slot, -gain, node))
    order = order[np.unique(node[order], return_index=True)[1]]
    order = order[gain[order] > 0]
    return [a[order] for a in (node, slot, cut, gain, left)]


def best_cuts(sums: DataFrame, shared, options: dict, n_parts: int) -> DataFrame:
    """The best cut of each node among the slots of a part: node (in the pass), slot, cut, gain, left."""
    classes, least, width = options["classes"], options["least"], 1 + (options["classes"] or 3)

    def work(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        todo, sums = shared.value[0], {}
        for rb in it:
            for part, at, s in zip(*(rb.column(c).to_pylist() for c in ("part", "at", "s"))):
                at = np.frombuffer(at, np.int32)
                if part not in sums:
                    low, high = todo.start[todo.parts[part:part + 2]]
                    sums[part] = np.zeros((width, int(high - low)))
                sums[part][:, at] += np.frombuffer(s).reshape(width, -1)
        found = [f for part in sorted(sums) for f in cuts_in(todo, part, sums[part], classes, least)]
        if not found:
            return
        node, slot, cut, gain, left = best_of(found)
        yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(slot), pa.array(cut), pa.array(gain),
                                          pa.array(left.tolist(), pa.list_(pa.float64()))], ["node", "slot", "cut", "gain", "left"])

    return sums.repartition(n_parts, "part").mapInArrow(work, "node long, slot long, cut long, gain double, left array<double>")


def totals_of(blocks: DataFrame, n_trees: int, bins: Bins, options: dict) -> np.ndarray:
    """Number of rows and sums of every tree's bag."""
    classes = options["classes"]

    width = 1 + (classes or 3)

    def work(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((n_trees, width))
        for rows in blocks_of(it, bins):
            for tree in range(n_trees):
                times = rows.bag(tree, options["seed"], options["rate"], options["bootstrap"])
                y, w = rows.target(options, tree)
                sums[tree] += [v.sum() for v in (times, *stats_of(y, w * times, classes))]
        yield pa.RecordBatch.from_arrays([pa.array([sums.tobytes()], pa.binary())], ["s"])

    return sum((np.frombuffer(r["s"]).reshape(n_trees, width) for r in blocks.mapInArrow(work, "s binary").collect()),
               np.zeros((n_trees, width)))


def write_down(blocks: DataFrame, shared, n_trees: int) -> DataFrame:
    """The blocks with the place of every row in every tree."""
    def work(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, shapes = shared.value
        for rb in it:
            for k in range(rb.num_rows):
                one = rb.slice(k, 1)
                rows = next(blocks_of([one], bins))
                nodes = np.concatenate([rows.place(t, shapes[t]) for t in range(n_trees)]).astype(np.int32)
                cols = [one.column(c) for c in _BLOCK_NAMES[:-1]]
                yield pa.RecordBatch.from_arrays([*cols, pa.array([nodes.tobytes()], pa.binary())], _BLOCK_NAMES)

    return blocks.mapInArrow(work, _BLOCK_SCHEMA)


def step(blocks: DataFrame, bins: Bins, trees: list[Tree], rate: float) -> DataFrame:
    """The blocks with ``rate`` times each tree added to its margin."""
    shapes = [t.shape(t.merged(0)) for t in trees]
    values = [rate * np.array([t.prediction(v, 0) for v in range(len(t.left))]) for t in trees]

    def work(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in it:
            for k in range(rb.num_rows):
                one = rb.slice(k, 1)
                rows = next(blocks_of([one], bins))
                margin = np.stack([value[rows.place(t, shape)] for t, (value, shape) in enumerate(zip(values, shapes))])
                margin += 0 if rows.margin is None else rows.margin
                cols = [one.column(c) for c in _BLOCK_NAMES]
                cols[_BLOCK_NAMES.index("margin")] = pa.array([margin.tobytes()], pa.binary())
                yield pa.RecordBatch.from_arrays(cols, _BLOCK_NAMES)

    return blocks.mapInArrow(work, _BLOCK_SCHEMA)


# ---------------------------------------------------------------- trees

class Tree:
    """Nodes in the order of their making, so that children follow their parent; -1: none."""

    def __init__(self, total: np.ndarray):
        self.feature, self.cut, self.left, self.gain, self.stats = [0], [0], [-1], [-1.0], [total]

    @classmethod
    def of(cls, r) -> Tree:
        """From a row of ``_TREE_SCHEMA``."""
        out = cls(None)
        out.feature, out.cut, out.left = (np.frombuffer(r[c], np.int64).tolist() for c in ("feature", "cut", "left"))
        out.gain, out.stats = np.frombuffer(r["gain"]).tolist(), list(np.frombuffer(r["stats"]).reshape(len(out.left), -1))
        return out

    def split(self, node: int, slot: int, cut: int, gain: float, left: np.ndarray) -> int:
        self.feature[node], self.cut[node], self.gain[node], self.left[node] = slot, cut, gain, len(self.left)
        for s in (left, self.stats[node] - left):
            self.feature.append(0), self.cut.append(0), self.left.append(-1), self.gain.append(-1.0), self.stats.append(s)
        return self.left[node]

    def shape(self, left: list[int] | None = None):
        return np.array(self.feature, np.int64), np.array(self.cut, np.int64), np.array(left or self.left, np.int32)

    def prediction(self, node: int, classes: int) -> float:
        s = self.stats[node]
        return float(s[1:].argmax()) if classes else float(s[2] / s[1]) if s[1] else 0.0

    def values(self) -> np.ndarray:
        """What a regression tree predicts in each node, below leaves that became one (``merged``) as above."""
        out, kept = np.array([self.prediction(v, 0) for v in range(len(self.left))]), self.merged(0)
        for v, a in enumerate(self.left):
            if a >= 0 and kept[v] < 0:
                out[a] = out[a + 1] = out[v]
        return out

    def merged(self, classes: int) -> list[int]:
        """Children per node after leaves of one parent that say the same became one, as Spark does."""
        left = list(self.left)
        for v in range(len(left) - 1, -1, -1):
            a = left[v]
            if a >= 0 and left[a] < 0 and left[a + 1] < 0 and self.prediction(a, classes) == self.prediction(a + 1, classes):
                left[v] = -1
        return left


def grow(blocks: DataFrame, bins: Bins, n_trees: int, depth: int, slots_per_node: int, least: int, least_gain: float,
         options: dict, write_every: int = CUT, totals: np.ndarray | None = None) -> list[Tree]:
    spark, options = blocks.sparkSession, {**options, "least": least}
    classes, held, made = options["classes"], [], []
    trees = [Tree(s) for s in (totals_of(blocks, n_trees, bins, options) if totals is None else totals)]
    root = [max(float(impurity(t.stats[0][1:], classes)), 0.0) if weight_of(t.stats[0][1:], classes) > 0 else 0.0 for t in trees]
    frontier = [(t, 0) for t in range(n_trees) if root[t] > 0]
    per_pass = max(1, PASS // int(np.sort(bins.count)[::-1][:slots_per_node].sum()))
    try:
        for level in range(depth):
            if not frontier:
                break
            shapes = [t.shape() for t in trees]
            if level and level % write_every == 0:
                made.append(spark.sparkContext.broadcast((bins, shapes)))
                blocks = write_down(blocks, made[-1], n_trees).persist()
                held.append(blocks)
            splits = []
            for start in range(0, len(frontier), per_pass):
                nodes = frontier[start:start + per_pass]
                drawn = [draw_slots(np.random.default_rng([options["seed"], 1, t, v]), bins.size, slots_per_node) for t, v in nodes]
                todo = Pass(nodes, drawn, np.array([trees[t].stats[v] for t, v in nodes]), bins)
                shared = spark.sparkContext.broadcast((todo, shapes))
                best = {}
                for r in best_cuts(add_up(blocks, shared, options), shared, options, len(todo.parts) - 1).collect():
                    one = (-r["gain"], r["slot"], r["cut"], r["left"])
                    best[r["node"]] = min(best.get(r["node"], one), one)
                shared.destroy()
                splits += [(*nodes[k], *best[k]) for k in sorted(best)]
            frontier = []
            for t, v, loss, slot, cut, left in splits:
                if -loss <= TINY * root[t] or -loss < least_gain:
                    continue
                child = trees[t].split(v, slot, cut, -loss, np.array(left))
                frontier += [(t, c) for c in (child, child + 1)
                             if impurity(trees[t].stats[c][1:], classes) > TINY * root[t]]
            # The blocks before the last places are no longer read.
            while len(held) > 1:
                held.pop(0).unpersist()
    finally:
        for b in held:
            b.unpersist()
        for b in made:
            b.destroy()
    return trees


# ---------------------------------------------------------------- boosting in one task

def grow_here(blocks: list[Rows], bins: Bins, tree: int, depth: int, slots_per_node: int, least: int, least_gain: float,
              options: dict) -> Tree:
    """``grow`` for one regression tree and blocks that lie in this process; afterwards their ``nodes`` tell
    each row's place."""
    xs = []
    for rows in blocks:
        times = rows.bag(tree, options["seed"], options["rate"], options["bootstrap"])
        y, w = rows.target(options, tree)
        xs.append([times, *stats_of(y, w * times, 0)])
        rows.nodes = np.zeros((tree + 1, rows.n), np.int32)
    made = Tree(sum(np.array([v.sum() for v in x]) for x in xs))
    # Without weights the number of rows is their weight: one sum serves for both.
    plain = all(np.array_equal(x[0], x[1]) for x in xs)
    xs = [x[plain:] for x in xs]
    root = float(impurity(made.stats[0][1:], 0)) if made.stats[0][1] > 0 else 0.0
    frontier = [0] if root > 0 else []
    per_pass = max(1, PASS // int(np.sort(bins.count)[::-1][:slots_per_node].sum()))
    for _ in range(depth):
        if not frontier:
            break
        splits = []
        for start in range(0, len(frontier), per_pass):
            nodes = frontier[start:start + per_pass]
            drawn = [draw_slots(np.random.default_rng([options["seed"], 1, tree, v]), bins.size, slots_per_node) for v in nodes]
            todo = Pass([(tree, v) for v in nodes], drawn, np.array([made.stats[v] for v in nodes]), bins)
            sums = np.zeros((4 - plain, int(todo.start[-1])))
            place = np.full(len(made.left), -1, np.int64)
            place[nodes] = np.arange(len(nodes))
            for rows, x in zip(blocks, xs):
                own = place[rows.nodes[tree]]
                own[x[0] == 0] = -1
                add_tree(sums, todo, rows, own, 0, len(nodes), x)
            sums = np.concatenate([sums[:1], sums]) if plain else sums
            found = [f for part in range(len(todo.parts) - 1)
                     for f in cuts_in(todo, part, sums[:, todo.start[todo.parts[part]]:todo.start[todo.parts[part + 1]]], 0, least)]
            if found:
                splits += [(nodes[k], *cut) for k, *cut in zip(*best_of(found))]
        frontier = []
        for v, slot, cut, gain, left in splits:
            if gain <= TINY * root or gain < least_gain:
                continue
            child = made.split(v, int(slot), int(cut), float(gain), left)
            frontier += [c for c in (child, child + 1) if impurity(made.stats[c][1:], 0) > TINY * root]
        shape = made.shape()
        for rows in blocks:
            rows.nodes[tree] = rows.place(tree, shape)
    return made


def boost_here(written: DataFrame, bins: Bins, n_trees: int, tree, weights: list[float], options: list[dict],
               every: int | None = None) -> tuple[list[list[Tree]], list[float]]:
    """(the trees of each round, the mean log-loss of softmax after every ``every`` rounds and the last): ``boost`` in
    one task, for blocks that fit into one.  A round of small tables takes less than the jobs of its levels."""
    depth, least, least_gain = tree.getMaxDepth(), tree.getMinInstancesPerNode(), tree.getMinInfoGain()
    m = slots_for(tree.getFeatureSubsetStrategy(), bins.size, 1, False)

    def work(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = sorted(blocks_of(it, bins), key=lambda rows: rows.id)
        for turn, option in enumerate(options):
            more = [np.zeros((n_trees, rows.n)) for rows in blocks]
            for k in range(n_trees):
                made = grow_here(blocks, bins, k, depth, m, least, least_gain, option)
                value = weights[turn] * made.values()
                for add, rows in zip(more, blocks):
                    add[k] = value[rows.nodes[k]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([turn], pa.int32()), pa.array([k], pa.int32()), pa.array([None], pa.float64()),
                     *[pa.array([np.array(a, kind).tobytes()], pa.binary()) for a, kind in (
                         (made.feature, np.int64), (made.cut, np.int64), (made.left, np.int64), (made.gain, float), (made.stats, float))]],
                    _TREE_NAMES)
            for add, rows in zip(more, blocks):
                rows.margin = add if rows.margin is None else rows.margin + add
            if every and ((turn + 1) % every == 0 or turn + 1 == len(options)):
                loss = sum(rows.loss() for rows in blocks) / sum(rows.n for rows in blocks)
                yield pa.RecordBatch.from_arrays([pa.array([turn], pa.int32()), pa.array([None], pa.int32()), pa.array([loss]),
                                                  *[pa.array([None], pa.binary())] * 5], _TREE_NAMES)

    trees, losses = [[None] * n_trees for _ in options], {}
    for r in written.repartition(1).mapInArrow(work, _TREE_SCHEMA).collect():
        if r["tree"] is None:
            losses[r["turn"]] = r["loss"]
        else:
            trees[r["turn"]][r["tree"]] = Tree.of(r)
    return trees, [losses[k] for k in sorted(losses)]


# ---------------------------------------------------------------- Spark's models

def _node_table(trees: list[Tree], bins: Bins, classes: int) -> pa.Table:
    tree, rows = [], []
    for k, t in enumerate(trees):
        left = t.merged(classes)
        number, order = {0: 0}, [0]
        for v in order:
            if left[v] >= 0:
                for c in (left[v], left[v] + 1):
                    number[c] = len(order)
                    order.append(c)
        for v in order:
            s, inner = t.stats[v], left[v] >= 0
            rows.append({"id": number[v], "prediction": t.prediction(v, classes),
                         "impurity": float(impurity(s[1:], classes)), "impurityStats": s[1:].tolist(), "rawCount": int(round(s[0])),
                         "gain": t.gain[v] if inner else -1.0, "leftChild": number[left[v]] if inner else -1,
                         "rightChild": number[left[v] + 1] if inner else -1,
                         "split": {"featureIndex": int(t.feature[v]) if inner else -1,
                                   "leftCategoriesOrThreshold": [bins.cut_value(t.feature[v], t.cut[v])] if inner else [],
                                   "numCategories": -1}})
            tree.append(k)
    kind = pa.struct([("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()),
                      ("impurityStats", pa.list_(pa.float64())), ("rawCount", pa.int64()), ("gain", pa.float64()),
                      ("leftChild", pa.int32()), ("rightChild", pa.int32()),
                      ("split", pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())),
                                           ("numCategories", pa.int32())]))])
    return pa.table({"treeID": pa.array(tree, pa.int32()), "nodeData": pa.array(rows, kind)})


def as_spark_model(spark, estimator, trees: list[Tree], bins: Bins, classes: int, weights: list[float] | None = None) -> Model:
    """The trees as the model that ``estimator`` fits: written in its saved form and loaded."""
    from pyspark.ml import classification as C
    from pyspark.ml import regression as R
    cls = {"RandomForestClassifier": C.RandomForestClassificationModel, "RandomForestRegressor": R.RandomForestRegressionModel,
           "GBTClassifier": C.GBTClassificationModel, "GBTRegressor": R.GBTRegressionModel}[type(estimator).__name__]
    home = "org.apache.spark.ml."
    one = home + ("classification.DecisionTreeClassificationModel" if classes else "regression.DecisionTreeRegressionModel")
    kind = f"{cls.__module__.split('.')[-1]}.{cls.__name__}"
    own = {p.name: v for p, v in estimator._paramMap.items()}
    default = {p.name: v for p, v in estimator._defaultParamMap.items()}

    def document(name: str, uid: str, only: set = own.keys() | default.keys(), **extra) -> str:
        return json.dumps({"class": name, "timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "uid": uid,
                           "paramMap": {k: v for k, v in own.items() if k in only},
                           "defaultParamMap": {k: v for k, v in default.items() if k in only}, **extra})

    counts = {"numFeatures": bins.size, **({"numClasses": classes} if classes else {})}
    weights = weights or [1.0] * len(trees)
    path = scratch_path(spark, "forest")
    whole = document(home + kind, estimator.uid, numTrees=len(trees), **counts)
    spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    of_tree = {"cacheNodeIds", "checkpointInterval", "featuresCol", "impurity", "labelCol", "leafCol", "maxBins", "maxDepth", "maxMemoryInMB",
               "minInfoGain", "minInstancesPerNode", "minWeightFractionPerNode", "predictionCol", "seed"}
    spark.createDataFrame([(k, document(one, f"{estimator.uid}_{k}", of_tree), weights[k]) for k in range(len(trees))],
                          "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    spark.createDataFrame(_node_table(trees, bins, classes)).write.parquet(f"{path}/data")
    model = cls.load(path)  # the driver holds it: its files go
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    return model


def slots_for(strategy: str, size: int, n_trees: int, classification: bool) -> int:
    """Slots drawn for a node, by the names that Spark gives the strategies."""
    if strategy == "auto":
        strategy = "all" if n_trees == 1 else "sqrt" if classification else "onethird"
    named = {"all": size, "sqrt": math.ceil(math.sqrt(size)), "log2": max(1, math.ceil(math.log2(size))), "onethird": math.ceil(size / 3)}
    if strategy in named:
        return named[strategy]
    return min(int(strategy), size) if strategy.isdigit() else max(1, math.ceil(float(strategy) * size))


def _packed(rows: DataFrame, estimator, label, margins: int = 0, small: bool = False,
            fine: int = 0) -> tuple[Bins, DataFrame, float, int, bool] | None:
    """(bins, written blocks, greatest label, number of rows, whether the blocks fit into one task); None if Spark's
    learner has to do it, as it does for small tables unless these are asked for by ``small``, with ``fine`` bins a slot."""
    weight = estimator.getWeightCol() if estimator.isSet("weightCol") else None
    rows = rows.select(label.cast("double").alias("label"), "features",
                       (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("weight"))
    hot, nominal = attributes(rows)
    if nominal or estimator.getMaxBins() > 255:
        return None
    top = rows.agg(F.count(F.lit(1)).alias("n"), F.max("label").alias("top")).first()
    if not top["n"]:
        raise ValueError("no rows to fit")
    size = rows.select(vector_size("features")).first()[0]
    cells = top["n"] * size
    if cells <= DENSE and not small:
        return None
    most_bins = fine if fine and cells <= DENSE else estimator.getMaxBins()
    bins = Bins(size, hot, *find_cuts(rows, top["n"], hot, most_bins, estimator.getSeed()))
    written = stable(pack(rows, bins, margins))
    alone = cells <= WIDE * DENSE and top["n"] <= ALONE_ROWS and ALONE >= written.agg(F.sum(sum(
        F.length(c) for c in ("row", "bins", "dense", "slots", "ends")))).first()[0]
    return bins, written, top["top"], top["n"], alone


def _held(written: DataFrame, n_rows: int) -> DataFrame:
    """The blocks, cached, dealt evenly to the cores: every level waits for its fullest task."""
    return written.repartition(max(written.sparkSession.sparkContext.defaultParallelism, n_rows // (64 * BLOCK))).persist()


def fit_forest(rows: DataFrame, estimator, classification: bool) -> Model:
    """What ``estimator`` (a forest of ``pyspark.ml``) fits to label, features and, if it has one, its weight column."""
    if (packed := _packed(rows, estimator, F.col("label"))) is None:
        return estimator.fit(rows)
    bins, written, top, n_rows, _ = packed
    classes = max(int(top) + 1, 2) if classification else 0
    blocks = _held(written, n_rows)
    try:
        trees = grow(blocks, bins, estimator.getNumTrees(), estimator.getMaxDepth(),
                     slots_for(estimator.getFeatureSubsetStrategy(), bins.size, estimator.getNumTrees(), classification),
                     estimator.getMinInstancesPerNode(), estimator.getMinInfoGain(),
                     {"classes": classes, "seed": estimator.getSeed() % (1 << 62), "rate": estimator.getSubsamplingRate(),
                      "bootstrap": estimator.getBootstrap(), "loss": None})
    finally:
        blocks.unpersist()
        drop_stable(written)
    return as_spark_model(rows.sparkSession, estimator, trees, bins, classes)


def fit_boosted(rows: DataFrame, estimator, classification: bool) -> Model:
    """What ``estimator`` (a booster of ``pyspark.ml``) fits, by squared loss or, for labels 0 and 1, logistic loss."""
    label = F.col("label")
    if not classification and estimator.getLossType() != "squared" or (
            packed := _packed(rows, estimator, 2 * label - 1 if classification else label, small=True)) is None:
        return estimator.fit(rows)
    bins, written, _, n_rows, alone = packed
    seed, most = estimator.getSeed(), estimator.getMaxIter()
    weights = [1.0] + [estimator.getStepSize()] * (most - 1)
    options = [{"classes": 0, "seed": (seed + turn) % (1 << 62), "rate": estimator.getSubsamplingRate(),
                "bootstrap": False, "loss": "logistic" if classification else "squared"} for turn in range(most)]
    if alone:
        try:
            trees, _ = boost_here(written, bins, 1, estimator, weights, options)
        finally:
            drop_stable(written)
    else:
        trees, _ = boost(written, n_rows, bins, 1, estimator, weights, classification, options)
    return as_spark_model(rows.sparkSession, estimator, [t for t, in trees], bins, 0, weights)


def boost(written: DataFrame, n_rows: int, bins: Bins, n_trees: int, tree, weights: list[float], classification: bool,
          options: list[dict], after_round=None) -> tuple[list[list[Tree]], list]:
    """(the trees of each round, what ``after_round`` makes of the blocks of the rounds whose margins
    are written): a round adds the last trees to the margins and grows ``n_trees`` at once, one a margin."""
    blocks, base, trees, made = _held(written, n_rows), written, [], []
    try:
        for turn, option in enumerate(options):
            totals = totals_of(blocks, n_trees, bins, option) if not trees else totals
            trees.append(grow(blocks, bins, n_trees, tree.getMaxDepth(),
                              slots_for(tree.getFeatureSubsetStrategy(), bins.size, 1, classification),
                              tree.getMinInstancesPerNode(), tree.getMinInfoGain(), option, MOST_LEVELS, totals))
            after, last = step(blocks, bins, trees[-1], weights[turn]), turn + 1 == len(options)
            if last and not after_round:
                break
            if cut := (turn + 1) % ROUNDS == 0 or last:
                after = stable(after)
                drop_stable(base)
                base = after
            after = _held(after, n_rows) if cut else after.persist()
            try:
                if cut and after_round:
                    made.append(after_round(after))
                if not last:  # this also makes the new margins, before what they are made of goes
                    totals = totals_of(after, n_trees, bins, options[turn + 1])
            finally:
                blocks.unpersist()
                blocks = after
    finally:
        blocks.unpersist()
        drop_stable(base)
    return trees, made


def fit_softmax(rows: DataFrame, tree, classes: int, rounds: int, rate: float, floor: float, every: int) -> tuple[list[Model], list[float]] | None:
    """(a booster for each class's margin, mean log-loss at every ``every`` rounds, or beyond one task ``ROUNDS``, and
    the last): a round fits one tree a class, with the options of ``tree``, to the working responses of
    ``operators/boosting.py``, all classes in one task or one job a level.  The cuts are placed once, not by every
    round's weights; on small tables so finely that each round finds its own among them.  None if Spark's learner
    has to do it."""
    if (packed := _packed(rows, tree, F.col("label"), classes, small=True, fine=255)) is None:
        return None
    bins, written, _, n_rows, alone = packed

    def loss(blocks: DataFrame) -> float:
        def work(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for r in blocks_of(it, bins):
                yield pa.RecordBatch.from_arrays([pa.array([r.n]), pa.array([r.loss()])], ["n", "s"])

        return float(blocks.mapInArrow(work, "n long, s double").agg(F.sum("s") / F.sum("n")).first()[0])

    options = [{"classes": 0, "seed": (tree.getSeed() + turn) % (1 << 62), "rate": tree.getSubsamplingRate(),
                "bootstrap": False, "loss": "softmax", "floor": floor} for turn in range(rounds)]
    if alone:
        try:
            grown, losses = boost_here(written, bins, classes, tree, [rate] * rounds, options, every)
        finally:
            drop_stable(written)
    else:
        grown, losses = boost(written, n_rows, bins, classes, tree, [rate] * rounds, False, options, loss)
    like = GBTRegressor(maxDepth=tree.getMaxDepth(), maxIter=rounds, stepSize=rate, seed=tree.getSeed())

    @inheritable_thread_target(rows.sparkSession)
    def model(k: int) -> Model:
        return as_spark_model(rows.sparkSession, like, [t[k] for t in grown], bins, 0, [rate] * rounds)

    with ThreadPool(min(classes, 3)) as pool:
        return pool.map(model, range(classes), chunksize=1), losses


def fit_one_vs_rest(rows: DataFrame, estimator) -> Model:
    """What ``estimator`` (one-vs-rest over a booster) fits: a booster for each class."""
    classes = max(int(rows.agg(F.max("label")).first()[0]) + 1, 2)

    @inheritable_thread_target(rows.sparkSession)
    def one(k: int) -> Model:
        return fit_boosted(rows.withColumn("label", (F.col("label") == k).cast("double")), estimator.getClassifier(), True)

    with ThreadPool(min(estimator.getParallelism(), classes)) as pool:
        model = OneVsRestModel(models=pool.map(one, range(classes), chunksize=1))
    model._resetUid(estimator.uid)
    return estimator._copyValues(model)
