"""Randomly split trees, random forests and boosted trees on Spark, for data that stay in their partitions.

* **Extra trees.** Every node draws one threshold per feature, evenly between the smallest and the largest value among its
  rows, and keeps the one that lowers the squared error most. All trees grow together: per level one aggregate brings
  the range of every (tree, node, feature), and one the rows and target sums below the drawn thresholds. Tasks add up what
  they hold before the shuffle; what comes to the driver is as large as the level of the model. Draws depend on (seed,
  tree, node, feature) alone. A task compares ranks within blocks of its rows, not values, and orders a block by node once
  for each tree, so that a row costs each tree some ten short runs over arrays a level.
* **Random forests.** Features are binned; per level the tasks add up rows and sums by (tree, node, feature, bin), and the
  histograms of a node meet in one task, which names its best split. How often a tree's sample has a row depends on the row's
  key and the tree alone, so no counts are kept.
* **Boosted trees.** Features are binned once; trees grow leaf by leaf, the best gain first, up to a number of leaves or a
  depth. A histogram holds rows and residual sums by (leaf, feature, bin); only the smaller child of a split is counted,
  its sibling is the parent less the child. Hundreds of rounds of a few steps each would read the rows and replay the trees
  as often, so all of it is one job in barrier mode: its tasks, one for every 250,000 rows, keep their rows and exchange
  histograms, and all settings move in step and share each exchange. An exchange holds the histograms of the few leaves
  in question, never rows. Spark's barrier is polled once a second, too slow for thousands of exchanges, so the tasks leave
  their histograms as files in the shared folder; the barrier carries them only where tasks can't read each other's files.
  If a task is lost, Spark starts the stage again, with files of its own.

Rows need no order and no index; subsamples depend on a hash of the row's key and the round, so partitioning changes
nothing but the last bits of sums.
"""

from __future__ import annotations

import base64
import hashlib
import pickle
import time
import uuid
from collections.abc import Generator, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import BarrierTaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crivo.session import checkpoint_folder

BINS = 128
BLOCK_ROWS = 65_535  # of a task that are worked on at once: ranks within them fit 16 bits
FOREST_BINS = 32
HISTOGRAMS = 1_000  # sent at once
POISSON = [float(x) for x in np.cumsum(1 / np.e / np.cumprod(np.maximum(np.arange(18), 1)))]  # shares of at most 0, 1, ... times
ROWS_PER_TASK = 250_000
PATIENCE = 3600  # seconds a task waits for the others' histograms


# === trees ==============================================================================================


@dataclass
class Trees:
    """Trees as arrays by (tree, node): a row goes on to `left` if its `feature` is at most `threshold`, else to `left` + 1.
    Leaves have feature -1."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    value: np.ndarray

    def places(self, x: np.ndarray, depth: int) -> np.ndarray:
        """The node of each row in each tree after `depth` steps, as (tree, row)."""
        trees = np.arange(len(self.feature))[:, None]
        node = np.zeros((len(self.feature), len(x)), np.int64)
        rows = np.arange(len(x))[None, :]
        for _ in range(depth):
            f = self.feature[trees, node]
            right = x[rows, np.maximum(f, 0)] > self.threshold[trees, node]
            node = np.where(f >= 0, self.left[trees, node] + right, node)
        return node

    def predict(self, x: np.ndarray, depth: int) -> np.ndarray:
        """The values that each tree gives each row."""
        return self.value[np.arange(len(self.feature))[:, None], self.places(x, depth)]


def matrix(batch: pa.RecordBatch, names: Sequence[str]) -> np.ndarray:
    if not names:
        return np.zeros((batch.num_rows, 0))
    return np.column_stack([batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False) for n in names])


# === extra trees ========================================================================================


def drawn(seed: int, tree: int, node: int, feature: int) -> float:
    """Between 0 and 1, from the name of the draw."""
    return int(hashlib.md5(f"{seed}-{tree}-{node}-{feature}".encode()).hexdigest()[:8], 16) / 2**32


@dataclass
class Level:
    """One level of all trees: which nodes are still open, and what is known of them."""

    trees: Trees
    depth: int
    open: np.ndarray  # (tree, node), true where a node may be split
    threshold: np.ndarray | None = None  # (tree, node, feature)

    def places(self, tree: int, block: Block, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(slot of each row of the block in a tree, node of each slot). `cut` has the split of each (tree, node) in ranks.
        A split is one comparison over the whole block and a few operations on bits."""
        feature, left = self.trees.feature[tree], self.trees.left[tree]
        rows = block.ranks.shape[1]
        slot, under = np.zeros(rows, np.min_scalar_type(2**self.depth - 1)), np.empty(rows, bool)
        level = [(0, 0, np.packbits(np.ones(rows, bool)))]  # node, its slot, its rows as bits
        for step in reversed(range(self.depth)):
            below, right = [], np.zeros_like(level[0][2])
            for node, at, inside in level:
                if feature[node] < 0:
                    continue
                np.less(block.ranks[feature[node]], cut[tree, node], out=under)
                stay = np.packbits(under) & inside
                go = stay ^ inside
                right |= go
                below += [(left[node], at, stay), (left[node] + 1, at | 1 << step, go)]
            if not below:
                return slot, np.full(2**self.depth, -1)
            slot += slot
            slot |= np.unpackbits(right, count=rows)
            level = below
        nodes = np.full(2**self.depth, -1)
        for node, at, _ in level:
            nodes[at] = node
        return slot, nodes


class Block:
    """Some rows of a task with each feature as its rank among the block's values: ranks are small, and `value <= threshold` is
    `rank < cut(threshold)`, exactly. With edges given, the bin takes the rank's place."""

    def __init__(self, x: np.ndarray, y: np.ndarray, keys: np.ndarray | None, edges: list[np.ndarray] | None):
        self.y, self.keys, self.values = y, keys, edges or []
        self.ranks = np.empty(x.shape[::-1], np.uint8 if edges else np.uint16)
        for f in range(x.shape[1]):
            if edges:
                self.ranks[f] = edges[f].searchsorted(x[:, f], "left")
            else:
                values, self.ranks[f] = np.unique(x[:, f], return_inverse=True)
                self.values.append(values)

    def cut(self, feature: int, threshold: np.ndarray) -> np.ndarray:
        return self.values[feature].searchsorted(threshold, "right").astype(np.uint16)


def blocks(batches: Iterator[pa.RecordBatch], inputs: list[str], edges: list[np.ndarray] | None = None) -> Iterator[Block]:
    """The rows in blocks; with edges, their keys too."""

    def block() -> Block:
        together = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        keys = together.column(together.schema.get_field_index("key")).to_numpy().view(np.uint64) if edges else None
        return Block(matrix(together, inputs), matrix(together, ["target"])[:, 0], keys, edges)

    held: list[pa.RecordBatch] = []
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(start, BLOCK_ROWS)
            if held and sum(h.num_rows for h in held) + part.num_rows > BLOCK_ROWS:
                yield block()
                held = []
            held.append(part)
    if held:
        yield block()


def _partial(level: Level, inputs: list[str], ranges: bool):
    """Per task: what it holds of every (tree, node, feature), `low` and `high` or rows and sums below the threshold. Within a
    block the rows of a tree are ordered by node, so that each node's are reduced in one run."""
    trees, many = level.trees, len(inputs)
    splits = np.nonzero(trees.feature >= 0)
    split_by = [tuple(i[trees.feature[splits] == f] for i in splits) for f in range(many)]
    open_ = np.nonzero(level.open)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape = (many, *level.open.shape)
        a, b = (np.full(shape, np.inf), np.full(shape, -np.inf)) if ranges else (np.zeros(shape), np.zeros(shape))
        cut, limit = np.zeros(level.open.shape, np.uint16), np.zeros(shape, np.uint16)
        rooms = [np.empty(BLOCK_ROWS, t) for t in (np.uint16, float, float, float)]
        for block in blocks(batches, inputs):
            # Written to again for each tree and feature: they stay in the cache, as new arrays would not.
            held, y, under, part = (r[: len(block.y)] for r in rooms)
            for f in range(many):
                cut[split_by[f]] = block.cut(f, trees.threshold[split_by[f]])
                if not ranges:
                    limit[f][open_] = block.cut(f, level.threshold[(*open_, f)])
            if level.depth == 0:
                # All trees begin with one node of all rows: nothing is ordered by node.
                for f, values in enumerate(block.values):
                    if ranges:
                        a[f], b[f] = np.minimum(a[f], values[0]), np.maximum(b[f], values[-1])
                    else:
                        for out, weights in ((a, None), (b, block.y)):
                            up_to = np.bincount(block.ranks[f], weights).cumsum()
                            out[f] += np.concatenate([[0.0], up_to])[limit[f]]
                continue
            for tree in np.flatnonzero(level.open.any(1)):
                slot, nodes = level.places(tree, block, cut)
                order, count = np.argsort(slot, kind="stable"), np.bincount(slot, minlength=len(nodes))
                there = np.flatnonzero(count)
                starts, at, count = (count.cumsum() - count)[there], nodes[there], count[there]
                known = np.flatnonzero(level.open[tree, at] & (at >= 0))
                place = at[known]
                if not ranges:
                    np.take(block.y, order, out=y, mode="clip")
                for f, values in enumerate(block.values):
                    np.take(block.ranks[f], order, out=held, mode="clip")
                    if ranges:
                        low, high = (values[r.reduceat(held, starts)[known]] for r in (np.minimum, np.maximum))
                        a[f, tree, place] = np.minimum(a[f, tree, place], low)
                        b[f, tree, place] = np.maximum(b[f, tree, place], high)
                    else:
                        np.less(held, np.repeat(limit[f, tree, at], count), out=under)
                        a[f, tree, place] += np.add.reduceat(under, starts)[known]
                        b[f, tree, place] += np.add.reduceat(np.multiply(under, y, out=part), starts)[known]
        f, tree, node = np.nonzero(np.isfinite(a) if ranges else a > 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(tree), pa.array(node), pa.array(f), pa.array(a[f, tree, node]), pa.array(b[f, tree, node])],
            names=["tree", "node", "feature", "a", "b"],
        )

    return partial


PARTIAL = "tree bigint, node bigint, feature bigint, a double, b double"


def node_ranges(train: DataFrame, level: Level, inputs: list[str]) -> DataFrame:
    """(tree, node, feature, low, high) over the rows of each open node."""
    parts = train.select(*inputs, "target").mapInArrow(_partial(level, inputs, True), PARTIAL)
    return parts.groupBy("tree", "node", "feature").agg(F.min("a").alias("low"), F.max("b").alias("high"))


def split_sums(train: DataFrame, level: Level, inputs: list[str]) -> DataFrame:
    """(tree, node, feature, rows, total) of the rows at or below each open node's thresholds."""
    parts = train.select(*inputs, "target").mapInArrow(_partial(level, inputs, False), PARTIAL)
    return parts.groupBy("tree", "node", "feature").agg(F.sum("a").alias("rows"), F.sum("b").alias("total"))


def _array(df: DataFrame, shape: tuple[int, ...], names: Sequence[str], missing: float) -> list[np.ndarray]:
    """Collected rows (tree, node, feature, ...) as arrays: as many as the level has (node, feature) pairs."""
    found = df.toArrow()
    at = tuple(found.column(c).to_numpy() for c in ("tree", "node", "feature"))
    out = []
    for name in names:
        array = np.full(shape, missing)
        array[at] = found.column(name).to_numpy()
        out.append(array)
    return out


def first_level(trees: int) -> Level:
    blank = Trees(*[np.full((trees, 1), v) for v in (-1, 0.0, -1, 0.0)])
    return Level(blank, 0, np.ones((trees, 1), bool))


def with_thresholds(train: DataFrame, level: Level, inputs: list[str], seed: int) -> np.ndarray:
    """Draws the thresholds of a level; returns where a feature varies within its node."""
    shape = (*level.open.shape, len(inputs))
    low, high = _array(node_ranges(train, level, inputs), shape, ("low", "high"), np.nan)
    level.threshold = np.zeros(shape)
    varies = high > low
    for t, n, f in zip(*np.nonzero(varies)):
        level.threshold[t, n, f] = low[t, n, f] + drawn(seed, t, n, f) * (high[t, n, f] - low[t, n, f])
    return varies


def extra_trees(train: DataFrame, inputs: list[str], trees: int, depth: int, min_leaf: int, seed: int) -> Trees:
    """Trees grown on (inputs, target). A node is split where both sides keep `min_leaf` rows."""
    whole = train.agg(F.count(F.lit(1)), F.sum("target")).first()
    level = first_level(trees)
    rows, total = np.full((trees, 1), float(whole[0])), np.full((trees, 1), float(whole[1]))
    level.trees.value[:] = whole[1] / whole[0]
    for step in range(depth):
        if not level.open.any():
            break
        varies = with_thresholds(train, level, inputs, seed)
        shape = (*level.open.shape, len(inputs))
        n, s = _array(split_sums(train, level, inputs), shape, ("rows", "total"), 0.0)
        m, r = rows[:, :, None] - n, total[:, :, None] - s
        allowed = varies & (n >= min_leaf) & (m >= min_leaf)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where(allowed, s * s / n + r * r / m, -np.inf)
        best = gain.argmax(2)
        at = np.indices(best.shape)
        split = level.open & np.isfinite(gain[*at, best])
        level, rows, total = _next(level, best, split, (n, s), (rows, total))
    return level.trees


def _next(level: Level, best: np.ndarray, split: np.ndarray, below: tuple, whole: tuple) -> tuple[Level, np.ndarray, np.ndarray]:
    """The trees with the splits taken; children stand behind the nodes there are, a pair for each split."""
    t, width = level.open.shape[0], level.open.shape[1]
    count = split.sum(1)
    room = width + 2 * int(count.max(initial=0))
    order = np.cumsum(split, 1) - 1
    tree, node = np.nonzero(split)
    left = width + 2 * order[tree, node]
    f = best[tree, node]

    def wider(a: np.ndarray, blank: float) -> np.ndarray:
        out = np.full((t, room), blank, a.dtype)
        out[:, :width] = a
        return out

    trees = Trees(wider(level.trees.feature, -1), wider(level.trees.threshold, 0.0), wider(level.trees.left, -1), wider(level.trees.value, 0.0))
    trees.feature[tree, node], trees.left[tree, node] = f, left
    trees.threshold[tree, node] = level.threshold[tree, node, f]
    rows, total = (wider(a, 0.0) for a in whole)
    for out, part, all_of in zip((rows, total), below, whole):
        out[tree, left] = part[tree, node, f]
        out[tree, left + 1] = all_of[tree, node] - part[tree, node, f]
    new = np.zeros((t, room), bool)
    new[tree, left] = new[tree, left + 1] = True
    trees.value[new] = total[new] / rows[new]
    return Level(trees, level.depth + 1, new), rows, total


# === random forests =====================================================================================


def bagged(keys: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often a tree's sample with replacement has each row: Poisson numbers of mean 1, from the row's key and the tree."""
    share, times = mixed(keys, seed * 100_003 + tree), np.zeros(len(keys), np.uint8)
    for most in POISSON:
        times += share >= most
    return times


def _histograms(level: Level, inputs: list[str], edges: list[np.ndarray], bins: int, seed: int):
    """Per task: rows and sums of its sample by (feature, bin) for each open (tree, node)."""
    trees, many = level.trees, len(inputs)
    splits = np.nonzero(trees.feature >= 0)
    cut = np.zeros(trees.feature.shape, np.uint8)
    for f in range(many):
        by = tuple(i[trees.feature[splits] == f] for i in splits)
        cut[by] = edges[f].searchsorted(trees.threshold[by], "right")
    place = np.full(level.open.shape, -1)
    place[level.open] = np.arange(level.open.sum())

    def histograms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((level.open.sum(), 2, many, bins))
        for block in blocks(batches, inputs, edges):
            for tree in np.flatnonzero(level.open.any(1)):
                times = bagged(block.keys, int(tree), seed)
                slot, nodes = level.places(tree, block, cut)
                at, slots = place[tree, nodes], len(nodes)
                open_ = (nodes >= 0) & (at >= 0)
                start, weight = slot.astype(np.int64) * bins, times.astype(float)
                sums = (weight, weight * block.y)
                for f in range(many):
                    cell = start + block.ranks[f]
                    for i, of in enumerate(sums):
                        held[at[open_], i, f] += np.bincount(cell, of, minlength=slots * bins).reshape(slots, bins)[open_]
        tree, node = np.nonzero(level.open)
        seen = np.flatnonzero(held[:, 0, 0].any(1))
        for start in range(0, len(seen), HISTOGRAMS):
            part = seen[start : start + HISTOGRAMS]
            yield pa.RecordBatch.from_arrays(
                [pa.array(tree[part]), pa.array(node[part]), pa.array([h.tobytes() for h in held[part]], pa.binary())],
                names=["tree", "node", "histogram"],
            )

    return histograms


def _best_splits(many: int, bins: int, setting: Boosting):
    """Adds the tasks' histograms of each (tree, node) and takes its best split, feature -1 where there is none."""

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, np.ndarray] = {}
        for batch in batches:
            for tree, node, part in zip(*(batch.column(i).to_pylist() for i in range(3))):
                known = held.setdefault((tree, node), np.zeros((2, many, bins)))
                known += np.frombuffer(part).reshape(known.shape)
        out = []
        for (tree, node), histogram in held.items():
            rows, total = histogram[:, 0].sum(1)
            leaf = Leaf(histogram, rows, total, 0, node)
            _, f, b = (best_split(leaf, np.arange(many), setting) if rows else None) or (0.0, -1, 0)
            out.append((tree, node, f, b, rows, total, *histogram[:, f, : b + 1].sum(1)))
        columns = list(zip(*out)) or [()] * 8
        kinds = [pa.int64()] * 4 + [pa.float64()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=BEST_COLUMNS)

    return best


BEST_COLUMNS = ["tree", "node", "feature", "bin", "rows", "total", "rows_below", "total_below"]
BEST = ", ".join(f"{c} {'bigint' if i < 4 else 'double'}" for i, c in enumerate(BEST_COLUMNS))


def random_forest(train: DataFrame, inputs: list[str], trees: int, depth: int, min_leaf: int, seed: int, bins: int = FOREST_BINS) -> Trees:
    """Trees grown on (id, date, inputs, target), each on a sample with replacement. A node is split where its squared error falls
    most, between any two of `bins` bins of any feature, if both sides keep `min_leaf` rows of the sample."""
    edges = bin_edges(train, inputs, bins)
    keyed = train.select(*inputs, "target", F.xxhash64("id", "date").alias("key"))
    setting = Boosting(1, 1.0, 2, 1, min_leaf)
    level = first_level(trees)
    for step in range(depth):
        if not level.open.any():
            break
        parts = keyed.mapInArrow(_histograms(level, inputs, edges, bins, seed), "tree bigint, node bigint, histogram binary")
        found = parts.repartition("tree", "node").mapInArrow(_best_splits(len(inputs), bins, setting), BEST).toArrow()
        tree, node, feature, at, *sums = (found.column(c).to_numpy() for c in BEST_COLUMNS)
        shape = (*level.open.shape, len(inputs))
        level.threshold = np.zeros(shape)
        rows, total, n, s = np.zeros(shape[:2]), np.zeros(shape[:2]), np.zeros(shape), np.zeros(shape)
        best, split = np.zeros(shape[:2], np.int64), np.zeros(shape[:2], bool)
        rows[tree, node], total[tree, node] = sums[:2]
        if step == 0:
            level.trees.value[tree, node] = total[tree, node] / rows[tree, node]
        best[tree, node], split[tree, node] = np.maximum(feature, 0), feature >= 0
        for t, node_, f, b, below, sum_below in zip(tree, node, feature, at, *sums[2:]):
            if f >= 0:
                level.threshold[t, node_, f], n[t, node_, f], s[t, node_, f] = edges[f][b], below, sum_below
        level, _, _ = _next(level, best, split, (n, s), (rows, total))
    return level.trees


def mean_of(trees: Trees, today: DataFrame, inputs: list[str], depth: int) -> DataFrame:
    """`today` (id, date, inputs) with the mean of all trees as predicted_return."""

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mean = trees.predict(matrix(batch, inputs), depth).mean(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(mean)], names=["id", "date", "predicted_return"])

    kinds = {n: t for n, t in today.dtypes}
    return today.select("id", "date", *inputs).mapInArrow(predicted, f"id {kinds['id']}, date {kinds['date']}, predicted_return double")


# === boosted trees ======================================================================================


@dataclass(frozen=True)
class Boosting:
    """A setting: trees stop at `leaves` or at `depth`; each uses a share of rows and of features."""

    rounds: int
    rate: float
    leaves: int
    depth: int
    min_leaf: int = 1
    rows: float = 1.0
    features: float = 1.0
    seed: int = 42


@dataclass(eq=False)
class Leaf:
    histogram: np.ndarray | None  # (2, feature, bin): rows, sums
    rows: float
    total: float
    depth: int
    node: int
    at: np.ndarray | None = None  # the task's rows
    best: tuple[float, int, int] | None = None  # gain, feature, bin
    children: list[Leaf] = field(default_factory=list)


def mixed(keys: np.ndarray, turn: int) -> np.ndarray:
    """Between 0 and 1 for each key, other numbers each turn."""
    z = keys.astype(np.uint64) + np.uint64((turn * 0x9E3779B97F4A7C15) % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z ^= z >> np.uint64(shift)
        z *= np.uint64(factor)
    return (z >> np.uint64(11)).astype(np.float64) / 2**53


def best_split(leaf: Leaf, features: np.ndarray, setting: Boosting) -> tuple[float, int, int] | None:
    """(gain, feature, bin) of the split that lowers the squared error most, ties to the first feature and bin."""
    rows, sums = leaf.histogram[:, features].cumsum(2)[:, :, :-1]
    others = leaf.rows - rows
    allowed = (rows >= setting.min_leaf) & (others >= setting.min_leaf)
    if not allowed.any():
        return None
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(allowed, sums**2 / rows + (leaf.total - sums) ** 2 / others, -np.inf) - leaf.total**2 / leaf.rows
    f, b = np.unravel_index(gain.argmax(), gain.shape)
    return (float(gain[f, b]), int(features[f]), int(b)) if gain[f, b] > 1e-12 else None


def boost(bins: np.ndarray, y: np.ndarray, keys: np.ndarray, count: int, setting: Boosting) -> Generator[np.ndarray, np.ndarray, tuple]:
    """Grows the trees over the rows at hand; yields arrays of its own rows and is sent their sum over all tasks. Returns (base,
    trees), a tree being arrays feature, bin, left, value by node."""
    n, width = bins.shape
    columns, everything = np.ascontiguousarray(bins.T), np.arange(n)
    whole = yield np.array([n, y.sum()])
    base = whole[1] / whole[0]
    predicted, out = np.full(n, base), []

    def counted(at: np.ndarray, residual: np.ndarray, used: np.ndarray | None) -> np.ndarray:
        at = at if used is None else at[used[at]]
        held, sums = np.empty((2, width, count)), residual[at]
        for f in range(width):
            cell = columns[f][at].astype(np.intp)
            held[0, f], held[1, f] = np.bincount(cell, minlength=count), np.bincount(cell, sums, count)
        return held

    def parted(leaf: Leaf) -> None:
        """Deals a leaf's rows out to its children, in order: later steps touch these rows alone."""
        if leaf.children[0].at is None:
            _, f, b = leaf.best
            below = columns[f][leaf.at] <= b
            leaf.children[0].at, leaf.children[1].at = leaf.at[below], leaf.at[~below]

    for turn in range(setting.rounds):
        residual = y - predicted
        used = mixed(keys, 2 * (setting.seed * 100_003 + turn)) < setting.rows if setting.rows < 1 else None
        order = np.argsort(mixed(np.arange(width), 2 * (setting.seed * 100_003 + turn) + 1), kind="stable")
        features = np.sort(order[: max(1, int(np.ceil(setting.features * width)))])
        nodes = [[-1, -1, -1, 0.0]]
        histogram = (yield counted(everything, residual, used).ravel()).reshape(2, width, count)
        root = Leaf(histogram, histogram[0, 0].sum(), histogram[1, 0].sum(), 0, 0, everything)
        root.best = best_split(root, features, setting) if root.rows else None
        leaves = [root]
        while len(leaves) < setting.leaves:
            ready = sorted((x for x in leaves if x.best), key=lambda x: (-x.best[0], x.node))
            if not ready:
                break
            if not ready[0].children:
                # Children of the leaves that may be next, all in one exchange. Those of the last level, or of the last
                # split, are never split again: what the parent's histogram says of them is enough.
                left = setting.leaves - len(leaves)
                asked = [x for x in ready[:left] if not x.children]
                parts = []
                for x in asked:
                    _, f, b = x.best
                    rows, total = x.histogram[0, f, : b + 1].sum(), x.histogram[1, f, : b + 1].sum()
                    x.children = [Leaf(None, rows, total, x.depth + 1, -1), Leaf(None, x.rows - rows, x.total - total, x.depth + 1, -1)]
                open_ = [x for x in asked if x.depth + 1 < setting.depth and left > 1]
                for x in open_:
                    parted(x)
                    small = x.children[0] if x.children[0].rows <= x.children[1].rows else x.children[1]
                    parts.append(counted(small.at, residual, used))
                if open_:
                    told = (yield np.stack(parts).ravel()).reshape(len(open_), 2, width, count)
                    for x, child in zip(open_, told):
                        pair = [child, x.histogram - child]
                        if x.children[0].rows > x.children[1].rows:
                            pair.reverse()
                        for leaf, histogram in zip(x.children, pair):
                            leaf.histogram = histogram
                            leaf.best = best_split(leaf, features, setting)
            chosen = ready[0]
            _, f, b = chosen.best
            for leaf in chosen.children:
                leaf.node = len(nodes)
                nodes.append([-1, -1, -1, 0.0])
            nodes[chosen.node][:3] = [f, b, chosen.children[0].node]
            parted(chosen)
            chosen.at = None
            leaves.remove(chosen)
            leaves += chosen.children
        for leaf in leaves:
            nodes[leaf.node][3] = setting.rate * leaf.total / leaf.rows if leaf.rows else 0.0
            predicted[leaf.at] += nodes[leaf.node][3]
        out.append([np.array(column) for column in zip(*nodes)])
    return base, out


def in_step(runs: dict[str, Generator], summed) -> dict[str, tuple]:
    """Runs all generators together; every step exchanges what they ask for as one array."""
    asked, done = {name: next(run) for name, run in runs.items()}, {}
    while asked:
        names = sorted(asked)
        told = summed(np.concatenate([asked[n] for n in names]))
        cuts = np.cumsum([len(asked[n]) for n in names])[:-1]
        for name, part in zip(names, np.split(told, cuts)):
            try:
                asked[name] = runs[name].send(part)
            except StopIteration as end:
                del asked[name]
                done[name] = end.value
    return done


class Exchange:
    """Sums arrays over the tasks of a barrier stage, in the same order everywhere.

    Each task leaves its array as a file of the shared folder and reads the others'. A task that has left the file of one
    turn has read all of the turn before, so its own file of that turn can go. Tasks first try whether they read each other's
    files at all; if any can't, the arrays go through the barrier.
    """

    def __init__(self, folder: str, context: BarrierTaskContext):
        self.context, self.tasks, self.turn = context, len(context.getTaskInfos()), 0
        # A stage that is started again must not meet the files of the attempt before.
        self.folder = f"{folder}/{context.allGather(uuid.uuid4().hex)[0]}" if self.tasks > 1 else folder
        self.files = self._opened()

    def summed(self, array: np.ndarray) -> np.ndarray:
        if self.tasks == 1:
            return array
        held = array.astype(float).tobytes()
        if self.files is None:
            parts = [base64.b64decode(t) for t in self.context.allGather(base64.b64encode(held).decode())]
        else:
            parts = self._through_files(held)
        return np.sum([np.frombuffer(p) for p in parts], axis=0)

    def _opened(self) -> fs.FileSystem | None:
        if self.tasks == 1:
            return None
        mine = self.context.partitionId()
        try:
            files, self.folder = fs.FileSystem.from_uri(self.folder)
            files.create_dir(self.folder)
            self._leave(files, f"{self.folder}/probe-{mine}", b"there")
        except Exception:  # noqa: BLE001 - a folder that only Spark can open
            files = None
        left = self.context.allGather("" if files is None else "left")
        if "" in left:
            return None
        found = files.get_file_info([f"{self.folder}/probe-{t}" for t in range(self.tasks)])
        seen = self.context.allGather("seen" if all(f.type == fs.FileType.File for f in found) else "")
        return None if "" in seen else files

    @staticmethod
    def _leave(files: fs.FileSystem, path: str, held: bytes) -> None:
        with files.open_output_stream(f"{path}.part") as out:
            out.write(held)
        files.move(f"{path}.part", path)  # whole or not there

    def _through_files(self, held: bytes) -> list[bytes]:
        mine, self.turn = self.context.partitionId(), self.turn + 1
        self._leave(self.files, f"{self.folder}/{self.turn}-{mine}", held)
        parts, began = {mine: held}, time.monotonic()
        while len(parts) < self.tasks:
            missing = [t for t in range(self.tasks) if t not in parts]
            infos = self.files.get_file_info([f"{self.folder}/{self.turn}-{t}" for t in missing])
            there = [t for t, info in zip(missing, infos) if info.type == fs.FileType.File]
            for t in there:
                with self.files.open_input_stream(f"{self.folder}/{self.turn}-{t}") as source:
                    parts[t] = source.read()
            if not there:
                waited = time.monotonic() - began
                if waited > PATIENCE:
                    raise TimeoutError(f"histograms of tasks {missing} did not come")
                time.sleep(min(max(0.1 * waited, 0.001), 0.05))  # a tenth more than the others need, at most
        if self.turn > 1:
            self.files.delete_file(f"{self.folder}/{self.turn - 1}-{mine}")
        return [parts[t] for t in range(self.tasks)]


def bin_edges(train: DataFrame, inputs: list[str], bins: int = BINS) -> list[np.ndarray]:
    """Ascending inner edges of each feature: a value is in the first bin whose edge it doesn't exceed."""
    shares = [i / bins for i in range(1, bins)]
    found = train.agg(*[F.percentile_approx(f, shares, 100 * bins).alias(f) for f in inputs]).first()
    return [np.unique(np.array(found[f], float)) for f in inputs]


def boosted(train: DataFrame, inputs: list[str], settings: dict[str, Boosting], bins: int = BINS) -> dict[str, tuple[float, Trees]]:
    """(base, trees) of each setting, trained together on (id, date, inputs, target) in one barrier job."""
    edges = bin_edges(train, inputs, bins)
    spark = train.sparkSession
    tasks = max(1, min(spark.sparkContext.defaultParallelism, -(-train.count() // ROWS_PER_TASK)))
    folder = f"{checkpoint_folder(spark)}/exchange-{uuid.uuid4().hex}"

    def grown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = BarrierTaskContext.get()
        held = [(matrix(b, inputs), matrix(b, ["target"])[:, 0], b.column(0).to_numpy()) for b in batches if b.num_rows]
        x = np.concatenate([h[0] for h in held]) if held else np.zeros((0, len(inputs)))
        y = np.concatenate([h[1] for h in held]) if held else np.zeros(0)
        keys = np.concatenate([h[2] for h in held]).view(np.uint64) if held else np.zeros(0, np.uint64)
        binned = np.column_stack([np.searchsorted(e, x[:, i], "left") for i, e in enumerate(edges)]).astype(np.uint8)

        done = in_step({name: boost(binned, y, keys, bins, s) for name, s in settings.items()}, Exchange(folder, context).summed)
        if context.partitionId() == 0:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(done)], pa.binary())], names=["models"])

    keyed = train.select(F.xxhash64("id", "date").alias("key"), *inputs, "target").repartition(tasks)
    # All tasks must run, so all rows are asked for; only the first task has one.
    done = pickle.loads(keyed.mapInArrow(grown, "models binary", barrier=True).collect()[0][0])
    return {name: (base, _packed(trees, edges)) for name, (base, trees) in done.items()}


def _packed(trees: list, edges: list[np.ndarray]) -> Trees:
    """Trees of bins as trees of values."""
    room = max(len(t[0]) for t in trees)

    def padded(i: int, blank: float) -> np.ndarray:
        return np.stack([np.concatenate([t[i], np.full(room - len(t[i]), blank)]) for t in trees])

    feature, at = padded(0, -1).astype(np.int64), padded(1, 0).astype(np.int64)
    threshold = np.array([[edges[f][min(b, len(edges[f]) - 1)] if f >= 0 else 0.0 for f, b in zip(*pair)] for pair in zip(feature, at)])
    return Trees(feature, threshold, padded(2, -1).astype(np.int64), padded(3, 0.0))


def sum_of(base: float, trees: Trees, today: DataFrame, inputs: list[str], depth: int) -> DataFrame:
    """`today` (id, date, inputs) with base plus the sum of all trees as predicted_return."""
    count = len(trees.feature)
    mean = mean_of(trees, today, inputs, depth)
    return mean.select("id", "date", (F.lit(float(base)) + F.col("predicted_return") * count).alias("predicted_return"))
