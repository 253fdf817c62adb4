"""Boosted trees on gradient histograms, with three ways of growing a tree.

Features are cut into at most ``BINS`` bins once, and rows are written as blocks of bins with
their labels and weights. A Spark job over the blocks returns sums of gradients, Hessians and
rows per (leaf, feature, bin); the driver holds these tables, whose size does not depend on the
rows, and chooses splits. Only left children are summed, right ones follow by subtraction. The
rows of up to one task are summed, and their splits chosen, in that task. Trees grow

* ``leaf``: the open leaf of greatest gain first, up to a number of leaves and a depth. All
  leaves of a level that may still be taken are summed in one job, so a tree takes at most as
  many jobs as it has levels, and the result is that of one leaf at a time;
* ``level``: every leaf of a level that gains;
* ``symmetric``: one condition for all leaves of a level, chosen by the gain added up over them.

Gradient, Hessian, gain and leaf value are those of the second-order expansion of the log loss
with an L2 penalty.
"""

from __future__ import annotations

import heapq
import math
import pickle
import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext, cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.session import materialise, shared_folder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bins of a feature, rows per task of a histogram (up to so many are fitted by one task), rounds
#: between two writes of the margins, partial histograms the driver adds up itself.
BINS, TASK_ROWS, REWRITE, DRIVER_PARTS = 128, 200_000, 10, 16
_LOWEST = -sys.float_info.max


@dataclass(frozen=True)
class Growth:
    """How trees grow and how much they may fit."""

    policy: str  # leaf, level or symmetric
    depth: int
    leaves: int = 1 << 30
    penalty: float = 1.0  # L2, added to every Hessian sum
    least_hessian: float = 0.0
    least_rows: int = 1
    row_share: float = 1.0  # drawn anew for every tree
    column_share: float = 1.0
    rate: float = 0.1
    from_average: bool = False  # start from the log odds of the weighted labels, else from 0


@dataclass(frozen=True)
class Tree:
    """Nodes in the order of their making; a leaf has feature -1. Larger values than ``cut`` go right."""

    feature: np.ndarray
    bin: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray  # what a leaf adds to the margin, rate included
    gradient: np.ndarray
    hessian: np.ndarray
    rows: np.ndarray
    gain: np.ndarray

    def leaf_of(self, table: np.ndarray, limits: np.ndarray, node: np.ndarray | None = None) -> np.ndarray:
        """Leaf of every row of ``table``: right at a node where its feature passes the node's limit. ``node`` has a node above each leaf."""
        row, node = np.arange(len(table)), np.zeros(len(table), np.int64) if node is None else node
        while (inner := self.feature[node] >= 0).any():
            right = table[row, self.feature[node]] > limits[node]
            node = np.where(inner, np.where(right, self.right[node], self.left[node]), node)
        return node


@dataclass(frozen=True)
class BoostedTrees:
    """A fitted model: probability of class 1 from the margin ``start`` plus what the leaves add."""

    start: float
    trees: tuple[Tree, ...]
    width: int
    penalty: float
    rate: float
    symmetric: bool
    losses: tuple[float, ...] = ()  # weighted log loss of the training rows before each tree and after the last

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        for tree in self.trees:
            out += tree.value[tree.leaf_of(x, tree.cut)]
        return out

    def probability(self) -> Column:
        """Probability of class 1 of the array column ``_x``. A missing number goes left."""
        if self.symmetric:
            return F.expr(f"1 / (1 + exp(-({self.expression('_x')})))")
        whole = self

        @F.pandas_udf("double")
        def score(x: pd.Series) -> pd.Series:
            if x.empty:
                return pd.Series([], dtype=float)
            known = x.notna().to_numpy()
            out = np.full(len(x), np.nan)
            if known.any():
                out[known] = 1 / (1 + np.exp(-whole.margin(np.stack(x[known].to_numpy()).astype(float))))
            return pd.Series(out).where(known)

        return score(F.col("_x"))

    def score(self, df: DataFrame, column: str = "p", features: str = "features") -> DataFrame:
        """Add the probability of class 1 as ``column``; null features have none."""
        is_vector = isinstance(df.schema[features].dataType, VectorUDT)
        with_x = df.withColumn("_x", vector_to_array(features) if is_vector else F.col(features))
        return with_x.withColumn(column, F.when(F.col("_x").isNotNull(), self.probability())).drop("_x")

    def expression(self, array: str) -> str:
        """SQL for the margin of a symmetric model: a leaf table per tree, indexed by the bits of its conditions."""
        if not self.symmetric:
            raise ValueError("only symmetric trees have one condition per level")
        terms = [f"{self.start!r}D"]
        for tree in self.trees:
            conditions, node = [], 0
            while tree.feature[node] >= 0:
                conditions.append((int(tree.feature[node]), float(tree.cut[node])))
                node = int(tree.left[node])
            table = []
            for bits in range(1 << len(conditions)):
                node = 0
                for level in range(len(conditions)):
                    node = int((tree.right if bits >> level & 1 else tree.left)[node])
                table.append(f"{float(tree.value[node])!r}D")
            # NaN compares as the largest number in SQL; here it goes left.
            index = " + ".join(f"if({array}[{f}] > {c!r}D and not isnan({array}[{f}]), {1 << k}, 0)" for k, (f, c) in enumerate(conditions)) or "0"
            terms.append(f"get(array({', '.join(table)}), {index})")
        return " + ".join(terms)

    @property
    def importances(self) -> np.ndarray:
        """Share of the gain of all splits by feature."""
        total = np.zeros(self.width)
        for tree in self.trees:
            inner = tree.feature >= 0
            np.add.at(total, tree.feature[inner], tree.gain[inner])
        return total / total.sum() if total.sum() else total

    def nodes(self, spark: SparkSession) -> DataFrame:
        """One row per node: tree, node, depth, feature (-1: leaf), cut, children, value, sums, gain."""
        rows = []
        for t, tree in enumerate(self.trees):
            depth = {0: 0}
            for n in range(len(tree.feature)):
                for child in (int(tree.left[n]), int(tree.right[n])):
                    if tree.feature[n] >= 0:
                        depth[child] = depth[n] + 1
                values = (tree.feature[n], tree.bin[n], tree.cut[n], tree.left[n], tree.right[n], tree.value[n], tree.gradient[n], tree.hessian[n], tree.rows[n], tree.gain[n])
                rows.append((t, n, depth[n], *[v.item() for v in values]))
        return spark.createDataFrame(rows, NODE_DDL)

    def state(self, spark: SparkSession) -> DataFrame:
        """What the node table does not hold, as one row."""
        row = (self.start, self.width, self.penalty, self.rate, self.symmetric, list(map(float, self.losses)))
        return spark.createDataFrame([row], STATE_DDL)

    @staticmethod
    def restore(nodes: DataFrame, state: DataFrame) -> BoostedTrees:
        table, kept = nodes.toPandas().sort_values(["tree", "node"]), state.first()
        trees = [Tree(*[part[c].to_numpy() for c in _NODE_COLUMNS]) for _, part in table.groupby("tree")]
        return BoostedTrees(kept["start"], tuple(trees), kept["width"], kept["penalty"], kept["rate"], kept["symmetric"], tuple(kept["losses"]))


_NODE_COLUMNS = ("feature", "bin", "cut", "left", "right", "value", "gradient", "hessian", "rows", "gain")
NODE_DDL = (
    "tree int, node int, depth int, feature int, bin int, cut double, left int, right int, value double, gradient double, hessian double,"
    " rows long, gain double"
)
STATE_DDL = "start double, width int, penalty double, rate double, symmetric boolean, losses array<double>"


# --- rows in blocks of bins -------------------------------------------------------------------

_BLOCK = pa.schema([("block", pa.int64()), ("n", pa.int32()), *[(c, pa.binary()) for c in ("bins", "y", "w")]])
_BLOCK_DDL = "block long, n int, bins binary, y binary, w binary"


def bin_edges(rows: DataFrame, width: int, bins: int = BINS) -> list[np.ndarray]:
    """Upper ends of all bins but the last of every feature, from approximate quantiles of array ``x``."""
    shares = [i / bins for i in range(bins)] + [1.0]
    listed = ", ".join(map(repr, shares))
    number = [f"nanvl(x[{j}], CAST(NULL AS DOUBLE))" for j in range(width)]
    ends = [f"percentile_approx({c}, array({listed}), {20 * bins})" for c in number]
    found = rows.selectExpr(*ends, *[f"count({c}) < count(*)" for c in number]).first()
    # Where values are missing, they have a bin of their own below all others.
    return [np.concatenate(([_LOWEST] if gaps else [], np.unique(np.array(q or [0.0], float))[:-1])) for q, gaps in zip(found[:width], found[width:])]


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Bin of every value; NaN counts as the smallest."""
    out = np.zeros(x.shape, np.uint8)
    for j, e in enumerate(edges):
        out[:, j] = np.where(np.isnan(x[:, j]), 0, np.searchsorted(e, x[:, j], side="left"))
    return out


def _blocks(edges: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for b in batches:
            if not b.num_rows:
                continue
            x = b["x"].flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, len(edges))
            parts = [np.ascontiguousarray(binned(x, edges).T), b["y"].to_numpy().astype(np.float64), b["w"].to_numpy().astype(np.float64)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([b.num_rows], pa.int32()), *[pa.array([p.tobytes()], pa.binary()) for p in parts]], schema=_BLOCK
            )
            number += 1

    return run


#: A block at work: its number, bins (features by rows), labels, weights, margins, and what the trees since their last rewrite add.
_Rows = tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _opened(block: int, n: int, bins: bytes, y: bytes, w: bytes, start: float) -> _Rows:
    return block, np.frombuffer(bins, np.uint8).reshape(-1, n), *(np.frombuffer(v, np.float64) for v in (y, w)), np.full(n, start), np.zeros(n)


def _after(rows: _Rows, tree: Tree, rewrite: bool) -> _Rows:
    """The block with the margins after ``tree``."""
    block, x, y, w, margin, gained = rows
    gained = gained + tree.value[tree.leaf_of(x.T, tree.bin)]
    return (block, x, y, w, margin + gained, np.zeros(len(y))) if rewrite else (block, x, y, w, margin, gained)


class _Drawn:
    """A block as one tree sees it: gradients and Hessians, the rows drawn, the leaf of each row, and the loss before the tree."""

    def __init__(self, rows: _Rows, share: float, seed: tuple[int, int]):
        block, self.x, y, w, margin, gained = rows
        margin = margin + gained
        self.loss = (w * (np.logaddexp(0, margin) - y * margin)).sum(), w.sum()
        p = 1 / (1 + np.exp(-margin))
        self.g, self.h = w * (p - y), w * p * (1 - p)
        self.drawn = np.ones(len(y), bool)
        if share < 1:
            self.drawn = np.random.default_rng((*seed, block & 0xFFFFFFFF, block >> 32)).random(len(y)) < share
        self.node = np.zeros(len(y), np.int64)

    def add(self, table: np.ndarray, tree: Tree, wanted: np.ndarray, starts: np.ndarray) -> None:
        """Add gradient, Hessian and row sums by slot and bin to ``table``; ``wanted`` has the slot of each leaf, or -1.

        The tree is the one of the call before, or grew from it. Features are summed one after
        the other: the bins of one and its sums stay in the processor's cache.
        """
        self.node = tree.leaf_of(self.x.T, tree.bin, self.node)
        slot = wanted[self.node]
        rows = np.flatnonzero((slot >= 0) & self.drawn)
        slot, g, h = slot[rows], self.g[rows], self.h[rows]
        for j in range(len(starts) - 1):
            first, end = starts[j], starts[j + 1]
            at = slot * (end - first) + self.x[j][rows]
            for k, v in enumerate((g, h, None)):
                table[k, :, first:end] += np.bincount(at, weights=v, minlength=table.shape[1] * (end - first)).reshape(-1, end - first)


def _wanted(tree: Tree, nodes: list[int]) -> np.ndarray:
    wanted = np.full(len(tree.feature), -1)
    wanted[nodes] = np.arange(len(nodes))
    return wanted


class _Here:
    """Sums over blocks in the memory of this process."""

    def __init__(self, blocks: list[_Rows], share: float, seed: int, starts: np.ndarray):
        self.blocks, self.share, self.seed, self.starts = blocks, share, seed, starts

    def begin(self, number: int) -> None:
        self.drawn = [_Drawn(b, self.share, (self.seed, number)) for b in self.blocks]

    def sums(self, tree: Tree, nodes: list[int]) -> tuple[np.ndarray, float]:
        """Tables of some leaves of ``tree``, and the loss before it."""
        table, wanted = np.zeros((3, len(nodes), int(self.starts[-1]))), _wanted(tree, nodes)
        for d in self.drawn:
            d.add(table, tree, wanted, self.starts)
        loss = sum(np.array(d.loss) for d in self.drawn)
        return table, loss[0] / loss[1]

    def after(self, tree: Tree, rewrite: bool) -> None:
        self.blocks = [_after(b, tree, rewrite) for b in self.blocks]


#: First block, sums, loss and weight of a task.
_Part = tuple[int, np.ndarray, float, float]


def _added(parts: list[_Part]) -> _Part:
    """Partial sums added up, in the order of their tasks."""
    parts = sorted(parts, key=lambda p: p[0])
    return parts[0][0], sum(p[1] for p in parts), sum(p[2] for p in parts), sum(p[3] for p in parts)


class _Spread:
    """Sums over the blocks of an RDD, a job each. The blocks with their margins after the last tree are kept by the executors;
    those after every ``REWRITE`` trees are written to the checkpoint folder, so a lost executor costs so many trees of margins at most."""

    def __init__(self, blocks: RDD, parts: int, share: float, seed: int, starts: np.ndarray):
        self.blocks, self.groups, self.share, self.seed, self.starts = blocks.persist(StorageLevel.MEMORY_AND_DISK), 0, share, seed, starts
        if parts > DRIVER_PARTS:
            # About as many groups as each holds parts, so neither a task nor the driver gets all.
            self.groups = max(1, math.isqrt(parts))
        self.last: RDD | None = None

    def begin(self, number: int) -> None:
        self.number = number

    def sums(self, tree: Tree, nodes: list[int]) -> tuple[np.ndarray, float]:
        share, seed, starts, groups, wanted, slots = self.share, (self.seed, self.number), self.starts, self.groups, _wanted(tree, nodes), len(nodes)

        def run(task: int, blocks: Iterator[_Rows]) -> Iterator[tuple[int, _Part]]:
            table, loss, weight, first = np.zeros((3, slots, int(starts[-1]))), 0.0, 0.0, -1
            for b in blocks:
                first = b[0] if first < 0 else first
                drawn = _Drawn(b, share, seed)
                drawn.add(table, tree, wanted, starts)
                loss, weight = loss + drawn.loss[0], weight + drawn.loss[1]
            if first >= 0:
                yield task % max(groups, 1), (first, table, loss, weight)

        made = self.blocks.mapPartitionsWithIndex(run)
        made = made.groupByKey(groups).map(lambda g: _added(list(g[1]))) if groups else made.values()
        _, table, loss, weight = _added(made.collect())
        if self.last is not None:  # the blocks after the last tree are there now
            self.last.unpersist()
            self.last = None
        return table, loss / weight

    def after(self, tree: Tree, rewrite: bool) -> None:
        self.last = self.blocks
        self.blocks = self.last.map(lambda b: _after(b, tree, rewrite), preservesPartitioning=True).persist(StorageLevel.MEMORY_AND_DISK)
        if rewrite:
            self.blocks.checkpoint()


# --- growing ------------------------------------------------------------------------------------


@dataclass
class _Growing:
    """One tree in the making, on the driver."""

    how: Growth
    edges: list[np.ndarray]
    columns: np.ndarray  # features that may be used
    starts: np.ndarray  # of each feature's bins
    nodes: list[list] = field(default_factory=list)  # feature, bin, cut, left, right, g, h, n, gain, depth
    tables: dict[int, np.ndarray] = field(default_factory=dict)  # gradients, Hessians, rows by bin

    def __post_init__(self):
        self.feature = np.repeat(np.arange(len(self.edges)), np.diff(self.starts))
        self.usable = self.columns[self.feature]
        self.usable[self.starts[1:] - 1] = False  # nothing is right of a feature's last bin

    def add(self, g: float, h: float, n: float, depth: int) -> int:
        self.nodes.append([-1, 0, 0.0, -1, -1, g, h, n, 0.0, depth])
        return len(self.nodes) - 1

    def gains(self, node: int) -> np.ndarray:
        """Gain of every bin as the last of its feature that goes left; -inf where not allowed."""
        table = self.tables[node]
        upto = np.concatenate((np.zeros((3, 1)), np.cumsum(table, axis=1)), axis=1)
        left = upto[:, 1:] - upto[:, self.starts[self.feature]]
        total = self.total(node)[:, None]
        right = total - left
        c = self.how.penalty

        def worth(t: np.ndarray) -> np.ndarray:
            return t[0] ** 2 / np.maximum(t[1] + c, 1e-300)

        out = worth(left) + worth(right) - worth(total)
        fits = (np.minimum(left[1], right[1]) >= self.how.least_hessian) & (np.minimum(left[2], right[2]) > max(self.how.least_rows, 1) - 0.5)
        return np.where(fits & self.usable, out, -np.inf)

    def total(self, node: int) -> np.ndarray:
        return self.tables[node][:, : self.starts[1]].sum(1)

    def split(self, node: int, place: int, gain: float) -> tuple[int, int]:
        feature = int(self.feature[place])
        start, total = int(self.starts[feature]), self.total(node)
        left = self.tables[node][:, start : place + 1].sum(1)
        depth = self.nodes[node][9] + 1
        children = self.add(*left, depth), self.add(*(total - left), depth)
        self.nodes[node][:5] = [feature, place - start, float(self.edges[feature][place - start]), *children]
        self.nodes[node][8] = gain
        return children

    def tree(self) -> Tree:
        feature, b, cut, left, right, g, h, n, gain, _ = (np.array(c) for c in zip(*self.nodes))
        value = np.where(feature < 0, -g / np.maximum(h + self.how.penalty, 1e-300) * self.how.rate, 0.0)
        return Tree(feature.astype(int), b.astype(int), cut, left.astype(int), right.astype(int), value, g, h, np.rint(n).astype(int), gain)


def _best(gains: np.ndarray) -> tuple[float, int]:
    place = int(np.argmax(gains))
    return float(gains[place]), place


def _grow(grown: _Growing, summed) -> Tree:
    """Grow one tree; ``summed(tree, nodes)`` returns the tables of some of its leaves."""
    how = grown.how
    root = grown.add(0.0, 0.0, 0.0, 0)
    grown.tables.update(summed(grown.tree(), [root]))
    grown.nodes[root][5:8] = grown.total(root).tolist()

    def know(children: list[tuple[int, tuple[int, int]]]) -> None:
        """Tables of children: the left ones summed, the right ones by subtraction."""
        children = [(p, c) for p, c in children if grown.nodes[c[0]][9] < how.depth]
        if children:
            grown.tables.update(summed(grown.tree(), [c[0] for _, c in children]))
            for parent, (left, right) in children:
                grown.tables[right] = grown.tables[parent] - grown.tables[left]

    if how.policy == "symmetric":
        level = [root]
        for _ in range(how.depth):
            every = [np.maximum(grown.gains(n), 0) for n in level]
            gain, place = _best(sum(every))
            if gain <= 0:
                break
            made = [(n, grown.split(n, place, gain / len(level))) for n in level]
            know(made)
            level = [c for _, both in made for c in both]
        return grown.tree()
    if how.policy == "level":
        level = [root]
        while level:
            made = []
            for n in level:
                gain, place = _best(grown.gains(n))
                if gain > 0:
                    made.append((n, grown.split(n, place, gain)))
            know(made)
            level = [c for _, both in made for c in both if c in grown.tables]
        return grown.tree()
    # Best first takes nodes by the least gain on their way from the root. So one that as many
    # known nodes precede as there are splits can never be taken, and each level needs one job for
    # the few others. Their splits are made ahead; those not taken in the end are left out.
    found: dict[int, tuple[float, int]] = {root: _best(grown.gains(root))}
    least = {root: found[root][0]}
    ahead: dict[int, tuple[int, int]] = {}
    level = [root]
    while level:
        bar = sorted(least.values(), reverse=True)[: how.leaves - 1][-1]
        made = [(n, grown.split(n, found[n][1], found[n][0])) for n in level if found[n][0] > 0 and least[n] >= bar]
        ahead.update(made)
        know(made)
        level = [c for _, both in made for c in both if c in grown.tables]
        for parent, both in made:
            for c in both:
                if c in grown.tables:
                    found[c] = _best(grown.gains(c))
                    least[c] = min(found[c][0], least[parent])
    heap, chosen = [(-found[root][0], root)] if root in ahead else [], set()
    while heap and len(chosen) + 1 < how.leaves:
        _, n = heapq.heappop(heap)
        chosen.add(n)
        for c in ahead[n]:
            if c in ahead:
                heapq.heappush(heap, (-found[c][0], c))
    order = [root, *sorted(c for n in chosen for c in ahead[n])]
    place = {n: i for i, n in enumerate(order)}
    kept = [list(grown.nodes[n]) for n in order]
    for n, row in zip(order, kept):
        row[3:5] = [place[c] for c in ahead[n]] if n in chosen else [-1, -1]
        if n not in chosen:
            row[0], row[8] = -1, 0.0
    grown.nodes = kept
    return grown.tree()


def _fitted(rows: _Here | _Spread, how: Growth, edges: list[np.ndarray], starts: np.ndarray, rounds: int, seed: int) -> tuple[list[Tree], list[float]]:
    """``rounds`` trees, and the loss before each and after the last."""
    rng = np.random.default_rng(seed)
    width, trees, losses = len(edges), [], []
    for number in range(rounds):
        columns = np.ones(width, bool)
        if how.column_share < 1:
            columns[rng.permutation(width)[max(1, round(how.column_share * width)) :]] = False
        seen: list[float] = []

        def summed(tree: Tree, nodes: list[int], seen: list[float] = seen) -> dict[int, np.ndarray]:
            table, loss = rows.sums(tree, nodes)
            seen.append(loss)
            return {n: table[:, i] for i, n in enumerate(nodes)}

        rows.begin(number)
        tree = _grow(_Growing(how, edges, columns, starts), summed)
        losses.append(float(seen[0]))
        trees.append(tree)
        rows.after(tree, len(trees) % REWRITE == 0)
    rows.begin(rounds)
    stump = Tree(*(np.array([v]) for v in (-1, 0, 0.0, -1, -1, 0.0, 0.0, 0.0, 0, 0.0)))
    losses.append(float(rows.sums(stump, [0])[1]))
    return trees, losses


def _fitted_there(how: Growth, edges: list[np.ndarray], starts: np.ndarray, rounds: int, seed: int, start: float):
    """All rounds in the one task that gets all blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = [_opened(*row, start) for b in batches for row in zip(*(c.to_pylist() for c in b.columns))]
        if blocks:
            rows = _Here(sorted(blocks, key=lambda b: b[0]), how.row_share, seed, starts)
            trees, losses = _fitted(rows, how, edges, starts, rounds, seed)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(([vars(t) for t in trees], losses))], pa.binary())], ["fitted"])

    return run


def fit_boosted(train: DataFrame, how: Growth, rounds: int, weight: str | None = None, seed: int = 42, bins: int = BINS) -> BoostedTrees:
    """Fit ``rounds`` trees to (``features``, ``label`` 0 or 1), rows weighted by ``weight``.

    Rows without features or label are left out. Equal rows in any order of the same files
    give the same model: tasks' sums are added in a fixed order. Rows that one task would sum
    are fitted by that task, without a job per level.
    """
    is_vector = isinstance(train.schema["features"].dataType, VectorUDT)
    x = vector_to_array("features") if is_vector else F.col("features")
    rows = train.select(x.alias("x"), F.col("label").cast("double").alias("y"), (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("w"))
    rows = materialise(rows.where("x is not null and y is not null and w is not null"))
    shape = rows.agg(F.max(F.size("x")), F.sum(F.col("w") * F.col("y")), F.sum("w"), F.count(F.lit(1))).first()
    if not shape[3]:
        raise ValueError("no rows to fit")
    width, positive, total, count = shape
    share = min(max(positive / total, 1e-6), 1 - 1e-6)
    start = math.log(share / (1 - share)) if how.from_average else 0.0
    edges = bin_edges(rows, width, bins)
    parts = math.ceil(count / TASK_ROWS)
    blocks = materialise(rows.coalesce(parts).mapInArrow(_blocks(edges), _BLOCK_DDL))
    starts = np.concatenate(([0], np.cumsum([len(e) + 1 for e in edges])))
    if parts == 1:
        found = blocks.coalesce(1).mapInArrow(_fitted_there(how, edges, starts, rounds, seed, start), "fitted binary").first()
        nodes, losses = pickle.loads(found["fitted"])
        trees = [Tree(**n) for n in nodes]
    else:
        context = train.sparkSession.sparkContext
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(shared_folder(train.sparkSession))
        spread = _Spread(blocks.rdd.map(lambda r: _opened(*r, start)), parts, how.row_share, seed, starts)
        try:
            trees, losses = _fitted(spread, how, edges, starts, rounds, seed)
        finally:
            spread.blocks.unpersist()
    return BoostedTrees(start, tuple(trees), width, how.penalty, how.rate, how.policy == "symmetric", tuple(losses))
