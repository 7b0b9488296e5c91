"""Trees on binned columns: boosting, single trees and forests; all candidates and folds of a search together.

Columns are binned once (`fit_bins`): a numeric has up to 255 cuts, a category one bin per value, and the split
"is this value" of a category is the split of its one-hot column. `make_blocks` packs the rows into blocks of at
most `BLOCK` rows (codes, target, fold), written to the shared folder.

A tree is a table of nodes with explicit child numbers, so no depth is built in. It grows in passes: a pass sums
histograms (gradient, hessian, rows) of the children of all nodes just split and finds their best splits. Without a
limit on leaves every node that gains is split. With one, growth is best first: a pass splits every leaf that may
still be among the best, and the order of gains then decides which splits stay.

* A search with more than `WHOLE` entries grows all its (candidate, fold) models in step: one Spark job per pass, in
  which every block routes its rows through the trees so far, sums histograms per model, and one task per model
  and slice of nodes adds them up and returns a few numbers per node. Boosted scores are a column of the blocks,
  renewed once a round and written to the shared folder every `ROUNDS_KEPT` rounds.
* Up to `WHOLE` entries fit into a task, which then has nothing to add up: each model is grown in a task of its own,
  with the larger sibling's histogram by subtraction. The rows of a node lie together, so a split reads its own rows
  only; several small columns share a histogram (`Joint`); rows with equal codes are one entry (`Cells`).
* Where there are more than `BLOCK` rows, equal ones (codes, target, fold) become one entry with a weight on the way
  into the blocks. Forests draw a weight for every row, so theirs stay apart.

Gradients are whole multiples of a small unit, so sums do not depend on the order or the cut of the blocks, and
both ways find the same splits. Candidates that differ in the number of rounds or trees alone are one model, read
off at several lengths.

Edge cases: a null or not-a-number numeric counts as the fill value; a null or unseen category is in no bin's value;
rows with a null target are left out; a target of one value gives a tree of one leaf.
"""

from __future__ import annotations

import heapq
import json
import math
import pickle
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wayfare.session import scratch_path

CUTS = 255
BLOCK = 1 << 20
WHOLE = 1 << 22       # entries that a task may hold
ENTRIES = 1 << 22     # (tree, entry) pairs that a task grows in step
JOINT = 4096          # cells of columns that share a histogram
SMALL = 256           # rows of a node from which it is split by itself
SPREAD_MB = 256       # blocks moved to the tasks by a shuffle; more are read by each task
HELD = 1 << 17        # held rows of a result row
SLOTS = 2048          # nodes whose histograms are summed together
ROUNDS_KEPT = 10
LEAST_HESSIAN = 1e-3
MOST_VALUES = 1 << 16
PIECE = 1 << 17       # rows of a block where there are several
TREES_PER_TASK = 50
JOBS_PER_TASK = 4     # boosted models that a task grows in step


# ---- bins ---------------------------------------------------------------------------------

@dataclass
class Bins:
    """Columns and how they are cut. `names` are the columns; `transform` is there for the common model interface."""

    cat: list[str]
    num: list[str]
    values: list[list[str]]
    cuts: list[list[float]]
    fill: list[float]

    @property
    def names(self) -> list[str]:
        return self.cat + self.num

    def transform(self, df: DataFrame) -> DataFrame:
        return df

    def inputs(self) -> list[Column]:
        return [F.col(f"`{c}`").cast("string") for c in self.cat] + [F.col(f"`{c}`").cast("double") for c in self.num]

    @property
    def sizes(self) -> np.ndarray:
        return np.array([len(v) + 1 for v in self.values] + [len(c) + 1 for c in self.cuts], np.int64)

    @property
    def is_cat(self) -> np.ndarray:
        return np.array([True] * len(self.cat) + [False] * len(self.num), bool)

    def codes(self, columns: Sequence[pa.Array]) -> np.ndarray:
        """(columns, rows) bin numbers; an unknown category has the last one."""
        out = np.zeros((len(columns), len(columns[0]) if columns else 0), np.uint16)
        for i, col in enumerate(columns[:len(self.cat)]):
            at = pc.index_in(col, pa.array(self.values[i], pa.string())).to_numpy(zero_copy_only=False)
            out[i] = np.where(np.isnan(at.astype(float)), len(self.values[i]), at)
        for i, col in enumerate(columns[len(self.cat):]):
            x = col.to_numpy(zero_copy_only=False).astype(float)
            x = np.where(np.isnan(x), self.fill[i], x)
            out[len(self.cat) + i] = np.searchsorted(np.array(self.cuts[i]), x, side="left")
        return out


def fit_bins(df: DataFrame, cat: Sequence[str], num: Sequence[str], median: bool = True) -> Bins:
    """Bins of all rows of `df`, in two aggregates. Missing numerics take the median, or zero."""
    cols = [F.col(f"`{c}`").cast("string") for c in cat] + [
        F.when(~F.isnan(F.col(f"`{c}`").cast("double")), F.col(f"`{c}`").cast("double")) for c in num]
    probs = [(i + 1) / (CUTS + 1) for i in range(CUTS)]
    row = df.agg(*[F.approx_count_distinct(c, 0.01).alias(f"n{i}") for i, c in enumerate(cols)],
                 *[F.percentile_approx(cols[len(cat) + i], F.array(*[F.lit(p) for p in probs]), 1 << 16).alias(f"q{i}")
                   for i in range(len(num))]).first()
    sizes = [row[f"n{i}"] for i in range(len(cols))]
    if any(n > MOST_VALUES * 0.9 for n in sizes[:len(cat)]):
        raise ValueError("a category has more values than a bin number can tell apart")
    few = [i for i, n in enumerate(sizes) if i < len(cat) or n <= CUTS]
    got = df.agg(*[F.array_sort(F.collect_set(cols[i])).alias(f"v{i}") for i in few]).first() if few else {}
    values = [list(got[f"v{i}"]) for i in range(len(cat))]
    cuts, fill = [], []
    for i in range(len(num)):
        q = [x for x in (row[f"q{i}"] or []) if x is not None]
        known = list(got[f"v{len(cat) + i}"]) if len(cat) + i in few else q
        cuts.append(sorted(set(float(x) for x in known))[:-1])
        fill.append(float(q[len(q) // 2]) if median and q else 0.0)
    return Bins(list(cat), list(num), values, cuts, fill)


def make_blocks(df: DataFrame, bins: Bins, target: Column, fold: Column | None = None, factor: Column | None = None,
                truth: Column | None = None, block: int | None = None, merge: bool = True) -> DataFrame:
    """block, n, codes, y, fold, factor, truth and weight of all rows with a target, as packed arrays, written out.

    A prediction is compared with `truth` (the target unless given) after it is multiplied with `factor`. Above `BLOCK`
    rows equal ones are merged, unless told not to or `block` is given; the weight is null where every entry is one row."""
    spark, width = df.sparkSession, len(bins.names)
    one = F.lit(1.0)
    rows = df.select(*[c.alias(f"c{i}") for i, c in enumerate(bins.inputs())], target.cast("double").alias("y"),
                     (F.lit(0) if fold is None else fold).cast("int").alias("fold"),
                     (one if factor is None else factor).cast("double").alias("factor"),
                     (target if truth is None else truth).cast("double").alias("truth")).where("y is not null and not isnan(y)")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, n, number = TaskContext.get().partitionId(), [], 0, 0

        def flush() -> pa.RecordBatch:
            return _packed((part << 32) + number, [np.concatenate([h[k] for h in held], axis=-1) for k in range(5)], None)

        for batch in batches:
            codes = bins.codes(batch.columns[:width])
            rest = [np.asarray(batch.column(width + k).to_numpy(zero_copy_only=False), t)
                    for k, t in enumerate((np.float64, np.int32, np.float64, np.float64))]
            at = 0
            while at < batch.num_rows:
                upto = min(batch.num_rows, at + most - n)
                held.append([codes[:, at:upto], *[r[at:upto] for r in rest]])
                n, at = n + upto - at, upto
                if n == most:
                    yield flush()
                    held, n, number = [], 0, number + 1
        if held:
            yield flush()

    # few, full blocks: the rows are counted first, so that a small table is one block
    whole = rows.persist()
    try:
        total = whole.count()
        most = total if total <= (block or BLOCK) else min(block or PIECE, PIECE)
        parts = max(1, math.ceil(total / max(most, 1)))
        path = scratch_path(spark, "blocks")
        if merge and block is None and total > BLOCK:
            packed = whole.mapInArrow(_keys(bins), "key binary").groupBy("key").agg(F.count("*").alias("w")) \
                .mapInArrow(_unpacker(width, most), PACKED)
        else:
            packed = (whole.coalesce(parts) if parts < whole.rdd.getNumPartitions() else whole).mapInArrow(run, PACKED)
        packed.write.parquet(path)
    finally:
        whole.unpersist()
    return spark.read.parquet(path)


PACKED = "block long, n long, codes binary, y binary, fold binary, factor binary, truth binary, weight binary"


def _packed(number: int, arrays: Sequence[np.ndarray], weight: np.ndarray | None) -> pa.RecordBatch:
    """A block of codes, y, fold, factor and truth."""
    return pa.RecordBatch.from_arrays(
        [pa.array([number]), pa.array([arrays[1].shape[0]]), *[pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in arrays],
         pa.array([None if weight is None else weight.tobytes()], pa.binary())], names=[f.split()[0] for f in PACKED.split(", ")])


def _row_type(width: int) -> np.dtype:
    return np.dtype([("codes", np.uint16, (width,)), ("y", np.float64), ("fold", np.int32), ("factor", np.float64), ("truth", np.float64)])


def _keys(bins: Bins):
    """The whole entry of every row as one binary value."""
    width = len(bins.names)
    kind = _row_type(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.empty(batch.num_rows, kind)
            out["codes"] = bins.codes(batch.columns[:width]).T if width else 0
            for k, name in enumerate(("y", "fold", "factor", "truth")):
                out[name] = batch.column(width + k).to_numpy(zero_copy_only=False)
            ends = np.arange(batch.num_rows + 1, dtype=np.int32) * np.int32(kind.itemsize)
            yield pa.RecordBatch.from_arrays([pa.Array.from_buffers(pa.binary(), batch.num_rows, [
                None, pa.py_buffer(ends.tobytes()), pa.py_buffer(out.tobytes())])], names=["key"])

    return run


def _unpacker(width: int, most: int):
    """Blocks of at most `most` of the merged entries."""
    kind = _row_type(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held, n = TaskContext.get().partitionId(), 0, [], 0

        def flush() -> pa.RecordBatch:
            rows, weight = (np.concatenate(x) for x in zip(*held))
            return _packed((part << 32) + number, [rows["codes"].T, *[rows[c] for c in ("y", "fold", "factor", "truth")]], weight)

        for batch in batches:
            rows = np.frombuffer(b"".join(batch.column(0).to_pylist()), kind)
            weight, at = batch.column(1).to_numpy().astype(np.float64), 0
            while at < len(rows):
                upto = min(len(rows), at + most - n)
                held.append((rows[at:upto], weight[at:upto]))
                n, at = n + upto - at, upto
                if n == most:
                    yield flush()
                    held, n, number = [], 0, number + 1
        if held:
            yield flush()

    return run


# ---- specifications and fitted trees ----------------------------------------------------------

@dataclass(frozen=True)
class TreeSpec:
    """`loss` is "squared" or "log" for boosting, "mean" for a single tree or a forest of `rounds` trees.

    `columns` is the number of (one-hot) columns tried per node, `draws` whether a tree sees Poisson weighted rows."""

    loss: str
    rounds: int = 1
    rate: float = 1.0
    leaves: int | None = None
    depth: int | None = None
    min_leaf: int = 1
    columns: int | None = None
    draws: bool = False
    seed: int = 42


@dataclass
class Nodes:
    """Trees as one table: the trees' roots first. A leaf has no left child."""

    tree: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def leaves_of(self, codes: np.ndarray, is_cat: np.ndarray, root: np.ndarray) -> np.ndarray:
        """The leaf of every row that starts at `root`."""
        node, n = root.copy(), np.arange(codes.shape[1])
        busy = np.flatnonzero(self.left[node] >= 0)
        while len(busy):
            at = node[busy]
            node[busy] = np.where(_goes_left(codes, is_cat, n[busy], self.feature[at], self.cut[at]), self.left[at], self.right[at])
            busy = busy[self.left[node[busy]] >= 0]
        return node

    def add_values(self, out: np.ndarray, codes: np.ndarray, is_cat: np.ndarray, root: int) -> None:
        """Adds to `out` what the tree at `root` gives to every row; a node is only shown its own rows."""
        if len(out) < 16 * SMALL:
            out += self.value[self.leaves_of(codes, is_cat, np.full(len(out), root))]
            return
        open_ = [(root, np.arange(len(out)))]
        while open_:
            i, rows = open_.pop()
            if len(rows) < SMALL:
                out[rows] += self.value[self.leaves_of(codes[:, rows], is_cat, np.full(len(rows), i))]
            elif self.left[i] < 0:
                out[rows] += self.value[i]
            else:
                code = codes[self.feature[i]].take(rows)
                goes = code == self.cut[i] if is_cat[self.feature[i]] else code <= self.cut[i]
                open_ += [(self.left[i], rows.compress(goes)), (self.right[i], rows.compress(~goes))]

    def one(self, tree: int) -> Nodes:
        """One of the trees, as a table of its own."""
        at = np.flatnonzero(self.tree == tree)
        place = np.full(len(self.tree), -1)
        place[at] = np.arange(len(at))
        point = lambda x: np.where(x[at] < 0, -1, place[np.maximum(x[at], 0)])
        return Nodes(np.zeros(len(at), np.int64), self.feature[at], self.cut[at], point(self.left), point(self.right), self.value[at])

    def scores(self, codes: np.ndarray, is_cat: np.ndarray, first: int, last: int) -> np.ndarray:
        """Sum of the values that trees first..last-1 give to every row."""
        out = np.zeros(codes.shape[1])
        for t in range(first, last):
            self.add_values(out, codes, is_cat, t)
        return out


def _goes_left(codes: np.ndarray, is_cat: np.ndarray, rows: np.ndarray, feature: np.ndarray, cut: np.ndarray) -> np.ndarray:
    code = codes[feature, rows]
    return np.where(is_cat[feature], code == cut, code <= cut)


def join_nodes(parts: Sequence[Nodes]) -> Nodes:
    """One table of the trees of several: roots first again."""
    trees = [int((p.tree == np.arange(len(p.tree))).sum()) for p in parts]
    total, out, base, rest = sum(trees), [], 0, sum(trees)
    for p, k in zip(parts, trees):
        place = np.concatenate([base + np.arange(k), rest + np.arange(len(p.tree) - k)])
        out.append((place, base, p))
        base, rest = base + k, rest + len(p.tree) - k
    made = Nodes(*[np.zeros(rest, a.dtype) for a in vars(parts[0]).values()]) if parts else None
    for place, base, p in out:
        made.tree[place], made.feature[place], made.cut[place], made.value[place] = p.tree + base, p.feature, p.cut, p.value
        made.left[place] = np.where(p.left < 0, -1, place[p.left])
        made.right[place] = np.where(p.right < 0, -1, place[p.right])
    return made


@dataclass
class Ensemble:
    """A fitted model: base + sum of trees (boosting), or base + mean of trees."""

    bins: Bins
    spec: TreeSpec
    base: float
    nodes: Nodes
    trees: int
    classifies: bool = False

    def raw(self, codes: np.ndarray) -> np.ndarray:
        total = self.nodes.scores(codes, self.bins.is_cat, 0, self.trees)
        return self.base + (total / max(self.trees, 1) if self.spec.loss == "mean" else total)

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds `prediction`, and `p1` for a classifier."""
        shared = df.sparkSession.sparkContext.broadcast(self)

        @F.arrow_udf("double")
        def score(*columns: pa.Array) -> pa.Array:
            model = shared.value
            return pa.array(model.raw(model.bins.codes(columns)))

        if not self.classifies:
            return df.withColumn("prediction", score(*self.bins.inputs()))
        raw = score(*self.bins.inputs())
        p1 = 1 / (1 + F.exp(-raw)) if self.spec.loss == "log" else F.greatest(F.lit(0.0), F.least(F.lit(1.0), raw))
        return df.withColumn("p1", p1).withColumn("prediction", (F.col("p1") > 0.5).cast("double"))

    def save(self, spark: SparkSession, path: str) -> None:
        n = self.nodes
        plain = pa.table({"tree": n.tree, "feature": n.feature, "cut": n.cut, "left": n.left, "right": n.right, "value": n.value})
        rows = list(zip(range(plain.num_rows), *(c.to_pylist() for c in plain.columns)))
        spark.createDataFrame(rows, "node long, tree long, feature long, cut long, left long, right long, value double") \
            .write.mode("overwrite").parquet(f"{path}/nodes")
        head = (asdict(self.bins) | {"trees": self.trees, "base": self.base, "classifies": self.classifies}, asdict(self.spec))
        spark.createDataFrame([(json.dumps(head),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/head")

    @classmethod
    def load(cls, path: str, spark: SparkSession | None = None) -> Ensemble:
        spark = spark or SparkSession.active()
        head, spec = json.loads(spark.read.text(f"{path}/head").first()[0])
        rows = spark.read.parquet(f"{path}/nodes").orderBy("node").toPandas()
        nodes = Nodes(*[rows[c].to_numpy() for c in ("tree", "feature", "cut", "left", "right", "value")])
        bins = Bins(*[head[k] for k in ("cat", "num", "values", "cuts", "fill")])
        return cls(bins, TreeSpec(**spec), head["base"], nodes, head["trees"], head["classifies"])


# ---- growing --------------------------------------------------------------------------------

@dataclass
class Shape:
    """Bins as the growing functions need them."""

    sizes: np.ndarray
    is_cat: np.ndarray

    def __post_init__(self) -> None:
        self.first = np.cumsum(self.sizes) - self.sizes
        self.cells = int(self.sizes.sum())
        self.feature = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.bin = np.arange(self.cells) - self.first[self.feature]
        cat = self.is_cat[self.feature]
        # a category's last bin (unknown) and a numeric's last bin are no split
        self.usable = self.bin < self.sizes[self.feature] - 1
        self.runs = [(a, n) for a, n, c in zip(self.first.tolist(), self.sizes.tolist(), self.is_cat) if not c]
        # cells of one (one-hot) column lie together: where each column starts, and the column of every cell
        self.columns = np.flatnonzero(cat | (self.bin == 0))
        self.column = np.searchsorted(self.columns, np.arange(self.cells), side="right") - 1
        self.real = self.usable[self.columns]
        self.joint: list[tuple[list[int], int]] = []  # (columns, cells) of the histograms that are summed
        for f in np.argsort(-self.sizes, kind="stable").tolist():
            size = int(self.sizes[f])
            fit = [k for k, (_, cells) in enumerate(self.joint) if cells * size <= JOINT]
            if fit:
                k = max(fit, key=lambda k: self.joint[k][1])
                self.joint[k] = (self.joint[k][0] + [f], self.joint[k][1] * size)
            else:
                self.joint.append(([f], size))

    def together(self, codes: np.ndarray) -> list[np.ndarray]:
        """The cells of every row in the joint histograms."""
        out = []
        for fs, cells in self.joint:
            cell = np.zeros(codes.shape[1], np.uint16 if cells <= 1 << 16 else np.int64)
            for f in fs:
                cell = cell * cell.dtype.type(min(self.sizes[f], 65535)) + codes[f]
            out.append(cell)
        return out

    def apart(self, sums: np.ndarray, k: int, out: np.ndarray) -> None:
        """Sums (nodes, cells) of a joint histogram, added up for each of its columns into `out` (nodes, all cells)."""
        fs = self.joint[k][0]
        cube = sums.reshape(len(sums), *[int(self.sizes[f]) for f in fs])
        for i, f in enumerate(fs):
            rest = tuple(1 + j for j in range(len(fs)) if j != i)
            out[:, self.first[f]:self.first[f] + self.sizes[f]] = cube.sum(axis=rest) if rest else cube


@dataclass
class Splits:
    """Per node: totals, and the best split (gain 0 if there is none)."""

    g: np.ndarray
    h: np.ndarray
    n: np.ndarray
    gain: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    left_n: np.ndarray


def best_splits(hist: np.ndarray, shape: Shape, columns: int | None, min_leaf: np.ndarray, least: float, keys: np.ndarray) -> Splits:
    """Of histograms (3, nodes, cells) of gradient, hessian and rows; `min_leaf` holds the least rows of a side per
    node, `least` is its smallest hessian."""
    min_leaf, nodes = min_leaf[:, None], hist.shape[1]
    total = hist[:, :, :shape.sizes[0]].sum(axis=2)
    left = hist.copy()
    for a, size in shape.runs:
        np.cumsum(hist[:, :, a:a + size], axis=2, out=left[:, :, a:a + size])
    g, h, n = left
    tg, th, tn = total[:, :, None]
    other = th - h
    ok = (n >= min_leaf) & (n <= tn - min_leaf) & shape.usable & (h >= least) & (other >= least)
    with np.errstate(divide="ignore", invalid="ignore"):
        # the difference of the sides' means loses no digits, unlike a difference of their squares
        low, high = g / h, (tg - g) / other
        apart = low - high
        apart[~(ok & (np.abs(apart) > 1e-15 * (np.abs(low) + np.abs(high))))] = 0.0
        gain = h * other / th * apart * apart
    gain[apart == 0.0] = 0.0
    if columns is not None:  # the first `columns` columns in random order, or as many as it takes to gain
        lead = np.maximum.reduceat(gain, shape.columns, axis=1)
        order = np.argsort(np.where(shape.real, _column_order(keys, len(shape.columns)), np.inf), axis=1)
        place = np.empty_like(order)
        np.put_along_axis(place, order, np.arange(order.shape[1])[None, :], axis=1)
        reach = np.where(lead > 0, place, order.shape[1]).min(axis=1, keepdims=True)
        gain = np.where((place <= np.maximum(columns - 1, reach))[:, shape.column], gain, 0.0)
    best = np.argmax(gain, axis=1)
    at = np.arange(nodes)
    return Splits(total[0], total[1], total[2], gain[at, best], shape.feature[best], shape.bin[best], n[at, best])


def _column_order(keys: np.ndarray, columns: int) -> np.ndarray:
    """A random number per (node, column), from the nodes' keys alone."""
    x = keys.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15)
    x = x + np.arange(columns, dtype=np.uint64)[None, :] * np.uint64(0xD6E8FEB86659FD93)
    for shift, mult in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(mult)
    return (x ^ (x >> np.uint64(31))).astype(np.float64)


class Growth:
    """Trees being grown together, each within the limits of its `specs` entry."""

    def __init__(self, specs: Sequence[TreeSpec], first_key: int = 0):
        self.specs, self.trees, trees, spec = specs, len(specs), len(specs), specs[0]
        self.leaves = [s.leaves for s in specs]
        self.min_leaf = np.array([s.min_leaf for s in specs])
        self.most_depth = np.array([np.iinfo(np.int64).max if s.depth is None else s.depth for s in specs])
        self.tree, self.depth, self.key = np.arange(trees), np.zeros(trees, np.int64), np.arange(trees, dtype=np.int64) + spec.seed * 1009 + first_key
        self.left, self.right = np.full(trees, -1), np.full(trees, -1)
        self.stat: Splits | None = None
        self.fresh = np.arange(trees)  # nodes without statistics yet

    def learn(self, splits: Splits) -> np.ndarray:
        """Take the statistics of the fresh nodes; returns which nodes to split now."""
        tree = self.tree[self.fresh]
        can = (splits.gain > 0) & (splits.n >= 2 * self.min_leaf[tree]) & (self.depth[self.fresh] < self.most_depth[tree])
        splits.gain[~can] = 0.0
        self.stat = splits if self.stat is None else Splits(*[np.concatenate([a, b]) for a, b in zip(vars(self.stat).values(), vars(splits).values())])
        pick = np.flatnonzero((self.stat.gain > 0) & (self.left < 0))
        if self.leaves[0] is not None:
            pick = np.array(sorted(i for i in self._chosen() if self.left[i] < 0), np.int64)
        self.fresh = np.zeros(0, np.int64)
        if len(pick):
            made = len(self.left) + np.arange(2 * len(pick))
            self.left[pick], self.right[pick] = made[0::2], made[1::2]
            self.left, self.right = (np.append(x, np.full(2 * len(pick), -1)) for x in (self.left, self.right))
            self.tree = np.append(self.tree, np.repeat(self.tree[pick], 2))
            self.depth = np.append(self.depth, np.repeat(self.depth[pick] + 1, 2))
            with np.errstate(over="ignore"):
                key = np.repeat(self.key[pick], 2) * np.int64(6364136223846793005) + np.tile([1, 2], len(pick))
            self.key = np.append(self.key, key)
            self.fresh = made
        return pick

    def _chosen(self) -> list[int]:
        """Nodes that best-first growth splits in all trees, as far as gains are known."""
        gain, left, right = self.stat.gain.tolist(), self.left.tolist(), self.right.tolist()
        known, out = len(gain), []
        for t, leaves in enumerate(self.leaves):
            heap, room = [(-gain[t], t)] if gain[t] > 0 else [], leaves - 1
            while heap and room:
                _, i = heapq.heappop(heap)
                out.append(i)
                room -= 1
                for child in (left[i], right[i]):
                    if 0 <= child < known and gain[child] > 0:
                        heapq.heappush(heap, (-gain[child], child))
        return out

    def nodes(self, scale: float | np.ndarray, unit: float) -> tuple[Nodes, np.ndarray]:
        """The final trees, and for every grown node the final node that its rows belong to. `scale` may differ by tree."""
        left, right = self.left.copy(), self.right.copy()
        scale = np.broadcast_to(scale, self.trees)[self.tree]
        if self.leaves[0] is not None:
            split = np.zeros(len(left), bool)
            split[self._chosen()] = True
            left[~split] = right[~split] = -1
        own, final = list(range(len(left))), left.tolist()
        for i, (a, b) in enumerate(zip(self.left.tolist(), self.right.tolist())):  # parents come before their children
            if a >= 0 and (final[i] < 0 or own[i] != i):  # a cut-off child hands its rows up
                own[a] = own[b] = own[i]
        own = np.array(own)
        stay = np.flatnonzero(own == np.arange(len(left)))
        place = np.full(len(left), -1)
        place[stay] = np.arange(len(stay))
        with np.errstate(divide="ignore", invalid="ignore"):
            value = np.where(self.stat.h > 0, scale * unit * self.stat.g / self.stat.h, 0.0)
        pointer = lambda x: np.where(x[stay] < 0, -1, place[np.maximum(x[stay], 0)])
        return Nodes(self.tree[stay], self.stat.feature[stay], self.stat.cut[stay], pointer(left), pointer(right), value[stay]), place[own]


def histograms(codes: np.ndarray, rows: np.ndarray, slots: np.ndarray, g: np.ndarray, h: np.ndarray | None, count: int,
               shape: Shape, n: np.ndarray | None = None) -> np.ndarray:
    """(3, count, cells) sums of gradient, hessian (`n` if null) and rows (`n`, or one each) over (row, slot) entries."""
    out = np.zeros((3, count, shape.cells))
    for f, (first, size) in enumerate(zip(shape.first.tolist(), shape.sizes.tolist())):
        cell = slots * size + codes[f, rows]
        part = out[:, :, first:first + size]
        part[0] = np.bincount(cell, g, count * size).reshape(count, size)
        part[2] = np.bincount(cell, n, count * size).reshape(count, size)
        part[1] = part[2] if h is None else np.bincount(cell, h, count * size).reshape(count, size)
    return out


def _stretches(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All positions of several stretches, and which one each position belongs to."""
    which = np.repeat(np.arange(len(start)), size)
    return np.arange(len(which)) - np.repeat(np.cumsum(size) - size - start, size), which


class _Entries:
    """(tree, row) entries being routed: the entries of a node lie together in `order`."""

    def __init__(self, codes: np.ndarray, shape: Shape, trees: int, tree: np.ndarray, row: np.ndarray | None, g: np.ndarray,
                 h: np.ndarray | None, n: np.ndarray | None, joint: list[np.ndarray] | None):
        self.codes, self.shape, self.row, self.g, self.h, self.n = codes, shape, row, g, h, n
        self.joint = shape.together(codes) if joint is None else joint
        self.order = np.arange(len(tree))  # entries come tree by tree
        self.start = np.searchsorted(tree, np.arange(trees)).astype(np.int64)
        self.size = np.bincount(tree, minlength=trees).astype(np.int64)

    def split(self, pick: np.ndarray, left: np.ndarray, right: np.ndarray, stat: Splits) -> None:
        """The entries of the nodes `pick` go on to their children, `left` and `right`, in the order they had."""
        start, size = self.start[pick], self.size[pick]
        to_left = np.zeros(len(pick), np.int64)
        alone = size >= SMALL
        for k in np.flatnonzero(alone).tolist():
            part = self.order[start[k]:start[k] + size[k]]
            f = stat.feature[pick[k]]
            code = self.codes[f].take(self.row.take(part) if self.row is not None else part)
            goes = code == stat.cut[pick[k]] if self.shape.is_cat[f] else code <= stat.cut[pick[k]]
            first, rest = part.compress(goes), part.compress(~goes)  # much faster than a mask as an index
            part[:len(first)], part[len(first):] = first, rest
            to_left[k] = len(first)
        few = np.flatnonzero(~alone)
        if len(few):
            at, which = _stretches(start[few], size[few])
            part, node = self.order[at], pick[few][which]
            goes = _goes_left(self.codes, self.shape.is_cat, part if self.row is None else self.row[part], stat.feature[node], stat.cut[node])
            to_left[few] = np.bincount(which[goes], minlength=len(few))
            ends = np.cumsum(goes)
            nth = ends - goes - np.repeat(np.cumsum(to_left[few]) - to_left[few], size[few])  # entries before it that go left
            here = at - start[few][which]
            self.order[start[few][which] + np.where(goes, nth, to_left[few][which] + here - nth)] = part
        grown = max(int(left.max()), int(right.max())) + 1 - len(self.start)
        self.start, self.size = (np.append(x, np.zeros(max(grown, 0), np.int64)) for x in (self.start, self.size))
        self.start[left], self.size[left] = start, to_left
        self.start[right], self.size[right] = start + to_left, size - to_left

    def sums(self, ids: np.ndarray) -> np.ndarray:
        """Histograms of some nodes."""
        out = np.zeros((3, len(ids), self.shape.cells))
        start, size = self.start[ids], self.size[ids]
        alone = size >= 4 * SMALL
        some = np.flatnonzero(alone)
        if len(some):
            joint = [np.empty((3, len(some), cells)) for _, cells in self.shape.joint]
            for k, i in enumerate(some.tolist()):
                part = self.order[start[i]:start[i] + size[i]]
                rows, g = part if self.row is None else self.row.take(part), self.g.take(part)
                h, n = (None if x is None else x.take(part) for x in (self.h, self.n))
                for (_, cells), cell_of, total in zip(self.shape.joint, self.joint, joint):
                    cell = cell_of.take(rows).astype(np.intp)
                    total[0, k] = np.bincount(cell, g, cells)
                    total[2, k] = np.bincount(cell, n, cells)
                    if h is not None:
                        total[1, k] = np.bincount(cell, h, cells)
            found = np.empty((len(some), self.shape.cells))
            for c in (0, 1, 2) if self.h is not None else (0, 2):
                for k, total in enumerate(joint):
                    self.shape.apart(total[c], k, found)
                out[c, some] = found
            if self.h is None:
                out[1, some] = out[2, some]
        few = np.flatnonzero(~alone)
        if len(few):
            at, which = _stretches(start[few], size[few])
            part = self.order[at]
            h, n = (None if x is None else x[part] for x in (self.h, self.n))
            out[:, few] = histograms(self.codes, part if self.row is None else self.row[part], which, self.g[part], h, len(few), self.shape, n)
        return out

    def nodes(self, leaf: np.ndarray) -> np.ndarray:
        """The grown leaf of every entry."""
        out = np.empty(len(self.order), np.int64)
        ends = np.flatnonzero(leaf & (self.size[:len(leaf)] > 0))
        ends = ends[np.argsort(self.start[ends], kind="stable")]
        out[self.order] = np.repeat(ends, self.size[ends])
        return out


def grow(codes: np.ndarray, shape: Shape, specs: Sequence[TreeSpec], node: np.ndarray, row: np.ndarray | None,
         g: np.ndarray, h: np.ndarray | None, least: float, n: np.ndarray | None = None, joint: list[np.ndarray] | None = None,
         first_key: int = 0) -> tuple[Growth, np.ndarray]:
    """Trees over entries (node, row) that come tree by tree, all in memory; `node` is a tree's number, and a null `row`
    means all rows in turn. Also returns the grown node of every entry. An entry stands for `n` rows, or for one.

    The smaller child is summed, the other one is the rest, as long as the histograms of the open nodes fit
    `SLOTS`; wider levels are summed slice by slice."""
    growth, columns = Growth(specs, first_key), specs[0].columns
    entries = _Entries(codes, shape, len(specs), node, row, g, h, n, joint)
    judge = lambda hist, ids: best_splits(hist, shape, columns, growth.min_leaf[growth.tree[ids]], least, growth.key[ids])
    fresh, held, held_ids = None, None, np.zeros(0, np.int64)
    while True:
        ids = growth.fresh
        if fresh is None:
            parts = []
            for a in range(0, len(ids), SLOTS):
                hist = entries.sums(ids[a:a + SLOTS])
                parts.append(judge(hist, ids[a:a + SLOTS]))
            splits = Splits(*[np.concatenate(x) for x in zip(*(vars(p).values() for p in parts))])
            fresh = hist if len(parts) == 1 else None
        else:
            splits = judge(fresh, ids)
        pick = growth.learn(splits)
        if not len(pick):
            return growth, entries.nodes(growth.left < 0)
        if fresh is not None:
            use = growth.stat.gain[ids] > 0
            held = fresh[:, use] if held is None else np.concatenate([held, fresh[:, use]], axis=1)
            held_ids = np.append(held_ids, ids[use])
        entries.split(pick, growth.left[pick], growth.right[pick], growth.stat)
        where = np.searchsorted(held_ids, pick)
        known = len(held_ids) > 0 and bool((held_ids[np.minimum(where, len(held_ids) - 1)] == pick).all())
        if not known or 2 * len(pick) > SLOTS:
            fresh = None
            if growth.leaves[0] is None:
                held, held_ids = None, np.zeros(0, np.int64)
            continue
        small_left = growth.stat.left_n[pick] * 2 <= growth.stat.n[pick]
        small = entries.sums(np.where(small_left, growth.left[pick], growth.right[pick]))
        large = held[:, where] - small
        fresh = np.empty((3, 2 * len(pick), shape.cells))
        fresh[:, 0::2] = np.where(small_left[:, None], small, large)
        fresh[:, 1::2] = np.where(small_left[:, None], large, small)
        stay = np.ones(len(held_ids), bool)
        stay[where] = False
        held, held_ids = held[:, stay], held_ids[stay]


# ---- losses -----------------------------------------------------------------------------------

@dataclass(frozen=True)
class Start:
    """Where a model begins: its constant, and the units that gradients and hessians are counted in."""

    base: float
    unit: float
    unit_h: float
    mean: float

    @property
    def least(self) -> float:
        return LEAST_HESSIAN / self.unit_h


def start_of(spec: TreeSpec, n: int, total: float, low: float, high: float) -> Start:
    mean = total / n if n else 0.0
    bits = 52 - max(n, 1).bit_length()
    if spec.loss == "log":
        p = min(max(mean, 1e-12), 1 - 1e-12)
        return Start(math.log(p / (1 - p)), 2.0 ** -bits, 2.0 ** -bits, mean)
    return Start(mean, max(high - low, 1e-300) * 2.0 ** -bits, 1.0, mean)


def gradients(spec: TreeSpec, start: Start, y: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
    if spec.loss == "log":
        p = 1 / (1 + np.exp(-score))
        return np.rint((p - y) / start.unit), np.rint(p * (1 - p) / start.unit_h)
    return np.rint((score - y) / start.unit), None


def scale_of(spec: TreeSpec) -> float:
    return 1.0 if spec.loss == "mean" else -spec.rate


def tree_rows(spec: TreeSpec, tree: int, block: int, n: int) -> np.ndarray | None:
    """How often a tree sees each row: Poisson draws fixed by seed, tree and block; null means once."""
    if not spec.draws:
        return None
    return np.random.Generator(np.random.Philox(key=[spec.seed * 1_000_003 + tree, block])).poisson(1.0, n)


def tree_entries(spec: TreeSpec, start: Start, y: np.ndarray, train: np.ndarray, block: int, first: int, last: int,
                 times: np.ndarray | None = None):
    """(tree from 0, row, gradient, hessian) of trees first..last-1 over the training rows of a block, whose entries
    stand for `times` rows each."""
    trees, rows, weights = [], [], []
    at = np.flatnonzero(train)
    for t in range(first, last):
        w = tree_rows(spec, t, block, len(y))
        hit = at if w is None else at[w[at] > 0]
        trees.append(np.full(len(hit), t - first))
        rows.append(hit)
        weights.append((np.ones(len(hit)) if times is None else times[hit]) if w is None else w[hit].astype(float))
    row, weight = np.concatenate(rows), np.concatenate(weights)
    return np.concatenate(trees), row, weight * np.rint((y[row] - start.base) / start.unit), weight


# ---- a job: one model, read off at several lengths ------------------------------------------------

@dataclass(frozen=True)
class Job:
    """A model fitted on all folds but `held` (-1: on all rows), of interest after each of `stops` rounds or trees."""

    spec: TreeSpec
    held: int
    stops: tuple[int, ...]


class Block:
    """A block's arrays. `weight` says how many rows an entry stands for; null: one each. `parts` are the numbers and
    sizes of the blocks it was put together from."""

    def __init__(self, number: int, n: int, codes: bytes, y: bytes, fold: bytes, factor: bytes, truth: bytes, columns: int,
                 weight: bytes | None = None):
        self.number, self.n, self.parts = number, n, [(number, n)]
        self.codes = np.frombuffer(codes, np.uint16).reshape(columns, n)
        self.y, self.factor, self.truth = (np.frombuffer(b, np.float64) for b in (y, factor, truth))
        self.fold = np.frombuffer(fold, np.int32)
        self.weight = None if weight is None else np.frombuffer(weight, np.float64)

    @classmethod
    def joined(cls, blocks: Sequence[Block]) -> Block:
        if len(blocks) == 1:
            return blocks[0]
        blocks = sorted(blocks, key=lambda b: b.number)
        out = cls.__new__(cls)
        out.number, out.n, out.parts = blocks[0].number, sum(b.n for b in blocks), [p for b in blocks for p in b.parts]
        out.codes = np.concatenate([b.codes for b in blocks], axis=1)
        out.y, out.factor, out.truth, out.fold = (np.concatenate([getattr(b, k) for b in blocks]) for k in ("y", "factor", "truth", "fold"))
        out.weight = None if blocks[0].weight is None else np.concatenate([b.weight for b in blocks])
        return out

    def draws(self, spec: TreeSpec, tree: int) -> np.ndarray | None:
        """`tree_rows` of all its parts."""
        return np.concatenate([tree_rows(spec, tree, number, n) for number, n in self.parts]) if spec.draws else None


class Cells:
    """The different codes among some rows: `codes`, the one of each row, and the rows of each."""

    def __init__(self, codes: np.ndarray, shape: Shape, weight: np.ndarray | None):
        self.n, self.at, self.codes, self.rows = codes.shape[1], None, codes, weight
        if math.prod(shape.sizes.tolist()) < 1 << 62:
            key = np.zeros(self.n, np.int64)
            for f, size in enumerate(shape.sizes.tolist()):
                key = key * size + codes[f]
            _, first, at = np.unique(key, return_index=True, return_inverse=True)
            if len(first) <= 0.8 * self.n:
                self.at, self.codes = at, np.ascontiguousarray(codes[:, first])
                self.rows = np.bincount(at, weight, len(first)).astype(float)
        self.size = self.codes.shape[1]

    def total(self, values: np.ndarray | None) -> np.ndarray | None:
        """Values of the rows, added up for each."""
        return values if values is None or self.at is None else np.bincount(self.at, values, self.size)

    def of_rows(self, values: np.ndarray) -> np.ndarray:
        """Values of the cells (last axis), for every row."""
        return values if self.at is None else values[..., self.at]


def _block(r: dict, columns: int) -> Block:
    return Block(*[r[c] for c in ("block", "n", "codes", "y", "fold", "factor", "truth")], columns, r["weight"])


def _blocks(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[tuple[Block, dict]]:
    for batch in batches:
        for r in batch.to_pylist():
            yield _block(r, columns), r


def run_boosting(block: Block, shape: Shape, jobs: Sequence[Job]) -> tuple[Start, list[list[Nodes]], list[dict[int, np.ndarray]]]:
    """All rounds of jobs of one loss and held fold over a block that holds all rows, in step: the trees of each (if
    nothing is held out), and the held rows' scores at its stops."""
    specs, fold = [j.spec for j in jobs], jobs[0].held
    train, held = np.flatnonzero(block.fold != fold), np.flatnonzero(block.fold == fold)
    y, weight = block.y[train], None if block.weight is None else block.weight[train]
    start = start_of(specs[0], len(y) if weight is None else int(weight.sum()), y.sum() if weight is None else (y * weight).sum(),
                     y.min(initial=0.0), y.max(initial=0.0))
    cells, test = Cells(block.codes[:, train], shape, weight), Cells(block.codes[:, held], shape, None)
    n, joint = cells.size, shape.together(cells.codes)
    score, out = np.full((len(jobs), n), start.base), np.full((len(jobs), test.size), start.base)
    trees: list[list[Nodes]] = [[] for _ in jobs]
    marks: list[dict[int, np.ndarray]] = [{} for _ in jobs]
    live = list(range(len(jobs)))
    times = lambda x: x if x is None or weight is None else x * weight
    for r in range(max(max(j.stops) for j in jobs)):
        live = [m for m in live if r < max(jobs[m].stops)]
        k, sums = len(live), []
        for m in live:
            g, h = gradients(specs[0], start, y, cells.of_rows(score[m]))
            sums.append((cells.total(times(g)), cells.total(times(h))))
        g, h = (None if x[0] is None else np.concatenate(x) for x in zip(*sums))
        growth, node = grow(cells.codes, shape, [specs[m] for m in live], np.repeat(np.arange(k), n),
                            None if k == 1 else np.tile(np.arange(n), k), g, h, start.least, None if cells.rows is None else np.tile(cells.rows, k), joint)
        tree, own = growth.nodes(np.array([scale_of(specs[m]) for m in live]), start.unit / start.unit_h)
        score[live] += tree.value[own[node]].reshape(k, n)
        for i, m in enumerate(live):
            if len(held):
                tree.add_values(out[m], test.codes, shape.is_cat, i)
            elif fold < 0:
                trees[m].append(tree if k == 1 else tree.one(i))
            if r + 1 in jobs[m].stops:
                marks[m][r + 1] = test.of_rows(out[m]).copy()
    return start, trees, marks


def run_trees(block: Block, shape: Shape, job: Job, first: int, last: int) -> tuple[Start, Nodes, np.ndarray]:
    """Trees first..last-1 of a forest over a block that holds all rows, and the sum of their scores of the held rows."""
    spec, train = job.spec, np.flatnonzero(block.fold != job.held)
    y, weight = block.y[train], None if block.weight is None else block.weight[train]
    start = start_of(spec, len(y) if weight is None else int(weight.sum()), y.sum() if weight is None else (y * weight).sum(),
                     y.min(initial=0.0), y.max(initial=0.0))
    cells, test = Cells(block.codes[:, train], shape, weight), Cells(block.codes[:, block.fold == job.held], shape, None)
    joint, g_row, every = shape.together(cells.codes), np.rint((y - start.base) / start.unit), np.arange(cells.size)
    specs, made, scores = replace(spec, seed=spec.seed + first), [], np.zeros(test.size)
    step = max(1, min(last - first, ENTRIES // max(cells.size, 1)))
    for a in range(first, last, step):
        trees, rows, sums = [], [], []
        for t in range(a, min(a + step, last)):
            w = block.draws(spec, t)
            w = weight if w is None else w[train].astype(float)
            n = cells.rows if not spec.draws else cells.total((w > 0).astype(float))
            total = (cells.total(g_row if w is None else g_row * w), cells.rows if not spec.draws else cells.total(w), n)
            hit = every if n is None else np.flatnonzero(n > 0)
            trees.append(np.full(len(hit), t - a))
            rows.append(hit)
            sums.append([None if x is None else x[hit] for x in total])
        g, h, n = (None if x[0] is None else np.concatenate(x) for x in zip(*sums))
        tree = np.concatenate(trees)
        growth, _ = grow(cells.codes, shape, [specs] * (min(a + step, last) - a), tree, np.concatenate(rows), g, h, start.least, n, joint, a - first)
        nodes, _ = growth.nodes(1.0, start.unit)
        scores += nodes.scores(test.codes, shape.is_cat, 0, min(a + step, last) - a)
        made.append(nodes)
    return start, join_nodes(made), test.of_rows(scores)


def _tasks(jobs: Sequence[Job], entries: int = 0) -> list[tuple[tuple[int, ...], int, int]]:
    """(jobs, first, last): boosting jobs of one loss, fold and length go together, as many as `ENTRIES` allows; forests
    in runs of trees that end at the stops."""
    out, alike = [], {}
    for j, job in enumerate(jobs):
        if job.spec.loss != "mean":
            alike.setdefault((job.spec.loss, job.held, max(job.stops), job.spec.leaves is None), []).append(j)
            continue
        ends = sorted({*job.stops, *range(TREES_PER_TASK, max(job.stops), TREES_PER_TASK)})
        out += [((j,), a, b) for a, b in zip([0, *ends[:-1]], ends)]
    step = max(1, min(JOBS_PER_TASK, ENTRIES // max(entries, 1)))
    for (_, _, rounds, _), group in alike.items():
        group = sorted(group, key=lambda j: jobs[j].spec.leaves or 0)
        out += [(tuple(group[a:a + step]), 0, rounds) for a in range(0, len(group), step)]
    return sorted(out, key=lambda t: (t[1] - t[2]) * len(t[0]))


FITTED = "job int, stop int, piece int, part int, base double, scores binary, truth binary, factor binary, weight binary, trees binary"


def _in_tasks(blocks: DataFrame, shape: Shape, jobs: Sequence[Job], pieces: int, entries: int) -> DataFrame:
    """Every job over all blocks put together, each in a task of its own."""
    tasks, columns = _tasks(jobs, entries), len(shape.sizes)

    def fitted(block: Block, task: int) -> Iterator[pa.RecordBatch]:
        group, first, last = tasks[task]
        some = [jobs[j] for j in group]
        keep = block.fold == some[0].held
        truth, factor, weight = block.truth[keep], block.factor[keep], None if block.weight is None else block.weight[keep]
        if some[0].spec.loss == "mean":
            start, nodes, scores = run_trees(block, shape, some[0], first, last)
            found = [([nodes], {s: scores / s + (start.base if not first else 0.0) for s in some[0].stops if s >= last})]
        else:
            start, trees, marks = run_boosting(block, shape, some)
            found = list(zip(trees, marks))
        for j, (trees, marks) in zip(group, found):
            packed = pickle.dumps(join_nodes(trees)) if jobs[j].held < 0 else None
            for stop, value in marks.items():
                for piece, a in enumerate(range(0, max(len(value), 1), HELD)):
                    cut = lambda x: x[a:a + HELD].tobytes()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x], pa.int32()) for x in (j, stop, piece, first)] + [pa.array([start.base])] + [
                            pa.array([x], pa.binary()) for x in (cut(value), cut(truth), cut(factor), None if weight is None else cut(weight), packed)],
                        names=[f.split()[0] for f in FITTED.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list[Block]] = {}
        for block, row in _blocks(batches, columns):
            key = tuple(row["tasks"])
            held.setdefault(key, []).append(block)
            if len(held[key]) == pieces:
                whole = Block.joined(held.pop(key))
                for task in key:
                    yield from fitted(whole, task)

    size = (columns * 2 + 36) * entries * len(tasks) / 1e6
    if pieces == 1 and size <= SPREAD_MB:
        spread = blocks.withColumn("tasks", F.explode(F.sequence(F.lit(0), F.lit(len(tasks) - 1)))).repartitionByRange(len(tasks), "tasks")
        return spread.withColumn("tasks", F.array("tasks")).mapInArrow(run, FITTED)
    # each task reads all blocks: nothing is shuffled; short jobs share a task
    n = min(len(tasks), 4 * blocks.sparkSession.sparkContext.defaultParallelism)
    spread = reduce(DataFrame.union, [blocks.coalesce(1).withColumn("tasks", F.array(*[F.lit(t) for t in range(i, len(tasks), n)])) for i in range(n)])
    return spread.mapInArrow(run, FITTED)


# ---- many blocks: one Spark job per pass ------------------------------------------------------------

CELLS = "model int, node long, cell int, g long, h long, n long"
FOUND = "model int, node long, g double, h double, n double, gain double, feature long, cut long, left_n double"


def _pass(state: DataFrame, shape: Shape, jobs: Sequence[Job], starts: Sequence[Start], growths: Sequence[Growth]) -> list[Splits]:
    """Statistics of the fresh nodes of all models: histograms per block, summed by Spark, judged per node."""
    columns = len(shape.sizes)
    routes = [None if not len(w.fresh) else Nodes(w.tree, *(np.append(x, np.zeros(len(w.fresh), np.int64)) for x in (
        (w.stat.feature, w.stat.cut) if w.stat else (np.zeros(0, np.int64),) * 2)), w.left, w.right, None) for w in growths]
    fresh = [w.fresh for w in growths]
    shared = state.sparkSession.sparkContext.broadcast((shape, list(jobs), list(starts), routes, fresh, [w.key for w in growths]))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape, jobs, starts, routes, fresh, _ = shared.value
        for block, r in _blocks(batches, columns):
            scores = None if r["scores"] is None else np.frombuffer(r["scores"], np.float64).reshape(len(jobs), block.n)
            for m, job in enumerate(jobs):
                if routes[m] is None:
                    continue
                train = block.fold != job.held
                if job.spec.loss == "mean":
                    tree, row, g, h = tree_entries(job.spec, starts[m], block.y, train, block.number, 0, max(job.stops), block.weight)
                else:
                    row = np.flatnonzero(train)
                    tree = np.zeros(len(row), np.int64)
                    g, h = gradients(job.spec, starts[m], block.y[row], scores[m][row])
                    if block.weight is not None:
                        g, h = g * block.weight[row], block.weight[row] if h is None else h * block.weight[row]
                n = None if block.weight is None else block.weight[row]
                node = routes[m].leaves_of(block.codes[:, row], shape.is_cat, tree)
                for a in range(0, len(fresh[m]), SLOTS):
                    low = fresh[m][a]
                    part = np.flatnonzero((node >= low) & (node < low + SLOTS))
                    hist = histograms(block.codes, row[part], node[part] - low, g[part], None if h is None else h[part],
                                      min(SLOTS, len(fresh[m]) - a), shape, None if n is None else n[part])
                    at, cell = np.nonzero(hist[2])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), m, np.int32)), pa.array(at + low), pa.array(cell.astype(np.int32)),
                         *[pa.array(hist[k, at, cell].astype(np.int64)) for k in range(3)]], names=[f.split()[0] for f in CELLS.split(", ")])

    def judge(table: pa.Table) -> pa.Table:
        shape, jobs, starts, _, _, keys = shared.value
        m, node = table.column("model")[0].as_py(), table.column("node")[0].as_py()
        hist = np.zeros((3, 1, shape.cells))
        for k, c in enumerate("ghn"):
            hist[k, 0, table.column("cell").to_numpy()] = table.column(c).to_numpy()
        best = best_splits(hist, shape, jobs[m].spec.columns, np.array([jobs[m].spec.min_leaf]), starts[m].least, keys[m][[node]])
        return pa.table({"model": pa.array([m], pa.int32()), "node": [node],
                         **{k: pa.array(v, pa.int64() if k in ("feature", "cut") else pa.float64()) for k, v in vars(best).items()}})

    summed = state.mapInArrow(count, CELLS).groupBy("model", "node", "cell").agg(*[F.sum(c).alias(c) for c in "ghn"])
    found = summed.groupBy("model", "node").applyInArrow(judge, FOUND).collect()  # a few numbers per new node
    shared.destroy()
    out = []
    for m, w in enumerate(growths):
        size = len(w.fresh)
        splits = Splits(*[np.zeros(size, np.int64 if k in (4, 5) else float) for k in range(7)])
        for r in found:
            if r["model"] == m:
                for k, values in vars(splits).items():
                    values[r["node"] - w.fresh[0]] = r[k]
        out.append(splits)
    return out


def _grow_all(state: DataFrame, shape: Shape, jobs: Sequence[Job], starts: Sequence[Start]) -> list[Growth]:
    growths = [Growth([j.spec] * (max(j.stops) if j.spec.loss == "mean" else 1)) for j in jobs]
    while any(len(w.fresh) for w in growths):
        for w, splits in zip(growths, _pass(state, shape, jobs, starts, growths)):
            if len(w.fresh):
                w.learn(splits)
    return growths


def _in_step(blocks: DataFrame, shape: Shape, jobs: Sequence[Job]) -> list[tuple[Start, Nodes]]:
    """All jobs of one kind over many blocks, in step: the trees of each."""
    spark, columns = blocks.sparkSession, len(shape.sizes)
    sums = _fold_sums(blocks, columns)
    starts = []
    for j in jobs:
        rows = [r for f, r in sums.items() if f != j.held]
        starts.append(start_of(j.spec, sum(r[0] for r in rows), math.fsum(r[1] for r in rows),
                               min((r[2] for r in rows), default=0.0), max((r[3] for r in rows), default=0.0)))
    plain = blocks.withColumn("scores", F.lit(None).cast("binary"))
    if jobs[0].spec.loss == "mean":
        return [(s, w.nodes(1.0, s.unit)[0]) for s, w in zip(starts, _grow_all(plain, shape, jobs, starts))]
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in plain.schema.fields)

    def renew(rows: DataFrame, new: list[Nodes] | None) -> DataFrame:
        """The score of every row under every model, with the trees of a round added."""
        shared = spark.sparkContext.broadcast((shape.is_cat, [s.base for s in starts], new))

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            is_cat, bases, trees = shared.value
            for batch in batches:
                for i in range(batch.num_rows):
                    one = batch.slice(i, 1)
                    (block, r), = _blocks([one], columns)
                    if trees is None:
                        scores = np.repeat(np.array(bases)[:, None], block.n, axis=1)
                    else:
                        scores = np.frombuffer(r["scores"], np.float64).reshape(len(bases), block.n).copy()
                        for m, t in enumerate(trees):
                            if t is not None:
                                scores[m] += t.scores(block.codes, is_cat, 0, 1)
                    yield pa.RecordBatch.from_arrays([*one.columns[:-1], pa.array([scores.tobytes()], pa.binary())], names=one.schema.names)

        return rows.mapInArrow(add, fields)

    trees: list[list[Nodes]] = [[] for _ in jobs]
    state, old = renew(plain, None).persist(StorageLevel.MEMORY_AND_DISK), None
    for r in range(max(max(j.stops) for j in jobs)):
        live = [m for m, j in enumerate(jobs) if r < max(j.stops)]
        grown = _grow_all(state, shape, jobs, starts) if len(live) == len(jobs) else \
            _grow_some(state, shape, jobs, starts, live)
        new: list[Nodes | None] = [None] * len(jobs)
        for m in live:
            new[m] = grown[m].nodes(scale_of(jobs[m].spec), starts[m].unit / starts[m].unit_h)[0]
            trees[m].append(new[m])
        old, state = state, renew(state, new)
        if r % ROUNDS_KEPT == ROUNDS_KEPT - 1:
            path = scratch_path(spark, "scores")
            state.write.parquet(path)
            state = spark.read.parquet(path)
        state = state.persist(StorageLevel.MEMORY_AND_DISK)
        state.count()
        old.unpersist()
    state.unpersist()
    return [(s, join_nodes(t)) for s, t in zip(starts, trees)]


def _grow_some(state: DataFrame, shape: Shape, jobs: Sequence[Job], starts: Sequence[Start], live: list[int]) -> dict[int, Growth]:
    """As `_grow_all`, leaving out the models that have all their rounds."""
    growths = [Growth([j.spec]) for j in jobs]
    for m, w in enumerate(growths):
        if m not in live:
            w.fresh = np.zeros(0, np.int64)
    while any(len(w.fresh) for w in growths):
        for w, splits in zip(growths, _pass(state, shape, jobs, starts, growths)):
            if len(w.fresh):
                w.learn(splits)
    return dict(enumerate(growths))


def _fold_sums(blocks: DataFrame, columns: int) -> dict[int, tuple]:
    """Per fold: rows, sum, least and greatest target."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _ in _blocks(batches, columns):
            folds, at = np.unique(block.fold, return_inverse=True)
            parts = [block.y[at == k] for k in range(len(folds))]
            times = [np.ones(len(p)) if block.weight is None else block.weight[at == k] for k, p in enumerate(parts)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(folds.astype(np.int32)), pa.array([int(w.sum()) for w in times]), pa.array([math.fsum(p * w) for p, w in zip(parts, times)]),
                 *[pa.array([float(f(p)) for p in parts]) for f in (min, max)]], names=["fold", "n", "total", "low", "high"])

    rows = blocks.mapInArrow(run, "fold int, n long, total double, low double, high double").groupBy("fold").agg(
        F.sum("n"), F.sum("total"), F.min("low"), F.max("high")).collect()
    return {r[0]: tuple(r[1:]) for r in rows}


# ---- entry points ---------------------------------------------------------------------------------

def _shape(bins: Bins) -> Shape:
    return Shape(bins.sizes, bins.is_cat)


def _whole(blocks: DataFrame) -> tuple[bool, int, int]:
    """Whether a task may hold all blocks, how many there are, and their entries."""
    pieces, entries = blocks.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    return pieces < 2 or entries <= WHOLE, pieces, entries


def fit(blocks: DataFrame, bins: Bins, spec: TreeSpec, classifies: bool = False) -> Ensemble:
    """One model over all rows of the blocks."""
    shape, job = _shape(bins), Job(spec, -1, (spec.rounds,))
    fits, pieces, entries = _whole(blocks)
    if fits:
        rows = sorted(_in_tasks(blocks, shape, [job], pieces, entries).select("part", "base", "trees").collect(), key=lambda r: r["part"])
        base, nodes = (rows[0]["base"], join_nodes([pickle.loads(r["trees"]) for r in rows])) if rows else (0.0, None)
        if nodes is None:
            nodes = Nodes(*[np.zeros(0, np.int64) for _ in range(5)], np.zeros(0))
            spec = replace(spec, rounds=0)
    else:
        (start, nodes), = _in_step(blocks, shape, [job])
        base = start.base
    return Ensemble(bins, spec, base, nodes, spec.rounds, classifies)


def predict_folds(blocks: DataFrame, bins: Bins, jobs: Sequence[Job]) -> DataFrame:
    """job, stop, label, prediction and p1 (scores of classifiers) of every held row under every job."""
    shape = _shape(bins)
    classifies = [j.spec.loss == "log" for j in jobs]
    fits, pieces, entries = _whole(blocks)
    if fits:
        scored = _in_tasks(blocks, shape, jobs, pieces, entries).drop("trees", "base")
        if any(j.spec.loss == "mean" for j in jobs):  # the runs of trees of a forest
            def add(table: pa.Table) -> pa.Table:
                total = sum(np.frombuffer(b, np.float64) for b in table.sort_by("part").column("scores").to_pylist())
                one = table.slice(0, 1).combine_chunks()
                return one.set_column(one.schema.get_field_index("scores"), "scores", pa.array([total.tobytes()], pa.binary()))

            scored = scored.groupBy("job", "stop", "piece").applyInArrow(add, scored.schema)
    else:
        kinds = [[m for m, j in enumerate(jobs) if (j.spec.loss == "mean") == mean] for mean in (True, False)]
        models: dict[int, tuple[Start, Nodes]] = {}
        for kind in kinds:
            if kind:
                models |= dict(zip(kind, _in_step(blocks, shape, [jobs[m] for m in kind])))
        shared = blocks.sparkSession.sparkContext.broadcast((shape, list(jobs), models))
        columns = len(shape.sizes)

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            shape, jobs, models = shared.value
            for block, _ in _blocks(batches, columns):
                for m, job in enumerate(jobs):
                    held = block.fold == job.held
                    if not held.any():
                        continue
                    (start, nodes), total, done = models[m], np.zeros(int(held.sum())), 0
                    for s in sorted(job.stops):
                        total = total + nodes.scores(block.codes[:, held], shape.is_cat, done, s)
                        done = s
                        value = start.base + (total / s if job.spec.loss == "mean" else total)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([m], pa.int32()), pa.array([s], pa.int32()),
                             *[pa.array([x.tobytes()], pa.binary()) for x in (value, block.truth[held], block.factor[held])],
                             pa.array([None if block.weight is None else block.weight[held].tobytes()], pa.binary())],
                            names=["job", "stop", "scores", "truth", "factor", "weight"])

        scored = blocks.mapInArrow(score, "job int, stop int, scores binary, truth binary, factor binary, weight binary")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                raw, truth, factor = (np.frombuffer(r[c], np.float64) for c in ("scores", "truth", "factor"))
                if r["weight"] is not None:
                    times = np.frombuffer(r["weight"], np.float64).astype(np.int64)
                    raw, truth, factor = (np.repeat(x, times) for x in (raw, truth, factor))
                p1 = 1 / (1 + np.exp(-raw)) if classifies[r["job"]] else np.clip(raw, 0.0, 1.0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(raw), r["job"], np.int32)), pa.array(np.full(len(raw), r["stop"], np.int32)),
                     pa.array(truth), pa.array(raw * factor), pa.array(p1)], names=["job", "stop", "label", "prediction", "p1"])

    return scored.mapInArrow(rows, "job int, stop int, label double, prediction double, p1 double")
