"""Random forests on blocks of binned rows.

As in ``boosting``, the rows are binned once and written as blocks; here a row is one byte a feature (its bin and its class).
All trees grow together, a level at a time.  A task descends the grown levels with each tree's sample of its rows and adds
up one table a tree, by slot (one of a node's drawn features), node, bin and class; the tables of a tree are added up and
split where they meet after a shuffle, so the driver gets one split a node.  A pass takes as many trees as have tables of
TABLES_MB together, so memory depends on neither rows nor trees.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from connlens.functions.arrays import argmax
from connlens.operators.boosting import _binned, feature_cuts, write_blocks
from connlens.session import drop_table, ship_package

TABLES_MB = 32
#: A row is drawn more than i times if its 16 random bits reach the i-th bound: a Poisson variate of mean 1.
DRAWN = [round(65536 * b) for b in np.cumsum([math.exp(-1) / math.factorial(i) for i in range(9)]) if b < 1 - 2 ** -17]
NEVER = 1 << 30


@dataclass
class Tree:
    """Nodes as arrays: rows whose bin of ``feature`` reaches ``cut`` go to ``left`` + 1, others to ``left``; a leaf leads to
    itself.  Per node the weights of its classes, and whether it is to be split; ``drawn`` has the open nodes' features."""
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    counts: np.ndarray
    open: np.ndarray
    drawn: np.ndarray | None = None

    @staticmethod
    def root(classes: int) -> Tree:
        return Tree(np.zeros(1, np.int64), np.full(1, NEVER), np.zeros(1, np.int64), np.zeros((1, classes)), np.ones(1, bool))

    def draw(self, rng, features: int, slots: int) -> None:
        self.drawn = np.argsort(rng.random((int(self.open.sum()), features)), axis=1)[:, :slots]

    def descend(self, x, start, classes: int, levels: int):
        """The nodes of rows whose codes (bin * classes + class) begin at ``start`` of ``x``."""
        node, cut = np.zeros(len(start), np.int64), self.cut * classes
        for _ in range(levels):
            at = self.feature[node]
            at += start
            node = self.left[node] + (x[at] >= cut[node])
        return node

    def grown(self, splits: np.ndarray, last: bool) -> Tree:
        """The tree with its open nodes split; ``splits`` has a row a node: feature, cut (0: none), the classes' weights at
        its left and in all."""
        classes = self.counts.shape[1]
        at = np.flatnonzero(self.open)
        counts = self.counts.copy()
        counts[at] = splits[:, 2 + classes:]
        cut = splits[:, 1].astype(np.int64)
        parts, at = splits[cut > 0], at[cut > 0]
        n, more = len(self.cut), 2 * len(at)
        children = np.empty((more, classes))
        children[::2], children[1::2] = parts[:, 2:2 + classes], parts[:, 2 + classes:] - parts[:, 2:2 + classes]
        out = Tree(np.r_[self.feature, np.zeros(more, np.int64)], np.r_[self.cut, np.full(more, NEVER)], np.r_[self.left, n + np.arange(more)],
                   np.r_[counts, children], np.r_[np.zeros(n, bool), (children > 0).sum(axis=1) > (classes if last else 1)])
        out.feature[at], out.cut[at], out.left[at] = parts[:, 0], parts[:, 1], n + 2 * np.arange(len(at))
        return out

    def pruned(self) -> Tree:
        """Two leaves of one node that predict the same class become one, as in MLlib."""
        best = self.counts.argmax(axis=1)
        for i in reversed(range(len(self.cut))):
            c = self.left[i]
            if c != i and self.left[c] == c and self.left[c + 1] == c + 1 and best[c] == best[c + 1]:
                self.feature[i], self.cut[i], self.left[i] = 0, NEVER, i
        return self


def _tables(blocks, trees: dict[int, Tree], level: int, features: int, classes: int, width: int, bootstrap: bool, seed: int) -> dict:
    """Of each tree, the weights of a task's rows by slot, open node, and code of bin and class."""
    held, place = {}, {}
    for t, tree in trees.items():
        k = int(tree.open.sum())
        place[t] = np.where(tree.open, np.cumsum(tree.open) - 1, k)  # rows of closed nodes share a place after the others
        held[t] = np.zeros((tree.drawn.shape[1], k + 1, width))
    for block in blocks:
        x = np.frombuffer(block["x"], np.uint8 if width <= 256 else np.uint16)
        n = len(x) // features
        given = np.frombuffer(block["weight"]) if "weight" in block else None
        for t, tree in trees.items():
            if bootstrap:
                bits = np.random.SFC64([seed, t, block["block"]]).random_raw((n + 3) // 4).view(np.uint16)[:n]
                rows = np.flatnonzero(bits >= DRAWN[0])
                bits, times = bits[rows], np.ones(len(rows), np.uint8)
                for bound in DRAWN[1:]:
                    times += bits >= bound
                weight = times.astype(np.float64)
            else:
                rows, weight = np.arange(n), np.ones(n)
            if given is not None:
                weight *= given[rows]
            start = rows * features
            node = place[t][tree.descend(x, start, classes, level)]
            drawn = np.vstack([tree.drawn, np.zeros_like(tree.drawn[:1])])
            first = node * width
            for slot, table in enumerate(held[t]):
                at = np.ascontiguousarray(drawn[:, slot])[node]
                at += start
                table += np.bincount(first + x[at], weights=weight, minlength=table.size).reshape(table.shape)
    return {t: h[:, :-1] for t, h in held.items()}


def _splits(table, drawn, classes: int):
    """Of each node the split with the largest gain of the Gini impurity, the first of equal ones; from sums by slot, node, bin and class."""
    total = table[0].sum(axis=1)
    left = np.cumsum(table, axis=2)[:, :, :-1]
    right = total[None, :, None] - left
    nl, nr, n = left.sum(axis=-1), right.sum(axis=-1), total.sum(axis=-1)
    ok = (nl > 1e-9 * n[:, None]) & (nr > 1e-9 * n[:, None])
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(ok, (left ** 2).sum(axis=-1) / nl + (right ** 2).sum(axis=-1) / nr, -np.inf)
        whole = (total ** 2).sum(axis=-1) / n
    slots, nodes, cuts = gain.shape
    flat = gain.transpose(1, 0, 2).reshape(nodes, slots * cuts)
    every = np.arange(nodes)
    best = flat.argmax(axis=1)
    slot, cut = best // max(cuts, 1), best % max(cuts, 1)
    found = flat[every, best] > whole + 1e-12 * n
    return np.c_[drawn[every, slot], np.where(found, cut + 1, 0), left[slot, every, cut], total]


def _grow_level(blocks: DataFrame, trees: dict[int, Tree], level: int, last: bool, features: int, classes: int, bins: int, bootstrap: bool, seed: int) -> dict:
    """The trees a level deeper, from one pass over the blocks."""
    width = bins * classes

    def add_up(batches):
        rows = ({c: v.as_py() for c, v in zip(batch.schema.names, row)} for batch in batches for row in zip(*batch.columns))
        for t, table in _tables(rows, trees, level, features, classes, width, bootstrap, seed).items():
            yield pa.RecordBatch.from_pydict({"tree": pa.array([t], pa.int32()), "sums": pa.array([table.tobytes()], pa.binary())})

    def split(batches):
        total: dict = {}
        for batch in batches:
            for t, sums in zip(*batch.columns):
                a = np.frombuffer(sums.as_buffer())
                t = t.as_py()
                total[t] = total[t] + a if t in total else a
        for t, a in total.items():
            drawn = trees[t].drawn
            best = _splits(a.reshape(drawn.shape[1], len(drawn), bins, classes), drawn, classes)
            yield pa.RecordBatch.from_pydict({"tree": pa.array([t], pa.int32()), "splits": pa.array([best.tobytes()], pa.binary())})

    cores = blocks.sparkSession.sparkContext.defaultParallelism
    sums = blocks.coalesce(2 * cores).mapInArrow(add_up, "tree int, sums binary").repartition(min(cores, len(trees)), "tree")
    found = sums.mapInArrow(split, "tree int, splits binary").collect()
    return {r["tree"]: trees[r["tree"]].grown(np.frombuffer(r["splits"]).reshape(-1, 2 + 2 * classes), last) for r in found}


@dataclass
class RandomForest:
    """A forest; ``transform`` adds rawPrediction (the sum of the trees' class shares), probability and prediction, as MLlib's does."""
    cuts: list[list[float]]
    classes: int
    trees: list[Tree] = field(default_factory=list)

    def votes(self, features):
        cuts, classes, trees = self.cuts, self.classes, self.trees

        @F.arrow_udf("array<double>")
        def votes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            shares = [t.counts / np.maximum(t.counts.sum(axis=1, keepdims=True), 1e-300) for t in trees]
            depths = [_depth(t) for t in trees]
            for batch in batches:
                x = np.stack(_binned(batch, cuts), axis=1).astype(np.uint8 if max(map(len, cuts)) < 256 else np.uint16).ravel()
                start = np.arange(len(batch)) * len(cuts)
                out = np.zeros((len(batch), classes))
                for tree, share, depth in zip(trees, shares, depths):
                    out += share[tree.descend(x, start, 1, depth)]
                yield pa.ListArray.from_arrays(np.arange(0, out.size + 1, classes, dtype=np.int32), pa.array(out.ravel()))

        return votes(vector_to_array(features))

    def transform(self, df: DataFrame) -> DataFrame:
        ship_package(df.sparkSession)
        n = len(self.trees)
        return df.withColumn("_votes", self.votes("features")).withColumn("rawPrediction", array_to_vector("_votes")).withColumn(
            "probability", array_to_vector(F.transform("_votes", lambda v: v / n))).withColumn("prediction", argmax("_votes").cast("double")).drop("_votes")


def _depth(tree: Tree) -> int:
    depth, at = 0, np.zeros(1, np.int64)
    while True:
        inner = at[tree.left[at] != at]
        if not len(inner):
            return depth
        depth, at = depth + 1, np.r_[tree.left[inner], tree.left[inner] + 1]


def fit_forest(train: DataFrame, label: str, n_trees: int, max_depth: int, weight: str | None = None, seed: int = 42,
               slots: int | None = None, bootstrap: bool = True, n_bins: int = 32) -> RandomForest:
    """A forest of Gini trees as MLlib grows them: each tree has a Poisson sample of the rows, each node draws ``slots``
    features (by default the root of their number, rounded up)."""
    x = vector_to_array("features")
    last = train.agg(F.max(label)).first()[0]
    classes = max(int(last or 0) + 1, 2)
    k = train.schema["features"].metadata.get("ml_attr", {}).get("num_attrs") or train.select(F.size(x)).first()[0]
    slots = slots or math.ceil(math.sqrt(k))
    cuts = feature_cuts(train.select(x.alias("x")), k, n_bins)
    bins = max(1, *map(len, cuts)) + 1
    code = "uint8" if bins * classes <= 256 else "uint16"

    def codes_of(batch):
        y = batch.column("y").to_numpy(zero_copy_only=False).astype(np.int64)
        codes = [(np.stack(_binned(batch.column("x"), cuts), axis=1) * classes + y[:, None]).ravel()]
        return codes + ([batch.column("w").to_numpy(zero_copy_only=False)] if weight else [])

    rows = train.select(F.col(label).cast("int").alias("y"), x.alias("x"), *([F.col(weight).cast("double").alias("w")] if weight else []))
    blocks = write_blocks(rows, codes_of, {"x": code} | ({"weight": "float64"} if weight else {}), "forest-blocks")
    trees = {t: Tree.root(classes) for t in range(n_trees)}
    for level in range(max_depth):
        growing = [t for t, tree in trees.items() if tree.open.any()]
        while growing:
            some, size = {}, 0.0
            while growing and (not some or size < TABLES_MB << 20):
                t = growing.pop()
                trees[t].draw(np.random.default_rng([seed, t, level]), k, slots)
                some[t] = trees[t]
                size += 8 * trees[t].drawn.size * bins * classes
            trees |= _grow_level(blocks, some, level, level + 1 == max_depth, k, classes, bins, bootstrap, seed)
    drop_table(blocks)
    return RandomForest(cuts, classes, [trees[t].pruned() for t in range(n_trees)])
