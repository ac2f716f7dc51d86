"""Second-order gradient boosting (logistic loss) on binned features.

Each round fits one tree to the gradients and Hessians of the loss at the
present margins. A tree grows level by level, and a level takes one aggregate
over all rows: the sums of gradients and Hessians by (node, feature, bin). The
best cut of a node maximises

    G_L^2 / (H_L + l2) + G_R^2 / (H_R + l2) - G^2 / (H + l2)

and a leaf is worth ``-rate * G / (H + l2)``. Only those sums, whose number is
bounded by nodes x features x bins whatever the data, reach the driver.

Rows are packed once into blocks (one byte for each feature), written, and kept
in memory or on disk by the executors while the model is fitted, one partition for each core. Of two siblings only
one is summed up; the other has the rest of its parent's sums.
Gradients are summed as integers (multiples of a power of two, as fine as 64
bits hold for the number of rows), so sums are exact and the model is the same
for any partitioning. A task works out a block's margins
from the trees sent along; a worker that has seen the block before adds only
the newest ones. Nothing depends on that memory: a lost executor costs time."""

from __future__ import annotations

import math
from collections import OrderedDict
from dataclasses import dataclass, field
from uuid import uuid4

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekpanel.operators.fitted import Classifier
from weekpanel.session import cut_lineage

BINS = 256
BLOCK_ROWS = 1 << 16
LEAST_ROWS = 1 << 12  # blocks are not made smaller than this to give every core one
SLICE = 1 << 14  # sums that Spark adds up as one record
DIRECT_BYTES = 1 << 26  # histograms of all tasks up to this size come straight to the driver; larger ones are summed by Spark first
REMEMBERED_BLOCKS = 256

_BLOCK = "block string, n int, bins binary, y binary, w binary"


@dataclass
class Forest:
    """Trees as arrays of shape (trees, nodes); the children of node i are 2 i + 1 and 2 i + 2."""

    depth: int
    feature: np.ndarray  # -1: a leaf or no node
    bin: np.ndarray  # rows with a greater bin go right
    threshold: np.ndarray  # the same cut as a value
    value: np.ndarray  # margin that a leaf adds
    cover: np.ndarray  # sum of Hessians

    @classmethod
    def empty(cls, depth: int) -> Forest:
        n = 2 ** (depth + 1) - 1
        return cls(depth, *(np.zeros((0, n), t) for t in (np.int32, np.int32, np.float64, np.float64, np.float64)))

    def grown(self, tree: dict) -> Forest:
        return Forest(self.depth, *(np.vstack((getattr(self, k), tree[k][None])) for k in ("feature", "bin", "threshold", "value", "cover")))

    def for_margins(self) -> Forest:
        """Without what only explanations need, to be sent to tasks."""
        nothing = np.zeros((len(self.feature), 0))
        return Forest(self.depth, self.feature, self.bin, nothing, self.value, nothing)

    def leaves(self, tree: int, x: np.ndarray, cut: np.ndarray) -> np.ndarray:
        """Node that every row of ``x`` ends in; ``cut`` is ``bin`` or ``threshold``."""
        feature, cut, columns, rows = self.feature[tree], cut[tree], np.ascontiguousarray(x.T).ravel(), np.arange(len(x))
        splits, start = feature >= 0, np.maximum(feature, 0).astype(np.int64) * len(x)
        node = np.zeros(len(x), np.int64)
        for _ in range(self.depth):
            below = 2 * node + 1 + (columns.take(start.take(node) + rows) > cut.take(node))
            node = np.where(splits.take(node), below, node)
        return node

    def margin(self, x: np.ndarray, cut: np.ndarray, first: int = 0) -> np.ndarray:
        out = np.zeros(len(x))
        for t in range(first, len(self.feature)):
            out += self.value[t][self.leaves(t, x, cut)]
        return out


class NewtonModel(Classifier):
    """Fitted booster: base margin plus the trees; ``loss`` is the mean weighted log-loss on train before each round and at the end."""

    def __init__(self, base: float = 0.0, forest: Forest | None = None, loss: list | None = None):
        super().__init__()
        self.base, self.forest, self.loss = base, forest, loss or []

    def numbers(self) -> dict:
        f = self.forest
        return {"base": self.base, "loss": self.loss, "depth": f.depth} | {k: getattr(f, k).tolist() for k in ("feature", "bin", "threshold", "value", "cover")}

    @classmethod
    def of(cls, n: dict) -> NewtonModel:
        kinds = {"feature": np.int32, "bin": np.int32, "threshold": np.float64, "value": np.float64, "cover": np.float64}
        return cls(n["base"], Forest(n["depth"], *(np.array(n[k], t).reshape(-1, 2 ** (n["depth"] + 1) - 1) for k, t in kinds.items())), n["loss"])

    def margin(self, features: Column) -> Column:
        base, forest = self.base, self.forest

        @F.pandas_udf("double")
        def score(x: pd.Series) -> pd.Series:
            return pd.Series(base + forest.margin(np.stack(x.to_numpy()), forest.threshold) if len(x) else [], dtype="float64")

        return score(vector_to_array(features))

    def trees(self) -> list:
        """The trees for ``treeshap`` (margin of class 1; the base is spread over none of them)."""
        from weekpanel.operators.treeshap import Tree

        out = []
        for t in range(len(self.forest.feature)):
            f = self.forest.feature[t]
            node = np.arange(len(f))
            left = np.where(f >= 0, 2 * node + 1, -1)
            right = np.where(f >= 0, 2 * node + 2, -1)
            out.append(Tree(left, right, f, self.forest.threshold[t], [None] * len(f), self.forest.value[t], self.forest.cover[t], 1.0))
        return out


@dataclass
class _Memory:
    """Margins of blocks that this worker has seen, by fit and block."""

    known: OrderedDict = field(default_factory=OrderedDict)

    def margin(self, key, forest: Forest, base: float, bins: np.ndarray) -> np.ndarray:
        done, margin = self.known.pop(key, (0, None))
        if margin is None:
            margin = np.full(len(bins), base)
        if done < len(forest.feature):
            margin = margin + forest.margin(bins, forest.bin, done)
        self.known[key] = (len(forest.feature), margin)
        while len(self.known) > REMEMBERED_BLOCKS:
            self.known.popitem(last=False)
        return margin


_MEMORY = _Memory()


def _margin(fit: str, block: str, forest: Forest, base: float, bins: np.ndarray) -> np.ndarray:
    """Margins of a block from this worker's memory. A function of the module goes to tasks by name; a task's own
    function would take a copy of the driver's empty memory along, and every level would walk all trees again."""
    return _MEMORY.margin((fit, block), forest, base, bins)


def cut_points(rows: DataFrame, n_features: int, bins: int = BINS) -> list[np.ndarray]:
    """At most ``bins`` - 1 cut values of each feature: its quantiles (values that occur), the greatest left out."""
    shares = ", ".join(f"{i / bins!r}D" for i in range(bins + 1))
    at = rows.agg(*[F.expr(f"percentile_approx(x[{j}], array({shares}), 10000)").alias(f"q{j}") for j in range(n_features)]).first()
    out = []
    for q in at:
        v = np.unique(np.array(q or [], float))
        out.append(v[:-1][-(bins - 1):])
    return out


def _pack(cuts: list[np.ndarray], block_rows: int):
    """Blocks of at least ``block_rows`` rows but for a task's last one; ``bins`` holds one feature after the other."""
    def run(batches):
        x, y, w = [], [], []

        def block():
            bins = np.stack([np.searchsorted(c, np.concatenate(x)[:, j], side="left") for j, c in enumerate(cuts)], 1).astype(np.uint8)
            columns = [[uuid4().hex], [len(bins)], [bins.T.tobytes()], [np.concatenate(y).tobytes()], [np.concatenate(w).tobytes()]]
            kinds = (pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["block", "n", "bins", "y", "w"])

        for batch in batches:
            for lo in range(0, batch.num_rows, block_rows):
                part = batch.slice(lo, block_rows)
                values = part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, len(cuts))
                x.append(values)
                y.append(part.column("y").to_numpy(zero_copy_only=False).astype(np.float64))
                w.append(part.column("w").to_numpy(zero_copy_only=False).astype(np.float64))
                if sum(map(len, x)) >= block_rows:
                    yield block()
                    x, y, w = [], [], []
        if x:
            yield block()

    return run


def _histograms(fit: str, forest: Forest, base: float, tree: dict | None, nodes: list[int], offsets: np.ndarray, unit: float, sliced: bool):
    """Sums of a task's blocks by cell: (node, feature, bin) in order, a feature having the bins from ``offsets[j]``
    on; first all gradients, then all Hessians, then the log-loss and the weight (in units). ``sliced`` gives the
    sums in numbered slices, for Spark to add up."""
    place = np.full(2 ** (forest.depth + 1) - 1, -1)
    place[nodes] = np.arange(len(nodes))
    width = int(offsets[-1])
    if tree is not None:
        tree = Forest(forest.depth, *(tree[k][None] for k in ("feature", "bin", "threshold", "value", "cover")))
    forest = forest.for_margins()

    def run(blocks):
        g_sum, h_sum = (np.zeros((len(nodes), width), np.int64) for _ in range(2))
        loss = weight = seen = 0
        for block, n, bins, y, w in blocks:
            seen += 1
            bins = np.frombuffer(bins, np.uint8).reshape(-1, n)
            y, w = np.frombuffer(y), np.frombuffer(w)
            margin = _margin(fit, block, forest, base, bins.T)
            p = 1.0 / (1.0 + np.exp(-margin))
            g, h = np.rint(w * (p - y) * unit), np.rint(w * p * (1.0 - p) * unit)
            if tree is None:  # the first level of a round
                loss += int(np.rint(w * (np.logaddexp(0.0, margin) - y * margin) * unit).sum())
                weight += int(np.rint(w * unit).sum())
                at = np.zeros(n, np.int64)
            else:
                at = place[tree.leaves(0, bins.T, tree.bin)]
                inside = np.flatnonzero(at >= 0)
                bins, g, h, at = bins.take(inside, 1), g[inside], h[inside], at[inside]
            at = at * BINS
            for x, lo, hi in zip(bins, offsets, offsets[1:], strict=False):
                cell = at + x
                for total, v in ((g_sum, g), (h_sum, h)):
                    total[:, lo:hi] += np.bincount(cell, v, len(nodes) * BINS).reshape(len(nodes), BINS)[:, : hi - lo].astype(np.int64)
        if not seen:
            return  # a task without blocks
        sums = np.concatenate((g_sum.ravel(), h_sum.ravel(), [loss, weight]))
        if sliced:
            yield from ((i, sums[lo : lo + SLICE]) for i, lo in enumerate(range(0, len(sums), SLICE)))
        else:
            yield sums

    return run


def level_sums(blocks: RDD, fit: str, forest: Forest, base: float, tree: dict | None, nodes: list[int], offsets: np.ndarray, unit: float, direct_bytes: int = DIRECT_BYTES):
    """(G, H) of shape (nodes, bins of all features), and (log-loss, weight) on the first level; all in whole units."""
    n_cells = len(nodes) * int(offsets[-1])
    direct = blocks.getNumPartitions() * n_cells * 16 <= direct_bytes
    run = _histograms(fit, forest, base, tree, nodes, offsets, unit, not direct)
    if direct:
        sums = sum(blocks.mapPartitions(run).collect())
    else:
        sums = np.concatenate([s for _, s in sorted(blocks.mapPartitions(run).reduceByKey(np.add).collect(), key=lambda s: s[0])])
    return sums[:n_cells].reshape(len(nodes), -1), sums[n_cells:-2].reshape(len(nodes), -1), int(sums[-2]), int(sums[-1])


def _unit(rows: int, most: float) -> float:
    """Gradients are whole multiples of 1 / unit: a block's sums stay exact as doubles, all rows' within 64 bits."""
    weight = max(0, math.ceil(math.log2(max(most, 1.0))))
    return 2.0 ** min(30, 36 - weight, 56 - weight - math.ceil(math.log2(max(rows, 2))))


def best_cuts(g: np.ndarray, h: np.ndarray, offsets: np.ndarray, l2: float, min_child: float):
    """Per node (gain, feature, bin, G_L, H_L, G, H); a gain of 0 means that no cut gains anything. Ties: the first feature, then the lowest bin."""
    nodes = np.arange(len(g))
    g_all, h_all = (x[:, : offsets[1]].sum(1) for x in (g, h))
    best = [np.zeros(len(g)) for _ in range(5)]  # gain, feature, bin, G_L, H_L
    for j, (lo, hi) in enumerate(zip(offsets, offsets[1:], strict=False)):
        if hi - lo < 2:
            continue
        g_left, h_left = np.cumsum(g[:, lo : hi - 1], 1), np.cumsum(h[:, lo : hi - 1], 1)
        g_right, h_right = g_all[:, None] - g_left, h_all[:, None] - h_left
        gain = g_left**2 / (h_left + l2) + g_right**2 / (h_right + l2) - (g_all**2 / (h_all + l2))[:, None]
        gain = np.where((h_left >= min_child) & (h_right >= min_child), gain, 0.0)
        at = gain.argmax(1)
        better = gain[nodes, at] > best[0]
        for to, value in zip(best, (gain[nodes, at], j, at, g_left[nodes, at], h_left[nodes, at]), strict=True):
            to[better] = value[better] if isinstance(value, np.ndarray) else value
    return best[0], best[1].astype(int), best[2].astype(int), best[3], best[4], g_all, h_all


def fit_newton(rows: DataFrame, rounds: int = 200, rate: float = 0.1, depth: int = 6, l2: float = 1.0, min_child: float = 1.0,
               cuts: list | None = None, direct_bytes: int = DIRECT_BYTES) -> NewtonModel:
    """Booster on ``rows`` (x array of doubles, y 0/1, w weight); all ``rounds`` are fitted.

    Rows with a null y, w or x are left out. The base margin is the weighted log-odds of class 1.
    ``cuts`` gives the cut values of every feature, else they are quantiles. Without rows, or with one class
    only, the model is its base margin (clipped at 20 either way) and no tree."""
    rows = rows.select("x", F.col("y").cast("double").alias("y"), F.col("w").cast("double").alias("w")).where("x is not null and y is not null and w is not null")
    about = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("w") * F.col("y")).alias("p"), F.sum("w").alias("w"), F.max(F.size("x")).alias("f"), F.max("w").alias("most")).first()
    share = (about["p"] or 0.0) / about["w"] if about["w"] else 0.5
    base = 20.0 * (1 if share >= 1 else -1) if share in (0.0, 1.0) else float(np.log(share / (1 - share)))
    forest = Forest.empty(depth)
    if not about["n"] or share in (0.0, 1.0):
        return NewtonModel(base, forest, [])
    n_features = about["f"]
    cuts = [np.asarray(c, float) for c in cuts] if cuts is not None else cut_points(rows, n_features)
    sc = rows.sparkSession.sparkContext
    block_rows = min(BLOCK_ROWS, max(LEAST_ROWS, -(-about["n"] // sc.defaultParallelism)))
    parts = -(-about["n"] // block_rows)
    table = cut_lineage(rows.repartition(parts).mapInArrow(_pack(cuts, block_rows), _BLOCK), "blocks")
    numbered = table.rdd.map(tuple).zipWithIndex().map(lambda b: (b[1], b[0]))
    blocks = numbered.partitionBy(min(parts, sc.defaultParallelism), int).values().persist(StorageLevel.MEMORY_AND_DISK)
    fit, losses = uuid4().hex, []
    unit, offsets = _unit(about["n"], about["most"]), np.concatenate(([0], np.cumsum([len(c) + 1 for c in cuts])))

    def sums(forest, tree, nodes):
        return level_sums(blocks, fit, forest, base, tree, nodes, offsets, unit, direct_bytes)

    try:
        for _ in range(rounds):
            tree, loss, weight = _grow(sums, forest, cuts, offsets, unit, rate, l2, min_child)
            losses.append(loss / weight)
            forest = forest.grown(tree)
        *_, loss, weight = sums(forest, None, [0])
    finally:
        blocks.unpersist()
    return NewtonModel(base, forest, [*losses, (loss / unit) / (weight / unit)])


def _grow(sums, forest, cuts, offsets, unit, rate, l2, min_child):
    """One tree, and the log-loss and weight before it. Below the root the child with the smaller sum of Hessians is summed
    up; its sibling has the rest of the parent's sums, which are whole numbers."""
    size = 2 ** (forest.depth + 1) - 1
    tree = {"feature": np.full(size, -1, np.int32), "bin": np.zeros(size, np.int32), "threshold": np.zeros(size), "value": np.zeros(size), "cover": np.zeros(size)}
    nodes, first, above = [0], None, {}
    for level in range(forest.depth):
        if not level:
            g, h, loss, weight = sums(forest, None, nodes)
            first = loss / unit, weight / unit
        else:
            pairs = list(zip(nodes[::2], nodes[1::2], strict=True))
            least = [left if tree["cover"][left] <= tree["cover"][right] else right for left, right in pairs]
            some_g, some_h, *_ = sums(forest, tree, least)
            g, h = (np.empty((len(nodes), int(offsets[-1])), np.int64) for _ in range(2))
            for k, (left, right) in enumerate(pairs):
                own, other = (2 * k, 2 * k + 1) if least[k] == left else (2 * k + 1, 2 * k)
                g[own], h[own] = some_g[k], some_h[k]
                g[other], h[other] = above[left][0] - some_g[k], above[left][1] - some_h[k]
        gain, feature, at, g_left, h_left, g_all, h_all = best_cuts(g / unit, h / unit, offsets, l2, min_child)
        following, kept = [], {}
        for k, node in enumerate(nodes):
            if not level:
                tree["value"][0], tree["cover"][0] = -rate * g_all[0] / (h_all[0] + l2), h_all[0]
            if gain[k] <= 1e-9:
                continue
            tree["feature"][node], tree["bin"][node], tree["threshold"][node] = feature[k], at[k], cuts[feature[k]][at[k]]
            kept[2 * node + 1] = g[k], h[k]
            for child, gs, hs in ((2 * node + 1, g_left[k], h_left[k]), (2 * node + 2, g_all[k] - g_left[k], h_all[k] - h_left[k])):
                tree["value"][child], tree["cover"][child] = -rate * gs / (hs + l2), hs
                following.append(child)
        nodes, above = following, kept
        if not nodes:
            break
    return tree, *first
