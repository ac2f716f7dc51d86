"""Path-dependent TreeSHAP for pyspark.ml tree models, vectorised over rows.

The fitted model's node table (its size is the model's, not the data's) goes
to every task; rows are explained in Arrow batches where they are. For one
leaf the contribution of a path feature depends only on which of the path's
features a row follows, and below a node rows differ only by that and by their
place among the cuts still to come. Rows that agree in both are merged on the
way down, so a leaf works on a few patterns and not on all rows.

Output space: class-1 probability for single trees and forests (mean of the
trees), the margin (weighted sum of the trees) for boosted trees. Per row
``expected + sum(phi)`` equals the model's output in that space."""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd

MERGE = 16  # rows are merged where there are at most so many times more ways to differ


@dataclass
class Tree:
    left: np.ndarray
    right: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray  # of continuous splits
    categories: list  # of categorical splits: the values that go left, else None
    value: np.ndarray
    cover: np.ndarray
    weight: float

    def goes_left(self, node: int, x: np.ndarray) -> np.ndarray:
        """Which rows go left at a split."""
        return self.value_goes_left(node, x[:, self.feature[node]])

    def value_goes_left(self, node: int, v: np.ndarray) -> np.ndarray:
        some = self.categories[node]
        return v <= self.threshold[node] if some is None else np.isin(v, some)


def trees_of(nodes: pd.DataFrame, boosted: bool, weights: dict | None = None) -> list[Tree]:
    """Trees of a node table (treeID, id, prediction, impurityStats, leftChild, rightChild, split)."""
    if "treeID" not in nodes:
        nodes = nodes.assign(treeID=0)
    out = []
    n_trees = nodes["treeID"].nunique()
    for tid, t in nodes.groupby("treeID"):
        t = t.sort_values("id")
        pos = {int(i): k for k, i in enumerate(t["id"])}
        n = len(t)
        tree = Tree(np.full(n, -1), np.full(n, -1), np.full(n, -1), np.zeros(n), [None] * n, np.zeros(n), np.zeros(n),
                    (weights or {}).get(int(tid), 1.0) if boosted else 1.0 / n_trees)
        for k, r in enumerate(t.itertuples(index=False)):
            stats = np.asarray(r.impurityStats, float)
            # classification keeps weights per class; regression keeps (weight, sum, sum of squares)
            tree.cover[k] = stats[0] if boosted else stats.sum()
            tree.value[k] = r.prediction if boosted else stats[1] / stats.sum()
            if r.leftChild >= 0:
                tree.left[k], tree.right[k] = pos[int(r.leftChild)], pos[int(r.rightChild)]
                tree.feature[k] = int(r.split["featureIndex"])
                values = np.asarray(r.split["leftCategoriesOrThreshold"], float)
                if int(r.split["numCategories"]) < 0:
                    tree.threshold[k] = values[0]
                else:
                    tree.categories[k] = values
        out.append(tree)
    return out


def expected_value(tree: Tree) -> float:
    def ev(j):
        if tree.left[j] < 0:
            return tree.value[j]
        a, b = tree.left[j], tree.right[j]
        return (tree.cover[a] * ev(a) + tree.cover[b] * ev(b)) / tree.cover[j]

    return tree.weight * ev(0)


_quadrature = lru_cache(maxsize=None)(np.polynomial.legendre.leggauss)


def _shapley(z: np.ndarray, o: np.ndarray) -> np.ndarray:
    """Contribution of each of d players to prod(z_i or o_i), for patterns o (p x d)."""
    # a contribution is the integral over t of the others' product at z + t (o - z), a polynomial of degree d - 1
    nodes, weights = _quadrature((o.shape[1] + 1) // 2)  # exact for it
    at = z + (0.5 + 0.5 * nodes)[:, None, None] * (o - z)
    others = np.ones_like(at)
    others[..., 1:] = np.cumprod(at[..., :-1], axis=2)
    others[..., :-1] *= np.cumprod(at[..., :0:-1], axis=2)[..., ::-1]
    return np.tensordot(0.5 * weights, others, 1) * (o - z)


def _splits_below(tree: Tree) -> list[list]:
    """For every node the different splits of its subtree: (feature, sorted cuts), or (feature, categories, None)."""
    below = [{} for _ in tree.left]

    def visit(node):
        if tree.left[node] < 0:
            return
        f, some = int(tree.feature[node]), tree.categories[node]
        found = {f: {float(tree.threshold[node])}} if some is None else {(f, tuple(some)): None}
        for child in (tree.left[node], tree.right[node]):
            visit(child)
            for key, cuts in below[child].items():
                found[key] = None if cuts is None else found.get(key, set()) | cuts
        below[node] = found

    visit(0)
    return [[(*key, None) if cuts is None else (key, np.array(sorted(cuts))) for key, cuts in b.items()] for b in below]


def _merged(x: np.ndarray, rows: np.ndarray, path: dict, splits: list):
    """(rows, path, place of every old row) with one row for all that follow the same features of ``path`` and go the
    same ways at ``splits``; None for the place if there are too many ways to do so."""
    size = 1 << len(path)
    for s in splits:
        size *= 2 if s[-1] is None else len(s[1]) + 1
    if size > MERGE * len(rows):
        return rows, path, None
    key = np.zeros(len(rows), np.int64)
    for _, o in path.values():
        key = 2 * key + o
    for s in splits:
        v = x[rows, s[0]]
        key = 2 * key + np.isin(v, s[1]) if s[-1] is None else key * (len(s[1]) + 1) + np.searchsorted(s[1], v, side="left")
    first = np.full(size, -1)
    first[key] = np.arange(len(rows))
    some = np.flatnonzero(first >= 0)
    at = first[some]
    first[some] = np.arange(len(some))
    return rows[at], {f: (z, o[at]) for f, (z, o) in path.items()}, first[key]


def tree_phi(tree: Tree, x: np.ndarray) -> np.ndarray:
    """Contributions (rows x features) of one weighted tree."""
    below = _splits_below(tree)

    def walk(node, rows, path):
        phi = np.zeros((len(rows), x.shape[1]))
        if tree.left[node] < 0:
            if path:
                names = list(path)
                z = np.array([path[f][0] for f in names])
                follows = np.stack([path[f][1] for f in names], axis=1)
                patterns, which = np.unique(follows, axis=0, return_inverse=True) if len(names) > 60 else _patterns(follows)
                phi[:, names] = (_shapley(z, patterns.astype(float)) * (tree.value[node] * tree.weight))[which]
            return phi
        f, left = int(tree.feature[node]), tree.value_goes_left(node, x[rows, tree.feature[node]])
        for child, there in ((tree.left[node], left), (tree.right[node], ~left)):
            ratio = tree.cover[child] / tree.cover[node]
            z, o = path.get(f, (1.0, np.ones(len(rows), bool)))
            some, on, place = _merged(x, rows, {**path, f: (z * ratio, o & there)}, below[child])
            part = walk(child, some, on)
            phi += part if place is None else part[place]
        return phi

    return walk(0, np.arange(len(x)), {})


def _patterns(follows: np.ndarray):
    code = follows @ (1 << np.arange(follows.shape[1], dtype=np.int64))
    _, first, which = np.unique(code, return_index=True, return_inverse=True)
    return follows[first], which


def explain_rows(trees: list[Tree], x: np.ndarray) -> np.ndarray:
    out = np.zeros(x.shape)
    for t in trees:
        out += tree_phi(t, x)
    return out
