"""Near-duplicate embeddings by a subspace pigeonhole join.

Unit vectors with cosine >= c have squared distance <= 2 - 2c. After one fixed
rotation the coordinates are split into blocks, and in at least one block a
linked pair keeps within the block's proportional share of that budget. So
each block is range-joined under its share: vectors meet in grid cells over the
block's first coordinates (a vector goes to its own cell and to the cells that its radius
reaches), candidates are the pairs within the block's budget, and every
candidate is verified by the cosine of the whole vectors in double precision.

A pair counts in the first block whose budget it keeps and in the cell of its smaller
node, so no pair table is needed: tasks return link counts and a spanning
forest. Equal vectors are one node with a size. A cell with more than ``CHUNK``
rows is cut into chunks that meet pair by pair in tasks of their own."""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekpanel.llm.blocks import chunk_pairs
from weekpanel.llm.components import connected_components, smallest_reachable
from weekpanel.session import cut_lineage

BLOCKS = 8
GRID = 2  # coordinates of a block that make its cells
CELL = 4.0  # cell width in radii
CHUNK = 4096
SEED = 20240611
SLACK = 1e-9
LAST_ID = (1 << 63) - 1

CELLS = "label string, dim int, block int, cell binary, home boolean, node long, size long, vec binary"


def rotation(dim: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(SEED).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def in_range(v: np.ndarray) -> np.ndarray:
    """Rows as doubles, each times the power of two that brings its largest component below 1: same cosines, no overflow."""
    v = v.astype(float)
    return np.ldexp(v, -np.frexp(np.abs(v).max(axis=1))[1][:, None])


def block_ranges(dim: int, blocks: int = BLOCKS) -> list[tuple[int, int]]:
    edges = np.linspace(0, dim, min(blocks, dim) + 1).astype(int).tolist()
    return list(zip(edges[:-1], edges[1:], strict=True))


def _emit(least: float, kind):
    budget = (2 - 2 * least) * (1 + SLACK) + SLACK

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            label, node, size = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("label", "node", "size"))
            vectors = [np.array(v, kind) for v in batch.column("embedding").to_pylist()]
            dims = np.array([len(v) for v in vectors])
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                v = np.stack([vectors[i] for i in at])
                raw = [x.tobytes() for x in v]
                u = in_range(v)
                u /= np.linalg.norm(u, axis=1, keepdims=True)
                r = u @ rotation(dim)
                for k, (lo, hi) in enumerate(block_ranges(dim)):
                    radius = np.sqrt(budget * (hi - lo) / dim)
                    x = r[:, lo : min(hi, lo + GRID)] / (CELL * radius)
                    home, low, high = np.floor(x), np.floor(x - 1 / CELL), np.floor(x + 1 / CELL)
                    for step in product((0, 1, 2), repeat=x.shape[1]):
                        # 0: the own cell's coordinate, 1 and 2: the lower and upper one if reached
                        c = np.stack([(home, low, high)[s][:, g] for g, s in enumerate(step)], axis=1)
                        moved = np.all([(c[:, g] != home[:, g]) | (s == 0) for g, s in enumerate(step)], axis=0)
                        pick = np.flatnonzero(moved)
                        if not len(pick):
                            continue
                        cells = c[pick].astype(np.int32)
                        rows = at[pick]
                        yield pa.RecordBatch.from_arrays([
                            pa.array(label[rows], pa.string()), pa.array(np.full(len(rows), dim, np.int32)), pa.array(np.full(len(rows), k, np.int32)),
                            pa.array([z.tobytes() for z in cells], pa.binary()), pa.array(np.full(len(rows), not any(step))),
                            pa.array(node[rows]), pa.array(size[rows]), pa.array([raw[i] for i in pick], pa.binary())],
                            [f.split()[0] for f in CELLS.split(", ")])

    return run


def _first_block(r1: np.ndarray, r2: np.ndarray, budget: float, dim: int) -> np.ndarray:
    """For rows of rotated pairs the first block that keeps its budget; symmetric, and the same in every task."""
    d = (r1 - r2) ** 2
    out = np.full(len(d), -1)
    for k, (lo, hi) in reversed(list(enumerate(block_ranges(dim)))):
        total = np.zeros(len(d))
        for j in range(lo, hi):
            total = total + d[:, j]
        out[total <= budget * (hi - lo) / dim] = k
    return out


def links_in_cell(xs, ys, dim: int, block: int, least: float):
    """(left index, right index) of the linked pairs of a cell that count here.

    ``xs`` and ``ys`` are (node, vectors); a pair counts when the left node is the smaller."""
    budget = (2 - 2 * least) * (1 + SLACK) + SLACK
    lo, hi = block_ranges(dim)[block]
    q = rotation(dim)
    # grouping may shuffle rows, so rotated coordinates must not depend on a row's neighbours
    turn = lambda u: np.einsum("ij,jk->ik", u, q)
    (xn, xv), (yn, yv) = xs, ys
    xv, yv = in_range(xv), in_range(yv)
    xl, yl = np.sqrt((xv * xv).sum(axis=1)), np.sqrt((yv * yv).sum(axis=1))
    xr, yr = turn(xv / xl[:, None]), turn(yv / yl[:, None])
    left, right = [], []
    for i in range(0, len(xn), 1024):
        for j in range(0, len(yn), 1024):
            p, s = xr[i : i + 1024, lo:hi], yr[j : j + 1024, lo:hi]
            d = (p * p).sum(axis=1)[:, None] + (s * s).sum(axis=1)[None, :] - 2 * (p @ s.T)
            near = (d <= budget * (hi - lo) / dim + SLACK) & (xn[i : i + 1024, None] < yn[None, j : j + 1024])
            a, b = np.nonzero(near)
            for k in range(0, len(a), 1 << 17):
                x, y = a[k : k + (1 << 17)] + i, b[k : k + (1 << 17)] + j
                cos = np.einsum("ij,ij->i", xv[x], yv[y]) / (xl[x] * yl[y])
                x, y = x[cos >= least], y[cos >= least]
                mine = _first_block(xr[x], yr[y], budget, dim) == block
                left.append(x[mine])
                right.append(y[mine])
    none = np.zeros(0, int)
    return np.concatenate(left or [none]), np.concatenate(right or [none])


def _join_cells(least: float, kind):
    """Rows sorted by cell in; per node its links found there and the root of its tree out."""

    def resolve(key, rows):
        _, dim, block = key[:3]
        node, size = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
        v = np.frombuffer(b"".join(r[2] for r in rows), kind).reshape(len(rows), dim)
        x, y = np.flatnonzero([r[3] for r in rows]), np.flatnonzero([r[4] for r in rows])
        a, b = links_in_cell((node[x], v[x]), (node[y], v[y]), dim, block, least)
        a, b = x[a], y[b]
        links = np.zeros(len(rows), np.int64)
        np.add.at(links, a, size[b])
        np.add.at(links, b, size[a])
        root = smallest_reachable(a, b, len(rows))
        some = np.flatnonzero(links)
        return pa.RecordBatch.from_arrays([pa.array(node[some]), pa.array(links[some]), pa.array(node[root[some]])], ["node", "links", "root"])

    def run(batches):
        key, rows = None, []
        for batch in batches:
            names = ("label", "dim", "block", "cell", "i", "j", "node", "size", "vec", "is_left", "is_right")
            for r in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                if r[:6] != key:
                    if len(rows) > 1:
                        yield resolve(key, rows)
                    key, rows = r[:6], []
                rows.append(r[6:])
        if len(rows) > 1:
            yield resolve(key, rows)

    return run


def _hash(salt, *columns):
    return F.xxhash64(salt, *columns)


def name_nodes(nodes: DataFrame) -> DataFrame:
    """``nodes`` plus ``node``, a long of its own for each (h1, h2): h1, but for rows that share h1 with a
    smaller h2. Those (a handful in 10^10) are named by the hash of both."""
    shared = nodes.groupBy("h1").agg(F.min("h2").alias("low"), F.count(F.lit(1)).alias("c")).where("c > 1").select("h1", "low")
    shared = cut_lineage(shared, "shared")
    if shared.isEmpty():
        return nodes.withColumn("node", F.col("h1"))
    named = nodes.join(shared, "h1", "left").withColumn("node", F.when(F.col("h2") > F.col("low"), F.xxhash64("h1", "h2")).otherwise(F.col("h1")))
    return cut_lineage(named.drop("low"), "nodes")


def near_vectors(table: DataFrame, least: float = 0.98, chunk: int = CHUNK) -> DataFrame:
    """(vec_id, n_links, component_id, kept), a row per vector.

    ``table`` needs vec_id, embedding and label; other columns are ignored. Vectors of one non-null
    label (a number, text or other plain type) and one dimension link when their cosine in double precision is at
    least ``least`` (between 0 and 1); arrays of floats are kept as floats, all others are doubles throughout. Null or
    zero vectors and vectors with null or non-finite components link with nothing. ``n_links`` counts the other rows linked directly,
    repeated rows included; ``component_id`` is the smallest vec_id reachable
    (null ids come last). A vector is known by 128 bits of hash, so any number of different ones may share 64. Empty table: no rows."""
    element = table.schema["embedding"].dataType.elementType
    single = isinstance(element, T.FloatType)
    kind, to = (np.float32, "float") if single else (np.float64, "double")
    # 0.0 and -0.0 are one value, in labels as in vectors
    label = F.col("label") + F.lit(0.0) if isinstance(table.schema["label"].dataType, (T.FloatType, T.DoubleType)) else F.col("label")
    e = F.col("embedding")
    rows = table.select(F.coalesce(F.col("vec_id").cast("long"), F.lit(LAST_ID)).alias("id"), label.cast("string").alias("label"),
                        e.cast(f"array<{to}>").alias("embedding"))
    good = F.col("label").isNotNull() & e.isNotNull() & (F.size(e) > 0) & F.forall(
        e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(e, lambda x: x != 0)
    rows = rows.withColumn("embedding", F.when(F.coalesce(good, F.lit(False)), F.transform(e, lambda x: x + F.lit(0.0).cast(to))))
    known = F.col("embedding").isNotNull()
    rows = rows.withColumns({"h1": F.when(known, _hash(F.lit(1), "label", "embedding")), "h2": F.when(known, _hash(F.lit(2), "label", "embedding"))})
    nodes = rows.where("h1 is not null").groupBy("h1", "h2", "label", "embedding").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("size"))
    nodes = name_nodes(cut_lineage(nodes, "vectors"))
    cells = cut_lineage(nodes.select("label", "node", "size", "embedding").mapInArrow(_emit(least, kind), CELLS), "cells")
    key = ["label", "dim", "block", "cell"]
    one = chunk_pairs(cells, key, "node", "home", chunk)
    group = [*key, "i", "j"]
    met = one.repartition(*group).sortWithinPartitions(*group).mapInArrow(_join_cells(least, kind), "node long, links long, root long")
    met = cut_lineage(met, "met")
    found = connected_components(met.where("node != root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    n = nodes.select("node", "h1", "h2", "id", "size").join(met.groupBy("node").agg(F.sum("links").alias("links")), "node", "left")
    n = n.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    low = n.groupBy("component").agg(F.min("id").alias("low"))
    n = cut_lineage(n.join(low, "component").select("h1", "h2", (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "low"), "found")
    out = rows.select("id", "h1", "h2").join(n, ["h1", "h2"], "left")
    low = F.coalesce("low", "id")
    null_last = lambda c: F.when(c != LAST_ID, c)
    return out.select(null_last(F.col("id")).alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      null_last(low).alias("component_id"), (F.col("id") == low).alias("kept"))
