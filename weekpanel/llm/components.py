"""Connected components of a link table, wholly on Spark.

Large-star / small-star contraction (Kiveris et al., 2014): every round
rewires each node to the smallest node near it, and O(log n) rounds leave
stars. Before a round every task replaces its own links by a spanning forest
of stars, which saves most rounds. Minima are pre-aggregated before
the shuffle, so a hub costs one row per task; the join back to its links is
an equi-join that adaptive execution can split. Every round is written to the
shared folder, so a lost executor costs one round at most."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekpanel.session import cut_lineage


def smallest_reachable(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest index reachable from each of n nodes over the links (a, b)."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        for end in (label[a], label[b], a, b):
            np.minimum.at(new, end, low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    return label


def _contract(batches):
    """A task's links (of one input split) as stars around each part's smallest node."""
    u, v = [], []
    for batch in batches:
        u.append(batch.column("u").to_numpy())
        v.append(batch.column("v").to_numpy())
    if u:
        nodes, at = np.unique(np.concatenate(u + v), return_inverse=True)
        root = smallest_reachable(at[: len(at) // 2], at[len(at) // 2 :], len(nodes))
        far = np.flatnonzero(root != np.arange(len(nodes)))
        for k in range(0, len(far), 1 << 16):
            x = far[k : k + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(nodes[x]), pa.array(nodes[root[x]])], ["u", "v"])


def _star(links: DataFrame) -> DataFrame:
    """One large-star and one small-star step on links (u > v)."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
    large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    large = large.unionByName(low.where("m < u").select("u", F.col("m").alias("v"))).distinct()
    low = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(low, "u")
    return (
        small.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        .unionByName(low.select("u", F.col("m").alias("v")))
        .distinct()
    )


def connected_components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, component): for every node in a link, the smallest node reachable.

    Nodes are long. ``links`` may repeat pairs and hold them in either order; null ends and
    loops are ignored. Nodes without links are not returned. Empty in, empty out."""
    e = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))
    ).distinct()
    e = cut_lineage(e, "links")
    seen = None
    for _ in range(max_rounds):
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen or not now[0]:
            break
        seen = now
        e = cut_lineage(_star(e.mapInArrow(_contract, "u long, v long")), "links")
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = e.select(F.col("v").alias("node")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
