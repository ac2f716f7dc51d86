from collections import Counter

import numpy as np
import pytest

from weekpanel.llm import embedding_dedup as E


def vectors(n=150, dim=12, seed=2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    rows = []
    for i in range(n):
        c = centres[i % 6] + rng.normal(size=dim) * (0.1 if i % 3 else 0.02)
        rows.append((i, [float(x) for x in c.astype(np.float32)], int(i % 2)))
    rows += [rows[3], (900, rows[3][1], 1), (901, rows[3][1], 0), (902, [2 * x for x in rows[4][1]], 0), (None, rows[5][1], 1),
             (903, None, 1), (904, [0.0] * dim, 1), (905, [float("nan")] * dim, 1), (906, [None] + [1.0] * (dim - 1), 1), (907, rows[5][1], None),
             (908, [float("inf")] * dim, 0), (909, [], 0), (910, rows[7][1][:5], 1), (911, [-0.0] + [1.0] * (dim - 1), 1), (912, [0.0] + [1.0] * (dim - 1), 1)]
    return rows


def brute(rows, least, kind=np.float32):
    def fit(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    n = len(rows)
    root, links = list(range(n)), [0] * n

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(n):
        for j in range(i):
            (_, a, la), (_, b, lb) = rows[i], rows[j]
            if la is None or la != lb or not fit(a) or not fit(b) or len(a) != len(b):
                continue
            a, b = np.array(a, kind).astype(float), np.array(b, kind).astype(float)
            a, b = a / np.abs(a).max(), b / np.abs(b).max()
            if a @ b / (np.sqrt(a @ a) * np.sqrt(b @ b)) >= least:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    low = {}
    for i, r in enumerate(rows):
        low[find(i)] = min(low.get(find(i), E.LAST_ID), E.LAST_ID if r[0] is None else r[0])
    return Counter((r[0], links[i], None if low[find(i)] == E.LAST_ID else low[find(i)]) for i, r in enumerate(rows))


@pytest.mark.parametrize("least,chunk", [(0.98, 4096), (0.95, 5)])
def test_links_match_all_pairs(spark, least, chunk):
    from pyspark.sql import functions as F

    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("node", F.lit("x")).withColumn("id", F.lit(1))
    out = E.near_vectors(df, least, chunk).collect()
    assert Counter((r.vec_id, r.n_links, r.component_id) for r in out) == brute(rows, least)


def test_doubles_and_text_labels(spark):
    """Vectors that are equal as floats but not as doubles, lengths beyond floats, labels that are no numbers."""
    rows = [(i, v, None if k is None else ["Ä", "b"][k]) for i, v, k in vectors()]
    rows += [(1000 + i, [1.0, 1e-9 * i], "b") for i in range(4)] + [(1010 + i, [1e300, 1e300 * i], "b") for i in range(3)] + [(1015, [1e-300, 1e-300], "b")] + [(1020, [1.0, 1.0], "2"), (1021, [1.0, 1.0], "2.0")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    out = E.near_vectors(df, 0.98).collect()
    assert Counter((r.vec_id, r.n_links, r.component_id) for r in out) == brute(rows, 0.98, np.float64)


def test_shared_hashes_stay_different_vectors(spark, monkeypatch):
    """Hashes of two bits: most vectors share the first, and the two together are still told apart."""
    from pyspark.sql import functions as F

    def weak(salt, *columns):
        h = F.xxhash64(F.lit(1), *columns)
        return F.when(salt == 1, F.pmod(h, F.lit(4))).otherwise(h)

    monkeypatch.setattr(E, "_hash", weak)
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    out = E.near_vectors(df, 0.98).collect()
    assert Counter((r.vec_id, r.n_links, r.component_id) for r in out) == brute(rows, 0.98)


def test_empty_table(spark):
    assert E.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_chunk_pairs_meet_once(spark):
    from weekpanel.llm.blocks import chunk_pairs

    rows = [(g, i, (i * 7 + g) % 3 == 0) for g, n in ((0, 3), (1, 40), (2, 9), (3, 21)) for i in range(n)]
    df = spark.createDataFrame(rows, "g int, node long, x boolean")
    met = Counter()
    groups = {}
    for r in chunk_pairs(df, ["g"], "node", "x", 6).collect():
        groups.setdefault((r.g, r.i, r.j), []).append(r)
    for (g, _, _), members in groups.items():
        met.update((g, a.node, b.node) for a in members if a.is_left for b in members if b.is_right)
    want = Counter((g, i, j) for g, i, x in rows if x for h, j, _ in rows if h == g)
    assert met == want
