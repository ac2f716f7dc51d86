import random
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm.corpus import as_bytes, documents, frame
from weekpanel.llm import hyperminhash as H
from weekpanel.llm.components import connected_components

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute(rows, n, percent):
    """(doc_id, n_shingles, component_id) of every row, all pairs compared."""
    sets = []
    for r in rows:
        w = WORD.findall(as_bytes(r[1]).lower())
        k = min(n, len(w))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    low = {}
    big = H.LAST_ID
    for i, r in enumerate(rows):
        low[find(i)] = min(low.get(find(i), big), big if r[0] is None else r[0])
    none = lambda x: None if x == big else x
    return Counter((r[0], len(sets[i]), none(low[find(i)])) for i, r in enumerate(rows))


@pytest.mark.parametrize("n,percent", [(3, 85), (5, 80)])
def test_components_match_all_pairs(spark, n, percent):
    rows = documents()
    out = H.near_duplicates(frame(spark, rows, extra=True), n, percent).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in out) == brute(rows, n, percent)
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)


def test_keep_one_and_empty(spark):
    rows = documents()
    docs = frame(spark, rows)
    found = H.near_duplicates(docs)
    kept = H.keep_one(docs, found).collect()
    groups = {(c) for (_, n, c) in brute(rows, 5, 80) if n}
    blank = {(r[0], r[1]) for r in rows if not WORD.findall(as_bytes(r[1]))}
    assert len(kept) == len(groups) + len(blank)
    empty = docs.limit(0)
    assert H.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("shared", [None, 7])
def test_rows_without_an_own_id_are_judged_by_text(spark, shared):
    """Unrelated texts with null ids, or with one shared id, all stay; their copies and near copies go."""
    rng = random.Random(8)
    texts = [[f"t{i}w{rng.randrange(500)}" for _ in range(60)] for i in range(6)]
    near = [["edited", *t[1:]] for t in texts[:2]]
    rows = [(shared, " ".join(t), "", "", 0) for t in texts + near]
    rows += [(3, " ".join(texts[4]), "", "", 0), (9, " ".join(texts[5]), "", "", 0), (shared, " ", "", "", 0), rows[2]]
    docs = frame(spark, rows)
    kept = Counter((r.doc_id, r.text) for r in H.keep_one(docs, H.near_duplicates(docs)).collect())
    assert len(kept) == sum(kept.values()) == 7
    assert {r[0] for r in kept if "t4w" in r[1]} == {3} and {r[0] for r in kept if "t5w" in r[1]} == {shared or 9}
    assert all(sum(f"t{i}w" in r[1] for r in kept) == 1 for i in range(6)) and (shared, " ") in kept


def test_pivot_misses_are_found(spark):
    """Near copies of a centre link to it but often not to each other; no link may be lost."""
    rng = random.Random(5)
    centre = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(40):
        w = list(centre)
        for _ in range(4):
            w[rng.randrange(200)] = f"x{i}_{rng.randrange(99)}"
        rows.append((i + 10, " ".join(w), "", "", 0))
    rows.append((500, " ".join(centre), "", "", 0))
    out = H.near_duplicates(frame(spark, rows), 3, 85).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in out) == brute(rows, 3, 85)


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(1)
    for n, j in ((40, 0.85), (700, 0.9), (5000, 0.5)):
        pool = rng.integers(0, 2**63, 2 * n, dtype=np.uint64)
        both = round(2 * n * j / (1 + j))
        extra = (2 * n - 2 * both) // 2
        a, b = np.sort(pool[: both + extra]), np.sort(np.concatenate((pool[:both], pool[both + extra : both + 2 * extra])))
        level = H.levels_of(len(a), 85)[0]
        ra, rb = (H.registers(x, level)[None, :] for x in (a, b))
        salts = 2 ** (H.TOP - level)
        got = H.estimate(ra, rb, [len(a) * salts], [len(b) * salts])[0]
        assert abs(got - both / (both + 2 * extra)) < 0.12


def test_levels_meet():
    for n in range(1, 6000, 7):
        for m in (n, int(n / 0.85)):
            if 100 * n >= 85 * m:
                assert set(H.levels_of(n, 85)) & set(H.levels_of(m, 85))


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1000), (None, 4), (2001, 2000), (2000, 2001)], "a long, b long")
    got = {r.node: r.component for r in connected_components(links).collect()}
    assert got == {i: 0 for i in range(301)} | {2000: 2000, 2001: 2000}
