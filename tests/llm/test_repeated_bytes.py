import hashlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.corpus import as_bytes, documents, frame
from weekpanel.llm import suffix_dedup as S


def brute(rows, length):
    texts = [as_bytes(r[1]) for r in rows]
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for r, t in zip(rows, texts, strict=True):
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        runs = int((np.diff(np.concatenate(([0], gone.astype(np.int8)))) == 1).sum())
        out.append((r[0], len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("length,gram,large", [(400, 160, 4096), (60, 20, 2)])
def test_removed_bytes_match_brute_force(spark, length, gram, large):
    rows = documents(n=48)
    out = S.repeated_bytes(frame(spark, rows, extra=True), length, gram, large).collect()
    assert Counter(tuple(r)[:5] for r in out) == brute(rows, length)
    assert all(sum(r.spans[1::2]) - sum(r.spans[0::2]) == r.n_removed for r in out)


def test_pieces_and_periods(monkeypatch, spark):
    monkeypatch.setattr(S, "PIECE", 97)
    text = np.frombuffer(b"ab" * 300 + bytes(range(60, 120)) * 3 + b"z" * 500, np.uint8)
    a, n, name, ctx = S.intervals(text, 50, 20)
    assert a[0] == 0 and (a[1:] == (a + n)[:-1]).all() and a[-1] + n[-1] == len(text) - 49
    # suffixes with equal 50 bytes share bucket and distance to the bucket's gram
    assert len(S._fold_repeats(a, n, name, ctx)[0]) <= len(a)


def test_suffix_blocks_against_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(20):
        n = rng.integers(1, 8)
        bodies = [bytes(rng.integers(97, 99, 40 + rng.integers(0, 30)).astype(np.uint8)) for _ in range(n)]
        bodies += bodies[:1]
        counts = np.array([len(b) - 29 for b in bodies])
        buckets = np.arange(len(bodies)) % 2
        got = S.repeated_suffixes(bodies, counts, buckets.astype(np.int64), 30)
        every = [(int(k), b[i : i + 30]) for k, b, c in zip(buckets, bodies, counts, strict=True) for i in range(c)]
        seen = Counter(every)
        assert got.tolist() == [seen[x] > 1 for x in every]


def test_empty_table(spark):
    assert S.repeated_bytes(frame(spark, documents(n=6)).limit(0)).count() == 0
