import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.corpus import documents, frame, words
from weekpanel.llm import byte_bpe, lexical_search, periodic_runs

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# ---- ranked search
def brute_ranking(docs, items, top):
    terms = lambda t: TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    found = [(i, t) for i, text in docs if (t := terms(text))]
    n_docs, n_terms = len(found), sum(len(t) for _, t in found)
    df = {}
    for _, t in found:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    asked = {}
    for i, text in items:
        asked.setdefault(i, set()).update(terms(text))
    out = []
    for i, q in asked.items():
        scores = []
        for doc, t in found:
            m = 50 + (50 * len(t) * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * ((10**9 * t.count(x)) // (1000 * t.count(x) + 20 * m)) for x in q if x in df and x in t)
            if s > 0:
                scores.append((-s, doc is None, doc or 0, doc))
        out += [(i, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scores)[:top])]
    return sorted(out, key=str)


@pytest.mark.parametrize("block_docs,item_terms,top", [(8192, 1 << 18, 50), (7, 40, 3), (1, 1, 5)])
def test_search_against_brute_force(spark, block_docs, item_terms, top):
    rng = random.Random(9)
    rows = [(i, (t or "")[:4000] if t else t, a, b, c) for i, t, a, b, c in documents(seed=8, n=50)]
    rows += [(900 + i, "tie tie other", "", "", 0) for i in range(9)] + [(950, "TIE É-tie;é", "", "", 0)]
    texts = [r[1] for r in rows if r[1]]
    items = [(i, " ".join(rng.sample(rng.choice(texts).split() or ["x"], 1) + words(rng, 3)) + " tie") for i in range(12)]
    items += [(None, "tie"), (3, "Other É"), (50, None), (51, ""), (52, "wordthatnowherestands"), items[0], (53, rows[1][1])]
    df, asked = frame(spark, rows, extra=True), spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS w", "2L AS doc_id")
    got = lexical_search.rank_documents(df, asked, top=top, block_docs=block_docs, item_terms=item_terms)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_ranking([r[:2] for r in rows], items, top)


def test_search_of_nothing(spark):
    df, asked = frame(spark, documents(n=3)), spark.createDataFrame([(1, "one")], "item_id long, text string")
    assert lexical_search.rank_documents(df.limit(0), asked).count() == 0
    assert lexical_search.rank_documents(df, asked.limit(0)).count() == 0
    assert lexical_search.rank_documents(df.withColumn("text", F.lit(" .,")), asked).count() == 0


def test_grid_finds_every_cell():
    rng = np.random.default_rng(1)
    for n_rows, n_columns in ((1, 1), (3, 40), (40, 3), (33, 64)):
        cells = np.unique(rng.integers(0, n_rows * n_columns, 30))
        rows, columns = np.divmod(cells, n_columns)
        impacts = rng.integers(1, 1000, len(cells))
        grid = lexical_search.Grid(rows, columns, impacts, n_rows, n_columns)
        held = {(r, c): v for r, c, v in zip(rows.tolist(), columns.tolist(), impacts.tolist(), strict=True)}
        assert grid.top[1] == impacts.max()
        for r in range(n_rows):
            for c in range(n_columns):
                node = np.array([1])
                for b in range(grid.depth - 1, -1, -1):
                    node = grid.quarter(node, np.array([(r >> b & 1) * 2 + (c >> b & 1)]))
                assert grid.top[node[0]] == held.get((r, c), 0)


# ---- periodic runs
def brute_runs(w):
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            x = w[s : i + q]
            if len(x) >= max(6, 4 * q) and not any(all(x[k] == x[k + r] for k in range(len(x) - r)) for r in range(1, q)):
                out.append((s, len(x), q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapse(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return b" ".join(x for i, x in enumerate(w) if i not in gone).decode()


def test_runs_against_brute_force():
    rng = random.Random(2)
    texts = []
    for _ in range(600):
        n, k = rng.randrange(90), rng.choice([1, 2, 3, 6])
        w = [b"w%d" % rng.randrange(k) for _ in range(n)]
        if n and rng.random() < 0.6:
            a = rng.randrange(n)
            p = 1 + (n - a) // (3 + rng.randrange(8))
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        texts.append(w)
    texts.append([b"a", b"b"] * 5000 + [b"c"] * 7 + [b"a", b"b", b"c"] * 30)
    found = list(periodic_runs._group(texts, 6, 4))
    for w, (runs, collapsed) in zip(texts[:-1], found[:-1], strict=True):
        assert [tuple(r.values()) for r in runs] == brute_runs(w)
        assert collapsed == collapse(w, brute_runs(w))
    # the run of c c c ... may share its last word with the run of a b c
    assert [tuple(r.values()) for r in found[-1][0]] == [(0, 10000, 2), (10000, 7, 1), (10006, 91, 3)]


def planted(doc_id, text):
    w = WORD.findall((text or "").encode())
    n, h = len(w), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def test_runs_query_against_brute_force(spark, tmp_path, monkeypatch):
    from weekpanel.llm.queries import QUERIES

    monkeypatch.setattr(periodic_runs, "GROUP_WORDS", 500)
    rows = [(i, t if t is None or len(t) < 3000 else t[:3000], a, b, c) for i, t, a, b, c in documents(seed=4, n=150)]
    rows += [(1000 + i, "ha " * i, "", "", 0) for i in range(12)] + [(2000, "a\x0bb\x1ca\x0bb\x1ca\x0bb\x1ca\x0bb\x1c a", "", "", 0)]
    frame(spark, rows, extra=True).withColumn("runs", F.lit(1)).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((tuple(r) for r in QUERIES["op12_periodic_runs"](spark, str(tmp_path)).collect()), key=str)
    want = []
    for r in rows:
        w = planted(r[0], r[1])
        runs = brute_runs(w)
        best = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2])) if runs else (None,) * 3
        want.append((r[0], len(runs), *best, best[1] * 1000 // best[2] if runs else None, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(collapse(w, runs))))
    assert sum(r[1] > 0 for r in want) > 15
    assert got == sorted(want, key=str)


def test_marked_runs_keep_columns_and_rows(spark):
    df = frame(spark, documents(n=12), extra=True).withColumn("runs", F.lit("x"))
    out = periodic_runs.mark_runs(df)
    assert out.count() == df.count() and out.columns == [*[c for c in df.columns if c != "runs"], "n_words", "runs", "collapsed"]
    assert periodic_runs.mark_runs(df.limit(0)).count() == 0
    long = out.where("text like 'ha ha%'").first()
    assert [tuple(r) for r in long.runs] == [(0, 500, 1)] and long.collapsed == "ha"
    with pytest.raises(ValueError):
        periodic_runs.mark_runs(df, least_power=1)


# ---- byte-level BPE
@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(byte_bpe.VOCABULARY)


def odd_texts(n, seed=1):
    rng = random.Random(seed)
    parts = ["a", "b", " ", "  ", "\n", "é", "ß", "中", "🙂", "'s", "'ll", "1", "²", "\x1c", "\x85", "<|endoftext|>", "<|endof", "!", "\t", "՘", "\U00010940", "the", "ing", "ا", "​", "\x00", "A" * 100, "ab" * 70]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(n)]


def test_tokens_equal_the_library(spark, library, monkeypatch):
    for name, value in (("CHUNK_WORDS", 37), ("LONG_TEXT", 60), ("REMEMBER", 50), ("SEND_TOKENS", 400)):
        monkeypatch.setattr(byte_bpe, name, value)
    texts = odd_texts(400) + ["x" * 3000, "ab " * 2000, " " * 300]
    codec = byte_bpe.Bpe(byte_bpe.VOCABULARY)
    ids, counts = codec.encode([*texts, None, ""])
    got = [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert got == [*want, [], []]
    assert [codec.decode(np.array(i, int)).decode() for i in got] == [*texts, "", ""]
    broken = [[i] for i in range(0, 50257, 401)] + [[50256, 447, 13], [447], [127, 0, 255]]
    assert [codec.decode(np.array(i)).decode("utf-8", "replace") for i in broken] == library.decode_batch(broken, skip_special_tokens=False)


def test_bpe_query_against_the_library(spark, library, tmp_path):
    from weekpanel.llm.queries import QUERIES

    rows = documents(n=40) + [(5000 + i, t, "", "", 0) for i, t in enumerate(odd_texts(60, 5))]
    frame(spark, rows, extra=True).withColumn("ids", F.lit(1)).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((tuple(r) for r in QUERIES["op13_byte_bpe"](spark, str(tmp_path)).collect()), key=str)
    want = []
    for r in rows:
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        want.append((r[0], len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert got == sorted(want, key=str)


def test_bpe_keeps_columns_and_rows(spark):
    df = frame(spark, documents(n=10), extra=True).withColumns({"ids": F.lit("x"), "decoded": F.lit(1)})
    out = byte_bpe.decode_ids(byte_bpe.encode_texts(df))
    assert out.where("decoded <> coalesce(text, '')").count() == 0 and out.count() == df.count()
    assert set(out.columns) == set(df.columns)
    assert byte_bpe.decode_ids(byte_bpe.encode_texts(df.limit(0))).count() == 0


def test_other_tokenizer_files_are_refused():
    with pytest.raises(ValueError):
        byte_bpe.Bpe("/opt/tokenizers/word_bpe_49k.json")
