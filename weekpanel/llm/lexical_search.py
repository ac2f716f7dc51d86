"""Ranked lexical search over a compressed grid of terms and documents (K2-treap).

Every block of documents becomes a grid: a row for each term, a column for
each document in order of doc_id, and in a cell the impact of the term in the
document. The grid is a quadtree: a node covers a square of cells, has a
4-bit mask of its non-empty quarters, finds them by counting mask bits, and
holds the greatest impact below it. Empty squares take no space.

An item descends along the paths of all its rows together. A state is a range
of columns with one node for each row; the sum of the nodes' maxima, weighted
by the terms, bounds the score of every document of the range, and in a single
column it is the score. The best states are opened first, many at a time.
States that cannot pass the 50 best documents found so far (kept over all
blocks of a task) are dropped, which is exact: nothing is cut or estimated.

The corpus counts (documents, terms, document frequencies of the items' terms)
come from one aggregation over all documents. The items come in blocks of
bounded size, one at a time: each is sent to the tasks, searched, written,
and released. Texts are never shuffled, and a block's rows are only terms that
some item of it asks for."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weekpanel.session import cut_lineage

SCALE, TF_SCALE, LENGTH_SCALE = 1_000_000_000, 1000, 20  # fixed values of the score
TOP = 50
BLOCK_DOCS = 8192  # columns of a grid
BLOCK_WORDS = 1 << 22  # a grid with so many words is closed before it has all its columns
ITEM_TERMS = 1 << 18  # terms of the items that are sent to the tasks at a time
AT_ONCE = 512  # states opened in one step
SALTS = 256

#: terms are runs of bytes that are ASCII letters, digits or not ASCII; A-Z are folded
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))

_COUNTED = "term binary, df long, n_terms long"
_FOUND = "item long, doc_id long, score long"
_BITS = np.array([[(bin(mask & ((1 << q) - 1)).count("1") if mask >> q & 1 else -1) for q in range(4)] for mask in range(16)], np.int8)


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(FOLD).split()


def _count(batches):
    """Partial document frequencies; the empty term counts the documents with any term, and all their terms."""
    for batch in batches:
        df, n_docs, n_terms = {}, 0, 0
        for text in batch.column("text"):
            words = terms_of(text.as_py())
            n_docs, n_terms = n_docs + bool(words), n_terms + len(words)
            for w in set(words):
                df[w] = df.get(w, 0) + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([b"", *df], pa.binary()), pa.array([n_docs, *df.values()], pa.int64()), pa.array([n_terms] + [0] * len(df), pa.int64())],
            ["term", "df", "n_terms"])


def _item_terms(batches):
    for batch in batches:
        rows = [(i, w) for i, text in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist(), strict=True) for w in set(terms_of(text))]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], ["item_id", "term"])


class Grid:
    """K2-treap of one block: ``rows``, ``columns`` and ``impacts`` of its non-empty cells."""

    def __init__(self, rows: np.ndarray, columns: np.ndarray, impacts: np.ndarray, n_rows: int, n_columns: int):
        self.depth = max(1, math.ceil(math.log2(max(n_rows, n_columns, 2))))
        code = np.zeros(len(rows), np.int64)
        for b in range(self.depth):
            code |= ((rows >> b) & 1) << (2 * b + 1) | ((columns >> b) & 1) << (2 * b)
        order = np.argsort(code)
        code, top = code[order], impacts[order]
        levels = [(np.zeros(len(code), np.uint8), top)]  # cells first, the root last
        for _ in range(self.depth):
            head = np.flatnonzero(np.concatenate(([True], code[1:] >> 2 != code[:-1] >> 2)))
            mask = np.bitwise_or.reduceat(np.left_shift(1, code & 3).astype(np.uint8), head)
            levels.append((mask, np.maximum.reduceat(levels[-1][1], head)))
            code = code[head] >> 2
        levels.reverse()
        # node 0 is the empty one; the nodes of a level follow those above, so the first quarter of a node is found by counting mask bits
        self.mask = np.concatenate([np.zeros(1, np.uint8), *(m for m, _ in levels)])
        self.top = np.concatenate([np.zeros(1, np.int64), *(t for _, t in levels)])
        held = np.array([bin(m).count("1") for m in range(16)], np.int32)[self.mask]
        self.first = (np.cumsum(held) - held + 2).astype(np.int32)

    def quarter(self, nodes: np.ndarray, which: np.ndarray) -> np.ndarray:
        """The quarter ``which`` of nodes, 0 where it is empty."""
        skip = _BITS[self.mask[nodes], which]
        return np.where(skip >= 0, self.first[nodes] + skip, 0)


class Best:
    """The best documents of one item so far: score down, then doc_id up (null last)."""

    def __init__(self, top: int):
        self.top = top
        self.score, self.doc, self.null = (np.zeros(0, t) for t in (np.int64, np.int64, bool))

    def add(self, score, doc, null):
        score, doc, null = (np.concatenate(x) for x in ((self.score, score), (self.doc, doc), (self.null, null)))
        order = np.lexsort((doc, null, -score))[: self.top]
        self.score, self.doc, self.null = score[order], doc[order], null[order]

    def may_enter(self, bound, doc, null):
        """Whether a document with at most this score and at least this doc_id can still come in."""
        if len(self.score) < self.top:
            return bound > 0
        low, last, last_null = self.score[-1], self.doc[-1], self.null[-1]
        earlier = (~null & last_null) | ((null == last_null) & (doc < last))
        return (bound > low) | ((bound == low) & (low > 0) & earlier)


def descend(grid: Grid, rows: np.ndarray, weights: np.ndarray, doc: np.ndarray, null: np.ndarray, best: Best):
    """Brings the best documents of one block into ``best``; ``doc`` and ``null`` are the columns' ids in order."""
    bits = (rows[None, :] >> np.arange(grid.depth - 1, -1, -1)[:, None]) & 1  # the half that a row's path takes at each depth
    nodes = np.ones((1, len(rows)), np.int32)
    low, level = np.zeros(1, np.int64), np.zeros(1, np.int64)
    bound = grid.top[nodes] @ weights
    while len(low):
        on = best.may_enter(bound, doc[low], null[low])
        if not on.all():
            low, level, bound, nodes = low[on], level[on], bound[on], nodes[on]
        if len(low) > AT_ONCE:
            pick = np.zeros(len(low), bool)
            pick[np.argpartition(-bound, AT_ONCE)[:AT_ONCE]] = True
        else:
            pick = np.ones(len(low), bool)
        leaf = pick & (level == grid.depth)
        if leaf.any():
            best.add(bound[leaf], doc[low[leaf]], null[low[leaf]])
        opened, rest = pick & ~leaf, ~pick
        parts = [(low[rest], level[rest], bound[rest], nodes[rest])]
        if opened.any():
            lo, lv, own = low[opened], level[opened], nodes[opened]
            half = bits[lv] * 2
            for right in (0, 1):
                at = lo + right * (1 << (grid.depth - 1 - lv))
                child = grid.quarter(own, half + right)
                b = grid.top[child] @ weights
                some = b > 0
                parts.append((at[some], lv[some] + 1, b[some], child[some]))
        low, level, bound, nodes = (np.concatenate(x) for x in zip(*parts, strict=True))


def _search(sent, n_docs: int, n_terms: int, top: int, block_docs: int):
    def run(batches):
        items, vocabulary = sent.value  # {item: (terms, weights)}, rows of the terms
        row = {t: i for i, t in enumerate(vocabulary)}
        best = {i: Best(top) for i in items}
        queries = {i: (np.array([row[t] for t in terms], np.int64), np.array(w, np.int64)) for i, (terms, w) in items.items()}
        ids, sizes, hits, held = [], [], [], []

        def close():
            nonlocal ids, sizes, hits, held
            if hits:
                null = np.array([i is None for i in ids])
                doc = np.array([i if i is not None else np.iinfo(np.int64).max for i in ids], np.int64)
                order = np.lexsort((doc, null))
                column = np.empty(len(order), np.int64)
                column[order] = np.arange(len(order))
                cells = np.concatenate([np.array(h, np.int64) for h in hits]) + np.repeat(column[held], [len(h) for h in hits]) * len(vocabulary)
                cells, tf = np.unique(cells, return_counts=True)
                columns, rows = np.divmod(cells, len(vocabulary))
                m = 50 + (50 * np.array(sizes, np.int64)[order] * n_docs) // n_terms
                impacts = (SCALE * tf) // (TF_SCALE * tf + LENGTH_SCALE * m[columns])
                grid = Grid(rows, columns, impacts, len(vocabulary), len(ids))
                # the columns behind the last document are empty, but a range may begin there
                pad = (1 << grid.depth) - len(ids)
                doc, null = np.pad(doc[order], (0, pad), mode="edge"), np.pad(null[order], (0, pad), mode="edge")
                for i, (r, w) in queries.items():
                    descend(grid, r, w, doc, null, best[i])
            ids, sizes, hits, held = [], [], [], []

        words = 0
        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                found = terms_of(text.as_py())
                if not found:
                    continue
                known = [row[w] for w in found if w in row]
                if known:
                    hits.append(known)
                    held.append(len(ids))
                ids.append(doc)
                sizes.append(len(found))
                words += len(found)
                if len(ids) >= block_docs or words >= BLOCK_WORDS:
                    close()
                    words = 0
        close()
        for i, b in best.items():
            if len(b.score):
                ids_out = pa.array(b.doc, pa.int64(), mask=b.null)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(b.score), i)), ids_out, pa.array(b.score)], ["item", "doc_id", "score"])

    return run


def rank_documents(docs: DataFrame, items: DataFrame, top: int = TOP, block_docs: int = BLOCK_DOCS, item_terms: int = ITEM_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of each item with a score above 0.

    ``docs`` has doc_id and text, ``items`` item_id and text; other columns are ignored. A score sums
    w * ((10^9 tf) div (1000 tf + 20 m)) over the item's distinct terms, with w = floor(1000 ln((2N + 2) /
    (2 df + 1))) and m = 50 + (50 n N) div L. Equal scores stand by ascending doc_id (null last).
    Every row of ``docs`` is a document: repeated rows and null ids rank each by themselves. Rows of
    ``items`` with one item_id are one item (their terms together), null being an id of its own.
    Null, empty and termless texts neither count nor rank; an item without known terms has no rows.
    Empty tables: no rows."""
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    items = items.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    asked = cut_lineage(items.mapInArrow(_item_terms, "item_id long, term binary").distinct(), "item-terms")
    spark = docs.sparkSession
    nothing = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    wanted = asked.select("term").distinct().unionByName(spark.createDataFrame([(bytearray(),)], "term binary"))
    counted = docs.mapInArrow(_count, _COUNTED).join(wanted, "term", "left_semi")
    counted = cut_lineage(counted.groupBy("term").agg(F.sum("df").alias("df"), F.sum("n_terms").alias("n_terms")), "term-counts")
    whole = counted.where(F.length("term") == 0).first()
    if whole is None or not whole["n_terms"]:
        return nothing
    n_docs, n_terms = whole["df"], whole["n_terms"]
    w = F.floor(F.lit(1000.0) * F.log((F.lit(2.0 * n_docs + 2)) / (F.col("df") * 2 + 1))).cast("long")
    weighted = asked.join(counted.where(F.length("term") > 0), "term").select("item_id", "term", w.alias("w")).where("w > 0")
    weighted = cut_lineage(weighted, "weighted-terms")
    blocks = max(1, -(-weighted.count() // item_terms))
    block = F.pmod(F.xxhash64(F.coalesce(F.col("item_id"), F.lit(-1)), F.col("item_id").isNull()), F.lit(blocks))
    found = nothing.select("item_id", "doc_id", "score")
    for b in range(blocks):
        # one block of items, of bounded size whatever their number
        rows = weighted.where(block == b).orderBy("item_id", "term").collect()
        if not rows:
            continue
        names, held = [], {}
        for r in rows:
            if not names or names[-1] != r["item_id"]:
                names.append(r["item_id"])
                held[len(names) - 1] = ([], [])
            held[len(names) - 1][0].append(bytes(r["term"]))
            held[len(names) - 1][1].append(r["w"])
        # rows of like weight side by side: their impacts are alike, and the maxima above them bound well
        vocabulary = sorted({(r["w"], bytes(r["term"])) for r in rows})
        sent = spark.sparkContext.broadcast((held, [t for _, t in vocabulary]))
        part = docs.mapInArrow(_search(sent, n_docs, n_terms, top, block_docs), _FOUND)
        numbers = spark.createDataFrame(list(enumerate(names)), "item long, item_id long")  # a block's items
        found = found.unionByName(cut_lineage(part.join(numbers, "item").select("item_id", "doc_id", "score"), "found"))
        sent.destroy()
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    salted = Window.partitionBy("item_id", F.pmod(F.xxhash64("doc_id", "score"), F.lit(SALTS))).orderBy(*order)
    few = found.withColumn("r", F.row_number().over(salted)).where(F.col("r") <= top).drop("r")
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(*order)).cast("int")
    return few.withColumn("rank", rank).where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


def rank_sql(top: int = TOP) -> str:
    """The same ranking in DuckDB SQL over tables documents and benchmark."""
    cut = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {cut} AS t FROM documents),
n AS (SELECT r, doc_id, len(t) AS n FROM d WHERE len(t) > 0),
c AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM n),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d) GROUP BY r, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
i AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({cut}) AS term FROM benchmark)),
w AS (SELECT i.item_id, i.term, CAST(floor(1000 * ln((2.0 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM i JOIN df USING (term), c),
s AS (SELECT w.item_id, tf.r, n.doc_id,
        CAST(sum(w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 20 * (100 - 50 + ((50 * n.n * c.n_docs) // c.n_terms))))) AS BIGINT) AS score
      FROM w JOIN tf USING (term) JOIN n ON n.r = tf.r, c GROUP BY w.item_id, tf.r, n.doc_id),
o AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= {top}"""
