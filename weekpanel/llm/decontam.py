"""Benchmark decontamination by rare n-gram seeds and Smith-Waterman alignment.

The benchmark is read in blocks of bounded size; a block's index is sent to all
tasks and the corpus is scanned, never shuffled. A copy that reaches ``least``
differs from its item in at most so many words (``most_edits``), and each edit
breaks at most one of any disjoint n-grams of the item. So one more disjoint
n-grams than edits are seeds enough: one of them stands whole in every such copy.
A first scan counts the block's n-grams in the corpus, and each item takes those
disjoint n-grams whose counts add up to the least (``rare_places``). The second
scan joins texts to items at the seeds, leaves out the items of which too few
words stand in the text to reach ``least`` whatever their order, and aligns the
others whole in a band around the seeds. An item leaks into a text if the matched
words reach ``least`` of the alignment, unmatched ends of the item and inserted
words included; edited copies are found as well."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekpanel.llm.align import align, clusters
from weekpanel.llm.hashing import NO_LETTER, shingles, text_views, word_hashes
from weekpanel.session import cut_lineage

N_WORDS = 5
LEAST = 0.8
BLOCK_WORDS = 1_000_000  # of benchmark items in one index
SECTION = 512  # seeds chosen at once

LEAK = T.StructType([
    T.StructField("item_id", T.LongType()), T.StructField("similarity", T.DoubleType()), T.StructField("matched", T.IntegerType()),
    T.StructField("item_words", T.IntegerType()), T.StructField("first_word", T.LongType()), T.StructField("end_word", T.LongType())])
_ARROW = pa.struct([("item_id", pa.int64()), ("similarity", pa.float64()), ("matched", pa.int32()), ("item_words", pa.int32()), ("first_word", pa.int64()), ("end_word", pa.int64())])


@lru_cache(maxsize=4096)
def most_edits(m: int, least: float) -> int:
    """Most words that can be changed, dropped or inserted while a copy of an item of ``m`` words still reaches ``least``."""
    lost = np.arange(m)
    lost = lost[(m - lost) / m >= least]
    if least <= 0 or not len(lost):
        return m - 1
    more = np.floor((m - lost) / least - m + 1e-6)
    return int(min((lost + more).max(), m - 1))


def seed_length(m: int, n_words: int, least: float) -> int:
    """Words of a seed: one more disjoint seeds than edits have to find room in ``m`` words."""
    return min(n_words, m // (most_edits(m, least) + 1))


def _cheapest(cost: np.ndarray, n: int, k: int) -> np.ndarray:
    """Places of ``k`` disjoint n-grams with the least sum of ``cost`` (by place; the first on ties)."""
    slack = len(cost) + n - 1 - n * k  # words that no gram covers
    # the j-th gram starts n * j to n * j + slack words in; best[x]: least sum with at most x words left out before its end
    best, moved = np.zeros(slack + 1), np.empty((k, slack + 1), np.int32)
    for j in range(k):
        total = best + cost[n * j : n * j + slack + 1]
        best = np.minimum.accumulate(total)
        new = np.concatenate(([True], total[1:] < best[:-1]))
        moved[j] = np.maximum.accumulate(np.where(new, np.arange(slack + 1), 0))
    places, x = np.empty(k, int), slack
    for j in reversed(range(k)):
        x = moved[j, x]
        places[j] = n * j + x
    return places


def rare_places(counts: np.ndarray, m: int, n: int, k: int) -> np.ndarray:
    """Places of ``k`` disjoint n-grams of an item of ``m`` words with small ``counts`` (by place).

    Up to ``SECTION`` grams are chosen together with the least sum; longer items are cut into
    sections with room for as many grams each, so time stays linear."""
    edges = [i * m // k for i in range(0, k, SECTION)] + [m]
    quota = [min(SECTION, k - i) for i in range(0, k, SECTION)]
    return np.concatenate([lo + _cheapest(counts[lo : hi - n + 1], n, q) for lo, hi, q in zip(edges[:-1], edges[1:], quota, strict=True)])


class Index:
    """Items of one block and where their n-grams stand: all of them, to be counted, until ``rare`` picks the seeds."""

    def __init__(self, items: list, n_words: int, least: float):
        self.ids = [i for i, _ in items]
        self.words = [w for _, w in items]
        self.size = np.array([len(w) for w in self.words])
        self.edits = [most_edits(m, least) for m in self.size.tolist()]
        self.length = [seed_length(m, n_words, least) for m in self.size.tolist()]
        self.lengths = sorted(set(self.length))
        self.flat = np.concatenate(self.words)
        self.start = np.cumsum(self.size) - self.size
        self._post([np.arange(m - n + 1) for m, n in zip(self.size.tolist(), self.length, strict=True)])

    def _post(self, places: list) -> None:
        """Index the n-grams of each item at ``places``."""
        gram = np.concatenate([shingles(w, n)[p] for w, n, p in zip(self.words, self.length, places, strict=True)])
        item, place = np.repeat(np.arange(len(places)), [len(p) for p in places]), np.concatenate(places)
        order = np.argsort(gram, kind="stable")
        self.item, self.place = item[order], place[order]
        self.grams, self.first = np.unique(gram[order], return_index=True)
        self.end = np.append(self.first[1:], len(gram))

    def rare(self, counts: np.ndarray) -> "Index":
        """Keep as seeds the rarest disjoint n-grams by ``counts`` in the corpus, one more than the item's edits."""
        places = []
        for w, n, e in zip(self.words, self.length, self.edits, strict=True):
            places.append(rare_places(counts[np.searchsorted(self.grams, shingles(w, n))], len(w), n, e + 1))
        self._post(places)
        return self

    def hits(self, words: np.ndarray):
        """(place in the text, n-gram) of the block's n-grams in a text."""
        at, which = [], []
        for n in self.lengths:
            if len(words) < n:
                continue
            g = shingles(words, n)
            x = np.minimum(np.searchsorted(self.grams, g), len(self.grams) - 1)
            p = np.flatnonzero(self.grams[x] == g)
            at.append(p)
            which.append(x[p])
        none = np.zeros(0, int)
        return np.concatenate(at or [none]), np.concatenate(which or [none])

    def possible(self, items: np.ndarray, words: np.ndarray, least: float) -> np.ndarray:
        """The items of which enough words for ``least`` stand in ``words``, in any order: no alignment matches more."""
        n = self.size[items]
        ahead = np.cumsum(n) - n
        flat = self.flat[np.repeat(self.start[items] - ahead, n) + np.arange(n.sum())]
        known = np.unique(words)
        there = known[np.minimum(np.searchsorted(known, flat), len(known) - 1)] == flat
        return np.add.reduceat(there, ahead, dtype=np.int64) / n >= least

    def leaks(self, words: np.ndarray, least: float) -> list:
        at, which = self.hits(words)
        if not len(at):
            return []
        n = (self.end - self.first)[which]
        posting = np.repeat(self.first[which], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        item, diagonal = self.item[posting], np.repeat(at, n) - self.place[posting]
        order = np.argsort(item, kind="stable")
        found, edge = [], np.flatnonzero(np.diff(item[order], prepend=-1))
        some = self.possible(item[order[edge]], words, least)
        for lo, hi in zip(edge[some], np.append(edge[1:], len(order))[some], strict=True):
            k = int(item[order[lo]])
            w, best = self.words[k], None
            for middle, band in clusters(diagonal[order[lo:hi]], len(w)):
                if np.isin(w, words[max(0, middle - band) : middle + band + len(w)]).sum() / len(w) < least:
                    continue
                x = align(w, words, middle, band)
                if x and (best is None or x.similarity(len(w)) > best.similarity(len(w))):
                    best = x
                    if x.matched == len(w) == x.columns:
                        break
            if best and best.similarity(len(w)) >= least:
                found.append({"item_id": self.ids[k], "similarity": best.similarity(len(w)), "matched": best.matched, "item_words": len(w), "first_word": best.b_start, "end_word": best.b_end})
        return found


def _blocks(benchmark: DataFrame, n_words: int, least: float, block_words: int):
    """Indexes over the benchmark, each of about ``block_words`` words."""
    block, size = [], 0
    for row in benchmark.select("item_id", "text").toLocalIterator():
        w = word_hashes(np.frombuffer((row["text"] or "").encode(), np.uint8), NO_LETTER)
        if len(w):
            block.append((row["item_id"], w))
            size += len(w)
        if size >= block_words:
            yield Index(block, n_words, least)
            block, size = [], 0
    if block:
        yield Index(block, n_words, least)


def _words(batch):
    return (word_hashes(v, NO_LETTER) for v in text_views(batch.column("text")))


def _count(sent):
    """Occurrences of the block's n-grams in a task's texts: (gram, n) by number."""

    def run(batches):
        total = np.zeros(len(sent.value.grams), np.int64)
        for batch in batches:
            for words in _words(batch):
                np.add.at(total, sent.value.hits(words)[1], 1)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["gram", "n"])

    return run


def _mark(sent, least: float):
    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index("leaks")
            found = [old + sent.value.leaks(words, least) for old, words in zip(batch.column("leaks").to_pylist(), _words(batch), strict=True)]
            yield batch.set_column(at, "leaks", pa.array(found, pa.list_(_ARROW)))

    return run


def mark_leaks(docs: DataFrame, benchmark: DataFrame, n_words: int = N_WORDS, least: float = LEAST, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` plus ``leaks``: an array with an entry for each benchmark item found in the text.

    ``docs`` needs text, ``benchmark`` item_id and text; all columns of docs pass through (one named
    leaks is replaced). Words are runs of letters, digits and non-ASCII
    bytes with A-Z folded. Seeds have ``n_words`` words, fewer where an item has no room for as many as copies at
    ``least`` ask for; items and texts without words (null, empty) never match. Repeated items give repeated entries, repeated rows are
    marked alike. ``first_word`` and ``end_word`` bound the best alignment in the text's words.
    A benchmark of several blocks is worked off block by block: the rows are written before the next block's index is
    sent, so one index is alive at a time. Empty tables: no rows, or empty arrays."""
    docs = docs.drop("leaks")
    out = docs.withColumn("leaks", F.array().cast(T.ArrayType(LEAK)))
    sc, last = docs.sparkSession.sparkContext, None
    for index in _blocks(benchmark, n_words, least, block_words):
        if last:
            out = cut_lineage(out, "leaks")
            last.destroy()
        sent = sc.broadcast(index)
        # at most as many rows as a block has n-grams
        found = docs.select("text").mapInArrow(_count(sent), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
        sent.destroy()
        counts = np.zeros(len(index.grams))
        counts[found.gram.to_numpy(int)] = found.n.to_numpy(float)
        last = sc.broadcast(index.rare(counts))
        out = out.mapInArrow(_mark(last, least), out.schema)
    return out
