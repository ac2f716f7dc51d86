"""Runs of periodic word sequences, found by a dictionary of basic factors.

Basic factors are the stretches of 1, 2, 4, ... words; equal ones share a name,
and the names of one length come from pairs of names of half that length. Take
length m. Two successive occurrences of a factor that are at most 2 m apart
propose their distance as a period. Distances above m are left to length 2 m:
there the two occurrences overlap or touch as well, and so the words between
them are known to repeat. A distance d of at most m means that the words from
the first occurrence to the end of the second have period d; neighbouring
places of the same distance form one progression, and by the theorem of Fine
and Wilf a whole progression is exactly one run that cannot be extended. A run
of period d shows at every length from d on; it is taken at the first (d above
m / 2), so none comes twice. Factors without a second occurrence in their
document cannot begin a longer repeated one and are dropped from level to
level, which leaves little work beyond the first few lengths.

Words are compared exactly (by a dictionary of the batch, not by hashes).
Documents of a batch are handled together in numpy, in groups of bounded size;
only one length is held at a time, so memory is linear in the longest text."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

LEAST_LENGTH, LEAST_POWER = 6, 4  # a run has at least so many words and so many periods
GROUP_WORDS = 1 << 19  # words of the documents handled at once (one longer document: its own)

RUN = StructType([StructField(n, LongType(), False) for n in ("start", "length", "period")])
OUT = [StructField("n_words", LongType()), StructField("runs", ArrayType(RUN)), StructField("collapsed", StringType())]


def find_runs(names: np.ndarray, ends: np.ndarray, least_length: int = LEAST_LENGTH, least_power: int = LEAST_POWER):
    """(start, length, period) of all runs, by start, then period, of documents
    whose words stand one behind the other: ``names`` are the words' numbers,
    equal only within a document; ``ends[i]`` is the end of the document of
    place i."""
    total = len(names)
    at = np.arange(total)  # places whose factor lies in its document and may occur again
    key, found, m = names.astype(np.int64), [], 1
    while len(at):
        order = np.argsort(key, kind="stable")  # equal factors side by side, by place
        places, sorted_key = at[order], key[order]
        same = sorted_key[1:] == sorted_key[:-1]
        gap = np.where(same, places[1:] - places[:-1], 0)  # to the successor
        near = (gap > m // 2) & (gap <= m)
        begins, d = places[:-1][near], gap[near]
        if len(begins):
            back = np.lexsort((begins, d))
            begins, d = begins[back], d[back]
            head = np.concatenate(([True], (begins[1:] != begins[:-1] + 1) | (d[1:] != d[:-1])))
            first = np.flatnonzero(head)
            last = np.concatenate((first[1:], [len(begins)])) - 1
            start, period = begins[first], d[first]
            length = begins[last] - start + period + m
            keep = length >= np.maximum(least_length, least_power * period)
            found.append((start[keep], length[keep], period[keep]))
        # names of twice the length, for places where both halves occur elsewhere too
        again = np.concatenate(([False], same)) | np.concatenate((same, [False]))
        name = np.full(total, -1, np.int64)
        name[places] = np.where(again, np.cumsum(np.concatenate(([0], ~same))), -1)
        at = np.sort(places[again])
        at = at[at + 2 * m <= ends[at]]
        at = at[name[at + m] >= 0]
        key = name[at] * total + name[at + m]
        m *= 2
    if not found:
        return (np.zeros(0, np.int64),) * 3
    start, length, period = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def kept_words(total: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Mask of the words that no run contains behind its first period."""
    step = np.zeros(total + 1, np.int64)
    np.add.at(step, start + period, 1)
    np.add.at(step, start + length, -1)
    return np.cumsum(step)[:-1] == 0


def _group(texts: list[list[bytes]], least_length: int, least_power: int):
    """(runs, collapsed text) of each list of words."""
    sizes = np.array([len(w) for w in texts], np.int64)
    flat = [w for words in texts for w in words]
    numbers: dict = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in flat), np.int64, len(flat))
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    doc = np.repeat(np.arange(len(texts)), sizes)
    start, length, period = find_runs(doc * max(len(numbers), 1) + ids, bounds[1:][doc], least_length, least_power)
    keep = kept_words(len(flat), start, length, period)
    where = np.searchsorted(start, bounds)
    for i, words in enumerate(texts):
        lo, hi = where[i], where[i + 1]
        if lo == hi:
            yield [], b" ".join(words).decode()
        else:
            own = keep[bounds[i] : bounds[i + 1]].tolist()
            rows = zip((start[lo:hi] - bounds[i]).tolist(), length[lo:hi].tolist(), period[lo:hi].tolist(), strict=True)
            yield [dict(zip(("start", "length", "period"), r, strict=True)) for r in rows], b" ".join([w for w, k in zip(words, own, strict=True) if k]).decode()


def _mark(column: str, least_length: int, least_power: int):
    kind = pa.list_(pa.struct([pa.field(n, pa.int64(), False) for n in ("start", "length", "period")]))

    def run(batches):
        for batch in batches:
            texts, at, held, done = batch.column(column), 0, [], 0
            for i in range(batch.num_rows):
                held.append((texts[i].as_py() or "").encode().split())  # bytes split at the six ASCII white-space bytes
                at += len(held[-1])
                if at >= GROUP_WORDS or i + 1 == batch.num_rows:
                    runs, collapsed = zip(*_group(held, least_length, least_power), strict=True)
                    part = batch.slice(done, len(held))
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns, pa.array(map(len, held), pa.int64()), pa.array(runs, kind), pa.array(collapsed, pa.string())],
                        [*part.schema.names, *(f.name for f in OUT)])
                    at, done, held = 0, i + 1, []

    return run


def mark_runs(docs: DataFrame, column: str = "text", least_length: int = LEAST_LENGTH, least_power: int = LEAST_POWER) -> DataFrame:
    """``docs`` with n_words, runs (array of start, length, period by start, then period) and collapsed.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text, numbered from 0. A run is a stretch of
    consecutive words with smallest period q and at least ``least_length`` words and ``least_power``
    periods that no neighbouring word extends. ``collapsed`` holds the words that no run contains behind
    its first q words, joined by one space. Null, empty and blank texts: no words, no runs, an empty
    ``collapsed``. Repeated rows are handled each; other columns stay, but columns named as the results
    are replaced. Empty table: no rows. Row by row, without a shuffle. ``least_power`` is 2 at least."""
    if least_power < 2:
        raise ValueError("a run has two periods at least")
    docs = docs.drop(*(f.name for f in OUT))
    return docs.mapInArrow(_mark(column, least_length, least_power), StructType([*docs.schema.fields, *OUT]))


def strongest(runs: str) -> Column:
    """The run with the greatest exact length / period (ties: smallest start, then period), null without one."""
    none = F.lit(None).cast(RUN)
    better = lambda a, b: a.isNull() | (b["length"] * a["period"] > a["length"] * b["period"])
    return F.reduce(F.col(runs), none, lambda a, b: F.when(better(a, b), b).otherwise(a))


def runs_digest(runs: str) -> Column:
    """Hex SHA-256 of one line ``start,length,period`` for every run."""
    lines = F.transform(F.col(runs), lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return F.sha2(F.array_join(lines, "").cast("binary"), 256)


def with_planted_run(docs: DataFrame, key: str = "doc_id", column: str = "text") -> DataFrame:
    """Texts in which a tenth of the documents, chosen by their key's checksum, go on periodically.

    h = crc32 of the decimal key, g = h div 10. Where h % 10 = 0 and the text has n > 0 words, each word
    i >= a becomes word a + (i - a) % p, with a = g % n and p = 1 + (n - a) div (3 + g % 8). A null key
    has no checksum: its text stays."""
    h = F.crc32(F.col(key).cast("string").cast("binary"))
    words = F.regexp_extract_all(F.coalesce(F.col(column), F.lit("")), F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    chosen = docs.withColumns({"_h": h, "_w": F.when(F.col("_h") % 10 == 0, words)})
    n, g = F.size("_w"), F.floor(F.col("_h") / 10)
    a = g % n
    p = F.floor((n - a) / (g % 8 + 3)) + 1
    again = F.ceil((n - a) / p)
    whole = lambda c: c.cast("int")
    tail = F.flatten(F.array_repeat(F.slice("_w", whole(a + 1), whole(p)), whole(again)))
    planted = F.slice(F.concat(F.slice("_w", F.lit(1), whole(a)), tail), F.lit(1), n)
    text = F.when((F.col("_h") % 10 == 0) & (n > 0), F.array_join(planted, " ")).otherwise(F.col(column))
    return chosen.withColumn(column, text).drop("_h", "_w")
