"""Exact removal of repeated byte strings, suffix bucket by suffix bucket.

A byte goes if a ``length``-byte string covering it also starts anywhere else.
Only whether the first ``length`` bytes of two suffixes are equal matters, so
this is blockwise suffix sorting cut off at that depth:

1. Buckets. Each suffix of at least ``length`` bytes belongs to the bucket of
   the k-gram with the smallest hash in its first ``length`` bytes (leftmost on
   ties) and its distance to it: equal strings share the bucket. Consecutive
   suffixes of one anchor travel as one interval. A bucket that a single interval uses holds no
   repetition.
2. Intervals whose whole contexts (all their suffixes' first ``length`` bytes)
   are equal repeat each other; only distinct contexts go on, with their bytes.
3. Distinct contexts of a bucket are sorted one block of buckets at a time. For
   the block's bytes, ranks are precomputed for the suffixes at a difference
   cover modulo 13; two suffixes have a common distance (below 13) to cover
   positions, so a long tie between them is resolved by the first twelve and last twelve bytes
   and one cover rank. Buckets too large for a block are spread by the hash of their strings
   over all tasks.

A text is processed in pieces and a block has a size bound, so memory depends
on neither the longest text nor the largest bucket."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekpanel.llm.hashing import U, mix, pack_texts, prefix_sums, substring_hashes, text_views, unpack
from weekpanel.session import cut_lineage

LENGTH = 400
GRAM = 160  # bytes of the k-gram that names a bucket
PIECE = 1 << 20  # suffixes handled at once
BLOCK = 1 << 22  # bytes of contexts sorted at once
LARGE = 4096  # contexts; a larger bucket is spread over tasks
# fixed value: a perfect difference set modulo 13
PERIOD, COVER = 13, (0, 1, 3, 9)

INTERVALS = "id long, th long, name long, ctx long, occ long, a long, n long, spans array<long>"
LAST_ID = (1 << 63) - 1
_PLACE_BITS = 21  # PIECE + length < 2**21
_PLACE = U((1 << _PLACE_BITS) - 1)


def _window_minimum(h: np.ndarray, w: int) -> np.ndarray:
    """The minimum of every window of ``w`` values."""
    n = len(h)
    padded = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, U)
    padded[:n] = h
    blocks = padded.reshape(-1, w)
    upto = np.minimum.accumulate(blocks, axis=1).ravel()  # from a block's start
    since = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()  # to a block's end
    return np.minimum(since[: n - w + 1], upto[w - 1 : n])


def intervals(b: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(first suffix, count, bucket name, context hash) arrays of one text, by place.

    The suffixes with at least ``length`` bytes left, in runs with one anchor."""
    w = length - gram + 1
    parts = []
    for lo in range(0, len(b) - length + 1, PIECE):
        piece = b[lo : lo + PIECE + length - 1]
        c = prefix_sums(piece)
        s = np.arange(len(piece) - gram + 1)
        h = substring_hashes(c, s, s + gram)
        # the place in the low bits makes the leftmost of equal grams the smallest
        place = (_window_minimum((h & ~_PLACE) | s.astype(U), w) & _PLACE).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        count = np.diff(np.append(first, len(place)))
        at = place[first]
        ctx = mix(substring_hashes(c, first, first + count - 1 + length) + (at - first).astype(U))
        parts.append((first + lo, count, h[at], ctx))
    return [np.concatenate(x) for x in zip(*parts, strict=True)]


def _merged(starts: np.ndarray, ends: np.ndarray):
    """Union of half-open intervals, sorted; touching ones become one."""
    order = np.argsort(starts, kind="stable")
    s, e = starts[order], np.maximum.accumulate(ends[order])
    new = np.flatnonzero(np.concatenate(([True], s[1:] > e[:-1])))
    return s[new], e[np.append(new[1:], len(s)) - 1]


def _fold_repeats(a, n, name, ctx):
    """Rows (a, n, name, ctx, occ, spans): contexts that a text holds several
    times become one row with the union of their suffixes."""
    key = mix(name + mix(ctx))
    order = np.argsort(key, kind="stable")
    k = key[order]
    first = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
    occ = np.diff(np.append(first, len(k)))
    at = order[first]
    spans = [None] * len(first)
    for i in np.flatnonzero(occ > 1).tolist():
        x = order[first[i] : first[i] + occ[i]]
        spans[i] = np.stack(_merged(a[x], a[x] + n[x]), axis=1).ravel()
    return a[at], n[at], name[at], ctx[at], occ, spans


def _emit_intervals(length: int, gram: int):
    def run(batches):
        for batch in batches:
            ids, ths = batch.column("id").to_numpy(), batch.column("th").to_numpy()
            rows, doc, size = [], [], 0
            for i, b in enumerate(text_views(batch.column("text"))):
                if len(b) >= length:
                    rows.append(_fold_repeats(*intervals(b, length, gram)))
                    doc.append(np.full(len(rows[-1][0]), i))
                    size += len(doc[-1])
                if rows and (size > 300_000 or i == batch.num_rows - 1):
                    yield _interval_batch(ids, ths, rows, doc)
                    rows, doc, size = [], [], 0
            if rows:
                yield _interval_batch(ids, ths, rows, doc)

    return run


def _interval_batch(ids, ths, rows, doc):
    a, n, name, ctx, occ = (np.concatenate([r[k] for r in rows]) for k in range(5))
    doc = np.concatenate(doc)
    spans = [x for r in rows for x in r[5]]
    return pa.RecordBatch.from_arrays(
        [pa.array(x) for x in (ids[doc], ths[doc], name.view(np.int64), ctx.view(np.int64), occ, a, n)] + [pa.array(spans, pa.list_(pa.int64()))],
        ["id", "th", "name", "ctx", "occ", "a", "n", "spans"])


def _cut_contexts(length: int):
    def run(batches):
        for batch in batches:
            out: list = [[] for _ in range(7)]
            size = 0
            for i, (b, wanted) in enumerate(zip(unpack(batch.column("z")), batch.column("wanted").to_pylist(), strict=True)):
                for w in wanted:
                    body = b[w["a"] : w["a"] + w["n"] - 1 + length].tobytes()
                    size += len(body)
                    for col, x in zip(out, (w["name"], batch.column("id")[i].as_py(), batch.column("th")[i].as_py(), w["a"], w["n"], w["alone"], body), strict=True):
                        col.append(x)
                if size > BLOCK:
                    yield _context_batch(out)
                    out, size = [[] for _ in range(7)], 0
            if out[0]:
                yield _context_batch(out)

    return run


CONTEXTS = "name long, id long, th long, a long, n long, alone boolean, body binary"


def _context_batch(out):
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], [c.split()[0] for c in CONTEXTS.split(", ")])


def repeated_suffixes(bodies: list, counts: np.ndarray, buckets: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Which suffixes of the contexts equal another one for ``length`` bytes.

    ``bodies`` are contexts as bytes, ``counts`` their suffixes, ``buckets``
    their names. Returns one flag per suffix, context by context."""
    text = np.frombuffer(b"".join(bodies), np.uint8)
    offset = np.concatenate(([0], np.cumsum([len(x) for x in bodies])[:-1]))
    which = np.repeat(np.arange(len(bodies)), counts)
    i = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts) + offset[which]  # suffixes
    c = prefix_sums(text)
    edge = PERIOD - 1
    rest = length - edge
    # ranks of the suffixes at cover positions, by sorting their first `rest` bytes
    in_cover = np.zeros(PERIOD, bool)
    in_cover[list(COVER)] = True
    near = np.zeros(len(text), bool)
    for d in range(PERIOD):
        near[i + d] = True
    sample = np.flatnonzero(near & in_cover[np.arange(len(text)) % PERIOD])
    rank = np.zeros(len(text), U)
    rank[sample] = np.unique(substring_hashes(c, sample, sample + rest), return_inverse=True)[1].astype(U)
    ends = substring_hashes(c, i, i + edge) + mix(substring_hashes(c, i + rest, i + length))
    base = mix(ends + mix(buckets[which].view(U)))
    # suffixes with a common distance d to cover positions tie when ends and ranks are equal
    hit = np.zeros(len(i), bool)
    for d in range(PERIOD):
        x = np.flatnonzero(in_cover[(i + d) % PERIOD])
        key = mix(base[x] + rank[i[x] + d] * U(0x9E3779B97F4A7C15))
        order = np.argsort(key)
        k = key[order]
        same = k[1:] == k[:-1]
        hit[x[order[1:][same]]] = True
        hit[x[order[:-1][same]]] = True
    return hit


def _runs(flags: np.ndarray):
    """(start, end) of the runs of True."""
    f = np.flatnonzero(np.diff(np.concatenate(([False], flags, [False])).astype(np.int8)))
    return zip(f[0::2].tolist(), f[1::2].tolist(), strict=True)


def _sort_blocks(length: int):
    """Contexts sorted by bucket in, runs of repeated suffixes out; one block of whole buckets at a time."""

    def resolve(rows):
        counts = np.array([r[4] for r in rows])
        hit = repeated_suffixes([r[6] for r in rows], counts, np.array([r[0] for r in rows], np.int64), length)
        out, at = [], 0
        for r in rows:
            if r[5]:
                out += [(r[1], r[2], r[3] + s, r[3] + e) for s, e in _runs(hit[at : at + r[4]])]
            at += r[4]
        return pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.int64()) for k in range(4)], ["id", "th", "s", "e"])

    def run(batches):
        rows, size, name = [], 0, None
        for batch in batches:
            for r in zip(*(batch.column(k).to_pylist() for k in range(7)), strict=True):
                if size >= BLOCK and r[0] != name:
                    yield resolve(rows)
                    rows, size = [], 0
                rows.append(r)
                size += len(r[6])
                name = r[0]
        if rows:
            yield resolve(rows)

    return run


def _spread(length: int):
    """Every suffix of a context with the hash of its bytes, for buckets too large for a block."""

    def run(batches):
        for batch in batches:
            for r in zip(*(batch.column(k).to_pylist() for k in range(7)), strict=True):
                b = np.frombuffer(r[6], np.uint8)
                i = np.arange(r[4])
                h = substring_hashes(prefix_sums(b), i, i + length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array(np.full(len(i), r[0])), pa.array(np.full(len(i), r[1])), pa.array(np.full(len(i), r[2])), pa.array(i + r[3]), pa.array([r[5]] * len(i))],
                    ["h", "name", "id", "th", "s", "alone"])

    return run


def _finish(length: int):
    def run(batches):
        for batch in batches:
            rows: list = [[] for _ in range(6)]
            for i, (b, found) in enumerate(zip(unpack(batch.column("z")), batch.column("found").to_pylist(), strict=True)):
                spans = []
                kept = b
                if found:
                    pairs = np.array([(f["s"], f["e"]) for f in found], np.int64)
                    s, e = _merged(pairs[:, 0], pairs[:, 1] - 1 + length)
                    spans = np.stack((s, e), axis=1).ravel().tolist()
                    step = np.zeros(len(b) + 1, np.int8)
                    step[s] += 1
                    step[e] -= 1
                    kept = b[np.cumsum(step[:-1], dtype=np.int8) == 0]
                kept = kept.tobytes()
                row = (len(b), len(b) - len(kept), len(spans) // 2, hashlib.sha256(kept).hexdigest(), spans)
                for col, x in zip(rows, (batch.column("id")[i].as_py(), *row), strict=True):
                    col.append(x)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(rows, kinds, strict=True)], [c.split()[0] for c in REMOVED.split(", ")])

    return run


REMOVED = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<long>"


def repeated_bytes(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, large: int = LARGE) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans), a row per document.

    ``docs`` needs doc_id and text; other columns are ignored. ``spans`` lists start and end
    byte offsets of the removed runs in turn; they may cut UTF-8 characters. Strings never cross
    documents; repeated rows repeat each other. Null texts are empty; texts shorter than ``length`` keep
    all bytes. Null ids come back null. Empty table: no rows."""
    base = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"), "text")
    t = cut_lineage(base.mapInArrow(_emit_intervals(length, gram), INTERVALS), "intervals")
    # all sides below grow with the corpus: they are merged at every size and never broadcast
    names = t.groupBy("name").agg(F.sum("occ").alias("c"), F.min("ctx").alias("lo"), F.max("ctx").alias("hi")).where("c > 1")
    m = t.join(names.select("name", (F.col("lo") != F.col("hi")).alias("mixed")).hint("merge"), "name")
    m = cut_lineage(m, "shared")
    own = F.transform(F.sequence(F.lit(0), (F.size("spans") / 2 - 1).cast("int")), lambda k: F.struct(F.get("spans", 2 * k).alias("s"), F.get("spans", 2 * k + 1).alias("e")))
    single = F.array(F.struct(F.col("a").alias("s"), (F.col("a") + F.col("n")).alias("e")))
    found = m.where("not mixed or occ > 1").select("id", "th", F.explode(F.when(F.col("occ") > 1, own).otherwise(single)).alias("x")).select("id", "th", "x.s", "x.e")
    mixed = m.where("mixed")
    contexts = mixed.groupBy("name", "ctx").agg(F.sum("occ").alias("c"), F.min(F.struct("id", "th", "a", "n")).alias("r"))
    contexts = cut_lineage(contexts, "contexts")
    several = contexts.where("c > 1").select("name", "ctx")
    found = found.unionByName(
        mixed.where("occ = 1").join(several.hint("merge"), ["name", "ctx"], "left_semi").select("id", "th", F.col("a").alias("s"), (F.col("a") + F.col("n")).alias("e")))
    # the bytes of the distinct contexts
    wanted = contexts.select("r.id", "r.th", F.struct("name", "r.a", "r.n", (F.col("c") == 1).alias("alone")).alias("w"))
    wanted = wanted.groupBy("id", "th").agg(F.collect_list("w").alias("wanted"))
    packed = lambda: base.mapInArrow(pack_texts, "id long, th long, z binary")
    bodies = packed().dropDuplicates(["id", "th"]).join(wanted.hint("merge"), ["id", "th"]).select("id", "th", "z", "wanted")
    bodies = bodies.mapInArrow(_cut_contexts(length), CONTEXTS)
    big = cut_lineage(contexts.groupBy("name").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > large).select("name"), "large")
    if big.isEmpty():
        small, spread = bodies, None
    else:
        bodies = cut_lineage(bodies, "bodies")
        small = bodies.join(big.hint("merge"), "name", "left_anti").select(*[c.split()[0] for c in CONTEXTS.split(", ")])
        spread = bodies.join(big.hint("merge"), "name", "left_semi").select(*[c.split()[0] for c in CONTEXTS.split(", ")])
    blocks = small.repartition("name").sortWithinPartitions("name").mapInArrow(_sort_blocks(length), "id long, th long, s long, e long")
    found = found.unionByName(blocks)
    if spread is not None:
        suffixes = spread.mapInArrow(_spread(length), "h long, name long, id long, th long, s long, alone boolean")
        twice = suffixes.groupBy("name", "h").agg(F.count(F.lit(1)).alias("c")).where("c > 1").drop("c")
        more = suffixes.where("alone").join(twice.hint("merge"), ["name", "h"], "left_semi")
        found = found.unionByName(more.select("id", "th", "s", (F.col("s") + 1).alias("e")))
    per_text = found.groupBy("id", "th").agg(F.collect_list(F.struct("s", "e")).alias("found"))  # at most a text's own intervals
    out = packed().join(per_text.hint("merge"), ["id", "th"], "left").select("id", "z", "found").mapInArrow(_finish(length), REMOVED)
    return out.select(F.when(F.col("id") != LAST_ID, F.col("id")).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans")
