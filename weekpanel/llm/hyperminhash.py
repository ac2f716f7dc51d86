"""Near-duplicate texts by HyperMinHash sketches, banding and exact confirmation.

A text is the set of its word shingles. Every shingle, repeated under ``t``
salts so that small sets fill the sketch too (this leaves Jaccard similarity
unchanged), hashes into one of 256 buckets; a bucket keeps its smallest value as leading-zero
count plus ten mantissa bits (Yu and Weber, 2017). Bands of registers give
candidate pairs, the collision-corrected estimate thins them, and links are
confirmed on the full shingle sets.

Equal sets form a class and only classes are compared. In each band bucket all
members are first compared with one pivot. Buckets that the components of these
links still split are then settled exactly inside tasks: members outside the
largest component meet all others of their bucket, chunk by chunk, as products
of 0/1 shingle matrices. A task returns a spanning forest of the links it
finds, so no group is ever written out as pairs and no candidate pair between
different components is left out."""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekpanel.llm.blocks import chunk_pairs
from weekpanel.llm.components import connected_components, smallest_reachable
from weekpanel.llm.hashing import U, mix, pack_texts, shingles, text_views, unpack, word_hashes
from weekpanel.session import cut_lineage

P_BITS, MANTISSA = 8, 10
BUCKETS = 1 << P_BITS
ROWS, BANDS = 7, 36  # a pair at similarity 0.85 misses all bands once in a million
TOP = 11  # texts with 2**TOP shingles or more use one salt
EMPTY = 0xFFFF
CHUNK = 1024  # members of a split bucket that meet in one task
COLUMNS = 4096  # shingles of a matrix product
LAST_ID = (1 << 63) - 1
_KEYS = mix(np.arange(5001, 5001 + (1 << TOP) * 2, dtype=U))


def text_hash(text="text"):
    """Column: 128 bits of the text's SHA-256 (null: no bytes)."""
    return F.coalesce(F.substring(F.unhex(F.sha2(F.col(text).cast("binary"), 256)), 1, 16), F.lit(b""))


def text_shingles(b: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a text's bytes."""
    return np.unique(shingles(word_hashes(b), n))


def levels_of(n: int, percent: int) -> list[int]:
    """Sketch levels of a set of ``n``: its own, and the next lower one when a
    partner at the threshold can belong there."""
    own = min(n.bit_length() - 1, TOP)
    return [own, own - 1] if own and percent * n < 100 * (1 << own) else [own]


def registers(s: np.ndarray, level: int) -> np.ndarray:
    """256 registers of the shingles under ``2**(TOP - level)`` salts."""
    salts = _KEYS[: 1 << (TOP - level)]
    h = mix((s[None, :] ^ salts[:, None]).ravel())
    h.sort()
    bucket = (h >> U(64 - P_BITS)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
    v = (h[first] >> U(4)) & U((1 << 52) - 1)
    zeros = 52 - np.frexp(v.astype(float))[1]  # leading zeros of 52 bits
    mantissa = ((v << (zeros + 1).astype(U)) & U((1 << 52) - 1)) >> U(52 - MANTISSA)
    out = np.full(BUCKETS, EMPTY, np.uint16)
    out[bucket[first]] = (zeros.astype(np.uint16) << MANTISSA) | mantissa.astype(np.uint16)
    return out


def band_keys(regs: np.ndarray, level: int) -> np.ndarray:
    r = regs[: ROWS * BANDS].astype(U).reshape(BANDS, ROWS) + U(1)
    h = (r * _KEYS[:ROWS]).sum(axis=1, dtype=U)
    return mix(mix(h) + _KEYS[100 : 100 + BANDS] + U(level))


@lru_cache(maxsize=4096)
def _expected_collisions(log_n: int, log_m: int) -> float:
    n, m = 2 ** (log_n / 4), 2 ** (log_m / 4)
    i = np.arange(1, 41)[:, None]
    j = np.arange(1 << MANTISSA)[None, :]
    size = 2.0 ** (P_BITS + MANTISSA + i)
    low, high = ((1 << MANTISSA) + j) / size, ((1 << MANTISSA) + j + 1) / size
    hit = lambda x: np.exp(x * np.log1p(-low)) - np.exp(x * np.log1p(-np.minimum(high, 1 - 1e-16)))
    return float(BUCKETS * (hit(n) * hit(m)).sum())


def estimate(ra: np.ndarray, rb: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard estimates of rows of registers, less the collisions expected by chance of sets of n and m."""
    some = (ra != EMPTY) | (rb != EMPTY)
    same = ((ra == rb) & some).sum(axis=1)
    chance = np.array([_expected_collisions(round(4 * math.log2(x)), round(4 * math.log2(y))) for x, y in zip(n, m, strict=True)])
    return np.maximum(0, same - chance) / np.maximum(1, some.sum(axis=1))


def _sketch(n_words: int, percent: int):
    def run(batches):
        for batch in batches:
            rows: list = [[] for _ in range(6)]
            pick = []
            for i, v in enumerate(text_views(batch.column("text"))):
                s = text_shingles(v, n_words)
                digest = [int(mix(x).sum(dtype=U).astype(np.int64)) for x in (s ^ _KEYS[0], s + _KEYS[1])]
                for k, level in enumerate(levels_of(len(s), percent) if len(s) else [-1]):
                    pick.append(i)
                    regs = registers(s, level).tobytes() if level >= 0 else b""
                    for out, x in zip(rows, (len(s), *digest, k == 0, level, regs), strict=True):
                        out.append(x)
            pick = pa.array(pick, pa.int64())
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pick), batch.column("th").take(pick)] + [pa.array(r, t) for r, t in zip(rows, kinds, strict=True)],
                ["id", "th", "n", "s1", "s2", "main", "level", "regs"])

    return run


def _bands(batches):
    for batch in batches:
        keys = [band_keys(np.frombuffer(r, np.uint16), lv) for r, lv in zip(batch.column("regs").to_pylist(), batch.column("level").to_pylist(), strict=True)]
        th = np.repeat(batch.column("th").to_numpy(), BANDS)
        yield pa.RecordBatch.from_arrays([pa.array((np.concatenate(keys) if keys else np.zeros(0, U)).view(np.int64)), pa.array(th, pa.int64())], ["key", "th"])


def _likely(percent: int):
    least = percent / 100 - 6 * math.sqrt(percent / 100 * (1 - percent / 100) / BUCKETS)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            ra, rb = (np.stack([np.frombuffer(x, np.uint16) for x in batch.column(c).to_pylist()]) for c in ("ra", "rb"))
            salts = 2.0 ** (TOP - batch.column("level").to_numpy())
            j = estimate(ra, rb, batch.column("na").to_numpy() * salts, batch.column("nb").to_numpy() * salts)
            ok = pa.array(j >= least)
            yield batch.select(["a", "b"]).filter(ok)

    return run


def _confirm(n_words: int, percent: int):
    def run(batches):
        last, s_last = None, None
        for batch in batches:
            ok = []
            for b, va, vb in zip(batch.column("b").to_pylist(), unpack(batch.column("ta")), unpack(batch.column("tb")), strict=True):
                if b != last:
                    last, s_last = b, text_shingles(vb, n_words)
                s = text_shingles(va, n_words)
                both = len(np.intersect1d(s, s_last, assume_unique=True))
                ok.append(100 * both >= percent * (len(s) + len(s_last) - both))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


def common_counts(left: list, right: list) -> np.ndarray:
    """Sizes of the intersections of two lists of sorted distinct arrays."""
    out = np.zeros((len(left), len(right)), np.float32)
    lv, rv = np.concatenate(left), np.concatenate(right)
    shared = np.intersect1d(lv, rv)
    li, ri = np.repeat(np.arange(len(left)), [len(x) for x in left]), np.repeat(np.arange(len(right)), [len(x) for x in right])

    def cells(values, rows):
        at = np.searchsorted(shared, values)
        ok = shared[np.minimum(at, len(shared) - 1)] == values
        order = np.argsort(at[ok], kind="stable")
        return at[ok][order], rows[ok][order]

    if not len(shared):
        return out
    (la, lr), (ra, rr) = cells(lv, li), cells(rv, ri)
    for lo in range(0, len(shared), COLUMNS):
        product = []
        for at, rows, n in ((la, lr, len(left)), (ra, rr, len(right))):
            x, y = np.searchsorted(at, (lo, lo + COLUMNS))
            m = np.zeros((n, min(COLUMNS, len(shared) - lo)), np.float32)
            m[rows[x:y], at[x:y] - lo] = 1
            product.append(m)
        out += product[0] @ product[1].T
    return out


def _settle(n_words: int, percent: int):
    """Rows sorted by bucket and chunk pair in, spanning forests of the links between components out."""

    def resolve(rows):
        th, comp = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
        sets = [text_shingles(v, n_words) for v in unpack(r[2] for r in rows)]
        size = np.array([len(s) for s in sets])
        x, y = np.flatnonzero([r[3] for r in rows]), np.flatnonzero([r[4] for r in rows])
        if not len(x) or not len(y):
            return None
        both = common_counts([sets[i] for i in x], [sets[i] for i in y])
        linked = (100 * both >= percent * (size[x][:, None] + size[y][None, :] - both)) & (comp[x][:, None] != comp[y][None, :])
        a, b = np.nonzero(linked)
        root = smallest_reachable(x[a], y[b], len(rows))
        far = np.flatnonzero(root != np.arange(len(rows)))
        return pa.RecordBatch.from_arrays([pa.array(th[far]), pa.array(th[root[far]])], ["a", "b"]) if len(far) else None

    def run(batches):
        key, rows = None, []
        for batch in batches:
            for r in zip(*(batch.column(c).to_pylist() for c in ("key", "i", "j", "th", "component", "z", "is_left", "is_right")), strict=True):
                if r[:3] != key:
                    if len(rows) > 1 and (found := resolve(rows)):
                        yield found
                    key, rows = r[:3], []
                rows.append(r[3:])
        if len(rows) > 1 and (found := resolve(rows)):
            yield found

    return run


def near_duplicates(docs: DataFrame, n_words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, th, n_shingles, component_id, kept, group), a row per document.

    ``docs`` needs doc_id and text; other columns are ignored. Words are runs
    other than ASCII white space with A-Z folded; a set is the distinct shingles of ``n_words``
    words, with fewer words the whole sequence as one. Texts link when
    100 * intersection >= percent * union of their sets. ``component_id`` is the
    smallest doc_id reachable, itself included (null ids come last), and
    ``kept`` tells whether that is the row's own. Null, empty and blank texts have an empty set and link
    with nothing. Repeated rows are documents like others. ``th`` is the first 128 bits of the text's
    SHA-256. ``group`` is a number of the component, also where rows share an id or have none
    (null: an empty set).
    Empty table: no rows."""
    base = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("id"), text_hash().alias("th"), "text")
    schema = "id long, th binary, n long, s1 long, s2 long, main boolean, level int, regs binary"
    sk = cut_lineage(base.mapInArrow(_sketch(n_words, percent), schema), "sketches")
    main = sk.where("main").drop("regs", "main", "level")
    # classes of equal sets, by a 128-bit digest of the set; the smallest member stands for it. Nodes are numbers
    # fixed by the written table, so no two classes share one
    classes = main.where("n > 0").groupBy("n", "s1", "s2").agg(F.min(F.struct("id", "th")).alias("m"))
    classes = cut_lineage(classes.select("n", "s1", "s2", "m.id", "m.th", F.monotonically_increasing_id().alias("node")), "classes")
    links = _links(base, sk, classes, n_words, percent)
    if links is None:
        comp = classes.select("n", "s1", "s2", F.col("id").alias("component"), F.col("node").alias("group"))
    else:
        found = connected_components(links)
        c = classes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
        low = c.groupBy("component").agg(F.min("id").alias("low"))
        comp = c.join(low, "component").select("n", "s1", "s2", F.col("low").alias("component"), F.col("component").alias("group"))
    comp = cut_lineage(comp, "components")
    out = main.join(comp, ["n", "s1", "s2"], "left").withColumn("component", F.coalesce("component", "id"))
    null_last = lambda c: F.when(F.col(c) != LAST_ID, F.col(c))
    return out.select(null_last("id").alias("doc_id"), "th", F.col("n").alias("n_shingles"),
                      null_last("component").alias("component_id"), (F.col("id") == F.col("component")).alias("kept"), "group")


def _links(base: DataFrame, sk: DataFrame, classes: DataFrame, n_words: int, percent: int) -> DataFrame | None:
    """Confirmed links (a, b) between classes that connect all classes that candidate links connect."""
    # the small sides below grow with the corpus, so they are merged at every size and never broadcast
    named = classes.select("id", "th", "node")
    reps = sk.join(named.hint("merge"), ["id", "th"]).dropDuplicates(["node", "level"])
    reps = cut_lineage(reps.select(F.col("node").alias("th"), "n", "level", "regs"), "reps")  # th: the node from here on
    bands = reps.select("th", "level", "regs").mapInArrow(_bands, "key long, th long")
    shared = bands.groupBy("key").agg(F.min("th").alias("pivot"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c")
    members = cut_lineage(bands.join(shared.hint("merge"), "key"), "members")
    pairs = cut_lineage(members.where("th != pivot").select(F.col("pivot").alias("a"), F.col("th").alias("b")).distinct(), "pairs")
    if pairs.isEmpty():
        return None
    # the texts of all candidates, one per class
    ids = named.join(members.select(F.col("th").alias("node")).distinct(), "node", "left_semi")
    texts = base.join(ids.hint("merge"), ["id", "th"]).select(F.col("node").alias("th"), "text").mapInArrow(pack_texts, "th long, z binary")
    texts = cut_lineage(texts.dropDuplicates(["th"]), "texts")
    regs = lambda x: reps.select(F.col("th").alias(x), F.col("n").alias(f"n{x}"), "level", F.col("regs").alias(f"r{x}"))
    both = pairs.hint("merge").join(regs("a"), "a").hint("merge").join(regs("b"), ["b", "level"])
    both = both.where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    likely = both.select("a", "b", "na", "nb", "level", "ra", "rb").mapInArrow(_likely(percent), "a long, b long").distinct()
    text = lambda x: texts.select(F.col("th").alias(x), F.col("z").alias(f"t{x}"))
    full = likely.hint("merge").join(text("a"), "a").hint("merge").join(text("b"), "b").select("a", "b", "ta", "tb")
    links = cut_lineage(full.mapInArrow(_confirm(n_words, percent), "a long, b long"), "links")
    # buckets with members of different components; their pivots have met all members
    comp = connected_components(links).withColumnRenamed("node", "th")
    m = members.join(comp, "th", "left").withColumn("component", F.coalesce("component", "th"))
    sizes = m.groupBy("key", "component").agg(F.count(F.lit(1)).alias("c"))
    split = sizes.groupBy("key").agg(F.max_by("component", F.struct("c", "component")).alias("large"), F.count(F.lit(1)).alias("k"), F.sum("c").alias("c"))
    split = split.where("k > 1 and c > 2").select("key", "large")
    split = m.join(split, "key").where("th != pivot").select("key", "th", "component", (F.col("component") != F.col("large")).alias("x"))
    split = cut_lineage(split, "split")
    met = chunk_pairs(split, ["key"], "th", "x", CHUNK).join(texts.hint("merge"), "th")
    met = met.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(_settle(n_words, percent), "a long, b long")
    return links.unionByName(cut_lineage(met, "links"))


def keep_one(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The documents of ``docs`` that stay: one of each group of ``found``, the
    smallest doc_id (null last) and of rows that share it the smallest text hash. Rows
    are judged by their text: an id in several rows, or none, makes no duplicates. Texts
    with an empty set all stay. Rows alike in doc_id and text are one row of the result."""
    node = found.select(F.coalesce("doc_id", F.lit(LAST_ID)).alias("_i"), F.col("th").alias("_k"), "group")
    own = lambda c: F.when(F.col("group").isNull(), F.col(c))
    one = node.groupBy("group", own("_i").alias("i"), own("_k").alias("k")).agg(F.min(F.struct("_i", "_k")).alias("one")).select("one._i", "one._k")
    keyed = docs.withColumns({"_i": F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)), "_k": text_hash()})
    # the join reuses the partitions and order of the first step
    alike = keyed.dropDuplicates(["_i", "_k"])
    return alike.join(one.hint("merge"), ["_i", "_k"], "left_semi").select(*docs.columns)
