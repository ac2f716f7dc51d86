"""Vectorised word and substring hashing on UTF-8 bytes (numpy, inside tasks).

A byte string hashes to ``mix(sum(T[b_i] * P**i))`` modulo 2**64 with an odd
``P`` and a fixed random table ``T``. Prefix sums give the hash of any word or
substring in constant time, and multiplying with the inverse power makes it
independent of its place. Texts are handled in pieces, so memory does not
grow with the longest text beyond its own bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_GOLD = 0x9E3779B97F4A7C15
_P = 0xD6E8FEB86659FD93
_P_INV = pow(_P, -1, 1 << 64)
PIECE = 1 << 20  # bytes handled at once

#: words are runs of bytes other than the six ASCII white-space bytes
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32  # A-Z only

#: words without ASCII punctuation: every ASCII byte that is no letter or digit separates
NO_LETTER = np.zeros(256, bool)
NO_LETTER[:128] = [not chr(i).isalnum() for i in range(128)]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (in place when given a temporary)."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


TABLE = mix(np.arange(1, 257, dtype=U) * U(_GOLD))


class _Powers:
    """Powers of P and of its inverse, grown as needed."""

    def __init__(self):
        self.n = 0

    def get(self, n: int):
        if n > self.n:
            n = max(n, 1 << 16)
            for name, base in (("p", _P), ("q", _P_INV)):
                a = np.full(n, base, U)
                a[0] = 1
                setattr(self, name, np.multiply.accumulate(a))
            self.n = n
        return self.p, self.q


POWERS = _Powers()


def prefix_sums(b: np.ndarray) -> np.ndarray:
    """C with ``C[j] - C[i]`` the weighted sum of bytes i..j-1."""
    p, _ = POWERS.get(len(b) + 1)
    c = np.empty(len(b) + 1, U)
    c[0] = 0
    np.cumsum(TABLE[b] * p[: len(b)], out=c[1:])
    return c


def substring_hashes(c: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, q = POWERS.get(len(c))
    return mix((c[ends] - c[starts]) * q[starts] + (ends - starts).astype(U) * U(_GOLD))


def text_views(column: pa.Array) -> list:
    """uint8 views of the strings of an Arrow column, null as empty."""
    column = pc.fill_null(column, "" if not pa.types.is_binary(column.type) else b"")
    column = column.cast(pa.large_binary())
    n = len(column)
    _, offsets, data = column.buffers()
    o = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    d = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return [d[o[i] : o[i + 1]] for i in range(n)]


def pack_texts(batches):
    """mapInArrow function: the column text as z, compressed UTF-8, to halve what is shuffled."""
    import zstandard

    c = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        at = batch.schema.get_field_index("text")
        packed = pa.array([c.compress(v.tobytes()) for v in text_views(batch.column("text"))], pa.binary())
        yield pa.RecordBatch.from_arrays([*batch.columns[:at], packed, *batch.columns[at + 1 :]], [*batch.schema.names[:at], "z", *batch.schema.names[at + 1 :]])


def unpack(packed):
    """uint8 views of texts that ``pack_texts`` has packed."""
    import zstandard

    d = zstandard.ZstdDecompressor()
    return (np.frombuffer(d.decompress(x if isinstance(x, bytes) else x.as_py()), np.uint8) for x in packed)


def _cuts(b: np.ndarray, separator: np.ndarray):
    """(lo, hi) pieces of about PIECE bytes that end at a separator."""
    lo = 0
    while lo < len(b):
        hi = min(len(b), lo + PIECE)
        while hi < len(b):
            step = np.flatnonzero(separator[b[hi : hi + PIECE]])
            if len(step):
                hi += int(step[0])
                break
            hi = min(len(b), hi + PIECE)
        yield lo, hi
        lo = hi


def word_spans(b: np.ndarray, separator: np.ndarray = SPACE):
    """Starts and ends (byte offsets) of the words of ``b``."""
    inside = ~separator[b]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(b) and inside[0]:
        edge = np.concatenate(([0], edge))
    if len(b) and inside[-1]:
        edge = np.concatenate((edge, [len(b)]))
    return edge[0::2], edge[1::2]


def word_and_stem_hashes(b: np.ndarray, separator: np.ndarray, stems: tuple):
    """Hashes of the words, and of the first ``k`` bytes of longer words for each ``k`` of ``stems``."""
    hs, ts = [], [[] for _ in stems]
    for lo, hi in _cuts(b, separator):
        piece = FOLD[b[lo:hi]]
        s, e = word_spans(piece, separator)
        c = prefix_sums(piece)
        hs.append(substring_hashes(c, s, e))
        for k, t in zip(stems, ts, strict=True):
            long = s[e - s > k]
            t.append(substring_hashes(c, long, long + k))
    return [np.concatenate(x) if x else np.zeros(0, U) for x in (hs, *ts)]


def word_hashes(b: np.ndarray, separator: np.ndarray = SPACE, spans: bool = False):
    """64-bit hashes of the words, A-Z folded; with ``spans`` also starts, ends."""
    hs, ss, es = [], [], []
    for lo, hi in _cuts(b, separator):
        piece = FOLD[b[lo:hi]]
        s, e = word_spans(piece, separator)
        hs.append(substring_hashes(prefix_sums(piece), s, e))
        if spans:
            ss.append(s + lo)
            es.append(e + lo)
    cat = lambda x, t: np.concatenate(x) if x else np.zeros(0, t)
    return (cat(hs, U), cat(ss, np.int64), cat(es, np.int64)) if spans else cat(hs, U)


_WORD_FACTORS = mix(np.arange(1001, 1017, dtype=U))  # one odd factor for each place in a shingle
_WORD_FACTORS |= U(1)


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words, in order. Fewer words: one hash of
    the whole sequence; no words: none."""
    if not len(words):
        return words
    k = min(n, len(words))
    acc = words[: len(words) - k + 1] * _WORD_FACTORS[0]
    for i in range(1, k):
        acc = acc + words[i : len(words) - k + 1 + i] * _WORD_FACTORS[i]
    return mix(acc + U(k))
