"""Byte-level BPE: texts to token ids and back, by the merges of a public tokenizer file.

A text is cut into its special tokens and the words of the file's fixed
pattern. A short word is a contiguous row of symbols (its part boundaries) with
the ranks of all adjacent pairs beside it: scan the row for the least rank,
delete that boundary, and look up the ranks of the two neighbours again, until
no pair of the row can be merged. The distinct words of a batch are rows of one
matrix, so every step handles all of them. A word too long for a row keeps
its pairs in a heap with linked neighbours, which gives the same merges in
n log n. Known words are remembered up to a bound; ids do not depend on it."""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from functools import lru_cache
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
# fixed value: the public pattern of words that byte-level tokenizers of this family cut texts into
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# fixed value: the bytes that stand for themselves in the file; the others follow from U+0100 on
PLAIN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]

WIDTHS = (4, 8, 16, 32, 64)  # bytes of a row; longer words go to the heap
NONE = np.iinfo(np.int32).max
CHUNK_WORDS = 1 << 17  # words handled at once
LONG_TEXT = 1 << 20  # characters from which words are not listed at once
REMEMBER = 1 << 18  # words kept between chunks
SEND_TOKENS = 1 << 20  # bytes of text after which a batch is sent on


class Bpe:
    """One tokenizer file; others than plain byte-level BPE are refused."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, cut = file["model"], file["pre_tokenizer"] or {}
        plain = model["type"] == "BPE" and cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
        plain = plain and not (file["normalizer"] or model.get("ignore_merges") or model.get("dropout") or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix"))
        if not plain or any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in file["added_tokens"]):
            raise ValueError(f"{path} is not a plain byte-level BPE tokenizer")
        shown = {b: chr(b) for b in PLAIN}
        shown |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in shown)}
        self.byte_of = {c: b for b, c in shown.items()}
        ids = model["vocab"]
        self.size = max([*ids.values(), *(t["id"] for t in file["added_tokens"])]) + 1
        self.symbol = np.array([ids[shown[b]] for b in range(256)], np.int32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self._keep(np.array([ids[a] * self.size + ids[b] for a, b in pairs], np.int64))
        self.merged = np.array([ids[a + b] for a, b in pairs], np.int32)
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.bytes = [b""] * self.size
        for token, i in ids.items():
            self.bytes[i] = bytes(self.byte_of[c] for c in token)
        for token, i in self.special.items():
            self.bytes[i] = token.encode()
        self.flat_bytes = np.frombuffer(b"".join(self.bytes), np.uint8)
        self.byte_ends = np.cumsum([len(b) for b in self.bytes])
        self.words = regex.compile(PATTERN)
        longest_first = sorted(self.special, key=len, reverse=True)
        self.at_special = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if self.special else None
        self.path = path
        self.forget()

    # ---- words of a text
    def pieces(self, text: str):
        """Lists of the words of ``text``; a special token comes as the tuple of its id."""
        if self.at_special and self.at_special.search(text):
            for i, part in enumerate(self.at_special.split(text)):
                if i % 2:
                    yield [(self.special[part],)]
                elif part:
                    yield from self._cut(part)
        else:
            yield from self._cut(text)

    def _cut(self, text: str):
        if not text.isascii() and is_newer(text):
            # the pattern library may have newer Unicode tables: the file's own library decides what is a letter
            yield [text[a:b] for _, (a, b) in self._cutter().pre_tokenize_str(text)]
            return
        words = self.words if _BEYOND_LATIN.search(text) else latin_words()
        if len(text) < LONG_TEXT:
            yield words.findall(text)
        else:
            found = (m[0] for m in words.finditer(text))
            while part := list(islice(found, CHUNK_WORDS)):
                yield part

    @lru_cache(maxsize=1)  # noqa: B019  (one instance per file and worker)
    def _cutter(self):
        from tokenizers import pre_tokenizers

        return pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)

    # ---- merges
    def _keep(self, keys: np.ndarray):
        """An open hash table from pairs (left * size + right) to their ranks."""
        self.slots = 1 << max(4, int(4 * len(keys)).bit_length())
        self.key, self.key_rank = np.full(self.slots, -1, np.int64), np.full(self.slots, NONE, np.int32)
        at, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = left[self.key[at[left]] < 0]
            self.key[at[free]] = keys[free]  # of those that want one slot the last one gets it
            won = free[self.key[at[free]] == keys[free]]
            self.key_rank[at[won]] = won
            left = np.setdiff1d(left, won)
            at[left] = (at[left] + 1) & (self.slots - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(65 - self.slots.bit_length())).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of symbols, NONE where they do not merge or one is missing (-1)."""
        keys = left.astype(np.int64) * self.size + right
        keys[(left < 0) | (right < 0)] = -2
        at = self._slot(keys)
        found = self.key[at]
        out = np.where(found == keys, self.key_rank[at], NONE)
        on = np.flatnonzero((found != keys) & (found >= 0))
        while len(on):
            at[on] = (at[on] + 1) & (self.slots - 1)
            found = self.key[at[on]]
            hit = found == keys[on]
            out[on[hit]] = self.key_rank[at[on[hit]]]
            on = on[~hit & (found >= 0)]
        return out

    @lru_cache(maxsize=1)  # noqa: B019
    def _byte_ranks(self) -> np.ndarray:
        left, right = np.divmod(np.arange(1 << 16), 256)
        return self.rank(self.symbol[left], self.symbol[right])

    def merge_rows(self, words: list[bytes], width: int):
        """(order, lengths, symbols): words of at most ``width`` bytes each in the order in which they are done."""
        lengths = np.array([len(w) for w in words])
        inside = np.arange(width) < lengths[:, None]
        raw = np.zeros((len(words), width + 1), np.uint8)
        raw[:, :width][inside] = np.frombuffer(b"".join(words), np.uint8)
        symbols = np.full((len(words), width + 1), -1, np.int32)
        symbols[:, :width][inside] = self.symbol[raw[:, :width][inside]]
        ranks = np.full((len(words), width + 1), NONE, np.int32)
        pair = inside[:, 1:]
        ranks[:, : width - 1][pair] = self._byte_ranks()[raw[:, : width - 1][pair].astype(np.int64) * 256 + raw[:, 1:width][pair]]
        row, columns, done = np.arange(len(words)), np.arange(width), []
        while len(row):
            j = ranks.argmin(1)
            least = ranks[np.arange(len(row)), j]
            on = least < NONE
            if not on.all():
                rest = symbols[~on]
                done.append((row[~on], (rest >= 0).sum(1), rest[rest >= 0]))
                row, symbols, ranks, j, least = row[on], symbols[on], ranks[on], j[on], least[on]
            at = np.arange(len(row))
            symbols[at, j] = self.merged[least]
            # the boundary behind j goes: all that follows moves up by one
            behind = columns > j[:, None]
            symbols[:, :-1] = np.where(behind, symbols[:, 1:], symbols[:, :-1])
            ranks[:, :-1] = np.where(behind, ranks[:, 1:], ranks[:, :-1])
            symbols[:, -1], ranks[:, -1] = -1, NONE
            ranks[at, j] = self.rank(symbols[at, j], symbols[at, j + 1])
            before = np.flatnonzero(j > 0)
            k = j[before]
            ranks[before, k - 1] = self.rank(symbols[before, k - 1], symbols[before, k])
        order, counts, flat = zip(*done, strict=True)
        return np.concatenate(order), np.concatenate(counts), np.concatenate(flat)

    def merge_long(self, word: bytes) -> np.ndarray:
        """Symbols of one long word: least rank first, leftmost on ties, from a heap."""
        symbols = self.symbol[np.frombuffer(word, np.uint8)]
        first = self.rank(symbols[:-1], symbols[1:])
        heap = [(int(first[i]), i, int(symbols[i]), int(symbols[i + 1])) for i in np.flatnonzero(first < NONE)]
        heapq.heapify(heap)
        at = symbols.tolist()
        after, before = list(range(1, len(at) + 1)), list(range(-1, len(at) - 1))
        after[-1] = -1
        known = self._pairs()
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if at[i] != left or j < 0 or at[j] != right:
                continue  # one of the two has been merged since
            at[i], at[j] = int(self.merged[rank]), -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (r := known.get((at[a], at[b]))) is not None:
                    heapq.heappush(heap, (r, a, at[a], at[b]))
        return np.array([s for s in at if s >= 0], np.int64)

    @lru_cache(maxsize=1)  # noqa: B019
    def _pairs(self) -> dict:
        some = self.key >= 0
        return {divmod(k, self.size): r for k, r in zip(self.key[some].tolist(), self.key_rank[some].tolist(), strict=True)}

    def merge(self, words: list[bytes]):
        """(order, lengths, symbols): the words' places in some order, and their symbols in that order."""
        kind = np.searchsorted(WIDTHS, np.fromiter(map(len, words), np.int64, len(words)))
        out = []
        for c, width in enumerate(WIDTHS):
            own = np.flatnonzero(kind == c)
            if len(own):
                order, counts, flat = self.merge_rows([words[i] for i in own], width)
                out.append((own[order], counts, flat))
        for i in np.flatnonzero(kind == len(WIDTHS)):
            flat = self.merge_long(words[i])
            out.append(([i], [len(flat)], flat))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    # ---- texts
    def forget(self):
        self.place: dict = {}  # word -> its number; the tokens of number k are flat[start[k]:start[k + 1]]
        self.flat, self.start = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def learn(self, words: set):
        """Tokens of words not known yet."""
        known = len(self.place)
        special = [w for w in words if isinstance(w, tuple)]
        plain = [w for w in words if not isinstance(w, tuple)] if special else list(words)
        counts, flat = [], []
        if plain:
            order, n, symbols = self.merge([w.encode() for w in plain])
            plain = [plain[i] for i in order.tolist()]
            counts, flat = [n], [symbols]
        self.place.update(zip(plain + special, range(known, known + len(words)), strict=True))
        counts = np.concatenate([*counts, np.ones(len(special), np.int64)])
        self.start = np.concatenate((self.start, self.start[-1] + np.cumsum(counts)))
        self.flat = np.concatenate((self.flat, *flat, np.array([w[0] for w in special], np.int32))).astype(np.int32)

    def encode(self, texts: list):
        """Token ids of the texts one behind the other, and how many each has (null: none)."""
        counts, parts, words, owner, held = np.zeros(len(texts), np.int64), [], [], [], []
        for i, text in enumerate(texts):
            for piece in self.pieces(text) if text else ():
                words += piece
                owner.append(i)
                held.append(len(piece))
                if len(words) >= CHUNK_WORDS:
                    parts.append(self._tokens(words, owner, held, counts))
                    words, owner, held = [], [], []
        if words:
            parts.append(self._tokens(words, owner, held, counts))
        return np.concatenate(parts) if parts else np.zeros(0, np.int32), counts

    def _tokens(self, words: list, owner: list, held: list, counts: np.ndarray) -> np.ndarray:
        if len(self.place) > REMEMBER or len(self.flat) > 8 * REMEMBER:
            self.forget()
        k = np.fromiter(map(self.place.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(k < 0)
        if len(new):
            missing = [words[i] for i in new.tolist()]
            self.learn(set(missing))
            k[new] = np.fromiter(map(self.place.__getitem__, missing), np.int64, len(missing))
        start, n = self.start[k], self.start[k + 1] - self.start[k]
        counts += np.bincount(np.repeat(owner, held), n, len(counts)).astype(np.int64)
        return self.flat[_spread(start, n)]

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of token ids; ids out of the vocabulary give none."""
        parts = []
        for lo in range(0, len(ids), CHUNK_WORDS):
            some = ids[lo : lo + CHUNK_WORDS]
            some = some[(some >= 0) & (some < self.size)]
            ends = self.byte_ends[some]
            n = ends - np.where(some > 0, self.byte_ends[some - 1], 0)
            parts.append(self.flat_bytes[_spread(ends - n, n)].tobytes())
        return b"".join(parts)


def _spread(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start[0], ..., start[0] + n[0] - 1, start[1], ... as one array of places."""
    ends = np.cumsum(n)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - ends + n, n)


@lru_cache(maxsize=2)
def bpe(path: str) -> Bpe:
    return Bpe(path)


_MAY_BE_NEWER = re.compile("[\u0378-\U0010ffff]")  # U+0378 is the first code point without a character


_BEYOND_LATIN = re.compile("[^\x00-\u024f]")


@lru_cache(maxsize=1)
def latin_words():
    """The same pattern for texts up to U+024F, whose letters and digits are settled: the plain pattern library is faster."""
    kinds = {k: "".join(c for c in map(chr, range(0x250)) if unicodedata.category(c)[0] == k) for k in "LN"}
    letter, digit, space = kinds["L"], kinds["N"], "\t-\r \x85\xa0"
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{digit}]+| ?[^{space}{letter}{digit}]+|[{space}]+(?![^{space}])|[{space}]+")


def is_newer(text: str) -> bool:
    """Whether ``text`` holds a code point that Python's Unicode tables do not know."""
    return bool(_MAY_BE_NEWER.search(text)) and any(unicodedata.category(c) == "Cn" for c in set(text))


def _encode(path: str, column: str, out: str):
    def run(batches):
        codec = bpe(path)
        for batch in batches:
            texts = batch.column(column)
            sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
            cut = np.flatnonzero(np.diff(sizes // SEND_TOKENS, prepend=0)).tolist()  # no text has more tokens than bytes
            for lo, hi in zip([0, *cut], [*cut, batch.num_rows], strict=True):
                if lo < hi:
                    ids, counts = codec.encode(texts.slice(lo, hi - lo).to_pylist())
                    lists = pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum(counts))).astype(np.int32), pa.array(ids, pa.int32()))
                    part = batch.slice(lo, hi - lo)
                    yield pa.RecordBatch.from_arrays([*part.columns, lists], [*part.schema.names, out])

    return run


def _decode(path: str, column: str, out: str):
    def run(batches):
        codec = bpe(path)
        for batch in batches:
            done, texts, size = 0, [], 0
            for i, ids in enumerate(batch.column(column)):
                texts.append(codec.decode(ids.values.to_numpy(zero_copy_only=False)).decode("utf-8", "replace") if ids.is_valid else None)
                size += len(texts[-1] or "")
                if size >= SEND_TOKENS or i + 1 == batch.num_rows:
                    part = batch.slice(done, len(texts))
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*part.schema.names, out])
                    done, texts, size = i + 1, [], 0

    return run


def _with(df: DataFrame, name: str, kind) -> StructType:
    return StructType([*df.schema.fields, StructField(name, kind)])


def encode_texts(docs: DataFrame, vocabulary: str = VOCABULARY, column: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with the token ids of ``column`` as array ``out``.

    Special tokens of the file are recognised wherever their strings stand. Null and empty texts have
    no tokens (an empty array); repeated rows are encoded each; all other columns stay, but a column
    named ``out`` is replaced. Empty table: no rows. Works row by row without a shuffle. ``vocabulary``
    must be readable at the same path on every executor."""
    docs = docs.drop(out)
    return docs.mapInArrow(_encode(vocabulary, column, out), _with(docs, out, ArrayType(IntegerType())))


def decode_ids(encoded: DataFrame, vocabulary: str = VOCABULARY, column: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` with the text of the ids of ``column`` as ``out``; special tokens show their strings,
    null ids give null, an empty array an empty text. A column named ``out`` is replaced."""
    encoded = encoded.drop(out)
    return encoded.mapInArrow(_decode(vocabulary, column, out), _with(encoded, out, StringType()))


def ids_digest(ids) -> Column:
    """Hex SHA-256 of decimal ids joined by commas."""
    return F.sha2(F.array_join(F.col(ids).cast("array<string>"), ",").cast("binary"), 256)
