"""Text folding: trim -> upper -> compatibility decomposition (NFKD) -> drop
combining marks -> collapse whitespace runs to one space.

All steps are deterministic built-in expressions. What becomes of a code point
(its decomposition without characters of combining class != 0) is worked out
from the Unicode database at import time. One ``translate`` folds the code
points that become one character or none; the few that become several
(ligatures, fractions, syllables) are spelled out character by character, in
texts that hold one.
"""

from __future__ import annotations

import functools
import sys
import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _ranges(cps: list[int]) -> str:
    out, start, prev = [], None, None
    for cp in cps:
        if start is None:
            start = prev = cp
        elif cp == prev + 1:
            prev = cp
        else:
            out.append((start, prev))
            start = prev = cp
    if start is not None:
        out.append((start, prev))
    return "".join(f"\\x{{{a:X}}}" if a == b else f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in out)


@functools.lru_cache(maxsize=1)
def folded_code_points() -> dict[str, str]:
    """Every code point that folding changes, with what becomes of it."""
    out = {}
    for cp in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= cp < 0xE000:
            continue
        ch = chr(cp)
        to = "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c))
        if to != ch:
            out[ch] = to
    return out


@functools.lru_cache(maxsize=1)
def _tables():
    """(from, to) of the single ones (``to`` ends before the code points that go), and (from, [first, second, ... characters]) of the others."""
    folded = folded_code_points()
    single = sorted((c for c, to in folded.items() if len(to) <= 1), key=lambda c: (not folded[c], c))
    several = sorted((c for c, to in folded.items() if len(to) > 1), key=lambda c: (-len(folded[c]), c))
    deep = max(len(folded[c]) for c in several)
    places = ["".join(folded[c][i] for c in several if len(folded[c]) > i) for i in range(deep)]
    return ("".join(single), "".join(folded[c] for c in single)), ("".join(several), places)


@functools.lru_cache(maxsize=1)
def _several_class() -> str:
    return "[" + _ranges(sorted(ord(c) for c in _tables()[1][0])) + "]"


def _fold(c: Column) -> Column:
    """``c`` decomposed (NFKD) and without marks."""
    (single, to), (several, places) = _tables()

    def spelled(ch: Column) -> Column:
        # longer spellings stand first, so a shorter one loses its later places to ``translate``
        parts = [F.translate(ch, several, p) for p in places]
        return F.when(F.translate(ch, several, "") == "", F.concat(*parts)).otherwise(ch)

    chars = F.regexp_extract_all(c, F.lit("(?s)(.)"), F.lit(1))
    whole = F.when(c.rlike(_several_class()), F.array_join(F.transform(chars, spelled), "")).otherwise(c)
    return F.translate(whole, single, to)


@functools.lru_cache(maxsize=1)
def whitespace_chars() -> str:
    """Every code point Python's ``str.strip`` / ``\\s`` treat as whitespace."""
    return "".join(chr(cp) for cp in range(sys.maxunicode + 1) if chr(cp).isspace())


def _ws_class() -> str:
    return "[" + "".join(f"\\x{{{ord(ch):X}}}" for ch in whitespace_chars()) + "]+"


def strip_ws(c: Column | str) -> Column:
    """Trim Unicode whitespace at both ends (no regex)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.btrim(c, F.lit(whitespace_chars()))


def normalize_text(c: Column | str) -> Column:
    """Upper-case, accent-free, single-spaced text. NULL stays NULL.

    Pure-ASCII values (the common case for names and labels) skip the
    decomposition: NFKD is the identity on ASCII and there are no marks."""
    up = F.upper(strip_ws(c))
    folded = F.when(up.rlike(r"[^\x00-\x7F]"), _fold(up)).otherwise(up)
    return F.regexp_replace(folded, _ws_class(), " ")


def normalize_header(df: DataFrame) -> DataFrame:
    """Strip and lower-case every column name."""
    return df.toDF(*[c.strip().lower() for c in df.columns])
