"""Seeds and banded local alignment of word sequences (small numpy helpers inside tasks)."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

MATCH, MISS, GAP = 2, -1, -1


@dataclass(frozen=True)
class Alignment:
    matched: int  # equal words
    columns: int  # alignment columns, gaps included
    a_start: int
    a_end: int
    b_start: int
    b_end: int

    def coverage(self, m: int) -> float:
        """Matched share of a pattern of m words."""
        return self.matched / m

    def similarity(self, m: int) -> float:
        """Matched share of the columns when the whole pattern is aligned."""
        return self.matched / (self.columns + m - (self.a_end - self.a_start))


def clusters(diagonals: np.ndarray, m: int):
    """Groups of sorted diagonals that one alignment of a pattern of m words can join: (middle, half width)."""
    d = np.unique(diagonals)
    reach = max(4, m // 4)
    first = 0
    for k in range(1, len(d) + 1):
        if k == len(d) or d[k] - d[k - 1] > reach or d[k] - d[first] > m:
            yield int(d[first] + d[k - 1]) // 2, int(d[k - 1] - d[first] + 1) // 2 + reach
            first = k


def align(a: np.ndarray, b: np.ndarray, diagonal: int, band: int) -> Alignment | None:
    """Best Smith-Waterman alignment of pattern ``a`` with ``b`` within
    ``band`` of the diagonal (place in b minus place in a). Time and memory are
    len(a) * (2 * band + 1), whatever the length of b."""
    m, width = len(a), 2 * band + 1
    if 0 <= diagonal <= len(b) - m and np.array_equal(b[diagonal : diagonal + m], a):
        return Alignment(m, m, 0, m, diagonal, diagonal + m)
    k = np.arange(width)
    j = np.arange(m)[:, None] + diagonal - band + k[None, :]
    inside = (j >= 0) & (j < len(b))
    if not inside.any():
        return None
    step = np.where(inside & (b[np.clip(j, 0, len(b) - 1)] == a[:, None]), MATCH, MISS)
    h = np.zeros((m + 1, width + 1), np.int32)  # a last column of 0 for the cell above the band's edge
    for i in range(m):
        row = np.maximum(np.maximum(h[i, :width] + step[i], h[i, 1:] + GAP), 0)
        row = np.maximum.accumulate(row - GAP * k) + GAP * k
        row[~inside[i]] = 0
        h[i + 1, :width] = row
    i, x = divmod(int(h.argmax()), width + 1)
    if not h[i, x]:
        return None
    a_end, b_end = i, int(j[i - 1, x]) + 1
    matched = columns = 0
    while i > 0 and h[i, x] > 0:
        columns += 1
        if h[i, x] == h[i - 1, x] + step[i - 1, x]:
            matched += step[i - 1, x] == MATCH
            i -= 1
        elif h[i, x] == h[i - 1, x + 1] + GAP:
            i, x = i - 1, x + 1
        else:
            x -= 1
    # the cell reached is just before the alignment
    return Alignment(int(matched), columns, i, a_end, i + diagonal - band + x, b_end)
