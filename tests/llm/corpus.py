"""Small corpora with the awkward rows that every operator has to stand."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
EXTRA = "id long, th long, n long, size long, label int, k string, leaks string, component long, name string, s int"


def words(rng: random.Random, n: int, vocabulary: int = 400) -> list[str]:
    return ["".join(rng.choice("bdfgklmnprst") + rng.choice("aeiouüé") for _ in range(1 + rng.randrange(3))) + str(rng.randrange(vocabulary) % 7 or "") for _ in range(n)]


def documents(seed: int = 3, n: int = 60) -> list[tuple]:
    """(doc_id, text, lang, source, n_chars): near copies, exact copies, shared
    passages and lines, repeated rows, nulls, empties, blanks and one very long text."""
    rng = random.Random(seed)
    texts = []
    base = words(rng, 120)
    passage = " ".join(words(rng, 110))
    for i in range(n):
        kind = i % 6
        if kind == 0:  # near copies of one text
            w = list(base)
            w[rng.randrange(len(w))] = f"edit{i}"
            texts.append(" ".join(w))
        elif kind == 1:
            texts.append(f"{' '.join(words(rng, 30))}\n{passage}\n{' '.join(words(rng, 20))}")
        elif kind == 2 and texts:
            texts.append(rng.choice(texts))
        elif kind == 3:
            lines = [" ".join(words(rng, 6)) for _ in range(5)]
            shared = [f"shared line {j} of the same notice" for j in range(8)]
            at = rng.randrange(5)
            texts.append("\n".join(lines[:at] + shared + lines[at:]))
        else:
            texts.append(" ".join(words(rng, rng.randrange(1, 80))))
    texts += [None, "", "  \n\t ", "one", "One two", "ha " * 500, " ".join(words(rng, 30_000))]
    rows = [(i, t, "en", f"src{i % 5}" if i % 7 else None, len(t) if t is not None else None) for i, t in enumerate(texts)]
    return rows + [rows[0], rows[3], (None, texts[1], None, "src0", 1), (None, None, None, None, None), (5, texts[6], "de", "src1", 2)]


def frame(spark, rows: list[tuple], extra: bool = False):
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:
        from pyspark.sql import functions as F

        df = df.select("*", *[F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in EXTRA.split(", ")])
    return df


def as_bytes(text) -> bytes:
    return (text or "").encode()
