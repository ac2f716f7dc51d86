"""Line deduplication by content-defined chunks of lines.

A text is its lines (split at ``\\n``). A rolling hash over the last
``window`` line hashes chooses chunk boundaries, so an inserted or removed
line moves boundaries only near it and shared passages fall into the same
chunks wherever they stand. A line of at least ``long_words`` words always has a
boundary before and after it, so the edges of a passage of such lines do not depend on
its neighbours. A chunk of at least ``min_lines`` lines or ``long_words`` words whose
bytes occur more than once in the corpus keeps its first occurrence (smallest
doc_id, null last, then text hash, then place) and loses the others.

All steps are SQL functions. Chunks are cut once, inside a text's row, and written as
digests; only digests seen twice lead back to the texts, where the chunks' bytes are compared."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekpanel.session import cut_lineage

WINDOW = 2
DIVISOR = 3  # a boundary after about every third line
MIN_LINES = 2
LONG_WORDS = 10  # lines of so many words are chunks of their own
WORD = r"[^\x20\x09-\x0D]+"
LONG = -1  # in place of a long line's hash
MODULUS = 2147483647
FACTOR = 48271


def _line_hash(line):
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 7), 16, 10).cast("long")


def _n_words(text):
    return F.regexp_count(text, F.lit(WORD))


def chunks_of(text, window: int = WINDOW, divisor: int = DIVISOR, long_words: int | None = LONG_WORDS):
    """Column: array of struct(first, last, body) of a text's chunks, lines from 0."""
    # aggregate() binds the lines and hashes once; a plain column would be computed anew at every use
    def cut(lines):
        hashes = F.transform(lines, lambda x: F.when(_n_words(x) >= long_words, F.lit(LONG)).otherwise(_line_hash(x)) if long_words else _line_hash(x))

        def roll(h, i):
            acc = F.element_at(h, i + 1)
            for back in range(1, window):
                acc = (acc + F.coalesce(F.get(h, i - back), F.lit(0)) * F.lit(FACTOR**back % MODULUS)) % F.lit(MODULUS)
            return acc

        def ends(h):
            last = F.size(h) - 1
            is_long = lambda i: F.coalesce(F.get(h, i) == LONG, F.lit(False)) if long_words else F.lit(False)
            return F.filter(F.sequence(F.lit(0), last), lambda i: (roll(h, i) % F.lit(divisor) == 0) | (i == last) | is_long(i) | is_long(i + 1))

        def chunk(e):
            return F.transform(e, lambda x, k: F.struct(
                F.coalesce(F.get(e, k - 1) + 1, F.lit(0)).alias("first"), x.alias("last"),
                F.array_join(F.slice(lines, F.coalesce(F.get(e, k - 1) + 2, F.lit(1)), x - F.coalesce(F.get(e, k - 1), F.lit(-1))), "\n").alias("body")))

        return let(let(hashes, ends), chunk)

    return let(F.split(text, "\n", -1), cut)


def let(value, body):
    """``body(value)`` with the value computed once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def body_digest(body):
    """Column: 128 bits of a chunk's SHA-256."""
    return F.substring(F.unhex(F.sha2(body.cast("binary"), 256)), 1, 16)


def _place():
    return F.struct(F.col("inside"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("th"), F.col("first"))


def _repeated(chunks: DataFrame, *keys: str) -> DataFrame:
    """The rows of ``chunks`` whose ``keys`` stand in more than one place, with ``drop``: not the first of them."""
    groups = chunks.groupBy(*keys).agg(F.min(_place()).alias("keep"), F.max(_place()).alias("far")).where("keep != far")
    # the groups grow with the corpus: a merge join, whose hot keys adaptive execution can split
    found = chunks.join(groups.drop("far").hint("merge"), list(keys))
    return found.withColumn("drop", F.col("inside") & (_place() != F.col("keep"))).drop("keep")


def _of_texts(chunks: DataFrame) -> DataFrame:
    """One row per text with the list of its chunks (at most a text's own)."""
    rows = chunks.groupBy("doc_id", "th").agg(F.collect_set(F.struct("first", "last", "digest", "inside", "drop")).alias("_ld_chunks"))
    return rows.withColumnsRenamed({"doc_id": "_ld_id", "th": "_ld_of"})


def _with_texts(base: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    # the lists grow with the corpus: a merge join at every size, never a broadcast
    return base.join(lists.hint("merge"), base["doc_id"].eqNullSafe(F.col("_ld_id")) & (F.col("_ld_th") == F.col("_ld_of")), how)


def dedup_lines(docs: DataFrame, window: int = WINDOW, divisor: int = DIVISOR, min_lines: int = MIN_LINES,
                long_words: int | None = LONG_WORDS, digest=body_digest) -> DataFrame:
    """``docs`` with the text's repeated chunks removed, plus n_lines, n_removed (lines).

    Needs doc_id and text; other columns pass through (names starting with
    ``_ld_`` are taken). A null text stays null with 0 lines; an empty text is
    one empty line; a text that loses all lines becomes ''. Rows with the same
    doc_id and text are one document in several rows: they are treated alike
    and are no repetition of each other. Empty table: no rows.

    With ``long_words`` (None: off) a line of at least so many words is a
    chunk, and chunks of so many words count whatever their lines. A text that is one such line is a
    document, not a passage: it stays, and goes before all others as the occurrence that is kept.

    ``digest`` proposes equal chunks. Where chunks of one digest differ in their bytes, they are
    grouped by the bytes instead, so any function gives the same result."""
    base = docs.withColumns({"_ld_th": F.unhex(F.sha2(F.col("text").cast("binary"), 256))})
    lines, n_lines = F.split("text", "\n", -1), F.size(F.split("text", "\n", -1))
    # every text has a chunk; a plain explode would also filter by the array, computing it three times
    cut = F.explode_outer(chunks_of(F.col("text"), window, divisor, long_words))
    c = base.where("text is not null").select("doc_id", F.col("_ld_th").alias("th"), n_lines.alias("n_lines"), cut.alias("c"))
    n = F.col("c.last") - F.col("c.first") + 1
    c = c.where((n >= min_lines) | (_n_words(F.col("c.body")) >= long_words) if long_words else n >= min_lines)
    inside = F.col("n_lines") > 1 if long_words else F.lit(True)
    c = cut_lineage(c.select("doc_id", "th", "c.first", "c.last", inside.alias("inside"), digest(F.col("c.body")).alias("digest")), "chunks")
    found = _repeated(c, "digest")
    lists = cut_lineage(_of_texts(found), "repeats")

    # the byte comparison: chunks of one digest are equal if the least and the greatest of them are
    def with_bodies():
        return let(lines, lambda y: F.transform("_ld_chunks", lambda d: F.struct(
            d.alias("c"), F.array_join(F.slice(y, d["first"] + 1, d["last"] - d["first"] + 1), "\n").alias("body"))))

    texts = _with_texts(base, lists, "inner")
    bodies = texts.select("doc_id", F.col("_ld_th").alias("th"), F.explode_outer(with_bodies()).alias("x")).select("doc_id", "th", "x.c.*", "x.body")
    differ = bodies.groupBy("digest").agg(F.min("body").alias("low"), F.max("body").alias("high")).where("low != high").select("digest")
    differ = cut_lineage(differ, "differ")
    if not differ.isEmpty():
        exact = _repeated(bodies.drop("drop").join(differ, "digest", "left_semi"), "digest", "body").drop("body")
        lists = cut_lineage(_of_texts(found.join(differ, "digest", "left_anti").unionByName(exact, allowMissingColumns=True)), "repeats")

    drop = F.filter("_ld_chunks", lambda d: d["drop"])
    lists = lists.select("_ld_id", "_ld_of", F.flatten(F.transform(drop, lambda d: F.sequence(d["first"], d["last"]))).alias("_ld_drop"))
    out = _with_texts(base, lists.where(F.size("_ld_drop") > 0), "left")
    gone = F.col("_ld_drop").isNotNull()
    kept = let(lines, lambda x: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(x) - 1), F.col("_ld_drop")), lambda i: F.get(x, i)), "\n"))
    return out.withColumns({
        "n_lines": F.coalesce(n_lines, F.lit(0)).cast("long"),
        "n_removed": F.when(gone, F.size("_ld_drop")).otherwise(0).cast("long"),
        "text": F.when(gone, kept).otherwise(F.col("text")),
    }).drop("_ld_th", "_ld_id", "_ld_of", "_ld_drop")


def dedup_sql(docs: str = "documents") -> str:
    """doc_id, text, n_lines, n_removed in DuckDB SQL (default parameters)."""
    n_words = lambda x: f"len(regexp_extract_all({x}, '[^\\x20\\x09-\\x0D]+'))"
    return f"""
WITH base AS (SELECT doc_id, text, sha256(text) AS th FROM {docs}),
uniq AS (SELECT DISTINCT doc_id, th, text FROM base WHERE text IS NOT NULL),
lines AS (
  SELECT doc_id, th, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM uniq),
hashed AS (
  SELECT *, CASE WHEN {n_words("line")} >= {LONG_WORDS} THEN {LONG} ELSE CAST('0x' || substr(md5(line), 1, 7) AS BIGINT) END AS h FROM lines),
ends AS (
  SELECT *, h = {LONG} OR coalesce(lead(h) OVER d = {LONG}, false)
            OR ((h + coalesce(lag(h) OVER d, 0) * {FACTOR}) % {MODULUS}) % {DIVISOR} = 0 AS e FROM hashed
  WINDOW d AS (PARTITION BY doc_id, th ORDER BY i)),
numbered AS (
  SELECT *, coalesce(sum(CASE WHEN e THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, th ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c
  FROM ends),
chunks AS (
  SELECT doc_id, th, c, min(i) AS first, max(i) AS last, string_agg(line, chr(10) ORDER BY i) AS body FROM numbered GROUP BY doc_id, th, c),
sized AS (
  SELECT *, max(last) OVER (PARTITION BY doc_id, th) > 0 AS inside, last - first + 1 >= {MIN_LINES} OR {n_words("body")} >= {LONG_WORDS} AS counts FROM chunks),
marked AS (
  SELECT *, counts AND inside AND row_number() OVER (PARTITION BY body, counts ORDER BY inside, doc_id NULLS LAST, th, first) > 1 AS gone
  FROM sized),
cleaned AS (
  SELECT doc_id, th, coalesce(string_agg(body, chr(10) ORDER BY first) FILTER (NOT gone), '') AS text,
    CAST(max(last) + 1 AS BIGINT) AS n_lines, CAST(coalesce(sum(last - first + 1) FILTER (gone), 0) AS BIGINT) AS n_removed
  FROM marked GROUP BY doc_id, th)
SELECT b.doc_id, c.text, coalesce(c.n_lines, 0) AS n_lines, coalesce(c.n_removed, 0) AS n_removed
FROM base b LEFT JOIN cleaned c ON b.doc_id IS NOT DISTINCT FROM c.doc_id AND b.th = c.th"""
