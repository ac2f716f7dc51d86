"""Mixing sources to target weights by weighted fair queueing.

Each document, repeated ``max_repeats`` times, is an item in its source's
shuffled queue. Its virtual finish time is the cumulative words of its source
divided by the source's target; items are taken in global order of finish time
until the total budget is spent.

Both cumulative sums are exact prefix sums in levels: sums of fixed buckets
first (a few thousand rows), rows inside a bucket second. So neither a source
that holds a third of all rows nor the global order ever lands in one task.
The global cut is a single item: every row decides by comparing with it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weekpanel.session import cut_lineage

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
BUDGET_SHARE = 1.5
MAX_REPEATS = 2
BUCKETS = 4096  # of the shuffled order and of the finish time: bounds memory, does not change the result


def source_targets(sizes: DataFrame, weights=WEIGHTS, budget_share: float = BUDGET_SHARE,
                   max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size, target, source_rank) for rows (source, size).

    Sources in code-point order, null last, get the weights in turn. A target
    is ``min(max_repeats * source_size, level * weight)`` with the one level at
    which the targets add up to the budget: a source at its bound stays there
    and the others share the excess by weight. The windows here run over one
    row per source."""
    s = sizes.groupBy("source").agg(F.sum("size").cast("double").alias("n"))
    s = s.withColumn("source_rank", F.row_number().over(W.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))) - 1)
    turn = (F.col("source_rank") % len(weights) + 1).cast("int")
    s = s.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn))
    s = s.withColumn("bound", F.col("n") * float(max_repeats)).withColumn("ratio", F.col("bound") / F.col("w"))
    by_ratio = W.orderBy("ratio", "source_rank")
    fixed = F.coalesce(F.sum("bound").over(by_ratio.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    free = F.sum("w").over(by_ratio.rowsBetween(0, W.unboundedFollowing))
    budget = F.sum("n").over(W.partitionBy()) * float(budget_share)
    s = s.withColumn("try", (budget - fixed) / free)
    s = s.withColumn("level", F.min(F.when(F.col("try") <= F.col("ratio"), F.struct("ratio", "source_rank", "try"))).over(W.partitionBy())["try"])
    target = F.when(F.col("level") * F.col("w") < F.col("bound"), F.col("level") * F.col("w")).otherwise(F.col("bound"))
    return s.select("source", F.col("n").cast("long").alias("source_size"), target.alias("target"), "source_rank")


def fair_mix(docs: DataFrame, weights=WEIGHTS, budget_share: float = BUDGET_SHARE, max_repeats: int = MAX_REPEATS,
             buckets: int = BUCKETS, keep: tuple = ()) -> DataFrame:
    """(doc_id, size, source_size, target, taken, repeats), one row per document.

    ``docs`` needs doc_id, source and text; columns named in ``keep`` pass
    through. ``taken`` counts words with repeats, at most ``max_repeats * size``;
    ``repeats`` counts the copies taken. The shuffled order is that of an md5 over
    doc_id and the text's md5 (null: of ''), so reruns agree and rows of one source without
    ids spread like others; rows alike in doc_id, source and text are interchangeable. Null or empty texts have size 0, cost nothing
    and count as taken while their finish time is before the cut. Null is a source of its own.
    An empty table gives no rows."""
    kept = F.struct(*[F.col(c) for c in keep]) if keep else F.lit(None).cast("int")
    sized = docs.select(
        F.col("doc_id"),
        F.col("source"),
        F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.concat_ws(" ", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(F.coalesce("text", F.lit("")).cast("binary"))).cast("binary")).alias("k"),
        kept.alias("kept"),
    )
    sized = cut_lineage(sized, "sizes")  # the texts are read once
    # one row per source; a written table, so Spark's own size check decides about a broadcast
    targets = cut_lineage(source_targets(sized, weights, budget_share, max_repeats).withColumnRenamed("source", "s"), "targets")
    d = sized.join(targets, sized["source"].eqNullSafe(F.col("s"))).drop("s")
    d = d.withColumn("hb", F.floor(F.conv(F.substring("k", 1, 7), 16, 10).cast("long") * buckets / 16**7).cast("int"))
    # words of the source up to each document in the shuffled order
    ahead = W.partitionBy("source_rank").orderBy("hb").rowsBetween(W.unboundedPreceding, -1)
    sums = d.groupBy("source_rank", "hb").agg(F.sum("size").alias("n"))
    sums = sums.select("source_rank", "hb", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))
    within = F.sum("size").over(W.partitionBy("source_rank", "hb").orderBy("k", "size").rowsBetween(W.unboundedPreceding, 0))
    d = d.withColumn("within", within).join(sums, ["source_rank", "hb"])
    d = d.withColumn("upto", F.col("ahead") + F.col("within")).drop("ahead", "within", "hb")
    d = cut_lineage(d, "queues")

    def item(p: int):
        words = (F.col("upto") + p * F.col("source_size")).cast("double")
        finish = F.when(F.col("target") > 0, words / F.col("target")).otherwise(F.lit(0.0))
        return F.struct(finish.alias("finish"), F.col("source_rank"), F.lit(p).alias("pass"), F.col("k"), F.col("size"))

    def place(finish, level: int):
        """Time bucket of the first or second level; the budget ends near finish 1, so 0 to 2 is split evenly."""
        x = F.least(finish * (buckets / 2), F.lit(buckets - 1.0))
        return F.floor(x).cast("long") if level == 1 else F.least(F.floor((x - F.floor(x)) * buckets), F.lit(buckets - 1)).cast("long")

    items = d.select(F.explode(F.array(*[item(p) for p in range(max_repeats)])).alias("i"))
    budget = float(budget_share) * (sized.agg(F.sum("size")).first()[0] or 0)

    def edge(rows: DataFrame, level: int, spent: int):
        """The bucket in which the budget ends (or none), and the words before it."""
        per = rows.groupBy(place(F.col("i.finish"), level).alias("t")).agg(F.sum("i.size").alias("n"))
        upto = F.sum("n").over(W.orderBy("t")) + spent  # at most `buckets` rows
        found = per.select("t", "n", upto.alias("upto")).where(F.col("upto") > budget).orderBy("t").first()
        return (found["t"], found["upto"] - found["n"]) if found else None

    result = lambda taken: d.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * taken).cast("long").alias("taken"), taken.cast("long").alias("repeats"),
        *[F.col(f"kept.{c}").alias(c) for c in keep if c != "doc_id"])
    first = edge(items, 1, 0)
    if first is None:  # all sizes are 0
        return result(F.lit(max_repeats))
    one = items.where(place(F.col("i.finish"), 1) == first[0])
    second = edge(one, 2, first[1])
    two = one.where(place(F.col("i.finish"), 2) == second[0])
    running = F.sum("i.size").over(W.orderBy("i")) + second[1]  # about one in 2 * buckets**2 / max_repeats of the items
    last = two.select("i", running.alias("upto")).where(F.col("upto") <= budget).agg(F.max("i").alias("i"))

    def is_taken(p: int):
        i = item(p)
        t1, t2 = place(i["finish"], 1), place(i["finish"], 2)
        at_edge = F.coalesce(i <= F.col("last"), F.lit(False))
        return ((t1 < first[0]) | ((t1 == first[0]) & ((t2 < second[0]) | ((t2 == second[0]) & at_edge)))).cast("int")

    d = d.crossJoin(F.broadcast(last.select(F.col("i").alias("last"))))  # a single row
    return result(sum((is_taken(p) for p in range(1, max_repeats)), is_taken(0)))


def mix_sql(docs: str = "documents") -> str:
    """The same rows in DuckDB SQL, with plain global windows."""
    return f"""
WITH sized AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '') || ' ' || md5(coalesce(text, ''))) AS k,
         CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size
  FROM {docs}),
per AS (SELECT source, CAST(sum(size) AS DOUBLE) AS n FROM sized GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS r FROM per),
weighed AS (SELECT *, CASE r % 3 WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 2.0 END::DOUBLE AS w, n * 2.0::DOUBLE AS bound FROM ranked),
tried AS (
  SELECT *, bound / w AS ratio,
    (sum(n) OVER () * 1.5::DOUBLE - coalesce(sum(bound) OVER (ORDER BY bound / w, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
    / sum(w) OVER (ORDER BY bound / w, r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS try
  FROM weighed),
lev AS (SELECT try AS level FROM tried WHERE try <= ratio ORDER BY ratio, r LIMIT 1),
targets AS (
  SELECT source, r, CAST(n AS BIGINT) AS source_size,
    CASE WHEN level * w < bound THEN level * w ELSE bound END AS target FROM tried LEFT JOIN lev ON true),
queued AS (
  SELECT d.*, t.r, t.source_size, t.target, row_number() OVER () AS rid,
    sum(size) OVER (PARTITION BY t.r ORDER BY k, size ROWS UNBOUNDED PRECEDING) AS upto
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
items AS (
  SELECT *, CASE WHEN target > 0 THEN CAST(upto + p * source_size AS DOUBLE) / target ELSE 0 END AS finish
  FROM queued, (VALUES (0), (1)) AS passes(p)),
taken AS (
  SELECT *, sum(size) OVER (ORDER BY finish, r, p, k, size ROWS UNBOUNDED PRECEDING)
            <= 1.5 * (SELECT sum(size) FROM sized) AS ok FROM items)
SELECT any_value(doc_id) AS doc_id, any_value(size) AS size, any_value(source_size) AS source_size, any_value(target) AS target,
       CAST(sum(CASE WHEN ok THEN size ELSE 0 END) AS BIGINT) AS taken,
       CAST(sum(CASE WHEN ok THEN 1 ELSE 0 END) AS BIGINT) AS repeats
FROM taken GROUP BY rid"""
