"""URL filtering: explicit host/path rules, and association rules mined by FP-growth.

A url that an explicit rule fits takes the longest rule's verdict. The others
are judged by mined rules: the labelled urls' tokens (host suffixes, host
labels, path words, query keys) and their label go through Spark's FP-growth,
and rules "tokens => label" above a support and a confidence, not implied by a
shorter rule at least as sure, are kept, however many tokens they need. Tokens that
stand in the same labelled urls (the suffixes of one deep host, the words of one
path) are mined as one and stand for each other in the rules. Urls with the same rule tokens are
judged once: an inverted index (each rule under one of its tokens) picks the
rules to test on each distinct token set."""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekpanel.session import cut_lineage

RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
MIN_SUPPORT = 0.01
MIN_CONFIDENCE = 0.8
DEFAULT = "allow"
MARK = "label="


def split_url(url):
    """(host, path) columns; both '' for null or without ``://``. Only A-Z are lower-cased."""
    at = F.locate("://", url)
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    whole = r"(?s)^([^/?#]*)([^?#]*).*$"
    host = F.translate(F.regexp_extract(rest, whole, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, whole, 2)


def longest_rule(host, path, rules=RULES):
    """Struct (verdict, rule) of the longest rule that fits, else null."""
    out = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        h, _, p = rule.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith("/" + p)
        out = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(out)
    return out


def url_tokens(host, path, url):
    """Distinct sorted tokens; path words with digits are left out (they name single pages)."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    suffixes = F.transform(F.sequence(F.lit(1), n), lambda k: F.concat(F.lit("host:"), F.array_join(F.slice(labels, n - k + 1, k), ".")))
    first = F.when(n > 2, F.array(F.concat(F.lit("sub:"), labels[0]))).otherwise(F.array().cast("array<string>"))
    words = F.filter(F.split(F.lower(path), r"[/._\-]+"), lambda w: (w != "") & ~w.rlike(r"\d"))
    asked = F.filter(F.split(F.regexp_extract(url, r"\?([^#]*)", 1), "&"), lambda x: x != "")
    keys = F.transform(asked, lambda x: F.concat(F.lit("key:"), F.substring_index(x, "=", 1)))
    return F.array_sort(F.array_distinct(F.concat(
        F.filter(suffixes, lambda s: s != "host:"), first, F.transform(words, lambda w: F.concat(F.lit("path:"), w)), keys)))


def twin_tokens(sets: DataFrame, least) -> DataFrame:
    """(token, twin) for the tokens of rows (tokens, n) that stand in at least ``least`` rows: ``twin`` is the smallest
    token that stands in just the same rows (known by their number and two sums of 64-bit hashes)."""
    hashed = lambda salt: F.sum(F.xxhash64(F.lit(salt), "tokens").cast("decimal(20,0)"))
    t = sets.select("tokens", "n", F.explode("tokens").alias("token"))
    t = t.groupBy("token").agg(F.sum("n").alias("c"), hashed(1).alias("a"), hashed(2).alias("b")).where(F.col("c") >= least)
    twins = t.groupBy("c", "a", "b").agg(F.min("token").alias("twin"))
    return t.join(twins, ["c", "a", "b"]).select("token", "twin")


def mine_rules(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(tokens, label, confidence, support) from rows (tokens array, label).

    Rules are bounded in number by the support, not by the rows. A rule is
    dropped when a subset of its tokens gives the same label with at least its
    confidence; so no rule holds two tokens that stand in the same rows, and FP-growth sees one of them
    (else k such tokens would be 2^k frequent sets). No labelled rows: no rules."""
    sets = cut_lineage(labelled.groupBy("tokens", "label").agg(F.count(F.lit(1)).alias("n")), "labelled")
    rows = sets.agg(F.sum("n")).first()[0] or 0
    twins = cut_lineage(twin_tokens(sets, math.ceil(min_support * rows)), "twins")
    mined = F.broadcast(twins.agg(F.array_sort(F.collect_set("twin")).alias("mined")))  # one row, bounded by the support
    items = labelled.crossJoin(mined).select(F.concat(F.array_intersect("tokens", "mined"), F.array(F.concat(F.lit(MARK), "label"))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(items)
    rules = model.associationRules.where(F.col("consequent")[0].startswith(MARK)).select(
        F.monotonically_increasing_id().alias("rule"), "antecedent", F.expr(f"substring(consequent[0], {len(MARK) + 1})").alias("label"),
        F.round("confidence", 9).alias("confidence"), F.round("support", 9).alias("support"))
    rules = cut_lineage(rules, "mined")
    # every twin in place of the token that was mined for it
    classes = twins.groupBy("twin").agg(F.array_sort(F.collect_set("token")).alias("class"))
    full = rules.select("*", F.posexplode("antecedent").alias("at", "twin")).join(classes, "twin")
    full = full.groupBy("rule", "label", "confidence", "support").agg(F.array_sort(F.collect_list(F.struct("at", "class"))).alias("classes"))
    one_of_each = F.aggregate(
        "classes", F.array(F.array().cast("array<string>")),
        lambda made, c: F.flatten(F.transform(made, lambda m: F.transform(c["class"], lambda x: F.concat(m, F.array(x))))))
    rules = full.select(F.explode(one_of_each).alias("tokens"), "label", "confidence", "support").withColumn("tokens", F.array_sort("tokens"))
    rules = cut_lineage(rules, "rules")
    wide = rules.alias("r")
    short = rules.select(F.col("tokens").alias("s_tokens"), F.col("label").alias("s_label"), F.col("confidence").alias("s_conf"))
    inside = (F.size("s_tokens") < F.size("tokens")) & (F.size(F.array_except("s_tokens", "tokens")) == 0)
    sure = (F.col("s_label") == F.col("label")) & (F.col("s_conf") >= F.col("confidence"))
    # a subset shares its first token with the rule: an equi-join on that token
    some = wide.withColumn("t", F.explode("tokens"))
    implied = some.join(short.withColumn("t", F.col("s_tokens")[0]), "t").where(inside & sure).select("tokens", "label").distinct()
    return rules.join(implied, ["tokens", "label"], "left_anti")


def judge_urls(pages: DataFrame, rules=RULES, labelled: DataFrame | None = None, min_support: float = MIN_SUPPORT,
               min_confidence: float = MIN_CONFIDENCE, default: str = DEFAULT) -> DataFrame:
    """(page_id, host, path, rule, verdict, mined) for rows (page_id, url).

    ``labelled`` has (url, label); by default the urls that an explicit rule
    decides serve as labelled examples. ``mined`` shows the tokens of the
    deciding mined rule, surest first (then support, fewer tokens, block first).
    Null urls and urls without ``://`` have empty host and path, no tokens and
    the default verdict. Repeated rows are judged alike. Other columns are ignored.
    Empty table: no rows."""
    host, path = split_url(F.col("url"))
    p = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    p = p.withColumn("found", longest_rule(F.col("host"), F.col("path"), rules))
    tokens = url_tokens(F.col("host"), F.col("path"), F.col("url"))
    p = cut_lineage(p.select("page_id", "host", "path", "found", F.when(F.col("host") != "", tokens).otherwise(F.array().cast("array<string>")).alias("tokens")), "urls")
    if labelled is None:
        examples = p.where("found is not null").select("tokens", F.col("found.verdict").alias("label"))
    else:
        host, path = split_url(F.col("url"))
        e = labelled.select("url", "label", host.alias("host"), path.alias("path")).where("host != '' and label is not null")
        examples = e.select(url_tokens(F.col("host"), F.col("path"), F.col("url")).alias("tokens"), "label")
    mined = cut_lineage(mine_rules(examples, min_support, min_confidence), "rules")
    # urls reduced to the tokens that rules use; few distinct sets are left
    vocabulary = mined.select(F.explode("tokens").alias("t")).agg(F.array_sort(F.collect_set("t")).alias("vocabulary"))
    p = p.crossJoin(F.broadcast(vocabulary)).select(  # one row, bounded by the mined rules
        "page_id", "host", "path", "found", F.array_intersect("tokens", "vocabulary").alias("used"))
    sets = p.where("found is null and size(used) > 0").select("used").distinct()
    index = mined.withColumn("t", F.col("tokens")[0])
    hits = sets.withColumn("t", F.explode("used")).join(index, "t").where(F.size(F.array_except("tokens", "used")) == 0)
    best = F.max_by(F.struct("label", "tokens"), F.struct("confidence", "support", -F.size("tokens"), F.col("label") == "block", "tokens"))
    judged = cut_lineage(hits.groupBy("used").agg(best.alias("m")), "judged")
    out = p.join(judged, "used", "left")
    return out.select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"),
        F.coalesce("found.verdict", F.when(F.col("found").isNull(), F.col("m.label")), F.lit(default)).alias("verdict"),
        F.when(F.col("found").isNull(), F.array_join("m.tokens", " ")).alias("mined"))
