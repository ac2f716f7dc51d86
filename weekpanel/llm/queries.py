"""Thin registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from weekpanel.llm import (
    byte_bpe,
    chat_format,
    decontam,
    embedding_dedup,
    hyperminhash,
    lexical_search,
    license_scan,
    line_dedup,
    mixing,
    periodic_runs,
    suffix_dedup,
    toxicity,
    url_filter,
)

QUERIES: dict = {}
ORACLE: dict = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn

    return deco


def table(spark, sf_dir: str, name: str, *columns: str):
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


@register("op3_url_filter")
def op3_url_filter(spark, sf_dir):
    """Verdict of every page's url."""
    return url_filter.judge_urls(table(spark, sf_dir, "pages", "page_id", "url"))


@register("op6_line_dedup", f"SELECT doc_id, n_lines, n_removed, CASE WHEN text IS NULL THEN NULL ELSE sha256(text) END AS kept_sha256 FROM ({line_dedup.dedup_sql()})")
def op6_line_dedup(spark, sf_dir):
    """Lines removed from every document, and the digest of what is left."""
    d = line_dedup.dedup_lines(table(spark, sf_dir, "documents", "doc_id", "text"))
    return d.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@register("op8_source_mix", mixing.mix_sql())
def op8_source_mix(spark, sf_dir):
    """Words of every document that the mix takes."""
    return mixing.fair_mix(table(spark, sf_dir, "documents", "doc_id", "text", "source"))


@register("op7_toxicity")
def op7_toxicity(spark, sf_dir):
    """Toxicity score of every document."""
    docs, labels = table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "toxic")
    return toxicity.judge(docs, labels).select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


@register("op10_chat_format")
def op10_chat_format(spark, sf_dir):
    """Digests of every conversation (and one whose texts hold control strings), read back from its tokens."""
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    nasty = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", nasty), (-7, 1, "assistant", nasty)], "conv_id long, turn long, role string, text string")
    return chat_format.read_back(chat_format.format_chats(turns.unionByName(extra)))


@register("op5_near_duplicates")
def op5_near_duplicates(spark, sf_dir):
    """Component of every document under 3-word shingle similarity of 0.85."""
    found = hyperminhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"), n_words=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@register("op4_repeated_bytes")
def op4_repeated_bytes(spark, sf_dir):
    """What is left of every document without strings of 400 bytes that stand elsewhere too."""
    found = suffix_dedup.repeated_bytes(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.drop("spans")


@register("op2_near_vectors")
def op2_near_vectors(spark, sf_dir):
    """Links and component of every embedding under cosine 0.98 within its label."""
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"), least=0.98)


@register("op1_license_scan")
def op1_license_scan(spark, sf_dir):
    """Licenses found in every document, with coverage and spans."""
    marked = license_scan.mark_licenses(table(spark, sf_dir, "documents", "doc_id", "text"))
    found = license_scan.license_matches(marked)
    return found.withColumn("spans", F.array_join(F.transform("spans", lambda x: F.concat_ws("-", x["start"], x["end"])), " "))


@register("op9_decontamination")
def op9_decontamination(spark, sf_dir):
    """Pairs of documents and the benchmark items that they hold."""
    docs, benchmark = table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text")
    return decontam.mark_leaks(docs, benchmark).select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


@register("op11_ranked_search", lexical_search.rank_sql())
def op11_ranked_search(spark, sf_dir):
    """The 50 best documents of every benchmark item."""
    docs, items = table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text")
    return lexical_search.rank_documents(docs, items)


@register("op12_periodic_runs")
def op12_periodic_runs(spark, sf_dir):
    """Runs of every document (a tenth of them made periodic), and digests of the runs and of what collapsing them leaves."""
    docs = periodic_runs.with_planted_run(table(spark, sf_dir, "documents", "doc_id", "text"))
    marked = periodic_runs.mark_runs(docs).withColumn("best", periodic_runs.strongest("runs"))
    return marked.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        periodic_runs.runs_digest("runs").alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


@register("op13_byte_bpe")
def op13_byte_bpe(spark, sf_dir):
    """Number and digest of every document's tokens, and digest of the text decoded from them."""
    encoded = byte_bpe.encode_texts(table(spark, sf_dir, "documents", "doc_id", "text")).drop("text")
    decoded = byte_bpe.decode_ids(encoded)
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), byte_bpe.ids_digest("ids").alias("ids_sha256"),
                          F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
