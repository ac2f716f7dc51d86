"""The corpus pipeline: toxicity, line dedup, near duplicates, decontamination, mix.

Each stage takes (spark, docs, sf_dir) and works on all that the one before
has kept; ``run`` writes each stage's rows as Parquet in the shared folder and
reads them again. All stages but the last return the columns of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekpanel.llm import decontam, hyperminhash, line_dedup, mixing, toxicity
from weekpanel.session import cut_lineage

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def clean_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go; the model learns from the labels that are not held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    return toxicity.judge(docs.select(*COLUMNS), labels).where("predicted = 0").select(*COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated chunks of lines and long lines go, n_chars follows the text. A document that loses all its words goes;
    one that had none stays."""
    cleaned = line_dedup.dedup_lines(docs.select(*COLUMNS))
    cleaned = cleaned.where((F.col("n_removed") == 0) | F.col("text").rlike(line_dedup.WORD))
    return cleaned.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays (five-word shingles, similarity 0.8)."""
    docs = docs.select(*COLUMNS)
    return hyperminhash.keep_one(docs, hyperminhash.near_duplicates(docs, n_words=5, percent=80))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontam.mark_leaks(docs.select(*COLUMNS), benchmark).where(F.size("leaks") == 0).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with the number of times each is taken."""
    mixed = mixing.fair_mix(docs.select(*COLUMNS), keep=COLUMNS)
    return mixed.where("repeats > 0").select(*COLUMNS, "size", "source_size", "target", "taken", "repeats")


STAGES = [("toxicity", clean_toxic), ("line dedup", dedup_lines), ("near duplicates", dedup_near),
          ("decontamination", decontaminate), ("source mix", mix)]
ORACLE_SQL = None  # a fitted model, sketches and alignments have no SQL; tests hold a brute-force version against it


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
