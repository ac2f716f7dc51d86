"""Data audit tables: null counts, duplicate keys, split ranges, target mix."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def null_counts(df: DataFrame) -> DataFrame:
    """(column, nulls) for every column; one pass."""
    one = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    return one.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("nulls")) for c in df.columns])).alias("s")
    ).select("s.*")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def duplicate_key_count(df: DataFrame, keys: list[str]) -> DataFrame:
    return duplicate_keys(df, keys).agg(F.count(F.lit(1)).alias("duplicate_keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows_in_duplicates"))


def split_ranges(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(
        F.min("week_start").alias("date_min"), F.max("week_start").alias("date_max"),
        F.min("year").alias("year_min"), F.max("year").alias("year_max"),
        F.count(F.lit(1)).alias("rows"),
    )


def target_mix(df: DataFrame, target: str = "target") -> DataFrame:
    """Rows and share per target value, missing included."""
    g = df.groupBy(F.col(target).alias("target")).agg(F.count(F.lit(1)).alias("rows"))
    return g.withColumn("share", F.col("rows") / F.sum("rows").over(Window.partitionBy()))
