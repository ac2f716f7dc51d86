"""Adapters that present the benchmark tables as raw case lists.

Each adapter returns the raw, all-text case list schema (``schema.RAW_CASES``)
so the full cleaning path runs on it. Fixed 25/5-row dimension tables (nation,
region) are broadcast explicitly; tables that grow with the data (supplier,
customer) are joined plainly, so Spark's size check (static statistics plus
AQE's runtime broadcast conversion) decides the strategy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weekpanel.functions.calendar import epi_week, epi_year
from weekpanel.schema import RAW_COLUMNS

# fixed values: disease labels of the three severity levels, and how the
# benchmark flags play them (N -> none, A -> warning signs, R -> severe)
LABEL_NONE = "DENGUE SIN SIGNOS DE ALARMA"
LABEL_WARNING = "DENGUE CON SIGNOS DE ALARMA"
LABEL_SEVERE = "DENGUE GRAVE"
AGE_UNITS = ["A", "M", "D"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def unit_key(key) -> Column:
    """Unit id as text, padded to at least six digits and never shortened."""
    text = key.cast("string")
    return F.when(F.length(text) < 6, F.lpad(text, 6, "0")).otherwise(text)


def _geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return F.broadcast(
        nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
        .select("n_nationkey", "n_name", "r_name")
    )


def _to_raw(df: DataFrame) -> DataFrame:
    missing = [F.lit(None).cast("string").alias(c) for c in RAW_COLUMNS if c not in df.columns]
    return df.select(*[c for c in df.columns if c in RAW_COLUMNS], *missing).select(*RAW_COLUMNS)


def _severity(flag_col, none_v, warn_v, severe_v):
    return (
        F.when(flag_col == none_v, F.lit(LABEL_NONE))
        .when(flag_col == warn_v, F.lit(LABEL_WARNING))
        .when(flag_col == severe_v, F.lit(LABEL_SEVERE))
    )


def supplier_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as a case list: unit = supplier, geography = region / nation /
    supplier name, week from the ship date, severity from the return flag."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate"
    )
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    geo = _geo(spark, sf_dir)
    j = li.join(sup, li.l_suppkey == sup.s_suppkey, "left").join(
        geo, F.col("s_nationkey") == geo.n_nationkey, "left"
    )
    d = F.col("l_shipdate")
    return _to_raw(
        j.select(
            F.col("r_name").alias("region"),
            F.initcap("n_name").alias("province"),
            F.col("s_name").alias("district"),
            _severity(F.col("l_returnflag"), "N", "A", "R").alias("disease"),
            epi_year(d).cast("string").alias("year"),
            epi_week(d).cast("string").alias("week"),
            unit_key(F.col("l_suppkey")).alias("unit_id"),
            F.col("l_quantity").cast("string").alias("age"),
            F.element_at(
                F.array(*[F.lit(u) for u in AGE_UNITS]), (F.pmod(F.col("l_linenumber"), F.lit(3)) + 1).cast("int")
            ).alias("age_unit"),
            F.when(F.col("l_linestatus") == "F", F.lit("F")).otherwise(F.lit("M")).alias("sex"),
        )
    )


def customer_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as a sparse case list: unit = customer."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    geo = _geo(spark, sf_dir)
    j = o.join(c, o.o_custkey == c.c_custkey, "left").join(geo, F.col("c_nationkey") == geo.n_nationkey, "left")
    d = F.col("o_orderdate")
    return _to_raw(
        j.select(
            F.col("r_name").alias("region"),
            F.col("n_name").alias("province"),
            F.col("c_name").alias("district"),
            _severity(F.col("o_orderstatus"), "O", "P", "F").alias("disease"),
            epi_year(d).cast("string").alias("year"),
            epi_week(d).cast("string").alias("week"),
            unit_key(F.col("o_custkey")).alias("unit_id"),
        )
    )
