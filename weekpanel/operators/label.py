"""Temporal split and next-week high-incidence label.

The per-unit threshold (exact percentile of cases on train rows only) and the
next-week value are window functions over the unit partitioning the features
already use, so labelling adds no shuffle. The split is decided from the
distinct real years (<= year_max - year_min + 1 rows, broadcast)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weekpanel.operators.panel import unit_order
from weekpanel.params import DEFAULT, Params
from weekpanel.schema import ORIGIN_REAL, ORIGIN_SIMULATED, TARGET


def real_years(panel: DataFrame) -> DataFrame:
    real = panel.filter(F.col("origin") == ORIGIN_REAL) if "origin" in panel.columns else panel
    return real.select("year").filter(F.col("year").isNotNull()).distinct()


def split_years(panel: DataFrame, params: Params = DEFAULT, years: DataFrame | None = None) -> DataFrame:
    """(year, split): last ``test_years`` real years test, the ``val_years``
    before val, the rest train. Years are counted on real rows only; a caller
    that already knows the distinct real years passes them as ``years``."""
    years = real_years(panel) if years is None else years
    r = F.dense_rank().over(Window.orderBy(F.col("year").desc()))
    return years.withColumn("_r", r).select(
        "year",
        F.when(F.col("_r") <= params.test_years, "test")
        .when(F.col("_r") <= params.test_years + params.val_years, "val")
        .otherwise("train")
        .alias("split"),
    )


def add_split(panel: DataFrame, params: Params = DEFAULT, years: DataFrame | None = None) -> DataFrame:
    # one row per distinct year in a bounded year range: safe to broadcast
    years = F.broadcast(split_years(panel, params, years))
    out = panel.join(years, "year", "left")
    if "origin" in panel.columns:
        out = out.withColumn(
            "split", F.when(F.col("origin") == ORIGIN_SIMULATED, F.lit(ORIGIN_SIMULATED)).otherwise(F.col("split"))
        )
    return out


def train_threshold_col(percentile: float) -> F.Column:
    """Exact (linear interpolation) percentile of train-row cases per unit."""
    train_cases = F.when(F.col("split") == "train", F.col("cases"))
    return F.percentile(train_cases, percentile / 100.0).over(Window.partitionBy("unit_id"))


def add_target_and_split(panel: DataFrame, params: Params = DEFAULT, years: DataFrame | None = None) -> DataFrame:
    out = add_split(panel, params, years)
    out = out.withColumn("threshold", train_threshold_col(params.target_percentile))
    out = out.withColumn("next_cases", F.lead("cases", 1).over(unit_order()))
    target = (F.col("next_cases") > F.col("threshold")).cast("int")
    if params.label_from_real_only and "origin" in panel.columns:
        next_origin = F.lead("origin", 1).over(unit_order())
        target = F.when(next_origin == F.col("origin"), target)
    return out.withColumn(TARGET, target)


def train_thresholds(master: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Per-unit threshold table (units without train rows are absent)."""
    return (
        master.filter(F.col("split") == "train")
        .groupBy("unit_id")
        .agg(F.percentile("cases", params.target_percentile / 100.0).alias("threshold"))
    )
