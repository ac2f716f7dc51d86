"""Bulk what-if scoring: per-unit feature rows from history, control ranges,
clamping, re-derivation from lags, and a scenario table scored in one job.

All per-unit reads are conditional aggregates over the unit's last few rows
(``row_number`` <= 9, which Spark turns into a per-partition group limit), so
a unit with a long history costs no more than one with a short one."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weekpanel.functions.calendar import week_cos, week_sin

CONTROLS = ["cases", "cases_lag_1", "cases_lag_2", "cases_lag_4", "roll_mean_4", "roll_mean_8", "roll_std_4", "growth", "week"]
INT_CONTROLS = {"cases", "cases_lag_1", "cases_lag_2", "cases_lag_4", "week"}


def _recent(panel: DataFrame, depth: int = 9) -> DataFrame:
    w = Window.partitionBy("unit_id").orderBy(F.col("week_id").desc())
    return panel.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= depth)


def _at(k: int, col: str = "cases"):
    return F.coalesce(F.max(F.when(F.col("_rn") == k, F.col(col).cast("double"))), F.lit(0.0))


def latest_features(panel: DataFrame, min_rows: int = 6) -> DataFrame:
    """Features of each unit's last observed week: current = last row; lags
    and trailing windows exclude it (std 0 with fewer than 2 points). Units
    with fewer than ``min_rows`` rows are skipped."""
    n = panel.groupBy("unit_id").agg(F.count(F.lit(1)).alias("n_rows"), F.max("cases").alias("max_cases"))
    r = _recent(panel)
    prev4 = F.col("_rn").between(2, 5)
    prev8 = F.col("_rn").between(2, 9)
    c = F.col("cases").cast("double")
    g = r.groupBy("unit_id").agg(
        _at(1).alias("cases"), _at(2).alias("cases_lag_1"), _at(3).alias("cases_lag_2"), _at(5).alias("cases_lag_4"),
        F.coalesce(F.avg(F.when(prev4, c)), F.lit(0.0)).alias("roll_mean_4"),
        F.coalesce(F.avg(F.when(prev8, c)), F.lit(0.0)).alias("roll_mean_8"),
        F.when(F.count(F.when(prev4, c)) > 1, F.stddev_samp(F.when(prev4, c))).otherwise(F.lit(0.0)).alias("roll_std_4"),
        F.max(F.when(F.col("_rn") == 1, F.col("week"))).alias("week"),
        F.max(F.when(F.col("_rn") == 1, F.col("region"))).alias("region"),
    )
    g = g.withColumn("growth", (F.col("cases") - F.col("cases_lag_1")) / (F.col("cases_lag_1") + 1.0))
    return g.join(n, "unit_id").filter(F.col("n_rows") >= min_rows).drop("n_rows")


def prediction_rows(panel: DataFrame, current: DataFrame) -> DataFrame:
    """Feature rows for predicting from a unit's history plus given current
    cases/week (``current``: unit_id, cases, week): the history's last 8 weeks
    are the previous weeks; partial windows are allowed, missing lags read 0."""
    r = _recent(panel, 8).withColumn("_rn", F.col("_rn") + 1)  # history row k -> position k+1
    c = F.col("cases").cast("double")
    prev4 = F.col("_rn").between(2, 5)
    g = r.groupBy("unit_id").agg(
        _at(2).alias("cases_lag_1"), _at(3).alias("cases_lag_2"), _at(5).alias("cases_lag_4"),
        F.coalesce(F.avg(F.when(prev4, c)), F.lit(0.0)).alias("roll_mean_4"),
        F.coalesce(F.avg(c), F.lit(0.0)).alias("roll_mean_8"),
        F.when(F.count(F.when(prev4, c)) > 1, F.stddev_samp(F.when(prev4, c))).otherwise(F.lit(0.0)).alias("roll_std_4"),
        F.max(F.when(F.col("_rn") == 2, F.col("region"))).alias("region"),
    )
    j = current.select("unit_id", F.col("cases").cast("double").alias("cases"), "week").join(g, "unit_id", "left")
    j = j.na.fill(0.0, subset=["cases_lag_1", "cases_lag_2", "cases_lag_4", "roll_mean_4", "roll_mean_8", "roll_std_4"])
    return j.withColumn("growth", (F.col("cases") - F.col("cases_lag_1")) / (F.col("cases_lag_1") + 1.0)).withColumn(
        "week_sin", week_sin("week")).withColumn("week_cos", week_cos("week"))


def resync(df: DataFrame) -> DataFrame:
    """Re-derive means, std and growth from lags 1, 2, 4 (week 3 is no control):
    mean4 = mean(lags), mean8 = mean(lags + old mean8), std = sample std(lags)."""
    l1, l2, l4 = F.col("cases_lag_1"), F.col("cases_lag_2"), F.col("cases_lag_4")
    m = (l1 + l2 + l4) / 3.0
    var = ((l1 - m) ** 2 + (l2 - m) ** 2 + (l4 - m) ** 2) / 2.0
    return df.withColumn("roll_mean_8", (l1 + l2 + l4 + F.col("roll_mean_8")) / 4.0).withColumn(
        "roll_mean_4", m).withColumn("roll_std_4", F.sqrt(var)).withColumn(
        "growth", (F.col("cases") - l1) / (l1 + 1.0))


def control_ranges(panel: DataFrame) -> DataFrame:
    """Per unit: top = max(20, ceil(max cases * 1.5 / 10) * 10), std upper
    bound max(5, top div 2)."""
    g = panel.groupBy("unit_id").agg(F.max("cases").alias("max_cases"))
    top = F.greatest(F.lit(20), (F.ceil(F.col("max_cases") * 1.5 / 10) * 10).cast("long"))
    return g.select("unit_id", top.alias("top"), F.greatest(F.lit(5), F.floor(top / 2).cast("long")).alias("std_hi"))


def clamp_controls(df: DataFrame, ranges: DataFrame) -> DataFrame:
    """Clamp every control to its range (missing -> lower bound) and type."""
    j = df.join(ranges, "unit_id")
    top, std_hi = F.col("top").cast("double"), F.col("std_hi").cast("double")
    bounds = {
        "cases": (F.lit(0.0), top), "cases_lag_1": (F.lit(0.0), top), "cases_lag_2": (F.lit(0.0), top),
        "cases_lag_4": (F.lit(0.0), top), "roll_mean_4": (F.lit(0.0), top), "roll_mean_8": (F.lit(0.0), top),
        "roll_std_4": (F.lit(0.0), std_hi), "growth": (F.lit(-1.0), F.lit(5.0)), "week": (F.lit(1.0), F.lit(53.0)),
    }
    out = []
    for c in CONTROLS:
        lo, hi = bounds[c]
        v = F.coalesce(F.col(c).cast("double"), lo)
        v = F.greatest(F.least(v, hi), lo)
        out.append((F.floor(v).cast("long") if c in INT_CONTROLS else v).alias(c))
    keep = [c for c in df.columns if c not in CONTROLS]
    return j.select(*keep, *out)


def scenario_table(latest: DataFrame, deltas: DataFrame) -> DataFrame:
    """Every unit's latest features x a small table of case multipliers
    (``deltas``: scenario, factor) applied to the current cases, with the
    derived columns re-synced."""
    j = latest.crossJoin(F.broadcast(deltas))
    j = j.withColumn("cases", F.col("cases") * F.col("factor"))
    return resync(j)


def feature_row(df: DataFrame) -> DataFrame:
    return df.withColumn("week_sin", week_sin("week")).withColumn("week_cos", week_cos("week"))

