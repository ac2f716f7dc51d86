"""Per-unit profiles and cluster summaries.

The master panel is hash-partitioned by unit after its windows, so the unit
and (unit, week-of-year) aggregates here run without another shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weekpanel.operators.ranks import equal_groups

PROFILE_COLS = [
    "mean_weekly", "median_weekly", "max_weekly", "std_weekly", "high_share",
    "growth_mean", "share_weeks_with_cases", "peak_week",
]
CLUSTER_COLS = ["mean_weekly", "median_weekly", "max_weekly", "std_weekly", "share_weeks_with_cases"]

# fixed values: level names, from the least to the most intense cluster
LEVEL_NAMES = [
    "Transmision esporadica",
    "Transmision estacional",
    "Transmision alta y sostenida",
    "Transmision muy alta",
]


def peak_week(panel: DataFrame) -> DataFrame:
    """Week of year with the highest mean cases per unit; ties -> earliest."""
    by_week = panel.groupBy("unit_id", "week").agg(F.avg("cases").alias("m"))
    return by_week.groupBy("unit_id").agg(
        F.max_by("week", F.struct(F.col("m"), (-F.col("week")).alias("nw"))).cast("double").alias("peak_week")
    )


def unit_profile(panel: DataFrame) -> DataFrame:
    """One row per unit: first region/district, mean, median, max, population
    std of weekly cases, mean label (0 if none), mean growth, share of weeks
    with cases, peak week; missing statistics read as 0."""
    c = F.col("cases").cast("double")
    prof = panel.groupBy("unit_id").agg(
        F.min_by("region", "week_id").alias("region"),
        F.min_by("district", "week_id").alias("district"),
        F.avg(c).alias("mean_weekly"),
        F.percentile(c, 0.5).alias("median_weekly"),
        F.max(c).alias("max_weekly"),
        F.stddev_pop(c).alias("std_weekly"),
        F.coalesce(F.avg(F.col("target").cast("double")), F.lit(0.0)).alias("high_share"),
        F.avg(F.when(~F.isnan("growth") & (F.abs("growth") != float("inf")), F.col("growth"))).alias("growth_mean"),
        F.avg((c > 0).cast("double")).alias("share_weeks_with_cases"),
    )
    out = prof.join(peak_week(panel), "unit_id", "left")
    return out.na.fill(0.0, subset=PROFILE_COLS)


def zscore(df: DataFrame, cols: list[str]) -> DataFrame:
    """(x - mean) / population std per column (0 where the std is 0); the
    1-row statistics table is broadcast."""
    stats = df.agg(*[F.avg(c).alias(f"_m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"_s_{c}") for c in cols])
    j = df.crossJoin(F.broadcast(stats))
    zs = [
        F.when(F.col(f"_s_{c}") > 0, (F.col(c) - F.col(f"_m_{c}")) / F.col(f"_s_{c}")).otherwise(F.lit(0.0)).alias(f"z_{c}")
        for c in cols
    ]
    return j.select(*df.columns, *zs)


def relabel_by_intensity(assign: DataFrame, profile: DataFrame, col: str = "mean_weekly") -> DataFrame:
    """Renumber clusters 0.. by ascending mean intensity so ids are stable
    across runs (k rows: tiny window)."""
    means = assign.join(profile.select("unit_id", col), "unit_id").groupBy("cluster").agg(F.avg(col).alias("_m"))
    order = means.withColumn("_lvl", (F.row_number().over(Window.orderBy("_m", "cluster")) - 1).cast("int"))
    return assign.join(F.broadcast(order.select("cluster", "_lvl")), "cluster").select(
        "unit_id", F.col("_lvl").alias("cluster")
    )


def cluster_summary(profile: DataFrame, labels: DataFrame) -> DataFrame:
    j = profile.join(labels, "unit_id")
    return j.groupBy("cluster").agg(
        *[F.round(F.avg(c), 2).alias(c) for c in PROFILE_COLS], F.count(F.lit(1)).alias("n_units")
    )


def cluster_labels(profile: DataFrame, labels: DataFrame) -> DataFrame:
    """Means of five columns and size per cluster, ordered by mean intensity,
    with a level 0..n-1 and a name (two clusters skip the middle name)."""
    j = profile.join(labels, "unit_id")
    g = j.groupBy("cluster").agg(
        F.avg("mean_weekly").alias("mean_weekly"), F.avg("max_weekly").alias("max_weekly"),
        F.avg("share_weeks_with_cases").alias("share_weeks_with_cases"), F.avg("high_share").alias("high_share"),
        F.avg("peak_week").alias("peak_week"), F.count(F.lit(1)).alias("n_units"),
    )
    # k rows: a global window is fine
    g = g.withColumn("level", (F.row_number().over(Window.orderBy("mean_weekly", "cluster")) - 1).cast("int"))
    g = g.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy()))
    names = F.array(*[F.lit(n) for n in LEVEL_NAMES])
    name_idx = F.when(F.col("_n") == 2, F.col("level") * 2).otherwise(F.col("level"))
    name = F.when(
        name_idx < len(LEVEL_NAMES), F.element_at(names, (name_idx + 1).cast("int"))
    ).otherwise(F.concat(F.lit("Nivel "), F.col("level").cast("string")))
    return g.withColumn("name", name).drop("_n")


def cluster_share(panel: DataFrame, labels: DataFrame) -> DataFrame:
    """Percent of all cases per cluster (1 decimal); unmapped units drop out."""
    per_unit = panel.groupBy("unit_id").agg(F.sum("cases").alias("cases"))
    per_cluster = per_unit.join(labels, "unit_id").groupBy("cluster").agg(F.sum("cases").alias("cases"))
    return per_cluster.select(
        "cluster", F.round(F.col("cases") * 100.0 / F.sum("cases").over(Window.partitionBy()), 1).alias("share_pct")
    )


def intensity_buckets(profile: DataFrame, k: int) -> DataFrame:
    """Deterministic reference labelling (k equal-size groups by mean
    intensity), used to check the summaries independently of K-means."""
    return equal_groups(profile.select("unit_id", "mean_weekly"), ["mean_weekly", "unit_id"], k, "cluster").select("unit_id", "cluster")
