"""Exploration tables: weekly series, KPIs, describe, histogram, box stats,
correlation matrix, IQR fences, top-k, distinct lists, filters, samples.

Every statistic is one aggregate (or a few) over the panel; nothing is
collected to the driver. Exact percentiles are used (``percentile``), never
the approximate variant."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weekpanel.functions.scalar import hash_uniform
from weekpanel.operators.ranks import exact_quantiles
from weekpanel.schema import ORIGIN_REAL, ORIGIN_SIMULATED
from weekpanel.session import cut_lineage


def real_only(df: DataFrame) -> DataFrame:
    """Observed rows only; tables without provenance pass through."""
    return df.filter(F.col("origin") == ORIGIN_REAL) if "origin" in df.columns else df


def explore_filter(df: DataFrame, year_from: int, year_to: int, region: str | None = None, real: bool = False) -> DataFrame:
    out = df.filter(F.col("year").between(year_from, year_to))
    if region is not None:
        out = out.filter(F.col("region") == region)
    return real_only(out) if real else out


def _without_gaps(sums: DataFrame, dates: DataFrame) -> DataFrame:
    """Every date of ``dates`` (d, i = place in date order; broadcast) from a series' first to its last, missing
    ones as 0. A date is followed up to the next one of its series, so nothing is joined with the series."""
    at = sums.join(F.broadcast(dates), F.col("week_start") == F.col("d")).select("level", "series_key", "i", "cases")
    following = F.lead("i").over(Window.partitionBy("level", "series_key").orderBy("i"))
    each = at.withColumn("_next", following).withColumn(
        "j", F.explode(F.sequence(F.col("i"), F.coalesce(F.col("_next") - 1, F.col("i")))))
    # rows without a key belong to no series' sum: their dates are there with 0
    own = F.when((F.col("j") == F.col("i")) & F.col("series_key").isNotNull(), F.col("cases"))
    each = each.select("level", "series_key", "j", F.coalesce(own, F.lit(0.0)).alias("cases"))
    named = F.broadcast(dates.select(F.col("i").alias("j"), F.col("d").alias("week_start")))
    return each.join(named, "j").select("level", "series_key", "week_start", "cases")


def weekly_series(panel: DataFrame, levels: tuple[str, ...] = ("national", "region", "unit")) -> DataFrame:
    """Weekly case totals for every series of the requested levels at once:
    (level, series_key, week_start, cases). Each series runs on the calendar of
    distinct dates of the whole table between its own first and last date;
    missing dates are 0. Regions and weeks are summed up first (a small table, written once: it gives the
    dates and the coarse levels), so the national series (one key) is a sum, not a hot group; the units' rows are
    shuffled once, by unit."""
    key = {"national": F.lit("ALL"), "region": F.col("region"), "unit": F.col("unit_id")}
    coarse = cut_lineage(panel.groupBy("region", "week_start").agg(F.sum("cases").alias("cases")), "region_weeks")
    # distinct dates: <= 53 per year of a bounded year range -> broadcast, one partition numbers them
    dates = coarse.select(F.col("week_start").alias("d")).where("d IS NOT NULL").distinct()
    dates = dates.withColumn("i", F.row_number().over(Window.orderBy("d")))
    out = None
    for lv in levels:
        rows = panel.select("unit_id", "week_start", "cases").repartition("unit_id") if lv == "unit" else coarse
        sums = rows.groupBy(F.lit(lv).alias("level"), key[lv].alias("series_key"), "week_start").agg(F.sum("cases").cast("double").alias("cases"))
        filled = _without_gaps(sums, dates)
        out = filled if out is None else out.unionByName(filled)
    return out


def panel_kpis(panel: DataFrame) -> DataFrame:
    return panel.agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("cases").cast("long").alias("total_cases"),
        F.countDistinct("region").alias("regions"),
        F.countDistinct("unit_id").alias("units"),
        F.min("year").alias("year_min"),
        F.max("year").alias("year_max"),
        F.count_if(F.col("origin") == ORIGIN_SIMULATED).alias("simulated_rows"),
    )


def describe(df: DataFrame, cols: list[str]) -> DataFrame:
    """count, mean, sample std, min, exact quartiles, max per column."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs.append(F.struct(F.lit(c).alias("column"), F.count(x).alias("count"), F.avg(x).alias("mean"),
                             F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max")).alias(c))
    one = df.agg(*aggs).select(F.explode(F.array(*[F.col(c) for c in cols])).alias("s")).select("s.*")
    q = exact_quantiles(df, cols, [0.25, 0.5, 0.75])
    return one.join(F.broadcast(q), "column", "left").select(  # one row per column
        "column", "count", "mean", "std", "min", F.col("q0").alias("q25"), F.col("q1").alias("q50"), F.col("q2").alias("q75"), "max")


def histogram(df: DataFrame, col: str = "cases", bins: int = 50, positive_only: bool = True) -> DataFrame:
    """Equal-width bins between min and max (the max folds into the last bin)."""
    x = F.col(col).cast("double")
    d = df.filter(x > 0) if positive_only else df.filter(x.isNotNull())
    mm = d.agg(F.min(x).alias("lo"), F.max(x).alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    b = F.when(F.col("hi") == F.col("lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col("v") - F.col("lo")) / width), F.lit(bins - 1))
    ).cast("int")
    j = d.select(x.alias("v")).crossJoin(F.broadcast(mm))  # 1-row side
    counts = j.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    return counts.crossJoin(F.broadcast(mm)).select(
        "bin",
        (F.col("lo") + F.col("bin") * (F.col("hi") - F.col("lo")) / bins).alias("bin_lo"),
        (F.col("lo") + (F.col("bin") + 1) * (F.col("hi") - F.col("lo")) / bins).alias("bin_hi"),
        "count",
    )


def _quartiles(d: DataFrame, x) -> DataFrame:
    q = exact_quantiles(d.select(x.alias("v")), ["v"], [0.25, 0.5, 0.75])
    return q.select(F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3"))


def outlier_points(df: DataFrame, col: str = "cases", keys: tuple[str, ...] = ("unit_id", "week_id"), positive_only: bool = True) -> DataFrame:
    """The points outside 1.5 IQR of the quartiles: (keys..., value, side)."""
    x = F.col(col).cast("double")
    d = df.filter(x > 0) if positive_only else df.filter(x.isNotNull())
    qs = _quartiles(d, x)
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    side = F.when(F.col("value") < F.col("q1") - reach, F.lit("low")).when(F.col("value") > F.col("q3") + reach, F.lit("high"))
    j = d.select(*keys, x.alias("value")).crossJoin(F.broadcast(qs))  # one row
    return j.withColumn("side", side).where("side is not null").select(*keys, "value", "side")


def box_stats(df: DataFrame, col: str = "cases", positive_only: bool = True) -> DataFrame:
    """Quartiles, whiskers (most extreme points within 1.5 IQR) and outlier count."""
    x = F.col(col).cast("double")
    d = df.filter(x > 0) if positive_only else df.filter(x.isNotNull())
    qs = _quartiles(d, x).withColumn("iqr", F.col("q3") - F.col("q1"))
    lo_f = F.col("q1") - 1.5 * F.col("iqr")
    hi_f = F.col("q3") + 1.5 * F.col("iqr")
    j = d.select(x.alias("v")).crossJoin(F.broadcast(qs))
    return j.groupBy("q1", "median", "q3", "iqr").agg(
        F.min(F.when(F.col("v") >= lo_f, F.col("v"))).alias("whisker_lo"),
        F.max(F.when(F.col("v") <= hi_f, F.col("v"))).alias("whisker_hi"),
        F.count_if((F.col("v") < lo_f) | (F.col("v") > hi_f)).alias("n_outliers"),
    )


def iqr_outliers(df: DataFrame, col: str = "cases") -> DataFrame:
    """Fences from the positive values; outliers = rows above the upper fence;
    their share over all rows (outliers are reported, never dropped)."""
    x = F.col(col).cast("double")
    qs = _quartiles(df.filter(x > 0), x).withColumn("iqr", F.col("q3") - F.col("q1"))
    qs = qs.select(
        "q1", "q3", "iqr",
        (F.col("q1") - 1.5 * F.col("iqr")).alias("lower_fence"),
        (F.col("q3") + 1.5 * F.col("iqr")).alias("upper_fence"),
    )
    j = df.select(x.alias("v")).crossJoin(F.broadcast(qs))
    return j.groupBy("q1", "q3", "iqr", "lower_fence", "upper_fence").agg(
        F.count_if(F.col("v") > F.col("upper_fence")).alias("n_outliers"),
        (F.count_if(F.col("v") > F.col("upper_fence")) * 100.0 / F.count(F.lit(1))).alias("pct_outliers"),
    )


def corr_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pairwise-complete Pearson correlation, long form (a, b, corr); NULL
    where either column is constant on the pair's rows (ANSI-safe). One pass;
    only the upper triangle is aggregated and mirrored."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    aggs = []
    for k, (a, b) in enumerate(pairs):
        xa, xb = F.col(a).cast("double"), F.col(b).cast("double")
        both = xa.isNotNull() & xb.isNotNull()
        sa = F.stddev_pop(F.when(both, xa))
        sb = F.stddev_pop(F.when(both, xb))
        cov = F.covar_pop(xa, xb)
        aggs.append(F.when((sa > 0) & (sb > 0), cov / (sa * sb)).alias(f"c{k}"))
    one = df.agg(*aggs)
    entries = []
    for k, (a, b) in enumerate(pairs):
        entries.append(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{k}").alias("corr")))
        if a != b:
            entries.append(F.struct(F.lit(b).alias("a"), F.lit(a).alias("b"), F.col(f"c{k}").alias("corr")))
    return one.select(F.explode(F.array(*entries)).alias("s")).select("s.*")


def top_categories(df: DataFrame, cat: str, value: str = "cases", n: int = 15) -> DataFrame:
    return (
        df.groupBy(cat).agg(F.sum(value).alias("total"))
        .orderBy(F.col("total").desc(), F.col(cat).asc_nulls_last())
        .limit(n)
    )


def top_rows(df: DataFrame, value: str, keys: list[str], n: int = 15) -> DataFrame:
    return df.orderBy(F.col(value).desc(), *[F.col(k).asc() for k in keys]).limit(n)


def units_of_region(df: DataFrame) -> DataFrame:
    return df.select("region", "unit_id", "district").distinct().orderBy("region", "unit_id")


def stable_sample(df: DataFrame, key_cols: list[str], n: int, seed: int = 42) -> DataFrame:
    """Seeded sample of n rows, the same for any partitioning: order by a
    hashed uniform of the row key (top-n, so one small sort per task)."""
    u = hash_uniform(*key_cols, seed=seed)
    return df.withColumn("_u", u).orderBy("_u", *key_cols).limit(n).drop("_u")


def first_weeks(df: DataFrame, n: int, part=("unit_id", "year"), order: str = "week") -> DataFrame:
    """The first n rows by week of every (unit, year) slice."""
    w = Window.partitionBy(*part).orderBy(order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")
