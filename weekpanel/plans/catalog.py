"""Registered queries: one callable (spark, sf_dir) -> DataFrame per key, and
the matching DuckDB SQL where the operator can be written in SQL.

Every query reads the driver tables (through an adapter) so its work grows
with them. Doubles are rounded to 6 places in both the Spark result and the
SQL so the comparison is about values, not summation order."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekpanel.functions.calendar import epi_week, epi_week_start, epi_year
from weekpanel.functions.scalar import age_in_years
from weekpanel.functions.text import normalize_text
from weekpanel.operators import audit, eda
from weekpanel.operators.clean import clean_cases
from weekpanel.operators.label import train_thresholds
from weekpanel.operators.panel import case_groups, epi_calendar, min_history, modal_geography, unit_week_aggregate
from weekpanel.params import Params
from weekpanel.plans import oracle as O
from weekpanel.plans.master import build_master, dense_panel
from weekpanel.schema import FEATURE_CATEGORICAL, FEATURE_NUMERIC, MASTER_COLUMNS, TARGET
from weekpanel.session import cut_lineage
from weekpanel.sources.adapters import supplier_cases, table

# driver data starts in 1995: the adapters widen the valid-year range
ADAPTER = Params(year_min=1990)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def round6(df: DataFrame) -> DataFrame:
    return df.select(
        *[F.round(F.col(f.name), 6).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
          for f in df.schema.fields]
    )


def panel(spark: SparkSession, sf_dir: str, params: Params = ADAPTER, columns: list[str] | None = None) -> DataFrame:
    """The master panel as a plan, for queries that read it in one pass: nothing is written in between and
    columns that are not read are not worked out. ``columns`` names those that are; cases are then grouped by what they need."""
    return build_master(supplier_cases(spark, sf_dir), params, columns=columns)


def master(spark: SparkSession, sf_dir: str, params: Params = ADAPTER, columns: list[str] | None = None) -> DataFrame:
    """The master panel (all its rows), written once per query: what a query reads of it several
    times (series, extension, fits) scans that table instead of planning the panel anew. ``columns`` names what
    the query reads; the others are neither worked out nor written."""
    return cut_lineage(panel(spark, sf_dir, params, columns), "panel")


def cases(spark, sf_dir):
    return clean_cases(supplier_cases(spark, sf_dir), ADAPTER)


MASTER_SQL = O.master_ctes()
R6_MASTER = ", ".join(
    O.r6(c) if c in ("age_mean", "warn_share", "severe_share", "female_share", "cases_lag_1", "cases_lag_2",
                     "cases_lag_4", "roll_mean_4", "roll_mean_8", "roll_std_4", "growth", "week_sin", "week_cos",
                     "threshold") else c
    for c in MASTER_COLUMNS
)


# --------------------------------------------------------------------- panel
@register("master_panel", MASTER_SQL + f"SELECT {R6_MASTER} FROM master")
def q_master_panel(spark, sf_dir):
    return round6(master(spark, sf_dir))


@register("clean_cases", O.with_ctes(O.CASES) + "SELECT unit_id, region, province, district, year, week, "
          "round(age_years, 6) AS age_years, warn_or_severe, severe, female FROM cases")
def q_clean_cases(spark, sf_dir):
    return round6(cases(spark, sf_dir))


@register("normalize_text", f"SELECT doc_id, lang, {O.norm('text')} AS text_norm FROM documents")
def q_normalize_text(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", "lang", normalize_text("text").alias("text_norm"))


@register("age_to_years", """
SELECT l_orderkey, l_linenumber,
       round(CASE WHEN a < 0 OR a > 120 THEN NULL ELSE a END, 6) AS age_years
FROM (SELECT l_orderkey, l_linenumber,
             CASE l_linenumber % 3 WHEN 1 THEN l_quantity / 12.0 WHEN 2 THEN l_quantity / 365.0 ELSE l_quantity END AS a
      FROM lineitem)""")
def q_age_to_years(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    unit = F.element_at(F.array(F.lit("A"), F.lit("M"), F.lit("D")), (F.pmod("l_linenumber", F.lit(3)) + 1).cast("int"))
    return round6(li.select("l_orderkey", "l_linenumber", age_in_years(F.col("l_quantity").cast("string"), unit).alias("age_years")))


@register("epi_week_date", """
SELECT year, week, week_start,
       CAST(year(week_start) AS INTEGER) AS year_back,
       CAST((dayofyear(week_start) - 1) // 7 + 1 AS INTEGER) AS week_back
FROM (SELECT year, week, CAST(make_date(year, 1, 1) + CAST(7 * (week - 1) AS INTEGER) AS DATE) AS week_start
      FROM (SELECT DISTINCT CAST(year(l_shipdate) AS INTEGER) AS year,
                   CAST((dayofyear(l_shipdate) - 1) // 7 + 1 AS INTEGER) AS week FROM lineitem))""")
def q_epi_week_date(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    yw = li.select(epi_year("l_shipdate").alias("year"), epi_week("l_shipdate").alias("week")).distinct()
    d = yw.withColumn("week_start", epi_week_start("year", "week"))
    return d.withColumn("year_back", epi_year("week_start")).withColumn("week_back", epi_week("week_start"))


@register("epi_calendar", O.with_ctes(O.CASES, O.CALENDAR) + "SELECT year, week, week_id, week_start FROM cal")
def q_epi_calendar(spark, sf_dir):
    g = case_groups(cases(spark, sf_dir))
    return epi_calendar(g.select("year", "week"))


@register("modal_geo", O.with_ctes(O.CASES, O.GEO) + "SELECT unit_id, region, province, district FROM geo")
def q_modal_geo(spark, sf_dir):
    return modal_geography(case_groups(cases(spark, sf_dir)))


AGG_SQL_COLS = ("unit_id, year, week, week_id, week_start, cases, round(age_mean, 6) AS age_mean, "
                "round(warn_share, 6) AS warn_share, round(severe_share, 6) AS severe_share, "
                "round(female_share, 6) AS female_share")


@register("unit_week_agg", O.with_ctes(O.CASES, O.CALENDAR, O.AGG) + f"SELECT {AGG_SQL_COLS} FROM agg")
def q_unit_week_agg(spark, sf_dir):
    g = case_groups(cases(spark, sf_dir))
    cal = epi_calendar(g.select("year", "week"))
    return round6(unit_week_aggregate(g, cal))


@register("fill_zero_weeks", O.with_ctes(O.CASES, O.CALENDAR, O.AGG, O.GEO, O.DENSE)
          + f"SELECT {AGG_SQL_COLS}, region, province, district FROM dense_geo")
def q_fill_zero_weeks(spark, sf_dir):
    panel, _, _ = dense_panel(supplier_cases(spark, sf_dir), ADAPTER)
    return round6(panel)


@register("min_history", O.with_ctes(O.CASES, O.CALENDAR, O.AGG, O.GEO, O.DENSE, O.hist(300))
          + "SELECT unit_id, count(*) AS weeks, sum(cases) AS cases FROM hist GROUP BY unit_id")
def q_min_history(spark, sf_dir):
    panel, _, _ = dense_panel(supplier_cases(spark, sf_dir), ADAPTER)
    kept = min_history(panel, 300)
    return kept.groupBy("unit_id").agg(F.count(F.lit(1)).alias("weeks"), F.sum("cases").alias("cases"))


FEATURE_SQL = ", ".join(["unit_id", "week_id", "cases"] + [O.r6(c) for c in FEATURE_NUMERIC if c != "cases"])


@register("panel_features", MASTER_SQL + f"SELECT {FEATURE_SQL} FROM feat")
def q_panel_features(spark, sf_dir):
    m = master(spark, sf_dir)
    return round6(m.select("unit_id", "week_id", *FEATURE_NUMERIC))


@register("train_threshold", MASTER_SQL + "SELECT unit_id, round(threshold, 6) AS threshold FROM thr")
def q_train_threshold(spark, sf_dir):
    return round6(train_thresholds(master(spark, sf_dir), ADAPTER))


@register("label_and_split", MASTER_SQL + "SELECT unit_id, week_id, split, round(threshold, 6) AS threshold, target FROM master")
def q_label_and_split(spark, sf_dir):
    return round6(master(spark, sf_dir).select("unit_id", "week_id", "split", "threshold", TARGET))


# ----------------------------------------------------------------------- EDA
@register("real_only", MASTER_SQL + "SELECT unit_id, week_id, cases FROM master WHERE origin = 'real'")
def q_real_only(spark, sf_dir):
    return eda.real_only(master(spark, sf_dir)).select("unit_id", "week_id", "cases")


@register("explore_filter", MASTER_SQL + "SELECT unit_id, week_id, year, region, cases FROM master "
          "WHERE year BETWEEN 1997 AND 1999 AND region = 'ASIA' AND origin = 'real'")
def q_explore_filter(spark, sf_dir):
    m = eda.explore_filter(master(spark, sf_dir), 1997, 1999, "ASIA", real=True)
    return m.select("unit_id", "week_id", "year", "region", "cases")


@register("modeling_frame", MASTER_SQL + "SELECT unit_id, week_id, split, "
          + ", ".join(["cases"] + [O.r6(c) for c in FEATURE_NUMERIC if c != "cases"]) + ", region, target FROM master WHERE target IS NOT NULL")
def q_modeling_frame(spark, sf_dir):
    m = master(spark, sf_dir).filter(F.col(TARGET).isNotNull())
    return round6(m.select("unit_id", "week_id", "split", *FEATURE_NUMERIC, *FEATURE_CATEGORICAL, TARGET))


SERIES_SQL = MASTER_SQL.rstrip() + """,
stacked AS (
  SELECT 'national' AS level, 'ALL' AS series_key, week_start, cases FROM master
  UNION ALL SELECT 'region', region, week_start, cases FROM master
  UNION ALL SELECT 'unit', unit_id, week_start, cases FROM master
),
sums AS (SELECT level, series_key, week_start, CAST(sum(cases) AS DOUBLE) AS cases FROM stacked GROUP BY 1, 2, 3),
spans AS (SELECT level, series_key, min(week_start) AS d0, max(week_start) AS d1 FROM sums GROUP BY 1, 2),
dates AS (SELECT DISTINCT week_start AS d FROM master),
series AS (
  SELECT s.level, s.series_key, d.d AS week_start, coalesce(m.cases, 0.0) AS cases
  FROM spans s JOIN dates d ON d.d BETWEEN s.d0 AND s.d1
  LEFT JOIN sums m ON m.level = s.level AND m.series_key = s.series_key AND m.week_start = d.d
)
"""


@register("weekly_series", SERIES_SQL + "SELECT level, series_key, week_start, round(cases, 6) AS cases FROM series")
def q_weekly_series(spark, sf_dir):
    return round6(eda.weekly_series(master(spark, sf_dir, columns=SERIES_COLS)))


@register("panel_kpis", MASTER_SQL + """SELECT CAST(count(*) AS BIGINT) AS rows, CAST(sum(cases) AS BIGINT) AS total_cases,
  CAST(count(DISTINCT region) AS BIGINT) AS regions, CAST(count(DISTINCT unit_id) AS BIGINT) AS units,
  min(year) AS year_min, max(year) AS year_max, CAST(count(*) FILTER (WHERE origin = 'simulated') AS BIGINT) AS simulated_rows
  FROM master""")
def q_panel_kpis(spark, sf_dir):
    return eda.panel_kpis(master(spark, sf_dir))


SERIES_COLS = ["unit_id", "region", "week_start", "cases", "origin"]
DESCRIBE_COLS = ["cases", "age_mean", "warn_share", "severe_share", "female_share"]


def _describe_sql() -> str:
    parts = []
    for c in DESCRIBE_COLS:
        parts.append(
            f"SELECT '{c}' AS \"column\", CAST(count({c}) AS BIGINT) AS count, round(avg({c}), 6) AS mean, "
            f"round(stddev_samp({c}), 6) AS std, round(CAST(min({c}) AS DOUBLE), 6) AS min, "
            f"round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50, "
            f"round(quantile_cont({c}, 0.75), 6) AS q75, round(CAST(max({c}) AS DOUBLE), 6) AS max FROM master"
        )
    return MASTER_SQL + " UNION ALL ".join(parts)


@register("describe_cases", _describe_sql())
def q_describe_cases(spark, sf_dir):
    return round6(eda.describe(master(spark, sf_dir, columns=DESCRIBE_COLS), DESCRIBE_COLS))


@register("histogram", MASTER_SQL.rstrip() + """,
pos AS (SELECT CAST(cases AS DOUBLE) AS v FROM master WHERE cases > 0),
mm AS (SELECT min(v) AS lo, max(v) AS hi FROM pos),
b AS (SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((v - lo) / ((hi - lo) / 50)), 49) END AS INTEGER) AS bin, lo, hi
      FROM pos, mm)
SELECT bin, round(lo + bin * (hi - lo) / 50, 6) AS bin_lo, round(lo + (bin + 1) * (hi - lo) / 50, 6) AS bin_hi,
       CAST(count(*) AS BIGINT) AS count
FROM b GROUP BY bin, lo, hi""")
def q_histogram(spark, sf_dir):
    return round6(eda.histogram(master(spark, sf_dir, columns=["cases"]), "cases", 50))


@register("box_stats", MASTER_SQL.rstrip() + """,
pos AS (SELECT CAST(cases AS DOUBLE) AS v FROM master WHERE cases > 0),
q AS (SELECT quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3 FROM pos),
qi AS (SELECT *, q3 - q1 AS iqr FROM q)
SELECT round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, round(iqr, 6) AS iqr,
       round(min(v) FILTER (WHERE v >= q1 - 1.5 * iqr), 6) AS whisker_lo,
       round(max(v) FILTER (WHERE v <= q3 + 1.5 * iqr), 6) AS whisker_hi,
       CAST(count(*) FILTER (WHERE v < q1 - 1.5 * iqr OR v > q3 + 1.5 * iqr) AS BIGINT) AS n_outliers
FROM pos, qi GROUP BY q1, median, q3, iqr""")
def q_box_stats(spark, sf_dir):
    return round6(eda.box_stats(master(spark, sf_dir, columns=["cases"])))


CORR_COLS = ["cases", "cases_lag_1", "cases_lag_2", "cases_lag_4", "roll_mean_4", "roll_mean_8", "roll_std_4", "growth", "age_mean"]


def _corr_sql() -> str:
    parts = []
    for a in CORR_COLS:
        for b in CORR_COLS:
            parts.append(
                f"SELECT '{a}' AS a, '{b}' AS b, round(CASE WHEN sa > 0 AND sb > 0 THEN cv / (sa * sb) END, 6) AS corr FROM "
                f"(SELECT covar_pop({a}, {b}) AS cv, stddev_pop({a}) FILTER (WHERE {a} IS NOT NULL AND {b} IS NOT NULL) AS sa, "
                f"stddev_pop({b}) FILTER (WHERE {a} IS NOT NULL AND {b} IS NOT NULL) AS sb FROM master)"
            )
    return MASTER_SQL + " UNION ALL ".join(parts)


@register("corr_matrix", _corr_sql())
def q_corr_matrix(spark, sf_dir):
    return round6(eda.corr_matrix(panel(spark, sf_dir), CORR_COLS))


@register("iqr_outliers", MASTER_SQL.rstrip() + """,
q AS (SELECT quantile_cont(CAST(cases AS DOUBLE), 0.25) AS q1, quantile_cont(CAST(cases AS DOUBLE), 0.75) AS q3 FROM master WHERE cases > 0),
f AS (SELECT q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence FROM q)
SELECT round(q1, 6) AS q1, round(q3, 6) AS q3, round(iqr, 6) AS iqr, round(lower_fence, 6) AS lower_fence,
       round(upper_fence, 6) AS upper_fence,
       CAST(count(*) FILTER (WHERE cases > upper_fence) AS BIGINT) AS n_outliers,
       round(count(*) FILTER (WHERE cases > upper_fence) * 100.0 / count(*), 6) AS pct_outliers
FROM master, f GROUP BY q1, q3, iqr, lower_fence, upper_fence""")
def q_iqr_outliers(spark, sf_dir):
    return round6(eda.iqr_outliers(master(spark, sf_dir, columns=["cases"])))


@register("top_categories", MASTER_SQL + "SELECT district, sum(cases) AS total FROM master GROUP BY district "
          "ORDER BY total DESC, district ASC LIMIT 15")
def q_top_categories(spark, sf_dir):
    return eda.top_categories(master(spark, sf_dir), "district", "cases", 15)


@register("top_outliers", MASTER_SQL + "SELECT unit_id, district, year, week, cases FROM master "
          "ORDER BY cases DESC, unit_id ASC, week_id ASC LIMIT 15")
def q_top_outliers(spark, sf_dir):
    m = master(spark, sf_dir)
    return eda.top_rows(m, "cases", ["unit_id", "week_id"], 15).select("unit_id", "district", "year", "week", "cases")


@register("units_of_region", MASTER_SQL + "SELECT DISTINCT region, unit_id, district FROM master")
def q_units_of_region(spark, sf_dir):
    return eda.units_of_region(master(spark, sf_dir))


@register("stable_sample", MASTER_SQL + """SELECT unit_id, week_id, cases FROM master
ORDER BY (CAST(('0x' || substr(md5(concat_ws('|', unit_id, CAST(week_id AS VARCHAR), '42')), 1, 8)) AS UBIGINT) + 0.5) / 4294967296.0,
         unit_id, week_id LIMIT 400""")
def q_stable_sample(spark, sf_dir):
    return eda.stable_sample(master(spark, sf_dir), ["unit_id", "week_id"], 400, 42).select("unit_id", "week_id", "cases")


@register("import_slice", MASTER_SQL + """SELECT unit_id, region, province, district, year, week, cases FROM
 (SELECT *, row_number() OVER (PARTITION BY unit_id, year ORDER BY week) AS rn FROM master) WHERE rn <= 15""")
def q_import_slice(spark, sf_dir):
    m = eda.first_weeks(master(spark, sf_dir), 15)
    return m.select("unit_id", "region", "province", "district", "year", "week", "cases")


# --------------------------------------------------------------------- audit
def _nulls_sql() -> str:
    parts = [f"SELECT '{c}' AS \"column\", CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS nulls FROM master"
             for c in MASTER_COLUMNS]
    return MASTER_SQL + " UNION ALL ".join(parts)


@register("audit_nulls", _nulls_sql())
def q_audit_nulls(spark, sf_dir):
    return audit.null_counts(master(spark, sf_dir))


@register("audit_dup_keys", MASTER_SQL + """SELECT CAST(count(*) AS BIGINT) AS duplicate_keys, CAST(coalesce(sum(n), 0) AS BIGINT) AS rows_in_duplicates
FROM (SELECT unit_id, week_start, count(*) AS n FROM master GROUP BY 1, 2 HAVING count(*) > 1)""")
def q_audit_dup_keys(spark, sf_dir):
    return audit.duplicate_key_count(master(spark, sf_dir), ["unit_id", "week_start"])


@register("audit_splits", MASTER_SQL + """SELECT split, min(week_start) AS date_min, max(week_start) AS date_max,
 min(year) AS year_min, max(year) AS year_max, CAST(count(*) AS BIGINT) AS rows FROM master GROUP BY split""")
def q_audit_splits(spark, sf_dir):
    return audit.split_ranges(master(spark, sf_dir))


@register("audit_target", MASTER_SQL + """SELECT target, CAST(count(*) AS BIGINT) AS rows,
 round(count(*) / sum(count(*)) OVER (), 6) AS share FROM master GROUP BY target""")
def q_audit_target(spark, sf_dir):
    return round6(audit.target_mix(master(spark, sf_dir)))


@register("customer_panel", O.with_ctes(O.CUSTOMER_CASES, O.CALENDAR, O.AGG, O.GEO, O.DENSE, O.hist(30))
          + "SELECT unit_id, week_id, year, week, cases, round(warn_share, 6) AS warn_share, "
            "round(severe_share, 6) AS severe_share, round(female_share, 6) AS female_share, age_mean, "
            "region, province, district FROM hist")
def q_customer_panel(spark, sf_dir):
    """Sparse stress case: customers as units (few cases each, long gaps),
    zero-filled and history-filtered."""
    from weekpanel.sources.adapters import customer_cases

    panel, _, _ = dense_panel(customer_cases(spark, sf_dir), ADAPTER)
    kept = min_history(panel, ADAPTER.min_history_weeks)
    return round6(kept.select("unit_id", "week_id", "year", "week", "cases", "warn_share", "severe_share", "female_share",
                              "age_mean", "region", "province", "district"))
