"""Queries that hold fitted results against facts that SQL can state.

Fitted models have no SQL of their own. Each key here runs such an operator
over its whole table and returns counts: of its rows, which SQL derives from
the panel, and of rows that break a rule the result must keep (none)."""

from __future__ import annotations

from pyspark.sql import functions as F

from weekpanel.operators import classify as CF
from weekpanel.operators import cluster as CL
from weekpanel.operators import forecast as FC
from weekpanel.operators import profile as PR
from weekpanel.operators import scenario as SC
from weekpanel.operators.eda import real_only
from weekpanel.plans import analysis_queries as AQ
from weekpanel.plans import table_queries as TQ
from weekpanel.plans.catalog import ADAPTER, MASTER_SQL, SERIES_SQL, master, register
from weekpanel.schema import FEATURE_NUMERIC
from weekpanel.session import cut_lineage


@register("score_panel_valid", MASTER_SQL + """SELECT split, CAST(count(*) AS BIGINT) AS rows, CAST(sum(target) AS BIGINT) AS positives, CAST(0 AS BIGINT) AS invalid
FROM master WHERE target IS NOT NULL GROUP BY split""")
def q_score_panel_valid(spark, sf_dir):
    """Scores are probabilities and decisions follow the threshold."""
    s = TQ.q_score_panel(spark, sf_dir)
    fine = F.col("proba").between(0, 1) & (F.col("pred") == (F.col("proba") >= 0.5).cast("int"))
    return s.groupBy("split").agg(F.count(F.lit(1)).alias("rows"), F.sum("y").cast("long").alias("positives"), F.count_if(~F.coalesce(fine, F.lit(False))).alias("invalid"))


_ELIGIBLE = """st AS (SELECT level, series_key, count(*) AS n, max(cases) AS mx FROM series GROUP BY 1, 2)"""


@register("hw_forecast_valid", SERIES_SQL.rstrip() + f""", {_ELIGIBLE}
SELECT level, CAST(count(*) AS BIGINT) AS series, CAST(4 * count(*) AS BIGINT) AS rows, CAST(0 AS BIGINT) AS invalid FROM st WHERE n >= 25 AND mx > 0 GROUP BY level""")
def q_hw_forecast_valid(spark, sf_dir):
    """Every eligible series has four weeks with 0 <= lower <= forecast <= upper."""
    f = FC.forecast_future(AQ.real_series(spark, sf_dir), 4)
    fine = (F.col("lower") >= 0) & (F.col("lower") <= F.col("forecast")) & (F.col("forecast") <= F.col("upper"))
    return f.groupBy("level").agg(F.count_distinct("series_key").alias("series"), F.count(F.lit(1)).alias("rows"), F.count_if(~F.coalesce(fine, F.lit(False))).alias("invalid"))


@register("backtest_valid", AQ._ma_sql([13]) + """SELECT level, series_key, eval_window, round(mape, 6) AS mape_ma, round(rmse, 6) AS rmse_ma, true AS chosen_is_lower FROM errs""")
def q_backtest_valid(spark, sf_dir):
    """The backtest's moving-average errors, and that it chooses the lower error."""
    b = FC.backtest(AQ.real_series(spark, sf_dir), [13])
    lower = F.when(F.col("chosen") == "holt_winters", F.col("rmse_hw") < F.col("rmse_ma")).otherwise(~F.coalesce(F.col("rmse_hw") < F.col("rmse_ma"), F.lit(False)))
    return b.select(*FC.SERIES, "eval_window", F.round("mape_ma", 6).alias("mape_ma"), F.round("rmse_ma", 6).alias("rmse_ma"), lower.alias("chosen_is_lower"))


@register("unit_clusters_valid", MASTER_SQL + "SELECT CAST(count(DISTINCT unit_id) AS BIGINT) AS units, CAST(3 AS BIGINT) AS clusters, true AS ordered, true AS beats_equal_groups FROM master")
def q_unit_clusters_valid(spark, sf_dir):
    """K-means labels every unit, orders clusters by intensity, and has no more
    within-cluster error than three equal groups."""
    prof = cut_lineage(PR.unit_profile(real_only(master(spark, sf_dir))), "profile")
    z = PR.zscore(prof, PR.CLUSTER_COLS)

    def error(labels):
        j = z.join(labels, "unit_id")
        dims = [f"z_{c}" for c in PR.CLUSTER_COLS]
        means = j.groupBy("cluster").agg(*[F.avg(d).alias(f"m_{d}") for d in dims])
        return j.join(F.broadcast(means), "cluster").agg(F.sum(sum((F.col(d) - F.col(f"m_{d}")) ** 2 for d in dims)).alias("e"))

    km = cut_lineage(CL.unit_clusters(prof, ADAPTER.k_selected, ADAPTER.seed), "clusters")
    by = km.join(prof, "unit_id").groupBy("cluster").agg(F.avg("mean_weekly").alias("m"), F.count(F.lit(1)).alias("n"))
    ordered = F.array_sort(F.collect_list(F.struct("cluster", "m")))["m"]
    one = by.agg(F.sum("n").alias("units"), F.count(F.lit(1)).alias("clusters"), (ordered == F.array_sort(ordered)).alias("ordered"))
    a, b = error(km), error(PR.intensity_buckets(prof, 3)).withColumnRenamed("e", "e2")
    return one.crossJoin(F.broadcast(a)).crossJoin(F.broadcast(b)).select("units", "clusters", "ordered", (F.col("e") <= F.col("e2")).alias("beats_equal_groups"))  # single rows


@register("shap_linear_valid", MASTER_SQL + f"""SELECT CAST(count(*) AS BIGINT) AS rows,
  CAST({len(FEATURE_NUMERIC)} + (SELECT count(DISTINCT region) FROM master WHERE split = 'train' AND target IS NOT NULL) AS BIGINT) AS features,
  CAST(0 AS BIGINT) AS not_additive FROM master WHERE split = 'test' AND target IS NOT NULL""")
def q_shap_linear_valid(spark, sf_dir):
    """Contributions of a row plus one constant give its log-odds."""
    fr = TQ._frame(spark, sf_dir)
    model = CF.fit(fr, "logistic_regression", ADAPTER)
    test = fr.filter(F.col("split") == "test")
    phi = CF.linear_shap(model, test, fr.filter(F.col("split") == "train"))
    sums = phi.groupBy("unit_id", "week_id").agg(F.sum("phi").alias("s"), F.count(F.lit(1)).alias("k"))
    p = CF.score(model, test, "m").select("unit_id", "week_id", "proba")
    j = cut_lineage(p.join(sums, ["unit_id", "week_id"], "full").withColumn("base", F.log(F.col("proba") / (1 - F.col("proba"))) - F.col("s")), "phi")
    mid = j.where("proba between 1e-6 and 1 - 1e-6").agg(F.avg("base").alias("b"))
    off = (F.abs(F.col("base") - F.col("b")) > 1e-6) & F.col("proba").between(1e-6, 1 - 1e-6)
    return j.crossJoin(F.broadcast(mid)).agg(F.count(F.lit(1)).alias("rows"), F.max("k").alias("features"), F.count_if(off | F.col("s").isNull()).alias("not_additive"))


@register("prediction_log_valid", TQ.LATEST_SQL + f"""SELECT CAST({len(TQ.DELTAS)} * count(*) AS BIGINT) AS rows, CAST({len(TQ.DELTAS)} * count(*) AS BIGINT) AS last_id,
  CAST({len(TQ.DELTAS)} * count(*) AS BIGINT) AS ids, CAST(0 AS BIGINT) AS invalid FROM lf""")
def q_prediction_log_valid(spark, sf_dir):
    """Ids 1..n without gaps, all inputs logged, probabilities in range."""
    t = TQ.q_prediction_log(spark, sf_dir)
    fine = (F.size("inputs") == len(SC.CONTROLS)) & F.col("probability").between(0, 1) & F.col("prediction").isin("high", "low")
    return t.agg(F.count(F.lit(1)).alias("rows"), F.max("id").alias("last_id"), F.count_distinct("id").alias("ids"), F.count_if(~F.coalesce(fine, F.lit(False))).alias("invalid"))
