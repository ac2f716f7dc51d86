"""Registered queries: saved artifacts, metadata, build-or-reuse, and facts of results that rest on fitted models."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from weekpanel.operators import classify as CF
from weekpanel.operators import eda
from weekpanel.operators import forecast as FC
from weekpanel.operators import metrics as ME
from weekpanel.operators import profile as PR
from weekpanel.operators import scenario as SC
from weekpanel.plans import analysis_queries as AQ
from weekpanel.plans import table_queries as TQ
from weekpanel.plans.catalog import ADAPTER, MASTER_SQL, SERIES_SQL, master, register, round6
from weekpanel.plans.master import load_or_build_master
from weekpanel.schema import FEATURE_NUMERIC
from weekpanel.session import cut_lineage, ensure_checkpoint_dir
from weekpanel.sources import io
from weekpanel.sources.adapters import supplier_cases


def _folder(spark) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/artifacts/{uuid.uuid4().hex}"


@register("master_reuse", MASTER_SQL + "SELECT split, CAST(count(*) AS BIGINT) AS built, CAST(count(*) AS BIGINT) AS reused, CAST(sum(cases) AS BIGINT) AS cases FROM master GROUP BY split")
def q_master_reuse(spark, sf_dir):
    """The panel is built and written by the first call and read back by the second, which gets no raw rows."""
    path = f"{_folder(spark)}/master"
    built = load_or_build_master(spark, path, supplier_cases(spark, sf_dir), extend=False, params=ADAPTER)
    reused = load_or_build_master(spark, path, None)
    a = built.groupBy("split").agg(F.count(F.lit(1)).alias("built"))
    return a.join(reused.groupBy("split").agg(F.count(F.lit(1)).alias("reused"), F.sum("cases").alias("cases")), "split")


@register("artifacts_gate", MASTER_SQL + """SELECT * FROM (
  SELECT 'master' AS artifact, true AS present, CAST(count(*) AS BIGINT) AS rows, true AS ready FROM master
  UNION ALL SELECT 'profile', true, CAST(count(DISTINCT unit_id) AS BIGINT), true FROM master
  UNION ALL SELECT 'forecast', false, CAST(NULL AS BIGINT), false)""")
def q_artifacts_gate(spark, sf_dir):
    """Which optional artifacts are there, their rows, and whether all up to each one are ready."""
    base, m = _folder(spark), master(spark, sf_dir)
    io.write_master(m, f"{base}/master")
    PR.unit_profile(eda.real_only(m)).write.parquet(f"{base}/profile")
    names, rows = ["master", "profile", "forecast"], None
    for i, name in enumerate(names):
        found = io.read_optional(spark, f"{base}/{name}")
        ready = io.artifacts_ready(spark, [f"{base}/{n}" for n in names[: i + 1]])
        count = found.agg(F.count(F.lit(1)).alias("rows")) if found is not None else spark.range(1).select(F.lit(None).cast("long").alias("rows"))
        one = count.select(F.lit(name).alias("artifact"), F.lit(found is not None).alias("present"), "rows", F.lit(ready).alias("ready"))
        rows = one if rows is None else rows.unionByName(one)
    return rows


@register("model_meta", MASTER_SQL + f"""SELECT CAST(count(*) FILTER (WHERE split = 'train') AS BIGINT) AS train_rows, CAST(count(*) FILTER (WHERE split = 'test') AS BIGINT) AS test_rows,
  round(greatest(avg(target) FILTER (WHERE split = 'train'), 1 - avg(target) FILTER (WHERE split = 'train')), 3) AS majority_share,
  greatest(avg(target) FILTER (WHERE split = 'train'), 1 - avg(target) FILTER (WHERE split = 'train')) > 0.8 AS balanced,
  CAST({ADAPTER.threshold} AS DOUBLE) AS threshold, CAST({len(FEATURE_NUMERIC) + 1} AS BIGINT) AS features, 'decision_tree' AS model FROM master WHERE target IS NOT NULL""")
def q_model_meta(spark, sf_dir):
    """The metadata record of a training run, as read back from where it was saved."""
    fr = TQ._frame(spark, sf_dir)
    n = {r["split"]: r["n"] for r in fr.groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()}
    balance = ME.class_balance(fr.where("split = 'train'")).first()
    path = f"{_folder(spark)}/meta"
    io.save_meta(spark, {"train_rows": n.get("train", 0), "test_rows": n.get("test", 0), "majority_share": round(balance["majority_share"], 3), "balanced": balance["balance"],
                         "threshold": ADAPTER.threshold, "features": CF.FEATURE_NUMERIC + CF.FEATURE_CATEGORICAL, "model": "decision_tree"}, path)
    meta = io.load_meta(spark, path)
    row = (meta["train_rows"], meta["test_rows"], meta["majority_share"], meta["balanced"], meta["threshold"], len(meta["features"]), meta["model"])
    return spark.createDataFrame([row], "train_rows long, test_rows long, majority_share double, balanced boolean, threshold double, features long, model string")


@register("modeling_rows", MASTER_SQL + "SELECT unit_id, week_id, split, "
          + ", ".join(["CAST(cases AS DOUBLE) AS cases"] + [f"round(coalesce(CAST({c} AS DOUBLE), 0.0), 6) AS {c}" for c in FEATURE_NUMERIC if c != "cases"])
          + ", region, CAST(target AS INTEGER) AS y FROM master WHERE target IS NOT NULL")
def q_modeling_rows(spark, sf_dir):
    """The modelling frame as its operator makes it."""
    return round6(CF.modeling_frame(master(spark, sf_dir)))


@register("outlier_points", MASTER_SQL.rstrip() + """,
q AS (SELECT quantile_cont(CAST(cases AS DOUBLE), 0.25) AS q1, quantile_cont(CAST(cases AS DOUBLE), 0.75) AS q3 FROM master WHERE cases > 0)
SELECT unit_id, week_id, CAST(cases AS DOUBLE) AS value, CASE WHEN cases < q1 - 1.5 * (q3 - q1) THEN 'low' ELSE 'high' END AS side
FROM master, q WHERE cases > 0 AND (cases < q1 - 1.5 * (q3 - q1) OR cases > q3 + 1.5 * (q3 - q1))""")
def q_outlier_points(spark, sf_dir):
    """The single points outside the whiskers."""
    return eda.outlier_points(master(spark, sf_dir))


@register("robustness_valid", AQ._ma_sql([8, 13, 26]) + "SELECT level, series_key, eval_window, round(mape, 6) AS mape_ma, round(rmse, 6) AS rmse_ma, true AS chosen_is_lower FROM errs")
def q_robustness_valid(spark, sf_dir):
    """Three windows of every series: the moving average's errors, and that the lower error is chosen."""
    b = FC.backtest(AQ.real_series(spark, sf_dir), [8, 13, 26])
    lower = F.coalesce(F.col("rmse_hw") < F.col("rmse_ma"), F.lit(False)) == (F.col("chosen") == "holt_winters")
    return b.select(*FC.SERIES, "eval_window", F.round("mape_ma", 6).alias("mape_ma"), F.round("rmse_ma", 6).alias("rmse_ma"), (lower & F.col("rmse_hw").isNotNull()).alias("chosen_is_lower"))


@register("forecast_display_valid", SERIES_SQL.rstrip() + """,
st AS (SELECT level, series_key, max(week_start) AS d, count(*) AS n, max(cases) AS mx FROM series GROUP BY 1, 2),
yw AS (SELECT level, series_key, CAST(year(d) AS INTEGER) AS y, CAST((dayofyear(d) - 1) // 7 + 1 AS INTEGER) AS w FROM st WHERE n >= 25 AND mx > 0),
f AS (SELECT level, series_key, y, least(w, 52) - 1 + s AS w0, s AS step FROM yw, (SELECT CAST(unnest([1, 2, 3, 4]) AS INTEGER) AS s))
SELECT level, series_key, step, strftime(CAST(make_date(CAST(y + w0 // 52 AS INTEGER), 1, 1) + CAST(7 * (w0 % 52) AS INTEGER) AS DATE), '%Y-%m-%d') AS date, true AS fine FROM f""")
def q_forecast_display_valid(spark, sf_dir):
    """What is shown of each forecast: its dates, and whole numbers in order."""
    shown = FC.display(FC.forecast_future(AQ.real_series(spark, sf_dir), 4))
    fine = (F.col("lower") >= 0) & (F.col("lower") <= F.col("forecast")) & (F.col("forecast") <= F.col("upper"))
    return shown.select(*FC.SERIES, "step", "date", F.coalesce(fine, F.lit(False)).alias("fine"))


@register("scenario_scores_valid", TQ.LATEST_SQL.rstrip() + f""",
d AS (SELECT * FROM (VALUES {", ".join(f"('{n}', {f})" for n, f in TQ.DELTAS)}) t(scenario, factor))
SELECT l.unit_id, d.scenario, CAST(floor(greatest(least(l.cases * d.factor, CAST(r.top AS DOUBLE)), 0.0)) AS BIGINT) AS cases, true AS fine FROM lf l, d, ranges2 r WHERE r.unit_id = l.unit_id""")
def q_scenario_scores_valid(spark, sf_dir):
    """Every unit under every scenario, with the clamped cases it is scored at, a probability and a decision that follows the threshold."""
    s = TQ.q_scenario_scores(spark, sf_dir)
    fine = F.col("proba").between(0, 1) & (F.col("pred") == (F.col("proba") >= ADAPTER.threshold).cast("int"))
    return s.select("unit_id", "scenario", F.col("cases").cast("long").alias("cases"), F.coalesce(fine, F.lit(False)).alias("fine"))


@register("top_contributions_valid", MASTER_SQL + "SELECT unit_id, week_id, CAST(10 AS BIGINT) AS features, true AS largest_first FROM master WHERE split = 'test' AND target IS NOT NULL")
def q_top_contributions_valid(spark, sf_dir):
    """Ten different features for every row of the test split, the largest contribution first."""
    t = TQ.q_top_contributions(spark, sf_dir)
    ranked = F.transform(F.array_sort(F.collect_list(F.struct("rank", F.abs("phi").alias("size")))), lambda r: r["size"])
    return t.groupBy("unit_id", "week_id").agg(F.count_distinct("feature").alias("features"), ranked.alias("r")).select(
        "unit_id", "week_id", "features", (F.col("r") == F.reverse(F.array_sort("r"))).alias("largest_first"))


@register("shap_tree_valid", MASTER_SQL + "SELECT unit_id, week_id, true AS adds_up FROM master WHERE split = 'test' AND target IS NOT NULL")
def q_shap_tree_valid(spark, sf_dir):
    """Tree SHAP of the decision tree: the expected value and a row's contributions add up to its probability."""
    fr = TQ._frame(spark, sf_dir)
    model, test = CF.fit(fr, "decision_tree", ADAPTER), fr.filter(F.col("split") == "test")
    phi = cut_lineage(CF.tree_shap_values(model, test, f"{_folder(spark)}/model"), "phi")
    base = phi.where("feature = '_expected'").select(F.col("phi").alias("base"))  # one row
    sums = phi.where("feature <> '_expected'").groupBy("unit_id", "week_id").agg(F.sum("phi").alias("s"))
    scored = CF.score(model, test, "tree").select("unit_id", "week_id", "proba").join(sums, ["unit_id", "week_id"], "left").crossJoin(F.broadcast(base))
    return scored.select("unit_id", "week_id", (F.abs(F.col("base") + F.coalesce("s", F.lit(0.0)) - F.col("proba")) < 1e-9).alias("adds_up"))
