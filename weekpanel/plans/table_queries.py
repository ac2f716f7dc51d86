"""Registered queries: keyed-table change batches, scenarios, classifiers,
file sources and sinks."""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import functions as F

from weekpanel.operators import classify as CF
from weekpanel.operators import registry as RG
from weekpanel.operators import scenario as SC
from weekpanel.operators.metrics import class_metrics, roc_auc
from weekpanel.params import Params
from weekpanel.plans.catalog import ADAPTER, MASTER_SQL, master, panel, register, round6
from weekpanel.plans.models import build_or_reuse, shared_folder
from weekpanel.schema import CASE_REGISTRY, FEATURE_NUMERIC, MASTER_COLUMNS, QUERY_REGISTRY
from weekpanel.session import cut_lineage, ensure_checkpoint_dir
from weekpanel.sources import io
from weekpanel.sources.adapters import LABEL_NONE, LABEL_SEVERE, LABEL_WARNING, supplier_cases, table

STAMP1 = datetime.datetime(2026, 1, 1, 0, 0, 0)
STAMP2 = datetime.datetime(2026, 2, 1, 0, 0, 0)
# fixed values: the note written on imported rows and on revised rows
NOTE_IMPORTED = "importado del dataset"
NOTE_REVISED = "revisado"

REG_COLS = "id, unit_id, region, province, district, year, week, cases, note, created_at, updated_at"
REG_SQL = MASTER_SQL.rstrip() + f""",
reg AS (
  SELECT CAST(row_number() OVER (ORDER BY unit_id, year, week) AS BIGINT) AS id, unit_id, region, province, district, year, week,
         cases, '{NOTE_IMPORTED}' AS note, TIMESTAMP '2026-01-01 00:00:00' AS created_at, TIMESTAMP '2026-01-01 00:00:00' AS updated_at
  FROM master
)
"""


def _registry(spark, sf_dir):
    batch = master(spark, sf_dir).withColumn("note", F.lit(NOTE_IMPORTED)).withColumn("bogus_column", F.lit(1))
    return cut_lineage(RG.append(RG.empty(spark, CASE_REGISTRY), batch, CASE_REGISTRY, STAMP1, ["unit_id", "year", "week"]), "registry")


@register("registry_append", REG_SQL + f"SELECT {REG_COLS} FROM reg")
def q_registry_append(spark, sf_dir):
    return _registry(spark, sf_dir)


@register("registry_list", REG_SQL + f"SELECT {REG_COLS} FROM reg ORDER BY created_at DESC, id DESC")
def q_registry_list(spark, sf_dir):
    return RG.list_all(_registry(spark, sf_dir))


@register("registry_update", REG_SQL + f"""SELECT id, unit_id, region, province, district, year, week,
  CASE WHEN week <= 2 THEN cases * 2 ELSE cases END AS cases, CASE WHEN week <= 2 THEN '{NOTE_REVISED}' ELSE note END AS note,
  created_at, CASE WHEN week <= 2 THEN TIMESTAMP '2026-02-01 00:00:00' ELSE updated_at END AS updated_at FROM reg""")
def q_registry_update(spark, sf_dir):
    reg = _registry(spark, sf_dir)
    changes = reg.filter(F.col("week") <= 2).select("id", (F.col("cases") * 2).alias("cases"), F.lit(NOTE_REVISED).alias("note"))
    return RG.update(reg, changes, CASE_REGISTRY, STAMP2)


@register("registry_delete", REG_SQL + f"SELECT {REG_COLS} FROM reg WHERE week <> 1")
def q_registry_delete(spark, sf_dir):
    reg = _registry(spark, sf_dir)
    return RG.delete(reg, reg.filter(F.col("week") == 1).select("id"))


@register("registry_kpis", REG_SQL + """SELECT CAST(count(*) AS BIGINT) AS rows, CAST(coalesce(sum(cases), 0) AS BIGINT) AS total_cases,
  CAST(count(DISTINCT district) AS BIGINT) AS districts, CAST(count(DISTINCT year) AS BIGINT) AS years FROM reg""")
def q_registry_kpis(spark, sf_dir):
    return RG.registry_kpis(_registry(spark, sf_dir))


@register("json_roundtrip", """SELECT event_id, CAST(json_extract(props, '$.k') AS DOUBLE) AS k,
  '{"k":' || CAST(CAST(json_extract(props, '$.k') AS DOUBLE) AS VARCHAR) || '}' AS props_text FROM events""")
def q_json_roundtrip(spark, sf_dir):
    ev = RG.json_roundtrip(table(spark, sf_dir, "events").select("event_id", "props"), "props")
    return ev.select("event_id", F.element_at("props_map", F.lit("k")).alias("k"), "props_text")


# ----------------------------------------------------------------- scenarios
LATEST_SQL = MASTER_SQL.rstrip() + """,
rn AS (SELECT *, row_number() OVER (PARTITION BY unit_id ORDER BY week_id DESC) AS r, count(*) OVER (PARTITION BY unit_id) AS n_rows,
              max(cases) OVER (PARTITION BY unit_id) AS mx FROM master),
latest AS (
  SELECT unit_id,
    coalesce(max(CASE WHEN r = 1 THEN CAST(cases AS DOUBLE) END), 0.0) AS cases,
    coalesce(max(CASE WHEN r = 2 THEN CAST(cases AS DOUBLE) END), 0.0) AS cases_lag_1,
    coalesce(max(CASE WHEN r = 3 THEN CAST(cases AS DOUBLE) END), 0.0) AS cases_lag_2,
    coalesce(max(CASE WHEN r = 5 THEN CAST(cases AS DOUBLE) END), 0.0) AS cases_lag_4,
    coalesce(avg(CASE WHEN r BETWEEN 2 AND 5 THEN cases END), 0.0) AS roll_mean_4,
    coalesce(avg(CASE WHEN r BETWEEN 2 AND 9 THEN cases END), 0.0) AS roll_mean_8,
    CASE WHEN count(CASE WHEN r BETWEEN 2 AND 5 THEN cases END) > 1 THEN stddev_samp(CASE WHEN r BETWEEN 2 AND 5 THEN cases END) ELSE 0.0 END AS roll_std_4,
    max(CASE WHEN r = 1 THEN week END) AS week, max(CASE WHEN r = 1 THEN region END) AS region,
    max(mx) AS max_cases, max(n_rows) AS n_rows
  FROM rn GROUP BY unit_id
),
lf AS (SELECT * EXCLUDE (n_rows), (cases - cases_lag_1) / (cases_lag_1 + 1.0) AS growth FROM latest WHERE n_rows >= 6),
ranges AS (SELECT unit_id, greatest(20, CAST(ceil(max(cases) * 1.5 / 10) * 10 AS BIGINT)) AS top FROM master GROUP BY unit_id),
ranges2 AS (SELECT unit_id, top, greatest(5, top // 2) AS std_hi FROM ranges)
"""
LF_COLS = ["cases", "cases_lag_1", "cases_lag_2", "cases_lag_4", "roll_mean_4", "roll_mean_8", "roll_std_4", "growth"]


@register("latest_features", LATEST_SQL + "SELECT unit_id, week, region, max_cases, " + ", ".join(f"round({c}, 6) AS {c}" for c in LF_COLS) + " FROM lf")
def q_latest_features(spark, sf_dir):
    return round6(SC.latest_features(master(spark, sf_dir)))


@register("prediction_rows", MASTER_SQL.rstrip() + """,
rn AS (SELECT *, row_number() OVER (PARTITION BY unit_id ORDER BY week_id DESC) AS r FROM master),
cur AS (SELECT unit_id, CAST(cases AS DOUBLE) AS cases, week FROM rn WHERE r = 1),
h AS (
  SELECT unit_id,
    coalesce(max(CASE WHEN r = 2 THEN CAST(cases AS DOUBLE) END), 0.0) AS cases_lag_1,
    coalesce(max(CASE WHEN r = 3 THEN CAST(cases AS DOUBLE) END), 0.0) AS cases_lag_2,
    coalesce(max(CASE WHEN r = 5 THEN CAST(cases AS DOUBLE) END), 0.0) AS cases_lag_4,
    coalesce(avg(CASE WHEN r BETWEEN 2 AND 5 THEN cases END), 0.0) AS roll_mean_4,
    coalesce(avg(CASE WHEN r BETWEEN 2 AND 9 THEN cases END), 0.0) AS roll_mean_8,
    CASE WHEN count(CASE WHEN r BETWEEN 2 AND 5 THEN cases END) > 1 THEN stddev_samp(CASE WHEN r BETWEEN 2 AND 5 THEN cases END) ELSE 0.0 END AS roll_std_4,
    max(CASE WHEN r = 2 THEN region END) AS region
  FROM rn WHERE r BETWEEN 2 AND 9 GROUP BY unit_id
)
SELECT c.unit_id, c.week, h.region, round(c.cases, 6) AS cases, """ + ", ".join(
    f"round(coalesce(h.{x}, 0.0), 6) AS {x}" for x in ["cases_lag_1", "cases_lag_2", "cases_lag_4", "roll_mean_4", "roll_mean_8", "roll_std_4"]
) + """, round((c.cases - coalesce(h.cases_lag_1, 0.0)) / (coalesce(h.cases_lag_1, 0.0) + 1.0), 6) AS growth,
  round(sin(2 * pi() * c.week / 52.0), 6) AS week_sin, round(cos(2 * pi() * c.week / 52.0), 6) AS week_cos
FROM cur c LEFT JOIN h ON c.unit_id = h.unit_id""")
def q_prediction_rows(spark, sf_dir):
    m = master(spark, sf_dir)
    from pyspark.sql import Window

    w = Window.partitionBy("unit_id").orderBy(F.col("week_id").desc())
    ranked = m.withColumn("_r", F.row_number().over(w))
    current = ranked.filter(F.col("_r") == 1).select("unit_id", "cases", "week")
    history = ranked.filter(F.col("_r") > 1).drop("_r")
    return round6(SC.prediction_rows(history, current))


RESYNC_SQL = """(cases_lag_1 + cases_lag_2 + cases_lag_4) / 3.0 AS roll_mean_4,
  (cases_lag_1 + cases_lag_2 + cases_lag_4 + roll_mean_8) / 4.0 AS roll_mean_8,
  sqrt((pow(cases_lag_1 - (cases_lag_1 + cases_lag_2 + cases_lag_4) / 3.0, 2) + pow(cases_lag_2 - (cases_lag_1 + cases_lag_2 + cases_lag_4) / 3.0, 2)
        + pow(cases_lag_4 - (cases_lag_1 + cases_lag_2 + cases_lag_4) / 3.0, 2)) / 2.0) AS roll_std_4,
  (cases - cases_lag_1) / (cases_lag_1 + 1.0) AS growth"""


@register("scenario_resync", LATEST_SQL.rstrip() + f""",
rs AS (SELECT unit_id, cases, cases_lag_1, cases_lag_2, cases_lag_4, {RESYNC_SQL} FROM lf)
SELECT unit_id, """ + ", ".join(f"round({c}, 6) AS {c}" for c in LF_COLS) + " FROM rs")
def q_scenario_resync(spark, sf_dir):
    lf = SC.latest_features(master(spark, sf_dir))
    return round6(SC.resync(lf).select("unit_id", *LF_COLS))


@register("scenario_ranges", LATEST_SQL + "SELECT unit_id, top, std_hi FROM ranges2")
def q_scenario_ranges(spark, sf_dir):
    return SC.control_ranges(master(spark, sf_dir))


DELTAS = [("half", 0.5), ("same", 1.0), ("double", 2.0), ("fivefold", 5.0)]


def _deltas(spark):
    return spark.createDataFrame(DELTAS, "scenario string, factor double")


def _clamp_sql(c: str) -> str:
    lo, hi = {"roll_std_4": ("0.0", "std_hi"), "growth": ("-1.0", "5.0"), "week": ("1.0", "53.0")}.get(c, ("0.0", "top"))
    v = f"greatest(least(coalesce(CAST({c} AS DOUBLE), {lo}), CAST({hi} AS DOUBLE)), {lo})"
    return (f"CAST(floor({v}) AS BIGINT) AS {c}" if c in SC.INT_CONTROLS else f"round({v}, 6) AS {c}")


@register("scenario_clamp", LATEST_SQL.rstrip() + f""",
d AS (SELECT * FROM (VALUES {", ".join(f"('{n}', {f})" for n, f in DELTAS)}) t(scenario, factor)),
sc AS (SELECT l.unit_id, d.scenario, l.cases * d.factor AS cases, l.cases_lag_1, l.cases_lag_2, l.cases_lag_4, l.roll_mean_8, l.week FROM lf l, d),
rs AS (SELECT unit_id, scenario, cases, cases_lag_1, cases_lag_2, cases_lag_4, week, {RESYNC_SQL} FROM sc),
j AS (SELECT rs.*, r.top, r.std_hi FROM rs JOIN ranges2 r ON rs.unit_id = r.unit_id)
SELECT unit_id, scenario, """ + ", ".join(_clamp_sql(c) for c in SC.CONTROLS) + " FROM j")
def q_scenario_clamp(spark, sf_dir):
    m = master(spark, sf_dir)
    sc = SC.scenario_table(SC.latest_features(m), _deltas(spark))
    out = SC.clamp_controls(sc, SC.control_ranges(m))
    return round6(out.select("unit_id", "scenario", *SC.CONTROLS))


# ---------------------------------------------------------------- classifiers
ML = ADAPTER


def _frame(spark, sf_dir):
    return cut_lineage(CF.modeling_frame(panel(spark, sf_dir, columns=CF.FRAME_READS)), "frame")


def _prep_sql() -> str:
    """Standardised numeric features and one-hot regions, in long form."""
    zs = [f"coalesce(CAST(f.{c} AS DOUBLE), 0.0)" for c in FEATURE_NUMERIC]
    stats = ", ".join(f"avg(coalesce(CAST({c} AS DOUBLE), 0.0)) AS m{i}, stddev_samp(coalesce(CAST({c} AS DOUBLE), 0.0)) AS s{i}" for i, c in enumerate(FEATURE_NUMERIC))
    numeric = " UNION ALL ".join(
        f"SELECT unit_id, week_id, split, {i} AS slot, round(CASE WHEN s{i} > 0 THEN ({z} - m{i}) / s{i} ELSE 0.0 END, 6) + 0.0 AS value FROM fr f, st"
        for i, z in enumerate(zs))
    return MASTER_SQL.rstrip() + f""",
fr AS (SELECT * FROM master WHERE target IS NOT NULL),
st AS (SELECT {stats} FROM fr WHERE split = 'train'),
idx AS (SELECT region, row_number() OVER (ORDER BY count(*) DESC, region) - 1 AS i FROM fr WHERE split = 'train' AND region IS NOT NULL GROUP BY region)
{numeric}
UNION ALL SELECT unit_id, week_id, split, CAST({len(FEATURE_NUMERIC)} + idx.i AS INTEGER), CASE WHEN f.region = idx.region THEN 1.0 ELSE 0.0 END FROM fr f, idx"""


@register("prep_vectors", _prep_sql())
def q_prep_vectors(spark, sf_dir):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    fr = _frame(spark, sf_dir)
    prep = Pipeline(stages=CF.preprocessor()).fit(fr.filter(F.col("split") == "train"))
    v = prep.transform(fr).select("unit_id", "week_id", "split", F.posexplode(vector_to_array("features")).alias("slot", "value"))
    return v.withColumn("value", F.round("value", 6) + F.lit(0.0))


def _models(spark, fr, names=CF.MODELS):
    """The application's models of this frame, fitted by the first query that asks for them."""
    return build_or_reuse(fr, shared_folder(spark), names, ML)


def _scored(fr, models: dict):
    """Scores of the test split by all models, written once."""
    test, scored = fr.filter(F.col("split") == "test"), None
    for name, model in models.items():
        s = CF.score(model, test, name)
        scored = s if scored is None else scored.unionByName(s)
    return cut_lineage(scored, "scored")


@register("train_classifiers")
def q_train_classifiers(spark, sf_dir):
    fr = _frame(spark, sf_dir)
    scored = _scored(fr, _models(spark, fr))
    return class_metrics(scored, ML.threshold).join(roc_auc(scored), "model")


@register("score_panel")
def q_score_panel(spark, sf_dir):
    fr = _frame(spark, sf_dir)
    return CF.score(CF.fit(fr, "logistic_regression", ML), fr, "logistic_regression")


@register("model_roundtrip", MASTER_SQL + "SELECT CAST(count(*) AS BIGINT) AS rows, CAST(0 AS BIGINT) AS different FROM master WHERE target IS NOT NULL")
def q_model_roundtrip(spark, sf_dir):
    fr = _frame(spark, sf_dir)
    model = CF.fit(fr, "decision_tree", ML)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/models/{uuid.uuid4().hex}/decision_tree"
    io.save_model(model, path)
    back = io.load_model(path)
    a = CF.score(model, fr, "saved", keep=CF.FEATURES).withColumnRenamed("proba", "p_saved")
    both = CF.score(back, a, "loaded", keep=["p_saved"]).withColumnRenamed("proba", "p_loaded")
    return both.agg(F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("p_saved").eqNullSafe(F.col("p_loaded"))).alias("different"))


@register("balance_effect")
def q_balance_effect(spark, sf_dir):
    fr = _frame(spark, sf_dir)
    models = _models(spark, fr, [f"{name}{state}" for name in ("random_forest", "xgboost") for state in ("_plain", "")])
    test, rows = fr.filter(F.col("split") == "test"), None
    for name, model in models.items():
        state = "without" if name.endswith("_plain") else "with"
        m = class_metrics(CF.score(model, test, name.removesuffix("_plain")), ML.threshold).select("model", F.lit(state).alias("state"), "recall", "f1")
        rows = m if rows is None else rows.unionByName(m)
    return rows


def _shap(spark, sf_dir):
    fr = _frame(spark, sf_dir)
    model = CF.fit(fr, "logistic_regression", ML)
    return CF.linear_shap(model, fr.filter(F.col("split") == "test"), fr.filter(F.col("split") == "train"))


@register("shap_linear")
def q_shap_linear(spark, sf_dir):
    return _shap(spark, sf_dir)


@register("top_contributions")
def q_top_contributions(spark, sf_dir):
    return CF.top_contributions(_shap(spark, sf_dir), 10)


@register("shap_global")
def q_shap_global(spark, sf_dir):
    return CF.global_importance(_shap(spark, sf_dir))


def _scenario_scores(spark, sf_dir):
    m = master(spark, sf_dir)
    fr = CF.modeling_frame(m)
    model = CF.fit(fr, "logistic_regression", ML)
    sc = SC.clamp_controls(SC.scenario_table(SC.latest_features(m), _deltas(spark)), SC.control_ranges(m))
    feats = SC.feature_row(sc).select(
        "unit_id", F.lit(None).cast("long").alias("week_id"), F.lit("scenario").alias("split"), "scenario",
        *[F.col(c).cast("double").alias(c) for c in CF.FEATURE_NUMERIC], "region", F.lit(None).cast("int").alias("y"))
    out = model.transform(feats)
    from pyspark.ml.functions import vector_to_array

    p = vector_to_array("probability")[1]
    scored = out.select("unit_id", "scenario", p.alias("proba"), (p >= ML.threshold).cast("int").alias("pred"))
    return scored.join(sc.select("unit_id", "scenario", *SC.CONTROLS), ["unit_id", "scenario"])


@register("scenario_scores")
def q_scenario_scores(spark, sf_dir):
    return _scenario_scores(spark, sf_dir).select("unit_id", "scenario", "cases", "proba", "pred")


@register("prediction_log")
def q_prediction_log(spark, sf_dir):
    scores = cut_lineage(_scenario_scores(spark, sf_dir), "scores")
    m = master(spark, sf_dir)
    geo = m.groupBy("unit_id").agg(F.min_by("region", "week_id").alias("region"), F.min_by("district", "week_id").alias("district"),
                                    F.max_by("week", "week_id").alias("last_week"))
    batch = scores.join(geo, "unit_id").select(
        "region", "district", F.col("last_week").alias("week"), F.lit("logistic_regression").alias("model"),
        F.create_map(*[x for c in SC.CONTROLS for x in (F.lit(c), F.round(F.col(c).cast("double"), 3))]).alias("inputs"),
        F.round("proba", 4).alias("probability"),
        F.when(F.col("pred") == 1, F.lit("high")).otherwise(F.lit("low")).alias("prediction"), "unit_id", "scenario",
    )
    return RG.append(RG.empty(spark, QUERY_REGISTRY), batch, QUERY_REGISTRY, STAMP1, ["unit_id", "scenario"])


# ------------------------------------------------------------ sources / sinks
def _scratch(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}/{uuid.uuid4().hex}"


@register("scan_raw_csv", f"""SELECT r.r_name AS region,
  array_to_string(list_transform(string_split(lower(n.n_name), ' '), lambda x: upper(x[1]) || x[2:]), ' ') AS province, s.s_name AS district,
  CASE l.l_returnflag WHEN 'N' THEN '{LABEL_NONE}' WHEN 'A' THEN '{LABEL_WARNING}' WHEN 'R' THEN '{LABEL_SEVERE}' END AS disease,
  CAST(year(l.l_shipdate) AS VARCHAR) AS year, CAST((dayofyear(l.l_shipdate) - 1) // 7 + 1 AS VARCHAR) AS week,
  lpad(CAST(l.l_suppkey AS VARCHAR), CAST(greatest(6, length(CAST(l.l_suppkey AS VARCHAR))) AS INTEGER), '0') AS unit_id,
  CAST(l.l_quantity AS VARCHAR) AS age, CASE l.l_linenumber % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'M' ELSE 'D' END AS age_unit,
  CASE WHEN l.l_linestatus = 'F' THEN 'F' ELSE 'M' END AS sex, CAST(NULL AS VARCHAR) AS locality, CAST(NULL AS VARCHAR) AS diagnostic,
  CAST(NULL AS VARCHAR) AS health_office, CAST(NULL AS VARCHAR) AS locality_code
FROM lineitem l LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""")
def q_scan_raw_csv(spark, sf_dir):
    """Round trip the raw case list through a `;` CSV with a header."""
    path = _scratch(spark, "raw_csv")
    io.write_raw_csv(supplier_cases(spark, sf_dir), path)
    return io.read_raw_csv(spark, path)


@register("write_master", MASTER_SQL + "SELECT split, CAST(count(*) AS BIGINT) AS rows FROM master GROUP BY split")
def q_write_master(spark, sf_dir):
    path = _scratch(spark, "master")
    io.write_master(panel(spark, sf_dir), path)
    return io.read_master(spark, path).groupBy("split").agg(F.count(F.lit(1)).alias("rows"))


@register("scan_master", MASTER_SQL + "SELECT " + ", ".join(
    f"round({c}, 6) AS {c}" if c in ("age_mean", "warn_share", "severe_share", "female_share", "cases_lag_1", "cases_lag_2", "cases_lag_4",
                                     "roll_mean_4", "roll_mean_8", "roll_std_4", "growth", "week_sin", "week_cos", "threshold") else c
    for c in MASTER_COLUMNS) + " FROM master")
def q_scan_master(spark, sf_dir):
    path = _scratch(spark, "master")
    io.write_master(panel(spark, sf_dir), path)
    return round6(io.read_master(spark, path).select(*MASTER_COLUMNS))


def _tree_shap(spark, sf_dir):
    fr = _frame(spark, sf_dir)
    model = _models(spark, fr, ["random_forest"])["random_forest"]
    return CF.tree_shap_values(model, fr.filter(F.col("split") == "test"), _scratch(spark, "models"))


@register("shap_tree")
def q_shap_tree(spark, sf_dir):
    """Tree SHAP of the random forest (class-1 probability) on the test split."""
    return _tree_shap(spark, sf_dir)


@register("shap_tree_global")
def q_shap_tree_global(spark, sf_dir):
    return CF.global_importance(_tree_shap(spark, sf_dir).where("unit_id is not null"))
