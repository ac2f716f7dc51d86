"""Registered queries: unit profiles, clustering, classification metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from weekpanel.operators import cluster as CL
from weekpanel.operators import metrics as ME
from weekpanel.operators import profile as PR
from weekpanel.operators.eda import real_only
from weekpanel.plans.oracle import FEATURES
from weekpanel.schema import BASE_COLUMNS, MASTER_COLUMNS
from weekpanel.session import cut_lineage
from weekpanel.plans.catalog import ADAPTER, MASTER_SQL, SERIES_COLS, master, register, round6

PROFILE_SQL = MASTER_SQL.rstrip() + """,
real AS (SELECT * FROM master WHERE origin = 'real'),
pw AS (
  SELECT unit_id, CAST(arg_max(week, (m, -week)) AS DOUBLE) AS peak_week
  FROM (SELECT unit_id, week, avg(cases) AS m FROM real GROUP BY unit_id, week) GROUP BY unit_id
),
prof0 AS (
  SELECT unit_id, arg_min(region, week_id) AS region, arg_min(district, week_id) AS district,
         avg(cases) AS mean_weekly, quantile_cont(CAST(cases AS DOUBLE), 0.5) AS median_weekly,
         CAST(max(cases) AS DOUBLE) AS max_weekly, stddev_pop(cases) AS std_weekly,
         coalesce(avg(CAST(target AS DOUBLE)), 0.0) AS high_share, avg(growth) AS growth_mean,
         avg(CAST(cases > 0 AS DOUBLE)) AS share_weeks_with_cases
  FROM real GROUP BY unit_id
),
prof AS (
  SELECT p.unit_id, p.region, p.district, coalesce(mean_weekly, 0) AS mean_weekly, coalesce(median_weekly, 0) AS median_weekly,
         coalesce(max_weekly, 0) AS max_weekly, coalesce(std_weekly, 0) AS std_weekly, coalesce(high_share, 0) AS high_share,
         coalesce(growth_mean, 0) AS growth_mean, coalesce(share_weeks_with_cases, 0) AS share_weeks_with_cases,
         coalesce(w.peak_week, 0) AS peak_week
  FROM prof0 p LEFT JOIN pw w ON p.unit_id = w.unit_id
),
lab AS (SELECT unit_id, CAST(ntile(3) OVER (ORDER BY mean_weekly, unit_id) - 1 AS INTEGER) AS cluster FROM prof)
"""

PCOLS = PR.PROFILE_COLS
PROFILE_READS = ["unit_id", "region", "district", "week", "week_id", "cases", "growth", "target", "origin"]


def profile(spark, sf_dir):
    return PR.unit_profile(real_only(master(spark, sf_dir, columns=PROFILE_READS)))


@register("unit_profile", PROFILE_SQL + "SELECT unit_id, region, district, "
          + ", ".join(f"round({c}, 6) AS {c}" for c in PCOLS) + " FROM prof")
def q_unit_profile(spark, sf_dir):
    return round6(profile(spark, sf_dir))


@register("peak_week", PROFILE_SQL + "SELECT unit_id, peak_week FROM pw")
def q_peak_week(spark, sf_dir):
    return PR.peak_week(real_only(master(spark, sf_dir, columns=PROFILE_READS)))


ZS = ", ".join(
    f"round(CASE WHEN stddev_pop({c}) OVER () > 0 THEN ({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () ELSE 0.0 END, 6) AS z_{c}"
    for c in PR.CLUSTER_COLS
)


@register("zscore_profile", PROFILE_SQL + f"SELECT unit_id, {ZS} FROM prof")
def q_zscore_profile(spark, sf_dir):
    z = PR.zscore(profile(spark, sf_dir), PR.CLUSTER_COLS)
    return round6(z.select("unit_id", *[f"z_{c}" for c in PR.CLUSTER_COLS]))


_ZCOLS = [f"z_{c}" for c in PR.CLUSTER_COLS]
_SQD = " + ".join(f"(a.{z} - b.{z}) * (a.{z} - b.{z})" for z in _ZCOLS)


@register("silhouette", PROFILE_SQL.rstrip() + f""",
z AS (SELECT p.unit_id, l.cluster, {ZS.replace('round(', '(').replace(', 6) AS', ') AS')} FROM prof p JOIN lab l ON p.unit_id = l.unit_id),
pairs AS (SELECT a.unit_id, a.cluster AS own, b.cluster AS c, {_SQD} AS d FROM z a JOIN z b ON a.unit_id <> b.unit_id),
sizes AS (SELECT cluster, count(*) AS n FROM lab GROUP BY cluster),
md AS (SELECT unit_id, own, c, avg(d) AS m FROM pairs GROUP BY unit_id, own, c),
ab AS (
  SELECT u.unit_id, u.cluster AS own, s.n AS n_own,
         max(CASE WHEN md.c = u.cluster THEN md.m END) AS a,
         min(CASE WHEN md.c <> u.cluster THEN md.m END) AS b
  FROM lab u JOIN sizes s ON s.cluster = u.cluster LEFT JOIN md ON md.unit_id = u.unit_id
  GROUP BY u.unit_id, u.cluster, s.n
)
SELECT round(avg(CASE WHEN n_own <= 1 OR b IS NULL THEN 0.0 WHEN greatest(a, b) > 0 THEN (b - a) / greatest(a, b) ELSE 0.0 END), 6) AS silhouette
FROM ab""")
def q_silhouette(spark, sf_dir):
    prof = profile(spark, sf_dir)
    lab = PR.intensity_buckets(prof, 3)
    z = PR.zscore(prof, PR.CLUSTER_COLS).join(lab, "unit_id")
    return round6(CL.silhouette(z, _ZCOLS))


@register("cluster_summary", PROFILE_SQL + "SELECT l.cluster, "
          + ", ".join(f"round(avg(p.{c}), 2) AS {c}" for c in PCOLS)
          + ", CAST(count(*) AS BIGINT) AS n_units FROM prof p JOIN lab l ON p.unit_id = l.unit_id GROUP BY l.cluster")
def q_cluster_summary(spark, sf_dir):
    prof = profile(spark, sf_dir)
    return PR.cluster_summary(prof, PR.intensity_buckets(prof, 3))


@register("cluster_labels", PROFILE_SQL.rstrip() + """,
g AS (
  SELECT l.cluster, avg(mean_weekly) AS mean_weekly, avg(max_weekly) AS max_weekly,
         avg(share_weeks_with_cases) AS share_weeks_with_cases, avg(high_share) AS high_share,
         avg(peak_week) AS peak_week, CAST(count(*) AS BIGINT) AS n_units
  FROM prof p JOIN lab l ON p.unit_id = l.unit_id GROUP BY l.cluster
),
lv AS (SELECT *, CAST(row_number() OVER (ORDER BY mean_weekly, cluster) - 1 AS INTEGER) AS level, count(*) OVER () AS n FROM g)
SELECT cluster, round(mean_weekly, 6) AS mean_weekly, round(max_weekly, 6) AS max_weekly,
       round(share_weeks_with_cases, 6) AS share_weeks_with_cases, round(high_share, 6) AS high_share,
       round(peak_week, 6) AS peak_week, n_units, level,
       CASE WHEN (CASE WHEN n = 2 THEN level * 2 ELSE level END) < 4
            THEN ['Transmision esporadica', 'Transmision estacional', 'Transmision alta y sostenida', 'Transmision muy alta'][(CASE WHEN n = 2 THEN level * 2 ELSE level END) + 1]
            ELSE 'Nivel ' || CAST(level AS VARCHAR) END AS name
FROM lv""")
def q_cluster_labels(spark, sf_dir):
    prof = profile(spark, sf_dir)
    return round6(PR.cluster_labels(prof, PR.intensity_buckets(prof, 3)))


@register("cluster_share", PROFILE_SQL + """SELECT l.cluster, round(sum(u.cases) * 100.0 / sum(sum(u.cases)) OVER (), 1) AS share_pct
FROM (SELECT unit_id, sum(cases) AS cases FROM real GROUP BY unit_id) u JOIN lab l ON u.unit_id = l.unit_id GROUP BY l.cluster""")
def q_cluster_share(spark, sf_dir):
    m = real_only(master(spark, sf_dir))
    prof = PR.unit_profile(m)
    return PR.cluster_share(m, PR.intensity_buckets(prof, 3))


def _u(parts: str) -> str:
    return f"((CAST(('0x' || substr(md5(concat_ws('|', {parts}, '42')), 1, 8)) AS UBIGINT) + 0.5) / 4294967296.0)"


_D = range(len(PR.CLUSTER_COLS))


def _points_sql() -> str:
    stats = ", ".join(f"avg({c}) AS m{i}, stddev_pop({c}) AS s{i}" for i, c in enumerate(PR.CLUSTER_COLS))
    zs = ", ".join(f"CASE WHEN s{i} > 0 THEN ({c} - m{i}) / s{i} ELSE 0.0 END" for i, c in enumerate(PR.CLUSTER_COLS))
    return PROFILE_SQL.rstrip() + f""",
zst AS (SELECT {stats} FROM prof),
pt AS (SELECT unit_id, [{zs}] AS v FROM prof, zst)"""


def _square(a: str, b: str) -> str:
    return "(" + " + ".join(f"({a}[{i + 1}] - {b}[{i + 1}]) * ({a}[{i + 1}] - {b}[{i + 1}])" for i in _D) + ")"


def _kmeans_sql(ks: str) -> str:
    """Hashed D^2 starts, Lloyd steps as a recursive query over all runs, the best run of each k: km(k, cs, inertia), klab(k, unit_id, cluster, v)."""
    k_high = ADAPTER.k_max
    steps = ["s1 AS (SELECT k, start, [arg_min(v, (-ln(" + _u("unit_id, CAST(k AS VARCHAR), CAST(start AS VARCHAR), '0'") + "), unit_id))] AS cs FROM runs, pt GROUP BY k, start)"]
    for j in range(1, k_high):
        near = f"list_min(list_transform(cs, lambda c: {_square('v', 'c')}))"
        key = f"CASE WHEN {near} > 0 THEN -ln({_u(f'unit_id, CAST(k AS VARCHAR), CAST(start AS VARCHAR), {chr(39)}{j}{chr(39)}')}) / {near} ELSE CAST('inf' AS DOUBLE) END"
        steps.append(f"s{j + 1} AS (SELECT k, start, list_append(cs, arg_min(v, ({key}, unit_id))) AS cs FROM s{j}, pt WHERE k > {j} GROUP BY k, start, cs"
                     f" UNION ALL SELECT k, start, cs FROM s{j} WHERE k <= {j})")
    mean = ", ".join(f"avg(v[{i + 1}])" for i in _D)
    own = f"list_position(list_transform(cs, lambda c: {_square('v', 'c')}), list_min(list_transform(cs, lambda c: {_square('v', 'c')})))"
    return _points_sql() + f""",
runs AS (SELECT k, start FROM (SELECT CAST(unnest([{ks}]) AS INTEGER) AS k), (SELECT CAST(unnest(range(10)) AS INTEGER) AS start) WHERE k <= (SELECT count(*) FROM pt)),
{", ".join(steps)},
lloyd AS (SELECT * FROM (
  WITH RECURSIVE l(k, start, cs, it, moved) AS (
    SELECT k, start, cs, 0, CAST(1 AS DOUBLE) FROM s{k_high}
    UNION ALL
    SELECT k, start, new, it + 1, list_sum(list_transform(range(1, k + 1), lambda i: {_square("new[i]", "cs[i]")})) FROM (
      SELECT k, start, it, cs, list_transform(range(1, k + 1), lambda i: coalesce(list_filter(ms, lambda m: m.own = i)[1].c, cs[i])) AS new FROM (
        SELECT k, start, it, cs, list({{'own': own, 'c': c}}) AS ms FROM (
          SELECT k, start, it, cs, own, [{mean}] AS c FROM (SELECT k, start, it, cs, v, {own} AS own FROM l, pt WHERE moved > 0.0001 AND it < 300)
          GROUP BY k, start, it, cs, own)
        GROUP BY k, start, it, cs)))
  SELECT k, start, arg_max(cs, it) AS cs FROM l GROUP BY k, start)),
fin AS (SELECT k, start, cs, sum(list_min(list_transform(cs, lambda c: {_square('v', 'c')}))) AS inertia FROM lloyd, pt GROUP BY k, start, cs),
km AS (SELECT k, arg_min(cs, (inertia, start)) AS cs, min(inertia) AS inertia FROM fin GROUP BY k),
klab AS (SELECT k, unit_id, v, CAST({own} - 1 AS INTEGER) AS cluster FROM km, pt)
"""


_SILHOUETTE_SQL = f"""cst AS (SELECT k, cluster, count(*) AS n, sum({" + ".join(f"v[{i + 1}] * v[{i + 1}]" for i in _D)}) AS q, [{", ".join(f"sum(v[{i + 1}])" for i in _D)}] AS s FROM klab GROUP BY k, cluster),
far AS (SELECT klab.k, unit_id, klab.cluster = cst.cluster AS own, n,
          (n * ({" + ".join(f"v[{i + 1}] * v[{i + 1}]" for i in _D)}) - 2 * ({" + ".join(f"v[{i + 1}] * s[{i + 1}]" for i in _D)}) + q)
          / CASE WHEN klab.cluster = cst.cluster THEN nullif(n - 1, 0) ELSE n END AS d FROM klab JOIN cst ON klab.k = cst.k),
ab AS (SELECT k, unit_id, max(d) FILTER (WHERE own) AS a, min(d) FILTER (WHERE NOT own) AS b, max(n) FILTER (WHERE own) AS n FROM far GROUP BY k, unit_id),
sil AS (SELECT k, avg(CASE WHEN n <= 1 OR b IS NULL OR greatest(a, b) <= 0 THEN 0.0 ELSE (b - a) / greatest(a, b) END) AS silhouette FROM ab GROUP BY k)
"""


@register("unit_clusters", _kmeans_sql(str(ADAPTER.k_selected)).rstrip() + """,
lv AS (SELECT cluster, row_number() OVER (ORDER BY m, cluster) - 1 AS level FROM (SELECT cluster, avg(mean_weekly) AS m FROM klab JOIN prof USING (unit_id) GROUP BY cluster))
SELECT unit_id, CAST(level AS INTEGER) AS cluster FROM klab JOIN lv USING (cluster)""")
def q_unit_clusters(spark, sf_dir):
    prof = profile(spark, sf_dir)
    return CL.unit_clusters(prof, k=ADAPTER.k_selected, seed=ADAPTER.seed)


@register("kmeans_sweep", _kmeans_sql(", ".join(str(k) for k in range(ADAPTER.k_min, ADAPTER.k_max + 1))).rstrip() + ",\n" + _SILHOUETTE_SQL
          + "SELECT k, round(inertia, 6) AS inertia, round(silhouette, 6) AS silhouette FROM km JOIN sil USING (k) WHERE k < (SELECT count(*) FROM pt)")
def q_kmeans_sweep(spark, sf_dir):
    return round6(CL.kmeans_sweep(profile(spark, sf_dir), ADAPTER.k_min, ADAPTER.k_max, seed=ADAPTER.seed))


@register("silhouette_euclidean", _kmeans_sql(str(ADAPTER.k_selected)).rstrip() + f""",
pr AS (SELECT a.unit_id, a.cluster AS own, b.cluster AS other, sum(sqrt({_square("a.v", "b.v")})) AS s, count(*) AS n FROM klab a JOIN klab b ON a.k = b.k GROUP BY 1, 2, 3),
ab AS (SELECT unit_id, max(s / nullif(n - 1, 0)) FILTER (WHERE own = other) AS a, min(s / n) FILTER (WHERE own <> other) AS b FROM pr GROUP BY unit_id)
SELECT round(avg(CASE WHEN a IS NULL OR b IS NULL OR greatest(a, b) <= 0 THEN 0.0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette, true AS within_error FROM ab""")
def q_silhouette_euclidean(spark, sf_dir):
    """Euclidean silhouette of the chosen clusters; the cells' bounds lie within twice the stated error."""
    prof = cut_lineage(profile(spark, sf_dir), "profile")
    clusters = CL.unit_clusters(prof, k=ADAPTER.k_selected, seed=ADAPTER.seed)
    s = CL.euclidean_silhouette(clusters.join(CL.scaled(prof), "unit_id"), error=1e-7)
    return s.select(F.round("silhouette", 6).alias("silhouette"), (F.col("most") - F.col("least") < 1e-5).alias("within_error"))


def _pca_sql() -> str:
    """Covariance, then its two first eigenvectors: a symmetric matrix squared and divided by its trace again and
    again goes to v v'; the second comes from what the first leaves."""
    d = len(PR.CLUSTER_COLS)
    ij = [(i, j) for i in range(d) for j in range(i, d)]
    m = lambda i, j: f"m{min(i, j)}{max(i, j)}"
    cov = ", ".join(f"covar_samp(v[{i + 1}], v[{j + 1}]) AS {m(i, j)}" for i, j in ij)
    names = ", ".join(m(i, j) for i, j in ij)
    trace = " + ".join(m(i, i) for i in range(d))
    squared = ", ".join("(" + " + ".join(f"{m(i, h)} * {m(h, j)}" for h in range(d)) + f") AS {m(i, j)}" for i, j in ij)
    power = lambda src: f"""(SELECT * FROM (WITH RECURSIVE p(it, {names}) AS (
      SELECT 0, {", ".join(f"{m(i, j)} / ({trace})" for i, j in ij)} FROM {src}
      UNION ALL SELECT it + 1, {", ".join(f"{m(i, j)} / ({trace})" for i, j in ij)} FROM (SELECT it, {squared} FROM p WHERE it < 50))
      SELECT {names} FROM p WHERE it = 50))"""  # noqa: E731
    column = lambda j: "[" + ", ".join(f"{m(i, j)} / sqrt({m(j, j)})" for i in range(d)) + "]"
    top = lambda j: " AND ".join(f"{m(j, j)} >= {m(h, h)}" for h in range(d) if h != j)
    vector = "CASE " + " ".join(f"WHEN {top(j)} THEN {column(j)}" for j in range(d)) + " END"
    value = lambda c: " + ".join(f"v[{i + 1}] * v[{j + 1}] * {c}.{m(i, j)}" for i in range(d) for j in range(d))
    dot = lambda e: " + ".join(f"v[{i + 1}] * {e}[{i + 1}]" for i in range(d))
    return _points_sql() + f""",
cv AS (SELECT {cov} FROM pt),
e1 AS (SELECT {vector} AS v FROM {power("cv")}),
l1 AS (SELECT {value("cv")} AS l FROM e1, cv),
cv2 AS (SELECT {", ".join(f"cv.{m(i, j)} - l * v[{i + 1}] * v[{j + 1}] AS {m(i, j)}" for i, j in ij)} FROM cv, e1, l1),
e2 AS (SELECT {vector} AS v FROM {power("cv2")}),
l2 AS (SELECT {value("cv")} AS l FROM e2, cv)
SELECT unit_id, round({dot("(SELECT v FROM e1)")}, 6) + 0.0 AS pca_1, round({dot("(SELECT v FROM e2)")}, 6) + 0.0 AS pca_2,
  round((SELECT l FROM l1) / ({trace}), 6) AS explained_1, round((SELECT l FROM l2) / ({trace}), 6) AS explained_2 FROM pt, cv"""


@register("pca_2d", _pca_sql())
def q_pca_2d(spark, sf_dir):
    return round6(CL.pca_2d(profile(spark, sf_dir)))


# ------------------------------------------------------------------ metrics
SCORED_SQL = MASTER_SQL.rstrip() + """,
scored AS (
  SELECT 'ratio_cases' AS model, unit_id, week_id, target AS y, cases / (cases + threshold + 1.0) AS proba
  FROM master WHERE split = 'test' AND target IS NOT NULL
  UNION ALL
  SELECT 'ratio_mean4', unit_id, week_id, target, coalesce(roll_mean_4, 0.0) / (coalesce(roll_mean_4, 0.0) + threshold + 1.0)
  FROM master WHERE split = 'test' AND target IS NOT NULL
),
cm AS (
  SELECT model, CAST(count(*) FILTER (WHERE proba >= 0.5 AND y = 1) AS BIGINT) AS tp,
         CAST(count(*) FILTER (WHERE proba >= 0.5 AND y = 0) AS BIGINT) AS fp,
         CAST(count(*) FILTER (WHERE proba < 0.5 AND y = 0) AS BIGINT) AS tn,
         CAST(count(*) FILTER (WHERE proba < 0.5 AND y = 1) AS BIGINT) AS fn
  FROM scored GROUP BY model
)
"""


def baseline_scores(m):
    """Two deterministic scores on test rows (the metric operators are checked
    on these before any model exists)."""
    t = m.filter((F.col("split") == "test") & F.col("target").isNotNull())
    r4 = F.coalesce(F.col("roll_mean_4"), F.lit(0.0))
    a = t.select(F.lit("ratio_cases").alias("model"), "unit_id", "week_id", F.col("target").alias("y"),
                 (F.col("cases") / (F.col("cases") + F.col("threshold") + 1.0)).alias("proba"))
    b = t.select(F.lit("ratio_mean4").alias("model"), "unit_id", "week_id", F.col("target").alias("y"),
                 (r4 / (r4 + F.col("threshold") + 1.0)).alias("proba"))
    return a.unionByName(b)


def _div(a, b):
    return f"CASE WHEN ({b}) > 0 THEN ({a}) * 1.0 / ({b}) ELSE 0.0 END"


@register("class_metrics", SCORED_SQL + f"""SELECT model, tp, fp, tn, fn,
  round({_div('tp + tn', 'tp + fp + tn + fn')}, 6) AS accuracy, round({_div('tp', 'tp + fp')}, 6) AS precision,
  round({_div('tp', 'tp + fn')}, 6) AS recall, round({_div('2 * tp', '2 * tp + fp + fn')}, 6) AS f1 FROM cm""")
def q_class_metrics(spark, sf_dir):
    return round6(ME.class_metrics(baseline_scores(master(spark, sf_dir)), 0.5))


@register("roc_auc", SCORED_SQL.rstrip() + """,
rk AS (SELECT model, y, rank() OVER (PARTITION BY model ORDER BY proba) + (count(*) OVER (PARTITION BY model, proba) - 1) / 2.0 AS r FROM scored),
auc_agg AS (SELECT model, sum(r) FILTER (WHERE y = 1) AS rs, count(*) FILTER (WHERE y = 1) AS p, count(*) FILTER (WHERE y = 0) AS n FROM rk GROUP BY model)
SELECT model, round(CASE WHEN p > 0 AND n > 0 THEN (rs - p * (p + 1) / 2.0) / (p * n) END, 6) AS auc FROM auc_agg""")
def q_roc_auc(spark, sf_dir):
    return round6(ME.roc_auc(baseline_scores(master(spark, sf_dir))))


@register("per_class_metrics", SCORED_SQL.rstrip() + """,
u AS (SELECT model, 1 AS cls, tp, fp, fn FROM cm UNION ALL SELECT model, 0, tn, fn, fp FROM cm)
SELECT model, cls, """ + f"round({_div('tp', 'tp + fp')}, 6) AS precision, round({_div('tp', 'tp + fn')}, 6) AS recall, "
          f"round({_div('2 * tp', '2 * tp + fp + fn')}, 6) AS f1, CAST(tp + fn AS BIGINT) AS support FROM u")
def q_per_class_metrics(spark, sf_dir):
    return round6(ME.per_class_metrics(baseline_scores(master(spark, sf_dir)), 0.5).withColumn("cls", F.col("cls").cast("int")))


@register("threshold_sweep", SCORED_SQL.rstrip() + """,
th AS (SELECT CAST(unnest([0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS DOUBLE) AS t),
c AS (
  SELECT model, t, count(*) FILTER (WHERE proba >= t AND y = 1) AS tp, count(*) FILTER (WHERE proba >= t AND y = 0) AS fp,
         count(*) FILTER (WHERE proba < t AND y = 1) AS fn
  FROM scored, th GROUP BY model, t
)
SELECT model, round(t, 6) AS threshold, """ + f"round({_div('tp', 'tp + fp')}, 6) AS precision, round({_div('tp', 'tp + fn')}, 6) AS recall, "
          f"round({_div('2 * tp', '2 * tp + fp + fn')}, 6) AS f1, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn FROM c")
def q_threshold_sweep(spark, sf_dir):
    return round6(ME.threshold_sweep(baseline_scores(master(spark, sf_dir))))


@register("best_model", SCORED_SQL + f"""SELECT arg_max(model, ({_div('2 * tp', '2 * tp + fp + fn')}, -CASE model WHEN 'ratio_cases' THEN 1 ELSE 2 END)) AS best_model FROM cm""")
def q_best_model(spark, sf_dir):
    cm = ME.class_metrics(baseline_scores(master(spark, sf_dir)), 0.5)
    return ME.best_by(cm, "f1", "model", ["ratio_cases", "ratio_mean4"])


@register("class_balance", MASTER_SQL + """SELECT CAST(count(*) FILTER (WHERE target = 1) AS BIGINT) AS n_pos,
  CAST(count(*) FILTER (WHERE target = 0) AS BIGINT) AS n_neg,
  round(CASE WHEN count(*) > 0 THEN greatest(count(*) FILTER (WHERE target = 1), count(*) FILTER (WHERE target = 0)) * 1.0 / count(*) ELSE 0.0 END, 6) AS majority_share,
  round(count(*) FILTER (WHERE target = 0) * 1.0 / greatest(count(*) FILTER (WHERE target = 1), 1), 6) AS pos_weight,
  (CASE WHEN count(*) > 0 THEN greatest(count(*) FILTER (WHERE target = 1), count(*) FILTER (WHERE target = 0)) * 1.0 / count(*) ELSE 0.0 END) > 0.8 AS balance
FROM master WHERE split = 'train' AND target IS NOT NULL""")
def q_class_balance(spark, sf_dir):
    m = master(spark, sf_dir).filter((F.col("split") == "train") & F.col("target").isNotNull())
    return round6(ME.class_balance(m.select(F.col("target").alias("y"))))


@register("class_weights", MASTER_SQL.rstrip() + """,
tr AS (SELECT unit_id, week_id, target AS y FROM master WHERE split = 'train' AND target IS NOT NULL),
b AS (SELECT count(*) FILTER (WHERE y = 1) AS n_pos, count(*) FILTER (WHERE y = 0) AS n_neg FROM tr),
bb AS (SELECT *, greatest(n_pos, n_neg) * 1.0 / (n_pos + n_neg) > 0.8 AS bal, n_neg * 1.0 / greatest(n_pos, 1) AS pw FROM b)
SELECT unit_id, week_id, y,
  round(CASE WHEN bal THEN (n_pos + n_neg) / (2.0 * CASE WHEN y = 1 THEN n_pos ELSE n_neg END) ELSE 1.0 END, 6) AS weight_balanced,
  round(CASE WHEN bal AND y = 1 THEN pw ELSE 1.0 END, 6) AS weight_pos
FROM tr, bb""")
def q_class_weights(spark, sf_dir):
    m = master(spark, sf_dir).filter((F.col("split") == "train") & F.col("target").isNotNull())
    return round6(ME.with_class_weights(m.select("unit_id", "week_id", F.col("target").alias("y"))))


@register("balance_pivot", SCORED_SQL.rstrip() + """,
prior AS (SELECT avg(CAST(target AS DOUBLE)) AS p FROM master WHERE split = 'train' AND target IS NOT NULL),
st AS (
  SELECT model, 'without' AS state, count(*) FILTER (WHERE proba >= 0.5 AND y = 1) AS tp, count(*) FILTER (WHERE proba < 0.5 AND y = 1) AS fn FROM scored GROUP BY model
  UNION ALL
  SELECT model, 'with', count(*) FILTER (WHERE proba >= p AND y = 1), count(*) FILTER (WHERE proba < p AND y = 1) FROM scored, prior GROUP BY model
),
rc AS (SELECT model, state, """ + _div("tp", "tp + fn") + """ AS recall FROM st)
SELECT model, round(max(recall) FILTER (WHERE state = 'without'), 6) AS without, round(max(recall) FILTER (WHERE state = 'with'), 6) AS "with",
       round(max(recall) FILTER (WHERE state = 'with') - max(recall) FILTER (WHERE state = 'without'), 6) AS gain
FROM rc GROUP BY model""")
def q_balance_pivot(spark, sf_dir):
    """Recall without / with balancing for the baseline scores. Balanced class
    weights move a calibrated score's decision threshold to the training
    base rate, so 'with' thresholds at the prior."""
    m = master(spark, sf_dir)
    s = baseline_scores(m)
    prior = m.filter((F.col("split") == "train") & F.col("target").isNotNull()).agg(F.avg(F.col("target").cast("double")).alias("p"))
    s2 = s.crossJoin(F.broadcast(prior))
    a = ME.class_metrics(s, 0.5).select("model", F.lit("without").alias("state"), "recall")
    b = ME._rates(ME.confusion(s2, "p")).select("model", F.lit("with").alias("state"), "recall")
    return round6(ME.balance_pivot(a.unionByName(b)))


# --------------------------------------------------------------- forecasting
from weekpanel.operators import eda as _eda  # noqa: E402
from weekpanel.operators import forecast as FC  # noqa: E402
from weekpanel.plans.catalog import SERIES_SQL  # noqa: E402


def real_series(spark, sf_dir):
    return cut_lineage(_eda.weekly_series(real_only(master(spark, sf_dir, columns=SERIES_COLS))), "series")


def _ma_sql(windows) -> str:
    wl = ", ".join(str(int(w)) for w in windows)
    return SERIES_SQL.rstrip() + f""",
pos AS (SELECT *, CAST(row_number() OVER (PARTITION BY level, series_key ORDER BY week_start) - 1 AS INTEGER) AS t,
               CAST(count(*) OVER (PARTITION BY level, series_key) AS INTEGER) AS n FROM series),
st AS (SELECT level, series_key, max(n) AS n, max(cases) AS mx FROM pos GROUP BY 1, 2),
ok AS (SELECT s.level, s.series_key, w.eval_window FROM st s, (SELECT CAST(unnest([{wl}]) AS INTEGER) AS eval_window) w
       WHERE n > eval_window + 8 AND mx > 0),
j AS (SELECT p.*, ok.eval_window FROM pos p JOIN ok ON p.level = ok.level AND p.series_key = ok.series_key),
ma AS (SELECT level, series_key, eval_window, avg(cases) AS pred FROM j
       WHERE t >= n - eval_window - 4 AND t < n - eval_window GROUP BY 1, 2, 3),
test AS (SELECT level, series_key, eval_window, t, cases AS actual FROM j WHERE t >= n - eval_window),
preds AS (SELECT test.*, ma.pred FROM test JOIN ma ON test.level = ma.level AND test.series_key = ma.series_key
          AND test.eval_window = ma.eval_window),
errs AS (SELECT level, series_key, eval_window,
                avg(CASE WHEN actual <> 0 THEN abs((actual - pred) / actual) END) * 100.0 AS mape,
                sqrt(avg((actual - pred) * (actual - pred))) AS rmse FROM preds GROUP BY 1, 2, 3)
"""


@register("ma_forecast", _ma_sql([13]) + "SELECT level, series_key, eval_window, round(pred, 6) AS pred FROM ma")
def q_ma_forecast(spark, sf_dir):
    p = FC.ma_backtest(real_series(spark, sf_dir), [13])
    return round6(p.select(*FC.SERIES, "eval_window", "pred").distinct())


@register("backtest_ma", _ma_sql([13]) + "SELECT level, series_key, eval_window, t, round(actual, 6) AS actual, round(pred, 6) AS pred FROM preds")
def q_backtest_ma(spark, sf_dir):
    p = FC.ma_backtest(real_series(spark, sf_dir), [13])
    return round6(p.select(*FC.SERIES, "eval_window", "t", "actual", "pred"))


@register("forecast_errors", _ma_sql([13]) + "SELECT level, series_key, eval_window, round(mape, 6) AS mape, round(rmse, 6) AS rmse FROM errs")
def q_forecast_errors(spark, sf_dir):
    e = FC.errors(FC.ma_backtest(real_series(spark, sf_dir), [13]))
    return round6(e.select(*FC.SERIES, "eval_window", "mape", "rmse"))


@register("robustness_ma", _ma_sql([8, 13, 26]) + "SELECT level, series_key, eval_window, round(mape, 6) AS mape, round(rmse, 6) AS rmse FROM errs")
def q_robustness_ma(spark, sf_dir):
    e = FC.errors(FC.ma_backtest(real_series(spark, sf_dir), [8, 13, 26]))
    return round6(e.select(*FC.SERIES, "eval_window", "mape", "rmse"))


@register("future_weeks", SERIES_SQL.rstrip() + """,
last AS (SELECT level, series_key, max(week_start) AS d FROM series GROUP BY 1, 2),
yw AS (SELECT level, series_key, CAST(year(d) AS INTEGER) AS y, CAST((dayofyear(d) - 1) // 7 + 1 AS INTEGER) AS w FROM last),
st AS (SELECT level, series_key, y, least(w, 52) - 1 + s AS w0, s AS step FROM yw, (SELECT CAST(unnest([1, 2, 3, 4]) AS INTEGER) AS s))
SELECT level, series_key, step,
       CAST(make_date(CAST(y + w0 // 52 AS INTEGER), 1, 1) + CAST(7 * (w0 % 52) AS INTEGER) AS DATE) AS week_start
FROM st""")
def q_future_weeks(spark, sf_dir):
    return FC.future_weeks(real_series(spark, sf_dir), 4)


@register("hw_forecast")
def q_hw_forecast(spark, sf_dir):
    return FC.forecast_future(real_series(spark, sf_dir), 4)


@register("backtest")
def q_backtest(spark, sf_dir):
    return FC.backtest(real_series(spark, sf_dir), [13])


@register("robustness")
def q_robustness(spark, sf_dir):
    return FC.backtest(real_series(spark, sf_dir), [8, 13, 26])


@register("forecast_display")
def q_forecast_display(spark, sf_dir):
    return FC.display(FC.forecast_future(real_series(spark, sf_dir), 4))


# ------------------------------------------------------------ extension
from weekpanel.operators import extend as XT  # noqa: E402

# the driver's data ends in 2001: the extension runs about 74 weeks beyond it, as far as the default horizon runs beyond the years it is made for
EXT = ADAPTER.replace(extend_to_year=2003, extend_to_week=22, year_intensity=((2002, 0.80), (2003, 0.90)))
_P = EXT


def _normal_sql(parts: str) -> str:
    return f"(sqrt(-2.0 * ln({_u(parts + ', ' + chr(39) + 'n1' + chr(39))})) * cos(2.0 * pi() * {_u(parts + ', ' + chr(39) + 'n2' + chr(39))}))"


EXT_SQL = MASTER_SQL.rstrip() + f""",
lastr AS (SELECT max(year) AS last_year, max(week_id) AS wid0 FROM master),
lastw AS (SELECT max(week) AS w0 FROM master, lastr WHERE year = last_year),
tsteps AS (SELECT last_year AS y0, w0, wid0, unnest(generate_series(1, ({_P.extend_to_year} - last_year) * 52 + ({_P.extend_to_week} - least(w0, 52)))) AS i FROM lastr, lastw),
tcal AS (
  SELECT CAST(y0 + (least(w0, 52) - 1 + i) // 52 AS INTEGER) AS year, CAST((least(w0, 52) - 1 + i) % 52 + 1 AS INTEGER) AS week,
         CAST(wid0 + i AS BIGINT) AS week_id
  FROM tsteps
),
active AS (SELECT DISTINCT unit_id FROM master, lastr WHERE year >= last_year - {_P.active_years - 1}),
inwin AS (SELECT DISTINCT unit_id FROM master, lastr WHERE year >= last_year - {_P.lookback_years - 1}),
pool AS (
  SELECT m.unit_id, m.year AS p_year, m.week AS p_week, m.week_id AS p_week_id, m.cases AS p_cases,
         m.age_mean AS p_age_mean, m.warn_share AS p_warn_share, m.severe_share AS p_severe_share, m.female_share AS p_female_share,
         pow({_P.recency_decay}, CAST(last_year - m.year AS DOUBLE)) AS weight
  FROM master m, lastr
  WHERE m.year >= last_year - {_P.lookback_years - 1} OR m.unit_id NOT IN (SELECT unit_id FROM inwin)
),
tg AS (SELECT a.unit_id, c.year, c.week, c.week_id FROM active a, tcal c),
band AS (
  SELECT t.unit_id, t.year, t.week, t.week_id, p.* EXCLUDE (unit_id) FROM tg t JOIN pool p
  ON p.unit_id = t.unit_id AND least(abs(p.p_week - t.week), 52 - abs(p.p_week - t.week)) <= {_P.band_weeks}
),
hit AS (SELECT DISTINCT unit_id, week_id FROM band),
fb AS (
  SELECT t.unit_id, t.year, t.week, t.week_id, p.* EXCLUDE (unit_id) FROM tg t JOIN pool p ON p.unit_id = t.unit_id
  WHERE NOT EXISTS (SELECT 1 FROM hit h WHERE h.unit_id = t.unit_id AND h.week_id = t.week_id)
),
cand AS (SELECT * FROM band UNION ALL SELECT * FROM fb),
keyed AS (SELECT *, -ln({_u("unit_id, CAST(week_id AS VARCHAR), CAST(p_week_id AS VARCHAR)")}) / weight AS k FROM cand),
drawn AS (
  SELECT unit_id, year, week, week_id, d.w AS p_week_id, d.c AS p_cases, d.a AS p_age_mean, d.ws AS p_warn_share,
         d.ss AS p_severe_share, d.fs AS p_female_share
  FROM (SELECT unit_id, year, week, week_id,
               arg_min({{'w': p_week_id, 'c': p_cases, 'a': p_age_mean, 'ws': p_warn_share, 'ss': p_severe_share,
                        'fs': p_female_share}}, (k, p_week_id)) AS d
        FROM keyed GROUP BY unit_id, year, week, week_id)
),
eps AS (
  SELECT unit_id, week_id, row_number() OVER (PARTITION BY unit_id ORDER BY week_id) AS rn,
         {_normal_sql("unit_id, CAST(week_id AS VARCHAR)")} * {_P.noise_sigma * (1 - _P.ar_rho ** 2) ** 0.5!r} AS e
  FROM tg
),
x0 AS (SELECT unit_id, {_normal_sql("unit_id, '-1'")} * {_P.noise_sigma!r} AS x0 FROM active),
ar AS (SELECT * FROM (
  WITH RECURSIVE rec(unit_id, rn, week_id, log_f) AS (
    SELECT e.unit_id, e.rn, e.week_id, {_P.ar_rho!r} * x0.x0 + e.e FROM eps e JOIN x0 ON e.unit_id = x0.unit_id WHERE e.rn = 1
    UNION ALL
    SELECT e.unit_id, e.rn, e.week_id, {_P.ar_rho!r} * rec.log_f + e.e FROM rec JOIN eps e ON e.unit_id = rec.unit_id AND e.rn = rec.rn + 1
  ) SELECT unit_id, week_id, log_f FROM rec)
),
based AS (
  SELECT d.*, p_cases * coalesce(CASE year {' '.join(f'WHEN {y} THEN {f!r}' for y, f in _P.year_intensity)} END, 1.0) AS base FROM drawn d
),
smoothed AS (SELECT *, avg(base) OVER (PARTITION BY unit_id ORDER BY week_id ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS smooth FROM based),
firstgeo AS (SELECT unit_id, arg_min(region, week_id) AS region, arg_min(province, week_id) AS province, arg_min(district, week_id) AS district FROM master GROUP BY unit_id),
sim0 AS (
  SELECT s.*, CAST(greatest(round_even(s.smooth * exp(a.log_f), 0), 0) AS BIGINT) AS cases
  FROM smoothed s JOIN ar a ON s.unit_id = a.unit_id AND s.week_id = a.week_id
),
sim AS (
  SELECT s.unit_id, g.region, g.province, g.district, s.year, s.week,
         CAST(make_date(s.year, 1, 1) + CAST(7 * (s.week - 1) AS INTEGER) AS DATE) AS week_start, s.week_id, s.cases,
         CASE WHEN s.cases > 0 THEN p_age_mean END AS age_mean, CASE WHEN s.cases > 0 THEN p_warn_share END AS warn_share,
         CASE WHEN s.cases > 0 THEN p_severe_share END AS severe_share, CASE WHEN s.cases > 0 THEN p_female_share END AS female_share,
         'simulated' AS origin
  FROM sim0 s LEFT JOIN firstgeo g ON s.unit_id = g.unit_id
)
"""


def _real(spark, sf_dir):
    return master(spark, sf_dir, columns=[*BASE_COLUMNS, "origin"])


@register("target_calendar", EXT_SQL + "SELECT year, week, week_id, CAST(make_date(year, 1, 1) + CAST(7 * (week - 1) AS INTEGER) AS DATE) AS week_start FROM tcal")
def q_target_calendar(spark, sf_dir):
    return XT.target_calendar(_real(spark, sf_dir), EXT)


@register("active_units", EXT_SQL + "SELECT unit_id FROM active")
def q_active_units(spark, sf_dir):
    return XT.active_units(_real(spark, sf_dir), EXT)


@register("seasonal_pool", EXT_SQL + "SELECT unit_id, week_id, CAST(count(*) AS BIGINT) AS n_candidates, round(sum(weight), 6) AS weight_sum FROM cand GROUP BY unit_id, week_id")
def q_seasonal_pool(spark, sf_dir):
    real = _real(spark, sf_dir)
    return round6(XT.pool_sizes(XT.targets(real, EXT), *XT.candidate_arrays(XT.pool(real, EXT), EXT)))


@register("weighted_draw", EXT_SQL + "SELECT unit_id, week_id, p_week_id AS drawn_week_id, p_cases AS drawn_cases FROM drawn")
def q_weighted_draw(spark, sf_dir):
    real = _real(spark, sf_dir)
    d = XT.weighted_draw(XT.candidates(XT.targets(real, EXT), XT.pool(real, EXT), EXT), EXT)
    return d.select("unit_id", "week_id", F.col("p_week_id").alias("drawn_week_id"), F.col("p_cases").alias("drawn_cases"))


@register("ar1_path", EXT_SQL + "SELECT unit_id, week_id, round(log_f, 6) AS log_f FROM ar")
def q_ar1_path(spark, sf_dir):
    return round6(XT.ar1_path(XT.targets(_real(spark, sf_dir), EXT), EXT))


@register("bootstrap_extend", EXT_SQL + "SELECT unit_id, region, province, district, year, week, week_start, week_id, cases, "
          "round(age_mean, 6) AS age_mean, round(warn_share, 6) AS warn_share, round(severe_share, 6) AS severe_share, "
          "round(female_share, 6) AS female_share, origin FROM sim")
def q_bootstrap_extend(spark, sf_dir):
    return round6(XT.simulate(_real(spark, sf_dir), EXT))


@register("extension_summary", EXT_SQL + """SELECT CAST((SELECT count(*) FROM sim) AS BIGINT) AS simulated_rows,
  CAST((SELECT count(*) FROM master) AS BIGINT) AS real_rows, CAST((SELECT count(DISTINCT unit_id) FROM sim) AS BIGINT) AS simulated_units,
  CAST((SELECT coalesce(sum(cases), 0) FROM sim) AS BIGINT) AS simulated_cases, (SELECT min(week_start) FROM sim) AS simulated_from,
  (SELECT max(week_start) FROM sim) AS simulated_to, (SELECT max(year) FROM master) AS last_real_year,
  (SELECT count(*) > 0 FROM sim) AS has_simulation,
  CASE WHEN (SELECT count(*) > 0 FROM sim) THEN (SELECT max(week_start) FROM master) END AS cut_date""")
def q_extension_summary(spark, sf_dir):
    return XT.extension_summary(XT.extend_panel(_real(spark, sf_dir), EXT))


_BASE = "unit_id, region, province, district, year, week, week_start, week_id, cases, age_mean, warn_share, severe_share, female_share, origin"
EXTENDED_SQL = EXT_SQL.rstrip() + f""",
both_rows AS (SELECT {_BASE} FROM master UNION ALL SELECT {_BASE} FROM sim),
{FEATURES.strip().replace("feat AS", "feat2 AS").replace("'real' AS origin", "1 AS one").replace("FROM hist", "FROM both_rows")},
yrs2 AS (SELECT year, dense_rank() OVER (ORDER BY year DESC) AS r FROM (SELECT DISTINCT year FROM feat2 WHERE origin = 'real')),
with_split2 AS (
  SELECT f.* EXCLUDE (one), CASE WHEN f.origin = 'simulated' THEN 'simulated' WHEN r <= 1 THEN 'test' WHEN r <= 2 THEN 'val' ELSE 'train' END AS split
  FROM feat2 f LEFT JOIN yrs2 y ON f.year = y.year),
thr2 AS (SELECT unit_id, quantile_cont(cases, 0.75) AS threshold FROM with_split2 WHERE split = 'train' GROUP BY unit_id),
extended AS (
  SELECT w.*, t.threshold, CASE WHEN lead(origin, 1) OVER (PARTITION BY w.unit_id ORDER BY week_id) = origin
    THEN CAST(lead(cases, 1) OVER (PARTITION BY w.unit_id ORDER BY week_id) > t.threshold AS INTEGER) END AS target
  FROM with_split2 w LEFT JOIN thr2 t ON w.unit_id = t.unit_id)
"""
_DOUBLES = ("age_mean", "warn_share", "severe_share", "female_share", "cases_lag_1", "cases_lag_2", "cases_lag_4", "roll_mean_4", "roll_mean_8", "roll_std_4",
            "growth", "week_sin", "week_cos", "threshold")


@register("extend_panel", EXTENDED_SQL + "SELECT " + ", ".join(f"round({c}, 6) AS {c}" if c in _DOUBLES else c for c in MASTER_COLUMNS) + " FROM extended")
def q_extend_panel(spark, sf_dir):
    return round6(XT.extend_panel(_real(spark, sf_dir), EXT))


@register("series_segments", EXTENDED_SQL.rstrip() + """,
cut AS (SELECT CASE WHEN (SELECT count(*) > 0 FROM sim) THEN max(week_start) END AS d FROM master),
nat AS (SELECT 'national' AS level, 'ALL' AS series_key, week_start, CAST(sum(cases) AS DOUBLE) AS cases FROM extended GROUP BY week_start)
SELECT nat.*, 'observed' AS segment FROM nat, cut WHERE week_start <= d
UNION ALL SELECT nat.*, 'projected' FROM nat, cut WHERE week_start >= d""")
def q_series_segments(spark, sf_dir):
    # the extended panel feeds two branches: materialise it once
    ext = cut_lineage(XT.extend_panel(_real(spark, sf_dir), EXT).select("year", *SERIES_COLS), "extended_panel")
    cut = F.broadcast(XT.extension_summary(ext).select("cut_date"))  # one row
    national = _eda.weekly_series(ext, ("national",))
    return XT.series_segments(national.crossJoin(cut))
