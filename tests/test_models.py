"""Boosting, logistic regression, K-means, PCA and smoothing against plain versions."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from weekpanel.operators import cluster as CL
from weekpanel.operators import newton as NW
from weekpanel.operators import smoothing as S
from weekpanel.operators.logistic import fit_logistic

XYW = "x array<double>, y int, w double"


def labelled(n=700, seed=3):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 3)), 1)
    x[:, 2] = rng.integers(0, 2, n)
    y = (x[:, 0] * (1 + x[:, 2]) - 0.5 * x[:, 1] + rng.normal(size=n) > 0.3).astype(int)
    return x, y, np.where(y == 1, 2.0, 1.0)


def table(spark, x, y, w, parts=3):
    return spark.createDataFrame([(r.tolist(), int(a), float(b)) for r, a, b in zip(x, y, w, strict=True)], XYW).repartition(parts)


def plain_boost(x, y, w, rounds, depth, rate=0.1, l2=1.0, min_child=1.0):
    """Margins of second-order boosting with every distinct value as a cut."""
    share = (w * y).sum() / w.sum()
    margin = np.full(len(y), np.log(share / (1 - share)))

    def grow(rows, level):
        p = 1 / (1 + np.exp(-margin[rows]))
        g, h = w[rows] * (p - y[rows]), w[rows] * p * (1 - p)
        best = (1e-9, None)
        for j in range(x.shape[1]) if level < depth else ():
            for c in np.unique(x[:, j])[:-1]:
                left = x[rows, j] <= c
                hl, hr = h[left].sum(), h[~left].sum()
                if hl >= min_child and hr >= min_child:
                    gain = g[left].sum() ** 2 / (hl + l2) + g[~left].sum() ** 2 / (hr + l2) - g.sum() ** 2 / (h.sum() + l2)
                    if gain > best[0] + 1e-7:
                        best = (gain, (j, c))
        if best[1] is None:
            return [(rows, -rate * g.sum() / (h.sum() + l2))]
        left = x[rows, best[1][0]] <= best[1][1]
        return grow(rows[left], level + 1) + grow(rows[~left], level + 1)

    for _ in range(rounds):
        for rows, value in grow(np.arange(len(y)), 0):
            margin[rows] += value
    return margin


def test_newton_boosting_equals_a_plain_version(spark, monkeypatch):
    monkeypatch.setattr(NW, "BLOCK_ROWS", 90)
    x, y, w = labelled()
    model = NW.fit_newton(table(spark, x, y, w), rounds=4, depth=3)
    got = model.base + model.forest.margin(x, model.forest.threshold)
    assert np.abs(got - plain_boost(x, y, w, 4, 3)).max() < 1e-5
    assert all(b < a for a, b in zip(model.loss, model.loss[1:], strict=False)) and len(model.loss) == 5
    # the same model whatever the partitions, and when Spark sums the histograms
    for other in (NW.fit_newton(table(spark, x, y, w, 7), rounds=4, depth=3), NW.fit_newton(table(spark, x, y, w), rounds=4, depth=3, direct_bytes=0)):
        assert other.numbers() == model.numbers()


def test_newton_workers_remember_the_margins_of_their_blocks(spark):
    NW.fit_newton(table(spark, *labelled()), rounds=3, depth=2)

    def remembered(_):
        from weekpanel.operators import newton

        return [trees for trees, _ in newton._MEMORY.known.values()]

    seen = spark.sparkContext.parallelize(range(32), 32).flatMap(remembered).collect()
    assert 3 in seen  # the last job's workers know the margins of all three trees


def test_newton_model_scores_saves_and_explains(spark, tmp_path):
    from pyspark.ml.functions import array_to_vector

    from weekpanel.operators.treeshap import expected_value, explain_rows

    x, y, w = labelled(300)
    rows = table(spark, x, y, w).withColumn("features", array_to_vector("x"))
    model = NW.fit_newton(rows, rounds=5, depth=4)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = NW.NewtonModel.load(str(tmp_path / "m"))
    scored = model.transform(rows).select("x", "margin", F.expr("prediction")).collect()
    same = again.transform(rows).select("x", "margin").collect()
    assert [r.margin for r in scored] == [r.margin for r in same] and again.loss == model.loss
    at = np.array([r.x for r in scored])
    total = model.base + sum(expected_value(t) for t in model.trees()) + explain_rows(model.trees(), at).sum(1)
    assert np.abs(total - [r.margin for r in scored]).max() < 1e-9


def test_newton_without_rows_or_with_one_class(spark):
    x, y, w = labelled(50)
    assert len(NW.fit_newton(table(spark, x, y, w).limit(0)).forest.feature) == 0
    assert NW.fit_newton(table(spark, x, np.ones(50), w)).base == 20.0
    nothing = spark.createDataFrame([(None, 1, 1.0), ([1.0], None, 1.0)], XYW)
    assert NW.fit_newton(nothing).numbers()["feature"] == []


def test_logistic_solves_the_score_equations(spark):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    x, y, w = labelled(500)
    rows = table(spark, x, y, w).cache()
    model = fit_logistic(rows, l2=2.0)
    beta = np.append(model.coefficients, model.intercept)
    design = np.hstack((x, np.ones((len(x), 1))))
    score = design.T @ (w * (1 / (1 + np.exp(-design @ beta)) - y)) + 2.0 * np.append(model.coefficients, 0)
    assert np.abs(score).max() / w.sum() < 1e-9 and model.score < 1e-10
    theirs = LogisticRegression(labelCol="y", weightCol="w", regParam=2.0 / w.sum(), standardization=False, tol=1e-12, maxIter=500).fit(rows.withColumn("features", array_to_vector("x")))
    assert np.abs(np.append(np.asarray(theirs.coefficients), theirs.intercept) - beta).max() < 1e-4
    assert fit_logistic(rows.limit(0)).intercept == 0.0
    apart = spark.createDataFrame([([float(i)], int(i > 5), 1.0) for i in range(10)], XYW)  # separable: the penalty holds it
    assert fit_logistic(apart).score < 1e-10


def test_kmeans_runs_equal_plain_lloyd(spark):
    rng = np.random.default_rng(5)
    x = np.vstack([rng.normal(c, 0.3, size=(20, 2)) for c in ((0, 0), (3, 0), (0, 3))])
    x = np.vstack([x, x[:3]])  # repeated units
    points = spark.createDataFrame([(f"u{i:03d}", r.tolist()) for i, r in enumerate(x)], "unit_id string, v array<double>").repartition(4).cache()
    starts = CL.seeds(points, [2, 3, 4], 3, 42)
    got = CL.kmeans_runs(points, [2, 3, 4], 3, 42)
    for s, r in zip(starts, got, strict=True):
        centres = s.centres.copy()
        for _ in range(300):
            own = ((x[:, None] - centres[None]) ** 2).sum(2).argmin(1)
            to = np.array([x[own == i].mean(0) if (own == i).any() else centres[i] for i in range(s.k)])
            moved, centres = ((to - centres) ** 2).sum(), to
            if moved <= 1e-4:
                break
        assert np.abs(centres - r.centres).max() < 1e-9
        assert abs(((x[:, None] - centres[None]) ** 2).sum(2).min(1).sum() - r.inertia) < 1e-9
    best = CL.best_runs(got)
    assert best[3].inertia < 20 and all(best[r.k].inertia <= r.inertia for r in got)
    labels = CL.assigned(points, [best[2], best[3]])
    sil = {r.k: r.silhouette for r in CL.silhouettes(labels).collect()}
    for k in (2, 3):
        one = labels.where(F.col("k") == k).select("unit_id", "cluster", F.col("v")[0].alias("a"), F.col("v")[1].alias("b"))
        assert abs(CL.silhouette(one, ["a", "b"]).first()[0] - sil[k]) < 1e-9
    assert sil[3] > sil[2]


@pytest.mark.parametrize("error,max_cells", [(0.0, 5000), (0.05, 5000), (0.3, 5000), (0.05, 12)])
def test_euclidean_silhouette_is_within_its_bounds(spark, error, max_cells):
    rng = np.random.default_rng(6)
    x = np.round(np.vstack([rng.normal(c, 0.7, size=(330, 2)) for c in ((0, 0), (3, 1), (0, 4))] + [[[9.0, 9.0]]]), 2)
    own = np.repeat([0, 1, 2, 5], [330, 330, 330, 1])
    df = spark.createDataFrame([(f"u{i}", int(c), r.tolist()) for i, (r, c) in enumerate(zip(x, own, strict=True))], "unit_id string, cluster int, v array<double>").repartition(3)
    dist = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    want = []
    for i, c in enumerate(own):
        mates = (own == c).sum() - 1
        if not mates:
            want.append(0.0)
            continue
        a, b = dist[i, own == c].sum() / mates, min(dist[i, own == o].mean() for o in set(own.tolist()) - {c})
        want.append((b - a) / max(a, b))
    got = CL.euclidean_silhouette(df, error, max_cells).first()
    assert got.least - 1e-9 <= np.mean(want) <= got.most + 1e-9 and got.least <= got.silhouette <= got.most
    if max_cells > 12:
        assert got.most - got.least <= 2.5 * error + 1e-9 and abs(got.silhouette - np.mean(want)) <= error / 5 + 1e-9


def test_euclidean_silhouette_is_as_exact_with_cells_in_many_blocks(spark):
    rng = np.random.default_rng(8)
    x, own = rng.normal(size=(150, 3)), np.repeat([0, 1, 4], 50)
    x += own[:, None]
    df = spark.createDataFrame([(f"u{i}", int(c), r.tolist()) for i, (r, c) in enumerate(zip(x, own, strict=True))], "unit_id string, cluster int, v array<double>").repartition(3)
    dist = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    a = np.array([dist[i, own == c].sum() / 49 for i, c in enumerate(own)])
    b = np.array([min(dist[i, own == o].mean() for o in {0, 1, 4} - {c}) for i, c in enumerate(own)])
    want = ((b - a) / np.maximum(a, b)).mean()
    # 150 cells, 40 of them at a time; before, the second number was the most cells there could be and the result was off
    for got in (CL.euclidean_silhouette(df, 1e-7, 40).first(), CL.euclidean_silhouette(df, 1e-7).first()):
        assert abs(got.silhouette - want) < 1e-9 and got.most - got.least < 1e-6


def test_euclidean_silhouette_of_little(spark):
    df = spark.createDataFrame([("a", 0, [0.0]), ("b", 0, [0.0])], "unit_id string, cluster int, v array<double>")
    assert CL.euclidean_silhouette(df.limit(0)).first().silhouette is None
    assert CL.euclidean_silhouette(df).first().silhouette == 0.0


def test_starts_with_fewer_points_than_clusters(spark):
    points = spark.createDataFrame([("a", [0.0]), ("b", [0.0]), ("c", [1.0])], "unit_id string, v array<double>")
    runs = CL.kmeans_runs(points, [3], 2, 1)
    assert all(len(r.centres) == 3 and r.inertia == 0.0 for r in runs)


def test_jacobi_equals_the_library():
    rng = np.random.default_rng(2)
    for d in (1, 2, 5, 8):
        a = rng.normal(size=(d, d + 2))
        a = a @ a.T
        values, vectors = CL.jacobi(a)
        assert np.allclose(values, np.linalg.eigvalsh(a)[::-1]) and np.allclose(a @ vectors, vectors * values)
    assert CL.jacobi(np.diag([1.0, 2.0]))[0].tolist() == [2.0, 1.0]


def plain_smoothing(y, alpha, beta, gamma, phi, period, seasonal):
    """(sum of squared errors, level, trend, season) of one series."""
    if seasonal:
        level, season = y[:period].mean(), y[:period] - y[:period].mean()
        trend = (y[period : 2 * period].mean() - level) / period
    else:
        level, trend, season = y[0], (y[1] - y[0] if len(y) > 1 else 0.0), np.zeros(period)
    sse = 0.0
    for t, v in enumerate(y):
        s = season[t % period]
        e = v - (level + phi * trend + s)
        sse += e * e
        new = alpha * (v - s) + (1 - alpha) * (level + phi * trend)
        trend = beta * (new - level) + (1 - beta) * phi * trend
        if seasonal:
            season[t % period] = gamma * (v - new) + (1 - gamma) * s
        level = new
    return sse, level, trend, season


def weekly(lengths, seed=1):
    rng = np.random.default_rng(seed)
    out = []
    for n in lengths:
        t = np.arange(n)
        rate = np.exp(rng.normal(1.5, 1) + 0.8 * np.sin(2 * np.pi * (t + rng.integers(52)) / 52) + np.cumsum(rng.normal(0, 0.1, n)))
        out.append(rng.poisson(np.clip(rate, 0, 1e4)).astype(float))
    return out


@pytest.mark.parametrize("seasonal,lengths", [(True, [160, 131, 104]), (False, [103, 60, 7, 2, 1])])
def test_recursion_of_many_series_equals_one_by_one(seasonal, lengths):
    ys = [np.log1p(v) for v in weekly(lengths)]
    y = np.zeros((len(ys), lengths[0]))
    for i, v in enumerate(ys):
        y[i, : len(v)] = v
    sets = np.array([(0.3, 0.1, 0.2 * seasonal, 0.9), (0.9, 0.01, 0.05 * seasonal, 0.8)])
    level, trend, season, sse, _ = S.recursion(y, np.array(lengths), np.repeat(sets[:, None], len(ys), 1), 52, seasonal)
    for c, i in itertools.product(range(2), range(len(ys))):
        want = plain_smoothing(ys[i], *sets[c], 52, seasonal)
        assert np.allclose((sse[c, i], level[c, i], trend[c, i]), want[:3])
        if seasonal:
            assert np.allclose(season[:, c, i], want[3])


def test_simplex_is_never_above_a_fine_grid():
    fine = {True: itertools.product(np.linspace(0.05, 0.95, 7), (0.01, 0.05, 0.2), (0.01, 0.05, 0.1, 0.3), (0.8, 0.9, 0.98)),
            False: itertools.product(np.linspace(0.05, 0.95, 10), (0.01, 0.05, 0.1, 0.2), (0.0,), (0.8, 0.9, 0.98))}
    for seasonal, n in ((True, 150), (False, 70)):
        y = np.array([np.log1p(v) for v in weekly([n] * 24, 7)])
        fit = S.fit_group(y, np.full(len(y), n), 52, seasonal)
        grid = np.array(list(fine[seasonal]))
        sse = S.recursion(y, np.full(len(y), n), np.repeat(grid[:, None], len(y), 1), 52, seasonal)[3].min(0)
        assert (fit.sse <= sse * (1 + 1e-9)).all() and (fit.sse < 0.999 * sse).any()
        again = S.recursion(y, np.full(len(y), n), fit.params[None], 52, seasonal)[3][0]
        assert np.allclose(again, fit.sse)


def test_forecasts_do_not_depend_on_the_company_of_a_series():
    ys = weekly([150, 30, 104, 30, 5, 0, 1])
    together = S.forecast_counts(ys, 4)
    for i, y in enumerate(ys):
        alone = S.forecast_counts([y], 4)
        for a, b in zip(alone, together, strict=True):
            assert np.allclose(a[0], b[i], rtol=1e-6, atol=1e-9)
    point, low, high = together
    assert (low >= 0).all() and (low <= point + 1e-12).all() and (point <= high + 1e-12).all()


def test_models_are_built_once_and_reused(spark, tmp_path, monkeypatch):
    from weekpanel.operators import classify as CF
    from weekpanel.params import Params
    from weekpanel.plans.models import build_or_reuse
    from weekpanel.schema import FEATURE_NUMERIC

    rng = np.random.default_rng(4)
    rows = [(f"u{i % 9}", i, "train" if i % 3 else "test", *[float(v) for v in rng.normal(size=len(FEATURE_NUMERIC)).round(2)], f"r{i % 4}", int(rng.random() < 0.3)) for i in range(300)]
    fr = spark.createDataFrame(rows, "unit_id string, week_id long, split string, " + ", ".join(f"{c} double" for c in FEATURE_NUMERIC) + ", region string, y int")
    small = Params(rf_trees=3, rf_depth=3, boost_rounds=3)
    first = build_or_reuse(fr, str(tmp_path), params=small)
    assert list(first) == CF.MODELS
    scores = {n: CF.score(m, fr, n).agg(F.sum("proba")).first()[0] for n, m in first.items()}
    fits = []
    real = CF.fit_models
    monkeypatch.setattr(CF, "fit_models", lambda frame, names, params: fits.append(list(names)) or real(frame, names, params))
    for n, m in build_or_reuse(fr, str(tmp_path), params=small).items():
        assert abs(CF.score(m, fr, n).agg(F.sum("proba")).first()[0] - scores[n]) < 1e-9
    assert fits == []
    build_or_reuse(fr, str(tmp_path), ["xgboost_plain", "xgboost"], small)
    build_or_reuse(fr.where("week_id > 9"), str(tmp_path), ["decision_tree"], small)
    assert fits == [["xgboost_plain"], ["decision_tree"]]


def test_tree_shap_merges_rows_and_keeps_shapley_values(monkeypatch):
    from itertools import permutations

    from weekpanel.operators import treeshap as TS

    # x0 <= 1 (else leaf 3): category of x1 in {0} (else x2 <= 0.5): then x0 <= 0
    tree = TS.Tree(np.array([1, 3, -1, 5, 7, -1, -1, -1, -1]), np.array([2, 4, -1, 6, 8, -1, -1, -1, -1]), np.array([0, 1, -1, 0, 2, -1, -1, -1, -1]),
                   np.array([1.0, 0, 0, 0.0, 0.5, 0, 0, 0, 0]), [None, np.array([0.0])] + [None] * 7, np.array([0, 0, 3.0, 0, 0, 1.0, -2.0, 5.0, 0.5]),
                   np.array([100.0, 60, 40, 35, 25, 20, 15, 10, 15]), 0.5)
    rng = np.random.default_rng(3)
    x = np.column_stack((rng.normal(0.5, 1, 2000), rng.integers(0, 2, 2000), rng.random(2000), rng.random(2000)))
    sizes, real = [], TS._patterns
    monkeypatch.setattr(TS, "_patterns", lambda follows: sizes.append(len(follows)) or real(follows))
    phi = TS.tree_phi(tree, x)
    assert max(sizes) <= 16  # before: every row at every leaf

    def mean(row, known, node=0):
        if tree.left[node] < 0:
            return tree.value[node]
        if tree.feature[node] in known:
            return mean(row, known, tree.left[node] if tree.goes_left(node, row[None])[0] else tree.right[node])
        return sum(tree.cover[c] * mean(row, known, c) for c in (tree.left[node], tree.right[node])) / tree.cover[node]

    for i in range(25):
        want = np.zeros(4)
        for order in permutations(range(4)):
            for k, f in enumerate(order):
                want[f] += (mean(x[i], order[: k + 1]) - mean(x[i], order[:k])) / 24
        assert np.abs(phi[i] - 0.5 * want).max() < 1e-12


def test_saved_and_loaded_model_are_scored_in_one_pass(spark, tmp_path):
    from tests.fixtures import raw_cases
    from weekpanel.operators import classify as CF
    from weekpanel.params import Params
    from weekpanel.plans.master import build_master
    from weekpanel.sources import io

    params = Params(min_history_weeks=10, tree_depth=3, tree_min_leaf=2)
    frame = CF.modeling_frame(build_master(raw_cases(spark), params, columns=CF.FRAME_READS)).localCheckpoint()
    assert CF.prepare(frame, params, ["decision_tree"])[1].columns == ["features", "y", "weight_balanced", "weight_pos"]
    assert CF.prepare(frame, params, ["xgboost"])[1].columns == ["x", "y", "weight_balanced", "weight_pos"]
    model = CF.fit(frame, "decision_tree", params)
    io.save_model(model, str(tmp_path / "tree"))
    other = CF.fit(frame, "decision_tree", params.replace(tree_depth=1))
    for second, same in ((io.load_model(str(tmp_path / "tree")), True), (other, False)):
        a = CF.score(model, frame, "a", keep=CF.FEATURES).withColumnRenamed("proba", "p")
        both = CF.score(second, a, "b", keep=["p"])
        assert "Join" not in both._jdf.queryExecution().optimizedPlan().toString()
        alone = {(r.unit_id, r.week_id): r.proba for r in CF.score(second, frame, "b").collect()}
        rows = both.collect()
        assert len(rows) == frame.count() and all(alone[r.unit_id, r.week_id] == r.proba for r in rows)
        assert all(r.p == r.proba for r in rows) == same


def test_boosters_are_compared_at_full_rounds(spark, monkeypatch):
    from weekpanel.operators import classify as CF
    from weekpanel.plans import model_queries as MQ
    from weekpanel.plans import table_queries as TQ
    from weekpanel.schema import FEATURE_NUMERIC

    rng = np.random.default_rng(7)
    rows = [(f"u{i % 9}", i, "train", *[float(v) for v in rng.normal(size=len(FEATURE_NUMERIC)).round(2)], f"r{i % 4}") for i in range(300)]
    rows = [(*r, int(r[3] + r[4] + rng.normal() > 1)) for r in rows]
    fr = spark.createDataFrame(rows, "unit_id string, week_id long, split string, " + ", ".join(f"{c} double" for c in FEATURE_NUMERIC) + ", region string, y int")
    params = MQ.ADAPTER.replace(boost_rounds=7)
    monkeypatch.setattr(MQ, "ADAPTER", params)
    monkeypatch.setattr(TQ, "ML", params)
    monkeypatch.setattr(TQ, "_frame", lambda *_: fr)
    TQ._models(spark, fr, ["decision_tree"])  # the folder of this frame's models is there already
    first, second, real, fit = [], [], CF.estimator, CF.fit_newton
    monkeypatch.setattr(CF, "estimator", lambda *a, **k: first.append(real(*a, **k)) or first[-1])
    monkeypatch.setattr(CF, "fit_newton", lambda rows, rounds, *a, **k: second.append(rounds) or fit(rows, rounds, *a, **k))
    got = MQ.q_newton_boost_valid(spark, "").first()
    assert [(e.getMaxIter(), e.getMaxDepth()) for e in first] == [(7, params.newton_depth)] and second == [7]  # before: 3 rounds of each
    assert (got.trees, got.rounds_without_gain, got.rows, got.positives) == (7, 0, 300, sum(r[-1] for r in rows))
    assert got.loss_is_last and got.beats_no_model and got.differs_from_first_order


def test_tree_shap_walks_a_tree_once_for_a_shard(spark, tmp_path, monkeypatch):
    from weekpanel.operators import classify as CF
    from weekpanel.operators import treeshap as TS
    from weekpanel.params import Params
    from weekpanel.schema import FEATURE_NUMERIC

    rng = np.random.default_rng(9)
    rows = [(f"u{i % 9}", i, "train", *[float(v) for v in rng.normal(size=len(FEATURE_NUMERIC)).round(2)], f"r{i % 4}", int(rng.random() < 0.4)) for i in range(300)]
    fr = spark.createDataFrame(rows, "unit_id string, week_id long, split string, " + ", ".join(f"{c} double" for c in FEATURE_NUMERIC) + ", region string, y int").localCheckpoint()
    model = CF.fit(fr, "random_forest", Params(rf_trees=4, rf_depth=4, rf_min_leaf=5))
    walked, real = spark.sparkContext.accumulator(0), TS.explain_rows

    def counted(trees, x):
        walked.add(len(trees))
        return real(trees, x)

    monkeypatch.setattr(TS, "explain_rows", counted)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 20)
    try:
        whole = CF.tree_shap_values(model, fr, str(tmp_path / "a")).collect()
        assert walked.value == 4  # before: once for every batch of 20 rows
        parted = CF.tree_shap_values(model, fr, str(tmp_path / "b"), rows_at_once=100).collect()
        assert walked.value > 4 + 4
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = {(r.unit_id, r.week_id, r.feature): r.phi for r in whole}
    assert len(want) == len(whole) == len(parted) and all(abs(want[r.unit_id, r.week_id, r.feature] - r.phi) < 1e-12 for r in parted)
    margin = {r.week_id: r.proba for r in CF.score(model, fr, "m").collect()}
    for i in range(300):
        assert abs(sum(v for (_, week, _), v in want.items() if week in (i, None)) - margin[i]) < 1e-9
