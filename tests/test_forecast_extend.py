import datetime

from pyspark.sql import functions as F

from tests.fixtures import master_like, seasonal_master
from weekpanel.operators import extend as X
from weekpanel.operators import forecast as FC
from weekpanel.operators.eda import weekly_series
from weekpanel.params import Params


def _series(spark):
    m = master_like(spark)
    return weekly_series(m, ("national", "unit"))


def test_forecast_length_and_bounds(spark):
    f = FC.forecast_future(_series(spark), 4).collect()
    assert len(f) > 0
    by = {}
    for r in f:
        by.setdefault((r.level, r.series_key), []).append(r)
        assert 0 <= r.lower <= r.forecast <= r.upper
    assert all(len(v) == 4 for v in by.values())


def test_backtest_chooses_lower_rmse(spark):
    b = FC.backtest(_series(spark), [13]).collect()
    for r in b:
        want = "holt_winters" if r.rmse_hw < r.rmse_ma else "moving_average"
        assert r.chosen == want


def test_series_and_moving_average_take_one_pass(spark):
    d0, half = datetime.date(2020, 1, 1), datetime.timedelta(days=7)
    dates = [d0 + half * i for i in range(40)]
    rows = [("a", "N", dates[i], i % 7) for i in range(0, 40, 3)] + [("b", "S", dates[i], i) for i in range(4, 36)]
    rows += [("b", "S", dates[5], 100), (None, "N", dates[0], 3), (None, "N", dates[20], 4), ("c", None, dates[2], 9), ("c", None, dates[4], None), ("z", "S", None, 7)]
    panel = spark.createDataFrame(rows, "unit_id string, region string, week_start date, cases long")
    series = weekly_series(panel)
    want, known = {}, sorted({r[2] for r in rows if r[2]})
    for level, at in (("national", None), ("region", 1), ("unit", 0)):
        for key in {"ALL" if at is None else r[at] for r in rows}:
            own = [r for r in rows if r[2] and (at is None or r[at] == key)]
            for d in known:
                if own and min(r[2] for r in own) <= d <= max(r[2] for r in own):
                    # dates without a key are there with 0
                    want[level, key, d] = float(sum(r[3] or 0 for r in own if r[2] == d)) if key is not None else 0.0
    got = series.collect()
    assert len(got) == len(want) and {(r.level, r.series_key, r.week_start): r.cases for r in got} == want
    plan = series._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan

    table = spark.createDataFrame(got, series.schema)
    preds = FC.ma_backtest(table, [8, 13, 26])
    plan = preds._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ExistingRDD") == 1 and "Join" not in plan
    expected = {}
    for level, key in {(lv, k) for lv, k, _ in want if k is not None}:
        y = [want[k] for k in sorted((k for k in want if k[:2] == (level, key)), key=lambda k: k[2])]
        for v in (8, 13, 26):
            if len(y) > v + 8 and max(y) > 0:
                for t in range(len(y) - v, len(y)):
                    expected[level, key, v, t] = (y[t], sum(y[-v - 4 : -v]) / 4)
    rows = preds.collect()
    assert len(rows) == len(expected) and {(r.level, r.series_key, r.eval_window, r.t): (r.actual, r.pred) for r in rows} == expected


def _extended(spark, parts=8, master=None):
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    m = master if master is not None else seasonal_master(spark)
    out = X.extend_panel(m, Params()).cache()
    out.count()
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    return out


def test_extension_invariants(spark):
    m = seasonal_master(spark)
    ext = _extended(spark, master=m)
    real_before = {(r.unit_id, r.week_id, r.cases) for r in m.collect()}
    real_after = {(r.unit_id, r.week_id, r.cases) for r in ext.filter(F.col("origin") == "real").collect()}
    assert real_before == real_after
    sim = ext.filter(F.col("origin") == "simulated")
    assert {r.split for r in sim.select("split").distinct().collect()} == {"simulated"}
    test_years = {r.year for r in ext.filter(F.col("split") == "test").select("year").distinct().collect()}
    assert test_years == {2024}
    last = sim.agg(F.max(F.struct("year", "week")).alias("m")).collect()[0].m
    assert (last.year, last.week) == (2026, 22)
    assert sim.filter(F.col("cases") < 0).count() == 0
    # the seasonal peak is kept near week 20
    peak = sim.groupBy("week").agg(F.avg("cases").alias("a")).orderBy(F.col("a").desc(), "week").first().week
    assert abs(peak - 20) <= 6


def test_extension_reproducible_for_any_partitioning(spark):
    a = {(r.unit_id, r.week_id, r.cases) for r in _extended(spark, 1).filter("origin = 'simulated'").collect()}
    b = {(r.unit_id, r.week_id, r.cases) for r in _extended(spark, 8).filter("origin = 'simulated'").collect()}
    assert a == b


def test_inactive_unit_not_revived(spark):
    m = seasonal_master(spark).filter(~((F.col("unit_id") == "010101") & (F.col("year") > 2020)))
    sim = X.simulate(m.withColumn("origin", F.lit("real")), Params())
    assert sim.filter(F.col("unit_id") == "010101").count() == 0
    assert sim.filter(F.col("unit_id") == "020202").count() > 0


def test_target_calendar_wraps(spark):
    m = seasonal_master(spark)
    cal = X.target_calendar(m, Params()).orderBy("week_id").collect()
    assert (cal[0].year, cal[0].week) == (2025, 1)
    assert cal[0].week_start == datetime.date(2025, 1, 1)
    assert max(r.week for r in cal) == 52


def test_tree_shap_additivity(spark, tmp_path):
    """Many regions (so one-hot splits are categorical), every row, every kind of tree."""
    import numpy as np

    from weekpanel.operators import classify as CF
    from weekpanel.params import Params
    from weekpanel.schema import FEATURE_NUMERIC

    rng = np.random.default_rng(4)
    rows = []
    for i in range(600):
        x = [float(v) for v in rng.normal(size=len(FEATURE_NUMERIC)).round(3)]
        r = int(rng.integers(0, 9))
        rows.append((f"u{i % 20}", i, "train" if i % 3 else "test", *x, f"region {r}", int(x[0] + (r in (2, 5)) - (r == 7) + rng.normal() * 0.3 > 0.4)))
    cols = "unit_id string, week_id long, split string, " + ", ".join(f"{c} double" for c in FEATURE_NUMERIC) + ", region string, y int"
    fr = spark.createDataFrame(rows, cols)
    small = Params(tree_depth=7, tree_min_leaf=2, rf_trees=4, rf_depth=6, rf_min_leaf=2, boost_rounds=4)
    for name in ("decision_tree", "random_forest", "xgboost", "gradient_boosting"):
        model = CF.fit(fr, name, small)
        phi = CF.tree_shap_values(model, fr, f"{tmp_path}/{name}").toPandas()
        assert (phi.feature.str.startswith("region")).any()
        expected = phi[phi.feature == "_expected"].phi.iloc[0]
        sums = phi[phi.feature != "_expected"].groupby("week_id").phi.sum().reindex(range(600), fill_value=0.0)
        proba = CF.score(model, fr, name).toPandas().set_index("week_id").proba.sort_index()
        margin = np.log(proba / (1 - proba))  # the first-order booster's margin is half the log-odds
        want = {"xgboost": margin, "gradient_boosting": margin / 2}.get(name, proba)
        assert np.abs(expected + sums - want).max() < 1e-6, name
