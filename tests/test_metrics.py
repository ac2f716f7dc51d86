import random

from weekpanel.operators.forecast import errors
from weekpanel.operators.metrics import class_metrics, roc_auc


def test_safe_mape(spark):
    df = spark.createDataFrame(
        [("n", "a", 13, 0, 0.0, 5.0), ("n", "a", 13, 1, 10.0, 11.0), ("n", "a", 13, 2, 20.0, 18.0),
         ("n", "b", 13, 0, 0.0, 1.0), ("n", "b", 13, 1, 0.0, 2.0)],
        "level string, series_key string, eval_window int, t int, actual double, pred double",
    ).withColumn("model", __import__("pyspark.sql.functions", fromlist=["lit"]).lit("m"))
    got = {r.series_key: r for r in errors(df).collect()}
    assert abs(got["a"].mape - 10.0) < 1e-9
    assert got["b"].mape is None


def _brute_auc(rows):
    pos = [p for y, p in rows if y == 1]
    neg = [p for y, p in rows if y == 0]
    s = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg)
    return s / (len(pos) * len(neg))


def test_auc_matches_brute_force_with_ties(spark):
    rnd = random.Random(3)
    rows = [(rnd.randint(0, 1), rnd.choice([0.1, 0.2, 0.2, 0.5, 0.7, 0.9, rnd.random()])) for _ in range(300)]
    df = spark.createDataFrame([("m", y, p) for y, p in rows], "model string, y int, proba double")
    got = roc_auc(df).collect()[0].auc
    assert abs(got - _brute_auc(rows)) < 1e-12


def test_auc_one_class_is_null(spark):
    df = spark.createDataFrame([("m", 1, 0.3), ("m", 1, 0.6)], "model string, y int, proba double")
    assert roc_auc(df).collect()[0].auc is None


def test_zero_division_gives_zero(spark):
    df = spark.createDataFrame([("m", 0, 0.1), ("m", 0, 0.2)], "model string, y int, proba double")
    r = class_metrics(df, 0.5).collect()[0]
    assert r.precision == 0.0 and r.recall == 0.0 and r.f1 == 0.0 and r.accuracy == 1.0
