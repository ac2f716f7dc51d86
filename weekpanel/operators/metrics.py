"""Classification metrics on a scored table (model, y, proba).

Everything is a grouped aggregate by model (a handful of groups, each
combined map-side), so the work never lands in one task. ROC-AUC uses exact
mid-ranks through a running total over range-sorted distinct scores, so
neither a model nor a band of close scores lands in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekpanel.operators.ranks import running_total

MODEL_ORDER = ["random_forest", "xgboost", "gradient_boosting", "logistic_regression", "decision_tree"]


def _safe_div(a, b):
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def confusion(scored: DataFrame, threshold: float | str = 0.5, by: tuple[str, ...] = ("model",)) -> DataFrame:
    t = F.col(threshold) if isinstance(threshold, str) else F.lit(threshold)
    pred = (F.col("proba") >= t).cast("int")
    y = F.col("y")
    return scored.groupBy(*by).agg(
        F.count_if((pred == 1) & (y == 1)).alias("tp"),
        F.count_if((pred == 1) & (y == 0)).alias("fp"),
        F.count_if((pred == 0) & (y == 0)).alias("tn"),
        F.count_if((pred == 0) & (y == 1)).alias("fn"),
    )


def _rates(df: DataFrame) -> DataFrame:
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    prec = _safe_div(tp, tp + fp)
    rec = _safe_div(tp, tp + fn)
    return df.select(
        "*",
        _safe_div(tp + tn, tp + fp + tn + fn).alias("accuracy"),
        prec.alias("precision"),
        rec.alias("recall"),
        _safe_div(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def class_metrics(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Confusion counts and accuracy / precision / recall / F1 (0 on zero division)."""
    return _rates(confusion(scored, threshold))


def roc_auc(scored: DataFrame) -> DataFrame:
    """Exact ROC-AUC with ties counted one half; NULL if a class is missing."""
    by_score = scored.groupBy("model", "proba").agg(
        F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") == 0).alias("neg")
    )
    s = running_total(by_score, ["model"], ["proba"], ["neg"]).withColumn("neg_below", F.col("neg_upto") - F.col("neg"))
    g = s.groupBy("model").agg(
        F.sum(F.col("pos") * (F.col("neg_below") + 0.5 * F.col("neg"))).alias("u"),
        F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"),
    )
    return g.select(
        "model",
        F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0), F.col("u") / (F.col("n_pos") * F.col("n_neg"))).alias("auc"),
    )


def per_class_metrics(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Precision / recall / F1 / support for class 0 and class 1."""
    c = confusion(scored, threshold)
    one = c.select("model", F.lit(1).alias("cls"), F.col("tp").alias("tp"), F.col("fp").alias("fp"), F.col("fn").alias("fn"))
    zero = c.select("model", F.lit(0).alias("cls"), F.col("tn").alias("tp"), F.col("fn").alias("fp"), F.col("fp").alias("fn"))
    u = one.unionByName(zero)
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return u.select(
        "model", "cls",
        _safe_div(tp, tp + fp).alias("precision"),
        _safe_div(tp, tp + fn).alias("recall"),
        _safe_div(2 * tp, 2 * tp + fp + fn).alias("f1"),
        (tp + fn).alias("support"),
    )


def threshold_sweep(scored: DataFrame, thresholds: list[float] | None = None) -> DataFrame:
    """Precision, recall, F1, FP, FN per model at each threshold.

    Each row is put once into the band between two thresholds; the sweep
    cumulates the counts of the few bands."""
    thresholds = sorted(thresholds or [round(0.1 * i, 1) for i in range(1, 10)])
    reached = sum((F.col("proba") >= F.lit(float(t))).cast("int") for t in thresholds)
    bands = scored.groupBy("model", F.coalesce(reached, F.lit(0)).alias("band")).agg(
        F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") == 0).alias("neg"))
    th = scored.sparkSession.createDataFrame([(i + 1, float(t)) for i, t in enumerate(thresholds)], "i int, t double")
    above = F.col("band") >= F.col("i")
    c = bands.crossJoin(F.broadcast(th)).groupBy("model", "t").agg(
        F.coalesce(F.sum(F.when(above, F.col("pos"))), F.lit(0)).alias("tp"), F.coalesce(F.sum(F.when(above, F.col("neg"))), F.lit(0)).alias("fp"),
        F.coalesce(F.sum(F.when(~above, F.col("neg"))), F.lit(0)).alias("tn"), F.coalesce(F.sum(F.when(~above, F.col("pos"))), F.lit(0)).alias("fn"))
    return _rates(c).select("model", F.col("t").alias("threshold"), "precision", "recall", "f1", "fp", "fn")


def best_by(df: DataFrame, metric: str, key: str = "model", order: list[str] | None = None, lowest: bool = False) -> DataFrame:
    """The key with the best metric; ties go to the earlier key in ``order``
    (or the smaller key)."""
    order = order or MODEL_ORDER
    ordinal = F.coalesce(F.array_position(F.array(*[F.lit(o) for o in order]), F.col(key)), F.lit(len(order) + 1))
    m = -F.col(metric) if lowest else F.col(metric)
    return df.agg(F.max_by(F.col(key), F.struct(m.alias("m"), (-ordinal).alias("o"), F.col(key).alias("k"))).alias(f"best_{key}"))


def class_balance(labels: DataFrame, y: str = "y", over: float = 0.80) -> DataFrame:
    """Majority-class share, n_neg / max(n_pos, 1), and whether to balance."""
    g = labels.agg(F.count_if(F.col(y) == 1).alias("n_pos"), F.count_if(F.col(y) == 0).alias("n_neg"))
    n = F.col("n_pos") + F.col("n_neg")
    return g.select(
        "n_pos", "n_neg",
        _safe_div(F.greatest("n_pos", "n_neg").cast("double"), n).alias("majority_share"),
        (F.col("n_neg") / F.greatest(F.col("n_pos"), F.lit(1))).cast("double").alias("pos_weight"),
        (_safe_div(F.greatest("n_pos", "n_neg").cast("double"), n) > over).alias("balance"),
    )


def with_class_weights(labels: DataFrame, y: str = "y", over: float = 0.80) -> DataFrame:
    """Row weights: balanced n / (2 n_c) and positive-class n_neg / n_pos,
    applied only when the majority share exceeds ``over`` (else 1)."""
    bal = F.broadcast(class_balance(labels, y, over))  # one row
    j = labels.crossJoin(bal)
    n = F.col("n_pos") + F.col("n_neg")
    n_c = F.when(F.col(y) == 1, F.col("n_pos")).otherwise(F.col("n_neg"))
    w_bal = F.when(F.col("balance"), n / (2.0 * n_c)).otherwise(F.lit(1.0))
    w_pos = F.when(F.col("balance") & (F.col(y) == 1), F.col("pos_weight")).otherwise(F.lit(1.0))
    return j.select(*labels.columns, w_bal.alias("weight_balanced"), w_pos.alias("weight_pos"))


def balance_pivot(effect: DataFrame) -> DataFrame:
    """Recall by model x state (without / with balancing) plus the gain."""
    p = effect.groupBy("model").pivot("state", ["without", "with"]).agg(F.first("recall"))
    return p.select("model", "without", "with", (F.col("with") - F.col("without")).alias("gain"))
