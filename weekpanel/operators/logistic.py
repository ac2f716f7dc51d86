"""Logistic regression by Newton steps.

Minimises ``sum of w * log-loss + l2 / 2 * |coefficients|^2`` (the intercept is
free). A step takes one aggregate over all rows: the gradient and the Hessian,
whose size is the square of the number of features. Tasks add up their rows as
matrix products; Spark sums the entries of all tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekpanel.operators.fitted import Classifier


class LogisticModel(Classifier):
    def __init__(self, coefficients=(), intercept: float = 0.0, steps: int = 0, score: float = 0.0):
        super().__init__()
        self.coefficients = np.asarray(coefficients, float)
        self.intercept, self.steps, self.score = float(intercept), steps, score

    def numbers(self) -> dict:
        return {"coefficients": self.coefficients.tolist(), "intercept": self.intercept, "steps": self.steps, "score": self.score}

    @classmethod
    def of(cls, n: dict) -> LogisticModel:
        return cls(n["coefficients"], n["intercept"], n["steps"], n["score"])

    def margin(self, features: Column) -> Column:
        x = vector_to_array(features)
        return sum((F.lit(float(c)) * x[i] for i, c in enumerate(self.coefficients)), F.lit(self.intercept))


def _sums(beta: np.ndarray):
    """Gradient (p - y) x, Hessian p (1 - p) x x' and log-loss of a partition's rows, entry by entry."""

    def run(batches):
        d = len(beta)
        total = np.zeros(d + d * d + 1)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, d - 1)
            x = np.hstack((x, np.ones((len(x), 1))))
            y, w = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("y", "w"))
            m = x @ beta
            p = 1.0 / (1.0 + np.exp(-m))
            total[:d] += x.T @ (w * (p - y))
            total[d:-1] += ((x * (w * p * (1.0 - p))[:, None]).T @ x).ravel()
            total[-1] += (w * (np.logaddexp(0.0, m) - y * m)).sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["entry", "value"])

    return run


def score_equations(rows: DataFrame, beta: np.ndarray, l2: float):
    """(gradient, Hessian, loss) of the penalised loss at ``beta`` (the intercept last)."""
    d = len(beta)
    summed = rows.mapInArrow(_sums(beta), "entry long, value double").groupBy("entry").agg(F.sum("value").alias("value")).toArrow()
    total = np.zeros(d + d * d + 1)
    total[summed.column("entry").to_numpy()] = summed.column("value").to_numpy()
    penalty = np.append(np.full(d - 1, l2), 0.0)
    return total[:d] + penalty * beta, total[d:-1].reshape(d, d) + np.diag(penalty), total[-1] + 0.5 * float(penalty @ beta**2)


def fit_logistic(rows: DataFrame, l2: float = 1.0, max_steps: int = 50, tolerance: float = 1e-10) -> LogisticModel:
    """Model of ``rows`` (x array of doubles, y 0/1, w weight), which are read once for each step: pass a table.

    Steps are halved while they raise the loss. The fit ends when the greatest score equation, per unit of
    weight, is below ``tolerance``. Rows with a null are left out; without rows all coefficients are 0."""
    rows = rows.select("x", F.col("y").cast("double").alias("y"), F.col("w").cast("double").alias("w")).where("x is not null and y is not null and w is not null")
    about = rows.agg(F.max(F.size("x")).alias("f"), F.sum("w").alias("w")).first()
    if not about["w"]:
        return LogisticModel(np.zeros(about["f"] or 0))
    beta = np.zeros(about["f"] + 1)
    gradient, hessian, loss = score_equations(rows, beta, l2)
    steps = 0
    while steps < max_steps and np.abs(gradient).max() / about["w"] > tolerance:
        steps += 1
        move = np.linalg.lstsq(hessian, gradient, rcond=None)[0]
        for half in range(30):
            to = beta - move / 2**half
            after = score_equations(rows, to, l2)
            if after[2] <= loss + 1e-12 * abs(loss):
                break
        else:
            break
        beta, (gradient, hessian, loss) = to, after
    return LogisticModel(beta[:-1], beta[-1], steps, float(np.abs(gradient).max() / about["w"]))
