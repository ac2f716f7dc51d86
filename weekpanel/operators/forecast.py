"""Weekly-series forecasting as Spark jobs over a long table of series
(level, series_key, week_start, cases).

* Moving average, errors, backtest windows and future weeks are SQL
  expressions and windows partitioned by series.
* The damped Holt-Winters fit takes whole series as rows (an array of at most
  the calendar length, whatever the data volume), dealt out by a hash of the
  series key. A task fits the series of an Arrow batch together, all evaluation
  windows of a series in the same pass."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weekpanel.functions.calendar import epi_week, epi_week_start, epi_year, roll_week
from weekpanel.operators import smoothing

SERIES = ["level", "series_key"]


def ma_backtest(series: DataFrame, windows=(13,), ma_window: int = 4) -> DataFrame:
    """Hold out the last ``window`` points; forecast them all with the mean of
    the last ``ma_window`` training points. Returns per-step predictions
    (level, series_key, window, t, actual, pred) of the (series, window) pairs
    with more than window + 2 * ma_window points and not all zero.

    One pass over the series: t = 0.. in date order, n = length and the largest count come from one shuffle, and
    only the points that some window reads go on from there."""
    windows = [int(v) for v in windows]
    whole = Window.partitionBy(*SERIES)
    pos = series.dropna(subset=SERIES).select(
        *SERIES, F.col("cases").alias("actual"),
        (F.row_number().over(whole.orderBy("week_start")) - 1).cast("int").alias("t"),
        F.count(F.lit(1)).over(whole).cast("int").alias("n"), F.max("cases").over(whole).alias("mx"),
    )
    tail = pos.filter((F.col("t") >= F.col("n") - (max(windows, default=0) + ma_window)) & (F.col("mx") > 0))
    each = F.explode(F.array(*[F.lit(v) for v in windows]).cast("array<int>")).alias("eval_window")
    cut = F.col("n") - F.col("eval_window")
    j = tail.select("*", each).filter((cut > 2 * ma_window) & (F.col("t") >= cut - ma_window)).select("*", (F.col("t") >= cut).alias("held_out"))
    pred = F.avg(F.when(~F.col("held_out"), F.col("actual"))).over(Window.partitionBy(*SERIES, "eval_window"))
    return j.withColumn("pred", pred).filter("held_out").select(*SERIES, "eval_window", "t", "actual", "pred").withColumn("model", F.lit("moving_average"))


def errors(preds: DataFrame) -> DataFrame:
    """Safe MAPE (actual = 0 skipped; NULL if nothing is left) and RMSE per
    (series, window, model)."""
    y, p = F.col("actual"), F.col("pred")
    return preds.groupBy(*SERIES, "eval_window", "model").agg(
        (F.avg(F.when(y != 0, F.abs((y - p) / y))) * 100.0).alias("mape"),
        F.sqrt(F.avg((y - p) * (y - p))).alias("rmse"),
    )


def _whole_series(series: DataFrame) -> DataFrame:
    """One row per series with its counts in date order, spread over all cores."""
    rows = series.groupBy(*SERIES).agg(F.array_sort(F.collect_list(F.struct("week_start", "cases"))).alias("s"))
    parts = int(series.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.select(*SERIES, F.transform("s", lambda p: p["cases"].cast("double")).alias("y")).repartition(parts, *SERIES)


def _counts(column) -> list:
    return [np.asarray(y.values.to_numpy(zero_copy_only=False)) for y in column]


def _table(batch, at: np.ndarray, **columns) -> pa.RecordBatch:
    """Rows for places ``at`` of the batch's series."""
    keys = [batch.column(c).take(pa.array(at)) for c in SERIES]
    return pa.RecordBatch.from_arrays([*keys, *(pa.array(v) for v in columns.values())], [*SERIES, *columns])


def hw_backtest(series: DataFrame, windows=(13,), ma_window: int = 4, period: int = 52) -> DataFrame:
    """Holt-Winters predictions of the held-out points of every eligible (series, window)."""
    windows = sorted(int(v) for v in windows)

    def run(batches):
        for batch in batches:
            ys = _counts(batch.column("y"))
            pairs = [(i, v) for i, y in enumerate(ys) for v in windows if len(y) > v + 2 * ma_window and y.max(initial=0.0) > 0]
            if not pairs:
                continue
            pred, lo, hi = smoothing.forecast_counts([ys[i][:-v] for i, v in pairs], windows[-1], period)
            v = np.array([v for _, v in pairs])
            inside = np.arange(windows[-1]) < v[:, None]
            at = np.repeat([i for i, _ in pairs], v)
            t = (np.array([len(ys[i]) for i, _ in pairs]) - v)[:, None] + np.arange(windows[-1])
            actual = np.concatenate([ys[i][-w:] for i, w in pairs])
            yield _table(batch, at, eval_window=np.repeat(v, v).astype(np.int32), t=t[inside].astype(np.int32), actual=actual, pred=pred[inside], lower=lo[inside], upper=hi[inside])

    schema = "level string, series_key string, eval_window int, t int, actual double, pred double, lower double, upper double"
    hw = _whole_series(series).mapInArrow(run, schema)
    return hw.select(*SERIES, "eval_window", "t", "actual", "pred").withColumn("model", F.lit("holt_winters"))


def hw_states(series: DataFrame, params, period: int = 52) -> DataFrame:
    """The recursion of every series at given parameters (alpha, beta, gamma, phi) on the log scale: (n,
    last_level, last_trend, sse, next)."""
    given = np.array(params, float)

    def run(batches):
        for batch in batches:
            ys = _counts(batch.column("y"))
            for seasonal in (False, True):
                at = np.array([i for i, y in enumerate(ys) if len(y) and (len(y) >= 2 * period) == seasonal], np.int64)
                if not len(at):
                    continue
                n = np.array([len(ys[i]) for i in at])
                order = np.argsort(-n, kind="stable")
                at, n = at[order], n[order]
                y = np.zeros((len(at), n[0]))
                for row, i in enumerate(at):
                    y[row, : len(ys[i])] = np.log1p(np.clip(ys[i], 0, None))
                use = np.tile(given if seasonal else given * [1, 1, 0, 1], (1, len(at), 1))
                level, trend, season, sse, _ = smoothing.recursion(y, n, use, period, seasonal)
                fit = smoothing.Fit(level[0], trend[0], season[:, 0], use[0], sse[0], sse[0], n)
                ahead = smoothing.forecast(fit, 1, period, seasonal)[:, 0]
                yield _table(batch, at, n=n.astype(np.int32), last_level=level[0], last_trend=trend[0], sse=sse[0], next=ahead)

    return _whole_series(series).mapInArrow(run, "level string, series_key string, n int, last_level double, last_trend double, sse double, next double")


def backtest(series: DataFrame, windows=(13,), ma_window: int = 4, period: int = 52) -> DataFrame:
    """Both models' errors per (series, window) and the chosen model (lower
    RMSE; a tie keeps the moving average)."""
    preds = ma_backtest(series, windows, ma_window).unionByName(hw_backtest(series, windows, ma_window, period))
    e = errors(preds)
    g = e.groupBy(*SERIES, "eval_window").agg(
        F.max(F.when(F.col("model") == "moving_average", F.col("mape"))).alias("mape_ma"),
        F.max(F.when(F.col("model") == "moving_average", F.col("rmse"))).alias("rmse_ma"),
        F.max(F.when(F.col("model") == "holt_winters", F.col("mape"))).alias("mape_hw"),
        F.max(F.when(F.col("model") == "holt_winters", F.col("rmse"))).alias("rmse_hw"),
    )
    return g.withColumn(
        "chosen", F.when(F.col("rmse_hw") < F.col("rmse_ma"), F.lit("holt_winters")).otherwise(F.lit("moving_average"))
    )


def future_weeks(series: DataFrame, steps: int = 4, period: int = 52) -> DataFrame:
    """The next ``steps`` weeks after each series' last date: week + i,
    wrapping after week 52 into week 1 of the next year."""
    last = series.groupBy(*SERIES).agg(F.max("week_start").alias("last"))
    s = last.select(*SERIES, epi_year("last").alias("y"), epi_week("last").alias("w"),
                    F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("step"))
    y, w = roll_week(F.col("y"), F.col("w"), F.col("step"), period)
    return s.select(*SERIES, "step", epi_week_start(y, w).alias("week_start"))


def forecast_future(series: DataFrame, steps: int = 4, min_points: int | None = None, ma_window: int = 4,
                    period: int = 52, eval_weeks: int = 13) -> DataFrame:
    """Holt-Winters fit on each whole series, ``steps`` future weeks with
    bounds. Series shorter than eval_weeks + 3 * ma_window points, or all
    zero, get no forecast."""
    min_points = eval_weeks + 3 * ma_window if min_points is None else min_points

    def run(batches):
        for batch in batches:
            ys = _counts(batch.column("y"))
            at = np.array([i for i, y in enumerate(ys) if len(y) >= min_points and y.max(initial=0.0) > 0], np.int64)
            if not len(at):
                continue
            point, lo, hi = smoothing.forecast_counts([ys[i] for i in at], steps, period)
            step = np.tile(np.arange(1, steps + 1, dtype=np.int32), len(at))
            yield _table(batch, np.repeat(at, steps), step=step, forecast=point.ravel(), lower=lo.ravel(), upper=hi.ravel())

    f = _whole_series(series).mapInArrow(run, "level string, series_key string, step int, forecast double, lower double, upper double")
    return f.join(future_weeks(series, steps, period), [*SERIES, "step"])


def display(forecasts: DataFrame) -> DataFrame:
    """Presentation projection: date as text, rounded integer forecast and bounds."""
    return forecasts.select(
        *SERIES, "step", F.date_format("week_start", "yyyy-MM-dd").alias("date"),
        F.round("forecast").cast("long").alias("forecast"), F.round("lower").cast("long").alias("lower"),
        F.round("upper").cast("long").alias("upper"),
    )
