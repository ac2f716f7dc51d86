"""Leak-free features per unit: lags, trailing means/std of the previous
weeks, growth, circular week encoding. One window spec (partition by unit,
order by week) serves every column, so the plan has one sort. Trailing means
are taken from the lags: a sliding frame would add up its rows anew for every row."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekpanel.functions.calendar import week_cos, week_sin
from weekpanel.functions.scalar import growth
from weekpanel.operators.panel import unit_order


def _trailing_mean(lags: list[Column]) -> Column:
    """Mean of the lags, NULL until all of them exist (counts add up exactly in doubles)."""
    return functools.reduce(operator.add, lags) / F.lit(float(len(lags)))


def add_features(panel: DataFrame, ma_window: int = 4, period: int = 52) -> DataFrame:
    c = F.col("cases").cast("double")
    lag = {k: F.lag(c, k).over(unit_order()) for k in {1, 2, 4, *range(1, 2 * ma_window + 1)}}
    mean = _trailing_mean([lag[k] for k in range(1, ma_window + 1)])
    std = F.stddev_samp("cases").over(unit_order().rowsBetween(-ma_window, -1))
    return panel.select(
        "*",
        lag[1].alias("cases_lag_1"),
        lag[2].alias("cases_lag_2"),
        lag[4].alias("cases_lag_4"),
        mean.alias("roll_mean_4"),
        _trailing_mean([lag[k] for k in range(1, 2 * ma_window + 1)]).alias("roll_mean_8"),
        F.when(mean.isNotNull(), std).alias("roll_std_4"),
        growth(c, lag[1]).alias("growth"),
        week_sin("week", period).alias("week_sin"),
        week_cos("week", period).alias("week_cos"),
    )
