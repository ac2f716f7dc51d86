"""Run parameters. One frozen dataclass; operators take it as an argument."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Params:
    # reproducibility
    seed: int = 42
    # clustering
    k_min: int = 2
    k_max: int = 8
    k_selected: int | None = 3
    # classifiers
    rf_trees: int = 200
    rf_depth: int = 16
    rf_min_leaf: int = 20
    boost_rounds: int = 200
    boost_rate: float = 0.10
    newton_depth: int = 6
    newton_l2: float = 1.0
    logistic_l2: float = 1.0
    tree_depth: int = 12
    tree_min_leaf: int = 20
    threshold: float = 0.50
    balance_if_majority_over: float = 0.80
    # label
    target_percentile: float = 75.0
    min_history_weeks: int = 30
    # forecasting
    forecast_weeks: int = 4
    ma_window: int = 4
    eval_weeks: int = 13
    robustness_windows: tuple[int, ...] = (8, 13, 26)
    season_length: int = 52
    # split
    test_years: int = 1
    val_years: int = 1
    # cleaning bounds
    year_min: int = 2000
    year_max: int = 2100
    week_min: int = 1
    week_max: int = 53
    age_max: float = 120.0
    # panel extension by seasonal bootstrap
    extend_to_year: int = 2026
    extend_to_week: int = 22
    lookback_years: int = 6
    active_years: int = 2
    band_weeks: int = 2
    recency_decay: float = 0.65
    noise_sigma: float = 0.25
    ar_rho: float = 0.75
    smooth_window: int = 3
    year_intensity: tuple[tuple[int, float], ...] = ((2025, 0.80), (2026, 0.90))
    label_from_real_only: bool = True
    # exploration
    histogram_bins: int = 50
    top_n: int = 15

    def replace(self, **kw) -> "Params":
        from dataclasses import replace

        return replace(self, **kw)


DEFAULT = Params()
