"""Damped additive-trend exponential smoothing with an optional additive
season, fitted on log1p counts for many series at once.

The series of a batch are the rows of one matrix, longest first, and the
recursion steps through the weeks for all of them (and for several parameter
sets each) together. The parameters minimise the sum of squared one-step
errors: a coarse grid gives every series its starts, and a Nelder-Mead
simplex for each series then moves all simplexes in step, with the five trial
points of every simplex evaluated in one pass. Parameters live in a box,
mapped to the line by the logit. Small numpy helper, run in Arrow batches."""

from __future__ import annotations

import itertools
from dataclasses import dataclass

import numpy as np

# box of (alpha, beta, gamma, phi); gamma only with a season
LOW = np.array([0.001, 0.0001, 0.0001, 0.80])
HIGH = np.array([0.999, 0.50, 0.90, 0.995])
STARTS = {
    False: [(a, b, 0.0, p) for a, b, p in itertools.product((0.05, 0.25, 0.5, 0.75, 0.95), (0.01, 0.1, 0.2), (0.8, 0.9, 0.98))],
    True: list(itertools.product((0.05, 0.25, 0.5, 0.75, 0.95), (0.01, 0.2), (0.01, 0.1, 0.3), (0.8, 0.98))),
}
N_STARTS = 2  # simplexes of a series, from its best points of the grid
STEPS = 40
ROWS = 256  # series handled at once
TOLERANCE = 1e-5


@dataclass
class Fit:
    """Final states of series (all arrays by series, ``season`` by place and series)."""

    level: np.ndarray
    trend: np.ndarray
    season: np.ndarray
    params: np.ndarray  # alpha, beta, gamma, phi
    sse: np.ndarray
    sd: np.ndarray  # of the one-step errors
    n: np.ndarray


def initial(y: np.ndarray, n: np.ndarray, period: int, seasonal: bool):
    """Start values (level, trend, season) of series y[:, :n]."""
    if seasonal:
        level = y[:, :period].mean(1)
        trend = (y[:, period : 2 * period].mean(1) - level) / period
        return level, trend, (y[:, :period] - level[:, None]).T.copy()
    level = np.where(n > 0, y[:, 0], 0.0)
    second = y[:, 1] if y.shape[1] > 1 else level
    return level, np.where(n > 1, second - level, 0.0), np.zeros((1, len(y)))


def recursion(y: np.ndarray, n: np.ndarray, params: np.ndarray, period: int, seasonal: bool):
    """Runs parameter sets (sets, series, 4) over the series (longest first, y[:, :n]).

    Returns (level, trend, season, sum of squared errors, sum of errors), each with an axis of sets."""
    sets, rows = params.shape[:2]
    alpha, beta, gamma, phi = (np.ascontiguousarray(params[..., i]) for i in range(4))
    l0, b0, s0 = initial(y, n, period, seasonal)
    level, trend = np.tile(l0, (sets, 1)), np.tile(b0, (sets, 1))
    season = np.repeat(s0[:, None, :], sets, 1)
    sse, total = np.zeros((sets, rows)), np.zeros((sets, rows))
    active = np.searchsorted(-n, -np.arange(y.shape[1]), side="left")  # rows with n > t: a prefix
    for t in range(int(n.max(initial=0))):
        k = active[t]
        lev, tr, s = level[:, :k], trend[:, :k], season[t % period if seasonal else 0][:, :k]
        damped = phi[:, :k] * tr
        base = lev + damped
        e = y[:k, t] - base - s
        sse[:, :k] += e * e
        total[:, :k] += e
        new = base + alpha[:, :k] * e
        trend[:, :k] = damped + beta[:, :k] * (new - lev - damped)
        if seasonal:
            s += gamma[:, :k] * (y[:k, t] - new - s)
        level[:, :k] = new
    return level, trend, season, sse, total


def _box(z: np.ndarray) -> np.ndarray:
    return LOW + (HIGH - LOW) / (1.0 + np.exp(-np.clip(z, -30, 30)))


def _unbox(p: np.ndarray) -> np.ndarray:
    share = np.clip((p - LOW) / (HIGH - LOW), 1e-4, 1 - 1e-4)
    return np.log(share / (1 - share))


def _simplex(error, z: np.ndarray, moves: np.ndarray, steps: int = STEPS):
    """Nelder-Mead for every row at once. ``z`` holds the starts (rows, 4), ``moves`` the
    coordinates that may move; ``error(points, rows)`` evaluates points (sets, rows, 4) of some rows."""
    rows, d = len(z), len(moves)
    points = np.repeat(z[:, None, :], d + 1, 1)
    for i, m in enumerate(moves):
        points[:, i + 1, m] += np.where(z[:, m] > 0, -1.0, 1.0)
    values = error(points.transpose(1, 0, 2), np.arange(rows)).T
    todo = np.arange(rows)
    for _ in range(steps):
        order = np.argsort(values[todo], 1, kind="stable")
        values[todo] = np.take_along_axis(values[todo], order, 1)
        points[todo] = np.take_along_axis(points[todo], order[:, :, None], 1)
        spread = values[todo, -1] - values[todo, 0]
        todo = todo[spread > TOLERANCE * np.maximum(values[todo, 0], 1e-12)]
        if not len(todo):
            break
        p, v = points[todo], values[todo]
        centre = p[:, :-1].mean(1)
        away = centre - p[:, -1]
        trial = np.stack([centre + c * away for c in (1.0, 2.0, 0.5, -0.5)] + [0.5 * (p[:, 0] + p[:, -1])])
        f = error(trial, todo)
        reflect, expand, outer, inner, _ = f
        best, second, worst = v[:, 0], v[:, -2], v[:, -1]
        pick = np.full(len(todo), 4)  # nothing helps: the worst point moves halfway to the best one
        pick[(inner < worst) & (reflect >= worst)] = 3
        pick[(outer <= reflect) & (reflect < worst) & (reflect >= second)] = 2
        pick[reflect < second] = 0
        pick[(reflect < best) & (expand < reflect)] = 1
        at = np.arange(len(todo))
        points[todo, -1], values[todo, -1] = trial[pick, at], f[pick, at]
    best = values.argmin(1)
    return points[np.arange(rows), best], values[np.arange(rows), best]


def fit_group(y: np.ndarray, n: np.ndarray, period: int, seasonal: bool) -> Fit:
    """Fits of series that are all seasonal or all not, longest first."""
    rows, moves = len(y), np.array([0, 1, 2, 3] if seasonal else [0, 1, 3])
    grid = np.array(STARTS[seasonal])
    sse = np.concatenate([recursion(y, n, np.repeat(part[:, None], rows, 1), period, seasonal)[3] for part in np.array_split(grid, max(1, len(grid) * rows // 8192))])
    starts = np.argsort(sse, 0, kind="stable")[:N_STARTS]
    z = _unbox(grid[starts]).reshape(-1, 4)  # all first starts, then all second ones

    def error(points, at):
        own = at % rows
        order = np.argsort(own, kind="stable")  # the recursion wants the longest first
        out = np.empty(points.shape[:2])
        params = _box(points[:, order])
        if not seasonal:
            params[..., 2] = 0.0
        out[:, order] = recursion(y[own[order]], n[own[order]], params, period, seasonal)[3]
        return out

    z, value = _simplex(error, z, moves)
    z, value = z.reshape(len(starts), rows, 4), value.reshape(len(starts), rows)
    best = value.argmin(0)
    params = _box(z[best, np.arange(rows)])
    if not seasonal:
        params[:, 2] = 0.0
    # a grid point may lie a hair below where its simplex ends
    on_grid = sse.min(0) < value.min(0)
    params[on_grid] = grid[starts[0]][on_grid]
    level, trend, season, sse, total = recursion(y, n, params[None], period, seasonal)
    mean = total[0] / np.maximum(n, 1)
    sd = np.sqrt(np.maximum(sse[0] / np.maximum(n, 1) - mean**2, 0.0))
    return Fit(level[0], trend[0], season[:, 0], params, sse[0], sd, n)


def forecast(fit: Fit, steps: int, period: int, seasonal: bool) -> np.ndarray:
    """Point forecasts (series, steps) on the fitted scale."""
    h = np.arange(1, steps + 1)
    damp = np.cumsum(fit.params[:, 3:] ** h, axis=1)
    out = fit.level[:, None] + damp * fit.trend[:, None]
    if seasonal:
        place = (fit.n[:, None] + h - 1) % period
        out = out + fit.season[place, np.arange(len(fit.n))[:, None]]
    return out


def forecast_counts(series: list, steps: int, period: int = 52, z: float = 1.96):
    """(point, lower, upper), each (series, steps), of lists of weekly counts: fitted on log1p, with a band of
    +-z standard deviations of the one-step errors there, back-transformed and clipped at 0. Series of two
    periods or more have a season."""
    out = np.zeros((3, len(series), steps))
    sizes = np.array([len(s) for s in series], np.int64)
    for seasonal in (False, True):
        own = np.flatnonzero((sizes >= 2 * period) == seasonal)
        own = own[np.argsort(-sizes[own], kind="stable")]
        for lo in range(0, len(own), ROWS):
            at = own[lo : lo + ROWS]
            n = sizes[at]
            y = np.zeros((len(at), max(1, int(n.max()))))
            for i, k in enumerate(at):
                y[i, : n[i]] = np.log1p(np.clip(np.asarray(series[k], float), 0, None))
            fitted = fit_group(y, n, period, seasonal)
            point = forecast(fitted, steps, period, seasonal)
            for j, shift in enumerate((0.0, -1.0, 1.0)):
                out[j, at] = np.clip(np.expm1(point + shift * z * fitted.sd[:, None]), 0, None)
    return out[0], out[1], out[2]
