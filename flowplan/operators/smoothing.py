"""Exponential smoothing forecasts.

``ets`` fits every trend and seasonal form per series. ``ets_grid`` is the additive-trend
form with fixed starts and a given grid of weights, folded over arrays by Spark itself.
"""

from __future__ import annotations

from itertools import product

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowplan.operators.models import MULTI_STEP, ColumnModel, Model, Phase, SeriesModel

NAME = "ets_forecaster"
KINDS = ("add", "mul", None)
# Numbers held per block of series while fitting (32 MB).
BLOCK = 4_000_000
# Smallest smoothing weight.
LEAST = 1e-4


def ets(
    trend: str | None = "add",
    seasonal: str | None = None,
    seasonal_periods: int | None = None,
) -> Model:
    """Holt-Winters smoothing, forecasting the whole window from the end of the fit."""
    if trend not in KINDS or seasonal not in KINDS:
        raise ValueError("trend and seasonal must be 'add', 'mul' or None")
    if seasonal is not None and (seasonal_periods is None or seasonal_periods < 2):
        raise ValueError("a seasonal component needs seasonal_periods of at least 2")
    period = seasonal_periods if seasonal else 0
    return SeriesModel(
        NAME,
        MULTI_STEP,
        batch=lambda trains, steps: fit_batch(trains, steps, trend, seasonal, period),
    )


def fit_batch(
    trains: list[np.ndarray], steps: list[int], trend: str | None, seasonal: str | None, period: int
) -> list[np.ndarray | str]:
    """Forecasts per series, or the reason why one has none.

    Series are fitted side by side in blocks, so that a step of the recursion is one array
    operation over many series and many candidate weights.
    """
    made: list[np.ndarray | str] = [_unfit(y, trend, seasonal, period) for y in trains]
    open_ids = [i for i, reason in enumerate(made) if reason is None]
    open_ids.sort(key=lambda i: len(trains[i]))
    width = 1 + (trend is not None) + (seasonal is not None)
    marks = np.linspace(-1.0, 1.0, 9 if width < 3 else 5)
    candidates = np.array(list(product(marks, repeat=width)))
    row = len(candidates) * (2 + period + (trend is not None))
    at = 0
    while at < len(open_ids):
        longest = len(trains[open_ids[min(at + 63, len(open_ids) - 1)]])
        ids = open_ids[at : at + max(1, min(64, BLOCK // (row * longest)))]
        at += len(ids)
        for i, forecast in zip(ids, _fit_block([trains[i] for i in ids], [steps[i] for i in ids],
                                               candidates, trend, seasonal, period)):
            made[i] = forecast if np.all(np.isfinite(forecast)) else "smoothing did not settle"
    return made


def _unfit(y: np.ndarray, trend: str | None, seasonal: str | None, period: int) -> str | None:
    if len(y) < 2 or len(y) < 2 * period or not np.all(np.isfinite(y)):
        return "too few observations, or missing ones, for exponential smoothing"
    if "mul" in (trend, seasonal) and y.min() <= 0:
        return "multiplicative components need positive demand"
    return None


def _fit_block(trains, steps, candidates, trend, seasonal, period):
    """Search the weights for the least squared one-step error, then extrapolate.

    A coarse grid gives the best point of each third of the slowest-changing weight; finer
    grids then close in on all three, since the error can have several valleys.
    """
    length = max(map(len, trains))
    offset = np.array([length - len(y) for y in trains])
    # Series end together; shorter ones wait until their first observation.
    values = np.stack([np.r_[np.zeros(o), y] for o, y in zip(offset, trains)], axis=1)
    evaluate = _general if "mul" in (trend, seasonal) else _additive
    width = candidates.shape[1]

    def tried(weights):
        sse, ends = evaluate(values, offset, weights, trend, seasonal, period)
        return np.where(np.isfinite(sse), sse, np.inf), ends

    third = np.digitize(candidates[:, 1 if trend else 0], (-0.34, 0.34))
    each = np.arange(len(trains))
    coarse = np.clip(0.5 + 0.49 * candidates, LEAST, 1.0 - LEAST)
    sse, ends = tried(np.broadcast_to(coarse, (len(trains), *coarse.shape)))
    first = [np.where(third == k, sse, np.inf).argmin(axis=1) for k in range(3)]
    centre = np.stack([coarse[i] for i in first], axis=1)
    least = np.stack([sse[each, i] for i in first], axis=1)
    end = np.stack([ends[each, i] for i in first], axis=1)
    steps_around = np.array(list(product((-1.0, 0.0, 1.0), repeat=width)))
    reach = 0.49 / (len(np.unique(candidates[:, 0])) - 1)
    for _ in range(7):
        weights = np.clip(centre[:, :, None] + reach * steps_around, LEAST, 1.0 - LEAST)
        sse, ends = tried(weights.reshape(len(trains), -1, width))
        sse = sse.reshape(*weights.shape[:3])
        ends = ends.reshape(*weights.shape[:3], -1)
        pick = (*np.indices(least.shape), sse.argmin(axis=2))
        better = sse[pick] < least
        centre[better], end[better] = weights[pick][better], ends[pick][better]
        least = np.where(better, sse[pick], least)
        reach *= 0.45
    end = end[each, least.argmin(axis=1)]
    for state, count in zip(end, steps):
        ahead = np.arange(1, count + 1)
        at = 1 + (trend is not None)
        forecast = np.full(count, state[0])
        if trend == "add":
            forecast = forecast + state[1] * ahead
        elif trend == "mul":
            forecast = forecast * state[1] ** ahead
        if period:
            season = state[at + (length + ahead - 1) % period]
            forecast = forecast * season if seasonal == "mul" else forecast + season
        yield forecast


def _additive(y, offset, weights, trend, seasonal, period):
    """Errors are linear in the start state, so the best start is a least-squares solution."""
    series, count = weights.shape[:2]
    season_at = 1 + (trend is not None)
    size = season_at + period
    # Column 0 of the state answers to the data, column k to start state k.
    state = np.zeros((series, count, size, size + 1))
    state[..., np.arange(size), np.arange(size) + 1] = 1.0
    alpha = weights[..., 0, None]
    beta = weights[..., 1, None] * alpha if trend else None
    gamma = weights[..., -1, None] * (1.0 - alpha) if period else None
    answers = np.empty((len(y), series, count, size + 1))
    latest = offset.max()
    for t, value in enumerate(y):
        level = state[:, :, 0] + state[:, :, 1] if trend else state[:, :, 0].copy()
        error = -level
        if period:
            slot = season_at + t % period
            error -= state[:, :, slot]
        error[..., 0] += value[:, None]
        if t < latest:
            waiting = offset > t
            error[waiting] = 0.0
            level[waiting] = state[waiting, :, 0]
        answers[t] = error
        state[:, :, 0] = level + alpha * error
        if trend:
            state[:, :, 1] += beta * error
        if period:
            state[:, :, slot] += gamma * error
    answers = np.ascontiguousarray(answers.transpose(1, 2, 3, 0))
    base, basis = answers[:, :, :1], answers[:, :, 1:]
    gram, pull = basis @ basis.swapaxes(2, 3), basis @ base.swapaxes(2, 3)
    # Level and seasons overlap in one direction; a trace of ridge settles it.
    ridge = 1e-11 * np.trace(gram, axis1=2, axis2=3)[:, :, None, None] + 1e-30
    start = -np.linalg.solve(gram + ridge * np.eye(size), pull)
    residual = base + start.swapaxes(2, 3) @ basis
    end = state[..., 0] + (state[..., 1:] @ start)[..., 0]
    return (residual[:, :, 0] ** 2).sum(axis=2), end


def _general(y, offset, weights, trend, seasonal, period):
    """Forms with a product in them, started from the first seasons (or points)."""
    series, count = weights.shape[:2]
    lead = max(period, 1)
    level, slope = np.empty((series, count)), np.zeros((series, count))
    seasons = np.empty((series, count, lead))
    for i, o in enumerate(offset):
        head = y[o : o + lead, i]
        first, second = head.mean(), y[o + lead : o + 2 * lead, i].mean()
        level[i] = first
        if trend:
            slope[i] = (second - first) / lead if trend == "add" else (second / first) ** (1 / lead)
        slots = (o + np.arange(lead)) % lead
        seasons[i][:, slots] = head / first if seasonal == "mul" else head - first
    alpha = weights[..., 0]
    beta = weights[..., 1] if trend else None
    gamma = weights[..., -1] if seasonal else None
    sse, latest = np.zeros((series, count)), offset.max()
    with np.errstate(all="ignore"):
        for t, value in enumerate(y):
            value, slot = value[:, None], t % lead
            before = (level.copy(), slope.copy(), seasons[..., slot].copy())
            season = before[2]
            expected = {"add": level + slope, "mul": level * slope, None: level}[trend]
            fitted = {"add": expected + season, "mul": expected * season, None: expected}[seasonal]
            miss = (value - fitted) ** 2
            plain = {"add": value - season, "mul": value / season, None: value}[seasonal]
            risen = alpha * plain + (1 - alpha) * expected
            if trend:
                change = risen - level if trend == "add" else risen / level
                slope = beta * change + (1 - beta) * slope
            if seasonal:
                swing = value - expected if seasonal == "add" else value / expected
                seasons[..., slot] = gamma * swing + (1 - gamma) * season
            level = risen
            if t < latest:
                waiting = offset > t
                miss[waiting] = 0.0
                level[waiting], slope[waiting] = before[0][waiting], before[1][waiting]
                seasons[waiting, :, slot] = before[2][waiting]
            sse += miss
    parts = [level[..., None]] + ([slope[..., None]] if trend else []) + ([seasons] if period else [])
    return sse, np.concatenate(parts, axis=2)


def ets_grid(
    weights: tuple[tuple[float, float], ...] = tuple(
        (a / 4.0, b / 4.0) for a in range(1, 4) for b in range(0, a + 1)
    ),
) -> ColumnModel:
    """Holt's linear form over (alpha, beta) pairs, started at y1 and y2 - y1, least error wins."""

    def attach(panel: DataFrame, phase: Phase, out: str) -> DataFrame:
        columns = [name for name in panel.columns if name not in ("destination_id", "rn")]
        series = (
            panel.withColumn("_fitted", phase.fitted)
            .groupBy("destination_id")
            .agg(
                F.array_sort(F.collect_list(F.struct("rn", *columns))).alias("_rows"),
                F.max("_fitted").alias("_fitted"),
            )
        )
        fitted = F.transform(
            F.filter(F.col("_rows"), lambda row: row["rn"] <= F.col("_fitted")),
            lambda row: row["demand"],
        )
        grid = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in weights])
        tried = F.transform(grid, lambda pair: _holt(F.col("_y"), pair))
        step = phase.step.cast("double")
        return (
            series.withColumn("_y", fitted)
            .withColumn("_best", F.when(F.size("_y") >= 2, F.array_min(tried)))
            .select("destination_id", "_best", F.inline("_rows"))
            .withColumn(
                out,
                F.when(phase.is_forecast, F.col("_best.level") + F.col("_best.slope") * step),
            )
            .drop("_best")
        )

    return ColumnModel(NAME, MULTI_STEP, attach)


def _holt(y: Column, pair: Column) -> Column:
    start = F.struct(
        F.lit(0.0).alias("sse"),
        pair["a"].alias("a"),
        pair["b"].alias("b"),
        F.get(y, 0).alias("level"),
        (F.get(y, 1) - F.get(y, 0)).alias("slope"),
    )

    def step(state: Column, value: Column) -> Column:
        error = value - (state["level"] + state["slope"])
        return F.struct(
            (state["sse"] + error * error).alias("sse"),
            state["a"].alias("a"),
            state["b"].alias("b"),
            (state["level"] + state["slope"] + state["a"] * error).alias("level"),
            (state["slope"] + state["a"] * state["b"] * error).alias("slope"),
        )

    return F.aggregate(F.slice(y, 2, F.greatest(F.size(y) - 1, F.lit(0))), start, step)
