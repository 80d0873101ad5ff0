"""ARIMA forecasts.

The default order (1,1,0) needs only sums over the differenced series, so it is solved in
window columns. Other orders fit each series by conditional least squares in NumPy.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowplan.operators.models import MULTI_STEP, ColumnModel, Model, Phase, SeriesModel
from flowplan.operators.panel import in_series, whole_series

NAME = "sarimax_forecaster"


def arima(
    order: tuple[int, int, int] = (1, 1, 0),
    seasonal_order: tuple[int, int, int, int] | None = None,
    estimate: str = "ml",
) -> Model:
    """ARIMA without intercept, forecasting the whole window from the end of the fit."""
    order = tuple(order)
    seasonal = (0, 0, 0, 0) if seasonal_order is None else tuple(seasonal_order)
    if len(order) != 3 or len(seasonal) != 4 or min(order + seasonal) < 0:
        raise ValueError(f"bad ARIMA order {order} {seasonal}")
    if any(seasonal[:3]) and seasonal[3] < 2:
        raise ValueError("a seasonal order needs a season of at least 2 periods")
    if order == (1, 1, 0) and not any(seasonal[:3]):
        return ColumnModel(NAME, MULTI_STEP, lambda *args: _attach_110(*args, estimate))
    return SeriesModel(
        NAME, MULTI_STEP, lambda train, window: fit_forecast(train, len(window), order, seasonal)
    )


def _attach_110(panel: DataFrame, phase: Phase, out: str, estimate: str) -> DataFrame:
    whole, x, x_lag = whole_series(), F.col("_x"), F.col("_x_lag")
    paired = x_lag.isNotNull()

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value).over(whole), F.lit(0.0))

    panel = panel.withColumn(
        "_x", F.when(phase.is_fitted, F.col("demand") - F.lag("demand", 1).over(in_series()))
    )
    panel = panel.withColumn("_x_lag", F.when(phase.is_fitted, F.lag("_x", 1).over(in_series())))
    panel = panel.withColumns(
        {
            "_count": F.count("_x").over(whole),
            "_first": total(F.when(F.col("rn") == 2, x)),
            "_own": total(F.when(paired, x * x)),
            "_cross": total(x * x_lag),
            "_past": total(x_lag * x_lag),
            "_x_end": total(F.when(F.col("rn") == phase.fitted, x)),
            "_y_end": F.max(F.when(F.col("rn") == phase.fitted, F.col("demand"))).over(whole),
            "_whole": F.count(F.when(phase.is_fitted, F.col("demand"))).over(whole) == phase.fitted,
        }
    )
    phi = _conditional_phi() if estimate == "conditional" else _likeliest_phi()
    step, root = phase.step, F.col("_phi")
    damped = F.when(F.abs(1.0 - root) < 1e-8, step.cast("double")).otherwise(
        root * (1.0 - F.pow(root, step)) / (1.0 - root)
    )
    value = F.col("_y_end") + F.col("_x_end") * damped
    return (
        panel.withColumn("_phi", phi)
        .withColumn(out, F.when(phase.is_forecast & F.col("_whole"), value))
        .drop(
            "_x", "_x_lag", "_count", "_first", "_own", "_cross", "_past",
            "_x_end", "_y_end", "_whole", "_phi",
        )
    )


def _conditional_phi() -> Column:
    return F.when(F.col("_past") > 0, F.col("_cross") / F.col("_past")).otherwise(F.lit(0.0))


def _likeliest_phi() -> Column:
    """The stationary coefficient of greatest exact Gaussian likelihood.

    Setting the derivative of the concentrated likelihood to zero gives a cubic with three
    real roots; the middle one lies in [-1, 1].
    """
    n = F.col("_count").cast("double")
    first = F.col("_first") * F.col("_first")
    ends, inner, cross = first + F.col("_own"), F.col("_past") - first, F.col("_cross")
    lead = (n - 1.0) * inner
    b = -(n - 2.0) * cross / lead
    c = -(n * inner + ends) / lead
    d = n * cross / lead
    p = c - b * b / 3.0
    q = 2.0 * b * b * b / 27.0 - b * c / 3.0 + d
    angle = F.acos(
        F.least(F.lit(1.0), F.greatest(F.lit(-1.0), 1.5 * q / p * F.sqrt(-3.0 / p)))
    )
    middle = 2.0 * F.sqrt(-p / 3.0) * F.cos(angle / 3.0 - 2.0943951023931953) - b / 3.0
    return (
        F.when((n > 1) & (inner > 0), F.least(F.lit(1.0), F.greatest(F.lit(-1.0), middle)))
        .when((n == 2) & (ends > 0), 2.0 * cross / ends)
        .otherwise(F.lit(0.0))
    )


def _lag_polynomial(short: np.ndarray, long: np.ndarray, season: int, sign: float) -> np.ndarray:
    base = np.r_[1.0, sign * short]
    stretched = np.zeros(len(long) * season + 1)
    stretched[0] = 1.0
    if len(long):
        stretched[season::season] = sign * long
    return np.convolve(base, stretched)


def _stable(polynomial: np.ndarray) -> bool:
    """All roots of ``1 + c1 z + ...`` lie outside the unit circle."""
    return len(polynomial) == 1 or bool(np.all(np.abs(np.roots(polynomial)) < 1.0))


def _residuals(w: np.ndarray, ar: np.ndarray, ma: np.ndarray) -> np.ndarray:
    """Conditional residuals with zeros before the start."""
    e = np.convolve(w, ar)[: len(w)]
    if len(ma) > 1:
        reach = len(ma) - 1
        padded = np.r_[np.zeros(reach), e]
        for t in range(reach, len(padded)):
            padded[t] -= ma[1:] @ padded[t - reach : t][::-1]
        e = padded[reach:]
    return e


def fit_forecast(
    train: pd.DataFrame,
    steps: int,
    order: tuple[int, int, int],
    seasonal: tuple[int, int, int, int],
) -> np.ndarray:
    """Difference, fit by Levenberg-Marquardt on conditional residuals, forecast, integrate."""
    (p, d, q), (sp, sd, sq, season) = order, seasonal
    y = train["demand"].to_numpy(dtype=float)
    if len(y) <= d + sd * season or not np.all(np.isfinite(y)):
        raise ValueError("too few observations, or missing ones, for this ARIMA order")
    difference = np.array([1.0])
    for gap in [1] * d + [season] * sd:
        factor = np.zeros(gap + 1)
        factor[0], factor[-1] = 1.0, -1.0
        difference = np.convolve(difference, factor)
    w = np.convolve(y, difference, mode="valid")

    def polynomials(theta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ar_s, ar_l, ma_s, ma_l = np.split(theta, np.cumsum([p, sp, q])[:3])
        return (
            _lag_polynomial(ar_s, ar_l, season, -1.0),
            _lag_polynomial(ma_s, ma_l, season, 1.0),
        )

    def errors(theta: np.ndarray) -> np.ndarray | None:
        ar, ma = polynomials(theta)
        return _residuals(w, ar, ma) if _stable(ar) and _stable(ma) else None

    theta = np.zeros(p + sp + q + sq)
    e, damping = errors(theta), 1e-3
    for _ in range(100 if len(theta) else 0):
        slopes = []
        for j in range(len(theta)):
            nudge = np.zeros_like(theta)
            nudge[j] = 1e-6 if theta[j] <= 0 else -1e-6
            moved = errors(theta + nudge)
            slopes.append(np.zeros_like(e) if moved is None else (moved - e) / nudge[j])
        jacobian = np.array(slopes).T
        gram = jacobian.T @ jacobian
        push = np.linalg.lstsq(
            gram + damping * np.diag(np.diag(gram) + 1e-12), -jacobian.T @ e, rcond=None
        )[0]
        trial = errors(theta + push)
        if trial is not None and trial @ trial < e @ e:
            gain = e @ e - trial @ trial
            theta, e, damping = theta + push, trial, damping / 3
            if gain <= 1e-12 * (e @ e + 1e-12):
                break
        else:
            damping *= 4
            if damping > 1e10:
                break

    ar, ma = polynomials(theta)
    full = np.convolve(ar, difference)
    history, noise = list(y), list(e)
    for _ in range(steps):
        past = sum(-c * history[-k] for k, c in enumerate(full) if 0 < k <= len(history))
        shock = sum(c * noise[-k] for k, c in enumerate(ma) if 0 < k <= len(noise))
        history.append(past + shock)
        noise.append(0.0)
    return np.array(history[len(y):])
