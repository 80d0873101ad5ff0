import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from flowplan.config import ForecastConfig
from flowplan.operators import arima as arima_module
from flowplan.operators.arima import arima
from flowplan.operators.models import (
    MULTI_STEP,
    BrokenModel,
    ColumnModel,
    Registry,
    SeriesModel,
    naive,
    rolling,
    seasonal,
)
from flowplan.operators.smoothing import ets, ets_grid, fit_batch
from flowplan.plans.forecast import default_registry, run_forecast


def forecasts(demand, factory, ratio=0.8, **params):
    registry = Registry()
    registry.register("m", factory)
    run = run_forecast(demand, ForecastConfig(["m"], ratio, model_params={"m": params}), registry)
    return [r["forecast"] for r in run.forecasts.orderBy("destination_id", "date").collect()]


LINE = [10 + 2.0 * i for i in range(60)]


def test_naive_uses_actuals_inside_the_window(make):
    assert forecasts(make.demand(A=[1, 2, 3, 4, 5, 6, 7, 8, 9, 10]), naive, 0.7) == [7, 8, 9]


def test_seasonal_null_where_history_is_short(make):
    assert forecasts(make.demand(A=range(10)), seasonal, 0.3, lag_value=5) == [None, None, 0, 1, 2, 3, 4]


def test_rolling_mean(make):
    values = forecasts(make.demand(A=[10, 20, 30, 40, 50, 60, 70, 80, 90]), rolling, 0.78, rolling_window=7)
    assert values == [40.0, 50.0]


def test_rolling_needs_every_value(make):
    values = forecasts(make.demand(A=[1, 2, None, 4, 5, 6, 7, 8]), rolling, 0.5, rolling_window=3)
    assert values == [None, None, 5.0, 6.0]


@pytest.mark.parametrize("factory", [ets, ets_grid])
def test_smoothing_continues_a_line(make, factory):
    values = forecasts(make.demand(A=LINE), factory, 0.84)
    assert values == pytest.approx(LINE[50:])


def test_arima_continues_growing(make):
    values = forecasts(make.demand(A=LINE), arima, 0.84)
    assert values == pytest.approx(LINE[50:], rel=1e-6)
    conditional = forecasts(make.demand(A=LINE), arima, 0.84, estimate="conditional")
    assert conditional == pytest.approx(LINE[50:])


def test_arima_is_a_window_column_by_default():
    assert isinstance(arima(), ColumnModel)
    assert isinstance(arima((2, 1, 1)), SeriesModel)
    with pytest.raises(ValueError):
        arima((1, -1, 0))
    with pytest.raises(ValueError):
        arima((1, 0, 0), (1, 0, 0, 1))


def likelihood(phi, x):
    n = len(x)
    total = (1 - phi**2) * x[0] ** 2 + ((x[1:] - phi * x[:-1]) ** 2).sum()
    return 0.5 * n * math.log(total / n) - 0.5 * math.log(1 - phi**2)


def test_arima_coefficient_maximises_the_likelihood(make):
    rng = np.random.default_rng(3)
    series = {}
    for i, phi in enumerate((-0.9, -0.3, 0.0, 0.5, 0.95)):
        x = np.zeros(40)
        for t in range(1, 40):
            x[t] = phi * x[t - 1] + rng.normal()
        series[f"S{i}"] = 100 + np.cumsum(x)
    values = np.reshape(forecasts(make.demand(**series), arima), (5, 8))
    grid = np.linspace(-0.999, 0.999, 3999)
    for y, found in zip(series.values(), values):
        x = np.diff(y[:32])
        best = grid[np.argmin([likelihood(p, x) for p in grid])]
        step = found[0] - y[31]
        assert step / x[-1] == pytest.approx(best, abs=2e-3)
        assert found[1] - found[0] == pytest.approx(best * step, abs=5e-2)


def test_arima_degenerate_series(make):
    assert forecasts(make.demand(A=[5] * 10), arima) == [5.0, 5.0]
    assert forecasts(make.demand(A=[5, 7, 7, 7]), arima, 0.5) == pytest.approx([7.0 + 0, 7.0], abs=3)


def test_general_arima_beats_its_start_and_recovers_a_season():
    y = np.tile([5.0, 9.0, 2.0, 4.0], 15) + np.arange(60) * 0.5
    train = pd.DataFrame({"demand": y[:48]})
    made = arima_module.fit_forecast(train, 12, (0, 0, 0), (0, 1, 0, 4), )
    assert made == pytest.approx(np.tile(y[44:48], 3))
    made = arima_module.fit_forecast(train, 12, (0, 1, 0), (0, 1, 0, 4))
    assert made == pytest.approx(y[48:])


def test_general_arima_recovers_coefficients():
    rng = np.random.default_rng(0)
    e = rng.normal(size=3000)
    x = np.zeros(3000)
    for t in range(1, 3000):
        x[t] = 0.6 * x[t - 1] + e[t] + 0.4 * e[t - 1]
    made = arima_module.fit_forecast(pd.DataFrame({"demand": x}), 3, (1, 0, 1), (0, 0, 0, 0))
    assert made[1] / made[0] == pytest.approx(0.6, abs=0.06)


def least_error_forecast(y):
    """Brute force: best start by least squares for every pair of weights on a fine grid."""

    def errors(alpha, beta, level, slope, values):
        out = []
        for value in values:
            e = value - level - slope
            out.append(e)
            level, slope = level + slope + alpha * e, slope + alpha * beta * e
        return np.array(out), level + slope

    best = (np.inf, None)
    zero = np.zeros(len(y))
    for alpha in np.arange(0.05, 1.0, 0.05):
        for beta in np.arange(0.0, 1.0, 0.05):
            base, _ = errors(alpha, beta, 0.0, 0.0, y)
            basis = np.stack([errors(alpha, beta, *start, zero)[0] for start in ((1, 0), (0, 1))], axis=1)
            start = -np.linalg.lstsq(basis, base, rcond=None)[0]
            e, ahead = errors(alpha, beta, *start, y)
            best = min(best, (e @ e, ahead))
    return best[1]


def test_smoothing_agrees_with_brute_force_whatever_the_block():
    rng = np.random.default_rng(1)
    ys = [np.cumsum(rng.normal(0.5, 4, n)) + 80 for n in (40, 55, 41)]
    made = fit_batch(ys, [1, 1, 1], "add", None, 0)
    for y, forecast in zip(ys, made):
        assert forecast == pytest.approx(fit_batch([y], [1], "add", None, 0)[0], rel=1e-6)
        assert forecast[0] == pytest.approx(least_error_forecast(y), rel=0.02)


@pytest.mark.parametrize("trend", ["add", "mul", None])
@pytest.mark.parametrize("kind", ["add", "mul", None])
def test_every_smoothing_form(trend, kind):
    season = np.tile([1.0, 1.2, 0.8, 1.0], 12)
    y = (100 + np.arange(48)) * season
    made = fit_batch([y, y[3:]], [4, 4], trend, kind, 4 if kind else 0)
    assert all(len(f) == 4 and np.isfinite(f).all() for f in made)
    if trend and kind:
        expected = (148 + np.arange(4)) * season[:4]
        assert made[0] == pytest.approx(expected, rel=0.1)


def test_smoothing_reports_unfit_series():
    made = fit_batch([np.array([1.0]), np.array([1.0, np.nan, 2.0]), np.array([0.0, 1.0, 2.0])], [1] * 3, "mul", None, 0)
    assert all(isinstance(reason, str) for reason in made)
    with pytest.raises(ValueError):
        ets(seasonal="add")
    with pytest.raises(ValueError):
        ets(trend="other")


def test_registry_order_overwrite_and_unknown():
    registry = default_registry()
    names = registry.names()
    registry.register("naive_forecaster", lambda: "replaced")
    assert registry.names() == names and len(registry) == 5
    assert registry.create("naive_forecaster") == "replaced"
    assert "ets_forecaster" in registry and "other" not in registry
    with pytest.raises(KeyError, match="naive_forecaster"):
        registry.create("other")


def test_bad_parameters_break_only_their_model():
    made = default_registry().create_all(["naive_forecaster", "ets_forecaster"], {"ets_forecaster": {"x": 1}})
    assert isinstance(made[0], ColumnModel) and isinstance(made[1], BrokenModel)


def test_display_names():
    assert naive().name == "naive_forecaster"
    assert seasonal().name == "seasonal_forecaster_lag_7"
    assert rolling(7).name == "ma_7_forecaster"


def test_user_model_and_its_failure(make):
    def factory():
        def forecast(train, window):
            if train["demand"].iloc[0] == 0:
                raise RuntimeError("no start")
            return [train["demand"].mean()] * len(window)

        return SeriesModel("mine", MULTI_STEP, forecast)

    registry = default_registry()
    registry.register("mine", factory)
    config = ForecastConfig(["mine", "naive_forecaster"])
    run = run_forecast(make.demand(A=[2, 4, 6, 8, 5, 5, 5, 5, 5, 5], B=range(10)), config, registry)
    rows = {(r["destination_id"], r["model"]): r for r in run.models.collect()}
    assert rows["B", "mine"]["error"] == "no start" and rows["A", "mine"]["error"] is None
    chosen = {r["destination_id"]: r["model"] for r in run.selected.collect()}
    assert chosen["B"] == "naive_forecaster"
    assert run.outcomes.filter(F.col("success")).count() == 2
