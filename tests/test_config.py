import pytest

from flowplan.config import ForecastConfig, ScenarioConfig


def test_defaults():
    config = ForecastConfig(["naive_forecaster"])
    assert (config.train_ratio, config.selection_metric, config.minimum_history_length) == (0.8, "wape", 2)
    assert not config.three_way


@pytest.mark.parametrize(
    "bad",
    [
        {"model_names": []},
        {"model_names": ["m"] * 21},
        {"model_names": [" "]},
        {"model_names": [1]},
        {"model_names": "naive"},
        {"train_ratio": 0},
        {"train_ratio": 1.0},
        {"train_ratio": "0.5"},
        {"selection_metric": "r2"},
        {"minimum_history_length": 0},
        {"minimum_history_length": 2.5},
        {"model_params": {"other": {}}},
        {"model_params": {"m": 3}},
        {"validation_periods": 3},
        {"test_periods": 3},
        {"validation_periods": 0, "test_periods": 3},
        {"validation_periods": 1.5, "test_periods": 3},
    ],
)
def test_rejected(bad):
    with pytest.raises(ValueError):
        ForecastConfig(**({"model_names": ["m"]} | bad))


@pytest.mark.parametrize(
    "bad",
    [
        {"forecast_strategy": "best"},
        {"plan_strategy": "best"},
        {"test_periods": 0},
        {"forecast_strategy": "selected", "forecasting": None},
    ],
)
def test_scenario_rejected(bad):
    good = {"forecasting": ForecastConfig(["m"])}
    with pytest.raises(ValueError):
        ScenarioConfig("s", **(good | bad))
