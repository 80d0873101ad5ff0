"""Parameter contracts, checked on construction."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

METRICS = ("mae", "mse", "rmse", "mape", "wape")
STRATEGIES = ("naive", "selected")
PLANNERS = ("naive", "optimized")


def _whole(value: Any) -> bool:
    return isinstance(value, int) and not isinstance(value, bool)


@dataclass(frozen=True)
class ForecastConfig:
    model_names: tuple[str, ...]
    train_ratio: float = 0.8
    selection_metric: str = "wape"
    minimum_history_length: int = 2
    model_params: dict[str, dict[str, Any]] = field(default_factory=dict)
    validation_periods: int | None = None
    test_periods: int | None = None

    def __post_init__(self) -> None:
        names = self.model_names
        if isinstance(names, str) or not 1 <= len(names) <= 20:
            raise ValueError("model_names must hold 1 to 20 names")
        if any(not isinstance(name, str) or not name.strip() for name in names):
            raise ValueError("model_names must be non-blank strings")
        object.__setattr__(self, "model_names", tuple(names))
        if isinstance(self.train_ratio, bool) or not isinstance(self.train_ratio, (int, float)):
            raise ValueError("train_ratio must be a number")
        if not 0 < self.train_ratio < 1:
            raise ValueError(f"train_ratio must lie strictly between 0 and 1: {self.train_ratio}")
        if self.selection_metric not in METRICS:
            raise ValueError(f"selection_metric must be one of {sorted(METRICS)}")
        if not _whole(self.minimum_history_length) or self.minimum_history_length < 1:
            raise ValueError("minimum_history_length must be a positive integer")
        for name, params in self.model_params.items():
            if name not in names:
                raise ValueError(f"model_params names a model that is not listed: {name}")
            if not isinstance(params, dict):
                raise ValueError(f"model_params[{name!r}] must be a dict")
        for name in ("validation_periods", "test_periods"):
            value = getattr(self, name)
            if value is not None and (not _whole(value) or value < 1):
                raise ValueError(f"{name} must be an integer of at least 1")
        if (self.validation_periods is None) != (self.test_periods is None):
            raise ValueError("validation_periods and test_periods go together")

    @property
    def three_way(self) -> bool:
        return self.test_periods is not None


@dataclass(frozen=True)
class ScenarioConfig:
    name: str
    forecast_strategy: str = "selected"
    plan_strategy: str = "optimized"
    test_periods: int = 30
    forecasting: ForecastConfig | None = None

    def __post_init__(self) -> None:
        if self.forecast_strategy not in STRATEGIES:
            raise ValueError(f"forecast_strategy must be one of {STRATEGIES}")
        if self.plan_strategy not in PLANNERS:
            raise ValueError(f"plan_strategy must be one of {PLANNERS}")
        if not _whole(self.test_periods) or self.test_periods < 1:
            raise ValueError("test_periods must be a positive integer")
        if self.forecast_strategy == "selected" and self.forecasting is None:
            raise ValueError("the selected forecast needs a forecasting section")
