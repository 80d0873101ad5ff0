"""The model contract, the registry, and models that are plain window columns.

A model adds one forecast column to a panel that carries, per row, its number ``rn`` in the
series, the series length ``n`` and the number of fitted rows. Column models stay inside
Spark expressions. Series models are a pandas function called once per series on its arrays.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowplan.operators.panel import in_series, on_dates

ONE_STEP = "one_step"
MULTI_STEP = "multi_step"

Forecast = Callable[[pd.DataFrame, pd.DataFrame], Iterable[float]]
Batch = Callable[[list[np.ndarray], list[int]], list[np.ndarray | str]]


@dataclass(frozen=True)
class Phase:
    """Columns that say which rows a model is fitted on and which it forecasts."""

    fitted: Column
    until: Column

    @property
    def is_fitted(self) -> Column:
        return F.col("rn") <= self.fitted

    @property
    def step(self) -> Column:
        return F.col("rn") - self.fitted

    @property
    def is_forecast(self) -> Column:
        return (F.col("rn") > self.fitted) & (F.col("rn") <= self.until)


@dataclass(frozen=True)
class ColumnModel:
    """``attach(panel, phase, out)`` returns the panel with forecast column ``out``."""

    name: str
    mode: str
    attach: Callable[[DataFrame, Phase, str], DataFrame]


@dataclass(frozen=True)
class SeriesModel:
    """A model fitted in Python, one series at a time or many at once.

    ``forecast(train, window)`` gets two frames (date, demand) and returns one value per
    window row. ``batch(trains, steps)`` gets the fitted values and window lengths of many
    series and returns, per series, the forecasts or the text of an error.
    """

    name: str
    mode: str
    forecast: Forecast | None = None
    batch: Batch | None = None


@dataclass(frozen=True)
class BrokenModel:
    """A model whose factory failed: it is reported as failed in every series."""

    name: str
    mode: str
    error: str


Model = ColumnModel | SeriesModel | BrokenModel


class Registry:
    """Model factories by name, in insertion order; registering again keeps the position."""

    def __init__(self) -> None:
        self._factories: dict[str, Callable[..., Model]] = {}

    def register(self, name: str, factory: Callable[..., Model]) -> None:
        self._factories[name] = factory

    def names(self) -> list[str]:
        return list(self._factories)

    def __contains__(self, name: str) -> bool:
        return name in self._factories

    def __len__(self) -> int:
        return len(self._factories)

    def create(self, name: str, **params: Any) -> Model:
        if name not in self._factories:
            raise KeyError(f"no model named {name!r}; available: {self.names()}")
        return self._factories[name](**params)

    def create_all(self, names: Iterable[str], params: dict[str, dict[str, Any]]) -> list[Model]:
        """All models of a run. Unknown names raise; bad parameters break only their model."""
        models: list[Model] = []
        for name in names:
            if name not in self:
                raise KeyError(f"no model named {name!r}; available: {self.names()}")
            try:
                models.append(self.create(name, **params.get(name, {})))
            except Exception as problem:
                models.append(BrokenModel(name, MULTI_STEP, str(problem)))
        return models


def naive() -> ColumnModel:
    """The previous actual."""
    return lagged("naive_forecaster", 1)


def seasonal(lag_value: int = 7) -> ColumnModel:
    """The actual ``lag_value`` rows earlier."""
    return lagged(f"seasonal_forecaster_lag_{lag_value}", lag_value)


def lagged(name: str, rows: int) -> ColumnModel:
    def attach(panel: DataFrame, phase: Phase, out: str) -> DataFrame:
        return panel.withColumn(out, F.lag("demand", rows).over(in_series()))

    return ColumnModel(name, ONE_STEP, attach)


def rolling(rolling_window: int = 1) -> ColumnModel:
    """The mean of the previous ``rolling_window`` actuals, null unless all are present."""

    def attach(panel: DataFrame, phase: Phase, out: str) -> DataFrame:
        frame = in_series().rowsBetween(-rolling_window, -1)
        full = F.count("demand").over(frame) == rolling_window
        return panel.withColumn(out, F.when(full, F.avg("demand").over(frame)))

    return ColumnModel(f"ma_{rolling_window}_forecaster", ONE_STEP, attach)


def lag_one_panel(demand: DataFrame, dates: DataFrame) -> DataFrame:
    """Lag-1 signal over the whole history, kept on ``dates``, rows without a past dropped."""
    lagged_rows = demand.select(
        "destination_id", "date", F.lag("demand", 1).over(in_series()).alias("demand")
    )
    kept = on_dates(lagged_rows, dates).filter(F.col("demand").isNotNull())
    return kept.select("destination_id", "date", "demand")


def attach_all(
    panel: DataFrame, models: list[Model], phase: Phase, label: str
) -> DataFrame:
    """Add ``fc_<label>_<i>`` and ``err_<label>_<i>`` for every model, on one partitioning."""
    for i, model in enumerate(models):
        out, err = f"fc_{label}_{i}", f"err_{label}_{i}"
        if isinstance(model, ColumnModel):
            panel = model.attach(panel, phase, out).withColumn(err, F.lit(None).cast("string"))
        elif isinstance(model, BrokenModel):
            panel = panel.withColumn(out, F.lit(None).cast("double")).withColumn(
                err, F.lit(model.error)
            )
    fitted = {i: model for i, model in enumerate(models) if isinstance(model, SeriesModel)}
    return _attach_series(panel, fitted, phase, label) if fitted else panel


def _attach_series(
    panel: DataFrame, models: dict[int, SeriesModel], phase: Phase, label: str
) -> DataFrame:
    columns = [name for name in panel.columns if name not in ("destination_id", "rn")]
    series = (
        panel.withColumns({"_fitted": phase.fitted, "_until": phase.until})
        .groupBy("destination_id")
        .agg(
            F.array_sort(F.collect_list(F.struct("rn", *columns))).alias("_rows"),
            F.max("_fitted").cast("int").alias("_fitted"),
            F.max("_until").cast("int").alias("_until"),
        )
    )
    inputs = (F.col("_rows.date"), F.col("_rows.demand"), F.col("_fitted"), F.col("_until"))
    series = series.withColumns(
        {f"_made_{i}": _fit(model)(*inputs) for i, model in models.items()}
    )
    made = {
        f"fc_{label}_{i}": F.get(F.col(f"_made_{i}.values"), F.col("rn") - F.col("_fitted") - 1)
        for i in models
    } | {f"err_{label}_{i}": F.col(f"_made_{i}.error") for i in models}
    kept = [f"_made_{i}" for i in models]
    return (
        series.select("destination_id", "_fitted", *kept, F.inline("_rows"))
        .withColumns(
            {
                name: F.when(F.col("rn") > F.col("_fitted"), value) if name[:3] == "fc_" else value
                for name, value in made.items()
            }
        )
        .drop("_fitted", *kept)
    )


def _fit(model: SeriesModel) -> Callable[..., Column]:
    def one(dates: np.ndarray, values: np.ndarray, cut: int, stop: int) -> np.ndarray | str:
        frame = pd.DataFrame({"date": dates, "demand": values})
        window = frame.iloc[cut:stop].reset_index(drop=True)
        try:
            made = np.asarray(list(model.forecast(frame.iloc[:cut], window)), dtype=float)
        except Exception as problem:
            return str(problem) or type(problem).__name__
        if len(made) != len(window):
            return f"{len(made)} forecasts for {len(window)} rows"
        return made

    @F.pandas_udf("values array<double>, error string")
    def run(
        dates: pd.Series, demand: pd.Series, fitted: pd.Series, until: pd.Series
    ) -> pd.DataFrame:
        # Series that cannot be split have no fitted rows at all.
        cuts = [max(int(cut), 0) for cut in fitted]
        stops = [max(int(stop), cut) for stop, cut in zip(until, cuts)]
        values = [np.asarray(value, dtype=float) for value in demand]
        if model.batch:
            made = model.batch(
                [value[:cut] for value, cut in zip(values, cuts)],
                [stop - cut for stop, cut in zip(stops, cuts)],
            )
        else:
            made = [one(*series) for series in zip(dates, values, cuts, stops)]
        return pd.DataFrame(
            [
                (None, result)
                if isinstance(result, str)
                else ([None if np.isnan(v) else float(v) for v in result], None)
                for result in made
            ],
            columns=["values", "error"],
        )

    return run
