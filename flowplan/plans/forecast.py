"""Forecast every series with several models, score them, keep the best one.

The demand table is shuffled once to merge repeated rows and once by destination. Windows,
fits, scores, selection and export all run on that second partitioning.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowplan.config import METRICS, ForecastConfig
from flowplan.functions.columns import usable, zero
from flowplan.functions.metrics import error_metrics
from flowplan.operators import panel
from flowplan.operators.arima import arima
from flowplan.operators.models import (
    Phase,
    Registry,
    SeriesModel,
    attach_all,
    naive,
    rolling,
    seasonal,
)
from flowplan.operators.selection import ALL_NULL
from flowplan.operators.smoothing import ets


def default_registry() -> Registry:
    registry = Registry()
    registry.register("naive_forecaster", naive)
    registry.register("seasonal_forecaster", seasonal)
    registry.register("rolling_window_forecaster", rolling)
    registry.register("ets_forecaster", ets)
    registry.register("sarimax_forecaster", arima)
    return registry


@dataclass(frozen=True)
class ForecastRun:
    """All tables of one run derive from ``outcomes``; persist that to read several of them."""

    config: ForecastConfig
    outcomes: DataFrame

    @property
    def successful(self) -> DataFrame:
        return self.outcomes.filter("success")

    @property
    def failed(self) -> DataFrame:
        return self.outcomes.filter("NOT success")

    @property
    def models(self) -> DataFrame:
        """One row per (destination, model) with selection-window metrics and ``error``."""
        return self.outcomes.select(
            "destination_id", F.inline("models")
        ).drop("forecasts")

    @property
    def selected(self) -> DataFrame:
        return self.successful.select(
            "destination_id",
            F.col("best.model").alias("model"),
            F.col("best.registry_key").alias("registry_key"),
            F.col("best.mode").alias("mode"),
            *[F.col(f"best.{m}").alias(m) for m in METRICS],
            *[F.col(f"final.{m}").alias(f"final_{m}") for m in METRICS],
            F.col("final.forecast_window").alias("forecast_window"),
        )

    @property
    def forecasts(self) -> DataFrame:
        """Every model's forecasts in its reported window."""
        return self.outcomes.select(
            "destination_id",
            F.explode("models").alias("m"),
        ).select(
            "destination_id",
            F.col("m.ord").alias("ord"),
            F.col("m.model").alias("model"),
            F.inline("m.forecasts"),
        )

    def signal(self, on_null: str = "keep") -> DataFrame:
        """The winners' forecasts as a demand signal.

        ``on_null`` keeps null forecasts, drops their rows, or turns them into zero demand.
        """
        rows = self.successful.select("destination_id", F.inline("final.forecasts"))
        value = F.col("forecast")
        if on_null == "drop":
            rows = rows.filter(value.isNotNull())
        elif on_null == "zero":
            value = zero(value)
        elif on_null != "keep":
            raise ValueError("on_null must be keep, drop or zero")
        return panel.to_signal(rows, value)

    def require_success(self) -> ForecastRun:
        """Raise when not one destination could be forecast."""
        if self.successful.isEmpty():
            raise ValueError("no destination could be forecast")
        return self

    def nested(self) -> DataFrame:
        """One row per destination: winner, its metrics and values, and all models' metrics."""
        metrics = F.struct(*[F.col(f"best.{m}").alias(m) for m in METRICS])
        return self.outcomes.select(
            "destination_id",
            "success",
            "error",
            F.col("best.model").alias("best_model"),
            F.when(F.col("success"), metrics).alias("metrics"),
            F.col("final.forecasts").alias("forecast_values"),
            F.transform(
                F.filter("models", lambda m: m["error"].isNull()),
                lambda m: F.struct(
                    m["model"].alias("model"), *[m[name].alias(name) for name in METRICS]
                ),
            ).alias("all_models"),
        )


def run_forecast(
    demand: DataFrame,
    config: ForecastConfig,
    registry: Registry | None = None,
    on_conflict: str = "flag",
) -> ForecastRun:
    """Forecast, score and select. Series shorter than the minimum history are left out.

    Rows that disagree about a date become the error of their destination alone; with
    ``on_conflict="sum"`` they are added up, with "fail" they end the job.
    """
    models = (registry or default_registry()).create_all(config.model_names, config.model_params)
    series = panel.unique_series(demand, on_conflict)
    if "conflict" not in series.columns:
        series = series.withColumn("conflict", F.lit(False))
    if any(isinstance(model, SeriesModel) for model in models):
        # A fit costs far more than its bytes suggest, so the task count is fixed: the
        # adaptive planner would merge these small partitions into a few slow tasks.
        tasks = int(demand.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        series = series.repartition(tasks, "destination_id")
    first_window = "validation" if config.three_way else "test"
    last_window = "holdout" if config.three_way else None

    def span_ok(window: str) -> Column:
        inside = F.when(F.col("split") == window, F.col("date"))
        whole = panel.whole_series()
        return F.coalesce(F.min(inside).over(whole) < F.max(inside).over(whole), F.lit(False))

    def prepare(split: DataFrame) -> DataFrame:
        return split.filter(F.col("n") >= config.minimum_history_length).withColumns(
            {
                "too_short": F.col("split").isNull(),
                "conflict": F.max("conflict").over(panel.whole_series()),
                "spans": span_ok("train") & span_ok(first_window),
                "last_span": span_ok(last_window) if last_window else F.lit(False),
            }
        )

    if config.three_way:
        vp, hp = config.validation_periods, config.test_periods
        frame = prepare(panel.split_three_way(series, vp, hp))
        first = Phase(F.col("n") - (vp + hp), F.col("n") - hp)
        frame = attach_all(frame, models, first, "first")
        frame = attach_all(frame, models, Phase(F.col("n") - hp, F.col("n")), "last")
        windows = {"validation": "first", "holdout": "last"}
    else:
        frame = prepare(panel.split_two_way(series, config.train_ratio))
        cut = F.floor(F.col("n") * F.lit(float(config.train_ratio)))
        frame = attach_all(frame, models, Phase(cut, F.col("n")), "first")
        windows = {"test": "first"}

    per_model = []
    for i, (key, model) in enumerate(zip(config.model_names, models)):
        forecast = F.lit(None).cast("double")
        error = F.lit(None).cast("string")
        for window, label in windows.items():
            here = F.col("split") == window
            forecast = F.when(here, F.col(f"fc_{label}_{i}")).otherwise(forecast)
            error = F.when(here, F.col(f"err_{label}_{i}")).otherwise(error)
        per_model.append(
            F.struct(
                F.lit(i).alias("ord"),
                F.lit(model.name).alias("model"),
                F.lit(key).alias("registry_key"),
                F.lit(model.mode).alias("mode"),
                forecast.alias("forecast"),
                error.alias("problem"),
            )
        )

    # A series that cannot be split keeps one marker row so that it is reported as failed.
    kept = (
        F.col("split").isin(*windows) | (F.col("rn") == 1)
    )
    rows = (
        frame.filter(kept)
        .withColumn("m", F.explode(F.array(*per_model)))
        .withColumns(
            {
                "actual": F.col("demand"),
                "in_window": F.coalesce(F.col("split").isin(*windows), F.lit(False)),
            }
        )
        .select(
            "destination_id", "date", "split", "actual", "in_window",
            "too_short", "conflict", "spans", "last_span", "m.*",
        )
    )
    scored = _score_windows(rows, first_window, last_window)
    return ForecastRun(config, _outcomes(scored, config.selection_metric, last_window))


def _score_windows(rows: DataFrame, first: str, last: str | None) -> DataFrame:
    """Metrics and forecasts per (destination, model), for the selection and the holdout window."""

    def measured(window: str):
        here = F.col("split") == window
        actual, forecast = F.when(here, F.col("actual")), F.when(here, F.col("forecast"))
        point = F.struct("date", "actual", "forecast", F.col("split").alias("forecast_window"))
        return F.struct(
            *[column.alias(name) for name, column in error_metrics(actual, forecast).items()],
            F.count(forecast).alias("present"),
            F.max(F.when(here, F.col("problem"))).alias("problem"),
            F.array_sort(F.collect_list(F.when(here, point))).alias("forecasts"),
        )

    wanted = [measured(first).alias("first")]
    if last:
        wanted.append(measured(last).alias("last"))
    return rows.groupBy("destination_id", "ord", "model", "registry_key", "mode").agg(
        F.max("too_short").alias("too_short"),
        F.max("conflict").alias("conflict"),
        F.max("spans").alias("spans"),
        F.max("last_span").alias("last_span"),
        *wanted,
    )


def _outcomes(scored: DataFrame, metric: str, last: str | None) -> DataFrame:
    def failure(window: str):
        return F.when(
            F.col(f"{window}.problem").isNotNull(), F.col(f"{window}.problem")
        ).when(F.col(f"{window}.present") == 0, F.lit(ALL_NULL))

    usable_last = F.lit(False)
    if last:
        usable_last = F.col("last_span") & failure("last").isNull()
    chosen = {name: F.col(f"first.{name}") for name in (*METRICS, "forecasts")}
    window = F.lit("validation" if last else "test")
    final = F.struct(
        *[value.alias(name) for name, value in chosen.items()], window.alias("forecast_window")
    )
    if last:
        final = F.when(
            usable_last,
            F.struct(
                *[F.col(f"last.{name}").alias(name) for name in chosen],
                F.lit("holdout").alias("forecast_window"),
            ),
        ).otherwise(final)
    entry = scored.select(
        "destination_id", "too_short", "conflict", "spans", "ord", "model", "registry_key", "mode",
        failure("first").alias("error"), *[value.alias(name) for name, value in chosen.items()],
        final.alias("final"),
    )
    fine = F.col("error").isNull() & F.col("spans") & ~F.col("too_short") & ~F.col("conflict")
    candidate = fine & usable(F.col(metric))
    described = ("ord", "model", "registry_key", "mode", *METRICS)
    grouped = entry.groupBy("destination_id").agg(
        F.max("too_short").alias("too_short"),
        F.max("conflict").alias("conflict"),
        F.max("spans").alias("spans"),
        F.count(F.when(fine, 1)).alias("working"),
        F.min_by(
            F.when(candidate, F.struct(*described)),
            F.when(candidate, F.struct(metric, "ord")),
        ).alias("best"),
        F.min_by(
            F.when(candidate, F.col("final")),
            F.when(candidate, F.struct(metric, "ord")),
        ).alias("final"),
        F.array_sort(F.collect_list(F.struct(*described, "error", "forecasts"))).alias("models"),
    )
    # The winner's row reports its final window, the other models the selection window.
    models = F.transform(
        "models",
        lambda m: F.when(
            m["ord"] == F.col("best.ord"), m.withField("forecasts", F.col("final.forecasts"))
        ).otherwise(m),
    )
    error = (
        F.when(F.col("conflict"), F.lit("conflicting demand rows"))
        .when(F.col("too_short"), F.lit("series too short for a three-way split"))
        .when(~F.col("spans"), F.lit("train and selection windows need two dates each"))
        .when(F.col("working") == 0, F.lit("all models failed"))
        .when(F.col("best").isNull(), F.lit(f"no usable {metric} in any model"))
    )
    return grouped.select(
        "destination_id",
        error.isNull().alias("success"),
        error.alias("error"),
        F.when(error.isNull(), F.col("best")).alias("best"),
        F.when(error.isNull(), F.col("final")).alias("final"),
        models.alias("models"),
    )
