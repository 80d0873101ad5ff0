"""Scenarios: a forecast strategy and a plan strategy, planned, replayed and compared."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowplan.config import ScenarioConfig
from flowplan.functions.columns import one_row
from flowplan.operators import evaluation, panel
from flowplan.operators.allocation import allocate
from flowplan.operators.models import Registry, lag_one_panel
from flowplan.operators.quality import MAX_VARIABLES, union
from flowplan.plans.forecast import ForecastRun, run_forecast
from flowplan.plans.planner import optimize
from flowplan.session import cut_lineage

# Fixed order: forecast strategy, then plan strategy.
GRID = (
    ("naive", "naive"),
    ("naive", "optimized"),
    ("selected", "naive"),
    ("selected", "optimized"),
)


@dataclass(frozen=True)
class ScenarioResult:
    """``planning`` is one row, ``planned_models`` and ``kpis`` one row per destination."""

    config: ScenarioConfig
    signal: DataFrame
    flows: DataFrame
    inventory: DataFrame
    planning: DataFrame
    planned_models: DataFrame
    kpis: DataFrame


def forecast_signal(
    demand: DataFrame, config: ScenarioConfig, registry: Registry | None = None
) -> tuple[DataFrame, ForecastRun | None]:
    """The demand signal of a strategy, and the run behind it if models were selected."""
    if config.forecast_strategy == "naive":
        series = panel.unique_series(demand)
        return lag_one_panel(series, panel.last_dates(series, config.test_periods)), None
    run = run_forecast(demand, config.forecasting, registry)
    run = ForecastRun(run.config, cut_lineage(run.outcomes)).require_success()
    return run.signal("zero"), run


def run_scenario(
    tables: dict[str, DataFrame],
    config: ScenarioConfig,
    forecast: tuple[DataFrame, ForecastRun | None],
    max_variables: int = MAX_VARIABLES,
) -> ScenarioResult:
    """Plan for the signal and replay the plan against real demand. ``tables`` are cleaned."""
    demand, lanes = tables["demand_history"], tables["lanes"]
    origins, destinations = tables["origins"], tables["destinations"]
    signal, run = forecast
    if config.plan_strategy == "naive":
        plan = allocate(signal, origins)
        flows = plan.flows()
        inventory = plan.replayed(demand).select(
            "destination_id", F.col("date").alias("period"), "inventory"
        )
        planned = plan.kpis(demand, lanes)
        kpis = cut_lineage(plan.realized(demand, lanes, destinations))
    else:
        solved = optimize(signal, origins, lanes, destinations, max_variables=max_variables)
        flows, inventory = solved.flows, solved.inventory()
        kpis = cut_lineage(evaluation.realized(flows, demand, lanes, destinations))
        service = evaluation.grand_total(kpis).select(
            ((1.0 - F.col("fill_rate")) * 100.0).alias("unmet_demand_pct"),
            F.lit(0.0).alias("infeasibility_rate"),
        )
        planned = one_row(solved.cost(), service)
    return ScenarioResult(
        config, signal, flows, inventory, _planning(planned, config, run), _models(run, signal), kpis
    )


def _models(run: ForecastRun | None, signal: DataFrame) -> DataFrame:
    if run is None:
        return signal.select(
            "destination_id",
            F.lit(None).cast("string").alias("selected_model"),
            *[F.lit(None).cast("double").alias(name) for name in ("wape", "mae", "rmse")],
        ).limit(0)
    return run.successful.select(
        "destination_id",
        F.col("best.model").alias("selected_model"),
        *[F.col(f"final.{name}").alias(name) for name in ("wape", "mae", "rmse")],
    )


def _planning(planned: DataFrame, config: ScenarioConfig, run: ForecastRun | None) -> DataFrame:
    counts = {
        "n_successful_destinations": "long",
        "n_failed_destinations": "long",
        "mean_wape": "double",
        "mean_mae": "double",
    }
    if run is None:
        rows = planned.withColumns({name: F.lit(None).cast(kind) for name, kind in counts.items()})
    else:
        totals = run.outcomes.agg(
            F.count_if("success").alias("n_successful_destinations"),
            F.count_if(~F.col("success")).alias("n_failed_destinations"),
            F.avg("final.wape").alias("mean_wape"),
            F.avg("final.mae").alias("mean_mae"),
        )
        rows = one_row(planned, totals)
    return rows.select(
        F.lit(config.name).alias("scenario"),
        F.lit(config.forecast_strategy).alias("forecast_strategy"),
        F.lit(config.plan_strategy).alias("plan_strategy"),
        *counts,
        "total_cost", "transportation_cost", "holding_cost",
        "unmet_demand_pct", "infeasibility_rate",
    )


def run_grid(
    tables: dict[str, DataFrame],
    configs: Iterable[ScenarioConfig],
    registry: Registry | None = None,
    max_variables: int = MAX_VARIABLES,
) -> tuple[dict[str, ScenarioResult], dict[str, str]]:
    """Run every scenario; one that its data or settings forbid is reported by name and the others go on.

    The tables are materialised once; scenarios with the same forecast share its signal.
    """
    kept = {name: cut_lineage(tables[name]) for name in ("demand_history", "lanes", "origins")}
    tables = {**tables, **kept}
    signals: dict[tuple, tuple[DataFrame, ForecastRun | None]] = {}
    results, failures = {}, {}
    for config in configs:
        key = (config.forecast_strategy, config.test_periods, repr(config.forecasting))
        try:
            if key not in signals:
                signal, run = forecast_signal(tables["demand_history"], config, registry)
                signals[key] = (cut_lineage(signal), run)
            results[config.name] = run_scenario(tables, config, signals[key], max_variables)
        except (ValueError, KeyError) as problem:  # a fault of the cluster is none of the scenario
            failures[config.name] = str(problem)
    return results, failures


def scenario_kpis(results: dict[str, ScenarioResult]) -> DataFrame:
    """Realized KPIs of all scenarios, per destination and in total."""
    return union(
        result.kpis.withColumn("scenario", F.lit(name)) for name, result in results.items()
    )


def scenario_planning(results: dict[str, ScenarioResult]) -> DataFrame:
    return union(result.planning for result in results.values())


def summary(spark: SparkSession, names: list[str], planning: DataFrame, kpis: DataFrame) -> DataFrame:
    """One row per wanted scenario; one without results has status MISSING."""
    wanted = spark.createDataFrame([(name,) for name in names], "scenario string")
    planned = planning.select(
        "scenario", "forecast_strategy", "plan_strategy", "mean_wape",
        F.col("total_cost").alias("planned_cost"), F.lit("OK").alias("status"),
    )
    total = kpis.filter(F.col("destination_id").isNull()).select(
        "scenario",
        F.col("realized_total_cost").alias("realized_cost"),
        F.col("realized_holding_cost").alias("holding_cost"),
        ((1.0 - F.col("fill_rate")) * 100.0).alias("unmet_pct"),
    )
    return (
        wanted.join(planned, "scenario", "left")
        .join(total, "scenario", "left")
        .withColumn("status", F.coalesce("status", F.lit("MISSING")))
    )


def decomposition(kpis: DataFrame, names: tuple[str, str, str, str]) -> DataFrame:
    """Cost saved against the first scenario by plan, by forecast, by both, and their interaction.

    ``names`` are the scenarios in GRID order. A missing scenario makes its effects null.
    """
    cost = {
        i: F.max(F.when(F.col("scenario") == name, F.col("realized_total_cost")))
        for i, name in enumerate(names)
    }
    effects = kpis.filter(F.col("destination_id").isNull()).agg(
        (cost[0] - cost[1]).alias("optimization_impact"),
        (cost[0] - cost[2]).alias("forecasting_impact"),
        (cost[0] - cost[3]).alias("total_impact"),
    )
    return effects.withColumn(
        "interaction",
        F.col("total_impact") - F.col("optimization_impact") - F.col("forecasting_impact"),
    )


def breakdown(kpis: DataFrame) -> DataFrame:
    """Per scenario and destination: costs, demand, shortage, fill percentage, cost per unit."""
    return kpis.filter(F.col("destination_id").isNotNull()).select(
        "scenario", "destination_id", "transport_cost", "realized_holding_cost",
        "realized_total_cost", "total_actual_demand", "total_shortage",
        (F.col("fill_rate") * 100.0).alias("fill_pct"), "cost_per_unit_demanded",
    )
