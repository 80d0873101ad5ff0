"""Saving scenario results and reading them back.

Each kind of result is one folder partitioned by scenario, so a whole grid is read at once
and a rerun replaces its own scenario only.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowplan.operators import evaluation
from flowplan.plans.scenarios import ScenarioResult, summary

PARQUET = ("forecasts", "flows", "inventory")
JSON = ("planning_metrics", "planning_models", "realized_metrics")


def save(result: ScenarioResult, root: str) -> None:
    """Signal, flows and stock as parquet; planning and realized metrics as JSON lines."""
    tables = {
        "forecasts": result.signal,
        "flows": result.flows,
        "inventory": result.inventory,
        "planning_metrics": nested_planning(result.planning),
        "planning_models": result.planned_models,
        "realized_metrics": result.kpis,
    }
    for name, table in tables.items():
        writer = table.write.mode("overwrite")
        path = f"{root}/{name}/scenario={result.config.name}"
        writer.json(path) if name in JSON else writer.parquet(path)


def nested_planning(planning: DataFrame) -> DataFrame:
    """The planning row with its figures grouped into structs."""
    return planning.select(
        "forecast_strategy",
        "plan_strategy",
        "n_successful_destinations",
        "n_failed_destinations",
        F.struct("mean_wape", "mean_mae").alias("aggregated_forecast"),
        F.struct("total_cost", "transportation_cost", "holding_cost").alias("costs"),
        F.struct("unmet_demand_pct", "infeasibility_rate").alias("service_level"),
    )


PLANNING_SCHEMA = (
    "forecast_strategy string, plan_strategy string, n_successful_destinations long, "
    "n_failed_destinations long, aggregated_forecast struct<mean_wape: double, mean_mae: double>, "
    "costs struct<total_cost: double, transportation_cost: double, holding_cost: double>, "
    "service_level struct<unmet_demand_pct: double, infeasibility_rate: double>, scenario string"
)
KPI_SCHEMA = ", ".join(
    ["destination_id string", *[f"{name} double" for name in evaluation.KPIS], "scenario string"]
)
MODELS_SCHEMA = (
    "destination_id string, selected_model string, wape double, mae double, rmse double, "
    "scenario string"
)


def load(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A saved table of all scenarios with its ``scenario`` column; empty if none was saved."""
    schema = {
        "planning_metrics": PLANNING_SCHEMA,
        "planning_models": MODELS_SCHEMA,
        "realized_metrics": KPI_SCHEMA,
    }.get(name)
    try:
        if schema:
            return spark.read.schema(schema).json(f"{root}/{name}")
        return spark.read.parquet(f"{root}/{name}")
    except AnalysisException as problem:
        if schema and "PATH_NOT_FOUND" in (problem.getCondition() or ""):
            return spark.createDataFrame([], schema)
        raise


def load_summary(spark: SparkSession, root: str, names: list[str]) -> DataFrame:
    """The summary of saved scenarios; a wanted one that was not saved shows as MISSING."""
    planning = load(spark, root, "planning_metrics").select(
        "scenario", "forecast_strategy", "plan_strategy", "aggregated_forecast.mean_wape",
        "costs.total_cost",
    )
    return summary(spark, names, planning, load(spark, root, "realized_metrics"))


def reevaluate(root: str, scenario: str, tables: dict[str, DataFrame]) -> DataFrame:
    """Realized KPIs of a saved plan against the given tables."""
    spark = tables["demand_history"].sparkSession
    flows = load(spark, root, "flows").filter(F.col("scenario") == scenario).drop("scenario")
    return evaluation.realized(
        flows, tables["demand_history"], tables["lanes"], tables["destinations"]
    )
