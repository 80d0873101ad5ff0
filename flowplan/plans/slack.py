"""Plan where every destination ships its need in the same period over its cheapest lane.

That is the least each cell can cost, so the plan is optimal if no origin is overloaded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowplan.plans.netting import FLOW_THRESHOLD, Demand, Plan

CAPACITY_TOLERANCE = 1e-6


def cheapest_lanes(lanes: DataFrame) -> DataFrame:
    """One lane per destination: least cost, then least origin id."""
    rank = F.struct("unit_cost", "origin_id")
    return lanes.groupBy("destination_id").agg(F.min_by("origin_id", rank).alias("origin_id"))


def slack_flows(required: DataFrame, lanes: DataFrame) -> DataFrame:
    return (
        required.filter(F.col("required") > FLOW_THRESHOLD)
        .join(cheapest_lanes(lanes), "destination_id")
        .select(
            "origin_id",
            "destination_id",
            F.col("date").alias("period"),
            F.col("required").alias("flow"),
        )
    )


def slack_plan(demand: Demand, lanes: DataFrame, destinations: DataFrame) -> Plan:
    return Plan(demand, slack_flows(demand.required(), lanes), lanes, destinations)


def overload(flows: DataFrame, origins: DataFrame) -> DataFrame:
    """Origin-periods that ship more than they can, with the excess."""
    return (
        flows.groupBy("origin_id", "period")
        .agg(F.sum("flow").alias("shipped"))
        .join(origins.select("origin_id", "daily_capacity"), "origin_id")
        .filter(F.col("shipped") > F.col("daily_capacity") + CAPACITY_TOLERANCE)
        .withColumn("excess", F.col("shipped") - F.col("daily_capacity"))
    )
