"""What a plan costs, on paper and against real demand."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowplan.functions.columns import one_row, ratio_or, zero
from flowplan.operators import panel
from flowplan.operators.inventory import replay

SUMS = (
    "transport_cost",
    "realized_holding_cost",
    "total_actual_demand",
    "total_fulfilled",
    "total_shortage",
)
KPIS = (
    "transport_cost",
    "realized_holding_cost",
    "realized_total_cost",
    "total_actual_demand",
    "total_fulfilled",
    "total_shortage",
    "fill_rate",
    "cost_per_unit_demanded",
    "cost_per_unit_fulfilled",
)


def transport_cost(flows: DataFrame, lanes: DataFrame) -> DataFrame:
    """Shipping cost per destination; a pair without a lane costs nothing.

    Periods are summed per pair before the lanes are joined.
    """
    pairs = flows.groupBy("origin_id", "destination_id").agg(F.sum("flow").alias("flow"))
    costs = lanes.select("origin_id", "destination_id", "unit_cost")
    return (
        pairs.join(costs, ["origin_id", "destination_id"], "left")
        .groupBy("destination_id")
        .agg(F.sum(F.col("flow") * zero(F.col("unit_cost"))).alias("transport_cost"))
    )


def holding_costs(destinations: DataFrame) -> DataFrame:
    value = F.col("holding_cost") if "holding_cost" in destinations.columns else F.lit(None)
    return destinations.select("destination_id", zero(value.cast("double")).alias("holding_cost"))


def plan_cost(
    flows: DataFrame, inventory: DataFrame, lanes: DataFrame, destinations: DataFrame
) -> DataFrame:
    """One row: planned transport, holding and total cost."""
    transport = transport_cost(flows, lanes).agg(
        zero(F.sum("transport_cost")).alias("transportation_cost")
    )
    holding = (
        inventory.groupBy("destination_id")
        .agg(F.sum("inventory").alias("held"))
        .join(holding_costs(destinations), "destination_id", "left")
        .agg(zero(F.sum(F.col("held") * zero(F.col("holding_cost")))).alias("holding_cost"))
    )
    return one_row(transport, holding).withColumn(
        "total_cost", F.col("transportation_cost") + F.col("holding_cost")
    )


def arrivals(flows: DataFrame) -> DataFrame:
    return flows.groupBy("destination_id", F.col("period").alias("date")).agg(
        F.sum("flow").alias("inflow")
    )


def inventory_replay(
    inflow: DataFrame, demand: DataFrame, destinations: DataFrame, horizon: DataFrame
) -> DataFrame:
    """Every destination on every horizon date with inflow, stock, shortage and fulfilled demand."""
    ids = destinations.select("destination_id").distinct()
    cells = (
        panel.dense(ids, panel.horizon_array(horizon), demand)
        .join(inflow, ["destination_id", "date"], "left")
        .withColumn("inflow", zero(F.col("inflow")))
    )
    return replay(cells)


def _kpis() -> list[Column]:
    total = F.col("transport_cost") + F.col("realized_holding_cost")
    demand, fulfilled = F.col("total_actual_demand"), F.col("total_fulfilled")
    derived = {
        "realized_total_cost": total,
        "fill_rate": ratio_or(fulfilled, demand, 1.0),
        "cost_per_unit_demanded": ratio_or(total, demand, 0.0),
        "cost_per_unit_fulfilled": ratio_or(total, fulfilled, 0.0),
    }
    return [derived.get(name, F.col(name)).alias(name) for name in KPIS]


def realized(
    flows: DataFrame,
    demand: DataFrame,
    lanes: DataFrame,
    destinations: DataFrame,
    horizon: DataFrame | None = None,
) -> DataFrame:
    """Realized KPIs of a plan, per destination and in total.

    The replay covers the dates that have a flow; pass ``horizon`` (column ``date``) to
    replay other dates as well.
    """
    dates = flows.select(F.col("period").alias("date")) if horizon is None else horizon
    return realized_from(
        arrivals(flows), transport_cost(flows, lanes), dates, demand, destinations
    )


def realized_from(
    inflow: DataFrame,
    transport: DataFrame,
    horizon: DataFrame,
    demand: DataFrame,
    destinations: DataFrame,
) -> DataFrame:
    """Realized KPIs per destination plus one grand-total row with a null destination.

    The total counts transport to destinations that the destinations table lacks.
    """
    served = (
        inventory_replay(inflow, demand, destinations, horizon)
        .groupBy("destination_id")
        .agg(
            F.sum("inventory").alias("held"),
            F.sum("demand").alias("total_actual_demand"),
            F.sum("fulfilled").alias("total_fulfilled"),
            F.sum("shortage").alias("total_shortage"),
        )
        .join(holding_costs(destinations), "destination_id", "left")
        .withColumn("realized_holding_cost", F.col("held") * zero(F.col("holding_cost")))
        .withColumn("listed", F.lit(True))
    )
    rows = served.join(transport, "destination_id", "full").select(
        "destination_id", "listed", *[zero(F.col(name)).alias(name) for name in SUMS]
    )
    levels = rows.groupingSets(
        [[F.col("destination_id"), F.col("listed")], []], F.col("destination_id"), F.col("listed")
    ).agg(
        F.grouping_id().alias("level"), *[zero(F.sum(name)).alias(name) for name in SUMS]
    )
    return levels.filter((F.col("level") > 0) | F.col("listed")).select("destination_id", *_kpis())


def by_destination(kpis: DataFrame) -> DataFrame:
    return kpis.filter(F.col("destination_id").isNotNull())


def grand_total(kpis: DataFrame) -> DataFrame:
    return kpis.filter(F.col("destination_id").isNull()).drop("destination_id")
