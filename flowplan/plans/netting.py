"""The planner's input: a dense demand panel with free stock already used up."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowplan.operators import panel
from flowplan.operators.evaluation import plan_cost
from flowplan.operators.inventory import planned_inventory, replay, with_initial

FLOW_THRESHOLD = 1e-6


@dataclass(frozen=True)
class Demand:
    """``cells`` is the dense signal (destination_id, t, date, demand)."""

    cells: DataFrame
    initial: DataFrame | None = None

    def required(self) -> DataFrame:
        """What must be shipped per cell once stock on hand is used for the earliest demand.

        Whatever the plan, ``required`` is left to ship and ``spare`` is carried, so netting
        changes the cost by a constant only.
        """
        return replay(with_initial(self.cells, self.initial)).select(
            "destination_id",
            "t",
            "date",
            F.col("shortage").alias("required"),
            F.col("inventory").alias("spare"),
        )

    def within(self, ids: DataFrame) -> Demand:
        """The same demand, of the destinations in ``ids`` only."""
        cells = self.cells.join(ids.select("destination_id"), "destination_id", "left_semi")
        return Demand(cells, self.initial)


@dataclass(frozen=True)
class Plan:
    """A shipment plan: ``flows`` (origin_id, destination_id, period, flow).

    No plan can cost less than ``lower_bound``; without it the plan is optimal. ``unmet``
    (destination_id, t, short) is demand that no plan could place, ``tiers`` says how the network was
    planned. ``prices`` (origin_id, t, price) and ``values`` (destination_id, t, need, value) prove the bound.
    """

    demand: Demand
    flows: DataFrame
    lanes: DataFrame
    destinations: DataFrame
    lower_bound: float | None = None
    unmet: DataFrame | None = None
    tiers: dict[str, int] | None = None
    prices: DataFrame | None = None
    values: DataFrame | None = None

    def inventory(self) -> DataFrame:
        """Stock of every destination after every period, zeros kept."""
        return planned_inventory(self.demand.cells, self.flows, self.demand.initial)

    def cost(self) -> DataFrame:
        return plan_cost(self.flows, self.inventory(), self.lanes, self.destinations)


def demand_of(
    signal: DataFrame, periods: DataFrame | None = None, initial: DataFrame | None = None
) -> Demand:
    """Dense demand over the horizon: the signal's own dates, or ``periods`` (column ``date``)."""
    wanted = panel.demand_in_horizon(signal, periods)
    dates = panel.horizon_array(signal if periods is None else periods)
    ids = wanted.select("destination_id").distinct()
    return Demand(panel.dense(ids, dates, wanted), initial)
