"""Proportional allocation: every origin ships its whole capacity, split by forecast share.

A shipment is capacity times share, so every total follows from the two factors. Costs,
stock and KPIs are computed from the factors; only ``flows`` writes the full plan out.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowplan.functions.columns import one_row, ratio_or, zero
from flowplan.operators import panel
from flowplan.operators.evaluation import realized_from
from flowplan.operators.inventory import replay
from flowplan.operators.skew import every_pair, salted_join, salts_for
from flowplan.session import cut_lineage

TOLERANCE = 1e-6


@dataclass(frozen=True)
class Allocation:
    """``shares`` is (destination_id, t, date, share), ``origins`` (origin_id, daily_capacity)."""

    shares: DataFrame
    origins: DataFrame

    def flows(self) -> DataFrame:
        """All shipments, lane or not: by definition one row per origin and share."""
        return every_pair(self.shares, self.origins, "destination_id", "origin_id").select(
            "origin_id",
            "destination_id",
            F.col("date").alias("period"),
            (F.col("daily_capacity") * F.col("share")).alias("flow"),
        )

    def inflow(self) -> DataFrame:
        capacity = self.origins.agg(zero(F.sum("daily_capacity")).alias("capacity"))
        return self.shares.select(
            "destination_id", "t", "date", (F.col("share") * capacity.scalar()).alias("inflow")
        )

    def replayed(self, demand: DataFrame) -> DataFrame:
        """Stock and shortage of the forecast destinations against actual ``demand``."""
        actual = demand.select("destination_id", "date", "demand")
        return replay(
            self.inflow()
            .join(actual, ["destination_id", "date"], "left")
            .withColumn("demand", zero(F.col("demand")))
        )

    def transport_cost(self, lanes: DataFrame) -> DataFrame:
        """Shipping cost per destination over existing lanes."""
        shipped = self.shares.groupBy("destination_id").agg(F.sum("share").alias("share"))
        rate = (
            salted_join(
                lanes, self.origins, ["origin_id"], ["destination_id"], salts=salts_for(lanes, ["origin_id"])
            )
            .groupBy("destination_id")
            .agg(F.sum(F.col("unit_cost") * F.col("daily_capacity")).alias("rate"))
        )
        return shipped.join(rate, "destination_id", "left").select(
            "destination_id", (F.col("share") * zero(F.col("rate"))).alias("transport_cost")
        )

    def infeasibility_rate(self) -> DataFrame:
        """Share of (origin, period) cells that ship more than the capacity."""
        # A period overloads the origins above a capacity that only rounding can reach.
        limits = (
            self.shares.groupBy("date")
            .agg((F.sum("share") - 1.0).alias("over"))
            .agg(
                F.collect_list(F.when(F.col("over") > 0, TOLERANCE / F.col("over"))).alias("limits"),
                F.count(F.lit(1)).alias("periods"),
            )
            .select(F.struct("limits", "periods"))
        )
        checked = self.origins.select("daily_capacity", limits.scalar().alias("p"))
        above = F.size(F.filter("p.limits", lambda limit: F.col("daily_capacity") > limit))
        return checked.agg(
            zero(ratio_or(F.sum(above), F.sum("p.periods"), 0.0)).alias("infeasibility_rate")
        )

    def realized(self, demand: DataFrame, lanes: DataFrame, destinations: DataFrame) -> DataFrame:
        """Realized KPIs, from the factors."""
        return realized_from(
            self.inflow().select("destination_id", "date", "inflow"),
            self.transport_cost(lanes),
            self.shares.select("date"),
            demand,
            destinations,
        )

    def kpis(self, demand: DataFrame, lanes: DataFrame) -> DataFrame:
        """One row: cost and service of the rule. It plans no holding cost."""
        served = self.replayed(demand).agg(
            F.sum("shortage").alias("shortage"), F.sum("demand").alias("demand")
        )
        cost = self.transport_cost(lanes).agg(
            zero(F.sum("transport_cost")).alias("transportation_cost")
        )
        unmet = ratio_or(F.col("shortage"), F.col("demand"), 0.0) * 100.0
        return one_row(served, cost, self.infeasibility_rate()).select(
            "transportation_cost",
            F.lit(0.0).alias("holding_cost"),
            F.col("transportation_cost").alias("total_cost"),
            unmet.alias("unmet_demand_pct"),
            "infeasibility_rate",
        )


def allocate(signal: DataFrame, origins: DataFrame) -> Allocation:
    """Share each period by the clamped forecast, equally where the whole period is zero.

    The shares are materialised: stock, cost and KPIs each read them.
    """
    values = signal.select(
        "destination_id", "date", F.greatest(zero(F.col("demand")), F.lit(0.0)).alias("demand")
    )
    ids = signal.select("destination_id").distinct()
    cells = panel.dense(ids, panel.horizon_array(signal), values)
    # Totals are aggregated and looked up by period number: a period may hold every
    # destination there is, so the cells are neither windowed nor shuffled by period.
    totals = (
        cells.groupBy("t")
        .agg(F.sum("demand").alias("total"), F.count(F.lit(1)).alias("members"))
        .agg(F.array_sort(F.collect_list(F.struct("t", "total", "members"))).alias("totals"))
    )
    looked_up = cells.withColumn("_of", F.get(totals.scalar(), F.col("t")))
    share = F.when(F.col("_of.total") > 0, F.col("demand") / F.col("_of.total")).otherwise(
        1.0 / F.col("_of.members")
    )
    shares = looked_up.select("destination_id", "t", "date", share.alias("share"))
    return Allocation(cut_lineage(shares), origins.select("origin_id", "daily_capacity"))
