"""Stock over time, in closed form over one ordered window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowplan.functions.columns import zero
from flowplan.operators.panel import in_series, so_far


def replay(panel: DataFrame, order: str = "t") -> DataFrame:
    """Serve ``demand`` from ``inflow`` and carried stock; what is short is lost, not owed.

    With S the running sum of inflow minus demand, the demand lost so far is
    ``max(0, -min S)``, so stock and shortage need two running aggregates and no recursion.
    Adds ``inventory``, ``shortage`` and ``fulfilled``.
    """
    window, running = in_series(order=order), so_far(order=order)
    return (
        panel.withColumn("_net", F.sum(F.col("inflow") - F.col("demand")).over(running))
        .withColumn("_lost", F.greatest(F.lit(0.0), -F.min("_net").over(running)))
        .withColumn("inventory", F.col("_net") + F.col("_lost"))
        .withColumn("shortage", F.col("_lost") - F.lag("_lost", 1, 0.0).over(window))
        .withColumn("fulfilled", F.col("demand") - F.col("shortage"))
        .drop("_net", "_lost")
    )


def with_initial(panel: DataFrame, initial: DataFrame | None) -> DataFrame:
    """Set ``inflow`` to the initial stock in the first period and to 0 afterwards."""
    if initial is None:
        return panel.withColumn("inflow", F.lit(0.0))
    stock = initial.groupBy("destination_id").agg(F.sum("qty").alias("qty"))
    return (
        panel.join(stock, "destination_id", "left")
        .withColumn("inflow", F.when(F.col("t") == 0, zero(F.col("qty"))).otherwise(F.lit(0.0)))
        .drop("qty")
    )


def planned_inventory(cells: DataFrame, flows: DataFrame, initial: DataFrame | None = None) -> DataFrame:
    """Stock after each period of a plan: initial + shipped so far - demanded so far."""
    shipped = flows.groupBy("destination_id", F.col("period").alias("date")).agg(
        F.sum("flow").alias("shipped")
    )
    balance = F.col("inflow") + zero(F.col("shipped")) - F.col("demand")
    return (
        with_initial(cells, initial)
        .join(shipped, ["destination_id", "date"], "left")
        .select(
            "destination_id",
            F.col("date").alias("period"),
            F.sum(balance).over(so_far(order="t")).alias("inventory"),
        )
    )
