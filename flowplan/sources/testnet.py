"""The star-schema test tables seen as a logistics network."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowplan.operators import panel
from flowplan.session import cut_lineage


class TestNetwork:
    """Views over one scale-factor folder; every view reads whole tables."""

    __test__ = False

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self._folder = spark, folder
        self._kept: DataFrame | None = None

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self._folder}/{name}.parquet")

    def demand_cells(self) -> DataFrame:
        """Ordered quantity per nation and month, only cells that have orders."""
        if self._kept is not None:
            return self._kept
        orders = self.table("orders")
        return (
            self.table("lineitem")
            .select("l_orderkey", "l_quantity")
            .join(
                orders.join(self.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
                .join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
                .select(
                    "o_orderkey",
                    F.trunc(F.col("o_orderdate").cast("date"), "month").alias("date"),
                    F.col("n_name").alias("destination_id"),
                ),
                F.col("l_orderkey") == F.col("o_orderkey"),
            )
            .groupBy("date", "destination_id")
            .agg(F.sum("l_quantity").alias("demand"))
        )

    def keep_demand(self) -> None:
        """Sum the orders once for all views of this network; a row per nation and month is kept."""
        self._kept = cut_lineage(self.demand_cells())

    def demand_month(self) -> DataFrame:
        """``demand_cells`` made dense over all its months."""
        cells = self.demand_cells()
        ids = cells.select("destination_id").distinct()
        return panel.dense(ids, panel.horizon_array(cells), cells).select(
            "date", "destination_id", "demand"
        )

    def demand_event_day(self) -> DataFrame:
        return (
            self.table("events")
            .groupBy(F.col("ts").cast("date").alias("date"), F.col("event_type").alias("destination_id"))
            .agg(F.count(F.lit(1)).cast("double").alias("demand"))
        )

    def demand_supplier_week(self) -> DataFrame:
        return (
            self.table("lineitem")
            .groupBy(
                F.trunc(F.col("l_shipdate").cast("date"), "week").alias("date"),
                F.col("l_suppkey").cast("string").alias("destination_id"),
            )
            .agg(F.sum("l_quantity").alias("demand"))
        )

    def destinations(self) -> DataFrame:
        return self.table("nation").select(
            F.col("n_name").alias("destination_id"),
            (0.25 * (1 + F.col("n_nationkey") % 4)).alias("holding_cost"),
        )

    def lanes(self) -> DataFrame:
        """Every supplier to every nation; a product, which Spark does not take for the size of the suppliers."""
        nations = self.table("nation").select("n_nationkey", "n_name")
        cost = (
            1.0
            + F.abs(F.col("s_nationkey") - F.col("n_nationkey"))
            + 0.25 * (F.col("s_suppkey") % 5)
        )
        return (
            self.table("supplier")
            .select("s_suppkey", "s_nationkey")
            .crossJoin(nations)
            .select(
                F.col("s_suppkey").cast("string").alias("origin_id"),
                F.col("n_name").alias("destination_id"),
                cost.alias("unit_cost"),
            )
        )

    def regional_lanes(self) -> DataFrame:
        """Lanes inside one region only, so that the network falls into separate parts."""
        nation = self.table("nation")
        home = nation.select(
            F.col("n_nationkey").alias("s_nationkey"), F.col("n_regionkey").alias("home")
        )
        away = nation.select(
            F.col("n_name").alias("destination_id"), F.col("n_regionkey").alias("home")
        )
        region_of = (
            self.table("supplier")
            .join(home, "s_nationkey")
            .select(F.col("s_suppkey").cast("string").alias("origin_id"), "home")
        )
        return (
            self.lanes()
            .join(region_of, "origin_id")
            .join(away, ["destination_id", "home"])
            .select("origin_id", "destination_id", "unit_cost")
        )

    def _peak(self) -> DataFrame:
        month = self.demand_cells().groupBy("date").agg(F.sum("demand").alias("total"))
        return month.agg(F.max("total").alias("peak"))

    def origins_slack(self) -> DataFrame:
        """Any one origin can carry the busiest month."""
        return self.table("supplier").select(
            F.col("s_suppkey").cast("string").alias("origin_id"),
            F.ceil(1.25 * self._peak().scalar()).cast("double").alias("daily_capacity"),
        )

    def origins_tight(self) -> DataFrame:
        """Every month fits in total, but the cheapest lanes overload their origins."""
        suppliers = self.table("supplier")
        count = suppliers.agg(F.count(F.lit(1)).alias("n"))
        return suppliers.select(
            F.col("s_suppkey").cast("string").alias("origin_id"),
            (
                F.ceil(1.25 * self._peak().scalar() / count.scalar())
                * (1 + F.col("s_suppkey") % 3)
            ).cast("double").alias("daily_capacity"),
        )

    def origins_regional(self) -> DataFrame:
        """Capacity tight inside each region that has suppliers: 1.25 of its busiest month, shared."""
        nation = self.table("nation").select("n_nationkey", "n_name", "n_regionkey")
        peak = (
            self.demand_cells()
            .join(nation, F.col("destination_id") == F.col("n_name"))
            .groupBy("n_regionkey", "date")
            .agg(F.sum("demand").alias("total"))
            .groupBy("n_regionkey")
            .agg(F.max("total").alias("peak"))
        )
        homes = self.table("supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        share = homes.groupBy("n_regionkey").agg(F.count(F.lit(1)).alias("members"))
        return (
            homes.select("s_suppkey", "n_regionkey")
            .join(peak, "n_regionkey")
            .join(share, "n_regionkey")
            .select(
                F.col("s_suppkey").cast("string").alias("origin_id"),
                (F.ceil(1.25 * F.col("peak") / F.col("members")) * (1 + F.col("s_suppkey") % 3))
                .cast("double")
                .alias("daily_capacity"),
            )
        )
