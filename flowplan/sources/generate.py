"""Synthetic demand over given ids and dates. Noise hangs on the keys, not on the partitioning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowplan.functions.columns import normal_noise, unit_noise
from flowplan.operators.skew import every_pair

# Weekend factor, growth per day, promotion factor and odds, noise deviation.
WEEKEND, GROWTH, PROMOTION, PROMOTION_ODDS, DEVIATION = 0.85, 0.0015, 1.25, 0.08, 4.0

# Level, change per day, noise deviation, and factors Monday to Sunday.
PATTERNS = (
    (80.0, 0.0, 4.0, (1.20, 1.15, 1.00, 0.90, 0.85, 0.70, 0.75)),
    (60.0, 0.0, 3.0, (1.00, 1.00, 1.00, 1.00, 1.00, 1.00, 1.00)),
    (50.0, 0.1, 7.0, (1.05, 1.02, 1.00, 0.98, 0.97, 0.99, 1.00)),
    (90.0, 0.08, 8.0, (1.25, 1.20, 1.05, 0.95, 0.85, 0.70, 0.80)),
    (70.0, 0.0, 20.0, (1.00, 1.00, 1.00, 1.00, 1.00, 1.00, 1.00)),
    (100.0, -0.05, 5.0, (1.10, 1.05, 1.00, 0.95, 0.90, 0.95, 1.00)),
)


def calendar(start: str, end: str):
    """All days from ``start`` to ``end`` as one array column."""
    return F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))


def demand_panel(bases: DataFrame, days, seed: int = 42, noisy: bool = True) -> DataFrame:
    """Daily demand of (destination_id, base): weekend dip, growth, promotions, noise, never below 0."""
    panel = bases.select("destination_id", "base", F.posexplode(days).alias("day", "date"))
    level = (
        F.col("base")
        * F.when(F.weekday("date") >= 5, WEEKEND).otherwise(1.0)
        * (1.0 + GROWTH * F.col("day"))
    )
    if noisy:
        keys = (F.col("destination_id"), F.col("date"))
        promoted = unit_noise(seed, *keys) < PROMOTION_ODDS
        level = level * F.when(promoted, PROMOTION).otherwise(1.0)
        level = level + DEVIATION * normal_noise(seed + 1, *keys)
    return panel.select(
        "date", "destination_id", F.round(F.greatest(level, F.lit(0.0)), 2).alias("demand")
    )


def pattern_panel(ids: DataFrame, days, seed: int = 42, noisy: bool = True) -> DataFrame:
    """Daily demand of (destination_id, pattern): one of six shapes by pattern number."""
    table = F.array(
        *[
            F.struct(
                F.lit(level).alias("level"),
                F.lit(change).alias("change"),
                F.lit(noise).alias("noise"),
                F.array(*[F.lit(factor) for factor in week]).alias("week"),
            )
            for level, change, noise, week in PATTERNS
        ]
    )
    panel = ids.select(
        "destination_id", F.get(table, F.col("pattern")).alias("p"),
        F.posexplode(days).alias("day", "date"),
    )
    level = (F.col("p.level") + F.col("p.change") * F.col("day")) * F.get(
        F.col("p.week"), F.weekday("date")
    )
    if noisy:
        level = level + F.col("p.noise") * normal_noise(seed, F.col("destination_id"), F.col("date"))
    return panel.select(
        "date", "destination_id", F.round(F.greatest(level, F.lit(0.0)), 1).alias("demand")
    )


def complete_lanes(origins: DataFrame, destinations: DataFrame, seed: int = 42) -> DataFrame:
    """A lane from every origin to every destination, whole costs from 5 to 24."""
    cost = F.floor(5 + 20 * unit_noise(seed, F.col("origin_id"), F.col("destination_id")))
    return every_pair(
        destinations.select("destination_id"), origins.select("origin_id"), "destination_id", "origin_id"
    ).select("origin_id", "destination_id", cost.cast("double").alias("unit_cost"))


def capacities(origins: DataFrame, seed: int = 42) -> DataFrame:
    """Whole daily capacities from 80 to 179."""
    drawn = F.floor(80 + 100 * unit_noise(seed, F.col("origin_id")))
    return origins.select("origin_id", drawn.cast("double").alias("daily_capacity"))


def holding(destinations: DataFrame, low: float = 0.5, high: float = 2.0, seed: int = 42) -> DataFrame:
    drawn = F.round(low + (high - low) * unit_noise(seed, F.col("destination_id")), 2)
    return destinations.select("destination_id", drawn.alias("holding_cost"))


def base_demand(destinations: DataFrame, seed: int = 42) -> DataFrame:
    """Whole base demands from 20 to 69."""
    drawn = F.floor(20 + 50 * unit_noise(seed, F.col("destination_id")))
    return destinations.select("destination_id", drawn.cast("double").alias("base"))


def write_network(tables: dict[str, DataFrame], folder: str) -> None:
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
