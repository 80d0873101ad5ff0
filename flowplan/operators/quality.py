"""Data-quality rules. Each yields violation rows (rank, rule, key, detail); ``enforce`` raises.

``rank`` orders the rules: structure first, feasibility last. The first violated rule is the
one reported.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowplan.functions.columns import zero

MAX_VARIABLES = 1_000_000
REQUIRED = {
    "demand_history": {"date", "destination_id", "demand"},
    "destinations": {"destination_id"},
    "lanes": {"origin_id", "destination_id", "unit_cost"},
    "origins": {"origin_id", "daily_capacity"},
}


class QualityError(ValueError):
    """Raised by ``enforce`` with the violated rule and its keys."""


def _rows(df: DataFrame, rank: int, rule: str, key: Column, detail: Column) -> DataFrame:
    return df.select(
        F.lit(rank).alias("rank"),
        F.lit(rule).alias("rule"),
        key.cast("string").alias("key"),
        detail.cast("double").alias("detail"),
    )


def require_columns(df: DataFrame, required: Iterable[str], name: str) -> None:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise QualityError(f"{name} lacks columns {missing}; needed: {sorted(required)}")


def empty_table(df: DataFrame, name: str, rank: int = 1) -> DataFrame:
    """One row if ``df`` has none. Only the first row found anywhere is counted."""
    counted = df.limit(1).agg(F.count(F.lit(1)).alias("n"))
    return _rows(counted.filter("n = 0"), rank, "empty_table", F.lit(name), F.lit(0))


def null_values(df: DataFrame, name: str, rank: int = 2) -> DataFrame:
    """One row per column that holds nulls, with their number."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    pairs = F.inline(
        F.array(*[F.struct(F.lit(f"{name}.{c}").alias("column"), F.col(c).alias("n")) for c in df.columns])
    )
    return _rows(counts.select(pairs).filter("n > 0"), rank, "null_values", F.col("column"), F.col("n"))


def negative_unit_cost(lanes: DataFrame, rank: int = 3) -> DataFrame:
    key = F.concat_ws("->", "origin_id", "destination_id")
    return _rows(lanes.filter("unit_cost < 0"), rank, "negative_unit_cost", key, F.col("unit_cost"))


def negative_holding_cost(destinations: DataFrame, rank: int = 4) -> DataFrame:
    value = F.col("holding_cost") if "holding_cost" in destinations.columns else F.lit(None)
    return _rows(
        destinations.filter(value < 0), rank, "negative_holding_cost", F.col("destination_id"), value
    )


def capacity_not_positive(origins: DataFrame, rank: int = 5) -> DataFrame:
    return _rows(
        origins.filter("daily_capacity <= 0"),
        rank,
        "capacity_not_positive",
        F.col("origin_id"),
        F.col("daily_capacity"),
    )


def unknown_origin(lanes: DataFrame, origins: DataFrame, rank: int = 6) -> DataFrame:
    named = lanes.select("origin_id").distinct().join(origins.select("origin_id"), "origin_id", "left_anti")
    return _rows(named, rank, "unknown_origin", F.col("origin_id"), F.lit(None))


def negative_initial_inventory(initial: DataFrame, rank: int = 7) -> DataFrame:
    return _rows(
        initial.filter("qty < 0"), rank, "negative_initial_inventory", F.col("destination_id"), F.col("qty")
    )


def plan_size(demand: DataFrame, lanes: DataFrame, periods: DataFrame) -> DataFrame:
    """One row: number of flow and inventory variables of a plan over ``periods`` (column date)."""
    dates = periods.agg(F.count_distinct("date").alias("n"))
    routes = lanes.agg(F.count(F.lit(1)).alias("n"))
    return (
        demand.agg(F.count_distinct("destination_id").alias("destinations"))
        .select(
            routes.scalar().alias("lanes"), "destinations", dates.scalar().alias("periods")
        )
        .withColumn("flow_variables", F.col("lanes") * F.col("periods"))
        .withColumn("inventory_variables", F.col("destinations") * F.col("periods"))
        .withColumn("variables", F.col("flow_variables") + F.col("inventory_variables"))
    )


def too_many_variables(
    demand: DataFrame, lanes: DataFrame, periods: DataFrame, limit: int = MAX_VARIABLES, rank: int = 8
) -> DataFrame:
    size = plan_size(demand, lanes, periods)
    return _rows(
        size.filter(F.col("variables") > limit),
        rank,
        "too_many_variables",
        F.lit(str(limit)),
        F.col("variables"),
    )


def unreachable(demand: DataFrame, lanes: DataFrame, rank: int = 9) -> DataFrame:
    """Destinations with demand that no lane serves."""
    lost = (
        demand.select("destination_id")
        .distinct()
        .join(lanes.select("destination_id").distinct(), "destination_id", "left_anti")
    )
    return _rows(lost, rank, "unreachable", F.col("destination_id"), F.lit(None))


def capacity_balance(demand: DataFrame, origins: DataFrame, periods: DataFrame) -> DataFrame:
    """One row: total demand, total capacity over the periods, and the shortfall."""
    dates = periods.agg(F.count_distinct("date").alias("n"))
    supply = origins.agg(zero(F.sum("daily_capacity")).alias("n"))
    return (
        demand.agg(zero(F.sum("demand")).alias("total_demand"))
        .withColumn("total_capacity", supply.scalar() * dates.scalar())
        .withColumn(
            "shortfall",
            F.greatest(F.lit(0.0), F.col("total_demand") - F.col("total_capacity")),
        )
    )


def capacity_short(
    demand: DataFrame, origins: DataFrame, periods: DataFrame, rank: int = 10
) -> DataFrame:
    balance = capacity_balance(demand, origins, periods)
    return _rows(
        balance.filter("shortfall > 0"), rank, "capacity_short", F.lit("network"), F.col("shortfall")
    )


def conflicting_keys(df: DataFrame, keys: list[str], value: str, name: str, rank: int = 11) -> DataFrame:
    """Keys that carry more than one value; ``detail`` is the number of different values."""
    found = df.groupBy(*keys).agg(
        (F.count_distinct(value) + F.max(F.col(value).isNull().cast("int"))).alias("n")
    )
    key = F.concat_ws("|", F.lit(name), *[F.col(k).cast("string") for k in keys])
    return _rows(found.filter("n > 1"), rank, "conflicting_keys", key, F.col("n"))


def resolved_keys(df: DataFrame, keys: list[str], sequence: list[str], keep: str = "last") -> DataFrame:
    """One row per key: the one that stands last (or first) in the order of the ``sequence`` columns.

    Rows that tie in the sequence are ordered by their other values, so the choice does not depend on
    how the rows arrive. Nulls in the sequence stand first. Copies merge before the shuffle.
    """
    if keep not in ("first", "last"):
        raise ValueError("keep must be first or last")
    values = [c for c in df.columns if c not in keys]
    rest = [c for c in values if c not in sequence]
    rank = F.struct(*sequence, *rest)
    chosen = (F.max if keep == "last" else F.min)(rank).alias("_row")
    return df.groupBy(*keys).agg(chosen).select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def contract_violations(result: DataFrame, schema: T.StructType, metrics: Iterable[str]) -> DataFrame:
    """Rows (rule, key, detail) where a table of scored windows breaks its contract.

    ``missing_column`` and ``wrong_type`` compare with ``schema``; ``unknown_metric`` names a metric outside
    ``metrics`` and ``reversed_period`` a window that does not start before it ends. Value rules read the
    columns that are there; a null start or end is a reversed period too.
    """
    spark, have = result.sparkSession, {f.name: f.dataType for f in result.schema}
    faults = []
    for field in schema:
        if field.name not in have:
            faults.append(("missing_column", field.name, field.dataType.simpleString()))
        elif have[field.name] != field.dataType:
            faults.append(("wrong_type", field.name, have[field.name].simpleString()))
    parts = [spark.createDataFrame(faults, "rule string, key string, detail string")]

    def rows(rule: str, where: Column, detail: Column) -> DataFrame:
        return result.filter(where).select(
            F.lit(rule).alias("rule"), F.col("destination_id").cast("string").alias("key"), detail.cast("string").alias("detail")
        )

    if {"destination_id", "metric"} <= have.keys():
        known = F.coalesce(F.col("metric").isin(list(metrics)), F.lit(False))
        parts.append(rows("unknown_metric", ~known, F.col("metric")))
    if {"destination_id", "start_date", "end_date"} <= have.keys():
        forward = F.coalesce(F.col("start_date") < F.col("end_date"), F.lit(False))
        parts.append(rows("reversed_period", ~forward, F.concat_ws("..", F.col("start_date").cast("string"), F.col("end_date").cast("string"))))
    return union(parts)


def network_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Structure of the four input tables: present columns, rows, nulls in demand."""
    for name, required in REQUIRED.items():
        require_columns(tables[name], required, name)
    found = [empty_table(tables[name], name) for name in REQUIRED]
    return union([*found, null_values(tables["demand_history"], "demand_history")])


def plan_report(
    signal: DataFrame,
    origins: DataFrame,
    lanes: DataFrame,
    destinations: DataFrame,
    periods: DataFrame,
    initial: DataFrame | None = None,
    limit: int | None = MAX_VARIABLES,
) -> DataFrame:
    """Every violated planning rule. ``limit=None`` leaves the size rule out."""
    require_columns(signal, REQUIRED["demand_history"], "demand signal")
    parts = [
        empty_table(signal, "demand"),
        empty_table(origins, "origins"),
        empty_table(lanes, "lanes"),
        empty_table(periods, "horizon"),
        negative_unit_cost(lanes),
        negative_holding_cost(destinations),
        capacity_not_positive(origins),
        unknown_origin(lanes, origins),
    ]
    if initial is not None:
        parts.append(negative_initial_inventory(initial))
    if limit is not None:
        parts.append(too_many_variables(signal, lanes, periods, limit))
    parts += [
        unreachable(signal, lanes),
        capacity_short(signal, origins, periods),
        conflicting_keys(lanes, ["origin_id", "destination_id"], "unit_cost", "lanes"),
        conflicting_keys(origins, ["origin_id"], "daily_capacity", "origins"),
    ]
    return union(parts)


def union(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def first_violation(report: DataFrame) -> DataFrame:
    """The rule that is reported, with the number of its violations; no row if all is well."""
    return (
        report.groupBy("rank", "rule")
        .agg(F.count(F.lit(1)).alias("violations"))
        .orderBy("rank")
        .limit(1)
    )


def enforce(report: DataFrame, shown: int = 20) -> None:
    """Raise on the lowest-ranked violated rule, naming up to ``shown`` of its keys."""
    rows = report.orderBy("rank", "key").limit(shown).collect()
    if rows:
        keys = [row["key"] for row in rows if row["rule"] == rows[0]["rule"]]
        raise QualityError(f"{rows[0]['rule']}: {keys}")
