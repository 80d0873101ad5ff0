"""Joins that stay even when one key holds a large part of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 16


def salted_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: list[str],
    spread_by: list[str],
    how: str = "inner",
    salts: int = SALTS,
) -> DataFrame:
    """Join many ``facts`` to few ``lookup`` rows per key, splitting each key over ``salts`` groups.

    ``spread_by`` are fact columns that differ within a key. Nothing is hinted: a small
    lookup side is still broadcast by Spark after its own size check, and a large one is
    shuffled with no key heavier than ``1 / salts`` of its rows.
    """
    salted = facts.withColumn("_salt", F.pmod(F.hash(*spread_by), F.lit(salts)))
    copies = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")


def salts_for(facts: DataFrame, keys: list[str], rows_per_group: int = 1_000_000) -> int:
    """How many groups the heaviest key must be split into to stay under ``rows_per_group``."""
    heaviest = (
        facts.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n")).first()["n"]
    )
    return max(1, -(-(heaviest or 0) // rows_per_group))


def pair_groups(left_rows: int, right_rows: int, rows_per_task: int) -> tuple[int, int]:
    """Into how many groups each side falls so that no two groups make more than ``rows_per_task`` pairs."""
    tasks = max(1, -(-left_rows * right_rows // rows_per_task))
    by_left = min(max(1, left_rows), max(1, round((tasks * left_rows / max(1, right_rows)) ** 0.5)))
    return by_left, min(max(1, right_rows), max(1, -(-tasks // by_left)))


def every_pair(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, rows_per_task: int = 1_000_000
) -> DataFrame:
    """Each left row with each right row, for results that are a product by definition.

    Both sides fall into groups, as many as their measured rows ask for; every pair of groups is
    one key, so a task holds one group of either side and never a whole side.
    """
    by_left, by_right = pair_groups(left.count(), right.count(), rows_per_task)
    if by_left * by_right == 1:
        return left.withColumn("_pair", F.lit(0)).join(right.withColumn("_pair", F.lit(0)), "_pair").drop("_pair")
    rows = left.withColumn("_i", F.pmod(F.hash(left_key), F.lit(by_left))).withColumn(
        "_j", F.explode(F.sequence(F.lit(0), F.lit(by_right - 1)))
    )
    columns = right.withColumn("_j", F.pmod(F.hash(right_key), F.lit(by_right))).withColumn(
        "_i", F.explode(F.sequence(F.lit(0), F.lit(by_left - 1)))
    )
    return rows.join(columns, ["_i", "_j"]).drop("_i", "_j")
