"""Reading the four network tables, from parquet or JSON records."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowplan import schemas
from flowplan.functions.columns import zero
from flowplan.operators.quality import REQUIRED, require_columns


def typed(table: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast the known columns that are present and keep the others as they are."""
    kinds = {field.name: field.dataType for field in schema}
    return table.select(
        *[F.col(c).cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in table.columns]
    )


def read_network(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """``demand_history``, ``destinations``, ``lanes`` and ``origins`` from parquet files in ``folder``."""
    tables = {}
    for name, schema in schemas.NETWORK.items():
        try:
            table = spark.read.parquet(f"{folder}/{name}.parquet")
        except AnalysisException as problem:
            if "PATH_NOT_FOUND" in (problem.getCondition() or ""):
                raise FileNotFoundError(f"{folder}/{name}.parquet does not exist") from None
            raise
        require_columns(table, REQUIRED[name], name)
        tables[name] = typed(table, schema)
    return tables


def read_records(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One network table from JSON lines; a record that does not fit its schema fails the read."""
    return spark.read.schema(schemas.NETWORK[name]).option("mode", "FAILFAST").json(path)


def normalize_holding(destinations: DataFrame) -> DataFrame:
    """Add ``has_holding_cost``: false if no row has a cost. If any has, the others cost 0."""
    value = F.col("holding_cost") if "holding_cost" in destinations.columns else F.lit(None)
    table = destinations.withColumn("holding_cost", value.cast("double"))
    known = table.agg(F.coalesce(F.bool_or(F.col("holding_cost").isNotNull()), F.lit(False)).alias("k"))
    return table.withColumn("has_holding_cost", known.scalar()).withColumn(
        "holding_cost", F.when(F.col("has_holding_cost"), zero(F.col("holding_cost")))
    )
