"""Cleaned tables, with their rows and nulls counted while they are written."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from flowplan.operators.quality import REQUIRED, QualityError, require_columns

REPORT = "name string, rows long, kept long, nulls map<string,long>"


def write_clean(tables: dict[str, DataFrame], folder: str, not_null: dict[str, tuple[str, ...]] | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """The tables without repeated rows, written under ``folder``, and a report of what went in and came out.

    Rows and nulls are observed by the job that writes, so nothing is scanned for them alone. Missing
    columns and empty tables fail before anything is written; a null in a column that must not have one
    fails with the count over all rows that came in, repeated ones too.
    """
    not_null = {name: REQUIRED.get(name, ()) for name in tables} if not_null is None else not_null
    for name, table in tables.items():
        require_columns(table, REQUIRED.get(name, ()), name)
        if table.isEmpty():
            raise QualityError(f"{name}: has no rows")
    clean, report = {}, []
    for name, table in tables.items():
        came, kept = Observation(f"{name} in"), Observation(f"{name} kept")
        counts = [F.count_if(F.col(c).isNull()).alias(f"null {i}") for i, c in enumerate(table.columns)]
        merged = table.observe(came, F.count(F.lit(1)).alias("rows"), *counts).dropDuplicates()
        merged.observe(kept, F.count(F.lit(1)).alias("rows")).write.parquet(f"{folder}/{name}")
        nulls = {c: came.get[f"null {i}"] for i, c in enumerate(table.columns)}
        report.append((name, came.get["rows"], kept.get["rows"], nulls))
        faults = [f"{c} has {nulls[c]} nulls" for c in not_null.get(name, ()) if nulls.get(c)]
        if faults:
            raise QualityError(f"{name}: " + ", ".join(faults))
        clean[name] = table.sparkSession.read.schema(table.schema).parquet(f"{folder}/{name}")
    spark = next(iter(tables.values())).sparkSession
    return clean, spark.createDataFrame(report, REPORT)
