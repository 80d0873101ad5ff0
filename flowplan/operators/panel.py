"""Panel shaping: cleaning, horizons, dense panels, demand signals.

Every series leaves this module with at most one row per calendar date. A window or an
array over one ``destination_id`` is therefore bounded by the calendar span, not by the
number of input rows, however many copies of a row the input holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from flowplan.functions.columns import zero

SERIES = ("destination_id", "date")


def clean(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Drop repeated rows from every table; the copies merge before they are shuffled."""
    return {name: table.dropDuplicates() for name, table in tables.items()}


def unique_series(demand: DataFrame, on_conflict: str = "fail") -> DataFrame:
    """One row per (destination, date). Equal copies merge; differing ones fail, are flagged or are summed.

    With "flag" a cell that disagrees has no demand and a true ``conflict``.
    """
    if on_conflict == "sum":
        return demand.groupBy(*SERIES).agg(F.sum("demand").alias("demand"))
    value = F.col("demand")
    merged = demand.groupBy(*SERIES).agg(
        F.min(value).alias("low"),
        F.max(value).alias("high"),
        F.count(value).alias("present"),
        F.count(F.lit(1)).alias("rows"),
    )
    conflict = (F.col("low") != F.col("high")) | (
        (F.col("present") > 0) & (F.col("present") < F.col("rows"))
    )
    if on_conflict == "flag":
        known = F.coalesce(conflict, F.lit(False))
        return merged.select(*SERIES, F.when(~known, F.col("low")).alias("demand"), known.alias("conflict"))
    message = F.concat(
        F.lit("conflicting demand rows for "), F.col("destination_id"), F.lit(" on "), F.col("date")
    )
    return merged.select(
        *SERIES, F.when(conflict, F.raise_error(message)).otherwise(F.col("low")).alias("demand")
    )


def horizon_array(dated: DataFrame, column: str = "date") -> DataFrame:
    """One row holding the sorted distinct dates; distinct dates are bounded by the calendar."""
    return dated.agg(F.array_sort(F.collect_set(F.col(column).cast("date"))).alias("dates"))


def horizon(dated: DataFrame, column: str = "date") -> DataFrame:
    """The planning horizon as (t, date), t counting from 0."""
    return horizon_array(dated, column).select(F.posexplode("dates").alias("t", "date"))


def last_dates(dated: DataFrame, periods: int, column: str = "date") -> DataFrame:
    """The last ``periods`` distinct dates of the whole table, not of each series."""
    return dated.select(F.col(column).cast("date").alias("date")).distinct().orderBy(F.desc("date")).limit(periods)


def small_calendar(dates: DataFrame, *columns: str) -> DataFrame:
    """Distinct calendar rows with ``date`` as a DATE, so at most the days of the calendar.

    Nothing is hinted: the adaptive planner broadcasts them by their measured size.
    """
    rest = [F.col(name) for name in columns if name != "date"]
    return dates.select(F.col("date").cast("date").alias("date"), *rest).distinct()


def on_dates(dated: DataFrame, dates: DataFrame) -> DataFrame:
    """Rows whose date is one of ``dates``."""
    return dated.withColumn("date", F.col("date").cast("date")).join(small_calendar(dates, "date"), "date", "left_semi")


def dense(ids: DataFrame, dates: DataFrame, demand: DataFrame) -> DataFrame:
    """Every id on every horizon date as (destination_id, t, date, demand), absent demand 0.

    Each id unrolls the horizon array, so the panel grows as ids times dates and no join
    builds pairs of rows.
    """
    grid = ids.select(
        "destination_id", F.posexplode(dates.select("dates").scalar()).alias("t", "date")
    )
    return grid.join(demand.select(*SERIES, "demand"), list(SERIES), "left").select(
        "destination_id", "t", "date", zero(F.col("demand")).alias("demand")
    )


def demand_in_horizon(signal: DataFrame, dates: DataFrame | None = None) -> DataFrame:
    """Demand the planner sees: horizon dates only, null as 0, repeated cells summed."""
    kept = signal if dates is None else on_dates(signal, dates)
    return kept.groupBy(*SERIES).agg(F.sum(zero(F.col("demand"))).alias("demand"))


def in_series(*, order: str = "date") -> WindowSpec:
    return Window.partitionBy("destination_id").orderBy(order)


def so_far(*, order: str = "date") -> WindowSpec:
    return in_series(order=order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def whole_series() -> WindowSpec:
    return Window.partitionBy("destination_id")


def long_enough(demand: DataFrame, minimum: int) -> DataFrame:
    """Rows of destinations that have at least ``minimum`` rows."""
    sized = demand.withColumn("n", F.count(F.lit(1)).over(whole_series()))
    return sized.filter(F.col("n") >= minimum)


def split_two_way(demand: DataFrame, ratio: float) -> DataFrame:
    """Label the first ``floor(n * ratio)`` rows of each series train and the rest test."""
    return _numbered(demand).withColumn(
        "split",
        F.when(F.col("rn") <= F.floor(F.col("n") * F.lit(float(ratio))), "train").otherwise("test"),
    )


def split_three_way(demand: DataFrame, validation: int, holdout: int) -> DataFrame:
    """Label the last ``holdout`` rows, the ``validation`` rows before them, and the rest train.

    Series that leave no training row get ``split`` null.
    """
    from_end = F.col("n") - F.col("rn")
    return _numbered(demand).withColumn(
        "split",
        F.when(F.col("n") < holdout + validation + 1, F.lit(None))
        .when(from_end < holdout, "holdout")
        .when(from_end < holdout + validation, "validation")
        .otherwise("train"),
    )


def _numbered(demand: DataFrame) -> DataFrame:
    return demand.withColumn("rn", F.row_number().over(in_series())).withColumn(
        "n", F.count(F.lit(1)).over(whole_series())
    )


def split_periods(split: DataFrame) -> DataFrame:
    """First and last date of each split; ``valid`` is false when they coincide."""
    return (
        split.groupBy("destination_id", "split")
        .agg(
            F.min("date").alias("start_date"),
            F.max("date").alias("end_date"),
            F.count(F.lit(1)).alias("rows"),
        )
        .withColumn("valid", F.col("start_date") < F.col("end_date"))
    )


def centered_mean(demand: DataFrame, reach: int = 3) -> DataFrame:
    """Mean over ``reach`` rows on both sides, null where the frame is cut by an edge."""
    frame = in_series().rowsBetween(-reach, reach)
    full = F.count("demand").over(frame) == 2 * reach + 1
    return demand.withColumn("centered_mean", F.when(full, F.avg("demand").over(frame)))


def series_stats(demand: DataFrame) -> DataFrame:
    value = F.col("demand")
    return demand.groupBy("destination_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.round(F.avg(value), 2).alias("mean"),
        F.round(F.stddev_samp(value), 2).alias("std"),
        F.round(F.min(value), 2).alias("min"),
        F.round(F.max(value), 2).alias("max"),
    )


def to_signal(forecasts: DataFrame, forecast: Column | None = None) -> DataFrame:
    """Forecast rows in demand-signal shape."""
    value = F.col("forecast") if forecast is None else forecast
    return forecasts.select("destination_id", "date", value.cast("double").alias("demand"))


def on_horizon(table: DataFrame, dates: DataFrame) -> DataFrame:
    """Each row of ``table`` once per horizon date, as (t, period)."""
    return table.select(
        *table.columns, F.posexplode(dates.select("dates").scalar()).alias("t", "period")
    )
