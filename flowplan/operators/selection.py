"""Scoring models and choosing one per destination."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowplan.config import METRICS
from flowplan.functions.columns import usable
from flowplan.functions.metrics import error_metrics

ALL_NULL = "every forecast is null"


def score(forecasts: DataFrame, *keys: str) -> DataFrame:
    """Metrics per key over rows (actual, forecast), with ``error`` set where no forecast exists."""
    measured = error_metrics(F.col("actual"), F.col("forecast"))
    return forecasts.groupBy(*keys).agg(
        *[column.alias(name) for name, column in measured.items()],
        F.when(F.count("forecast") == 0, F.lit(ALL_NULL)).alias("error"),
    )


def select_best(scores: DataFrame, metric: str = "wape", key: str = "destination_id") -> DataFrame:
    """The model with the least ``metric`` per key; the lowest ``ord`` wins a tie.

    Every key is returned. One without a usable metric has a null model and an ``error``.
    """
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {sorted(METRICS)}")
    if metric not in scores.columns:
        raise ValueError(f"metric {metric!r} is not in the scores; found {scores.columns}")
    candidate = usable(F.col(metric))
    kept = [name for name in scores.columns if name not in (key, "error")]
    best = F.min_by(
        F.when(candidate, F.struct(*kept)), F.when(candidate, F.struct(metric, "ord"))
    )
    return (
        scores.groupBy(key)
        .agg(best.alias("_best"))
        .select(
            key,
            "_best.*",
            F.when(
                F.col("_best").isNull(),
                F.concat(F.lit(f"no usable {metric} for destination "), F.col(key)),
            ).alias("error"),
        )
    )
