"""Forecast error metrics as aggregate columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowplan.functions.columns import NAN

# Fixed value: the smallest denominator of a percentage error (float64 machine epsilon).
PERCENTAGE_FLOOR = 2.220446049250313e-16


def error_metrics(actual: Column, forecast: Column) -> dict[str, Column]:
    """mae, mse, rmse, mape and wape over rows where both sides are present; NaN if there are none.

    wape is NaN when the actuals sum to zero in absolute value.
    """
    gap = F.abs(actual - forecast)
    size = F.when(gap.isNotNull(), F.abs(actual))

    def or_nan(value: Column) -> Column:
        return F.coalesce(value, F.lit(NAN))

    mse = F.avg(gap * gap)
    weight = F.sum(size)
    return {
        "mae": or_nan(F.avg(gap)),
        "mse": or_nan(mse),
        "rmse": or_nan(F.sqrt(mse)),
        "mape": or_nan(F.avg(gap / F.greatest(size, F.lit(PERCENTAGE_FLOOR)))),
        "wape": or_nan(F.when(weight > 0, F.sum(gap) / weight)),
    }
