"""Column helpers."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NAN = float("nan")


def zero(column: Column) -> Column:
    return F.coalesce(column, F.lit(0.0))


def ratio_or(numerator: Column, denominator: Column, fallback: float) -> Column:
    """``numerator / denominator`` where the denominator is positive, else ``fallback``."""
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(fallback))


def usable(metric: Column) -> Column:
    """True for a metric that can be compared: neither null nor NaN."""
    return metric.isNotNull() & ~F.isnan(metric)


def unit_noise(seed: int, *keys: Column) -> Column:
    """A number in [0, 1) fixed by the keys alone, whatever the partitioning."""
    return F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(1 << 30)).cast("double") / float(1 << 30)


def normal_noise(seed: int, *keys: Column) -> Column:
    """A standard normal draw (Box-Muller) fixed by the keys alone."""
    radius = F.sqrt(-2.0 * F.log(1.0 - unit_noise(seed, *keys)))
    return radius * F.cos(unit_noise(seed + 1, *keys) * 6.283185307179586)


def one_row(*totals: DataFrame) -> DataFrame:
    """Put the columns of several one-row frames side by side in one row."""
    stacked = reduce(partial(DataFrame.unionByName, allowMissingColumns=True), totals)
    return stacked.agg(*[F.max(name).alias(name) for name in stacked.columns])
