"""Dense time series and change from one period to the next."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions import percent
from ..functions.dates import Day, as_date

Bound = Day | Column


def _bound(value: Bound) -> Column:
    return value if isinstance(value, Column) else F.lit(as_date(value))


def members(spark: SparkSession, column: str, values: Sequence[str]) -> DataFrame:
    """One row per listed value."""
    return spark.range(1).select(F.explode(F.array(*map(F.lit, values))).alias(column))


def calendar(keys: DataFrame, period: str, start: Bound, end: Bound, unit: str = "month") -> DataFrame:
    """Every key with every day or month from ``start`` to ``end``, without a join."""
    step = {"day": F.expr("INTERVAL 1 DAY"), "month": F.expr("INTERVAL 1 MONTH")}[unit]
    return keys.withColumn(period, F.explode(F.sequence(_bound(start), _bound(end), step)))


def dense(sparse: DataFrame, grid: DataFrame, on: Sequence[str]) -> DataFrame:
    """The grid with the sparse values attached; an absent period stays, with NULL."""
    return grid.join(sparse, list(on), "left")


def period_change(
    series: DataFrame, keys: Sequence[str], period: str, value: str, change: str, digits: int = 2
) -> DataFrame:
    """Percentage change from the previous row of a dense series.

    Only meaningful on a dense series: there an absent period is a NULL value, and the period after
    it has no change. The window holds one row per period and key.
    """
    before = F.lag(value).over(Window.partitionBy(*keys).orderBy(period))
    lagged = series.withColumn("_before", before)
    moved = percent(F.col(value) - F.col("_before"), F.col("_before"), digits)
    return lagged.withColumn(change, moved).drop("_before")
