"""Ratios over the matched population of two facts, and top-k reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import guarded_ratio

def stock_by_pair(readings: DataFrame, pair: Sequence[str], stock: str) -> DataFrame:
    """Per pair: average and sum of known stock, known readings, all readings. Zero is a known reading."""
    return readings.groupBy(*pair).agg(
        F.avg(stock).alias("avg_stock"),
        F.sum(stock).alias("sum_stock"),
        F.count(stock).alias("observed_days"),
        F.count(F.lit(1)).alias("expected_days"),
    )


def matched_rows(facts: DataFrame, population: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Facts whose key occurs in the population.

    The population is reduced to its keys first, so a key with many rows there is one row in the
    join. Group the facts before the call where only their totals per key are wanted.
    """
    return facts.join(population.select(*keys).distinct(), list(keys), "left_semi")


def matched_turnover(
    sales: DataFrame,
    readings: DataFrame,
    store: str = "store_id",
    product: str = "product_id",
    units: str = "quantity",
    stock: str = "stock_quantity",
) -> DataFrame:
    """Units sold per average unit in stock, per product, over pairs that have stock readings.

    Each fact is read once and grouped by (store, product) first: that combines a hot product
    before the shuffle, and both sides are then already partitioned on the join key. Sales of pairs
    without readings find no partner.

    Averages of pairs with equally many known readings are added as whole numbers, and the few such sums of a
    product in the order of those numbers: nothing is rounded to a scale, and the result does not depend
    on the order in which rows arrive.
    """
    pair = [store, product]
    sold = sales.groupBy(*pair).agg(F.sum(units).alias("units"))
    pairs = stock_by_pair(readings, pair, stock).join(sold, pair, "left")
    alike = pairs.groupBy(product, F.col("observed_days").alias("days")).agg(
        F.sum("units").alias("units"),
        F.sum("sum_stock").alias("sum_stock"),
        F.count(store).alias("stores"),
        F.sum("observed_days").alias("observed_days"),
        F.sum("expected_days").alias("expected_days"),
    )
    share = F.struct("days", (F.col("sum_stock").cast("double") / F.col("days")).alias("average"))
    shares = F.array_sort(F.collect_list(F.when(F.col("days") > 0, share)))
    average = F.aggregate(shares, F.lit(0.0), lambda total, x: total + x["average"])
    totals = alike.groupBy(product).agg(
        F.coalesce(F.sum("units"), F.lit(0)).cast("bigint").alias("physical_units_sold"),
        F.when(F.max("days") > 0, average).alias("average_inventory_units"),
        F.sum("stores").alias("store_count"),
        F.sum("observed_days").alias("observed_days"),
        F.sum("expected_days").alias("expected_days"),
    )
    coverage = F.round(F.lit(100.0) * F.col("observed_days") / F.col("expected_days"), 2)
    ratio = guarded_ratio(F.col("physical_units_sold"), F.col("average_inventory_units"))
    return (
        totals.where(F.col("average_inventory_units").isNotNull())
        .withColumn("inventory_coverage_pct", coverage)
        .withColumn("inventory_turnover", ratio)
        .drop("observed_days", "expected_days")
    )


def top_k(df: DataFrame, by: str | Column, tie_break: Sequence[str], k: int | None) -> DataFrame:
    """The ``k`` largest rows, NULL last, ties broken by key; all rows, unordered, without ``k``."""
    if k is None:
        return df
    order = F.col(by) if isinstance(by, str) else by
    return df.orderBy(order.desc_nulls_last(), *tie_break).limit(k)
