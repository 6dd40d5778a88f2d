"""Stretches of consecutive calendar days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .gates import guarded


def consecutive_days(
    days: DataFrame,
    keys: Sequence[str],
    day: str,
    min_days: int = 4,
    on_duplicate: str = "fail",
    names: tuple[str, str, str] = ("run_start", "run_end", "run_days"),
    counts: Column | None = None,
) -> DataFrame:
    """Maximal runs of consecutive days per key, at least ``min_days`` long.

    ``counts`` marks the rows that qualify (default: all); a day without one ends a run. Rows without a day
    belong to no run.

    A key has one row per day, which the job relies on and checks (``on_duplicate="fail"``): one shuffle by the
    keys, and a row on the same day as the one before it, qualifying or not, fails. With ``"merge"`` a day counts
    once however many rows it has; those are combined before the shuffle, so that a key with very many rows has at
    most one per calendar day when it reaches its task.
    """
    if on_duplicate not in ("fail", "merge"):
        raise ValueError("on_duplicate is 'fail' or 'merge'")
    start, end, length = names
    wanted = F.lit(True) if counts is None else F.coalesce(counts, F.lit(False))
    cells = days.select(*keys, F.to_date(day).alias("_day"), wanted.alias("_counts")).where(F.col("_day").isNotNull())
    ordered = Window.partitionBy(*keys).orderBy("_day")
    if on_duplicate == "fail":
        shown = [F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in (*keys, "_day")]
        message = F.concat(F.lit("more than one row for "), F.concat_ws(" / ", *shown))
        again = F.coalesce(F.lag("_day").over(ordered) == F.col("_day"), F.lit(False))
        cells = cells.withColumn("_again", again).withColumn("_counts", guarded(F.col("_counts"), ~F.col("_again"), message))
        cells = cells.where("_counts").select(*keys, "_day")
    else:
        cells = cells.where("_counts").select(*keys, "_day").distinct()
    # Inside a run the day and its position grow together, so their difference names the run.
    islands = cells.withColumn("_island", F.date_sub(F.col("_day"), F.row_number().over(ordered)))
    return (
        islands.groupBy(*keys, "_island")
        .agg(
            F.min("_day").alias(start),
            F.max("_day").alias(end),
            F.count(F.lit(1)).alias(length),
        )
        .where(F.col(length) >= min_days)
        .drop("_island")
    )
