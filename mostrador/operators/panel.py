"""Profile of a daily panel from one scan: readings by (pair, day), then by pair and by day; all reports read those."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..session import settle
from . import profile

MEASURES = ("n_rows", "n_missing", "n_zero", "n_sentinel")


@dataclass(frozen=True)
class Panel:
    """Rows, missing, zero and sentinel readings per (pair, day as delivered), per pair and per day.

    Rows without a complete pair, or without a day, are groups of their own; ``pairs`` has ``n_days``, the distinct days.
    """

    cells: DataFrame
    pairs: DataFrame
    days: DataFrame
    pair: tuple[str, str]

    def _complete(self) -> DataFrame:
        return self.pairs.dropna(subset=list(self.pair))

    def sentinels(self) -> DataFrame:
        counted = self.pairs.agg(
            F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"), F.coalesce(F.sum("n_sentinel"), F.lit(0)).alias("n_sentinel")
        )
        share = F.try_divide(F.col("n_sentinel") * 100.0, F.col("n_rows").cast("double"))
        return counted.withColumn("sentinel_pct", F.round(share, 4))

    def repeated(self) -> DataFrame:
        """Rows beyond the first of their pair and day as delivered."""
        return self.cells.agg(F.coalesce(F.sum(F.col("n_rows") - 1), F.lit(0)).cast("bigint").alias("n_duplicates"))

    def calendar(self) -> DataFrame:
        return profile.calendar_summary(self.days, "day")

    def missing_days(self) -> DataFrame:
        return profile.missing_days(self.days, "day")

    def coverage(self) -> DataFrame:
        """Pairs, min / max / exact median of their days, and pairs with all or only some of the days."""
        # a day that only incomplete pairs have is no day of the pairs
        every = self.days.where(F.col("day").isNotNull() & (F.col("n_complete") > 0)).agg(F.count(F.lit(1))).scalar()
        return profile.coverage_of_days(self._complete().select("n_days"), every)

    def days_per_pair(self) -> DataFrame:
        return profile.distribution(self._complete(), "n_days", "n_pairs")

    def _dated(self) -> DataFrame:
        return self.days.where(F.col("day").isNotNull())

    def rows_per_day(self) -> DataFrame:
        return self._dated().agg(
            F.min("n_rows").alias("min_rows"),
            F.max("n_rows").alias("max_rows"),
            F.count_distinct("n_rows").alias("n_distinct_counts"),
        )

    def day_sizes(self) -> DataFrame:
        return profile.distribution(self._dated().select("n_rows"), "n_rows", "n_days")

    def spread(self, measure: str) -> DataFrame:
        """Rows counted by a measure, and the pairs, stores, products and days they touch."""
        store, product = self.pair
        touched = self._dated().where(F.col(measure) > 0).agg(F.count(F.lit(1))).scalar()
        return self.pairs.where(F.col(measure) > 0).agg(
            F.coalesce(F.sum(measure), F.lit(0)).alias("n_rows"),
            F.count(F.lit(1)).alias("n_pairs"),
            F.count_distinct(store).alias("n_stores"),
            F.count_distinct(product).alias("n_products"),
            F.max(touched).alias("n_days"),
        ).withColumn("n_days", F.coalesce("n_days", F.lit(0)))

    def missing_per_pair(self) -> DataFrame:
        share = F.col("n_missing").cast("double") / F.col("n_rows") * 100
        return self._complete().select(*self.pair, "n_missing", "n_rows", share.alias("missing_pct"))


def read_panel(df: DataFrame, pair: tuple[str, str], day: str, value: Column, raw: Column | None = None, sentinel: str = "N/A") -> Panel:
    """Scan a panel once. ``value`` is the reading (NULL: unknown), ``raw`` the text in which the sentinel stands.

    The groupings combine rows before they shuffle, and the tables by pair and by day are made from the stored cells.
    """
    of_raw = F.lit(False) if raw is None else raw.cast("string") == sentinel
    rows = df.select(*pair, F.col(day).alias("_day"), value.alias("_value"), of_raw.alias("_sentinel"))
    cells = rows.groupBy(*pair, "_day").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("_value").isNull()).cast("bigint").alias("n_missing"),
        F.count_if(F.col("_value") == 0).cast("bigint").alias("n_zero"),
        F.count_if("_sentinel").cast("bigint").alias("n_sentinel"),
    )
    cells = settle(cells.withColumn("day", F.to_date("_day")), "panel-cells")
    sums = [F.sum(m).alias(m) for m in MEASURES]
    pairs = settle(cells.groupBy(*pair).agg(*sums, F.count_distinct("day").alias("n_days")), "panel-pairs")
    complete = F.col(pair[0]).isNotNull() & F.col(pair[1]).isNotNull()
    days = settle(cells.groupBy("day").agg(*sums, F.count_if(complete).cast("bigint").alias("n_complete")), "panel-days")
    return Panel(cells, pairs, days, tuple(pair))
