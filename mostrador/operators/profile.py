"""Source profiling: counts, ranges, coverage, missing values, rule agreement.

Every operator returns a DataFrame, one row per metric or per group, and combines rows before it
shuffles. Listings stay flat (one row per member), so no group is collected into one row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import code_number
from ..functions.dates import Day, within
from .resolve import CodeSystem


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _count_if(condition: Column, name: str) -> Column:
    return F.count_if(condition).cast("bigint").alias(name)


# --- counts and ranges -----------------------------------------------------------------------


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per named table."""
    return union_all(
        [df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("source", F.lit(name)) for name, df in tables.items()]
    ).select("source", "n_rows")


def date_ranges(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """First and last calendar day per named (table, date column)."""
    return union_all(
        [
            df.agg(F.min(F.to_date(day)).alias("first_day"), F.max(F.to_date(day)).alias("last_day"))
            .withColumn("source", F.lit(name))
            for name, (df, day) in tables.items()
        ]
    ).select("source", "first_day", "last_day")


def common_range(ranges: DataFrame) -> DataFrame:
    """The days that all sources of :func:`date_ranges` cover: latest first to earliest last."""
    return ranges.agg(F.max("first_day").alias("first_day"), F.min("last_day").alias("last_day"))


def id_uniqueness(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-NULL ids, and rows beyond the first of their id."""
    groups = df.groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.count(column).alias("n_distinct"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("n_duplicates"),
    )


def duplicate_row_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows beyond the first of their composite key."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("n_duplicates"))


def has_column(df: DataFrame, column: str) -> bool:
    return column in df.columns


def sentinel_share(df: DataFrame, column: str, sentinel: str = "N/A") -> DataFrame:
    """How often a column holds the exact text of a sentinel."""
    counted = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        _count_if(F.col(column).cast("string") == sentinel, "n_sentinel"),
    )
    share = F.try_divide(F.col("n_sentinel") * 100.0, F.col("n_rows").cast("double"))
    return counted.withColumn("sentinel_pct", F.round(share, 4))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, NULL included."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))


# --- sets ------------------------------------------------------------------------------------


def membership(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """Each distinct non-NULL value of two columns and the sides it occurs on, in one shuffle."""
    sides = left.select(F.col(left_key).alias("value"), F.lit(True).alias("l"), F.lit(False).alias("r")).unionAll(
        right.select(F.col(right_key).alias("value"), F.lit(False).alias("l"), F.lit(True).alias("r"))
    )
    known = sides.where(F.col("value").isNotNull())
    return known.groupBy("value").agg(F.bool_or("l").alias("in_left"), F.bool_or("r").alias("in_right"))


def set_comparison(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """Sizes of both sets, of their overlap and differences, and whether they are equal."""
    l, r = F.col("in_left"), F.col("in_right")
    sizes = membership(left, left_key, right, right_key).agg(
        _count_if(l, "n_left"),
        _count_if(r, "n_right"),
        _count_if(l & r, "n_both"),
        _count_if(l & ~r, "n_left_only"),
        _count_if(r & ~l, "n_right_only"),
    )
    return sizes.withColumn("identical", (F.col("n_left_only") == 0) & (F.col("n_right_only") == 0))


def missing_from(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """Distinct values of the left column that the right one lacks."""
    sides = membership(left, left_key, right, right_key)
    return sides.where("in_left AND NOT in_right").select("value")


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[_count_if(F.col(c).isNull(), f"null_{c}") for c in columns])


# --- codes -----------------------------------------------------------------------------------


def unparseable(codes: DataFrame, column: str, pattern: str) -> DataFrame:
    """Codes in all and codes without a number."""
    return codes.agg(
        F.count(F.lit(1)).alias("n_codes"),
        _count_if(code_number(column, pattern).isNull(), "n_unparseable"),
    )


def with_numbers(mapping: DataFrame, systems: Sequence[CodeSystem]) -> DataFrame:
    """Mapping rows with ``number_<column>`` per code system."""
    return mapping.select("*", *[code_number(s.column, s.pattern).alias(f"number_{s.column}") for s in systems])


def _agree(systems: Sequence[CodeSystem]) -> Column:
    # Two missing numbers do not agree: a NULL comparison counts as a mismatch.
    numbers = [F.col(f"number_{s.column}") for s in systems]
    pairs = [a == b for a, b in zip(numbers, numbers[1:])]
    return F.coalesce(reduce(lambda x, y: x & y, pairs), F.lit(False))


def known_rows(mapping: DataFrame, systems: Sequence[CodeSystem]) -> DataFrame:
    """Mapping rows in which all the named systems have a code, with numbers and ``agrees``."""
    present = mapping.dropna(subset=[s.column for s in systems])
    return with_numbers(present, systems).withColumn("agrees", _agree(systems))


def rule_agreement(mapping: DataFrame, systems: Sequence[CodeSystem]) -> DataFrame:
    """Known rows, and how many agree on the number, for two or more systems."""
    return known_rows(mapping, systems).agg(
        F.count(F.lit(1)).alias("n_known"),
        _count_if(F.col("agrees"), "n_match"),
        _count_if(~F.col("agrees"), "n_mismatch"),
    )


def rule_mismatches(mapping: DataFrame, systems: Sequence[CodeSystem]) -> DataFrame:
    return known_rows(mapping, systems).where(~F.col("agrees")).drop("agrees")


def row_conflicts(mapping: DataFrame, systems: Sequence[CodeSystem]) -> DataFrame:
    """Mapping rows whose codes carry more than one distinct number."""
    numbers = F.array_distinct(F.array_compact(F.array(*[F.col(f"number_{s.column}") for s in systems])))
    return with_numbers(mapping, systems).where(F.size(numbers) > 1)


def shared_numbers(catalog: DataFrame, number: str) -> DataFrame:
    """Catalog rows whose number occurs more than once (rows without a number do not count)."""
    numbered = catalog.where(F.col(number).isNotNull())
    repeated = numbered.groupBy(number).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(number)
    return numbered.join(repeated, number, "left_semi")


def catalog_uniqueness(catalog: DataFrame, number: str) -> DataFrame:
    """Rows, rows with a number, distinct numbers, and rows that share their number."""
    groups = catalog.groupBy(number).agg(F.count(F.lit(1)).alias("_n"))
    known = F.col(number).isNotNull()
    return groups.agg(
        F.sum("_n").alias("n_rows"),
        F.coalesce(F.sum(F.when(known, F.col("_n"))), F.lit(0)).cast("bigint").alias("n_parsed"),
        _count_if(known, "n_distinct"),
        F.coalesce(F.sum(F.when(known & (F.col("_n") > 1), F.col("_n"))), F.lit(0)).cast("bigint").alias("n_sharing"),
    )


def collisions(df: DataFrame, number: str, code: str) -> DataFrame:
    """Numbers carried by more than one distinct code, one row per (number, code)."""
    pairs = df.where(F.col(number).isNotNull() & F.col(code).isNotNull()).select(number, code).distinct()
    crowded = pairs.groupBy(number).agg(F.count(F.lit(1)).alias("n_codes")).where("n_codes > 1")
    return pairs.join(crowded, number)


def candidate_counts(unmapped: DataFrame, code: str, pattern: str, catalog: DataFrame, number: str) -> DataFrame:
    """How many catalog rows carry the number of each unmapped code; 0 also for a code without one.

    The rows themselves are listed once per number by :func:`candidate_rows`: codes that share a
    number share its candidates, so pairing every code with every row would only multiply them.
    """
    coded = unmapped.select(code, code_number(code, pattern).alias("code_number"))
    counts = (
        catalog.where(F.col(number).isNotNull())
        .groupBy(F.col(number).alias("_number"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return coded.join(counts, F.col("code_number") == F.col("_number"), "left").select(
        code, "code_number", F.coalesce("_n", F.lit(0)).cast("bigint").alias("n_candidates")
    )


def candidate_rows(unmapped: DataFrame, code: str, pattern: str, catalog: DataFrame, number: str) -> DataFrame:
    """Catalog rows whose number occurs in an unmapped code."""
    wanted = unmapped.select(code_number(code, pattern).alias(number)).distinct()
    return catalog.join(wanted, number, "left_semi")


def coverage_in_window(
    facts: DataFrame,
    when: str,
    code: str,
    pattern: str,
    units: str,
    catalog: DataFrame,
    number: str,
    start: Day,
    end: Day,
) -> DataFrame:
    """Rows and units in a window that the number rule alone maps to exactly one catalog row."""
    single = (
        catalog.where(F.col(number).isNotNull())
        .groupBy(F.col(number).alias("_number"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .where("_n = 1")
        .select("_number", F.lit(True).alias("_mapped"))
    )
    # Combined per code first: a hot code is one row before the lookup.
    per_code = (
        within(facts, when, start, end)
        .groupBy(code)
        .agg(F.count(F.lit(1)).alias("_rows"), F.sum(units).alias("_units"))
    )
    looked_up = per_code.withColumn("_code_number", code_number(code, pattern)).join(
        single, F.col("_code_number") == F.col("_number"), "left"
    )
    mapped = F.col("_mapped").isNotNull()
    # whole units stay whole, fractions stay fractions
    units_kind = "bigint" if isinstance(facts.schema[units].dataType, T.IntegralType) else "double"

    def total(column: str, condition: Column | None, name: str) -> Column:
        value = F.col(column) if condition is None else F.when(condition, F.col(column))
        return F.coalesce(F.sum(value), F.lit(0)).cast("bigint" if column == "_rows" else units_kind).alias(name)

    return looked_up.agg(
        total("_rows", None, "n_rows"),
        total("_rows", mapped, "mapped_rows"),
        total("_rows", ~mapped, "unmapped_rows"),
        total("_units", None, "total_units"),
        total("_units", mapped, "mapped_units"),
        total("_units", ~mapped, "unmapped_units"),
    )


# --- daily panel -----------------------------------------------------------------------------


def observed_days(df: DataFrame, day: str) -> DataFrame:
    return df.select(F.to_date(day).alias("day")).where(F.col("day").isNotNull()).distinct()


def missing_days(df: DataFrame, day: str) -> DataFrame:
    """Calendar days between the first and the last observed day that have no row."""
    seen = observed_days(df, day)
    bounds = seen.agg(F.min("day").alias("_first"), F.max("day").alias("_last"))
    return bounds.select(F.explode(F.sequence("_first", "_last")).alias("day")).join(seen, "day", "left_anti")


def calendar_summary(df: DataFrame, day: str) -> DataFrame:
    """First and last day, observed days, calendar days and missing days."""
    spans = observed_days(df, day).agg(
        F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.count("day").alias("n_observed")
    )
    expected = (F.date_diff(F.col("last_day"), F.col("first_day")) + 1).cast("bigint")
    return spans.withColumn("n_expected", expected).withColumn(
        "n_missing", F.col("n_expected") - F.col("n_observed")
    )


def _pair_days(df: DataFrame, pair: Sequence[str], day: str) -> DataFrame:
    """Distinct (pair, day); rows without a complete pair do not count."""
    return df.dropna(subset=list(pair)).select(*pair, F.to_date(day).alias("_day")).distinct()


def days_per_pair(df: DataFrame, pair: Sequence[str], day: str) -> DataFrame:
    """Distinct days per pair."""
    return _pair_days(df, pair, day).groupBy(*pair).agg(F.count("_day").alias("n_days"))


def pair_coverage(df: DataFrame, pair: Sequence[str], day: str) -> DataFrame:
    """Pairs, min / max / exact median of their days, and pairs with all or only some days."""
    days = _pair_days(df, pair, day)
    every = days.select("_day").distinct().agg(F.count("_day")).scalar()
    return coverage_of_days(days.groupBy(*pair).agg(F.count("_day").alias("n_days")), every)


def coverage_of_days(per_pair: DataFrame, every: Column) -> DataFrame:
    """The report of :func:`pair_coverage` from the days per pair and the number of all days."""
    return per_pair.withColumn("_every", every).agg(
        F.count(F.lit(1)).alias("n_pairs"),
        F.min("n_days").alias("min_days"),
        F.max("n_days").alias("max_days"),
        F.median("n_days").alias("median_days"),
        _count_if(F.col("n_days") == F.col("_every"), "full_pairs"),
        _count_if(F.col("n_days") != F.col("_every"), "partial_pairs"),
    )


def distribution(per_group: DataFrame, measure: str, out: str = "n_groups") -> DataFrame:
    """How many groups have each value of a measure."""
    return per_group.groupBy(measure).agg(F.count(F.lit(1)).alias(out))


def rows_per_day(df: DataFrame, day: str) -> DataFrame:
    dated = df.where(F.col(day).isNotNull())
    return dated.groupBy(F.to_date(day).alias("day")).agg(F.count(F.lit(1)).alias("n_rows"))


def rows_per_day_summary(df: DataFrame, day: str) -> DataFrame:
    return rows_per_day(df, day).agg(
        F.min("n_rows").alias("min_rows"),
        F.max("n_rows").alias("max_rows"),
        F.count_distinct("n_rows").alias("n_distinct_counts"),
    )


def spread(df: DataFrame, condition: Column, pair: tuple[str, str], day: str) -> DataFrame:
    """Rows that meet a condition, and the pairs, stores, products and days they touch."""
    store, product = pair
    return df.where(condition).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(F.struct(store, product)).alias("n_pairs"),
        F.count_distinct(store).alias("n_stores"),
        F.count_distinct(product).alias("n_products"),
        F.count_distinct(F.to_date(day)).alias("n_days"),
    )


def missing_per_pair(df: DataFrame, pair: Sequence[str], value: str) -> DataFrame:
    """Missing and all rows per complete pair, and the missing percentage."""
    counted = df.dropna(subset=list(pair)).groupBy(*pair).agg(
        _count_if(F.col(value).isNull(), "n_missing"), F.count(F.lit(1)).alias("n_rows")
    )
    return counted.withColumn("missing_pct", F.col("n_missing").cast("double") / F.col("n_rows") * 100)


def missing_summary(per_pair: DataFrame) -> DataFrame:
    """Min, max, exact median and mean of missing rows per pair, and the largest percentage."""
    return per_pair.agg(
        F.min("n_missing").alias("min_missing"),
        F.max("n_missing").alias("max_missing"),
        F.median("n_missing").alias("median_missing"),
        F.avg("n_missing").alias("mean_missing"),
        F.max("missing_pct").alias("max_missing_pct"),
    )


def most_missing(per_pair: DataFrame, pair: Sequence[str], k: int = 10) -> DataFrame:
    """The pairs with the largest missing percentage, ties broken by pair."""
    return per_pair.orderBy(F.desc("missing_pct"), *pair).limit(k)
