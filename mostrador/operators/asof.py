"""As-of join: for each row the entry of a dated history that was in force on its day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.dates import Day, as_date, month_of
from ..session import settle

FROM, UNTIL, SLICE = "_from", "_until", "_slice"
#: Month partition of stored intervals.
MONTH = "valid_month"


def validity(
    history: DataFrame,
    keys: Sequence[str],
    effective: str,
    horizon: tuple[Day, Day] | None = None,
) -> DataFrame:
    """History as half-open intervals ``[_from, _until)``; an open end is NULL.

    (keys, effective) must be unique in the history (see ``gates.duplicate_keys``), so one key has
    at most one entry per day and the window below is bounded by the calendar. Entries that are
    never in force inside ``horizon`` are left out.
    """
    order = Window.partitionBy(*keys).orderBy(effective)
    dated = history.where(F.col(effective).isNotNull())
    spans = dated.withColumn(FROM, F.col(effective)).withColumn(UNTIL, F.lead(effective).over(order))
    if horizon:
        first, last = (F.lit(as_date(d)) for d in horizon)
        spans = spans.where((F.col(FROM) <= last) & (F.col(UNTIL).isNull() | (F.col(UNTIL) > first)))
    return spans


def asof_join(
    facts: DataFrame,
    history: DataFrame,
    keys: Sequence[str],
    day: str,
    effective: str,
    values: Sequence[str],
    horizon: tuple[Day, Day] | None = None,
    slices: int = 16,
    store: bool = True,
) -> DataFrame:
    """Left join each fact to the latest history entry with ``effective <= day``.

    The intervals of one key do not overlap, so a fact meets at most one of them and no ranking per
    fact is needed. Time is cut into slices, and both sides join on (keys, slice) with a range
    condition. That spreads a key that holds much of the facts over the slices, compares a fact with
    the entries of one slice only, and keeps the output from being partitioned by the keys alone, so
    that an adaptive skew split stays possible before a later grouping. The history grows by at most
    ``slices`` rows per key.

    The optimiser broadcasts the sliced history when its size allows. It cannot foresee how much the
    slices add, so the sliced history is written once (``store``) and its exact size decides;
    ``store=False`` keeps the call free of jobs, for histories known to be small.

    ``horizon`` is the first and last day that the facts can have, usually the window they were
    filtered with; a fact outside finds no entry. Without it the slices follow the history.
    """
    if horizon is None:
        ends = history.agg(F.min(effective).alias("first"), F.max(effective).alias("last"))
        first, last = ends.select("first").scalar(), ends.select("last").scalar()
        fact_day = F.least(F.col(day), last)  # after the last change the last slice goes on
    else:
        first, last = (F.lit(as_date(d)) for d in horizon)
        fact_day = F.col(day)
    width = F.ceil((F.date_diff(last, first) + 1) / F.lit(slices))

    def slice_of(when: Column) -> Column:
        return F.floor(F.date_diff(when, first) / width).cast("int")

    # LEAST skips NULL: an open interval ends with the horizon.
    ends_on = F.least(F.date_sub(F.col(UNTIL), 1), last)
    starts_on = F.greatest(F.col(FROM), first)
    spans = validity(history, keys, effective, horizon).withColumn(
        SLICE, F.explode(F.sequence(slice_of(starts_on), slice_of(ends_on)))
    )
    on = [*keys, SLICE]
    left = facts.withColumn(SLICE, slice_of(fact_day)).alias("f")
    right = spans.select(*on, FROM, UNTIL, *values)
    right = (settle(right, "history") if store else right).alias("h")
    return _in_force(left, right, on, day, facts.columns, values)


def _in_force(
    left: DataFrame, right: DataFrame, on: Sequence[str], day: str, columns: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """Facts ``f`` with the values of the interval ``h`` that holds their day."""
    matches = [F.col(f"f.{k}") == F.col(f"h.{k}") for k in on]
    matches.append(F.col(f"f.{day}") >= F.col(f"h.{FROM}"))
    matches.append(F.col(f"h.{UNTIL}").isNull() | (F.col(f"f.{day}") < F.col(f"h.{UNTIL}")))
    kept = [F.col(f"f.{c}") for c in columns]
    return left.join(right, matches, "left").select(*kept, *[F.col(f"h.{v}") for v in values])


def monthly_intervals(
    history: DataFrame, keys: Sequence[str], effective: str, values: Sequence[str], horizon: tuple[Day, Day]
) -> DataFrame:
    """A history cut at calendar months, to be stored once and read by any number of :func:`interval_join`.

    One row per key, entry and month of ``horizon`` in which the entry is in force; (keys, effective) must be unique.
    Unlike the slices of :func:`asof_join`, months do not depend on the window of one report, so reports with
    different windows share the table, and its partition column lets each read its own months only.
    """
    first, last = (F.lit(as_date(d)) for d in horizon)
    starts, ends = F.greatest(F.col(FROM), first), F.least(F.date_sub(F.col(UNTIL), 1), last)
    months = F.sequence(month_of(starts), month_of(ends), F.expr("INTERVAL 1 MONTH"))
    spans = validity(history, keys, effective, (as_date(horizon[0]), as_date(horizon[1])))
    return spans.select(*keys, FROM, UNTIL, *values, F.explode(months).alias(MONTH))


def interval_join(
    facts: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str],
    day: str,
    values: Sequence[str],
    horizon: tuple[Day, Day] | None = None,
) -> DataFrame:
    """:func:`asof_join` on stored :func:`monthly_intervals`: no job, no window and no copy of the history.

    A fact meets the intervals of its own month, at most one of which holds its day; a fact of a month that is not
    stored finds no entry. ``horizon``, the first and last day that the facts can have, prunes the months that
    are read. A hot key is spread over the months, and an adaptive skew split stays possible.
    """
    right = intervals
    if horizon:
        first, last = (as_date(d).replace(day=1) for d in horizon)
        right = right.where(F.col(MONTH).between(F.lit(first), F.lit(last)))
    right = right.select(*keys, F.col(MONTH).alias(SLICE), FROM, UNTIL, *values).alias("h")
    left = facts.withColumn(SLICE, month_of(day)).alias("f")
    return _in_force(left, right, [*keys, SLICE], day, facts.columns, values)
