"""Data-quality gates.

Every gate is a lazy frame of violations. :func:`enforce` runs any number of them as one job and
raises :class:`GateError` with a bounded preview of the first one that is not empty.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F

from ..functions import code_number

PREVIEW = 10


class GateError(ValueError):
    """The input breaks a rule that the results rely on."""


@dataclass(frozen=True)
class Gate:
    """A rule, the rows that break it, and how to show them (in ``order``, joined by ``glue``)."""

    message: str
    violations: DataFrame
    order: Sequence[str] = field(default=())
    glue: str = " / "

    def keys(self, position: int) -> DataFrame:
        shown = list(self.order) or self.violations.columns
        text = F.concat_ws(self.glue, *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in shown])
        return self.violations.select(F.lit(position).alias("gate"), text.alias("key"))


def enforce(*gates: Gate, preview: int = PREVIEW) -> None:
    """Raise for the first broken gate, with its first keys.

    All gates run as one job, and at most ``preview + 1`` rows reach the driver.
    """
    if not gates:
        return
    every = reduce(DataFrame.unionByName, [gate.keys(i) for i, gate in enumerate(gates)])
    rows = every.orderBy("gate", "key").limit(preview + 1).collect()
    if rows:
        first = rows[0]["gate"]
        keys = [row["key"] for row in rows if row["gate"] == first]
        more = ", ..." if len(keys) > preview else ""
        count = f"more than {preview}" if more else str(len(keys))
        raise GateError(f"{gates[first].message} ({count} found: {', '.join(keys[:preview])}{more})")


def guarded(value: Column, holds: Column, message: str | Column) -> Column:
    """``value`` where the rule holds; elsewhere the job fails when the value is needed.

    For rules that can be checked on the way, without another pass over the facts.
    """
    text = F.lit(message) if isinstance(message, str) else message
    return F.when(holds, value).otherwise(F.raise_error(text))


@dataclass(frozen=True)
class RowRule:
    """A rule on single rows: what is wrong, the condition of a broken row, and the column that names it."""

    message: str
    broken: Column
    shown: Column


class Watch:
    """Row rules that are counted while a frame is written, without a second read of it.

        watch = Watch(facts, rules)
        watch.frame.write.parquet(path)
        watch.check()

    ``check`` waits for the write and raises :class:`GateError` for the first broken rule, with the number of rows and
    the smallest and largest name among them. Rows of a task that runs again after a loss count again, so the number
    can be too large then; whether a rule is broken, and the names, cannot change.
    """

    def __init__(self, df: DataFrame, rules: Sequence[RowRule]):
        self.rules, self.observation = list(rules), Observation()
        self.frame = df
        if self.rules:
            counters = []
            for i, rule in enumerate(self.rules):
                broken = F.coalesce(rule.broken, F.lit(False))
                name = F.when(broken, F.coalesce(rule.shown.cast("string"), F.lit("NULL")))
                counters += [F.count_if(broken).alias(f"n{i}"), F.min(name).alias(f"first{i}"), F.max(name).alias(f"last{i}")]
            self.frame = df.observe(self.observation, *counters)

    def check(self) -> None:
        found = self.observation.get if self.rules else {}
        for i, rule in enumerate(self.rules):
            if n := found.get(f"n{i}"):
                first, last = found[f"first{i}"], found[f"last{i}"]
                names = first if first == last else f"{first} to {last}"
                raise GateError(f"{rule.message} ({n} rows: {names})")


# --- structure -------------------------------------------------------------------------------


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    return sorted(set(required) - set(df.columns))


def require_columns(df: DataFrame, required: Iterable[str], name: str) -> None:
    missing = missing_columns(df, required)
    if missing:
        raise GateError(f"{name} is missing required columns: {missing}")


# --- keys and references ---------------------------------------------------------------------


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count; NULL keys form one group."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def duplicate_numbers(df: DataFrame, number: str) -> DataFrame:
    """Derived numbers shared by several rows; rows without a number do not count."""
    return duplicate_keys(df.where(F.col(number).isNotNull()), [number])


def conflicting_targets(mapping: DataFrame, source: str, target: str) -> DataFrame:
    """Source codes that map to more than one target."""
    pairs = mapping.dropna(subset=[source, target]).select(source, target).distinct()
    return pairs.groupBy(source).agg(F.count(F.lit(1)).alias("n_targets")).where("n_targets > 1")


def unknown_keys(df: DataFrame, key: str, known: DataFrame, known_key: str | None = None) -> DataFrame:
    """Distinct non-NULL keys of ``df`` that ``known`` does not have."""
    wanted = df.where(F.col(key).isNotNull()).select(key).distinct()
    have = known.select(F.col(known_key or key).alias(key)).distinct()
    return wanted.join(have, key, "left_anti")


def contradictions(
    mapping: DataFrame, left: str, left_pattern: str, right: str, right_pattern: str
) -> DataFrame:
    """Mapping rows whose two codes both carry a number, and not the same one."""
    a, b = code_number(left, left_pattern), code_number(right, right_pattern)
    return mapping.where(a != b).select(left, right).distinct()


# --- effective-dated tables ------------------------------------------------------------------


def missing_rates(
    sales: DataFrame,
    rates: DataFrame,
    base: str = "MXN",
    day: str = "sale_date",
    currency: str = "currency",
    rate_day: str = "rate_date",
    rate: str = "rate_to_mxn",
) -> DataFrame:
    """Distinct (day, currency) of foreign sales without a rate; a NULL rate is no rate."""
    wanted = sales.where(F.col(currency) != base).select(day, currency).distinct()
    have = rates.where(F.col(rate).isNotNull()).select(F.col(rate_day).alias(day), currency)
    return wanted.join(have, [day, currency], "left_anti")


def uncosted(costed: DataFrame, cost: str, key: str) -> DataFrame:
    """Distinct keys that have a row without an applicable cost."""
    return costed.where(F.col(cost).isNull()).select(key).distinct()
