"""Resolution of the codes of one system to canonical ids."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..functions import code_number
from .gates import (
    Gate, conflicting_targets, contradictions, duplicate_keys, duplicate_numbers, guarded, unknown_keys,
)

# How a code was resolved.
EXPLICIT, INFERRED, NOT_OBSERVED = "explicit", "inferred_numeric_pattern", "not_observed"


@dataclass(frozen=True)
class CodeSystem:
    """One source of codes: its name, its column in the mapping table, its number format."""

    label: str
    column: str
    pattern: str


def observed_codes(facts: DataFrame, column: str, name: str) -> DataFrame:
    """Distinct non-NULL codes of a fact table."""
    return facts.select(F.col(column).alias(name)).where(F.col(name).isNotNull()).distinct()


def explicit_pairs(mappings: DataFrame, system: CodeSystem, target: str) -> DataFrame:
    """Complete (code, target) pairs of the mapping table, without repeats."""
    pair = [system.column, target]
    return mappings.dropna(subset=pair).select(*pair).distinct()


def numbered(catalog: DataFrame, target: str, pattern: str, number: str = "product_number") -> DataFrame:
    return catalog.withColumn(number, code_number(target, pattern))


def resolve_codes(
    observed: DataFrame,
    explicit: DataFrame,
    catalog: DataFrame,
    system: CodeSystem,
    target: str = "sku_erp",
    number: str = "product_number",
) -> DataFrame:
    """(code, target, mapping_method) for each observed code; target is NULL when unresolved.

    An explicit pair wins; otherwise the number inside the code is looked up in the catalog.
    """
    code = system.column
    by_number = catalog.where(F.col(number).isNotNull()).select(
        F.col(number).alias("_number"), F.col(target).alias("_fallback")
    )
    pairs = explicit.select(code, F.col(target).alias("_explicit"))
    # Codes without a number get a negative one that matches nothing; as NULL they would all be
    # shuffled to one task.
    nowhere = -1 - F.pmod(F.xxhash64(code), F.lit(1 << 20))
    looked_up = (
        observed.join(pairs, code, "left")
        .withColumn("_code_number", F.coalesce(code_number(code, system.pattern), nowhere))
        .join(by_number, F.col("_code_number") == F.col("_number"), "left")
    )
    method = F.when(F.col("_explicit").isNotNull(), F.lit(EXPLICIT)).otherwise(F.lit(INFERRED))
    return looked_up.select(
        code, F.coalesce("_explicit", "_fallback").alias(target), method.alias("mapping_method")
    )


def mapping_gates(
    mappings: DataFrame,
    catalog: DataFrame,
    system: CodeSystem,
    target: str,
    target_pattern: str,
) -> list[Gate]:
    """Rules on the explicit pairs of one system, which hold whether or not a code was observed."""
    pairs = explicit_pairs(mappings, system, target)
    return [
        Gate(
            f"Conflicting explicit {system.label} mappings",
            conflicting_targets(pairs, system.column, target),
            [system.column],
        ),
        Gate(
            f"Explicit {system.label} mappings name products that are not in the catalog",
            unknown_keys(pairs, target, catalog),
        ),
        Gate(
            f"Explicit {system.label} mappings contradict the numbers in the codes",
            contradictions(pairs, system.column, system.pattern, target, target_pattern),
        ),
    ]


def resolution_gates(resolved: DataFrame, system: CodeSystem, target: str) -> list[Gate]:
    """Rules on the resolved codes of one system."""
    found = resolved.where(F.col(target).isNotNull())
    return [
        Gate(
            f"{system.label} codes without an explicit mapping that their number cannot resolve",
            resolved.where(F.col(target).isNull()).select(system.column),
        ),
        Gate(
            f"Several observed {system.label} codes resolve to the same product",
            duplicate_keys(found, [target]),
            [target],
        ),
    ]


def catalog_gates(catalog: DataFrame, target: str, number: str = "product_number") -> list[Gate]:
    return [
        Gate(f"The catalog repeats {target}", duplicate_keys(catalog, [target]), [target]),
        Gate(
            "Catalog numbers are not unique, so codes cannot be resolved by number",
            duplicate_numbers(catalog, number),
            [number],
        ),
    ]


def attach_ids(
    facts: DataFrame, bridge: DataFrame, code: str, bridge_code: str, label: str, target: str = "sku_erp", strict: bool = True
) -> DataFrame:
    """Facts with their canonical id; a fact without one fails the job that reads the id.

    Without ``strict`` its id is NULL, for a ``gates.Watch`` on the pass that writes the facts to count and name.
    """
    ids = bridge.where(F.col(bridge_code).isNotNull()).select(
        F.col(bridge_code).alias("_code"), F.col(target).alias("_id")
    )
    shown = F.concat(F.lit(f"Unreconciled {label} code: "), F.coalesce(F.col(code).cast("string"), F.lit("NULL")))
    joined = facts.join(ids, F.col(code) == F.col("_code"), "left")
    resolved = guarded(F.col("_id"), F.col("_id").isNotNull(), shown) if strict else F.col("_id")
    return joined.withColumn(target, resolved).drop("_code", "_id")


def unreconciled(facts: DataFrame, bridge: DataFrame, code: str, bridge_code: str) -> DataFrame:
    """Distinct codes, NULL included, of facts that the bridge does not resolve."""
    ids = bridge.where(F.col(bridge_code).isNotNull()).select(F.col(bridge_code).alias(code))
    return facts.select(code).distinct().join(ids, code, "left_anti")


def assemble_bridge(
    catalog: DataFrame,
    resolved: Sequence[tuple[DataFrame, str, str, str]],
    target: str = "sku_erp",
) -> DataFrame:
    """Catalog with one code and method column per system.

    ``resolved`` lists (frame, code column, output code column, output method column).
    """
    bridge = catalog
    for frame, code, code_out, method_out in resolved:
        side = frame.select(target, F.col(code).alias(code_out), F.col("mapping_method").alias(method_out))
        bridge = bridge.join(side, target, "left").withColumn(
            method_out, F.coalesce(F.col(method_out), F.lit(NOT_OBSERVED))
        )
    return bridge
