"""The product bridge: one row per catalog product with its codes in the other systems."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import ERP_CODE, HANDLE_CODE, POS_CODE
from ..operators.gates import Gate, duplicate_keys, enforce, require_columns
from ..operators.resolve import (
    CodeSystem, assemble_bridge, attach_ids, catalog_gates, explicit_pairs, mapping_gates, numbered,
    observed_codes, resolution_gates, resolve_codes,
)
from ..session import settle
from ..sources.readers import Erp

POS = CodeSystem("POS", "sku_pos", POS_CODE)
WEB = CodeSystem("web shop", "handle", HANDLE_CODE)

COLUMNS = (
    "sku_erp", "nombre", "categoria", "sku_pos", "product_handle", "product_number",
    "pos_mapping_method", "shopify_mapping_method",
)


def build_bridge(sales: DataFrame, orders: DataFrame, erp: Erp, check: bool = True) -> DataFrame:
    """Resolve every observed code: explicit mapping first, then the number in the code, else fail.

    Each fact is read once, for its distinct codes; the resolved codes are written to the shared
    folder and everything after that, gates included, works on catalog-sized tables.
    """
    require_columns(erp.mappings, ("sku_pos", "sku_erp", "handle"), "sku_mappings")
    require_columns(sales, ("sku",), "sales")
    require_columns(orders, ("product_handle",), "orders")
    catalog = numbered(erp.products.select("sku_erp", "nombre", "categoria"), "sku_erp", ERP_CODE)
    if check:
        enforce(
            *catalog_gates(catalog, "sku_erp"),
            *mapping_gates(erp.mappings, catalog, POS, "sku_erp", ERP_CODE),
            *mapping_gates(erp.mappings, catalog, WEB, "sku_erp", ERP_CODE),
        )
    resolved = {}
    for system, facts, column in ((POS, sales, "sku"), (WEB, orders, "product_handle")):
        seen = observed_codes(facts, column, system.column)
        explicit = explicit_pairs(erp.mappings, system, "sku_erp")
        codes = resolve_codes(seen, explicit, catalog, system)
        resolved[system.label] = settle(codes, f"codes-{system.column}") if check else codes
    if check:
        enforce(
            *[g for s in (POS, WEB) for g in resolution_gates(resolved[s.label], s, "sku_erp")]
        )
    bridge = assemble_bridge(
        catalog,
        [
            (resolved[POS.label], "sku_pos", "sku_pos", "pos_mapping_method"),
            (resolved[WEB.label], "handle", "product_handle", "shopify_mapping_method"),
        ],
    )
    return bridge.select(*COLUMNS)


def _one_product_per_code(bridge: DataFrame, code: str) -> None:
    known = bridge.where(F.col(code).isNotNull())
    enforce(Gate(f"The product bridge repeats {code}", duplicate_keys(known, [code]), [code]))


def reconcile_sales(sales: DataFrame, bridge: DataFrame, check: bool = True, strict: bool = True) -> DataFrame:
    """Point-of-sale rows with ``sku_erp``. ``check`` makes sure that the join cannot repeat a sale."""
    if check:
        _one_product_per_code(bridge, "sku_pos")
    return attach_ids(sales, bridge, "sku", "sku_pos", "POS", strict=strict)


def reconcile_orders(orders: DataFrame, bridge: DataFrame, check: bool = True, strict: bool = True) -> DataFrame:
    """Web-shop rows with ``sku_erp``. ``check`` makes sure that the join cannot repeat an order."""
    if check:
        _one_product_per_code(bridge, "product_handle")
    return attach_ids(orders, bridge, "product_handle", "product_handle", "web shop", strict=strict)
