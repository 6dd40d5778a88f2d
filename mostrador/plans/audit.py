"""Audit of the raw feeds: the profiling operators applied to all four sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import ERP_CODE, HANDLE_CODE, POS_CODE
from ..functions.dates import Day
from ..operators import profile
from ..operators.panel import read_panel
from ..operators.resolve import CodeSystem, numbered, observed_codes
from ..session import settle
from ..sources.readers import Erp
from .bridge import POS, WEB

ERP_SYSTEM = CodeSystem("ERP", "sku_erp", ERP_CODE)
PAIR = ("tienda_id", "sku_erp")


def audit_identifiers(sales: DataFrame, orders: DataFrame, erp: Erp) -> dict[str, DataFrame]:
    """Codes of the three systems: uniqueness, coverage by the mappings, agreement of their numbers.

    The distinct codes of each fact are stored once; the reports on codes read those.
    """
    catalog = numbered(erp.products.select("sku_erp", "nombre", "categoria"), "sku_erp", ERP_CODE)
    pos = settle(observed_codes(sales, "sku", "sku_pos"), "audit-pos")
    web = settle(observed_codes(orders, "product_handle", "handle"), "audit-web")
    unmapped_pos = profile.missing_from(pos, "sku_pos", erp.mappings, "sku_pos").withColumnRenamed("value", "sku_pos")
    unmapped_web = profile.missing_from(web, "handle", erp.mappings, "handle").withColumnRenamed("value", "handle")
    reports = {
        "sale_ids": profile.id_uniqueness(sales, "venta_id"),
        "sale_stores": profile.id_uniqueness(sales, "tienda_id"),
        "sale_codes": profile.id_uniqueness(sales, "sku"),
        "order_ids": profile.id_uniqueness(orders, "order_id"),
        "order_codes": profile.id_uniqueness(orders, "product_handle"),
        "pos_mapping_overlap": profile.set_comparison(pos, "sku_pos", erp.mappings, "sku_pos"),
        "web_mapping_overlap": profile.set_comparison(web, "handle", erp.mappings, "handle"),
        "mapping_nulls": profile.null_counts(erp.mappings, ["sku_erp", "handle"]),
        "stores_compared": profile.set_comparison(sales, "tienda_id", erp.stores, "tienda_id"),
        "unmapped_pos": unmapped_pos,
        "unmapped_web": unmapped_web,
        "catalog_numbers": profile.catalog_uniqueness(catalog, "product_number"),
        "catalog_shared_numbers": profile.shared_numbers(catalog, "product_number"),
        "mapping_conflicts": profile.row_conflicts(erp.mappings, (POS, ERP_SYSTEM, WEB)),
    }
    rules = {"pos_erp": (POS, ERP_SYSTEM), "pos_web": (POS, WEB), "three_way": (POS, ERP_SYSTEM, WEB)}
    for name, systems in rules.items():
        reports[f"{name}_agreement"] = profile.rule_agreement(erp.mappings, systems)
        reports[f"{name}_mismatches"] = profile.rule_mismatches(erp.mappings, systems)
    for name, codes, column, pattern in (
        ("pos", pos, "sku_pos", POS_CODE), ("web", web, "handle", HANDLE_CODE), ("erp", catalog, "sku_erp", ERP_CODE)
    ):
        reports[f"{name}_unparseable"] = profile.unparseable(codes, column, pattern)
        reports[f"{name}_collisions"] = profile.collisions(numbered(codes, column, pattern, "number"), "number", column)
    for name, codes, column, pattern in (
        ("pos", unmapped_pos, "sku_pos", POS_CODE), ("web", unmapped_web, "handle", HANDLE_CODE)
    ):
        reports[f"{name}_candidate_counts"] = profile.candidate_counts(codes, column, pattern, catalog, "product_number")
        reports[f"{name}_candidates"] = profile.candidate_rows(codes, column, pattern, catalog, "product_number")
    return reports


def audit_snapshots(erp: Erp) -> dict[str, DataFrame]:
    """The daily stock panel: calendar, coverage of the pairs, unknown and zero readings; the feed is scanned once."""
    raw = erp.snapshots
    # the reports describe the feed as it is: what is no number is unknown, a fraction is a reading
    stock = raw.withColumn("stock", F.nullif(F.col("cantidad_en_stock").try_cast("double"), F.lit(float("nan"))))
    panel = read_panel(stock, PAIR, "fecha", F.col("stock"), F.col("cantidad_en_stock"))
    per_pair = panel.missing_per_pair()
    return {
        "sentinels": panel.sentinels(),
        "repeated_readings": panel.repeated(),
        "calendar": panel.calendar(),
        "missing_days": panel.missing_days(),
        "pair_coverage": panel.coverage(),
        "days_per_pair": panel.days_per_pair(),
        "rows_per_day": panel.rows_per_day(),
        "day_sizes": panel.day_sizes(),
        "unknown_spread": panel.spread("n_missing"),
        "zero_spread": panel.spread("n_zero"),
        "unknown_per_pair": profile.missing_summary(per_pair),
        "unknown_distribution": profile.distribution(per_pair, "n_missing", "n_pairs"),
        "most_unknown": profile.most_missing(per_pair, PAIR),
    }


def audit(
    sales: DataFrame,
    orders: DataFrame,
    erp: Erp,
    start: Day = "2025-10-01",
    end: Day = "2026-03-31",
) -> dict[str, DataFrame]:
    """All reports by name. Each is computed when it is read, except for the tables that several reports share.

    ``start`` and ``end`` bound the coverage reports.
    """
    catalog = numbered(erp.products.select("sku_erp"), "sku_erp", ERP_CODE)
    tables = {
        "sales": sales, "orders": orders, "stores": erp.stores, "mappings": erp.mappings,
        "products": erp.products, "snapshots": erp.snapshots,
    }
    ranges = profile.date_ranges(
        {"sales": (sales, "fecha_hora"), "orders": (orders, "fecha"), "snapshots": (erp.snapshots, "fecha")}
    )
    reports = {
        "row_counts": profile.row_counts(tables),
        "date_ranges": ranges,
        "common_range": profile.common_range(ranges),
        "sale_currencies": profile.value_counts(sales, "moneda"),
        "order_currencies": profile.value_counts(orders, "currency"),
    }
    for name, facts, when, code, pattern in (
        ("sales", sales, "fecha_hora", "sku", POS_CODE), ("orders", orders, "fecha", "product_handle", HANDLE_CODE)
    ):
        units = facts.withColumn("cantidad", F.col("cantidad").try_cast("double"))
        reports[f"{name}_coverage"] = profile.coverage_in_window(
            units, when, code, pattern, "cantidad", catalog, "product_number", start, end
        )
    return reports | audit_identifiers(sales, orders, erp) | audit_snapshots(erp)
