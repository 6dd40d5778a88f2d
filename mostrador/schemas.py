"""Column names and types of the raw feeds and of the star schema."""

from __future__ import annotations

# Field names of the raw feeds. Text feeds are read as strings and parsed strictly
# when the star schema is built, so that a bad value is an error and not a silent NULL.
POS_SALES = (
    "venta_id STRING, fecha_hora STRING, tienda_id STRING, sku STRING, cantidad STRING, "
    "monto STRING, moneda STRING, tipo_comprobante STRING"
)
FX_RATES = "fecha STRING, currency STRING, rate_to_mxn STRING"

STORES = "tienda_id STRING, ciudad STRING, region STRING, timezone STRING"
MAPPINGS = "sku_pos STRING, sku_erp STRING, handle STRING"
COST_ENTRY = "fecha_vigencia: STRING, costo_mxn: STRING, proveedor: STRING"
PRODUCTS = (
    "sku_erp STRING, nombre STRING, categoria STRING, "
    f"cost_history ARRAY<STRUCT<{COST_ENTRY}>>"
)
SNAPSHOTS = "fecha STRING, tienda_id STRING, sku_erp STRING, cantidad_en_stock STRING"

# Section names of the ERP document and the path of each one in it.
ERP_SECTIONS = {
    "stores": ("tiendas_info", STORES),
    "mappings": ("sku_mappings", MAPPINGS),
    "products": ("catalogo.productos", PRODUCTS),
    "snapshots": ("snapshots", SNAPSHOTS),
}

# Texts that count as missing in the CSV feeds.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Star schema: the columns of each table.
MODEL = {
    "dim_product": (
        "product_id STRING, product_name STRING, category STRING, sku_pos STRING, product_handle STRING, "
        "product_number BIGINT, pos_mapping_method STRING, shopify_mapping_method STRING"
    ),
    "dim_store": "store_id STRING, city STRING, region STRING, timezone STRING",
    "fact_sales": (
        "transaction_id STRING, sold_at TIMESTAMP_NTZ, product_id STRING, channel STRING, store_id STRING, "
        "quantity BIGINT, amount_native DOUBLE, currency STRING, document_type STRING"
    ),
    "fact_inventory": "date DATE, store_id STRING, product_id STRING, stock_quantity BIGINT",
    "fact_product_cost": "product_id STRING, effective_date DATE, cost_mxn DOUBLE, supplier STRING",
    "fact_exchange_rate": "rate_date DATE, currency STRING, rate_to_mxn DOUBLE",
}

# Star schema: table -> columns that identify a row (empty: no key is enforced).
MODEL_KEYS = {
    "dim_product": ("product_id",),
    "dim_store": ("store_id",),
    "fact_sales": (),
    "fact_inventory": (),
    "fact_product_cost": ("product_id", "effective_date"),
    "fact_exchange_rate": ("rate_date", "currency"),
}

# Month partitions of the large facts: table -> (date column, partition column).
MONTH_PARTITIONS = {
    "fact_sales": ("sold_at", "sale_month"),
    "fact_inventory": ("date", "stock_month"),
}

# Bucketed layout of the large facts: the pair that turnover groups and joins on.
BUCKET_KEYS = ("store_id", "product_id")

# Costs as half-open intervals cut at months, stored beside the model: see operators.asof.monthly_intervals.
INTERVALS = "cost_intervals"
INTERVAL_SCHEMA = "product_id STRING, _from DATE, _until DATE, cost_mxn DOUBLE, valid_month DATE"
