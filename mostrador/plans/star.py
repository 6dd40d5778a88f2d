"""The six tables of the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import lenient_integer, strict_cast, strict_integer, strict_number
from ..operators.gates import Gate, duplicate_keys, enforce, require_columns
from ..schemas import MODEL_KEYS
from ..sources.readers import Erp
from .bridge import COLUMNS as BRIDGE_COLUMNS

PHYSICAL, ECOMMERCE = "physical", "ecommerce"


def _stamp(column: str) -> Column:
    return strict_cast(F.col(column), "timestamp_ntz", column)


def _is_text(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.StringType)


def _number(df: DataFrame, column: str) -> Column:
    return strict_number(F.col(column), column, _is_text(df, column))


def _integer(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType
    if isinstance(kind, T.IntegralType):
        return F.col(column).cast("bigint")
    return strict_integer(F.col(column), column, _is_text(df, column))


def dim_product(bridge: DataFrame) -> DataFrame:
    require_columns(bridge, BRIDGE_COLUMNS, "product bridge")
    renamed = {"sku_erp": "product_id", "nombre": "product_name", "categoria": "category"}
    return bridge.select(*[F.col(c).alias(renamed.get(c, c)) for c in BRIDGE_COLUMNS])


def dim_store(stores: DataFrame) -> DataFrame:
    require_columns(stores, ("tienda_id", "ciudad", "region", "timezone"), "tiendas_info")
    return stores.select(
        F.col("tienda_id").alias("store_id"), F.col("ciudad").alias("city"), "region", "timezone"
    )


def fact_sales(sales: DataFrame, orders: DataFrame) -> DataFrame:
    """Both channels in one table, amounts in native currency; web orders have no store."""
    require_columns(
        sales,
        ("venta_id", "fecha_hora", "tienda_id", "sku", "cantidad", "monto", "moneda", "tipo_comprobante", "sku_erp"),
        "reconciled sales",
    )
    require_columns(
        orders,
        ("order_id", "fecha", "product_handle", "cantidad", "amount", "currency", "sku_erp"),
        "reconciled orders",
    )

    def unified(df, ident, when, channel, store, amount, currency, document):
        return df.select(
            F.col(ident).cast("string").alias("transaction_id"),
            _stamp(when).alias("sold_at"),
            F.col("sku_erp").alias("product_id"),
            F.lit(channel).alias("channel"),
            store.cast("string").alias("store_id"),
            _integer(df, "cantidad").alias("quantity"),
            _number(df, amount).alias("amount_native"),
            F.col(currency).alias("currency"),
            document.cast("string").alias("document_type"),
        )

    nothing = F.lit(None)
    physical = unified(
        sales, "venta_id", "fecha_hora", PHYSICAL, F.col("tienda_id"), "monto", "moneda", F.col("tipo_comprobante")
    )
    online = unified(orders, "order_id", "fecha", ECOMMERCE, nothing, "amount", "currency", nothing)
    return physical.unionByName(online)


def fact_inventory(snapshots: DataFrame) -> DataFrame:
    """Daily panel; zero is a reading, anything that is not a number is unknown (NULL)."""
    require_columns(snapshots, ("fecha", "tienda_id", "sku_erp", "cantidad_en_stock"), "inventory snapshots")
    stock = "cantidad_en_stock"
    return snapshots.select(
        F.to_date(_stamp("fecha")).alias("date"),
        F.col("tienda_id").alias("store_id"),
        F.col("sku_erp").alias("product_id"),
        lenient_integer(F.col(stock), stock, _is_text(snapshots, stock)).alias("stock_quantity"),
    )


def fact_product_cost(products: DataFrame) -> DataFrame:
    """Cost history, one row per product and effective date; an empty history gives no row."""
    require_columns(products, ("sku_erp", "cost_history"), "catalogo.productos")
    entries = products.select(F.col("sku_erp").alias("product_id"), F.explode("cost_history").alias("e"))
    flat = entries.select("product_id", "e.*")
    return flat.select(
        "product_id",
        F.to_date(_stamp("fecha_vigencia")).alias("effective_date"),
        _number(flat, "costo_mxn").alias("cost_mxn"),
        F.col("proveedor").alias("supplier"),
    )


def fact_exchange_rate(rates: DataFrame) -> DataFrame:
    """Daily rates as delivered, neither averaged nor interpolated."""
    require_columns(rates, ("fecha", "currency", "rate_to_mxn"), "exchange rates")
    return rates.select(
        F.to_date(_stamp("fecha")).alias("rate_date"),
        "currency",
        _number(rates, "rate_to_mxn").alias("rate_to_mxn"),
    )


def model_gates(model: dict[str, DataFrame]) -> list[Gate]:
    """Unique keys of the dimensions, the cost history and the rates."""
    return [
        Gate(f"{name} has several rows for one ({', '.join(keys)})", duplicate_keys(model[name], keys), list(keys))
        for name, keys in MODEL_KEYS.items()
        if keys and name in model
    ]


def history_gate(products: DataFrame) -> Gate:
    """Products that lack a cost history altogether (an empty one is allowed)."""
    absent = products.where(F.col("cost_history").isNull()).select("sku_erp")
    return Gate("Products without a cost_history", absent)


def build_model(
    sales: DataFrame, orders: DataFrame, erp: Erp, bridge: DataFrame, rates: DataFrame, check: bool = True
) -> dict[str, DataFrame]:
    """All six tables. The key gates run here as one job; the facts stay lazy."""
    model = {
        "dim_product": dim_product(bridge),
        "dim_store": dim_store(erp.stores),
        "fact_sales": fact_sales(sales, orders),
        "fact_inventory": fact_inventory(erp.snapshots),
        "fact_product_cost": fact_product_cost(erp.products),
        "fact_exchange_rate": fact_exchange_rate(rates),
    }
    if check:
        enforce(history_gate(erp.products), *model_gates(model))
    return model
