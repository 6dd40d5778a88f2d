"""The sample tables in the roles of the retail model.

The sample data has no stores, stock or exchange rates, so its tables stand in for them:

* readings   lineitem with return flag A: supplier = store, part = product, quantity = stock;
             line number 7 stands for an unknown reading
* sales      lineitem with return flag N (physical) or R (web shop)
* panel      events: each (user, event type) that occurs, on each day of the events; the reading is
             the number of events, unknown on days on which the user had an error
* costs      dated unit prices of returned lines, with the list price as the first entry
* fx sales   orders by status, in the currency of the customer's region
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from mostrador.operators.series import calendar
from mostrador.plans import run_batch
from mostrador.session import settle, shared_folder

FIRST, LAST = "1995-01-01", "2001-12-31"  # all orders and shipments of the sample lie in here


class Tables:
    """Lazy sample tables by attribute. The schema of a file is looked up once per process."""

    _schemas: dict[str, T.StructType] = {}

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        path = f"{self._folder}/{name}.parquet"
        if path not in self._schemas:
            self._schemas[path] = self._spark.read.parquet(path).schema
        table = self._spark.read.schema(self._schemas[path]).parquet(path)
        setattr(self, name, table)
        return table


def cents(amount: str) -> Column:
    return F.rint(F.col(amount) * 100).cast("bigint")


def coded(prefix: str, key: str) -> Column:
    return F.concat(F.lit(prefix), F.lpad(F.col(key).cast("string"), 9, "0"))


def readings(t: Tables) -> DataFrame:
    stock = F.when(F.col("l_linenumber") != 7, F.col("l_quantity").cast("bigint"))
    return t.lineitem.where("l_returnflag = 'A'").select(
        F.to_date("l_shipdate").alias("date"),
        F.col("l_suppkey").alias("store_id"),
        F.col("l_partkey").alias("product_id"),
        stock.alias("stock_quantity"),
    )


def sales(t: Tables) -> DataFrame:
    physical = F.col("l_returnflag") == "N"
    return t.lineitem.where("l_returnflag <> 'A'").select(
        F.col("l_shipdate").alias("sold_at"),
        F.col("l_partkey").alias("product_id"),
        F.when(physical, F.lit("physical")).otherwise(F.lit("ecommerce")).alias("channel"),
        F.when(physical, F.col("l_suppkey")).alias("store_id"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.col("l_extendedprice").alias("amount_native"),
    )


def products(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"), F.col("p_type").alias("category")
    )


def panel(t: Tables) -> DataFrame:
    counts = t.events.groupBy("user_id", "event_type", F.to_date("ts").alias("date")).agg(
        F.count(F.lit(1)).alias("n")
    )
    days = t.events.agg(F.min(F.to_date("ts")).alias("lo"), F.max(F.to_date("ts")).alias("hi"))
    pairs = counts.where("event_type <> 'error'").select("user_id", "event_type").distinct()
    grid = calendar(pairs, "date", days.select("lo").scalar(), days.select("hi").scalar(), "day")
    failed = counts.where("event_type = 'error'").select("user_id", "date", F.lit(True).alias("failed"))
    stock = F.when(F.col("failed").isNull(), F.coalesce("n", F.lit(0)))
    return (
        grid.join(counts, ["user_id", "event_type", "date"], "left")
        .join(failed, ["user_id", "date"], "left")
        .select(
            "date",
            F.col("user_id").alias("store_id"),
            F.col("event_type").alias("product_id"),
            stock.cast("bigint").alias("stock_quantity"),
        )
    )


def panel_model(t: Tables) -> dict[str, DataFrame]:
    """The panel with dimensions that know the BUILDING customers and every event type."""
    customers = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).where(
        "c_mktsegment = 'BUILDING'"
    )
    return {
        "fact_inventory": panel(t),
        "dim_store": customers.select(
            F.col("c_custkey").alias("store_id"), F.col("c_name").alias("city"), F.col("n_name").alias("region")
        ),
        "dim_product": t.events.select(F.col("event_type").alias("product_id")).distinct().withColumn(
            "product_name", F.upper("product_id")
        ),
    }


def unit_prices(t: Tables) -> DataFrame:
    """Lowest unit price in cents per part and day of its returned lines, with a supplier."""
    price = F.expr("cast(rint(l_extendedprice * 100) as bigint) div cast(l_quantity as bigint)")
    return (
        t.lineitem.where("l_returnflag = 'R'")
        .groupBy(F.col("l_partkey").alias("product_id"), F.to_date("l_shipdate").alias("effective_date"))
        .agg(F.min(price).alias("price"), F.min("l_suppkey").alias("supplier"))
    )


def costs(t: Tables, with_list_price: bool = True) -> DataFrame:
    dated = unit_prices(t).select("product_id", "effective_date", "price")
    if with_list_price:
        dated = dated.unionByName(
            t.part.select(
                F.col("p_partkey").alias("product_id"),
                F.lit("1994-12-31").cast("date").alias("effective_date"),
                cents("p_retailprice").alias("price"),
            )
        )
    return dated.select("product_id", "effective_date", (F.col("price") / F.lit(100.0)).alias("cost_mxn"))


def ordered_sales(t: Tables) -> DataFrame:
    """Physical lines on the day of their order."""
    lines = t.lineitem.where("l_returnflag = 'N'")
    return lines.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_orderdate").alias("sold_at"),
        F.col("l_partkey").alias("product_id"),
        F.lit("physical").alias("channel"),
        F.col("l_suppkey").alias("store_id"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.col("l_extendedprice").alias("amount_native"),
    )


def margin_model(t: Tables, with_list_price: bool = True) -> dict[str, DataFrame]:
    return {
        "fact_sales": ordered_sales(t),
        "fact_product_cost": costs(t, with_list_price),
        "dim_product": products(t),
    }


def fx_sales(t: Tables) -> DataFrame:
    currency = (
        F.when(F.col("r_name") == "AMERICA", "USD").when(F.col("r_name") == "EUROPE", "EUR").otherwise("MXN")
    )
    customers = (
        t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", currency.alias("currency"))
    )
    return t.orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_orderdate").alias("sold_at"),
        F.col("o_orderstatus").alias("channel"),
        "currency",
        F.col("o_totalprice").alias("amount_native"),
    )


def fx_rates(t: Tables, weekdays_only: bool = False) -> DataFrame:
    """A rate for USD and EUR on each day with orders, derived from the date."""
    days = t.orders.select(F.to_date("o_orderdate").alias("rate_date")).distinct()
    if weekdays_only:
        days = days.where(F.weekday("rate_date") < 5)
    rates = days.select("rate_date", F.explode(F.array(F.lit("USD"), F.lit("EUR"))).alias("currency"))
    base = F.when(F.col("currency") == "USD", F.lit(17)).otherwise(F.lit(20)).cast("decimal(9,3)")
    rate = base + F.dayofyear("rate_date") * F.lit(0.001).cast("decimal(4,3)")
    return rates.withColumn("rate_to_mxn", rate.cast("double"))


def fx_model(t: Tables, weekdays_only: bool = False) -> dict[str, DataFrame]:
    return {"fact_sales": fx_sales(t), "fact_exchange_rate": fx_rates(t, weekdays_only)}


# Codes: the order system knows a customer as CU-<9 digits>, the web site as web-<9 digits>. Customers
# in debt have an explicit order code, BUILDING customers an explicit web code.

def code_catalog(t: Tables) -> DataFrame:
    return t.customer.select(
        F.col("c_name").alias("sku_erp"), F.col("c_mktsegment").alias("nombre"), F.col("c_nationkey").alias("categoria")
    )


def code_mappings(t: Tables) -> DataFrame:
    return t.customer.select(
        F.when(F.col("c_acctbal") < 0, coded("CU-", "c_custkey")).alias("sku_pos"),
        F.col("c_name").alias("sku_erp"),
        F.when(F.col("c_mktsegment") == "BUILDING", coded("web-", "c_custkey")).alias("handle"),
    )


def code_orders(t: Tables) -> DataFrame:
    return t.orders.withColumn("sku", coded("CU-", "o_custkey"))


def code_events(t: Tables) -> DataFrame:
    return t.events.withColumn("product_handle", coded("web-", "user_id"))


def part_codes(t: Tables) -> DataFrame:
    """Parts as mapping rows: brand number, size number, and a handle that PROMO parts lack."""
    handle = F.concat(F.lower("p_type"), F.lit("-"), F.lpad(F.col("p_size").cast("string"), 3, "0"))
    return t.part.select(
        F.col("p_brand").alias("sku_pos"),
        F.concat(F.lit("SIZE_"), F.col("p_size").cast("string")).alias("sku_erp"),
        F.when(F.col("p_type") != "PROMO", handle).alias("handle"),
        "p_partkey",
    )


# Files: the tables as the feeds that the batch run reads. Parts are products, suppliers stores; every third part is sold by
# the web shop as well. Codes hold a number of three digits; parts beyond that, and every seventh, have explicit codes.

def _explicit(part: str) -> Column:
    return (F.col(part) % 7 == 0) | (F.col(part) > 999)


def _erp_code(part: str) -> Column:
    numbered = F.concat(F.lit("ERP-PROV-MX-"), F.lpad(F.col(part).cast("string"), 3, "0"), F.lit("-X"))
    return F.when(F.col(part) > 999, F.concat(F.lit("part {"), F.col(part))).otherwise(numbered)


def _pos_code(part: str) -> Column:
    numbered = F.concat(F.lit("CN-"), F.lpad(F.col(part).cast("string"), 5, "0"))
    return F.when(_explicit(part), F.concat(F.lit("till {"), F.col(part))).otherwise(numbered)


def _handle(part: str) -> Column:
    numbered = F.concat(F.lit("thing-"), F.lpad(F.col(part).cast("string"), 3, "0"))
    return F.when(_explicit(part), F.concat(F.lit('a "b" '), F.col(part))).otherwise(numbered)


def _erp_lines(t: Tables) -> DataFrame:
    """The ERP document, line by line: (place, line)."""
    product = _erp_code("p_partkey")
    dated = costs(t).groupBy("product_id").agg(
        F.sort_array(
            F.collect_list(
                F.struct(
                    F.col("effective_date").cast("string").alias("fecha_vigencia"),
                    F.col("cost_mxn").alias("costo_mxn"),
                    F.lit("any").alias("proveedor"),
                )
            )
        ).alias("cost_history")
    )
    parts = t.part.select("p_partkey", product.alias("sku_erp"), F.col("p_name").alias("nombre"), F.col("p_type").alias("categoria"))
    readings_ = readings(t).select(
        F.col("date").cast("string").alias("fecha"),
        F.col("store_id").cast("string").alias("tienda_id"),
        _erp_code("product_id").alias("sku_erp"),
        F.coalesce(F.col("stock_quantity").cast("string"), F.lit("N/A")).alias("cantidad_en_stock"),
    )
    sections = [
        ('{"tiendas_info": [', t.supplier.select(
            F.col("s_suppkey").cast("string").alias("tienda_id"), F.col("s_name").alias("ciudad"),
            F.col("s_nationkey").cast("string").alias("region"), F.lit("UTC").alias("timezone"))),
        ('], "sku_mappings": [', t.part.where(_explicit("p_partkey")).select(
            _pos_code("p_partkey").alias("sku_pos"), product.alias("sku_erp"),
            F.when(F.col("p_partkey") % 3 == 0, _handle("p_partkey")).alias("handle"))),
        ('], "catalogo": {"version": 2, "productos": [', parts.join(
            dated, F.col("p_partkey") == F.col("product_id")).select("sku_erp", "nombre", "categoria", "cost_history")),
        (']}, "snapshots": [', readings_),
    ]
    lines = []
    for k, (head, rows) in enumerate(sections):
        options = {"ignoreNullFields": "false"}
        lines.append(rows.select(F.lit(2 * k + 1).alias("place"), F.to_json(F.struct("*"), options).alias("line")))
        lines.append(t._spark.range(1).select(F.lit(2 * k).alias("place"), F.lit(head).alias("line")))
    lines.append(t._spark.range(1).select(F.lit(2 * len(sections)).alias("place"), F.lit("]}").alias("line")))
    whole = lines[0]
    for more in lines[1:]:
        whole = whole.unionByName(more)
    return whole


#: Bytes, about, of a part of the ERP document, which one task writes.
PART = 64 << 20


def _write_document(lines: DataFrame, path: str) -> None:
    """The lines (place, line) as one JSON document in their order, in parts that follow each other by their names."""
    lines = settle(lines.withColumn("id", F.monotonically_increasing_id()), "document")
    size = lines.agg(F.sum(F.octet_length("line"))).first()[0]
    firsts = [
        row.id
        for (place,) in lines.where("place % 2 = 1").select("place").distinct().collect()
        for row in lines.where(F.col("place") == place).orderBy("line", "id").limit(1).collect()
    ]
    comma = F.when((F.col("place") % 2 == 1) & ~F.col("id").isin(firsts), F.lit(", ")).otherwise(F.lit(""))
    order = ["place", "line", "id"]
    parts = lines.repartitionByRange(size // PART + 1, *order).sortWithinPartitions(*order)
    parts.select(F.concat(comma, "line").alias("line")).write.text(path)


def batch_model(t: Tables) -> dict[str, DataFrame]:
    """The stored star schema of a batch run over files made of the tables."""
    root = f"{shared_folder(t._spark).rstrip('/')}/mostrador/feeds-{uuid.uuid4().hex}"
    orders = ordered_sales(t)
    orders.select(
        F.monotonically_increasing_id().alias("venta_id"),
        F.col("sold_at").cast("string").alias("fecha_hora"),
        F.col("store_id").alias("tienda_id"),
        _pos_code("product_id").alias("sku"),
        F.col("quantity").alias("cantidad"),
        F.col("amount_native").alias("monto"),
        F.lit("MXN").alias("moneda"),
        F.lit("I").alias("tipo_comprobante"),
    ).write.option("header", True).option("escape", '"').csv(f"{root}/sales")
    web = orders.where("product_id % 3 = 0")
    web.select(
        F.monotonically_increasing_id().cast("string").alias("order_id"),
        F.col("sold_at").cast("string").alias("fecha"),
        _handle("product_id").alias("product_handle"),
        F.col("quantity").alias("cantidad"),
        F.col("amount_native").alias("amount"),
        F.lit("USD").alias("currency"),
    ).write.parquet(f"{root}/orders")
    rates = fx_rates(t).select(F.col("rate_date").cast("string").alias("fecha"), "currency", "rate_to_mxn")
    rates.write.option("header", True).csv(f"{root}/rates")
    _write_document(_erp_lines(t), f"{root}/inventory")
    return run_batch(t._spark, f"{root}/sales", f"{root}/orders", f"{root}/inventory", f"{root}/rates", f"{root}/model")
