"""One query per operator group, on the sample tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from mostrador.functions import code_number, cost_total, lenient_integer, money_total, strict_integer, strict_number
from mostrador.operators import (
    asof_join, calendar, consecutive_days, convert_currency, dense, interval_join, matched_rows, matched_turnover,
    monthly_intervals, period_change, stock_by_pair, top_k,
)
from mostrador.operators import gates, profile, resolve
from mostrador.operators.panel import read_panel
from mostrador.operators.resolve import CodeSystem
from mostrador.plans import channel_growth, inventory_turnover, negative_margin, star, stockout_runs
from mostrador.plans.bridge import reconcile_orders
from mostrador.plans.metrics import currency_gates, sales_cells, several_costs
from mostrador.session import settle

from . import roles
from .roles import FIRST, LAST, Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Code formats of the sample tables.
ORDER_CODE = r"\ACU-([0-9]{9})\z"
WEB_CODE = r"-([0-9]{9})\n?\z"
CUSTOMER_NAME = r"\ACustomer#([0-9]{9})\z"
BRAND = r"\ABrand#([0-9]+)\z"
SIZE = r"\ASIZE_([0-9]+)\z"
SIZE_HANDLE = r"-([0-9]{3})\n?\z"
NATION_NAME = r"_([0-9]+)\n?\z"

ORDER_SYSTEM = CodeSystem("order", "sku_pos", ORDER_CODE)
WEB_SYSTEM = CodeSystem("web", "handle", WEB_CODE)
PART_POS = CodeSystem("brand", "sku_pos", BRAND)
PART_ERP = CodeSystem("size", "sku_erp", SIZE)
PART_WEB = CodeSystem("handle", "handle", SIZE_HANDLE)


def query(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    QUERIES[build.__name__] = lambda spark, folder: build(Tables(spark, folder))
    return build


# --- turnover --------------------------------------------------------------------------------


def _turnover_model(t: Tables) -> dict[str, DataFrame]:
    return {"fact_sales": roles.sales(t), "fact_inventory": roles.readings(t), "dim_product": roles.products(t)}


@query
def inventory_turnover_all(t):
    return inventory_turnover(_turnover_model(t), FIRST, LAST, limit=None)


@query
def inventory_turnover_top(t):
    return inventory_turnover(_turnover_model(t), FIRST, LAST, limit=10)


@query
def turnover_by_type(t):
    """The same operator on other keys: product type per supplier instead of part per supplier."""
    kinds = roles.products(t).select("product_id", "category")
    sold = roles.sales(t).where("channel = 'physical'").join(kinds, "product_id")
    stock = roles.readings(t).join(kinds, "product_id")
    return matched_turnover(sold, stock, product="category")


@query
def matched_population(t):
    pair = ["store_id", "product_id"]
    sold = roles.sales(t).where("channel = 'physical'").groupBy(*pair).agg(
        F.count(F.lit(1)).alias("n_sales"), F.sum("quantity").alias("units")
    )
    return matched_rows(sold, roles.readings(t), pair)


@query
def reading_coverage(t):
    pairs = stock_by_pair(roles.readings(t), ["store_id", "product_id"], "stock_quantity")
    totals = pairs.groupBy("product_id").agg(
        F.sum("observed_days").alias("observed_days"),
        F.sum("expected_days").alias("expected_days"),
        F.count_distinct("store_id").alias("store_count"),
    )
    share = F.round(F.lit(100.0) * F.col("observed_days") / F.col("expected_days"), 2)
    return totals.withColumn("coverage_pct", share)


@query
def top_customers(t):
    spent = t.orders.groupBy("o_custkey").agg(money_total("o_totalprice").cast("double").alias("spent"))
    return top_k(spent, "spent", ["o_custkey"], 10)


# --- runs ------------------------------------------------------------------------------------


@query
def zero_runs(t):
    zero = roles.panel(t).where("stock_quantity = 0")
    return consecutive_days(zero, ["store_id", "product_id"], "date", 4)


@query
def runs_enriched(t):
    return stockout_runs(roles.panel_model(t), "2024-01-01", "2024-12-31")


@query
def repeated_stock_days(t):
    """Pairs with several readings on one day, whatever the readings are."""
    return gates.duplicate_keys(roles.readings(t), ["store_id", "product_id", "date"])


@query
def order_day_runs(t):
    """Stretches of at least two consecutive days on which a customer ordered; several orders a day."""
    return consecutive_days(t.orders, ["o_custkey"], "o_orderdate", 2, on_duplicate="merge")


# --- channels and currency -------------------------------------------------------------------


@query
def channel_mom(t):
    return channel_growth(roles.fx_model(t), "1995-02-01", "2001-08-31", channels=("F", "O", "P"))


@query
def currency_normalize(t):
    sales = roles.fx_sales(t).withColumn("sale_date", F.to_date("sold_at"))
    return convert_currency(sales, roles.fx_rates(t)).select(
        "transaction_id", "currency", F.col("amount_mxn").cast("double").alias("amount_mxn")
    )


@query
def precise_rates(t):
    """Rates with twelve decimals, derived from the day; every sale converted with all of them."""
    sales = roles.fx_sales(t).withColumn("sale_date", F.to_date("sold_at")).where("currency <> 'MXN'")
    digits = F.dayofyear("rate_date").cast("bigint") * 712345678 + 1
    rates = roles.fx_rates(t).withColumn("rate_to_mxn", digits.cast("double") / F.lit(1e12))
    return convert_currency(sales, rates).select("transaction_id", F.col("amount_mxn").cast("double").alias("amount_mxn"))


@query
def sales_cell_totals(t):
    return sales_cells(roles.fx_sales(t)).withColumn("amount_native", F.col("amount_native").cast("double"))


@query
def month_grid(t):
    """Orders per priority and month, with the months in which a priority has none."""
    orders = t.orders.select("o_orderpriority", F.trunc("o_orderdate", "MM").alias("month"))
    sparse = orders.groupBy("o_orderpriority", "month").agg(F.count(F.lit(1)).alias("n_orders"))
    grid = calendar(sparse.select("o_orderpriority").distinct(), "month", "1994-11-01", "2001-12-01")
    return dense(sparse, grid, ["o_orderpriority", "month"])


@query
def currency_change(t):
    """Month-over-month change per currency on its dense series."""
    sales = roles.fx_sales(t).groupBy("currency", F.trunc("sold_at", "MM").alias("month")).agg(
        money_total("amount_native").cast("double").alias("amount")
    )
    grid = calendar(sales.select("currency").distinct(), "month", "1995-01-01", "2001-12-01")
    return period_change(dense(sales, grid, ["currency", "month"]), ["currency"], "month", "amount", "change_pct")


@query
def missing_rate_gate(t):
    model = roles.fx_model(t, weekdays_only=True)
    missing = currency_gates(sales_cells(model["fact_sales"]), model["fact_exchange_rate"])[0]
    return missing.violations


@query
def duplicate_rate_gate(t):
    """Days on which a priority class has more than one order, read as a rate table."""
    return gates.duplicate_keys(
        t.orders.select(F.to_date("o_orderdate").alias("rate_date"), F.col("o_orderpriority").alias("currency")),
        ["rate_date", "currency"],
    )


# --- effective-dated costs -------------------------------------------------------------------


def _asof(t: Tables, horizon: tuple[str, str] | None) -> DataFrame:
    sales = roles.ordered_sales(t).withColumn("sale_date", F.to_date("sold_at"))
    costed = asof_join(
        sales, roles.costs(t), ["product_id"], "sale_date", "effective_date", ["cost_mxn"], horizon
    )
    return _cost_totals(costed)


def _cost_totals(costed: DataFrame) -> DataFrame:
    return costed.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("n_sales"),
        F.count("cost_mxn").alias("n_costed"),
        money_total("cost_mxn").cast("double").alias("cost_sum"),
    )


@query
def asof_cost(t):
    return _asof(t, (FIRST, LAST))


@query
def asof_cost_stored(t):
    """The same from intervals that are stored by month."""
    keys, values = ["product_id"], ["cost_mxn"]
    intervals = settle(monthly_intervals(roles.costs(t), keys, "effective_date", values, (FIRST, LAST)), "intervals")
    sales = roles.ordered_sales(t).withColumn("sale_date", F.to_date("sold_at"))
    return _cost_totals(interval_join(sales, intervals, keys, "sale_date", values, (FIRST, LAST)))


@query
def asof_cost_open_horizon(t):
    return _asof(t, None)


@query
def negative_margin_pairs(t):
    return negative_margin(roles.margin_model(t), FIRST, LAST)


@query
def precise_costs(t):
    """Unit costs with twelve decimals, derived from the part; totals with all of them."""
    cost = (F.col("l_partkey").cast("bigint") * 1234567 + 7).cast("double") / F.lit(1e12)
    lines = t.lineitem.select("l_partkey", F.col("l_quantity").cast("bigint").alias("quantity"), cost.alias("cost"))
    return lines.groupBy("l_partkey").agg(cost_total(F.col("quantity"), F.col("cost")).cast("double").alias("cost"))


@query
def large_totals(t):
    """Amounts over 10^13 beside small ones with many decimals, of both signs; one group holds nulls alone."""
    price = F.col("l_extendedprice")

    def signed(factor):
        size = F.when(F.col("l_linestatus") == "O", price * factor).otherwise(price / 1024)
        return F.when(F.col("l_linenumber") < 7, F.when(F.col("l_returnflag") == "R", -size).otherwise(size))

    lines = t.lineitem.select(
        "l_linenumber", signed(1e8).alias("amount"), signed(1e5).alias("unit"), F.col("l_quantity").cast("bigint").alias("quantity")
    )
    return lines.groupBy("l_linenumber").agg(
        money_total("amount", written=True).alias("total"),
        cost_total(F.col("quantity"), F.col("unit"), written=True).alias("cost"),
    )


@query
def repeated_order_days(t):
    """Customers with several orders on one day."""
    days = t.orders.select("o_custkey", F.to_date("o_orderdate").alias("date"))
    return gates.duplicate_keys(days, ["o_custkey", "date"])


@query
def repeated_costs(t):
    """Parts with several returned lines on one day, read as cost entries."""
    entries = t.lineitem.where("l_returnflag = 'R'").select(
        F.col("l_partkey").alias("product_id"), F.to_date("l_shipdate").alias("effective_date")
    )
    return several_costs(entries).violations


@query
def missing_cost_gate(t):
    sales = roles.ordered_sales(t).withColumn("sale_date", F.to_date("sold_at"))
    costed = asof_join(
        sales, roles.costs(t, with_list_price=False), ["product_id"], "sale_date", "effective_date", ["cost_mxn"],
        (FIRST, LAST),
    )
    return gates.uncosted(costed, "cost_mxn", "product_id")


# --- codes -----------------------------------------------------------------------------------


@query
def code_extract(t):
    customers = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return customers.select(
        "c_custkey",
        code_number("c_name", CUSTOMER_NAME).alias("customer_number"),
        code_number("n_name", NATION_NAME).alias("nation_number"),
        code_number("c_mktsegment", BRAND).alias("no_number"),
    )


def _resolved(t: Tables, system: CodeSystem, facts: DataFrame, column: str) -> DataFrame:
    catalog = resolve.numbered(roles.code_catalog(t), "sku_erp", CUSTOMER_NAME)
    seen = resolve.observed_codes(facts, column, system.column)
    explicit = resolve.explicit_pairs(roles.code_mappings(t), system, "sku_erp")
    return resolve.resolve_codes(seen, explicit, catalog, system)


def _bridge(t: Tables) -> DataFrame:
    catalog = resolve.numbered(roles.code_catalog(t), "sku_erp", CUSTOMER_NAME)
    return resolve.assemble_bridge(
        catalog,
        [
            (_resolved(t, ORDER_SYSTEM, roles.code_orders(t), "sku"), "sku_pos", "sku_pos", "pos_mapping_method"),
            (
                _resolved(t, WEB_SYSTEM, roles.code_events(t), "product_handle"),
                "handle", "product_handle", "shopify_mapping_method",
            ),
        ],
    )


@query
def code_bridge(t):
    return _bridge(t)


@query
def code_methods(t):
    both = _resolved(t, ORDER_SYSTEM, roles.code_orders(t), "sku").select("sku_erp", "mapping_method")
    return both.groupBy("mapping_method").agg(F.count("sku_erp").alias("n_codes"))


@query
def product_dimension(t):
    return star.dim_product(_bridge(t))


@query
def reconcile_facts(t):
    bridge = _bridge(t)
    orders = resolve.attach_ids(roles.code_orders(t), bridge, "sku", "sku_pos", "order")
    return orders.groupBy("sku_erp").agg(
        F.count(F.lit(1)).alias("n_orders"), money_total("o_totalprice").cast("double").alias("amount")
    )


@query
def unreconciled_codes(t):
    """Web codes looked up among the order codes of indebted customers only: most are unknown."""
    known = roles.code_mappings(t).where("sku_pos IS NOT NULL").select(
        F.regexp_replace("sku_pos", "CU-", "web-").alias("code"), "sku_erp"
    )
    return resolve.unreconciled(roles.code_events(t), known, "product_handle", "code")


@query
def mapping_conflict_gate(t):
    return gates.conflicting_targets(t.part, "p_name", "p_brand")


@query
def unknown_target_gate(t):
    return gates.unknown_keys(t.customer, "c_custkey", t.events, "user_id")


@query
def contradiction_gate(t):
    return gates.contradictions(roles.part_codes(t), "sku_pos", BRAND, "sku_erp", SIZE)


@query
def duplicate_key_gate(t):
    return gates.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query
def shared_code_gate(t):
    """Several codes for one target: web codes that resolve to the nation of their customer."""
    resolved = _resolved(t, WEB_SYSTEM, roles.code_events(t), "product_handle")
    nations = resolved.join(roles.code_catalog(t), "sku_erp").select("handle", F.col("categoria").alias("target"))
    return gates.duplicate_keys(nations, ["target"])


@query
def shared_number_gate(t):
    """Sizes that several parts share; a part without a handle has no number."""
    numbered = resolve.numbered(roles.part_codes(t), "handle", SIZE_HANDLE)
    return gates.duplicate_numbers(numbered, "product_number")


@query
def unresolvable_gate(t):
    """Web codes that neither a mapping nor a number leads to a customer in debt."""
    catalog = resolve.numbered(roles.code_catalog(t).join(
        t.customer.where("c_acctbal < 0").select(F.col("c_name").alias("sku_erp")), "sku_erp", "left_semi"
    ), "sku_erp", CUSTOMER_NAME)
    seen = resolve.observed_codes(roles.code_events(t), "product_handle", "handle")
    explicit = resolve.explicit_pairs(roles.code_mappings(t), WEB_SYSTEM, "sku_erp")
    resolved = resolve.resolve_codes(seen, explicit, catalog, WEB_SYSTEM)
    return resolve.resolution_gates(resolved, WEB_SYSTEM, "sku_erp")[0].violations


@query
def join_cardinality_gate(t):
    """Codes that a bridge would repeat: the order code beside each of the customer's events."""
    bridge = _bridge(t).join(t.events.select(F.col("user_id"), "event_type"), F.col("product_number") == F.col("user_id"))
    return gates.duplicate_keys(bridge.where("sku_pos IS NOT NULL"), ["sku_pos"])


@query
def reconciled_orders(t):
    """Web rows with the customer that their code leads to."""
    rows = reconcile_orders(roles.code_events(t), _bridge(t), check=False)
    return rows.groupBy("sku_erp").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("event_type").alias("n_types"))


@query
def strict_numbers(t):
    """Quantities and prices as texts, read strictly."""
    lines = t.lineitem.select(
        "l_returnflag", F.col("l_quantity").cast("string").alias("units"), F.col("l_extendedprice").cast("string").alias("price"),
        F.concat(F.lit("9007199254"), F.lpad(F.col("l_orderkey").cast("string"), 8, "0")).alias("long"),
    )
    return lines.groupBy("l_returnflag").agg(
        F.sum(strict_integer(F.col("units"), "units")).alias("units"),
        F.max(strict_number(F.col("price"), "price")).alias("highest"),
        F.max(strict_integer(F.col("long"), "long")).alias("longest"),
    )


@query
def lenient_stock(t):
    """Texts that are no number are unknown, whole numbers keep all their digits."""
    text = F.when(F.col("l_linenumber") == 1, F.lit("N/A")).when(F.col("l_linenumber") == 2, F.lit("")).otherwise(
        F.concat(F.lit("90071992547"), F.lpad(F.col("l_partkey").cast("string"), 7, "0"))
    )
    lines = t.lineitem.select("l_linenumber", lenient_integer(text, "stock").alias("stock"))
    return lines.groupBy("l_linenumber").agg(F.count("stock").alias("n_known"), F.max("stock").alias("highest"))


# --- star schema -----------------------------------------------------------------------------


@query
def batch_from_files(t):
    """The sample tables as feeds in files, then the whole batch run: reading, codes, star schema, margin by store and product."""
    return negative_margin(roles.batch_model(t), FIRST, LAST)


@query
def unified_sales(t):
    lines = t.lineitem.where("l_returnflag = 'N'").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("venta_id"),
        F.col("l_shipdate").cast("string").alias("fecha_hora"),
        F.col("l_suppkey").alias("tienda_id"),
        F.lit("code").alias("sku"),
        F.col("l_quantity").cast("string").alias("cantidad"),
        F.col("l_extendedprice").cast("string").alias("monto"),
        F.lit("MXN").alias("moneda"),
        F.col("l_linestatus").alias("tipo_comprobante"),
        F.col("l_partkey").alias("sku_erp"),
    )
    purchases = t.events.where("event_type = 'purchase'").select(
        F.col("event_id").alias("order_id"),
        F.col("ts").alias("fecha"),
        F.lit("code").alias("product_handle"),
        F.lit(1).alias("cantidad"),
        F.col("value").alias("amount"),
        F.lit("USD").alias("currency"),
        F.col("user_id").alias("sku_erp"),
    )
    returned = t.lineitem.where("l_returnflag = 'R'").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("order_id"),
        F.col("l_shipdate").cast("string").alias("fecha"),
        F.lit("code").alias("product_handle"),
        F.col("l_quantity").cast("int").alias("cantidad"),
        F.col("l_extendedprice").alias("amount"),
        F.lit("EUR").alias("currency"),
        F.col("l_partkey").alias("sku_erp"),
    )
    purchases = purchases.withColumn("order_id", F.col("order_id").cast("string")).withColumn("fecha", F.col("fecha").cast("string"))
    return (
        star.fact_sales(lines, purchases.unionByName(returned))
        .groupBy("channel", "currency", "document_type")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count("store_id").alias("n_with_store"),
            F.sum("quantity").alias("units"),
            money_total("amount_native").cast("double").alias("amount"),
            F.min(F.to_date("sold_at")).alias("first_day"),
            F.max(F.to_date("sold_at")).alias("last_day"),
        )
    )


@query
def parse_stock(t):
    text = F.coalesce(F.col("stock_quantity").cast("string"), F.lit("N/A"))
    snapshots = roles.panel(t).select(
        F.col("date").cast("string").alias("fecha"),
        F.col("store_id").alias("tienda_id"),
        F.col("product_id").alias("sku_erp"),
        text.alias("cantidad_en_stock"),
    )
    return star.fact_inventory(snapshots).groupBy("product_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("stock_quantity").alias("n_known"),
        F.count_if(F.col("stock_quantity") == 0).cast("bigint").alias("n_zero"),
        F.sum("stock_quantity").alias("units"),
    )


@query
def nested_flatten(t):
    """Dated prices packed per part (at most one entry per day) and flattened to a cost table."""
    entry = F.struct(
        F.col("effective_date").cast("string").alias("fecha_vigencia"),
        F.col("price").cast("string").alias("costo_mxn"),
        F.col("supplier").cast("string").alias("proveedor"),
    )
    packed = roles.unit_prices(t).groupBy(F.col("product_id").alias("sku_erp")).agg(
        F.collect_list(entry).alias("cost_history")
    )
    return star.fact_product_cost(packed)


@query
def store_dimension(t):
    places = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    return star.dim_store(
        places.select(
            F.col("s_suppkey").alias("tienda_id"),
            F.col("n_name").alias("ciudad"),
            F.col("r_name").alias("region"),
            F.lit("UTC").alias("timezone"),
        )
    )


@query
def exchange_rate_table(t):
    rates = roles.fx_rates(t)
    return star.fact_exchange_rate(
        rates.select(
            F.col("rate_date").cast("string").alias("fecha"), "currency", F.col("rate_to_mxn").cast("string").alias("rate_to_mxn")
        )
    )


# --- profiling -------------------------------------------------------------------------------


@query
def source_row_counts(t):
    names = ("customer", "supplier", "part", "orders", "lineitem", "events")
    return profile.row_counts({n: getattr(t, n) for n in names})


def _ranges(t: Tables) -> DataFrame:
    # Every source but the events shares some days; three of them are compared.
    return profile.date_ranges(
        {
            "orders": (t.orders, "o_orderdate"),
            "shipments": (t.lineitem, "l_shipdate"),
            "stock": (roles.readings(t), "date"),
            "events": (t.events, "ts"),
        }
    )


@query
def source_date_ranges(t):
    return _ranges(t)


@query
def common_date_range(t):
    return profile.common_range(_ranges(t).where("source <> 'events'"))


@query
def id_uniqueness(t):
    columns = {"o_custkey": t.orders, "o_orderkey": t.orders, "l_orderkey": t.lineitem, "event_id": t.events}
    frames = [
        profile.id_uniqueness(df, name).select(F.lit(name).alias("id"), "n_distinct", "n_duplicates")
        for name, df in columns.items()
    ]
    return profile.union_all(frames)


@query
def duplicate_rows(t):
    return profile.duplicate_row_count(t.lineitem, ["l_orderkey", "l_linenumber"])


@query
def sentinel_share(t):
    stock = roles.panel(t).select(F.coalesce(F.col("stock_quantity").cast("string"), F.lit("N/A")).alias("stock"))
    return profile.sentinel_share(stock, "stock")


@query
def value_counts(t):
    return profile.value_counts(t.orders, "o_orderpriority")


@query
def null_counts(t):
    return profile.null_counts(roles.code_mappings(t), ["sku_pos", "sku_erp", "handle"])


def _parts_by_flag(t: Tables, flag: str) -> DataFrame:
    return t.lineitem.where(F.col("l_returnflag") == flag)


@query
def set_compare(t):
    return profile.set_comparison(_parts_by_flag(t, "A"), "l_partkey", _parts_by_flag(t, "N"), "l_partkey")


@query
def sets_that_differ(t):
    """Customers with orders and event users: neither holds the other."""
    return profile.set_comparison(t.orders, "o_custkey", t.events, "user_id")


@query
def set_difference(t):
    return profile.missing_from(t.customer, "c_custkey", t.events, "user_id")


@query
def unparseable_codes(t):
    codes = roles.part_codes(t).select("handle").distinct()
    return profile.unparseable(codes, "handle", SIZE_HANDLE)


@query
def rule_agreement(t):
    parts = roles.part_codes(t)
    checks = {"brand-size": (PART_POS, PART_ERP), "brand-handle": (PART_POS, PART_WEB),
              "three-way": (PART_POS, PART_ERP, PART_WEB)}
    return profile.union_all(
        [profile.rule_agreement(parts, systems).withColumn("rule", F.lit(n)) for n, systems in checks.items()]
    )


@query
def three_way_agreement(t):
    """Three codes from three columns, so that two of them may agree and the third not."""
    parts = t.part.select(
        F.col("p_brand").alias("sku_pos"),
        F.concat(F.lit("SIZE_"), (F.col("p_size") % 7 + 10 * (F.col("p_partkey") % 5)).cast("string")).alias("sku_erp"),
        F.concat(F.lit("h-"), F.lpad((F.col("p_partkey") % 50).cast("string"), 3, "0")).alias("handle"),
    )
    checks = {"pos-erp": (PART_POS, PART_ERP), "pos-web": (PART_POS, PART_WEB), "erp-web": (PART_ERP, PART_WEB),
              "three-way": (PART_POS, PART_ERP, PART_WEB)}
    return profile.union_all(
        [profile.rule_agreement(parts, systems).withColumn("rule", F.lit(n)) for n, systems in checks.items()]
    )


@query
def rule_mismatches(t):
    return profile.rule_mismatches(roles.part_codes(t), (PART_POS, PART_WEB))


@query
def row_conflicts(t):
    return profile.row_conflicts(roles.part_codes(t), (PART_POS, PART_ERP, PART_WEB))


@query
def code_collisions(t):
    return profile.collisions(t.part, "p_size", "p_name")


def _priced_orders(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", roles.cents("o_totalprice").alias("number"))


@query
def shared_numbers(t):
    return profile.shared_numbers(_priced_orders(t), "number")


@query
def catalog_uniqueness(t):
    return profile.catalog_uniqueness(_priced_orders(t), "number")


@query
def code_candidates(t):
    """Customers' codes against suppliers numbered by nation: none or several candidates each."""
    codes = roles.code_orders(t).select("sku").distinct()
    catalog = t.supplier.select("s_name", F.col("s_nationkey").cast("bigint").alias("number"))
    return profile.candidate_counts(codes, "sku", ORDER_CODE, catalog, "number")


@query
def candidate_rows(t):
    codes = roles.code_orders(t).select("sku").distinct()
    catalog = t.supplier.select("s_name", F.col("s_nationkey").cast("bigint").alias("number"))
    return profile.candidate_rows(codes, "sku", ORDER_CODE, catalog, "number")


@query
def coverage_in_window(t):
    """Lines against a catalog of parts and suppliers: a number that both use maps to neither."""
    lines = t.lineitem.withColumn("sku", roles.coded("CU-", "l_partkey"))
    catalog = t.part.select(F.col("p_partkey").alias("number")).unionAll(
        t.supplier.select(F.col("s_suppkey").alias("number"))
    )
    return profile.coverage_in_window(
        lines, "l_shipdate", "sku", ORDER_CODE, "l_quantity", catalog, "number", "1996-07-01", "2000-06-30"
    )


@query
def calendar_gaps(t):
    return profile.missing_days(t.orders, "o_orderdate")


@query
def calendar_summary(t):
    return profile.calendar_summary(t.orders, "o_orderdate")


PAIR = ("store_id", "product_id")


@query
def pair_coverage(t):
    return profile.pair_coverage(roles.readings(t), PAIR, "date")


@query
def pair_day_distribution(t):
    return profile.distribution(profile.days_per_pair(roles.readings(t), PAIR, "date"), "n_days", "n_pairs")


@query
def rows_per_day(t):
    return profile.rows_per_day_summary(roles.readings(t), "date")


@query
def day_row_distribution(t):
    return profile.distribution(profile.rows_per_day(roles.readings(t), "date"), "n_rows", "n_days")


@query
def missing_spread(t):
    return profile.spread(roles.panel(t), F.col("stock_quantity").isNull(), PAIR, "date")


@query
def zero_spread(t):
    return profile.spread(roles.panel(t), F.col("stock_quantity") == 0, PAIR, "date")


@query
def panel_spreads(t):
    """Unknown and zero readings from the panel's stored cells."""
    panel = read_panel(roles.panel(t), PAIR, "date", F.col("stock_quantity"))
    return profile.union_all(
        [panel.spread(m).withColumn("measure", F.lit(m)) for m in ("n_missing", "n_zero", "n_sentinel")]
    )


@query
def panel_coverage(t):
    panel = read_panel(roles.readings(t), PAIR, "date", F.col("stock_quantity"))
    return panel.coverage()


@query
def missing_by_pair(t):
    return profile.missing_per_pair(roles.readings(t), PAIR, "stock_quantity")


@query
def missing_summary(t):
    return profile.missing_summary(profile.missing_per_pair(roles.panel(t), PAIR, "stock_quantity"))


@query
def missing_distribution(t):
    per_pair = profile.missing_per_pair(roles.panel(t), PAIR, "stock_quantity")
    return profile.distribution(per_pair, "n_missing", "n_pairs")


@query
def most_missing(t):
    return profile.most_missing(profile.missing_per_pair(roles.panel(t), PAIR, "stock_quantity"), PAIR)
