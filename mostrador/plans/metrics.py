"""The four metrics over the star schema.

Each takes the model as a mapping of table name to DataFrame and returns a DataFrame. Windows,
channels and thresholds are parameters whose defaults are the reporting periods of the business.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions import cost_total, money_total, month_of, percent, within
from ..functions.dates import Day, as_date
from ..operators.asof import asof_join, interval_join
from ..operators.currency import convert_currency
from ..operators.gates import Gate, duplicate_keys, enforce, guarded, missing_rates, uncosted
from ..operators.runs import consecutive_days
from ..operators.series import calendar, dense, members, period_change
from ..operators.turnover import matched_turnover, top_k
from ..session import settle
from .star import ECOMMERCE, PHYSICAL

Model = Mapping[str, DataFrame]


def _physical(sales: DataFrame, start: Day, end: Day) -> DataFrame:
    return within(sales.where(F.col("channel") == PHYSICAL), "sold_at", start, end, "sale_month")


def inventory_turnover(
    model: Model, start: Day = "2025-10-01", end: Day = "2026-03-31", limit: int | None = 10
) -> DataFrame:
    """Products by units sold per average unit in stock, over (store, product) pairs with readings.

    Physical sales only: a web order names no store, so it has no place in a store-level
    denominator. Unknown stock does not enter an average, zero does. Products without an average
    are left out; an average of zero gives a NULL turnover. ``limit=None`` returns all products.
    """
    sales = _physical(model["fact_sales"], start, end)
    readings = within(model["fact_inventory"], "date", start, end, "stock_month")
    names = model["dim_product"].select("product_id", "product_name", "category")
    rows = matched_turnover(sales, readings).join(names, "product_id").select(
        F.col("product_id").alias("sku_erp"),
        "product_name",
        "category",
        "physical_units_sold",
        "average_inventory_units",
        "store_count",
        "inventory_coverage_pct",
        "inventory_turnover",
    )
    return top_k(rows, "inventory_turnover", ["sku_erp"], limit)


def stockout_runs(
    model: Model,
    start: Day = "2026-01-01",
    end: Day = "2026-03-31",
    min_days: int = 4,
    ordered: bool = True,
    on_duplicate: str = "fail",
) -> DataFrame:
    """Stretches of consecutive days with a confirmed stock of zero, per store and product.

    Unknown stock is not zero and ends a stretch, as does a day without a row. Stretches are
    clipped to the window. Two readings of one day, whatever they are, fail the job; with
    ``on_duplicate="merge"`` one zero among them makes the day a zero day.
    """
    readings = within(model["fact_inventory"], "date", start, end, "stock_month")
    events = consecutive_days(
        readings,
        ["store_id", "product_id"],
        "date",
        min_days,
        on_duplicate,
        ("stockout_start", "stockout_end", "stockout_days"),
        counts=F.col("stock_quantity") == 0,
    )
    stores = model["dim_store"].select("store_id", "city", "region")
    products = model["dim_product"].select("product_id", "product_name")
    rows = events.join(stores, "store_id", "left").join(products, "product_id", "left").select(
        "store_id", "city", "region", "product_id", "product_name", "stockout_start", "stockout_end", "stockout_days"
    )
    if not ordered:
        return rows
    return rows.orderBy(F.desc("stockout_days"), "store_id", "product_id", "stockout_start")


def sales_cells(sales: DataFrame) -> DataFrame:
    """Native totals per (channel, currency, day): at most one row per channel, currency and day."""
    return sales.groupBy("channel", "currency", F.to_date("sold_at").alias("sale_date")).agg(
        money_total("amount_native").alias("amount_native")
    )


def currency_gates(cells: DataFrame, rates: DataFrame, base: str = "MXN") -> list[Gate]:
    """Foreign sales need exactly one rate for their day; a sale needs a currency."""
    return [
        Gate(
            "Sales in a foreign currency without an exchange rate",
            missing_rates(cells, rates, base).select("currency", "sale_date"),
            ["sale_date", "currency"],
        ),
        Gate(
            "Several exchange rates for one day and currency",
            duplicate_keys(rates, ["rate_date", "currency"]),
            ["rate_date", "currency"],
        ),
        Gate(
            "Sales without a currency",
            cells.where(F.col("currency").isNull()).select("sale_date").distinct(),
        ),
    ]


def channel_growth(
    model: Model,
    start: Day = "2025-04-01",
    end: Day = "2026-03-31",
    channels: Sequence[str] = (PHYSICAL, ECOMMERCE),
    base: str = "MXN",
    check: bool = True,
    ordered: bool = True,
) -> DataFrame:
    """Monthly revenue per channel in the base currency, and its change from the month before.

    The month before ``start`` is read as the baseline and not shown. Every (month, channel) is
    present; an absent month is NULL and leaves the next month without a change. The facts are read
    once, into one total per channel, currency and day; gates and conversion work on those.
    """
    spark = model["fact_sales"].sparkSession
    first, last = as_date(start).replace(day=1), as_date(end)
    baseline = (first.replace(year=first.year - 1, month=12) if first.month == 1
                else first.replace(month=first.month - 1))
    rates = model["fact_exchange_rate"]
    sales = within(model["fact_sales"], "sold_at", baseline, last, "sale_month")
    cells = sales_cells(sales)
    if check:
        cells = settle(cells, "sales-cells")
        enforce(*currency_gates(cells, rates, base))
    wanted = cells.where(F.col("channel").isin(*channels))
    monthly = (
        convert_currency(wanted, rates, base=base)
        .groupBy("channel", month_of("sale_date").alias("month"))
        .agg(F.sum("amount_mxn").cast("double").alias("sales_mxn"))
    )
    grid = calendar(members(spark, "channel", channels), "month", baseline, last.replace(day=1))
    series = period_change(dense(monthly, grid, ["channel", "month"]), ["channel"], "month", "sales_mxn", "mom_pct")
    shown = series.where(F.col("month") >= F.lit(first)).select("month", "channel", "sales_mxn", "mom_pct")
    return shown.orderBy("month", "channel") if ordered else shown


def several_costs(history: DataFrame) -> Gate:
    """A product has at most one cost from a day on."""
    keys = ["product_id", "effective_date"]
    return Gate("Several costs for one product and effective date", duplicate_keys(history, keys), keys)


def costed_pairs(
    model: Model, start: Day, end: Day, store: bool = True, intervals: DataFrame | None = None
) -> DataFrame:
    """Revenue, cost and rows without a cost per (store, product), from stored ``intervals`` of costs where given."""
    sales = _physical(model["fact_sales"], start, end).select(
        "store_id", "product_id", F.to_date("sold_at").alias("sale_date"), "quantity", "amount_native"
    )
    keys, values, horizon = ["product_id"], ["cost_mxn"], (start, end)
    if intervals is not None:
        costed = interval_join(sales, intervals, keys, "sale_date", values, horizon)
    else:
        costs = model["fact_product_cost"]
        costed = asof_join(sales, costs, keys, "sale_date", "effective_date", values, horizon, store=store)
    return costed.groupBy("store_id", "product_id").agg(
        money_total("amount_native").alias("revenue"),
        cost_total(F.col("quantity"), F.col("cost_mxn")).alias("cost"),
        F.count_if(F.col("cost_mxn").isNull()).alias("n_uncosted"),
    )


def negative_margin(
    model: Model,
    start: Day = "2024-10-01",
    end: Day = "2026-03-31",
    check: bool = True,
    ordered: bool = True,
    intervals: DataFrame | None = None,
) -> DataFrame:
    """(Store, product) pairs whose physical sales cost more than they earned.

    A sale costs its quantity times the unit cost in force on its day. A sale without a cost is an
    error, and so are two costs of a product from one day: with ``check`` the pair totals are stored once,
    the gates read them and the costs and raise ``GateError``; without it the call runs no job, the job
    that reads the result fails on a missing cost, and costs are taken to be unique. Either way the facts
    are read once.

    ``intervals`` are the costs as stored with the model (``sources.read_intervals``), which reports share; the
    history is then not read at all, and its keys were checked when it was stored.
    """
    if check and intervals is None:
        enforce(several_costs(model["fact_product_cost"]))
    pairs = costed_pairs(model, start, end, store=check, intervals=intervals)
    if check:
        pairs = settle(pairs, "margin-pairs")
        broken = uncosted(pairs.withColumn("_cost", F.when(F.col("n_uncosted") == 0, F.lit(1))), "_cost", "product_id")
        enforce(Gate("Physical sales without an applicable cost, by product", broken))
    message = F.concat(F.lit("Physical sales without an applicable cost: "), F.col("product_id").cast("string"))
    cost = guarded(F.col("cost"), F.col("n_uncosted") == 0, message)
    margins = (
        pairs.withColumn("margin", F.col("revenue") - cost)
        .where(F.col("margin") < 0)
        .withColumn("margin_pct", percent(F.col("margin"), F.col("revenue")))
    )
    names = model["dim_product"].select("product_id", "product_name")
    rows = margins.join(names, "product_id", "left").select(
        "store_id",
        F.col("product_id").alias("sku_erp"),
        "product_name",
        F.col("revenue").cast("double").alias("revenue_mxn"),
        F.col("cost").cast("double").alias("cost_mxn"),
        F.col("margin").cast("double").alias("margin_mxn"),
        "margin_pct",
    )
    return rows.orderBy("margin_mxn", "store_id", "sku_erp") if ordered else rows
