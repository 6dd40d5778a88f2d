"""The four metrics on small hand-made models."""

import datetime as dt

import pytest

from conftest import day, records, sale
from mostrador.operators import GateError
from mostrador.plans import channel_growth, inventory_turnover, negative_margin, stockout_runs

# --- turnover --------------------------------------------------------------------------------

PRODUCTS = [("K-1", "kettle", "kitchen"), ("K-2", "lamp", "light")]


def stock(store, product, start, *values):
    first = day(start)
    return [(first + dt.timedelta(days=i), store, product, v) for i, v in enumerate(values)]


def turnover_rows(df):
    return {
        r["sku_erp"]: (
            r["physical_units_sold"], r["average_inventory_units"], r["store_count"],
            r["inventory_coverage_pct"], r["inventory_turnover"],
        )
        for r in df.collect()
    }


def two_stores(model, *more):
    """The kettle averages 6 in the north (of 9 and 3) and 1.5 in the south; the lamp 8 in the south only."""
    return model(
        dim_product=PRODUCTS,
        fact_inventory=stock("north", "K-1", "2025-12-01", 9, None, None, 3)
        + stock("south", "K-1", "2025-12-01", 1, 2, 0, 3)
        + stock("south", "K-2", "2026-01-20", 8, 8),
        fact_sales=[
            sale("a", "2025-12-24 18:30:00", "K-1", "north", 4, 61),
            sale("b", "2026-03-31 23:59:59", "K-1", "south", 11, 75),
            sale("c", "2026-02-01 00:00:00", "K-2", "south", 2, 12),
            *more,
        ],
    )


def test_turnover(model):
    result = inventory_turnover(two_stores(model))
    assert records(result, "sku_erp") == ["K-1", "K-2"]
    rows = turnover_rows(result)
    assert rows["K-1"] == (15, 7.5, 2, 75.0, 2.0)
    assert rows["K-2"] == (2, 8.0, 1, 100.0, 0.25)


@pytest.mark.parametrize(
    "other",
    [
        sale("w", "2026-01-02 08:00:00", "K-1", None, 37, 5, channel="ecommerce"),
        sale("x", "2026-01-02 08:00:00", "K-1", "pop-up", 37, 5),  # a store without readings
        sale("y", "2025-09-30 23:59:59", "K-1", "north", 37, 5),  # the evening before the window
        sale("z", "2026-04-01 00:00:00", "K-2", "south", 37, 5),  # the morning after it
    ],
)
def test_turnover_counts_sales_with_a_denominator_only(model, other):
    assert turnover_rows(inventory_turnover(two_stores(model, other))) == turnover_rows(
        inventory_turnover(two_stores(model))
    )


def test_turnover_pair_without_a_known_reading(model):
    """Its sales count, its average does not: three known days of the other store give the denominator."""
    m = model(
        dim_product=PRODUCTS,
        fact_inventory=stock("east", "K-2", "2026-02-10", None, None, None) + stock("west", "K-2", "2026-02-10", 7, 0, 2),
        fact_sales=[sale("a", "2026-02-11", "K-2", "east", 9, 1), sale("b", "2026-02-12", "K-2", "west", 6, 1)],
    )
    assert turnover_rows(inventory_turnover(m))["K-2"] == (15, 3.0, 2, 50.0, 5.0)


def test_turnover_adds_averages_without_rounding_them(model):
    """Thirds of many stores: the sum of 3000 averages of 1/3 is 1000, not 3000 times a rounded third."""
    m = model(
        dim_product=PRODUCTS,
        fact_inventory=[r for i in range(3000) for r in stock(f"s{i}", "K-1", "2026-01-01", 1, 0, 0)],
        fact_sales=[sale("a", "2026-01-02", "K-1", "s5", 500, 1)],
    )
    assert turnover_rows(inventory_turnover(m))["K-1"][1:2] == (1000.0,)


def test_turnover_zero_and_missing_averages(model):
    m = model(
        dim_product=[("P0", "zero", "c"), ("P1", "unknown", "c"), ("P2", "none", "c"), ("P3", "unsold", "c")],
        fact_inventory=stock("T", "P0", "2025-10-01", 0, 0)
        + stock("T", "P1", "2025-10-01", None)
        + stock("T", "P3", "2025-10-01", 4)
        + stock("T", "P9", "2025-10-01", 4),
        fact_sales=[sale("1", "2025-10-05", p, "T", 2, 1) for p in ("P0", "P1", "P2", "P9")],
    )
    rows = turnover_rows(inventory_turnover(m))
    assert set(rows) == {"P0", "P3"}
    assert rows["P0"][4] is None
    assert rows["P3"][0] == 0 and rows["P3"][4] == 0.0


def test_turnover_ties_and_limit(model):
    m = model(
        dim_product=[(p, p, "c") for p in ("P3", "P1", "P2", "P4")],
        fact_inventory=[r for p in ("P1", "P2", "P3", "P4") for r in stock("T", p, "2025-10-01", 2)],
        fact_sales=[sale(p, "2025-10-05", p, "T", 2, 1) for p in ("P1", "P2", "P3")],
    )
    assert records(inventory_turnover(m, limit=2), "sku_erp") == ["P1", "P2"]
    assert inventory_turnover(m, limit=None).count() == 4


# --- stockouts -------------------------------------------------------------------------------


def events(model, *values, start="2026-01-10", **options):
    m = model(
        dim_product=[("P", "name", "c")],
        dim_store=[("T", "city", "north", "UTC")],
        fact_inventory=stock("T", "P", start, *values),
    )
    return records(stockout_runs(m, **options), "stockout_start", "stockout_end", "stockout_days")


@pytest.mark.parametrize(
    "values, expected",
    [
        ((0, 0, 0, 5), []),
        ((0, 0, 0, 0, 5), [(day("2026-01-10"), day("2026-01-13"), 4)]),
        ((0, 0, None, 0, 0), []),
        ((0, 5, 0, 5, 0, 5), []),
        ((0, 0, 0, 0, None, 0, 0, 0, 0, 0), [
            (day("2026-01-15"), day("2026-01-19"), 5), (day("2026-01-10"), day("2026-01-13"), 4),
        ]),
    ],
)
def test_stockouts(model, values, expected):
    assert events(model, *values) == expected


def test_stockout_names_and_unknown_dimension(model):
    m = model(
        dim_store=[("T", "city", "north", "UTC")],
        fact_inventory=stock("T", "P", "2026-01-01", 0, 0, 0, 0, 5)
        + stock("T", "P", "2026-02-01", 0, 0, None, 0, 0),
    )
    (row,) = stockout_runs(m).collect()
    assert tuple(row) == ("T", "city", "north", "P", None, day("2026-01-01"), day("2026-01-04"), 4)


def test_stockout_is_clipped_to_the_window(model):
    assert events(model, *[0] * 7, start="2025-12-28") == []
    assert events(model, *[0] * 8, start="2025-12-28") == [(day("2026-01-01"), day("2026-01-04"), 4)]


def test_stockout_calendar_gap(model):
    m = model(
        fact_inventory=stock("T", "P", "2026-01-01", 0, 0, 0) + stock("T", "P", "2026-01-05", 0, 0, 0),
    )
    assert stockout_runs(m).count() == 0


def test_stockout_repeated_day(model):
    rows = stock("T", "P", "2026-01-01", 0, 0, 0, 0)
    m = model(fact_inventory=rows + rows[:1])
    with pytest.raises(Exception, match="more than one row for T / P / 2026-01-01"):
        stockout_runs(m).collect()
    assert records(stockout_runs(m, on_duplicate="merge"), "stockout_days") == [4]


@pytest.mark.parametrize("second", [5, None])
def test_stockout_repeated_day_with_another_reading(model, second):
    rows = stock("T", "P", "2026-01-01", 0, 0, 0, 0) + stock("T", "P", "2026-01-02", second)
    m = model(fact_inventory=rows)
    with pytest.raises(Exception, match="more than one row for T / P / 2026-01-02"):
        stockout_runs(m).collect()
    assert records(stockout_runs(m, on_duplicate="merge"), "stockout_days") == [4]


# --- channel growth --------------------------------------------------------------------------


def growth(m, **options):
    return {
        (r["month"].isoformat()[:7], r["channel"]): (r["sales_mxn"], r["mom_pct"])
        for r in channel_growth(m, **options).collect()
    }


def test_growth_shape_and_order(model):
    m = model(fact_sales=[
        sale("1", "2025-05-01", "P", "T", 1, 10),
        sale("2", "2025-05-01", "P", None, 1, 10, channel="ecommerce"),
    ])
    rows = records(channel_growth(m), "month", "channel")
    assert len(rows) == 24 and rows == sorted(rows)
    assert {r[0] for r in rows} == {dt.date(2025 + (i // 12), i % 12 + 1, 1) for i in range(3, 15)}


def test_growth_base_currency_passes(model):
    m = model(fact_sales=[
        sale("1", "2025-04-01", "P", "T", 1, 1000),
        sale("2", "2025-04-30 23:59:59", "P", "T", 1, 500),
        sale("3", "2025-04-02", "P", None, 1, 300, channel="ecommerce"),
        sale("4", "2025-04-03", "P", None, 1, 200, channel="ecommerce"),
    ])
    result = growth(m)
    assert result["2025-04", "physical"] == (1500.0, None)
    assert result["2025-04", "ecommerce"] == (500.0, None)


@pytest.mark.parametrize(
    "sales, rates, expected",
    [
        # two currencies on one day
        ([("2025-04-05", 30, "USD"), ("2025-04-05", 8, "EUR")],
         [("2025-04-05", "USD", 18.5), ("2025-04-05", "EUR", 21.25)], 725.0),
        # each day has its own rate, other currencies' rates do not matter
        ([("2025-04-01", 10, "USD"), ("2025-04-30", 10, "USD")],
         [("2025-04-01", "USD", 16.0), ("2025-04-30", "USD", 18.0), ("2025-04-01", "EUR", 5.0)], 340.0),
        # base currency beside foreign ones, with a rate that no sale needs
        ([("2025-04-02", 2, "EUR"), ("2025-04-03", 70, "MXN"), ("2025-04-04", 3, "USD")],
         [("2025-04-02", "EUR", 19.0), ("2025-04-04", "USD", 17.0), ("2025-04-03", "USD", 1e6)], 159.0),
        # all digits of a rate count, however small or large it is
        ([("2025-04-06", 1e9, "VND")], [("2025-04-06", "VND", 0.000712345678)], 712345.678),
        ([("2025-04-06", 2, "KWD")], [("2025-04-06", "KWD", 12345678.5)], 24691357.0),
    ],
)
def test_growth_conversion(model, sales, rates, expected):
    m = model(
        fact_sales=[
            sale(str(i), d, "P", None, 1, a, channel="ecommerce", currency=c) for i, (d, a, c) in enumerate(sales)
        ],
        fact_exchange_rate=rates,
    )
    assert growth(m)["2025-04", "ecommerce"][0] == expected


def months(model, channel, **amounts):
    return model(fact_sales=[
        sale(k, f"2025-{k[1:]}-15", "P", "T", 1, v, channel=channel) for k, v in amounts.items()
    ])


def test_growth_change(model):
    result = growth(months(model, "physical", m03=1000, m04=1500, m05=750))
    assert result["2025-04", "physical"] == (1500.0, 50.0)
    assert result["2025-05", "physical"] == (750.0, -50.0)
    assert ("2025-03", "physical") not in result


def test_growth_without_baseline_and_after_a_gap(model):
    result = growth(months(model, "ecommerce", m04=1000, m05=1500, m07=10, m08=20))
    assert result["2025-04", "ecommerce"] == (1000.0, None)
    assert result["2025-05", "ecommerce"] == (1500.0, 50.0)
    assert result["2025-06", "ecommerce"] == (None, None)
    assert result["2025-07", "ecommerce"] == (10.0, None)
    assert result["2025-08", "ecommerce"] == (20.0, 100.0)


def test_growth_after_a_zero_month(model):
    assert growth(months(model, "physical", m04=0, m05=5))["2025-05", "physical"] == (5.0, None)


@pytest.mark.parametrize("when, currency", [("2025-04-11", "USD"), ("2025-03-20", "EUR")])
def test_growth_missing_rate(model, when, currency):
    m = model(fact_sales=[sale("1", when, "P", None, 1, 10, channel="ecommerce", currency=currency)])
    with pytest.raises(GateError, match=f"{when} / {currency}"):
        channel_growth(m)


def test_growth_null_rate_is_missing_and_outside_the_window_is_not(model):
    m = model(
        fact_sales=[sale("1", "2025-04-11", "P", None, 1, 10, channel="ecommerce", currency="USD")],
        fact_exchange_rate=[("2025-04-11", "USD", None)],
    )
    with pytest.raises(ValueError, match="without an exchange rate"):
        channel_growth(m)
    m = model(fact_sales=[sale("1", "2025-02-28", "P", None, 1, 10, channel="ecommerce", currency="USD")])
    assert channel_growth(m).count() == 24


def test_growth_duplicate_rate(model):
    m = model(
        fact_sales=[sale("1", "2025-04-11", "P", "T", 1, 10)],
        fact_exchange_rate=[("2020-01-01", "USD", 17.0), ("2020-01-01", "USD", 18.0)],
    )
    with pytest.raises(GateError, match="Several exchange rates"):
        channel_growth(m)


def test_growth_null_currency(model):
    m = model(fact_sales=[sale("1", "2025-04-11", "P", "T", 1, 10, currency=None)])
    with pytest.raises(GateError, match="without a currency"):
        channel_growth(m)


def test_growth_many_missing_rates_are_previewed(model):
    m = model(fact_sales=[
        sale(str(i), f"2025-04-{i + 1:02d}", "P", None, 1, 10, channel="ecommerce", currency="USD") for i in range(25)
    ])
    with pytest.raises(GateError, match="more than 10 found") as error:
        channel_growth(m)
    assert "2025-04-10" in str(error.value) and "2025-04-11" not in str(error.value)


# --- margin ----------------------------------------------------------------------------------


def margins(m, **options):
    return {
        (r["store_id"], r["sku_erp"]): (r["revenue_mxn"], r["cost_mxn"], r["margin_mxn"])
        for r in negative_margin(m, **options).collect()
    }


@pytest.mark.parametrize("check", [True])
def test_margin_repeated_cost(model, check):
    m = margin_model(model, [("2025-03-01", "P", "T", 1, 5)], [("P", "2025-01-01", 10.0), ("P", "2025-01-01", 20.0)])
    with pytest.raises(GateError, match="Several costs for one product .*P / 2025-01-01"):
        negative_margin(m, check=check)


def margin_model(model, sales, costs):
    return model(
        dim_product=[("P", "name", "c")],
        fact_sales=[sale(str(i), d, p, s, q, a) for i, (d, p, s, q, a) in enumerate(sales)],
        fact_product_cost=[(p, d, c, "s") for p, d, c in costs],
    )


OLD = [("P", "2024-01-01", 10.0)]


@pytest.mark.parametrize(
    "sales, costs, expected",
    [
        ([("2025-02-03", "P", "T", 4, 31)], [("P", "2025-02-03", 8.25)], (31.0, 33.0, -2.0)),
        ([("2025-02-03", "P", "T", 10_000_000, 3)], [("P", "2025-02-03", 0.0000014)], (3.0, 14.0, -11.0)),
        ([("2025-06-15 12:00:00", "P", "T", 1, 5)], [("P", "2024-01-01", 100.0), ("P", "2025-01-01", 50.0)],
         (5.0, 50.0, -45.0)),
        ([("2025-01-10", "P", "T", 1, 5)], [("P", "2024-01-01", 20.0), ("P", "2026-01-01", 999.0)],
         (5.0, 20.0, -15.0)),
        ([("2025-01-10 08:00:00", "P", "T", 1, 5)], [("P", "2024-01-01", 20.0), ("P", "2025-01-10", 30.0)],
         (5.0, 30.0, -25.0)),
        ([("2025-01-10", "P", "T", 7, 10)], [("P", "2024-01-01", 3.0)], (10.0, 21.0, -11.0)),
        ([("2025-01-10", "P", "T", 1, 100)], OLD, None),
        ([("2025-01-10", "P", "T", 1, 12), ("2025-01-11", "P", "T", 5, 10)], OLD, (22.0, 60.0, -38.0)),
        ([("2024-09-30", "P", "T", 1, 0), ("2026-04-01", "P", "T", 1, 0), ("2025-01-01", "P", "T", 1, 5)], OLD,
         (5.0, 10.0, -5.0)),
        ([("2024-10-01", "P", "T", 1, 5), ("2026-03-31 23:59:59", "P", "T", 1, 5)], OLD, (10.0, 20.0, -10.0)),
    ],
)
def test_margin(model, sales, costs, expected):
    result = margins(margin_model(model, sales, costs))
    assert result == ({("T", "P"): expected} if expected else {})


def test_margin_by_pair_and_order(model):
    m = margin_model(
        model,
        [("2025-01-01", "P", "T001", 10, 5), ("2025-01-01", "P", "T002", 1, 500), ("2025-01-01", "P", "T003", 20, 5)],
        OLD,
    )
    rows = negative_margin(m).collect()
    assert [(r["store_id"], r["margin_mxn"], r["product_name"]) for r in rows] == [
        ("T003", -195.0, "name"), ("T001", -95.0, "name"),
    ]
    assert rows[1]["margin_pct"] == -1900.0


def test_margin_counts_every_document_type_and_no_web_order(model):
    m = model(
        fact_sales=[sale(d, "2025-01-01", "P", "T", 1, 1, document=d) for d in "IEPNT"]
        + [sale("x", "2025-01-01", "Q", None, 1, 0, channel="ecommerce")],
        fact_product_cost=[("P", "2024-01-01", 10.0, "s")],
    )
    assert margins(m) == {("T", "P"): (5.0, 50.0, -45.0)}


def test_margin_repeated_transaction_id_and_zero_revenue(model):
    m = model(
        fact_sales=[sale("same", "2025-01-01", p, "T", 1, 0) for p in ("P", "Q", "Q")],
        fact_product_cost=[("P", "2024-01-01", 10.0, "s"), ("Q", "2024-01-01", 20.0, "s")],
    )
    assert margins(m) == {("T", "P"): (0.0, 10.0, -10.0), ("T", "Q"): (0.0, 40.0, -40.0)}
    assert set(records(negative_margin(m), "margin_pct")) == {None}


@pytest.mark.parametrize(
    "costs", [[], [("P", "2025-01-01", 1.0)], [("P", "2024-01-01", 1.0), ("P", "2024-10-15", None)]]
)
def test_margin_without_cost(model, costs):
    m = margin_model(model, [("2024-11-01", "P", "T", 1, 5), ("2024-11-02", "P", "T", 1, 5)], costs)
    with pytest.raises(GateError, match="without an applicable cost.*P"):
        negative_margin(m)
    with pytest.raises(Exception, match="without an applicable cost: P"):
        negative_margin(m, check=False).collect()


def test_margin_total_is_exact(model):
    m = margin_model(model, [("2025-01-01", "P", "T", 1, 0.1)] * 10, [("P", "2024-01-01", 0.2)])
    assert margins(m) == {("T", "P"): (1.0, 2.0, -1.0)}


def test_metrics_on_an_empty_model(model):
    m = model()
    assert inventory_turnover(m).count() == 0
    assert stockout_runs(m).count() == 0
    assert negative_margin(m).count() == 0
    assert growth(m)["2025-04", "physical"] == (None, None)
