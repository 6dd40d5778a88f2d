"""Star schema builders, feeds and the batch run."""

import datetime as dt
import json
import random
from dataclasses import replace
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from checks import roles
from conftest import day, records, sale, stamp
from mostrador.functions import lenient_integer, money_total, strict_integer
from mostrador.operators import (
    GateError, RowRule, Watch, asof_join, interval_join, monthly_intervals, stock_by_pair,
)
from mostrador.plans import (
    audit, build_model, channel_growth, inventory_turnover, negative_margin, run_batch, star, stockout_runs,
)
from mostrador.plans.metrics import costed_pairs
from mostrador.schemas import ERP_SECTIONS, MAPPINGS, MODEL_KEYS, PRODUCTS, SNAPSHOTS, STORES
from mostrador.session import intermediate
from mostrador.sources import (
    Erp, land_document, land_erp, read_erp, read_intervals, read_model, read_pos, read_sources, split_document, write_model,
)
from mostrador.sources.documents import Splitter

RECONCILED_SALES = (
    "venta_id STRING, fecha_hora STRING, tienda_id STRING, sku STRING, cantidad STRING, monto STRING, "
    "moneda STRING, tipo_comprobante STRING, sku_erp STRING"
)
RECONCILED_ORDERS = (
    "order_id STRING, fecha STRING, product_handle STRING, cantidad BIGINT, amount DOUBLE, currency STRING, "
    "sku_erp STRING"
)
SKU = "ERP-PROV-MX-030-C"
POS_ROW = ("till-19-4", "2026-02-17 08:05:09", "T014", "CN-00030", "3", "47.25", "MXN", "I", SKU)
ORDER_ROW = ("web-4471", "2026-02-16 23:59:00", "tetera-azul-030", 6, 88.5, "EUR", SKU)


def test_fact_sales(frame):
    df = star.fact_sales(frame(RECONCILED_SALES, POS_ROW), frame(RECONCILED_ORDERS, ORDER_ROW))
    assert [tuple(r) for r in df.orderBy("channel").collect()] == [
        ("web-4471", stamp("2026-02-16 23:59:00"), SKU, "ecommerce", None, 6, 88.5, "EUR", None),
        ("till-19-4", stamp("2026-02-17 08:05:09"), SKU, "physical", "T014", 3, 47.25, "MXN", "I"),
    ]
    assert dict(df.dtypes)["sold_at"] == "timestamp_ntz" and dict(df.dtypes)["quantity"] == "bigint"


@pytest.mark.parametrize(
    "position, value, message",
    [
        (1, "not a date", "fecha_hora: cannot read 'not a date'"),
        (4, "2.5", "cantidad: cannot read '2.5' as a whole number"),
        (4, "two", "cantidad: cannot read 'two'"),
        (4, "5d", "cantidad: cannot read '5d'"),
        (5, "12,50", "monto: cannot read '12,50'"),
    ],
)
def test_strict_parsing(frame, spark, position, value, message):
    row = list(POS_ROW)
    row[position] = value
    df = star.fact_sales(frame(RECONCILED_SALES, tuple(row)), frame(RECONCILED_ORDERS))
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            with pytest.raises(Exception, match=message):
                df.select("*").collect()
        finally:
            spark.conf.set("spark.sql.ansi.enabled", "true")


def test_nulls_pass_strict_parsing(frame):
    row = ("V", None, None, None, None, None, None, None, SKU)
    (got,) = star.fact_sales(frame(RECONCILED_SALES, row), frame(RECONCILED_ORDERS)).collect()
    assert tuple(got) == ("V", None, SKU, "physical", None, None, None, None, None)


def test_stock_zero_is_known_and_text_is_not(frame):
    texts = ["0", "N/A", "5", "", "NaN", " 7 ", "3.0", None]
    rows = [(f"2026-01-{i + 1:02d}", "T", SKU, t) for i, t in enumerate(texts)]
    df = star.fact_inventory(frame(SNAPSHOTS, *rows)).orderBy("date")
    assert records(df, "stock_quantity") == [0, None, 5, None, None, 7, 3, None]
    assert dict(df.dtypes) == {
        "date": "date", "store_id": "string", "product_id": "string", "stock_quantity": "bigint",
    }


@pytest.mark.parametrize("text", ["3.5", "inf", "1e300"])
def test_fractional_stock_fails(frame, text):
    with pytest.raises(Exception, match="as a whole number"):
        star.fact_inventory(frame(SNAPSHOTS, ("2026-01-01", "T", SKU, text))).collect()


def test_cost_history_is_flattened(frame):
    products = frame(
        PRODUCTS,
        ("A", "a", "c", [("2025-02-01", "120.0", "s2"), ("2025-01-01", "100.0", "s1")]),
        ("B", "b", "c", []),
    )
    df = star.fact_product_cost(products).orderBy("effective_date")
    assert [tuple(r) for r in df.collect()] == [
        ("A", day("2025-01-01"), 100.0, "s1"), ("A", day("2025-02-01"), 120.0, "s2"),
    ]


def test_rates_are_kept(frame):
    rates = frame(
        "fecha STRING, currency STRING, rate_to_mxn DOUBLE", ("2025-01-01", "USD", 17.5), ("2025-01-01", "EUR", 20.3)
    )
    df = star.fact_exchange_rate(rates)
    assert df.count() == 2 and dict(df.dtypes)["rate_date"] == "date"


def whole(frame, **changes):
    tables = dict(
        stores=frame(STORES, ("T001", "city", "north", "UTC")),
        mappings=frame(MAPPINGS),
        products=frame(PRODUCTS, (SKU, "n", "c", [("2025-01-01", "1.0", "s")])),
        snapshots=frame(SNAPSHOTS),
    )
    rates = changes.pop("rates", frame("fecha STRING, currency STRING, rate_to_mxn DOUBLE"))
    bridge = changes.pop("bridge", frame(
        "sku_erp STRING, nombre STRING, categoria STRING, sku_pos STRING, product_handle STRING, "
        "product_number BIGINT, pos_mapping_method STRING, shopify_mapping_method STRING",
        (SKU, "n", "c", None, None, 30, "not_observed", "not_observed"),
    ))
    tables.update(changes)
    return build_model(frame(RECONCILED_SALES), frame(RECONCILED_ORDERS), Erp(**tables), bridge, rates)


def test_build_model(frame):
    model = whole(frame)
    assert list(model) == list(MODEL_KEYS)
    assert model["dim_product"].columns[:3] == ["product_id", "product_name", "category"]
    assert model["dim_store"].columns == ["store_id", "city", "region", "timezone"]


def test_model_gates(frame):
    rate = ("2025-01-01", "USD", 17.0)
    with pytest.raises(GateError, match="fact_exchange_rate has several rows"):
        whole(frame, rates=frame("fecha STRING, currency STRING, rate_to_mxn DOUBLE", rate, rate))
    with pytest.raises(GateError, match="dim_store has several rows"):
        whole(frame, stores=frame(STORES, ("T", "a", "b", "c"), ("T", "d", "e", "f")))
    twice = [("2025-01-01", "1", "s"), ("2025-01-01", "2", "s")]
    with pytest.raises(GateError, match="fact_product_cost has several rows"):
        whole(frame, products=frame(PRODUCTS, (SKU, "n", "c", twice)))
    with pytest.raises(GateError, match="without a cost_history"):
        whole(frame, products=frame(PRODUCTS, (SKU, "n", "c", None)))
    with pytest.raises(GateError, match=r"tiendas_info is missing required columns: \['region', 'timezone'\]"):
        whole(frame, stores=frame("tienda_id STRING, ciudad STRING"))


# --- files -----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def feeds(tmp_path_factory):
    root = tmp_path_factory.mktemp("feeds")
    (root / "sales.csv").write_text(
        "venta_id,fecha_hora,tienda_id,sku,cantidad,monto,moneda,tipo_comprobante,extra\n"
        "V1,2025-10-02 09:00:00,T001,CN-00030,4,8.0,MXN,I,x\n"
        "V2,2025-11-02 09:00:00,T001,CN-00030,2,100.0,MXN,E,NA\n"
        "V3,2026-01-02 09:00:00,T002,SPECIAL,1,3.5,MXN,,x\n"
    )
    pd.DataFrame({
        "order_id": ["S1", "S2"],
        "fecha": ["2025-10-03 10:00:00", "2025-11-03 10:00:00"],
        "product_handle": ["tetera-030", "tetera-030"],
        "cantidad": [1, 2],
        "amount": [10.0, 20.0],
        "currency": ["USD", "MXN"],
    }).to_parquet(root / "orders.parquet")
    (root / "rates.csv").write_text("fecha,currency,rate_to_mxn\n2025-10-03,USD,18.25\n")
    snapshots = [
        {"fecha": f"2026-01-{d:02d}", "tienda_id": "T001", "sku_erp": SKU, "cantidad_en_stock": v}
        for d, v in enumerate([0, 0, 0, 0, "N/A", 6, 2], 1)
    ]
    products = [
        {"sku_erp": SKU, "nombre": "Molinillo ñ", "categoria": "m", "unit": "kg", "cost_history": [
            {"fecha_vigencia": "2024-01-01", "costo_mxn": 5, "proveedor": "p1"},
            {"fecha_vigencia": "2025-11-01", "costo_mxn": 7.5, "proveedor": "p2"},
        ]},
        {"sku_erp": "ERP-PROV-MX-031-D", "nombre": "Otro", "categoria": "m", "cost_history": [
            {"fecha_vigencia": "2024-01-01", "costo_mxn": 1.0, "proveedor": "p1"},
        ]},
    ]
    document = {
        "tiendas_info": [
            {"tienda_id": t, "ciudad": "C", "region": "R", "timezone": "America/Mexico_City"} for t in ("T001", "T002")
        ],
        "sku_mappings": [
            {"sku_pos": "SPECIAL", "sku_erp": "ERP-PROV-MX-031-D", "handle": None},
            {"sku_pos": None, "sku_erp": SKU, "handle": "tetera-030"},
        ],
        "catalogo": {"version": 3, "productos": products},
        "snapshots": snapshots,
    }
    (root / "inventory.json").write_text(json.dumps(document, indent=1, ensure_ascii=False), encoding="utf-8")
    return {
        "sales": str(root / "sales.csv"),
        "ecommerce": str(root / "orders.parquet"),
        "inventory": str(root / "inventory.json"),
        "exchange_rates": str(root / "rates.csv"),
    }


def test_sources(spark, feeds):
    sources = read_sources(spark, **feeds)
    assert list(sources) == ["sales", "ecommerce", "inventory", "exchange_rates"]
    assert "extra" not in sources["sales"].columns
    assert records(sources["sales"].orderBy("venta_id"), "tipo_comprobante") == ["I", "E", None]
    erp = sources["inventory"]
    assert records(erp.snapshots.orderBy("fecha"), "cantidad_en_stock") == ["0", "0", "0", "0", "N/A", "6", "2"]
    assert erp.products.count() == 2 and erp.stores.count() == 2 and erp.mappings.count() == 2


def test_missing_source(spark, feeds):
    with pytest.raises(Exception, match="PATH_NOT_FOUND.*nowhere.csv"):
        read_pos(spark, feeds["sales"].replace("sales.csv", "nowhere.csv"))


def test_broken_document(spark, tmp_path):
    (tmp_path / "bad.json").write_text('{"snapshots": [')
    with pytest.raises(Exception, match="(?i)malformed"):
        read_erp(spark, str(tmp_path / "bad.json")).snapshots.collect()


def test_landed_layouts(spark, feeds, tmp_path):
    erp = read_erp(spark, feeds["inventory"])
    land_erp(erp, str(tmp_path / "landed"))
    for name in ("stores", "mappings", "products", "snapshots"):
        getattr(erp, name).write.json(str(tmp_path / "lines" / name))
    for layout, root in (("parquet", "landed"), ("lines", "lines")):
        again = read_erp(spark, str(tmp_path / root), layout)
        for name in ("stores", "mappings", "products", "snapshots"):
            assert sorted(map(str, getattr(again, name).collect())) == sorted(map(str, getattr(erp, name).collect()))
    with pytest.raises(ValueError, match="unknown layout"):
        read_erp(spark, str(tmp_path), "xml")


def made_document(seed):
    rng = random.Random(seed)
    texts = ["", "{", "}{", "[", '"', "\\", "\\\"{", "a\nb", "\u2028é", "tiendas_info", "snapshots", "x" * 50]

    def value(depth):
        kind = rng.randrange(6 if depth else 4)
        if kind == 4:
            return [value(depth - 1) for _ in range(rng.randrange(3))]
        if kind == 5:
            return {rng.choice(texts): value(depth - 1) for _ in range(rng.randrange(3))}
        return (rng.choice(texts), rng.randrange(-9, 9) / 4, None, True)[kind]

    def rows():
        return [{"k": value(3), **{rng.choice(texts): value(2) for _ in range(3)}} for _ in range(rng.randrange(6))]

    inner = {"x": value(2), "rows": rows(), "more": [{"rows": rows()}], "tiendas_info": rows()}
    parts = [("noise", value(3)), ("tiendas_info", rows()), ("catalogo", inner), ("snapshots", rows()), ("{", rows()), ("rows", rows())]
    rng.shuffle(parts)
    return dict(parts)


@pytest.mark.parametrize("seed", range(8))
def test_documents_are_split(spark, tmp_path, seed):
    document = made_document(seed)
    text = json.dumps(document, indent=[None, 2][seed % 2], ensure_ascii=seed % 3 == 0)
    (tmp_path / "d.json").write_text(text, encoding="utf-8")
    sections = {"a": "tiendas_info", "b": "catalogo.rows", "c": "snapshots", "d": "catalogo.absent"}
    expected = {"a": document["tiendas_info"], "b": document["catalogo"]["rows"], "c": document["snapshots"]}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "37")  # every record crosses splits
    try:
        rows = split_document(spark, str(tmp_path / "d.json"), sections).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    found = {}
    for row in rows:
        assert "\n" not in row.value
        found.setdefault(row.section, []).extend([json.loads(row.value)] if row.value else [])
    assert found == expected


def test_documents_are_split_by_many_tasks(spark, tmp_path):
    """A document in one file, in parts and two documents in a folder; no task reads more than a chunk."""
    rows = [{"k": i, "t": ['part {7', 'a "b" \\', "]"][i % 3], "more": [{"x": [i]}] * (i % 4)} for i in range(3000)]
    rows[1700]["t"] = '{ \\\\" ' * 3000  # longer than a chunk
    lines = [json.dumps({"noise": [{"snapshots": [{"k": -1}]}]})[:-1] + ', "snapshots": [', *[json.dumps(r) + "," for r in rows[:-1]], json.dumps(rows[-1]), "]}"]
    (tmp_path / "one.json").write_text("\n".join(lines))
    (tmp_path / "parts").mkdir()
    (tmp_path / "two").mkdir()
    for i in range(0, len(lines), 100):
        (tmp_path / "parts" / f"part-{i:05d}").write_text("\n".join(lines[i : i + 100]) + "\n")
    for name in "ab":
        (tmp_path / "two" / name).write_text("\n".join(lines))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        for name, times in (("one.json", 1), ("parts", 1), ("two", 2)):
            found = split_document(spark, str(tmp_path / name), {"s": "snapshots"})
            values = [r.value for r in found.collect()]
            assert values.count("") == times
            records = sorted((json.loads(v) for v in values if v), key=lambda r: r["k"])
            assert records == [r for r in rows for _ in range(times)]
            assert found.rdd.getNumPartitions() > 20
        (tmp_path / "parts" / f"part-{100:05d}").unlink()
        assert len(split_document(spark, str(tmp_path / "parts"), {"s": "snapshots"}).collect()) == 2901
        (tmp_path / "parts" / f"part-{3000:05d}").unlink()
        with pytest.raises(ValueError, match="it ends too early"):
            split_document(spark, str(tmp_path / "parts"), {"s": "snapshots"})
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_documents_are_written_in_parts(spark, frame, tmp_path, monkeypatch):
    """Equal lines stay, and the parts together are one valid document."""
    monkeypatch.setattr(roles, "PART", 100)
    rows = ['{"a": %d}' % (i // 2) for i in range(60)]
    roles._write_document(frame("place INT, line STRING", (0, '{"x": ['), *[(1, r) for r in rows], (2, '], "y": ['), (4, "]}")), str(tmp_path / "d"))
    files = sorted((tmp_path / "d").glob("part-*"))
    found = json.loads("".join(f.read_text() for f in files))
    assert len(files) > 3 and found["y"] == [] and sorted(r["a"] for r in found["x"]) == [i // 2 for i in range(60)]


def test_split_documents_hold_one_record():
    record = '{"k": [{"x": 1}, "{"]}'
    splitter, most, n = Splitter({"a": "a"}), 0, 0
    pieces = ('{"noise": [' + "{}, " * 5000 + '1], "a": [' + ", ".join([record] * 5000) + ', null, 3], "b": 2}').split("{")
    for i, piece in enumerate(pieces):
        n += sum(1 for _, value in splitter.feed(piece if i == 0 else "{" + piece) if value == record)
        most = max(most, sum(map(len, splitter.record or [])))
    splitter.finish()
    assert n == 5000 and most <= 2 * len(record)


@pytest.mark.parametrize("text", ["", "[", '{"snapshots": [', '{"snapshots": [{"a": 1}', '{"a": 1}}', '{"a": [1}', '{"a": "x}'])
def test_broken_documents_are_not_landed(spark, tmp_path, text):
    (tmp_path / "bad.json").write_text(text)
    with pytest.raises(Exception, match="malformed JSON document|has no section"):
        land_document(spark, str(tmp_path / "bad.json"), str(tmp_path / "out"))


def test_landed_document(spark, feeds, tmp_path):
    erp, landed = read_erp(spark, feeds["inventory"]), land_document(spark, feeds["inventory"], str(tmp_path / "out"))
    for name in ERP_SECTIONS:
        assert sorted(map(str, getattr(landed, name).collect())) == sorted(map(str, getattr(erp, name).collect()))
        assert getattr(landed, name).schema == getattr(erp, name).schema


@pytest.fixture(scope="module")
def stored(spark, feeds, tmp_path_factory):
    """Root of the stored model, written twice: the second run replaces the tables."""
    root = str(tmp_path_factory.mktemp("model"))
    run_batch(spark, **feeds, root=root)
    run_batch(spark, **feeds, root=root)
    return root


def test_batch_run_and_metrics(spark, stored):
    model = read_model(spark, stored)
    assert {n: df.count() for n, df in model.items()} == {
        "dim_product": 2, "dim_store": 2, "fact_sales": 5, "fact_inventory": 7,
        "fact_product_cost": 3, "fact_exchange_rate": 1,
    }
    (run,) = stockout_runs(model).collect()
    assert (run["store_id"], run["city"], run["product_name"], run["stockout_days"]) == ("T001", "C", "Molinillo ñ", 4)
    (row,) = inventory_turnover(model).collect()
    assert (row["physical_units_sold"], row["average_inventory_units"]) == (6, 8 / 6)
    growth = {(str(r["month"]), r["channel"]): r["sales_mxn"] for r in channel_growth(model).collect()}
    assert growth["2025-10-01", "ecommerce"] == 182.5 and growth["2025-11-01", "physical"] == 100.0
    (margin,) = negative_margin(model, start="2025-10-01", end="2025-10-31").collect()
    assert (margin["revenue_mxn"], margin["cost_mxn"], margin["margin_mxn"]) == (8.0, 20.0, -12.0)


def test_stored_facts_are_pruned_by_month(spark, stored):
    plan = stockout_runs(read_model(spark, stored))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(stock_month" in plan
    assert "GreaterThanOrEqual(date" in plan.split("PushedFilters: ")[1]


def test_audit(spark, feeds):
    sources = read_sources(spark, **feeds)
    reports = {
        name: [tuple(r) for r in df.collect()]
        for name, df in audit(sources["sales"], sources["ecommerce"], sources["inventory"]).items()
    }
    assert dict(reports["row_counts"]) == {
        "sales": 3, "orders": 2, "stores": 2, "mappings": 2, "products": 2, "snapshots": 7
    }
    assert reports["common_range"] == [(day("2026-01-01"), day("2025-11-03"))]  # the feeds do not overlap
    assert sorted(reports["order_currencies"]) == [("MXN", 1), ("USD", 1)]
    assert reports["sale_codes"] == [(2, 1)] and reports["order_codes"] == [(1, 1)]
    assert reports["unmapped_pos"] == [("CN-00030",)] and reports["unmapped_web"] == []
    assert reports["pos_candidate_counts"] == [("CN-00030", 30, 1)]
    assert reports["pos_unparseable"] == [(2, 1)] and reports["pos_erp_agreement"] == [(1, 0, 1)]
    assert reports["stores_compared"] == [(2, 2, 2, 0, 0, True)]
    assert reports["sales_coverage"] == [(3, 2, 1, 7, 6, 1)] and reports["orders_coverage"] == [(2, 2, 0, 3, 3, 0)]
    assert reports["sentinels"] == [(7, 1, 14.2857)] and reports["repeated_readings"] == [(0,)]
    assert reports["calendar"] == [(day("2026-01-01"), day("2026-01-07"), 7, 7, 0)]
    assert reports["unknown_spread"] == [(1, 1, 1, 1, 1)] and reports["zero_spread"] == [(4, 1, 1, 1, 4)]
    assert len(reports) == 50


def test_audit_of_odd_numbers(spark, feeds, frame):
    """Reports describe what is there: fractions and texts do not stop them."""
    sources = read_sources(spark, **feeds)
    columns = "venta_id STRING, fecha_hora STRING, tienda_id STRING, sku STRING, cantidad STRING, moneda STRING"
    sales = frame(
        columns,
        ("1", "2025-10-02", "T001", "CN-00030", "3.0", "MXN"),
        ("2", "2025-10-03", "T001", "CN-00030", "3.7", "MXN"),
        ("3", "2025-10-04", "T001", "CN-00030", "many", "MXN"),
    )
    snapshots = frame(SNAPSHOTS, *[(f"2026-01-0{i + 1}", "T001", SKU, t) for i, t in enumerate(["2.5", "0", "x", "0.0"])])
    erp = replace(sources["inventory"], snapshots=snapshots)
    reports = {n: [tuple(r) for r in df.collect()] for n, df in audit(sales, sources["ecommerce"], erp).items()}
    assert reports["sales_coverage"][0][3] == pytest.approx(6.7)
    assert reports["zero_spread"][0][0] == 2 and reports["unknown_spread"][0][0] == 1


def _edited(feeds, tmp_path, change):
    with open(feeds["inventory"], encoding="utf-8") as f:
        document = json.load(f)
    change(document)
    (tmp_path / "inventory.json").write_text(json.dumps(document))
    return str(tmp_path / "inventory.json")


PATHS = [path for path, _ in ERP_SECTIONS.values()]


def _records(document, path):
    for step in path.split("."):
        document = document[step]
    return document


@pytest.mark.parametrize("path", PATHS)
def test_absent_section(spark, feeds, tmp_path, path):
    *outer, last = path.split(".")
    with pytest.raises(GateError, match=f"no section {path}"):
        read_erp(spark, _edited(feeds, tmp_path, lambda d: (_records(d, ".".join(outer)) if outer else d).pop(last)))
    with pytest.raises(GateError, match=f"no section {path}"):
        land_document(spark, str(tmp_path / "inventory.json"), str(tmp_path / "out"))


@pytest.mark.parametrize(
    "name, field",
    [
        (name, column.split()[0])
        for name, (_, rows) in ERP_SECTIONS.items()
        for column in rows.split("ARRAY<")[0].split(", ")
    ],
)
def test_absent_field(spark, feeds, tmp_path, name, field):
    path, rows = ERP_SECTIONS[name]
    message = rf"{path} is missing required columns: \['{field}'\]"
    with pytest.raises(GateError, match=message):
        read_erp(spark, _edited(feeds, tmp_path, lambda d: [r.pop(field) for r in _records(d, path)]))
    with pytest.raises(GateError, match=message):
        land_document(spark, str(tmp_path / "inventory.json"), str(tmp_path / "out"))
    erp = read_erp(spark, feeds["inventory"])
    for layout, write in (("lines", "json"), ("parquet", "parquet")):
        root = tmp_path / layout
        for other in ERP_SECTIONS:
            table = getattr(erp, other)
            getattr((table.drop(field) if other == name else table).write, write)(str(root / other))
        with pytest.raises(GateError, match=message):
            read_erp(spark, str(root), layout)


def test_field_of_some_records_and_empty_section(spark, feeds, tmp_path):
    def change(document):
        document["tiendas_info"][0].pop("region")
        document["snapshots"] = []

    path = _edited(feeds, tmp_path, change)
    for erp in (read_erp(spark, path), land_document(spark, path, str(tmp_path / "out"))):
        assert sorted(map(str, records(erp.stores, "region"))) == ["None", "R"] and erp.snapshots.count() == 0


@pytest.mark.parametrize("name", sorted(MODEL_KEYS))
def test_absent_stored_column(spark, stored, tmp_path, name):
    for table, df in read_model(spark, stored).items():
        (df.drop(df.columns[1]) if table == name else df).write.parquet(str(tmp_path / table))
    with pytest.raises(GateError, match=f"{name} is missing required columns"):
        read_model(spark, str(tmp_path))


def test_whole_numbers_keep_their_digits(frame):
    texts = ["9007199254740993", "9007199254740993.0", "-9007199254740993", "1e3", " 7 "]
    df = frame("t STRING", *[(t,) for t in texts])
    for parse in (strict_integer, lenient_integer):
        assert records(df.select(parse(F.col("t"), "t").alias("n")), "n") == [
            9007199254740993, 9007199254740993, -9007199254740993, 1000, 7
        ]
    for wrong in ("9007199254740993.5", "5.00000000001", "1e30"):
        with pytest.raises(Exception, match="as a whole number"):
            frame("t STRING", (wrong,)).select(strict_integer(F.col("t"), "t")).collect()
    exact = frame("d DECIMAL(30,2)", (Decimal("9007199254740993.00"),))
    assert records(exact.select(strict_integer(F.col("d"), "d", False).alias("n")), "n") == [9007199254740993]


def test_totals_keep_their_digits(frame):
    df = frame("a DOUBLE", (0.1,), (0.2,), (1e-7,), (0.000712345678,), (None,))
    assert records(df.agg(money_total("a").cast("string").alias("t")), "t") == ["0.300712445678000000"]
    assert records(frame("a DOUBLE", (None,)).agg(money_total("a").alias("t")), "t") == [None]
    assert records(frame("a DOUBLE", (9e16,), (0.25,)).agg(money_total("a").cast("double").alias("t")), "t") == [9e16]
    for large in (1e19, 1e-25, float("inf"), float("nan")):
        with pytest.raises(Exception, match="amount: cannot read"):
            frame("a DOUBLE", (large,)).agg(money_total("a").alias("t")).collect()


def test_csv_quotes_and_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text('venta_id,sku\n"V""1","a,b"\n')
    assert [tuple(r) for r in read_pos(spark, str(tmp_path / "a.csv")).collect()] == [('V"1', "a,b")]
    (tmp_path / "b.csv").write_text("sku,venta_id\nx,V2\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_pos(spark, str(tmp_path)).collect()


def test_write_model_subset(spark, frame, tmp_path):
    write_model({"dim_store": frame("store_id STRING", ("T",))}, str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "dim_store")).count() == 1


# --- stored intervals, buckets, counters of the write ------------------------------------------


def test_reports_share_stored_intervals(spark, stored):
    model, costs = read_model(spark, stored), read_intervals(spark, stored)
    with intermediate(spark) as written:
        for window in (dict(start="2025-10-01", end="2025-10-31"), dict(start="2025-10-05", end="2025-11-30")):
            shared = negative_margin(model, **window, intervals=costs)
            assert shared.collect() == negative_margin(model, **window).collect()
            assert "/history-" not in "".join(shared.inputFiles())
        assert sum("/history-" in path for path in written) == 2  # of the two calls without the stored table
    plan = costed_pairs(model, "2025-10-01", "2025-10-31", intervals=costs)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(valid_month" in plan


def test_interval_join_is_the_asof_join(frame):
    rng = random.Random(3)
    start = dt.date(2025, 1, 20)
    entries = {(rng.choice("abc"), start + dt.timedelta(days=rng.randrange(-90, 400))): rng.choice([None, 1, 2, 3]) for _ in range(60)}
    history = frame("k STRING, e DATE, v INT", *[(k, e, v) for (k, e), v in entries.items()], ("a", None, 9), (None, start, 8))
    facts = frame(
        "id INT, k STRING, d DATE",
        *[(i, rng.choice("abcd"), start + dt.timedelta(days=rng.randrange(420))) for i in range(400)], (-1, "a", None), (-2, None, start),
    )
    horizon = (start, start + dt.timedelta(days=419))
    intervals = monthly_intervals(history, ["k"], "e", ["v"], horizon)
    found = sorted(records(interval_join(facts, intervals, ["k"], "d", ["v"]), "id", "v"), key=str)
    assert found == sorted(records(asof_join(facts, history, ["k"], "d", "e", ["v"], horizon), "id", "v"), key=str)
    narrow = (start, dt.date(2025, 3, 2))  # months outside are not read; facts there find nothing
    for i, d, v in records(interval_join(facts, intervals, ["k"], "d", ["v"], narrow), "id", "d", "v"):
        assert (i, v) in found if d and d < dt.date(2025, 4, 1) else v is None
    assert interval_join(facts.limit(0), intervals, ["k"], "d", ["v"]).count() == 0
    assert records(interval_join(facts, intervals.limit(0), ["k"], "d", ["v"]).select("v").distinct(), "v") == [None]


def test_bucketed_facts_meet_without_a_shuffle(spark, feeds, stored, tmp_path):
    root = str(tmp_path / "it's a model")
    for n in (3, 5):  # the second run replaces the tables and their number of buckets
        bucketed = run_batch(spark, **feeds, root=root, buckets=n)
    plain = read_model(spark, stored)
    for name in plain:
        assert sorted(map(str, bucketed[name].collect())) == sorted(map(str, plain[name].collect()))
        assert bucketed[name].columns == plain[name].columns
    assert inventory_turnover(bucketed).collect() == inventory_turnover(plain).collect()
    pair = ["store_id", "product_id"]
    sold = bucketed["fact_sales"].groupBy(*pair).agg(F.sum("quantity").alias("units"))
    joined = stock_by_pair(bucketed["fact_inventory"], pair, "stock_quantity").join(sold.hint("merge"), pair, "left")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "Bucketed: true" in plan
    again = run_batch(spark, **feeds, root=root)  # and without buckets
    assert sorted(map(str, again["fact_sales"].collect())) == sorted(map(str, plain["fact_sales"].collect()))


def test_broken_rows_are_counted_by_the_write(spark, model, tmp_path):
    rows = [sale(f"V{i}", "2025-10-01T10:00:00", None if i % 2 else "P1", "T1", 1, 1) for i in range(9)]
    facts = model(fact_sales=rows, fact_product_cost=[("P1", "2025-01-01", 1.0, "s")])
    rule = RowRule("Sales whose code has no product", F.col("product_id").isNull(), F.col("transaction_id"))
    with pytest.raises(GateError, match=r"Sales whose code has no product \(4 rows: V1 to V7\)"):
        write_model(facts, str(tmp_path / "a"), {"fact_sales": [rule]})
    unknown = RowRule("No currency", F.col("currency") == F.lit(None), F.col("currency"))  # NULL is not broken
    write_model(facts, str(tmp_path / "b"), {"fact_sales": [unknown]})
    nameless = RowRule("All", F.lit(True), F.lit(None))
    watch = Watch(facts["fact_sales"], [nameless])
    watch.frame.write.parquet(str(tmp_path / "c"))
    with pytest.raises(GateError, match=r"All \(9 rows: NULL\)"):
        watch.check()
    empty = Watch(facts["fact_sales"].limit(0), [nameless])
    empty.frame.write.parquet(str(tmp_path / "d"))
    empty.check()


def test_intervals_of_a_model_without_sales(spark, model, tmp_path):
    write_model(model(fact_product_cost=[("P1", "2025-01-01", 1.0, "s")]), str(tmp_path))
    assert read_intervals(spark, str(tmp_path)).count() == 0
