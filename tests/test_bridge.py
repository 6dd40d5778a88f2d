"""Code numbers, the product bridge and its gates."""

import pytest

from conftest import records
from mostrador.functions import ERP_CODE, HANDLE_CODE, POS_CODE, code_number
from mostrador.operators import GateError, enforce
from mostrador.operators.gates import Gate
from mostrador.operators.resolve import unreconciled
from mostrador.plans import build_bridge, reconcile_orders, reconcile_sales
from mostrador.schemas import MAPPINGS, PRODUCTS, SNAPSHOTS, STORES
from mostrador.sources import Erp


@pytest.fixture(scope="module")
def erp(frame):
    def make(products, mappings):
        rows = [(p, f"name {p}", "category", []) for p in products]
        return Erp(frame(STORES), frame(MAPPINGS, *mappings), frame(PRODUCTS, *rows), frame(SNAPSHOTS))

    return make


@pytest.fixture(scope="module")
def bridge(frame, erp):
    def make(pos=(), handles=(), products=("ERP-PROV-MX-030-C",), mappings=((None, None, None),)):
        sales = frame("sku STRING", *[(c,) for c in pos])
        orders = frame("product_handle STRING", *[(c,) for c in handles])
        return build_bridge(sales, orders, erp(products, mappings))

    return make


@pytest.mark.parametrize(
    "pattern, code, number",
    [
        (POS_CODE, "CN-00030", 30),
        (POS_CODE, "CN-00030\n", None),
        (POS_CODE, "CN-000300", None),
        (POS_CODE, "xCN-00030", None),
        (POS_CODE, "CN-0003", None),
        (POS_CODE, None, None),
        (ERP_CODE, "ERP-PROV-MX-030-C", 30),
        (ERP_CODE, "ERP-PROV-MX-030-c", None),
        (ERP_CODE, "ERP-PROV-MX-030-CD", None),
        (ERP_CODE, "", None),
        (HANDLE_CODE, "tetera-azul-030", 30),
        (HANDLE_CODE, "-007", 7),
        (HANDLE_CODE, "a-030\n", 30),
        (HANDLE_CODE, "a-0301", None),
        (HANDLE_CODE, "a-030-", None),
    ],
)
def test_code_number(frame, pattern, code, number):
    assert records(frame("c STRING", (code,)).select(code_number("c", pattern).alias("n")), "n") == [number]


def test_explicit_mapping_needs_no_pattern(bridge):
    (row,) = bridge(
        pos=["till key 7", "till key 7", None],
        mappings=[("till key 7", "ERP-PROV-MX-030-C", None)],
    ).collect()
    assert row["sku_pos"] == "till key 7"
    assert row["pos_mapping_method"] == "explicit"
    assert row["shopify_mapping_method"] == "not_observed" and row["product_handle"] is None


def test_fallback_by_number(bridge):
    (row,) = bridge(pos=["CN-00030"], handles=["tetera-azul-030"]).collect()
    assert row.asDict() == {
        "sku_erp": "ERP-PROV-MX-030-C",
        "nombre": "name ERP-PROV-MX-030-C",
        "categoria": "category",
        "sku_pos": "CN-00030",
        "product_handle": "tetera-azul-030",
        "product_number": 30,
        "pos_mapping_method": "inferred_numeric_pattern",
        "shopify_mapping_method": "inferred_numeric_pattern",
    }


def test_every_catalog_row_is_kept(bridge):
    rows = bridge(pos=["CN-00001"], products=["ERP-PROV-MX-001-A", "ERP-PROV-MX-002-A", "ODD"]).collect()
    assert {(r["sku_erp"], r["product_number"], r["pos_mapping_method"]) for r in rows} == {
        ("ERP-PROV-MX-001-A", 1, "inferred_numeric_pattern"),
        ("ERP-PROV-MX-002-A", 2, "not_observed"),
        ("ODD", None, "not_observed"),
    }


A, B = "ERP-PROV-MX-030-C", "ERP-PROV-MX-031-C"


@pytest.mark.parametrize(
    "given, message",
    [
        (dict(pos=["CN-00030"], products=[A, B], mappings=[("CN-00030", A, None), ("CN-00030", B, None)]),
         "Conflicting explicit POS"),
        (dict(products=[A, B], mappings=[(None, A, "h"), (None, B, "h")]), "Conflicting explicit web shop"),
        (dict(products=[A, A]), "catalog repeats sku_erp"),
        (dict(products=[A, "ERP-PROV-MX-030-D"]), "numbers are not unique"),
        (dict(mappings=[("X", "ERP-PROV-MX-999-A", None)]), "Explicit POS mappings name products"),
        (dict(mappings=[(None, "ERP-PROV-MX-999-A", "h")]), "Explicit web shop mappings name products"),
        (dict(mappings=[("CN-00031", A, None)]), "Explicit POS mappings contradict"),
        (dict(mappings=[(None, A, "h-031")]), "Explicit web shop mappings contradict"),
        (dict(pos=["NO-NUMBER"]), "POS codes without an explicit mapping"),
        (dict(pos=["CN-00099"]), "POS codes without an explicit mapping"),
        (dict(handles=["thing-099"]), "web shop codes without an explicit mapping"),
        (dict(pos=["CN-00030", "OTHER"], mappings=[("OTHER", A, None)]), "Several observed POS codes"),
        (dict(handles=["a-030", "b-030"]), "Several observed web shop codes"),
    ],
)
def test_bridge_gates(bridge, given, message):
    with pytest.raises(GateError, match=message):
        bridge(**given)


def test_same_mapping_twice_is_no_conflict(bridge):
    (row,) = bridge(pos=["X"], mappings=[("X", A, "h"), ("X", A, None), (None, A, "h")]).collect()
    assert row["pos_mapping_method"] == "explicit"


def test_missing_mapping_column(frame, erp):
    whole = erp([A], [])
    broken = Erp(whole.stores, whole.mappings.drop("handle"), whole.products, whole.snapshots)
    with pytest.raises(GateError, match=r"sku_mappings is missing required columns: \['handle'\]"):
        build_bridge(frame("sku STRING"), frame("product_handle STRING"), broken)


def test_reconcile(frame, bridge):
    table = bridge(pos=["CN-00030"], handles=["h-030"])
    sales = frame("venta_id STRING, sku STRING", ("1", "CN-00030"), ("2", "CN-00030"))
    assert records(reconcile_sales(sales, table).orderBy("venta_id"), "venta_id", "sku", "sku_erp") == [
        ("1", "CN-00030", A), ("2", "CN-00030", A),
    ]
    orders = frame("order_id STRING, product_handle STRING", ("1", "h-030"))
    assert reconcile_orders(orders, table).columns == ["order_id", "product_handle", "sku_erp"]


@pytest.mark.parametrize("code, shown", [("CN-00031", "CN-00031"), (None, "NULL")])
def test_unreconciled_code_fails(frame, bridge, code, shown):
    table = bridge(pos=["CN-00030"])
    sales = frame("venta_id STRING, sku STRING", ("1", "CN-00030"), ("2", code))
    assert records(unreconciled(sales, table, "sku", "sku_pos"), "sku") == [code]
    with pytest.raises(Exception, match=f"Unreconciled POS code: {shown}"):
        reconcile_sales(sales, table).collect()


def test_reconcile_needs_unique_codes(frame, bridge):
    twice = bridge(pos=["CN-00030"], handles=["h-030"])
    twice = twice.unionAll(twice)
    with pytest.raises(GateError, match="bridge repeats sku_pos"):
        reconcile_sales(frame("sku STRING"), twice)
    with pytest.raises(GateError, match="bridge repeats product_handle"):
        reconcile_orders(frame("product_handle STRING"), twice)


def test_enforce_reports_the_first_broken_gate_in_order(frame):
    good = Gate("good", frame("k INT"))
    bad = Gate("bad", frame("k INT, v STRING", (2, None), (1, "x")))
    worse = Gate("worse", frame("k INT", (1,)))
    enforce(good)
    enforce()
    with pytest.raises(GateError, match=r"^bad \(2 found: 1 / x, 2 / NULL\)$"):
        enforce(good, bad, worse)
