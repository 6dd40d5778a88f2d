"""Operators against brute force on random rows, and their edge cases."""

import datetime as dt
import random
from collections import defaultdict
from decimal import Context, Decimal, localcontext
from statistics import median

import pytest
from pyspark.sql import functions as F

from conftest import day, records
from mostrador.functions import as_date, cost_total, money_total, strict_integer, within
from mostrador.operators import (
    asof_join, calendar, consecutive_days, convert_currency, dense, matched_rows, matched_turnover, members,
    period_change, top_k,
)
from mostrador.operators import gates, profile
from mostrador.operators.panel import read_panel

START = dt.date(2025, 1, 1)


def some_day(rng, span):
    return START + dt.timedelta(days=rng.randrange(span))


# --- as-of join ------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def dated(frame):
    rng = random.Random(7)
    keys = [f"k{i}" for i in range(12)]
    history = {}
    for k in keys[1:]:
        for _ in range(rng.choice([1, 2, 5, 60])):
            history[k, some_day(rng, 400)] = rng.choice([None, *range(1, 50)])
    # k1 holds a third of the facts.
    facts = [(i, rng.choice(keys) if i % 3 else "k1", some_day(rng, 420)) for i in range(1500)]
    expected = {}
    for i, k, d in facts:
        past = [e for (hk, e) in history if hk == k and e <= d]
        expected[i] = history[k, max(past)] if past else None
    return (
        frame("id INT, k STRING, d DATE", *facts, (-1, "k1", None), (-2, None, START)),
        frame("k STRING, e DATE, v INT", *[(k, e, v) for (k, e), v in history.items()], ("k1", None, 5)),
        expected | {-1: None, -2: None},
    )


@pytest.mark.parametrize(
    "options",
    [
        dict(horizon=("2025-01-01", "2026-02-24")),
        dict(horizon=("2025-01-01", "2026-02-24"), slices=1),
        dict(horizon=("2025-01-01", "2026-02-24"), slices=1000),
        dict(horizon=("2020-01-01", "2030-01-01"), slices=7),
        dict(horizon=("2025-01-01", "2026-02-24"), store=False),
        dict(),
    ],
)
def test_asof_join(dated, options):
    facts, history, expected = dated
    joined = asof_join(facts, history, ["k"], "d", "e", ["v"], **options)
    assert joined.columns == ["id", "k", "d", "v"]
    rows = joined.collect()
    assert len(rows) == len(expected)
    assert {r["id"]: r["v"] for r in rows} == expected


def test_asof_join_without_facts(frame):
    facts = frame("id INT, k STRING, d DATE")
    history = frame("k STRING, e DATE, v INT", ("k", START, 1))
    assert asof_join(facts, history, ["k"], "d", "e", ["v"]).count() == 0


def test_asof_join_never_multiplies_facts(frame):
    facts = frame("id INT, k STRING, d DATE", (1, "k", day("2025-03-01")))
    history = frame("k STRING, e DATE, v INT", ("k", START, 1), ("k", START, 2))
    assert asof_join(facts, history, ["k"], "d", "e", ["v"]).count() == 1


# --- runs ------------------------------------------------------------------------------------


def brute_runs(days, shortest):
    found = []
    for k, seen in days.items():
        for d in seen:
            if d - dt.timedelta(days=1) not in seen:
                end = d
                while end + dt.timedelta(days=1) in seen:
                    end += dt.timedelta(days=1)
                if (end - d).days + 1 >= shortest:
                    found.append((k, d, end, (end - d).days + 1))
    return sorted(found)


@pytest.mark.parametrize("shortest", [1, 3])
def test_consecutive_days(frame, shortest):
    rng = random.Random(3)
    rows = [(f"k{rng.randrange(5)}" if i % 3 else "hot", some_day(rng, 300)) for i in range(900)]
    days = defaultdict(set)
    for k, d in rows:
        days[k].add(d)
    rows += [("hot", None), ("hot", None), ("none", None)]  # rows without a day are in no run
    df = consecutive_days(frame("k STRING, d DATE", *rows), ["k"], "d", shortest, on_duplicate="merge")
    assert sorted(records(df, "k", "run_start", "run_end", "run_days")) == brute_runs(days, shortest)
    # one row per day, some of which count
    once = [(k, d, rng.random() < 0.7) for k, seen in days.items() for d in sorted(seen)]
    counted = defaultdict(set)
    for k, d, counts in once:
        if counts:
            counted[k].add(d)
    once += [("hot", None, True), ("x", START, None)]
    df = consecutive_days(frame("k STRING, d DATE, c BOOLEAN", *once), ["k"], "d", shortest, counts=F.col("c"))
    assert sorted(records(df, "k", "run_start", "run_end", "run_days")) == brute_runs(counted, shortest)
    # one shuffle, by the key
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == 1


def test_consecutive_days_rejects_unknown_mode(frame):
    with pytest.raises(ValueError, match="on_duplicate"):
        consecutive_days(frame("k STRING, d DATE"), ["k"], "d", on_duplicate="keep")


# --- series ----------------------------------------------------------------------------------


def test_calendar_and_change(spark, frame):
    sparse = frame("c STRING, m DATE, v DOUBLE", ("a", day("2025-01-01"), 10.0), ("a", day("2025-02-01"), 15.0),
                   ("a", day("2025-04-01"), 0.0), ("a", day("2025-05-01"), 5.0), ("b", day("2025-03-01"), 1.0))
    grid = calendar(members(spark, "c", ["a", "b"]), "m", "2025-01-01", "2025-05-01")
    series = period_change(dense(sparse, grid, ["c", "m"]), ["c"], "m", "v", "pct").orderBy("c", "m")
    assert records(series, "v", "pct") == [
        (10.0, None), (15.0, 50.0), (None, None), (0.0, None), (5.0, None),
        (None, None), (None, None), (1.0, None), (None, None), (None, None),
    ]
    assert calendar(members(spark, "c", ["a"]), "d", "2024-02-27", "2024-03-01", "day").count() == 4


# --- money -----------------------------------------------------------------------------------


def test_money_total_is_exact(frame):
    rng = random.Random(5)
    groups = {
        "small": [rng.randrange(-10**7, 10**7) / 100 for _ in range(3000)],
        "large": [rng.randrange(10**9) / 100 for _ in range(500)],
        "signs": [0.1, 0.2, -0.3, 1e-6],
        "digits": [rng.randrange(-10**15, 10**15) / 10**12 for _ in range(300)] + [1e-18, -1e-18, 3.5e-17],
        "null": [None, None],
        "mixed": [None, 0.7],
    }
    rows = [(k, v) for k, values in groups.items() for v in values]
    df = frame("k STRING, v DOUBLE", *rows).repartition(7).groupBy("k").agg(money_total("v").alias("t"))
    expected = {
        k: sum((Decimal(str(v)) for v in values if v is not None), Decimal(0))
        for k, values in groups.items()
    }
    expected["null"] = None
    assert dict(records(df, "k", "t")) == expected


def written(rng, least=-18, most=17):
    """An amount of any size that has at most 18 decimals as it is written."""
    while True:
        value = rng.choice((1, -1)) * round(rng.random(), rng.randint(1, 16)) * 10.0 ** rng.randint(least + 1, most)
        if Decimal(repr(value)).as_tuple().exponent >= -18:
            return value


def exact_sum(values):
    with localcontext(Context(prec=80)):
        return sum(values, Decimal(0))


@pytest.mark.parametrize("seed", range(3))
def test_totals_of_any_size(frame, seed):
    rng = random.Random(seed)
    groups = {f"g{k}": [written(rng) for _ in range(rng.choice((1, 2, 3, 500)))] for k in range(60)}
    groups |= {
        "apart": [9e16, 0.25], "one": [1e13], "minus": [-1e13], "cancel": [1e17, -1e17, 1e-18], "null": [None, None],
        "edge": [4294967295.999999, 4294967296.000001, -4294967296.0, 8e12 + 0.1, 9223372036854.775, -9223372036854.776],
    }
    rows = [(k, v) for k, values in groups.items() for v in values]
    df = frame("k STRING, v DOUBLE", *rows).repartition(5).groupBy("k").agg(money_total("v").alias("t"))
    digits = lambda v: Decimal(int(v)) if abs(v) >= 2**53 else Decimal(repr(v))
    expected = {k: exact_sum(digits(v) for v in values if v is not None) for k, values in groups.items()}
    assert dict(records(df, "k", "t")) == expected | {"null": None}


def test_totals_that_do_not_fit_fail(frame):
    for values in ((9e17, 9e17), (1e18,), (-9e17, -2e17)):
        with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE|cannot read"):
            frame("v DOUBLE", *[(v,) for v in values]).agg(money_total("v").alias("t")).collect()


def test_written_totals_hold_any_size(frame):
    rng = random.Random(9)
    groups = {f"g{k}": [written(rng) for _ in range(rng.choice((1, 2, 40)))] for k in range(40)}
    groups |= {
        "much": [9e17] * 50, "less": [-9e17] * 50 + [0.3], "between": [-0.3], "unit": [-1.0], "zero": [1e13, -1e13], "null": [None],
        "near": [-1e17] * 30 + [1e-18], "cents": [4294967295.999999] * 9,
    }
    rows = [(k, v) for k, values in groups.items() for v in values]
    total, cost = money_total("v", written=True), cost_total(F.lit(3).cast("bigint"), F.col("v"), written=True)
    df = frame("k STRING, v DOUBLE", *rows).repartition(3).groupBy("k").agg(total.alias("t"), cost.alias("c"))
    digits = lambda v: Decimal(int(v)) if abs(v) >= 2**53 else Decimal(repr(v))
    with localcontext(Context(prec=80)):
        sums = {k: exact_sum(digits(v) for v in values if v is not None) for k, values in groups.items() if k != "null"}
        expected = {(k, f"{v:.18f}", f"{3 * v:.18f}") for k, v in sums.items()}
    assert set(records(df, "k", "t", "c")) == expected | {("null", None, None)}


def test_cost_totals_of_any_size(frame):
    rng = random.Random(2)
    rows = [(f"g{k % 7}", rng.choice((1, -1)) * rng.randrange(10**9), written(rng, -18, 6)) for k in range(700)]
    rows += [("big", 10**12 + 1, 4294967295.999999 / 10**5), ("big", 10**15 + 1, 12.345678), ("big", -3, 99999999999.25)]
    rows += [("null", None, 1.0), ("null", 2, None), ("null", None, 1e-9)]
    rows += [("large", 7, 12345678901234.5), ("large", -(2**40), 0.1)]
    df = frame("k STRING, q BIGINT, c DOUBLE", *rows).repartition(5).groupBy("k").agg(cost_total(F.col("q"), F.col("c")).alias("t"))
    products = defaultdict(list)
    with localcontext(Context(prec=80)):
        for k, q, c in rows:
            products[k].append(None if q is None or c is None else q * Decimal(repr(c)))
    expected = {k: exact_sum(v) for k, v in products.items() if k != "null"}
    assert dict(records(df, "k", "t")) == expected | {"null": None}


@pytest.mark.parametrize("kind", ["DOUBLE", "FLOAT", "DECIMAL(20,2)", "BIGINT", "INT"])
def test_whole_numbers_that_are_no_texts(frame, kind):
    df = frame("d STRING", ("17",), ("-3",), (None,), ("0",)).select(F.col("d").cast(kind).alias("d"))
    assert records(df.select(strict_integer(F.col("d"), "d", False).alias("n")), "n") == [17, -3, None, 0]


def test_kinds_of_whole_texts(frame):
    texts = {
        "17": 17, " 17 ": 17, "+17": 17, "17.0": 17, "17.": 17, "-0.0": 0, "1700": 1700, "1e3": 1000, "1.5e1": 15, "0.1e1": 1,
        "9223372036854775807": 2**63 - 1, "-9223372036854775808.00": -(2**63), ".0": 0, "1e3.0": None, "17.0.0": None,
        "17.50": None, "17.0x": None, "5d": None, "1_0": None, "9223372036854775808": None, "1e19": None, "inf": None, "x.0": None,
    }
    for text, number in texts.items():
        one = frame("t STRING", (text,)).select(strict_integer(F.col("t"), "t").alias("n"))
        if number is None:
            with pytest.raises(Exception, match="as a whole number"):
                one.collect()
        else:
            assert records(one, "n") == [number], text
    missing = frame("t STRING", (None,), ("nan",), (" NaN ",)).select(strict_integer(F.col("t"), "t").alias("n"))
    assert records(missing, "n") == [None] * 3


def test_panel_reports_equal_those_of_the_rows(spark, frame):
    rng = random.Random(6)
    rows = [
        (
            rng.choice(["s1", "s2", "s3", None]), rng.choice(["p1", "p2", "p3", "p4", None]),
            rng.choice([f"2026-01-{d:02d}" for d in (1, 2, 3, 5, 9)] + ["2026-01-01 00:00:00", None]),
            rng.choice([0, 0, 1, 5, None]),
        )
        for _ in range(300)
    ] + [("s9", "p9", "2026-01-01", 3), (None, "p1", "2026-01-20", 0)]
    full = frame("s STRING, p STRING, d STRING, v BIGINT", *rows)
    pair = ("s", "p")
    same = lambda a, b: sorted(map(str, a.select(*sorted(a.columns)).collect())) == sorted(
        map(str, b.select(*sorted(b.columns)).collect())
    )
    for df in (full, full.where("false"), full.where("s = 's9'"), full.where("v > 0")):
        panel = read_panel(df, pair, "d", F.col("v"), F.coalesce(F.col("v").cast("string"), F.lit("N/A")))
        per_pair = profile.missing_per_pair(df, pair, "v")
        text = df.withColumn("t", F.coalesce(F.col("v").cast("string"), F.lit("N/A")))
        assert same(panel.sentinels(), profile.sentinel_share(text, "t"))
        assert same(panel.repeated(), profile.duplicate_row_count(df, ["d", *pair]))
        assert same(panel.calendar(), profile.calendar_summary(df, "d"))
        assert same(panel.missing_days(), profile.missing_days(df, "d"))
        assert same(panel.coverage(), profile.pair_coverage(df, pair, "d"))
        assert same(panel.days_per_pair(), profile.distribution(profile.days_per_pair(df, pair, "d"), "n_days", "n_pairs"))
        assert same(panel.rows_per_day(), profile.rows_per_day_summary(df, "d"))
        assert same(panel.day_sizes(), profile.distribution(profile.rows_per_day(df, "d"), "n_rows", "n_days"))
        assert same(panel.spread("n_missing"), profile.spread(df, F.col("v").isNull(), pair, "d"))
        assert same(panel.spread("n_zero"), profile.spread(df, F.col("v") == 0, pair, "d"))
        assert same(panel.missing_per_pair(), per_pair)
        for report in (panel.spread("n_zero"), panel.coverage(), panel.sentinels()):
            plan = report._jdf.queryExecution().optimizedPlan().toString()
            assert "LogicalRDD" not in plan and "LocalRelation" not in plan, plan  # the rows themselves are not read again


def test_converting_a_total_equals_totalling_conversions(frame):
    rng = random.Random(11)
    sales = frame("currency STRING, sale_date DATE, amount_native DOUBLE", *[
        (rng.choice(["MXN", "USD", "EUR"]), some_day(rng, 20), rng.randrange(10**6) / 100) for _ in range(800)
    ])
    rates = frame("rate_date DATE, currency STRING, rate_to_mxn DOUBLE", *[
        (START + dt.timedelta(days=i), c, round(15 + rng.random() * 8, 6)) for i in range(20) for c in ("USD", "EUR")
    ])
    rows = convert_currency(sales, rates).agg(F.sum("amount_mxn").alias("t"))
    cells = sales.groupBy("currency", "sale_date").agg(money_total("amount_native").alias("amount_native"))
    totals = convert_currency(cells, rates).agg(F.sum("amount_mxn").alias("t"))
    assert records(rows, "t") == records(totals, "t")


# --- turnover --------------------------------------------------------------------------------


def test_matched_turnover(frame):
    rng = random.Random(13)
    readings = [(f"s{rng.randrange(6)}", f"p{rng.randrange(8)}" if i % 3 else "p0", rng.choice([None, 0, 1, 2, 9]))
                for i in range(400)]
    sales = [(f"s{rng.randrange(9)}" if i % 10 else None, f"p{rng.randrange(10)}" if i % 3 else "p0", rng.randrange(5))
             for i in range(500)]
    by_pair = defaultdict(list)
    for s, p, v in readings:
        by_pair[s, p].append(v)
    expected = {}
    for product in {p for _, p in by_pair}:
        pairs = {k: [v for v in vs if v is not None] for k, vs in by_pair.items() if k[1] == product}
        averages = [sum(vs) / len(vs) for vs in pairs.values() if vs]
        if averages:
            units = sum(q for s, p, q in sales if (s, p) in pairs)
            rows = sum(len(by_pair[k]) for k in pairs)
            known = sum(len(v) for v in pairs.values())
            average = sum(averages)
            expected[product] = (units, round(average, 6), len(pairs), round(100 * known / rows, 2),
                                 round(units / average, 6) if average > 0 else None)
    df = matched_turnover(
        frame("store_id STRING, product_id STRING, quantity BIGINT", *sales),
        frame("store_id STRING, product_id STRING, stock_quantity BIGINT", *readings),
    )
    got = {
        r["product_id"]: (
            r["physical_units_sold"], round(r["average_inventory_units"], 6), r["store_count"],
            r["inventory_coverage_pct"], None if r["inventory_turnover"] is None else round(r["inventory_turnover"], 6),
        )
        for r in df.collect()
    }
    assert got == expected


def test_matched_rows_keeps_each_fact_once(frame):
    facts = frame("k STRING, v INT", ("a", 1), ("a", 1), ("b", 2), (None, 3))
    population = frame("k STRING", ("a",), ("a",), ("c",), (None,))
    assert records(matched_rows(facts, population, ["k"]), "v") == [1, 1]


def test_top_k(frame):
    df = frame("k STRING, v DOUBLE", ("b", 1.0), ("a", 1.0), ("c", None), ("d", 2.0))
    assert records(top_k(df, "v", ["k"], 3), "k") == ["d", "a", "b"]
    assert records(top_k(df, "v", ["k"], 9), "k") == ["d", "a", "b", "c"]


def test_within_is_inclusive(frame):
    stamps = ["2025-01-31 23:59:59", "2025-02-01 00:00:00", "2025-02-28 23:59:59.999999", "2025-03-01 00:00:00"]
    df = frame("t TIMESTAMP_NTZ", *[(dt.datetime.fromisoformat(t),) for t in stamps], (None,))
    assert within(df, "t", "2025-02-01", as_date("2025-02-28")).count() == 2


# --- gates -----------------------------------------------------------------------------------


def test_gate_frames(frame):
    df = frame("a STRING, b STRING", ("x", "1"), ("x", "1"), ("x", "2"), (None, "3"), (None, "3"), ("y", None))
    assert sorted(map(str, records(gates.duplicate_keys(df, ["a", "b"]), "a", "n_rows"))) == ["('x', 2)", "(None, 2)"]
    assert records(gates.conflicting_targets(df, "a", "b"), "a", "n_targets") == [("x", 2)]
    assert records(gates.unknown_keys(df, "a", frame("k STRING", ("x",), ("x",)), "k"), "a") == ["y"]
    assert gates.missing_columns(df, ["c", "a", "b2"]) == ["b2", "c"]


def test_missing_rates_ignores_a_null_currency(frame):
    sales = frame("sale_date DATE, currency STRING", (START, "USD"), (START, "USD"), (START, None), (START, "MXN"))
    rates = frame("rate_date DATE, currency STRING, rate_to_mxn DOUBLE", (START, "EUR", 1.0))
    assert records(gates.missing_rates(sales, rates), "sale_date", "currency") == [(START, "USD")]


# --- profiling -------------------------------------------------------------------------------


def test_panel_profile(frame):
    rng = random.Random(17)
    rows = [(START + dt.timedelta(days=i), f"s{s}", f"p{p}", rng.choice([None, 0, 0, 3]))
            for i in range(15) for s in range(3) for p in range(2) if i != 4 and rng.random() < 0.8]
    df = frame("d DATE, s STRING, p STRING, v INT", *rows)
    pair = ("s", "p")
    days, per_pair, per_day = {r[0] for r in rows}, defaultdict(list), defaultdict(int)
    for d, s, p, v in rows:
        per_pair[s, p].append((d, v))
        per_day[d] += 1
    assert day("2025-01-05") in records(profile.missing_days(df, "d"), "day")
    (c,) = profile.calendar_summary(df, "d").collect()
    span = (max(days) - min(days)).days + 1
    assert tuple(c) == (min(days), max(days), len(days), span, span - len(days))
    counts = [len(v) for v in per_pair.values()]
    (c,) = profile.pair_coverage(df, pair, "d").collect()
    full = sum(n == len(days) for n in counts)
    assert tuple(c) == (len(counts), min(counts), max(counts), median(counts), full, len(counts) - full)
    (c,) = profile.rows_per_day_summary(df, "d").collect()
    assert tuple(c) == (min(per_day.values()), max(per_day.values()), len(set(per_day.values())))
    zero = [r for r in rows if r[3] == 0]
    (c,) = profile.spread(df, F.col("v") == 0, pair, "d").collect()
    assert tuple(c) == (
        len(zero), len({r[1:3] for r in zero}), len({r[1] for r in zero}), len({r[2] for r in zero}), len({r[0] for r in zero})
    )
    missing = {k: sum(x is None for _, x in v) for k, v in per_pair.items()}
    (c,) = profile.missing_summary(profile.missing_per_pair(df, pair, "v")).collect()
    assert tuple(c)[:3] == (min(missing.values()), max(missing.values()), median(missing.values()))
    worst = records(profile.most_missing(profile.missing_per_pair(df, pair, "v"), pair, 3), "s", "p")
    assert worst == sorted(per_pair, key=lambda k: (-missing[k] / len(per_pair[k]), k))[:3]


def test_code_profile(frame):
    from mostrador.operators.resolve import CodeSystem

    a, b = CodeSystem("a", "a", r"\Aa([0-9]+)\z"), CodeSystem("b", "b", r"\Ab([0-9]+)\z")
    mapping = frame("a STRING, b STRING", ("a1", "b1"), ("a1", "b2"), ("x", "y"), ("a3", None), (None, "b4"))
    assert records(profile.rule_agreement(mapping, (a, b)), "n_known", "n_match", "n_mismatch") == [(3, 1, 2)]
    assert records(profile.rule_mismatches(mapping, (a, b)), "a") == ["a1", "x"]
    assert records(profile.row_conflicts(mapping, (a, b)), "a", "b") == [("a1", "b2")]
    assert records(profile.unparseable(mapping, "a", a.pattern), "n_codes", "n_unparseable") == [(5, 2)]
    numbers = frame("n INT, c STRING", (1, "x"), (1, "y"), (1, "y"), (2, "z"), (None, "u"), (None, "v"))
    assert sorted(records(profile.collisions(numbers, "n", "c"), "n", "c", "n_codes")) == [(1, "x", 2), (1, "y", 2)]
    assert sorted(records(profile.shared_numbers(numbers, "n"), "c")) == ["x", "y", "y"]
    assert [tuple(r) for r in profile.catalog_uniqueness(numbers, "n").collect()] == [(6, 4, 2, 3)]
    codes = frame("a STRING", ("a1",), ("a2",), ("a9",), ("odd",))
    counts = profile.candidate_counts(codes, "a", a.pattern, numbers, "n")
    assert dict(records(counts, "a", "n_candidates")) == {"a1": 3, "a2": 1, "a9": 0, "odd": 0}
    assert sorted(records(profile.candidate_rows(codes, "a", a.pattern, numbers, "n"), "c")) == ["x", "y", "y", "z"]


def test_sets_and_counts(frame):
    left, right = frame("l STRING", ("a",), ("a",), ("b",), (None,)), frame("r STRING", ("b",), ("c",), ("c",))
    assert [tuple(r) for r in profile.set_comparison(left, "l", right, "r").collect()] == [(2, 2, 1, 1, 1, False)]
    assert [tuple(r) for r in profile.set_comparison(left, "l", left, "l").collect()] == [(2, 2, 2, 0, 0, True)]
    assert records(profile.missing_from(left, "l", right, "r"), "value") == ["a"]
    assert records(profile.id_uniqueness(left, "l"), "n_distinct", "n_duplicates") == [(2, 1)]
    assert records(profile.duplicate_row_count(left.where("false"), ["l"]), "n_duplicates") == [0]
    assert records(profile.sentinel_share(frame("s STRING", ("N/A",), ("n/a",), ("0",), (None,)), "s"), "sentinel_pct") == [25.0]
    assert sorted(map(str, records(profile.value_counts(left, "l"), "l", "n_rows"))) == ["('a', 2)", "('b', 1)", "(None, 1)"]
    assert profile.has_column(left, "l") and not profile.has_column(left, "store")


def test_coverage_in_window(frame):
    facts = frame("t DATE, code STRING, units BIGINT",
                  (START, "c1", 5), (START, "c2", 7), (START, "c9", 1), (START, None, 2), (START, "odd", 3),
                  (day("2024-12-31"), "c1", 100))
    catalog = frame("n BIGINT", (1,), (2,), (2,), (None,))
    df = profile.coverage_in_window(
        facts, "t", "code", r"\Ac([0-9]+)\z", "units", catalog, "n", "2025-01-01", "2025-12-31"
    )
    assert [tuple(r) for r in df.collect()] == [(5, 1, 4, 18, 5, 13)]
