"""Vector codes, URL filters and the divergence of sources, against plain versions."""

import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from mostrador.llm import common, divergence, url_filter, vector_codes
from mostrador.llm.url_filter import RULES, Rule

from . import brute

# vector codes


def vectors(spark, rows):
    schema = "vec_id bigint, label int, embedding array<double>, code string, v string, error string, right_label string"
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], schema)


def clusters(n, size, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(9, size))
    return [(centres[rng.integers(9)] + 0.2 * rng.normal(size=size)).tolist() for _ in range(n)]


@pytest.mark.parametrize("size", [8, 24, 64])
def test_vector_codes(spark, size):
    rng = random.Random(size)
    made = clusters(150, size, size)
    rows = [(i, rng.choice([1, 2, None]), v) for i, v in enumerate(made)]
    rows += [rows[3], (rows[5][0], 7, made[6]), (None, 1, made[8]), (900, 1, None), (901, 1, [None, *made[0][1:]])]
    rows += [(902, 2, [float("nan"), *made[0][1:]]), (-1, 2, [float("inf"), *made[0][1:]]), (903, None, [0.0] * size)]
    expected, digest = brute.vector_codes(rows)
    out = vector_codes.compress(vectors(spark, rows)).collect()
    assert Counter((r.vec_id, r.label, r.code, r.error, r.label_error) for r in out) == Counter(
        (rows[i][0], rows[i][1], *v) for i, v in expected.items()
    )
    assert {r.codebooks_sha256 for r in out} == {digest}


def test_vector_codes_of_few_and_odd_vectors(spark):
    assert vector_codes.compress(vectors(spark, [(1, 1, None)])).count() == 0
    assert vector_codes.compress(vectors(spark, [])).columns == [
        "vec_id", "label", "code", "error", "label_error", "codebooks_sha256"
    ]
    few = [(i, 1, v) for i, v in enumerate(clusters(3, 8, 1))]
    expected, digest = brute.vector_codes(few)
    assert {r.vec_id: (r.code, r.error, r.label_error) for r in vector_codes.compress(vectors(spark, few)).collect()} == expected
    # shorter vectors and lengths that do not divide: as if padded with zeros
    rows = [(1, 1, []), (2, 1, [0.5] * 5), (3, 1, clusters(1, 13, 2)[0])]
    padded = [(i, la, v + [0.0] * (16 - len(v))) for i, la, v in rows]
    expected, digest = brute.vector_codes(padded)
    out = vector_codes.compress(vectors(spark, rows)).collect()
    assert {r.vec_id - 1: (r.code, r.error, r.label_error) for r in out} == expected and out[0].codebooks_sha256 == digest
    with pytest.raises(Exception, match="component too large"):
        vector_codes.compress(vectors(spark, [(1, 1, [1e300] * 8)])).collect()


@settings(deadline=None, max_examples=200)
@given(st.integers(1, 17), st.integers(1, 16), st.sampled_from([1, 3, 5000, 1 << 26, 1 << 40]), st.integers(0, 10**9))
def test_elimination_is_exact(size, entries, peak, seed):
    rng = np.random.default_rng(seed)
    parts, book = rng.integers(-peak, peak + 1, (40, size)), rng.integers(-peak, peak + 1, (entries, size))
    book[-1] = book[0]
    index, distance = vector_codes.nearest(parts, book)
    for x, k, d in zip(parts.tolist(), index, distance):
        every = [sum((a - b) ** 2 for a, b in zip(x, e)) for e in book.tolist()]
        assert (d, k) == (min(every), every.index(min(every)))


@pytest.mark.parametrize("length", [1, 2, 8, 32])
def test_sequency(length):
    rows = vector_codes.walsh(np.eye(length, dtype=np.int64)).T
    assert ((rows @ rows.T) == length * np.eye(length)).all()
    assert [(np.diff(r) != 0).sum() for r in rows] == list(range(length))


def test_hot_and_null_keys_meet_once(spark):
    keys = ["hot"] * 300 + [None] * 200 + [f"k{i}" for i in range(400)]
    left = common.settle(spark.createDataFrame(list(enumerate(keys)), "n int, k string"), "left")
    right = spark.createDataFrame([(k, (k or "none") + "!") for k in {*keys[:600], "other"}], "k string, value string")
    out = common.join_unique(left, right, "k")
    assert out.columns == ["n", "k", "value"]
    expected = {i: None if i >= 600 else (k or "none") + "!" for i, k in enumerate(keys)}
    assert {r.n: r.value for r in out.collect()} == expected and out.count() == len(keys)


# URL filters


def pages(spark, rows):
    schema = "page_id bigint, url string, html string, host string, rule string, key string, alias string, id string"
    return spark.createDataFrame([(*r, *["x"] * 5) for r in rows], schema)


ADDRESSES = [
    None, "", "no address", "http://", "http://net", "http://a.net/", "http://A.B.Net/x?y#z", "https://example.net/en/1",
    "https://www.example.net/en", "http://m.EXAMPLE.com/de/?q=http://b.net/", "http://example.com/DE/", "http://notexample.com/de/1",
    "http://x.org/fr/1", "http://org/fr/", "http://x.org/en/", "http://example.com?x=/de/", "x?u=http://c.net/1", "http://é.net/ü",
    "http://\n.net/\n/", "http://user:1@h.net:80/p", "ftp://example.com#/de/", "http://example.com/fr/1", "http://İ.org/fr/",
]


@pytest.mark.parametrize("in_plan", [500, 0])
def test_rules(spark, monkeypatch, in_plan):
    monkeypatch.setattr(url_filter, "IN_PLAN", in_plan)
    rules = [*RULES, Rule("example.com", "/de/1/", "allow"), Rule("com", "/de/1/2/3/4/5/6", "block")]
    addresses = [*ADDRESSES, "http://example.com/de/1/2/3/4/5/6", "http://example.com/de/1/2", *["http://hot.net/"] * 50]
    out = url_filter.judge_urls(pages(spark, [(i, u, "<p>x") for i, u in enumerate(addresses)]), rules)
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in out.collect()}
    assert found == dict(enumerate(brute.judge_urls(addresses, [], rules)))


def test_aliases(spark):
    rng = random.Random(4)
    hosts = ["a.example.com", "b.org", "c.net", "example.net", "d.info", "e.info"]
    addresses = [f"http://{rng.choice(hosts)}/{rng.choice(['en', 'de', 'fr'])}/{i}" for i in range(120)]
    links = [tuple(rng.sample(addresses, 2)) for _ in range(45)] + [(a, "http://hub.info/") for a in addresses[:30]]
    links += [(addresses[50], "http://only.target.net/x"), (addresses[51], addresses[51] + "#part")]
    redirects, inside = links[::2], links[1::2]
    forms = (
        '<html><head><link rel="canonical" href="{}"></head>',
        "<LINK href='{}' class=x rel='nofollow Canonical'/>",
        '<meta http-equiv="Refresh" content="0; URL={}">',
        '<meta content="5;{}" http-equiv=refresh>',
    )
    pages_of = {}
    for k, (a, b) in enumerate(inside):
        pages_of[a] = pages_of.get(a, "") + forms[k % 4].format(b)
    rows = [(i, a, pages_of.get(a, "canonical" if i % 2 else None)) for i, a in enumerate(addresses)]
    rows += [(500, addresses[0], None), (501, None, '<link rel=canonical href="http://c.net/1">')]
    table = spark.createDataFrame(redirects + [(None, "http://c.net/"), ("x", "y")], "from_url string, to_url string")
    out = {r.page_id: r for r in url_filter.judge_urls(pages(spark, rows), redirects=table).collect()}
    expected = brute.judge_urls([r[1] for r in rows], links, RULES)
    assert [(out[r[0]].host, out[r[0]].path, out[r[0]].rule, out[r[0]].verdict) for r in rows] == expected
    assert any(r.alias for r in out.values()) and all(r.rule is None and r.verdict == "block" for r in out.values() if r.alias)


def test_allow_goes_before_block(spark):
    link = '<link rel="canonical" href="{}">'
    rows = [
        (1, "http://x.info/1", link.format("http://bad.net/1")),
        (2, "http://x.info/2", link.format("http://bad.net/2")),
        (3, "http://good.org/fr/2", link.format("http://x.info/2")),
        (4, "http://bad.net/2", None),
        (5, "http://x.info/5", "<!-- " + link.format("http://bad.net/5") + "-->"),
    ]
    out = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge_urls(pages(spark, rows)).collect()}
    assert out == {
        1: (None, "block"), 2: (None, "allow"), 3: ("org/fr/", "allow"), 4: ("net/", "block"), 5: (None, "allow")
    }
    assert url_filter.judge_urls(pages(spark, [])).count() == 0


def test_declared():
    says = lambda page, url="http://a.b/c/d?e": url_filter.declared(page, url)
    link = "<link rel=canonical href={}>"
    assert says(link.format("../x?y&amp;z")) == ["http://a.b/x?y&z"]
    assert says(link.format("//o.p/")) == ["http://o.p/"]
    assert says("<base href='http://q.r/s/'>" + link.format("t")) == ["http://q.r/s/t"]
    assert says("<script>'" + link.format("/x") + "'</script><!--" + link.format("/y") + "-->" + link.format("/z")) == ["http://a.b/z"]
    assert says("<script>" + link.format("/x")) == [] == says("<!-- " + link.format("/x")) == says("<link rel=canonical>")
    assert says(link.format("http://[x/")) == [] == says("<links rel=canonical href=/x>") == says('<meta http-equiv=refresh content=5>')
    for odd in ("<link " * 50_000, "<link rel='" * 50_000, "<link " + " " * 200_000, "<!--" * 100_000, "<link a=\"" * 50_000, "<script>" * 50_000):
        assert says(odd) == []


# divergence of sources


def test_divergence(spark, documents):
    rng = random.Random(8)
    words = [f"{chr(97 + k % 26)}{'xyz'[k % 3]}{chr(97 + k // 26)}" for k in range(300)] + ["Über", "über", "日本", "İ", "﻿a", "été"]
    rows = []
    for _ in range(160):
        lang, source = rng.choice(["en", "en", "en", "de", "", None]), rng.choice(["s0", "s0", "s1", "é", "Z", "", None])
        some = [rng.choice(words[: rng.choice([5, 60, 306])]) for _ in range(rng.randint(0, 60))]
        rows.append((rng.choice([" ", ", ", "1", "\x00"]).join(some).swapcase() if rng.random() < 0.9 else None, lang, source))
    rows += [(None, "xx", "alone"), ("", "yy", "a"), ("rare words", "yy", "b"), rows[0], rows[0], ("only " * 9, "one", "s")]
    rows += [("same same", "zz", s) for s in "abc"] + [("1 2 _", "zz", "d")]
    out = divergence.audit_sources(documents([(i, *r) for i, r in enumerate(rows)]))
    assert sorted(map(tuple, out.collect())) == brute.divergence(rows)
    assert out.dtypes[-2:] == [("value", "bigint"), ("rank", "int")]


def test_divergence_ranks_and_pieces(spark, documents, prose, monkeypatch):
    monkeypatch.setattr(divergence, "SLICE", 50)
    monkeypatch.setattr(divergence, "HELD", 100)
    rows = [(prose(400, k, 900), "en", f"s{k % 4}") for k in range(24)]
    frame = documents([(i, *r) for i, r in enumerate(rows)])
    assert sorted(map(tuple, divergence.audit_sources(frame, top=7, least=2).collect())) == brute.divergence(rows, 2, 7)
    assert divergence.audit_sources(frame.where("false")).count() == 0


def test_per_billion_of_large_counts(spark):
    cases = [(1, 1), (0, 7), (10**12 + 7, 10**13 + 9), (8 * 10**15, 9 * 10**15), (9 * 10**15, 9 * 10**15)]
    frame = spark.createDataFrame(cases, "a bigint, b bigint").select("a", "b", divergence.per_billion("a", "b").alias("p"))
    assert all(r.p == 1 + 10**9 * r.a // r.b for r in frame.collect())


def test_longest_counts():
    assert divergence.term_counts(None) == {} == divergence.term_counts("12 _")
    assert divergence.term_counts("Ab aB é1É") == {b"ab": 2, "é".encode(): 1, "É".encode(): 1}
    assert divergence.term_counts("long" * 600_000 + " x") == {b"long" * 600_000: 1, b"x": 1}
