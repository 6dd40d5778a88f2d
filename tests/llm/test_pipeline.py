"""The registered queries and the pipeline, end to end."""

import collections
import math
import os

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from checks.compare import duck
from mostrador.llm import queries, secrets, toxicity
from mostrador.session import settle

from . import brute
from .test_operators import toxic_rows

FOLDER = os.environ.get("SAMPLE_DIR", "/root/testdata/sf0.001")
sample = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no sample tables")

COLUMNS = {
    "op1": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op2": "doc_id size source_size target taken",
    "op3": "vec_id n_links component_id kept",
    "op4": "page_id url text n_chars",
    "op5": "doc_id held_out lang_pred score",
    "op6": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op7": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op8": "doc_id n_bytes n_tokens over_limit",
    "op9": "doc_id held_out score predicted",
    "op10": "doc_id fingerprint component_id",
    "op11": "vec_id code error label_error codebooks_sha256",
    "op12": "page_id host path rule verdict",
    "op13": "lang source part item value rank",
}
TABLES = {"op3": "embeddings", "op4": "pages", "op11": "embeddings", "op12": "pages", "op13": None}


def test_registered():
    names = {n.split("_")[0]: n for n in contract.queries() if n.startswith("op") and n.split("_")[0] in COLUMNS}
    assert set(names) == set(COLUMNS) and "pipeline" in contract.queries()
    assert set(queries.QUERIES) == set(names.values())


@sample
@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_whole_tables(spark, name):
    table = TABLES.get(name.split("_")[0], "documents")
    out = contract.queries()[name](spark, FOLDER)
    wanted = COLUMNS[name.split("_")[0]].split()
    assert out.columns[: len(wanted)] == wanted
    assert out.count() == spark.read.parquet(f"{FOLDER}/{table}.parquet").count() if table else out.count() > 0


@sample
@pytest.mark.parametrize("name", ["op1_secret_scans", "op2_mix_sources"])
def test_native_plans_hold_no_python(spark, name):
    plan = contract.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


@sample
@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql(spark, name):
    out = contract.queries()[name](spark, FOLDER)
    columns = sorted(out.columns)
    cursor = duck(FOLDER).execute(queries.ORACLE[name])
    names = [c[0] for c in cursor.description]
    theirs = [tuple(r[names.index(c)] for c in columns) for r in cursor.fetchall()]
    assert sorted((tuple(r[c] for c in columns) for r in out.collect()), key=repr) == sorted(theirs, key=repr)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory, prose):
    """Tables with toxic texts, copies, passages of the benchmark and secrets, in three sources of different sizes."""
    root = str(tmp_path_factory.mktemp("corpus"))
    rows, labels = toxic_rows()
    rows = [(i, text, lang, "abc"[min(i % 5, 2)]) for i, text, lang, _ in rows]
    items = [(i, prose(20, 900 + i)) for i in range(5)]
    for i in range(0, 40, 4):
        rows.append((2000 + i, rows[i + 1][1], "en", "b"))  # copies of clean texts
    rows += [(3000 + i, f"{prose(30, i)} {items[i][1].upper()} {prose(30, 50 + i)}", "en", "a") for i in range(5)]
    rows += [(4000 + i, f"{prose(40, 70 + i)} token=abc{i}def{i}00 {prose(5, 90 + i)}", "en", "c") for i in range(5)]
    rows += [(5000, None, "en", None), (5001, "", "en", "a"), rows[0]]
    for name, schema, data in (
        ("documents", "doc_id bigint, text string, lang string, source string, n_chars bigint", [(*r, len(r[1] or "")) for r in rows]),
        ("labels", "doc_id bigint, quality int, toxic int", [r[:3] for r in labels]),
        ("benchmark", "item_id bigint, text string", items),
    ):
        spark.createDataFrame(data, schema).write.parquet(f"{root}/{name}.parquet")
    return root


def test_pipeline_against_plain_version(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = toxicity.learn(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    rows = [tuple(r) for r in docs.collect()]
    expected = {}
    clean = [r for r, score in zip(rows, model.scores([r[1] for r in rows])) if score < toxicity.THRESHOLD]
    expected["toxicity"] = collections.Counter(r[0] for r in clean)
    by_id = {r[0]: r for r in clean}
    groups = brute.simhash_groups({i: r[1] for i, r in by_id.items()})
    by_id = {i: r for i, r in by_id.items() if groups[i][1] == i}
    expected["simhash"] = collections.Counter(by_id.keys())
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    hits = brute.contamination({i: r[1] for i, r in by_id.items()}, items)
    by_id = {i: r for i, r in by_id.items() if not hits[i][1]}
    expected["decontamination"] = expected["secrets"] = collections.Counter(by_id.keys())

    found = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = settle(stage(spark, docs, folder), name)
        if name != "mixing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            assert collections.Counter(r.doc_id for r in docs.collect()) == expected[name], name
        found[name] = docs
    assert len(expected["toxicity"]) < len(rows) and len(expected["simhash"]) < len(expected["toxicity"])
    assert len(by_id) < len(expected["simhash"])

    text = {r.doc_id: r.text for r in found["secrets"].collect()}
    for i, r in by_id.items():
        counts, listed = brute.base_secrets(r[1])
        assert ("[SECRET]" in (text[i] or "")) == bool(listed) or not listed
        if not listed:
            assert text[i] == r[1]
        for span in listed:
            _, a, b = span.split(":")
            assert r[1][int(a) : int(b)] not in text[i]

    size = collections.Counter()
    for i, r in by_id.items():
        size[r[3]] += len((text[i] or "").split())
    target = brute.targets(size)
    copies = collections.Counter(r.doc_id for r in found["mixing"].collect())
    for i, r in by_id.items():
        rate = target[r[3]] / size[r[3]] if size[r[3]] else 0
        assert copies[i] in (math.floor(rate), math.floor(rate) + 1)
    for source in "abc":
        taken = sum(len((text[i] or "").split()) * copies[i] for i, r in by_id.items() if r[3] == source)
        assert taken == pytest.approx(target[source], rel=0.1)


def test_run(spark, folder):
    out = corpus_pipeline.run(spark, folder)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "copy"] and out.count() > 0


def test_extra_columns_and_empty_tables(spark, folder, documents):
    docs = documents([(1, "a b c", "en", "a"), (2, None, "en", None), (None, "x", None, "b")])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns
        assert stage(spark, docs.limit(0), folder).count() == 0
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert mixed.columns[:-1] == docs.columns and "copy" in mixed.columns[-1]
    assert secrets.redact(docs).count() == 3


def test_run_leaves_one_table(spark, folder):
    from mostrador.session import shared_folder

    def tables():
        where = f"{shared_folder(spark).rstrip('/').removeprefix('file:')}/mostrador"
        return set(os.listdir(where)) if os.path.isdir(where) else set()

    before = tables()
    out = corpus_pipeline.run(spark, folder)
    made = tables() - before
    assert len(made) == 1 and made.pop().startswith("corpus-mixing-") and out.count() > 0
