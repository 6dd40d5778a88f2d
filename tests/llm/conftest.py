import random

import pytest

#: Columns that documents may have besides their own, under names the operators use themselves.
CLASHING = ("id", "tie", "size", "score", "copies", "copy", "spans", "fp", "row", "n_words", "anchor", "place", "found", "component_id")


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source), with columns of clashing names."""

    def make(rows, clashing=True):
        full = [(*r, *("en", "s0")[len(r) - 2 :]) if len(r) < 4 else tuple(r) for r in rows]
        schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
        data = [(*r, len(r[1]) if r[1] is not None else None) for r in full]
        if clashing:
            schema += "".join(f", {c} string" for c in CLASHING)
            data = [(*r, *(["x"] * len(CLASHING))) for r in data]
        return spark.createDataFrame(data, schema)

    return make


@pytest.fixture(scope="session")
def prose():
    def make(n, seed, words=400):
        """``n`` words from a small vocabulary."""
        rng = random.Random(seed)
        known = ["".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randint(2, 9))) for _ in range(words)]
        return " ".join(rng.choice(known) for _ in range(n))

    return make
