"""Source divergence audit (operator 13): how the word use of the sources of a language differs, in exact whole numbers.

A language keeps the terms that enough of its documents hold. Every group (language and source) has, for each count, the set of
the terms that occur so often in it, as bits: terms are numbered by frequency, 64 to a word, and a row holds the word
of one (group, count). For a pair of groups, AND and a popcount of two words give the number of terms with one count in the one and another
in the other, a joint cell, and the divergence is the sum over all cells of its terms times the value f of the two counts.

Cells with a zero count need no bits. With f0 for a zero count, the sum over all kept terms is

    V f(0,0) + sum over counts a of the group's terms (f(a,0) - f(0,0)) + the same for the other group
      + sum over joint cells (f(a,b) - f(a,0) - f(0,b) + f(0,0))

which takes the complements from the sizes. Values are added in two parts of 32 bits, so that no partial sum overflows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mostrador.session import settle

from .common import encoded, join_unique

#: Documents of a language that hold a term before it is kept; ranks of the terms that are returned.
DOCUMENTS, TOP = 3, 200
#: Terms of which a task holds counts before it passes them on, and bytes of a text that are cut at once.
HELD, SLICE = 300_000, 1 << 20
#: Parts into which the counts of a language are dealt when they meet its groups.
DEALT = 32

# Letters (A-Z lower-cased) and all bytes beyond ASCII stay; everything else parts terms.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


def term_counts(text: str | None) -> Counter:
    """How often each term (as bytes) occurs in a text; cut in slices that end between terms."""
    data = encoded(text).translate(_LETTERS)
    found: Counter = Counter()
    start = 0
    while start < len(data):
        end = len(data) if start + SLICE >= len(data) else data.find(b" ", start + SLICE)
        end = len(data) if end < 0 else end
        found.update(data[start:end].split(b" "))
        start = end
    found.pop(b"", None)
    return found


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Count and documents of every (lang, source, term), added up as far as memory allows; an empty term for the group."""

    def rows(held: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), terms in held.items():
            items = [(b"", (0, 0)), *terms.items()]
            for k in range(0, len(items), 50_000):
                part = items[k : k + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(part), pa.string()),
                        pa.array([source] * len(part), pa.string()),
                        pa.array([t for t, _ in part], pa.binary()).cast(pa.string()),
                        pa.array([n for _, (n, _) in part], pa.int64()),
                        pa.array([d for _, (_, d) in part], pa.int64()),
                    ],
                    ["lang", "source", "term", "n", "docs"],
                )

    held: dict = {}
    size = 0
    for batch in batches:
        for lang, source, text in zip(*(batch.column(c) for c in ("lang", "source", "text"))):
            terms = held.setdefault((lang.as_py(), source.as_py()), {})
            size -= len(terms)
            for term, n in term_counts(text.as_py()).items():
                before = terms.get(term, (0, 0))
                terms[term] = (before[0] + n, before[1] + 1)
            size += len(terms)
            if size > HELD:
                yield from rows(held)
                held, size = {}, 0
    yield from rows(held)


def per_billion(count: str, total: str) -> Column:
    """1 + floor(10^9 * count / total) for count <= total, in steps of a thousand so that totals up to 9 * 10^15 do not overflow."""
    first = f"({count}) * 1000"
    second = f"(({first}) % ({total})) * 1000"
    third = f"(({second}) % ({total})) * 1000"
    return F.expr(
        f"1 + (({first}) div ({total})) * 1000000 + (({second}) div ({total})) * 1000 + (({third}) div ({total}))"
    )


def _f(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q}) div {q})"


def term_table(docs: DataFrame, least: int = DOCUMENTS) -> DataFrame:
    """(lang, source, term, n, total, lead) for the kept terms of columns lang, source and text: count in the group and in the
    language; lead marks one row of each term of a language. A row with an empty term stands for each group."""
    rows = docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")))
    raw = rows.mapInArrow(_counted, "lang string, source string, term string, n bigint, docs bigint")
    # dealt by language and term: the sums by group, those by language and the choice of terms take no further shuffle
    counts = raw.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    whole = Window.partitionBy("lang", "term")
    found = counts.select(
        "*", F.sum("docs").over(whole).alias("of_lang"), F.sum("n").over(whole).alias("total"),
        (F.min("source").over(whole) == F.col("source")).alias("lead"),
    )
    kept = found.where((F.col("term") == "") | (F.col("of_lang") >= least))
    return settle(kept.select("lang", "source", "term", "n", "total", "lead"), "terms")


def group_table(terms: DataFrame) -> DataFrame:
    """(lang, source, size, of_lang, v): occurrences of kept terms in the group and in the language, kept terms of the language;
    p0, the value of a term that the group does not hold."""
    sizes = terms.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    langs = terms.groupBy("lang").agg(
        F.sum("n").alias("of_lang"), F.sum((F.col("lead") & (F.col("term") != "")).cast("long")).alias("v")
    )
    groups = sizes.join(langs, "lang")
    return settle(groups.withColumn("p0", per_billion("1L", "greatest(size + v, 1L)")), "groups")


def top_terms(words: DataFrame, top: int = TOP) -> DataFrame:
    """Part ``term``: the terms that a group uses more than its language, by value."""
    q = words.withColumn("q", per_billion("total + 1", "of_lang + v")).where("p > q")
    valued = q.select("lang", "source", F.col("term").alias("item"), F.expr(_f("p", "q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return valued.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def count_bits(words: DataFrame) -> DataFrame:
    """(lang, chunk, source, n, p, p0, bits): the terms of a group with count n, as bits of a 64-bit word."""
    terms = words.where("lead").select("lang", "term", "total")
    ordered = terms.repartitionByRange("lang", F.desc("total"), "term").sortWithinPartitions("lang", F.desc("total"), "term")
    # the numbers are written before they are used, so that no task that runs again can give other ones
    numbers = settle(ordered.select("lang", "term", F.monotonically_increasing_id().alias("number")), "numbers")
    numbered = words.join(numbers, ["lang", "term"])
    bit = F.expr("shiftleft(1L, cast(number & 63 as int))")
    grouped = numbered.groupBy("lang", F.shiftright("number", 6).alias("chunk"), "source", "n", "p", "p0")
    return settle(grouped.agg(F.bit_or(bit).alias("bits")), "bits")


def _parts(value: Column) -> tuple[Column, Column]:
    return F.sum(F.shiftright(value, 32)).alias("high"), F.sum(value.bitwiseAND(F.lit((1 << 32) - 1))).alias("low")


def pair_values(bits: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for every ordered pair of groups of a language."""
    a, b = bits.alias("a"), bits.alias("b")
    met = a.join(b, F.expr("a.lang = b.lang AND a.chunk = b.chunk AND a.source < b.source"))
    cell = met.select(
        F.col("a.lang").alias("lang"), F.col("a.source").alias("x"), F.col("b.source").alias("y"),
        F.bit_count(F.col("a.bits").bitwiseAND(F.col("b.bits"))).cast("bigint").alias("cell"),
        F.col("a.p").alias("px"), F.col("a.p0").alias("zx"), F.col("b.p").alias("py"), F.col("b.p0").alias("zy"),
    ).where("cell > 0")
    forth = F.expr(f"cell * ({_f('px', 'py')} - {_f('px', 'zy')} - {_f('zx', 'py')} + {_f('zx', 'zy')})")
    back = F.expr(f"cell * ({_f('py', 'px')} - {_f('py', 'zx')} - {_f('zy', 'px')} + {_f('zy', 'zx')})")
    high, low = _parts(forth)
    high2, low2 = _parts(back)
    cells = cell.groupBy("lang", "x", "y").agg(high, low, high2.alias("high2"), low2.alias("low2"))

    def both(df: DataFrame) -> DataFrame:
        one = df.select("lang", F.col("x").alias("source"), F.col("y").alias("item"), "high", "low")
        return one.unionByName(df.select("lang", F.col("y").alias("source"), F.col("x").alias("item"), F.col("high2").alias("high"), F.col("low2").alias("low")))

    sized = bits.groupBy("lang", "source", "n", "p", "p0").agg(F.sum(F.bit_count("bits").cast("bigint")).alias("terms"))
    sized = sized.withColumn("part", F.pmod(F.hash("source", "n"), F.lit(DEALT)))
    others = groups.select("lang", F.col("source").alias("y"), F.col("p0").alias("zy"))
    others = others.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(DEALT - 1))))
    level = sized.join(others, ["lang", "part"]).where("source <> y").withColumnRenamed("source", "x")
    high, low = _parts(F.expr(f"terms * ({_f('p', 'zy')} - {_f('p0', 'zy')})"))
    high2, low2 = _parts(F.expr(f"terms * ({_f('zy', 'p')} - {_f('zy', 'p0')})"))
    levels = level.groupBy("lang", "x", "y").agg(high, low, high2.alias("high2"), low2.alias("low2"))

    first = groups.select("lang", F.col("source").alias("x"), F.col("p0").alias("zx"), "v")
    base = first.join(groups.select("lang", F.col("source").alias("y"), F.col("p0").alias("zy")), "lang").where("x <> y")
    empty = F.expr(f"v * {_f('zx', 'zy')}")
    base = base.select(
        "lang", F.col("x").alias("source"), F.col("y").alias("item"),
        F.shiftright(empty, 32).alias("high"), empty.bitwiseAND(F.lit((1 << 32) - 1)).alias("low"),
    )
    whole = base.unionByName(both(cells)).unionByName(both(levels)).groupBy("lang", "source", "item")
    value = F.sum("high").cast("decimal(20,0)") * F.lit(1 << 32).cast("decimal(10,0)") + F.sum("low").cast("decimal(20,0)")
    return whole.agg(value.cast("bigint").alias("value"))


def audit_sources(
    docs: DataFrame,
    text_column: str = "text",
    lang_column: str = "lang",
    source_column: str = "source",
    least: int = DOCUMENTS,
    top: int = TOP,
) -> DataFrame:
    """(lang, source, part, item, value, rank): divergence of every two sources of a language, and a source's own terms.

    Nulls in any of the three columns are empty; groups without terms take part in pairs; ties are ordered by item; repeated rows
    count each; a language without kept terms has pairs of value 0; a language of one source has no pairs; no rows give no
    rows; other columns are ignored.
    """
    named = ((text_column, "text"), (lang_column, "lang"), (source_column, "source"))
    terms = term_table(docs.select(*(F.col(f"`{old}`").alias(new) for old, new in named)), least)
    groups = group_table(terms)
    words = join_unique(terms.where("term <> ''"), groups, "lang", "source")
    words = settle(words.withColumn("p", per_billion("n + 1", "size + v")), "words")
    pairs = pair_values(count_bits(words), groups)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(order))

    def part(df: DataFrame, name: str) -> DataFrame:
        return df.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank")

    return part(pairs, "pair").unionByName(part(top_terms(words, top), "term"))
