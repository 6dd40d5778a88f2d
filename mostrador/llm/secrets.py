"""Secret scans (operator 1), by DataFrame functions alone.

Three fixed patterns find assignments, access keys and hexadecimal strings. On top of them every candidate
string (a long run of one character class) is scanned by a window: the counts of the characters in it are kept as
it moves by one, and with them the Shannon entropy. Windows at or above the class's entropy are joined to spans; spans
that an allow-list pattern matches whole (plain words, numbers, UUIDs) are left out, and so are those of which little is
left without the surroundings of a word that marks an example.

Expressions that a lambda uses for every element are bound first (``_let``), and windows and running sums are made in blocks,
so that time grows in proportion to a text, also where it is one long run.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh

# The patterns of the contract. A run of the last two that is shorter than its bound cannot hide a longer
# match, so the bound may stand in the pattern.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGNED = 6  # least characters of the value
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"


@dataclass(frozen=True)
class Class:
    """A character class whose long runs are candidates."""

    kind: str
    alphabet: str
    pattern: str  # the same as a range list
    window: int
    entropy: float  # bits a character, of the window


DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
CLASSES = (
    Class("entropy_hex", DIGITS + "abcdef", "0-9a-f", 20, 3.0),
    Class("entropy_hexupper", DIGITS + "ABCDEF", "0-9A-F", 20, 3.0),
    Class("entropy_base64", UPPER + LOWER + DIGITS + "+/_-", "A-Za-z0-9+/_-", 20, 3.8),
)
#: Spans that one of these matches whole are no secrets.
ALLOWED = (
    r"[A-Za-z_/+-]+",  # words, paths
    r"[0-9_/+-]+",  # numbers, dates
    r"[A-Za-z]+[0-9]{1,4}",  # numbered names
    r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",  # UUIDs
)
#: Words that mark an example, with what belongs to them: the piece between / _ - that they stand in, as far as it is near.
NEAR = 20
MARKED = f"[^/_-]{{0,{NEAR}}}(?i:example|sample|dummy|placeholder|xxxx)[^/_-]{{0,{NEAR}}}"
BLOCK = 512  # matches, or positions of a window, of one block

SPAN = "array<struct<start:int,kind:int,end:int>>"
KINDS = ("assign", "access", "hex")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once however often and in whatever lambda the body uses it."""
    return F.get(F.transform(F.array(value), body), 0)


def _blocks(first: int | Column, last: Column) -> Column:
    """The starts of the blocks from ``first`` to ``last``; one at least."""
    first = F.lit(first) if isinstance(first, int) else first
    return F.sequence(first, F.greatest(last, first), F.lit(BLOCK))


def _scan(values: Column, add: Callable[[Column, Column], Column]) -> Column:
    """For each element of an array of whole numbers what ``add`` makes, from 0, of those before it."""

    def before(part: Column, first: Column) -> Column:
        start = F.struct(first.alias("at"), F.array().cast("array<int>").alias("out"))
        step = F.aggregate(
            part, start, lambda s, n: F.struct(add(s["at"], n).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out"))
        )
        return step["out"]

    def joined(blocks: Column) -> Column:
        firsts = before(F.transform(blocks, lambda part: F.aggregate(part, F.lit(0), add)), F.lit(0))
        return F.flatten(F.zip_with(blocks, firsts, lambda b, f: before(b, f)))

    return _let(values, lambda all_: _let(_in_blocks(all_), joined))


def _in_blocks(values: Column) -> Column:
    return F.transform(_blocks(1, F.size(values)), lambda i: F.slice(values, i, BLOCK))


def _matches(text: Column, pattern: str) -> Column:
    """The leftmost matches that do not overlap: array of (start, end, match), code points, end exclusive."""

    def found(hits: Column) -> Column:
        gaps = F.slice(F.transform(F.split(text, pattern, -1), F.length), F.lit(1), F.size(hits))
        # gap, hit, gap, hit: what precedes hit i is the first i gaps and hits, and its own gap
        sizes = F.zip_with(gaps, hits, lambda g, h: F.struct(g.alias("gap"), F.length(h).alias("hit")))

        def placed(both: Column) -> Column:
            before = _scan(F.transform(both, lambda x: x["gap"] + x["hit"]), lambda a, b: a + b)
            starts = F.zip_with(before, both, lambda b, x: b + x["gap"])
            return F.zip_with(
                starts, hits, lambda s, h: F.struct(s.alias("start"), (s + F.length(h)).alias("end"), h.alias("match"))
            )

        return _let(sizes, placed)

    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.when(text.rlike(pattern), _let(hits, found)).otherwise(F.array().cast("array<struct<start:int,end:int,match:string>>"))


def _spans(found: Column, kind: int) -> Column:
    return F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end")))


def base_spans(text: Column) -> tuple[Column, Column, Column]:
    """Spans of assignments, access keys and hexadecimal strings."""
    value = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    pairs = F.arrays_zip(_matches(text, ASSIGN).alias("m"), value.alias("v"))
    long_ones = F.transform(F.filter(pairs, lambda p: F.length(p["v"]) >= ASSIGNED), lambda p: p["m"])
    assign = F.when(text.rlike(ASSIGN), _spans(long_ones, 0)).otherwise(F.array().cast(SPAN))
    return assign, _spans(_matches(text, ACCESS), 1), _spans(_matches(text, HEX), 2)


def entropy_windows(candidate: Column, group: Class) -> Column:
    """Joined windows of a candidate string whose entropy reaches the class's bound: array of (start, end).

    With c the count of a character in the window of w, its entropy is log2 w - sum(c log2 c) / w. The counts and
    that sum change by one character that leaves and one that enters. Blocks of windows are read on their own, each with the w
    windows before and after it: those tell whether the first or the last high window of the block begins or ends a span.
    """
    w = group.window
    # in units of 2^-32 bits, so that a window weighs the same in every block
    table = F.array(*(F.lit(round(c * math.log2(c) * 2**32) if c else 0).cast("long") for c in range(w + 2)))
    heaviest = math.floor((math.log2(w) - group.entropy) * w * 2**32)
    places = F.transform(F.split(candidate, ""), lambda c: F.instr(F.lit(group.alphabet), c) - 1)
    places = F.filter(places, lambda p: p >= 0)
    nothing = F.array().cast("array<int>")

    def change(count: Column, by: int) -> Column:
        return F.get(table, count + by) - F.get(table, count)

    def block(all_: Column, first: Column) -> Column:
        """Starts and ends of spans among the windows that end at first ... first + BLOCK - 1."""
        begin = F.greatest(first - 2 * w, F.lit(0))  # characters from here on
        part = F.slice(all_, begin + 1, first + BLOCK + w - 1 - begin)

        def within(at: Column) -> Column:
            return (at >= first) & (at < first + BLOCK)

        def step(state: Column, pair: Column) -> Column:
            counts, last = state["counts"], state["last"]
            at, come, go = pair["at"], pair["come"], pair["go"]
            weight = state["weight"] + F.when(go >= 0, change(F.get(counts, go), -1)).otherwise(F.lit(0).cast("long"))
            weight = weight + F.when(come == go, -change(F.get(counts, come), -1)).otherwise(change(F.get(counts, come), 1))
            moved = F.when(come == go, counts).otherwise(
                F.transform(counts, lambda c, j: F.when(j == come, c + 1).when(j == go, c - 1).otherwise(c))
            )
            high = (at - begin >= w) & (weight <= heaviest)
            opens = high & (at - last > w)
            return F.struct(
                moved.alias("counts"),
                weight.alias("weight"),
                F.when(high, at).otherwise(last).alias("last"),
                F.when(opens & within(at), F.concat(state["starts"], F.array(at - w))).otherwise(state["starts"]).alias("starts"),
                F.when(opens & within(last), F.concat(state["ends"], F.array(last))).otherwise(state["ends"]).alias("ends"),
            )

        def closed(state: Column) -> Column:
            ends = F.when(within(state["last"]), F.concat(state["ends"], F.array(state["last"]))).otherwise(state["ends"])
            return F.struct(state["starts"].alias("starts"), ends.alias("ends"))

        start = F.struct(
            F.array_repeat(F.lit(0), len(group.alphabet)).alias("counts"),
            F.lit(0).cast("long").alias("weight"),
            F.lit(-2 * w).alias("last"),
            nothing.alias("starts"),
            nothing.alias("ends"),
        )

        def scanned(chars: Column) -> Column:
            pairs = F.transform(
                chars,
                lambda p, j: F.struct(
                    (begin + j + 1).alias("at"), p.alias("come"), F.when(j >= w, F.get(chars, j - w)).otherwise(-1).alias("go")
                ),
            )
            return F.aggregate(pairs, start, step, closed)

        return _let(part, scanned)

    def spans(found: Column) -> Column:
        ends = F.flatten(F.transform(found, lambda b: b["ends"]))
        return F.zip_with(
            F.flatten(F.transform(found, lambda b: b["starts"])), ends, lambda s, e: F.struct(s.alias("start"), e.alias("end"))
        )

    return _let(places, lambda all_: _let(F.transform(_blocks(w, F.size(all_)), lambda i: block(all_, i)), spans))


def _allowed(value: Column, allowed: tuple) -> Column:
    return value.rlike("^(?:" + "|".join(allowed) + ")$")


def _marked(value: Column, least: int, allowed: tuple) -> Column:
    """True for an example: without the surroundings of the marks too little is left, or nothing but words and numbers."""
    rest = F.regexp_replace(value, MARKED, "")
    return value.rlike(MARKED) & ((F.length(rest) < least) | _allowed(rest, allowed))


def entropy_spans(text: Column, group: Class, kind: int, allowed: tuple = ALLOWED) -> Column:
    """Spans of high entropy in the candidates of one class, less what the allow-list matches and marked examples."""
    pattern = f"[{group.pattern}]{{{group.window},}}"
    candidates = F.filter(_matches(text, pattern), lambda m: ~_allowed(m["match"], allowed))

    def within(found: Column) -> Column:
        windows = entropy_windows(found["match"], group)

        def cut(span: Column, more: int = 0) -> Column:
            start = F.greatest(span["start"] - more, F.lit(0))
            return F.substring(found["match"], start + 1, span["end"] + more - start)

        kept = F.filter(windows, lambda s: ~_allowed(cut(s), allowed) & ~_marked(cut(s, NEAR), group.window, allowed))
        return F.transform(
            kept,
            lambda s: F.struct(
                (found["start"] + s["start"]).alias("start"), F.lit(kind).alias("kind"), (found["start"] + s["end"]).alias("end")
            ),
        )

    return F.when(text.rlike(pattern), F.flatten(F.transform(candidates, within))).otherwise(F.array().cast(SPAN))


def secret_spans(text: Column, classes: tuple = CLASSES, allowed: tuple = ALLOWED) -> Column:
    """All spans of a text, base spans first by kind: struct of base and added, arrays of (start, kind, end)."""
    assign, access, hexadecimal = base_spans(text)
    added = [entropy_spans(text, group, len(KINDS) + i, allowed) for i, group in enumerate(classes)]
    return F.struct(
        assign.alias("assign"), access.alias("access"), hexadecimal.alias("hex"),
        (F.concat(*added) if added else F.array().cast(SPAN)).alias("added"),
    )


def _listed(spans: Column, classes: tuple) -> Column:
    names = F.array(*(F.lit(k) for k in (*KINDS, *(c.kind for c in classes))))
    line = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])
    return F.array_join(F.transform(F.array_sort(spans), line), ",")


def scan_secrets(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", classes: tuple = CLASSES, allowed: tuple = ALLOWED
) -> DataFrame:
    """One row per row of ``docs``: id, n_assign, n_access, n_hex, base_sha256, spans, n_added.

    Spans are kind:start:end in code points, end exclusive, by start and kind. A null or empty text has none; ids may be
    null or repeated; no rows give no rows; other columns are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").alias("text"))
    rows = rows.select("id", secret_spans(text, classes, allowed).alias("s"))
    base = F.concat("s.assign", "s.access", "s.hex")
    return rows.select(
        F.col("id").alias(id_column),
        *(F.size(f"s.{k}").cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(_listed(base, classes), 256).alias("base_sha256"),
        _listed(F.concat(base, "s.added"), classes).alias("spans"),
        F.size("s.added").cast("long").alias("n_added"),
    )


def redact(
    docs: DataFrame, text_column: str = "text", mark: str = "[SECRET]", classes: tuple = CLASSES, allowed: tuple = ALLOWED
) -> DataFrame:
    """``docs`` with every span in the text replaced by ``mark``; spans that meet are one. Nulls stay null.

    A column n_chars, if there is one, gets the new length.
    """
    text, name = F.col(f"`{text_column}`"), fresh(docs, "secret_spans")
    found = docs.withColumn(name, secret_spans(F.coalesce(text, F.lit("")), classes, allowed))
    spans = F.array_sort(F.concat(*(F.col(f"{name}.{k}") for k in (*KINDS, "added"))))

    def pieces(part: Column) -> Column:
        """The text between the spans of a block, each with a mark; cut from the block's own stretch of the text."""
        first = F.get(part, 0)["at"]
        stretch = F.substring(text, first + 1, F.get(part, F.size(part) - 1)["until"] - first)
        cut = lambda s: F.transform(
            part, lambda c: F.concat(F.substring(s, c["at"] - first + 1, c["until"] - c["at"]), F.lit(mark))
        )
        return F.array_join(_let(stretch, cut), "")

    def whole(all_: Column) -> Column:
        # what precedes a span begins where all spans before it have ended; a span that begins earlier adds nothing
        ended = _scan(F.transform(all_, lambda s: s["end"]), lambda a, b: F.greatest(a, b))
        gaps = F.zip_with(all_, ended, lambda s, e: F.struct(e.alias("at"), s["start"].alias("until")))
        apart = F.filter(gaps, lambda c, i: (c["until"] > c["at"]) | (i == 0))
        marked = _let(apart, lambda kept: F.array_join(F.transform(_in_blocks(kept), pieces), ""))
        last = F.array_max(F.transform(all_, lambda s: s["end"]))
        return F.concat(marked, F.substring(text, last + 1, F.length(text)))

    cleaned = F.when(F.size(spans) > 0, _let(spans, whole)).otherwise(text)
    out = found.withColumn(text_column, cleaned).drop(name)
    return out.withColumn("n_chars", F.length(text_column).cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
