"""SimHash near-duplicates by multi-index hashing (operator 10).

A text's fingerprint has bit i set when more than half of its shingles' XXH64 values have it set. Equal fingerprints
are one entry. Two entries within 2 bits differ by (high half, low half) = (0, <= 2), (<= 2, 0) or (1, 1), so the
index has a table for each 32-bit half: an entry looks up its own high half, its own low half, and the high halves one bit away
(only 0 turned to 1, so that each pair is met from one side), and whole distances are verified.

A half that more than ``BUCKET`` entries share would make that many candidates for each of them. Such look-ups carry
on instead: they enumerate the remaining bits in the other half as well and look up whole fingerprints. That meets
only pairs that are within the distance, of which an entry has at most 2080, so nothing has to be cut off.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mostrador.session import settle

from .common import encoded, fresh, hash_of_row, narrow, word_lists
from .components import components

#: Entries that may share a half before look-ups into it go on to whole fingerprints.
BUCKET = 256
#: XXH64 seed of the shingles.
SEED = 42
#: Largest number of differing bits of two linked fingerprints; the look-ups below are those of 2 bits.
DISTANCE = 2


def text_fingerprint(text: str | None, shingle: int) -> int:
    """Unsigned 64-bit fingerprint of a text; 0 for a text without words."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    ones, total, carry = np.zeros(64, np.int64), 0, []
    for words in word_lists(encoded(text).lower()):
        words = carry + words
        if len(words) >= shingle:
            hashes = [digest(b" ".join(words[i : i + shingle]), SEED) for i in range(len(words) - shingle + 1)]
            bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int64)
            total += len(hashes)
            carry = words[len(words) - shingle + 1 :]
        else:
            carry = words
    if not total and carry:
        return digest(b" ".join(carry), SEED)
    return int(np.packbits(ones * 2 > total, bitorder="little").view("<u8")[0]) if total else 0


def fingerprint(text: Column | str, shingle: int = 3) -> Column:
    """Fingerprint as a BIGINT with the same 64 bits."""

    @F.pandas_udf("long")
    def fingerprints(texts: pd.Series) -> pd.Series:
        values = np.fromiter((text_fingerprint(t, shingle) for t in texts), dtype="<u8", count=len(texts))
        return pd.Series(values.view("<i8"))

    return fingerprints(text)


def _flips(value: Column, bits: str) -> Column:
    """``value`` with each of the 0-bits among ``bits`` (a SQL sequence of bit numbers) turned to 1."""
    masks = F.transform(F.expr(bits), lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), i))
    return F.transform(F.filter(masks, lambda m: value.bitwiseAND(m) == 0), lambda m: value.bitwiseOR(m))


HIGH, LOW = "sequence(32, 63)", "sequence(0, 31)"


def _masks(first: int) -> Column:
    """The 1-bit and 2-bit masks within the 32 bits from ``first`` on."""
    one = f"transform(sequence({first}, {first + 31}), i -> shiftleft(1L, i))"
    two = (
        f"flatten(transform(sequence({first}, {first + 30}), i -> "
        f"transform(sequence(i + 1, {first + 31}), j -> shiftleft(1L, i) | shiftleft(1L, j))))"
    )
    return F.expr(f"concat({one}, {two})")


def close_pairs(entries: DataFrame) -> DataFrame:
    """(a, b) for all pairs of distinct fingerprints (column fp, no repeats) within 2 bits, each once or more."""
    halves = entries.select(
        "fp", F.shiftrightunsigned("fp", 32).alias("hi"), F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)).alias("lo")
    )
    hot_hi = settle(halves.groupBy("hi").count().where(F.col("count") > BUCKET).select("hi"), "hot-hi")
    hot_lo = settle(halves.groupBy("lo").count().where(F.col("count") > BUCKET).select("lo"), "hot-lo")
    any_hi, any_lo = not hot_hi.isEmpty(), not hot_lo.isEmpty()
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= DISTANCE

    cold_hi = halves.join(hot_hi, "hi", "left_anti") if any_hi else halves
    cold_lo = halves.join(hot_lo, "lo", "left_anti") if any_lo else halves
    by_hi = cold_hi.select("hi", F.col("fp").alias("b"))
    by_lo = cold_lo.select("lo", F.col("fp").alias("b"))
    # own high half, and the high halves one bit away
    ask_hi = halves.select(F.col("fp").alias("a"), F.explode(F.concat(F.array("hi"), _flips(F.col("hi"), LOW))).alias("hi"))
    ask_lo = halves.select(F.col("fp").alias("a"), "lo")
    found = [
        ask_hi.join(by_hi, "hi")
        .where(near & ((F.col("a") < F.col("b")) | (F.shiftrightunsigned("a", 32) != F.col("hi"))))
        .select("a", "b"),
        ask_lo.join(by_lo, "lo").where((F.col("a") < F.col("b")) & near).select("a", "b"),
    ]
    whole = entries.select(F.col("fp").alias("b"))
    asked = []
    if any_hi:
        own = halves.join(hot_hi, "hi", "left_semi").select("fp", F.explode(_masks(0)).alias("m"))
        asked.append(own.select(F.col("fp").alias("a"), F.col("fp").bitwiseXOR(F.col("m")).alias("b")).where("a < b"))
        step = halves.select("fp", "lo", F.explode(_flips(F.col("hi"), LOW)).alias("hi")).join(hot_hi, "hi", "left_semi")
        step = step.select("fp", F.shiftleft("hi", 32).bitwiseOR(F.col("lo")).alias("x"), F.explode(F.expr(LOW)).alias("i"))
        asked.append(
            step.select(F.col("fp").alias("a"), F.col("x").bitwiseXOR(F.expr("shiftleft(1L, i)")).alias("b"))
        )
    if any_lo:
        own = halves.join(hot_lo, "lo", "left_semi").select("fp", F.explode(_masks(32)).alias("m"))
        asked.append(own.select(F.col("fp").alias("a"), F.col("fp").bitwiseXOR(F.col("m")).alias("b")).where("a < b"))
    found += [x.join(whole, "b").select("a", "b") for x in asked]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def link_fingerprints(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From rows (id, fp): the table of fingerprints (fp, least: its smallest id, component: the smallest id reachable)
    and the links between different fingerprints (a, b)."""
    entries = settle(rows.groupBy("fp").agg(F.min("id").alias("least")), "fingerprints")
    links = settle(close_pairs(entries).distinct(), "close")
    roots = components(links)
    placed = entries.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    placed = placed.withColumn("root", F.coalesce("root", "fp"))
    smallest = placed.groupBy("root").agg(F.min("least").alias("component"))
    return placed.join(smallest, "root").select("fp", "root", "least", "component"), links


def simhash_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = 3) -> DataFrame:
    """One row per row of ``docs``: id, fingerprint (16 hex digits), component_id (smallest id reachable by links).

    Null and empty texts have fingerprint zero and are linked like any other; fewer words than a shingle make one
    shingle. Rows with equal fingerprints are one group, also when ids repeat; null ids are never the smallest unless a
    group has no other. No rows give no rows; other columns are ignored.
    """
    rows = narrow(docs, id=id_column, text=text_column).select("id", fingerprint("text", shingle).alias("fp"))
    rows = settle(rows, "simhash")
    placed, _ = link_fingerprints(rows)
    return rows.join(placed.select("fp", "component"), "fp").select(
        F.col("id").alias(id_column),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def keep_one_per_group(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = 3) -> DataFrame:
    """The rows of ``docs``, with all their columns, less all but one of each group of near-duplicates.

    The smallest id stays; of repeated ids the one with the smallest row hash, and one of rows that are equal.
    """
    names = docs.columns
    own, row_hash = fresh(docs, "fp"), fresh(docs, "row")
    marked = docs.select("*", fingerprint(F.col(f"`{text_column}`"), shingle).alias(own), hash_of_row(docs).alias(row_hash))
    marked = settle(marked, "simhash-rows")
    rows = marked.select(F.col(f"`{id_column}`").alias("id"), F.col(own).alias("fp"), F.col(row_hash).alias("row"))
    placed, _ = link_fingerprints(rows)
    # of one fingerprint, then of one group: numbers sort before null ids
    first = F.struct(F.col("id").isNull().alias("none"), "id", "row", "fp")
    winners = (
        rows.groupBy("fp").agg(F.min(first).alias("w")).join(placed.select("fp", "root"), "fp")
        .groupBy("root").agg(F.min("w").alias("w"))
    )
    of_fp, of_id, of_row = fresh(docs, "first_fp"), fresh(docs, "first_id"), fresh(docs, "first_row")
    winners = winners.select(F.col("w.fp").alias(of_fp), F.col("w.id").alias(of_id), F.col("w.row").alias(of_row))
    kept = marked.join(
        winners,
        (F.col(own) == F.col(of_fp)) & (F.col(row_hash) == F.col(of_row)) & F.col(f"`{id_column}`").eqNullSafe(F.col(of_id)),
        "left_semi",
    )
    return kept.dropDuplicates([own, row_hash]).select(*(F.col(f"`{c}`") for c in names))
