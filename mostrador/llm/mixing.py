"""Mixing sources to target weights (operator 2), by DataFrame functions alone.

Words are added up per source. The sources, in code point order with null last, get the weights in turn; their
targets share the sum of all sizes by weight, and a target above ``most`` times its source's size stops there, the
excess being shared again by weight among the others until none is above. A document is taken floor(rate) times, with
rate = target / size of its source, and once more if its draw, a number in [0, 1) hashed from a seed, its id and its
text, is below the fraction.

Sizes differ by orders of magnitude, so independent draws leave a source of a thousand documents some tenths off its
target. The draws are therefore stratified: the documents of a source, by size, are cut into strata of ``STRATUM``, and
in a stratum of n the draws are (place + jitter) / n, with place in the order of one hash and jitter from another.
Each draw by itself is still uniform, so each document gets its copy with probability equal to the fraction.

Nothing is ranked in one task: rows are dealt by ranges, ranked within a range, and the counts of the ranges before
are added. A source that holds a third of all rows spreads over as many ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mostrador.session import settle

from .common import fresh

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
#: No target is above this many times its source's size.
MOST = 3
SEED = "mix-1"
#: Documents of a source, next to each other in size, whose draws are spread evenly.
STRATUM = 32


def words(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _digest(ident: Column, text: Column, seed: str) -> Column:
    key = F.concat_ws("|", F.lit(seed), F.coalesce(ident.cast("string"), F.lit("")), F.coalesce(text, F.lit("")))
    return F.md5(key)


def _part(digest: Column, first: int, digits: int) -> Column:
    return F.conv(F.substring(digest, first, digits), 16, 10).cast("long")


def _before(ranged: DataFrame, keys: list[str]) -> DataFrame:
    """(part, *keys, before): rows with these keys in the ranges before each range."""
    counts = ranged.groupBy("part", *keys).count()  # a row for each range and key
    earlier = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("part", *keys, F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))


def draws(rows: DataFrame) -> DataFrame:
    """Distinct (source, size, digest) of ``rows`` with their draw u."""
    units = rows.select("source", "size", "digest").distinct()
    order = [F.col("source").isNull(), "source", "size", "digest"]
    ranged = settle(units.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "draws")
    before = _before(ranged, ["source"]).select(F.col("part").alias("p"), F.col("source").alias("s"), "before")
    place = F.row_number().over(Window.partitionBy("part", "source").orderBy("size", "digest")) - 1
    ranked = ranged.withColumn("place", place).join(
        before, (F.col("part") == F.col("p")) & F.col("source").eqNullSafe(F.col("s"))
    )
    ranked = ranked.withColumn("stratum", F.floor((F.col("place") + F.col("before")) / STRATUM))
    stratum = Window.partitionBy("source", "stratum")
    turn = F.row_number().over(stratum.orderBy(_part(F.col("digest"), 14, 13), "size", "digest")) - 1
    jitter = _part(F.col("digest"), 27, 6) / F.lit(float(1 << 24))
    return ranked.select("source", "size", "digest", ((turn + jitter) / F.count(F.lit(1)).over(stratum)).alias("u"))


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target, rate) from rows (source, size), any number of them per source.

    A source without words has target and rate 0. No rows give no rows.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    none = F.col("source").isNull()
    ranged = settle(sums.repartitionByRange(none, "source").withColumn("part", F.spark_partition_id()), "sources")
    offsets = settle(ranged.groupBy("part").count(), "ranges")  # a row for each range
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = offsets.select("part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(none, "source")) - 1 + F.col("before")
    turn = (place % len(weights)).cast("int")
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), turn + 1)
    ranked = settle(ranged.join(offsets, "part").select("source", "source_size", weight.alias("weight")), "weights")

    most_of = F.col("source_size") * most
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, stopped = 0.0, -1
    while True:
        above = F.lit(level) * F.col("weight") > most_of if stopped >= 0 else F.lit(False)
        n, taken, rest = ranked.agg(
            F.count_if(above), F.sum(F.when(above, most_of).otherwise(0)), F.sum(F.when(above, 0.0).otherwise(F.col("weight")))
        ).first()
        if n == stopped or not rest:
            break
        level, stopped = (total - taken) / rest, n
    target = F.least(F.lit(level) * F.col("weight"), most_of.cast("double"))
    rate = F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0)
    return settle(ranked.select("source", "source_size", target.alias("target"), rate.alias("rate")), "targets")


def _decided(rows: DataFrame) -> DataFrame:
    """Rows (..., source, size, digest) with source_size, target, rate and copies."""
    plan = source_targets(rows.select("source", "size")).withColumnRenamed("source", "of")
    drawn = draws(rows).select(F.col("source").alias("s"), F.col("size").alias("n"), F.col("digest").alias("d"), "u")
    same = F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("n")) & (F.col("digest") == F.col("d"))
    fraction = F.col("rate") - F.floor("rate")
    copies = (F.floor("rate") + (F.col("u") < fraction).cast("int")).cast("int")
    return (
        rows.join(drawn, same).join(plan, F.col("source").eqNullSafe(F.col("of")))
        .withColumn("copies", copies).drop("s", "n", "d", "of")
    )


def mix_counts(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", seed: str = SEED
) -> DataFrame:
    """One row per row of ``docs``: id, size, source_size, target, taken (size times copies), copies.

    Null texts have size 0, a null source is a source of its own, rows with equal id, text and source share their draw,
    no rows give no rows; other columns are ignored.
    """
    ident, text = F.col(f"`{id_column}`"), F.col(f"`{text_column}`")
    rows = docs.select(
        ident.alias("id"), F.col(f"`{source_column}`").alias("source"), words(text).alias("size"),
        _digest(ident, text, seed).alias("digest"),
    )
    taken = _decided(settle(rows, "sizes"))
    return taken.select(
        F.col("id").alias(id_column), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies"
    )


def mix(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", seed: str = SEED
) -> DataFrame:
    """The rows of ``docs`` as often as they are taken, with a column ``copy`` (1, 2, ...) in addition."""
    names = docs.columns
    ident, text, source = F.col(f"`{id_column}`"), F.col(f"`{text_column}`"), F.col(f"`{source_column}`")
    digest = _digest(ident, text, seed)
    rows = settle(docs.select(source.alias("source"), words(text).alias("size"), digest.alias("digest")), "sizes")
    d, of, n = fresh(docs, "mix_digest"), fresh(docs, "mix_of"), fresh(docs, "mix_copies")
    plan = _decided(rows).select("digest", "source", "copies").distinct()
    plan = plan.select(F.col("digest").alias(d), F.col("source").alias(of), F.col("copies").alias(n)).where(F.col(n) > 0)
    out = docs.join(plan, (digest == F.col(d)) & source.eqNullSafe(F.col(of)))
    return out.select(*(F.col(f"`{c}`") for c in names), F.explode(F.sequence(F.lit(1), F.col(n))).alias(fresh(docs, "copy")))
