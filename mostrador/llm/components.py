"""Connected components of a graph given as a table of links.

Rounds of large-star and small-star steps: in the first every node's larger neighbours are linked to its smallest
one, in the second every node and its smaller neighbours. Links only ever point at smaller nodes, their number does
not grow, and after a logarithmic number of rounds every node is linked to the smallest node it can reach. Minima
are combined before they are shuffled, so a node with very many links is no hot spot; each round is written to the
shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mostrador.session import settle


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (columns a, b; either order, repeated, or a = b).

    ``root`` is the smallest node that can be reached. Rows with a null end are ignored; nodes that occur only in
    links to themselves have themselves as root; no links give no rows.
    """
    clean = links.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL")
    alone = clean.where("a = b").select(F.col("a").alias("node")).distinct()
    pairs = clean.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct()
    pairs = settle(pairs, "links")
    before = _state(pairs)
    while before[0]:
        pairs = settle(_small_star(_large_star(pairs)), "links")
        after = _state(pairs)
        if after == before:
            break
        before = after
    rooted = pairs.select(F.col("v").alias("node"), F.col("u").alias("root"))
    roots = pairs.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct()
    found = rooted.unionByName(roots)
    lone = alone.join(found, "node", "left_anti").withColumn("root", F.col("node"))
    return found.unionByName(lone)


def _state(pairs: DataFrame) -> tuple:
    row = pairs.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("v", "u")), F.bit_xor(F.xxhash64("u", "v"))).first()
    return tuple(row)


def _large_star(pairs: DataFrame) -> DataFrame:
    """Links (v, smallest neighbour of u) for every u and its larger neighbours v."""
    both = pairs.unionByName(pairs.select(F.col("u").alias("v"), F.col("v").alias("u")))
    least = both.groupBy(F.col("v").alias("u")).agg(F.least(F.min("u"), F.first("v")).alias("m"))
    # pairs has u < v: v are the larger neighbours of u
    return pairs.join(least, "u").select("v", F.col("m").alias("u")).distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    """Links (smaller neighbour of v, smallest neighbour of v), and (v, smallest neighbour of v)."""
    least = pairs.groupBy("v").agg(F.min("u").alias("m"))
    below = pairs.join(least, "v").select(F.col("u").alias("v"), F.col("m").alias("u"))
    own = least.select("v", F.col("m").alias("u"))
    return below.unionByName(own).where("v <> u").distinct()
