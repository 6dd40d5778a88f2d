"""Helpers the operators share: reading tables, walking over long texts in bounded pieces."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mostrador.session import settle

#: Bytes of a text that are cut into words at once.
SLICE = 1 << 20

_SPACE = re.compile(rb"[\x09-\x0D\x20]")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def narrow(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the given names; others, whatever they are called, stay out."""
    return df.select(*(F.col(f"`{old}`").alias(new) for new, old in columns.items()))


def fresh(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def hash_of_row(df: DataFrame) -> Column:
    """A hash over all columns that Spark can hash (all but maps)."""
    return F.xxhash64(*(F.col(f"`{f.name}`") for f in df.schema if "map" not in f.dataType.simpleString()))


def encoded(text: str | None) -> bytes:
    """UTF-8; a null is empty, and a lone surrogate, which UTF-8 cannot hold, becomes a question mark."""
    return (text or "").encode("utf-8", "replace")


def word_lists(data: bytes, size: int = SLICE) -> Iterator[list[bytes]]:
    """The words of ``data`` (cut at ASCII white space), in lists made from about ``size`` bytes each."""
    if len(data) <= size:
        yield data.split()
        return
    start = 0
    while start < len(data):
        end = len(data)
        if start + size < end and (cut := _SPACE.search(data, start + size)):
            end = cut.start()
        yield data[start:end].split()
        start = end


def join_unique(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
    """``left`` with the columns of ``right``, which has at most one row per key; null keys match each other.

    Keys that hold more than a fourth of an even share of a partition are few, at most four times the number of
    partitions; their rows of ``right`` are broadcast. The other rows are joined by a shuffle in which no key is hot.
    ``left`` is read several times and should be a table.
    """
    spark = left.sparkSession
    counted = settle(left.groupBy(*keys).count(), "keys")
    rows, groups = counted.agg(F.coalesce(F.sum("count"), F.lit(0)), F.count(F.lit(1))).first()
    most = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))

    def joined(part: DataFrame, found: DataFrame) -> DataFrame:
        renamed = found.select(*(F.col(c).alias(f"right_{c}" if c in keys else c) for c in found.columns))
        same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"right_{k}")) for k in keys))
        return part.join(renamed, same, "left").drop(*(f"right_{k}" for k in keys))

    def only(part: DataFrame, few: DataFrame, kind: str) -> DataFrame:
        renamed = few.select(*(F.col(k).alias(f"few_{k}") for k in keys))
        same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"few_{k}")) for k in keys))
        return part.join(F.broadcast(renamed), same, kind)

    if groups <= most:
        return joined(left, F.broadcast(only(right, counted, "left_semi")))
    hot = counted.where(F.col("count") * most > rows)
    if not hot.take(1):
        return joined(left, right)
    of_hot = F.broadcast(only(right, hot, "left_semi"))
    return joined(only(left, hot, "left_semi"), of_hot).unionByName(joined(only(left, hot, "left_anti"), right))
