"""Vector code compression (operator 11): integer codebooks of parts, searched in the Walsh-Hadamard domain.

Components become whole numbers and vectors are cut into equal parts, each with a codebook of its own. Parts and entries are
padded with zeros to a power of two and go through an integer Walsh-Hadamard transform, in sequency order (by number of
sign changes). The transform multiplies all squared distances by its length, so the sum of the squared differences of the
first coefficients never exceeds the scaled distance: an entry whose sum passes that of a known entry is left out early,
and the rest are exact. There is no floating point after the first floor.

Rounds run on Spark: each task adds up its parts by entry, a grouping adds up the tasks, and the driver holds the
codebooks only, whose size depends on the dimension and not on the number of vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mostrador.session import settle

from .common import join_unique

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Components, in absolute value, that are refused: their squares could not be given as BIGINT anyway.
LARGEST = float(1 << 28)
#: Numbers of a batch that are transformed at once.
NUMBERS = 1 << 21


def usable(vector: Column) -> Column:
    """True for vectors without null and non-finite components."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vector.isNotNull() & F.coalesce(F.forall(vector, finite), F.lit(False))


def whole_numbers(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component; the job fails on one beyond ``LARGEST``."""

    def one(x: Column) -> Column:
        x = x.cast("double")
        large = F.raise_error(F.concat(F.lit("vector component too large: "), x.cast("string"))).cast("bigint")
        return F.when(F.abs(x) <= LARGEST, F.floor(x * scale)).otherwise(large)

    return F.transform(vector, one)


def sequency(length: int) -> np.ndarray:
    """Rows of the Hadamard matrix of that length (a power of two) by number of sign changes."""
    bits = length.bit_length() - 1
    gray = [i ^ (i >> 1) for i in range(length)]
    return np.array([int(format(g, f"0{bits}b")[::-1], 2) if bits else 0 for g in gray])


def walsh(rows: np.ndarray) -> np.ndarray:
    """The transform of every row, padded with zeros to a power of two, in sequency order."""
    n, width = rows.shape
    length = 1 << max(width - 1, 0).bit_length()
    out = np.zeros((n, length), rows.dtype)
    out[:, :width] = rows
    half = 1
    while half < length:
        pairs = out.reshape(n, length // (2 * half), 2, half)
        out = np.stack((pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]), axis=2).reshape(n, length)
        half *= 2
    return out[:, sequency(length)]


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry (the lowest of several) and the squared distance, for every part."""
    if not len(parts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    peak = max(int(abs(parts).max(initial=0)), int(abs(book).max(initial=0)), 1)
    length = 1 << max(parts.shape[1] - 1, 0).bit_length()
    if 4 * length * length * peak * peak >= 1 << 62:  # no 64-bit number holds the sums
        parts, book = parts.astype(object), book.astype(object)
    x, c = walsh(parts), walsh(book)
    first = (x[:, :1] - c[:, 0]) ** 2
    guess = first.argmin(axis=1)
    bound = ((x - c[guess]) ** 2).sum(axis=1)
    row, entry = np.nonzero(first <= bound[:, None])  # by row, then by entry
    so_far = first[row, entry]
    for k in range(1, x.shape[1]):
        so_far = so_far + (x[row, k] - c[entry, k]) ** 2
        alive = so_far <= bound[row]
        row, entry, so_far = row[alive], entry[alive], so_far[alive]
    starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    best = np.minimum.reduceat(so_far, starts)
    hits = np.flatnonzero(so_far == best[row])
    hits = hits[np.r_[True, row[hits][1:] != row[hits][:-1]]]
    return entry[hits], best // x.shape[1]


def _matrices(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The vectors of a batch as matrices of that width, short ones padded with zeros, in slices of bounded size."""
    step = max(1, NUMBERS // max(width, 1))
    for start in range(0, len(column), step):
        part = column.slice(start, step)
        sizes = part.value_lengths().to_numpy(zero_copy_only=False)
        flat = part.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        out = np.zeros((len(part), width), np.int64)
        out[np.arange(width) < sizes[:, None]] = flat
        yield out


class Codebooks:
    """One codebook per part; ``books`` is (parts, entries, components)."""

    def __init__(self, books: np.ndarray):
        self.books = books

    @property
    def width(self) -> int:
        return self.books.shape[0] * self.books.shape[2]

    def assign(self, vectors: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For every part: its components, nearest entries, squared distances."""
        parts, _, size = self.books.shape
        for p in range(parts):
            part = vectors[:, p * size : (p + 1) * size]
            yield part, *nearest(part, self.books[p])

    def sums(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Number of parts and sums of their components by part and entry, of all batches of a task."""
        parts, entries, size = self.books.shape
        slots = np.arange(parts * entries * size)

        def batch(count, total):
            kept = slots[np.repeat(count.ravel() > 0, size)]
            columns = [kept, np.repeat(count.ravel(), size)[kept], total.ravel()[kept]]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["slot", "n", "total"])

        count, total, weight = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, size), np.int64), 0
        for arrived in batches:
            for vectors in _matrices(arrived.column("v"), self.width):
                peak = len(vectors) * int(abs(vectors).max(initial=0))
                if weight + peak >= 1 << 62:
                    yield batch(count, total)
                    count, total, weight = np.zeros_like(count), np.zeros_like(total), 0
                weight += peak
                for p, (part, entry, _) in enumerate(self.assign(vectors)):
                    count[p] += np.bincount(entry, minlength=entries)
                    order = np.argsort(entry, kind="stable")
                    met, starts = np.unique(entry[order], return_index=True)
                    if len(met) and size:
                        total[p, met] += np.add.reduceat(part[order], starts, axis=0)
        yield batch(count, total)

    def moved(self, rows: Iterable) -> Codebooks:
        """Entries replaced by the floor of the mean of their parts, from (slot, n, total); the others stay."""
        books = self.books.copy()
        for row in rows:
            books.reshape(-1)[row["slot"]] = int(row["total"]) // int(row["n"])
        return Codebooks(books)

    def codes(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The batches with code and error in place of the vector."""
        for arrived in batches:
            codes, errors = [], []
            for vectors in _matrices(arrived.column("v"), self.width):
                entries, distances = zip(*((e, d) for _, e, d in self.assign(vectors)))
                codes += [row.tobytes().hex() for row in np.stack(entries, axis=1).astype(np.uint8)]
                errors += [sum(map(int, d)) for d in zip(*distances)]
            kept = arrived.drop_columns(["v"])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(codes, pa.string()), pa.array(errors, pa.int64())], [*kept.schema.names, "code", "error"]
            )

    def text(self) -> str:
        return ",".join(map(str, self.books.reshape(-1).tolist()))


def fit(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks of a table (id, v), which every round reads once; None where it is empty.

    The first vectors by id (nulls last, then by components) are the first entries; fewer vectors give fewer entries.
    """
    first = vectors.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    if not first:
        return None
    widest = vectors.agg(F.max(F.size("v"))).first()[0]
    size = -(-widest // parts)
    books = np.zeros((len(first), parts * size), np.int64)
    for i, row in enumerate(first):
        books[i, : len(row["v"])] = row["v"]
    found = Codebooks(np.ascontiguousarray(books.reshape(len(first), parts, size).transpose(1, 0, 2)))
    for _ in range(rounds):
        sums = vectors.select("v").mapInArrow(found.sums, "slot bigint, n bigint, total bigint")
        added = sums.groupBy("slot").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
        found = found.moved(added.collect())
    return found


def compress(
    df: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> DataFrame:
    """One row per usable vector: id, label, code, error, label_error, codebooks_sha256.

    Vectors that are null or hold null or non-finite components are left out. Repeated rows and ids count each; null labels
    are one group. Vectors that are shorter than the longest, or whose length does not divide by ``parts``, are
    padded with zeros at the end; empty ones have error 0. Components beyond ``LARGEST``, and errors that no BIGINT holds,
    fail the job. No usable vectors give no rows; other columns are ignored.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hexadecimal digits, so there are 1 to 256 entries")
    rows = df.select(
        F.col(f"`{id_column}`").alias("id"), F.col(f"`{label_column}`").alias("label"), F.col(f"`{vector_column}`").alias("x")
    ).where(usable(F.col("x")))
    vectors = settle(rows.select("id", "label", whole_numbers(F.col("x"), scale).alias("v")), "vectors")
    books = fit(vectors, parts, entries, rounds)
    kinds = vectors.select("id", "label").schema.fields
    schema = T.StructType([*kinds, T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    if books is None:
        coded, digest = df.sparkSession.createDataFrame([], schema).withColumn("label_error", F.lit(None).cast("bigint")), ""
    else:
        table = settle(vectors.mapInArrow(books.codes, schema), "codes")
        totals = table.groupBy("label").agg(F.sum(F.col("error").cast("decimal(20,0)")).cast("bigint").alias("label_error"))
        coded = join_unique(table, totals, "label")
        digest = hashlib.sha256(books.text().encode()).hexdigest()
    return coded.select(
        F.col("id").alias(id_column), F.col("label").alias(label_column), "code", "error", "label_error",
        F.lit(digest).alias("codebooks_sha256"),
    )
