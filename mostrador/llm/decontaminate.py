"""Benchmark decontamination by training suffix arrays (operator 7).

The documents of a task are dealt into shards of about ``SHARD`` bytes. A shard's words become numbers in the
vocabulary of the benchmark (0 for words it does not have), and its suffix array sorts the positions at which a
benchmark passage can begin: those whose first three words begin some benchmark suffix. Every test suffix is looked up by
binary search; the matching range gives the places where its first ten words occur word for word, and places that
continue each other are the longest matches.

The benchmark is held in blocks of about ``WINDOWS`` words and at most ``BLOCK`` bytes of text, long items being cut into
pieces that overlap by nine words, so that what the driver builds and what a worker holds has a bound whatever the
benchmark's size. A batch of documents meets one block after another: the documents are read once.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mostrador.session import settle

from .common import SLICE, encoded, fresh, narrow, word_lists

#: Words that have to match in a row; an item with fewer has to occur whole.
WINDOW = 10
#: Bytes of documents in a shard.
SHARD = 4 << 20
#: Words of benchmark that are held at once (about 100 bytes a word, and 150 a different word), and bytes of their text.
WINDOWS, BLOCK = 1 << 19, 8 << 20
#: Words of a piece of a benchmark item.
PIECE = 2048

# Words are letters, digits and everything beyond ASCII; A-Z count as a-z.
_KEPT = b"0123456789abcdefghijklmnopqrstuvwxyz"
WORDS = bytes(
    c if c >= 0x80 or c in _KEPT else (c + 32 if 65 <= c <= 90 else 32) for c in range(256)
)


def text_words(text: str | None, size: int = SLICE):
    """Lists of the words of a text."""
    return word_lists(encoded(text).translate(WORDS), size)


_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)


def _grams(ids: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """A hash of the ``n`` words from each position; only used to leave out positions."""
    out = np.zeros(len(at), np.uint64)
    for k in range(n):
        out = (out ^ ids[at + k].astype(np.uint64)) * _MIX[k]
        out ^= out >> np.uint64(29)
    return out


def _keys(ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The ``WINDOW`` words from each position as byte strings that sort like the words' numbers."""
    rows = ids[at[:, None] + np.arange(WINDOW)].astype(">u4")
    return np.ascontiguousarray(rows).view(f"S{4 * WINDOW}").ravel()


class TestSuffixes:
    """The suffixes of a block of benchmark items that begin a window, each window once, in arrays."""

    def __init__(self, rows: list[tuple[str, int, str]]):
        self.vocabulary: dict[bytes, int] = {}
        self.items = sorted({item for item, _, _ in rows})
        number = {item: k for k, item in enumerate(self.items)}
        parts, at, owner, place, size = [], [], [], [], 0
        gap = np.zeros(WINDOW, np.int32)
        for item, first, text in rows:
            words = [w for part in text_words(text) for w in part]
            if not words:
                continue
            ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words], np.int32)
            n = max(1, len(ids) - WINDOW + 1)
            at.append(np.arange(size, size + n))
            owner.append(np.full(n, number[item], np.int32))
            place.append(np.arange(first, first + n, dtype=np.int32))
            parts += [ids, gap]
            size += len(ids) + WINDOW
        flat = np.concatenate([*parts, gap])
        begin = np.concatenate([*at, np.zeros(0, np.int64)]).astype(np.int64)
        keys = _keys(flat, begin)
        order = np.argsort(keys, kind="stable")
        begin, keys = begin[order], keys[order]
        self.owner = np.concatenate([*owner, np.zeros(0, np.int32)])[order]
        self.place = np.concatenate([*place, np.zeros(0, np.int32)])[order]
        new = np.flatnonzero(np.r_[len(keys) > 0, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
        #: window w has the places from offsets[w] to offsets[w + 1]
        self.offsets = np.append(new, len(keys))
        begin, self.low = begin[new], keys[new]
        table = flat[begin[:, None] + np.arange(WINDOW)]
        self.lengths = (table > 0).sum(axis=1)
        high = np.where(table > 0, table.astype(np.int64), 0xFFFFFFFF).ravel()
        self.high = _keys(np.concatenate([high, gap]), np.arange(len(begin)) * WINDOW)
        # by length of the beginning that is compared first: which hashes begin a window
        self.begins = {}
        for n in (1, 2, 3):
            some = self.lengths == n if n < 3 else self.lengths >= n
            if some.any():
                self.begins[n] = np.unique(_grams(flat, begin[some], n))
        self.first = np.zeros(len(self.vocabulary) + 1, bool)
        self.first[table[:, 0]] = True

    def numbers(self, text: str | None) -> np.ndarray:
        """The text's words as numbers of the vocabulary, 0 for others."""
        get = self.vocabulary.get
        parts = [np.fromiter(map(get, words, repeat(0)), np.int32, len(words)) for words in text_words(text)]
        return np.concatenate(parts) if parts else np.zeros(0, np.int32)

    def occurrences(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, window) of all places in ``ids``, which ends with at least ``WINDOW`` zeros."""
        at = np.flatnonzero(self.first[ids])
        possible = np.zeros(len(at), bool)
        for n, known in self.begins.items():
            grams = _grams(ids, at, n)
            place = np.minimum(np.searchsorted(known, grams), len(known) - 1)
            possible |= known[place] == grams
        at = at[possible]
        keys = _keys(ids, at)
        order = np.argsort(keys, kind="stable")
        array, keys = at[order], keys[order]  # the shard's suffix array
        low = np.searchsorted(keys, self.low, "left")
        counts = np.maximum(np.searchsorted(keys, self.high, "right") - low, 0)
        window = np.repeat(np.arange(len(counts)), counts)
        within = np.arange(len(window)) - np.repeat(np.cumsum(counts) - counts, counts)
        return array[np.repeat(low, counts) + within], window

    def matches(self, texts: list) -> Iterator[tuple[int, int, np.ndarray]]:
        """(number, words, matches) of each text; a match is a row (item, item's word less the text's, begin, end)."""
        shard, size, first = [], 0, 0
        for k, text in enumerate(texts):
            shard.append(self.numbers(text))
            size += len(text or "")
            if size >= SHARD or k + 1 == len(texts):
                yield from self._shard(shard, first)
                shard, size, first = [], 0, k + 1

    def _shard(self, docs: list[np.ndarray], first: int) -> Iterator[tuple[int, int, np.ndarray]]:
        none = np.zeros((0, 4), np.int64)
        gap = np.zeros(WINDOW, np.int32)
        ids = np.concatenate([part for doc in docs for part in (doc, gap)])
        sizes = np.array([len(doc) for doc in docs])
        starts = np.cumsum(sizes + WINDOW) - sizes - WINDOW
        at, window = self.occurrences(ids) if len(self.lengths) else (np.zeros(0, np.int64),) * 2
        doc = np.searchsorted(starts, at, "right") - 1
        order = np.argsort(doc, kind="stable")
        at, window, doc = at[order], window[order], doc[order]
        edges = np.searchsorted(doc, np.arange(len(docs) + 1))
        for d in range(len(docs)):
            here = slice(edges[d], edges[d + 1])
            yield first + d, int(sizes[d]), self._joined(at[here] - starts[d], window[here]) if edges[d] < edges[d + 1] else none

    def _joined(self, at: np.ndarray, window: np.ndarray) -> np.ndarray:
        """Places of windows that continue each other in a text and in an item, as one match."""
        counts = self.offsets[window + 1] - self.offsets[window]
        within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        where = np.repeat(self.offsets[window], counts) + within
        at, ends = np.repeat(at, counts), np.repeat(at + self.lengths[window], counts)
        return joined(np.stack([self.owner[where], self.place[where] - at, at, ends], axis=1))


def joined(rows: np.ndarray) -> np.ndarray:
    """Matches (item, distance, begin, end) with those of one item and distance made one that overlap or meet."""
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    if len(rows) < 2:
        return rows
    other = np.r_[False, (rows[1:, :2] != rows[:-1, :2]).any(axis=1)]
    shift = np.cumsum(other) * (rows[:, 3].max() + 1)  # a running maximum that starts anew with every item and distance
    furthest = np.maximum.accumulate(rows[:, 3] + shift)
    begins = np.flatnonzero(np.r_[True, other[1:] | (rows[1:, 2] + shift[1:] > furthest[:-1])])
    ends = np.append(begins[1:], len(rows)) - 1
    return np.concatenate([rows[begins, :3], (furthest - shift)[ends, None]], axis=1)


def longest_in(blocks: Iterable, texts: list) -> list[tuple[int, list[tuple[str, int, int, int]]]]:
    """For each text its words and all longest matches (item, item's word, text's word, words), by item and place.

    One block is held after another; parts of a match from several blocks, or pieces of an item, are put together.
    """
    sizes, found = [0] * len(texts), [[] for _ in texts]
    names: dict[str, int] = {}
    for block in blocks:
        number = np.array([names.setdefault(item, len(names)) for item in block.items], np.int64)
        for k, size, rows in block.matches(texts):
            sizes[k] = size
            if len(rows):
                found[k].append(np.concatenate([number[rows[:, :1]], rows[:, 1:]], axis=1))
    items = list(names)
    out = []
    for size, parts in zip(sizes, found):
        rows = joined(np.concatenate(parts)).tolist() if parts else []
        out.append((size, sorted((items[i], distance + begin, begin, end - begin) for i, distance, begin, end in rows)))
    return out


def benchmark_blocks(
    items: DataFrame, id_column: str = "item_id", text_column: str = "text", windows: int = WINDOWS, block: int = BLOCK
) -> Iterator[list]:
    """Pieces (item, place of the first word, text) of the benchmark, one block of bounded size after another."""

    @F.pandas_udf("array<struct<place:int,n:int,text:string>>")
    def pieces(texts: pd.Series) -> pd.Series:
        def cut(text):
            words = [w for part in text_words(text) for w in part]
            last = max(1, len(words) - WINDOW + 1)
            parts = ((i, words[i : i + PIECE + WINDOW - 1]) for i in range(0, last, PIECE))
            return [{"place": i, "n": len(part), "text": b" ".join(part).decode("utf-8")} for i, part in parts if part]

        return pd.Series([cut(t) for t in texts])

    rows = narrow(items, item=id_column, text=text_column)
    rows = rows.select(F.coalesce(F.col("item").cast("string"), F.lit("")).alias("item"), F.inline(pieces("text")))
    rows = settle(rows.distinct(), "benchmark")
    words, size = rows.agg(F.sum("n"), F.sum(F.octet_length("text") + F.octet_length("item") + 64)).first()
    n = max(1, math.ceil((words or 0) / windows), math.ceil((size or 0) / block))
    for k in range(n):
        part = rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k)
        yield [tuple(r) for r in part.select("item", "place", "text").collect()]


MATCHES = "array<struct<item:string,item_word:int,doc_word:int,n_words:int>>"


def _held(spark, items: DataFrame, windows: int, block: int) -> list:
    return [spark.sparkContext.broadcast(TestSuffixes(rows)) for rows in benchmark_blocks(items, windows=windows, block=block)]


def _search(text: Column, held: list) -> Column:
    def each() -> Iterator[TestSuffixes]:
        for block in held:
            yield block.value
            if len(held) > 1:  # a worker holds one block at a time; the next batch loads it again
                vars(block).pop("_value", None)

    @F.pandas_udf(f"n_words bigint, matches {MATCHES}")
    def search(texts: pd.Series) -> pd.DataFrame:
        names = ("item", "item_word", "doc_word", "n_words")
        found = longest_in(each(), texts.tolist())
        return pd.DataFrame({"n_words": [n for n, _ in found], "matches": [[dict(zip(names, m)) for m in ms] for _, ms in found]})

    return search(text)


def with_matches(
    docs: DataFrame, items: DataFrame, name: str, text_column: str = "text", windows: int = WINDOWS, block: int = BLOCK
) -> DataFrame:
    """``docs`` with a column ``name``: n_words, and matches, all longest verbatim ones (item, item_word, doc_word, n_words).

    The documents are read once, whatever the number of blocks.
    """
    held = _held(docs.sparkSession, items, windows, block)
    return docs.withColumn(name, _search(F.col(f"`{text_column}`"), held))


def hit_words(matches: Column) -> Column:
    """Words of the text that at least one match covers."""

    def step(state: Column, span: Column) -> Column:
        more = F.greatest(span["end"] - F.greatest(span["start"], state["at"]), F.lit(0))
        return F.struct((state["n"] + more).alias("n"), F.greatest(state["at"], span["end"]).alias("at"))

    spans = F.transform(matches, lambda m: F.struct(m["doc_word"].alias("start"), (m["doc_word"] + m["n_words"]).alias("end")))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("at"))
    return F.aggregate(F.array_sort(F.array_distinct(spans)), start, step, lambda s: s["n"])


def find_contamination(
    docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text", windows: int = WINDOWS, block: int = BLOCK
) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_hit, n_items, items_sha256, contaminated, longest (words of the longest
    verbatim match, 0 without one), matches (all longest matches: item, item_word, doc_word, n_words).

    Null and empty texts, of documents and items, have no words; an item without words is nowhere; repeated items count
    once; ids may be null or repeated; no documents give no rows and no items no hits; other columns are ignored.
    """
    rows = with_matches(narrow(docs, id=id_column, text=text_column), items, "m", "text", windows, block)
    items_found = F.array_sort(F.array_distinct(F.transform("m.matches", lambda x: x["item"])))
    longest = F.array_max(F.transform("m.matches", lambda x: x["n_words"]))
    return rows.select(
        F.col("id").alias(id_column), F.col("m.n_words").alias("n_words"), hit_words(F.col("m.matches")).alias("n_hit"),
        F.size(items_found).cast("long").alias("n_items"),
        F.sha2(F.array_join(items_found, ","), 256).alias("items_sha256"),
        (F.size("m.matches") > 0).alias("contaminated"),
        F.coalesce(longest, F.lit(0)).cast("long").alias("longest"),
        F.col("m.matches").alias("matches"),
    )


def remove_contaminated(
    docs: DataFrame, items: DataFrame, text_column: str = "text", windows: int = WINDOWS, block: int = BLOCK
) -> DataFrame:
    """The rows of ``docs``, with all their columns, in which no window of the benchmark occurs."""
    name = fresh(docs, "hits")
    out = with_matches(docs, items, name, text_column, windows, block).where(F.size(f"{name}.matches") == 0)
    return out.select(*(F.col(f"`{c}`") for c in docs.columns))


def longest_matches(
    docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text", windows: int = WINDOWS, block: int = BLOCK
) -> DataFrame:
    """(id, item, item_word, doc_word, n_words): every longest verbatim match and where it lies.

    Matches have at least ``WINDOW`` words, or are a shorter item as a whole.
    """
    rows = with_matches(narrow(docs, id=id_column, text=text_column), items, "m", "text", windows, block)
    return rows.select(F.col("id").alias(id_column), F.inline("m.matches"))
