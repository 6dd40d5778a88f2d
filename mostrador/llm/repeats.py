"""Removal of long repeated strings by column-wise construction (operator 6).

A byte goes if a string of ``LENGTH`` bytes covers it that also starts earlier: in a document with a smaller id, or further
up in the same one. Nothing shorter than a whole document is ever compared across tasks; what is compared is brought
together by content.

Anchors. Of the ``GRAM``-byte strings in a window of ``LENGTH`` bytes the one with the smallest hash is the window's anchor,
the leftmost of equal ones. Neighbouring windows mostly share their anchor; together they are a stretch, of at most
``2 * LENGTH - GRAM`` bytes. Equal windows have equal anchors at equal places, so windows of stretches with different
anchors never match, and a stretch whose anchor occurs once has nothing to remove. Equal stretches are settled by a
minimum over their places.

Columns. The different stretches of an anchor form a collection of strings that are aligned at the anchor, so equal windows
begin in the same column. The collection is built column by column from the right: each round puts one symbol before
every string, sorts the strings anew by it (stably, so that the order is that of all they hold so far; the symbols in this
order are the column's Burrows-Wheeler transform) and updates the common prefixes of neighbours from the round before.
Neighbours with a common prefix of ``LENGTH`` are equal windows; all but the earliest go. A round needs only the arrays of
the round before it, and there are at most ``2 * LENGTH - GRAM`` rounds whatever the length of the documents.

Collections are dealt by anchor in bounded shards. An anchor with more different stretches than an even share of a
partition, like a line that a third of all documents hold, is settled window by window instead, by a minimum over
places per window, so that no task has to hold it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mostrador.session import settle

from .common import encoded, narrow

LENGTH, GRAM = 100, 32
#: Different stretches of an anchor that are compared in one collection: an even share of a shuffle partition, within bounds.
HOT_LEAST, HOT_MOST = 1024, 1 << 16
#: Bytes that are scanned at once, and strings that are built into one collection.
SLICE, SHARD = 1 << 18, 1 << 15

_MUL = np.uint64(0x9E3779B97F4A7C15)
_P = 0x5851F42D4C957F2D


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MUL
    return x ^ (x >> np.uint64(29))


_BYTES = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))


class Hashes:
    """Hashes of any stretch of some bytes, by running sums of the bytes times powers of an odd number."""

    power = np.cumprod(np.full(2 * SLICE + 2 * LENGTH, _P, np.uint64))
    inverse = np.cumprod(np.full(2 * SLICE + 2 * LENGTH + 1, pow(_P, -1, 1 << 64), np.uint64))

    def __init__(self, data: np.ndarray):
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[data] * self.power[: len(data)])])

    def of(self, begin, end) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[begin]) * self.inverse[begin])


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` neighbours."""
    done = 1
    while done * 2 <= width:
        values, done = np.minimum(values[:-done], values[done:]), done * 2
    rest = width - done
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def _segments(texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """(text, place in it, bytes) in groups of about ``SLICE`` bytes; segments of a text overlap by all but one byte of
    ``length``, so that each window lies in one of them."""
    group, size = [], 0
    for i, data in enumerate(texts):
        for first in range(0, len(data) - length + 1, SLICE):
            group.append((i, first, data[first : first + SLICE + length - 1]))
            size += len(group[-1][2])
            if size >= SLICE:
                yield group
                group, size = [], 0
    if group:
        yield group


def _scan(group: list[tuple[int, int, bytes]], length: int, gram: int) -> tuple[np.ndarray, ...]:
    flat = np.frombuffer(b"".join(data for _, _, data in group), np.uint8)
    sizes = np.fromiter((len(data) for _, _, data in group), np.int64, len(group))
    ends = np.cumsum(sizes)
    hashes = Hashes(flat)
    at = np.arange(len(flat) - gram + 1)
    of_gram = hashes.of(at, at + gram)
    # the place in the low bits: of equal hashes the leftmost is the smallest
    low = np.uint64((1 << 21) - 1)
    anchor = (_smallest((of_gram & ~low) | at.astype(np.uint64), length - gram + 1) & low).astype(np.int64)
    whole_window = np.ones(len(anchor) + 1, bool)
    for end in ends[:-1]:  # windows that go on into the next segment
        whole_window[max(0, end - length + 1) : end] = False
    whole_window[-1] = False
    new = np.concatenate([[True], anchor[1:] != anchor[:-1], [True]])
    new[1:] |= whole_window[1:] != whole_window[:-1]
    edge = np.flatnonzero(new)
    begin, end = edge[:-1], edge[1:]
    begin, end = begin[whole_window[begin]], end[whole_window[begin]]
    windows, place = end - begin, anchor[begin] - begin
    whole = hashes.of(begin, end + length - 1) + (windows * 256 + place).astype(np.uint64)
    of = np.searchsorted(ends, begin, "right")
    text = np.fromiter((i for i, _, _ in group), np.int64, len(group))[of]
    shift = np.fromiter((first for _, first, _ in group), np.int64, len(group)) - (ends - sizes)
    return text, begin + shift[of], windows, place, of_gram[anchor[begin]].view(np.int64), whole.view(np.int64)


def stretches(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(text, start, windows, anchor's place from the start, anchor's hash, hash of the stretch) of the stretches of texts."""
    parts = [_scan(group, length, gram) for group in _segments(texts, length)]
    return tuple(np.concatenate(x) for x in zip(*parts)) if parts else tuple(np.zeros(0, np.int64) for _ in range(6))


def _own(found) -> np.ndarray:
    """Which stretches are the first of their kind in their text."""
    text, _, _, _, anchor, whole = found
    order = np.lexsort((whole, anchor, text))  # stable: of equal ones the first stays first
    again = np.ones(len(order), bool)
    if len(order):
        again[0] = False
        for x in (text, anchor, whole):
            again[1:] &= x[order[1:]] == x[order[:-1]]
    out = np.zeros(len(order), bool)
    out[order[~again]] = True
    return out


# (start, windows, place of the anchor) in one number that sorts like the start
def _pack(start, windows, place):
    return (start << 16) | (windows << 8) | place


def _unpack(packed):
    return packed >> 16, (packed >> 8) & 0xFF, packed & 0xFF


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [encoded(text) for text in batch.column("text").to_pylist()]


def _scan_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = stretches(_texts(batch))
        yield pa.RecordBatch.from_pydict({"anchor": found[4][_own(found)]})


def _scan_stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = stretches(_texts(batch))
        own = _own(found)
        text, start, windows, place, anchor, whole = (x[own] for x in found)
        owner = pa.array(text)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(anchor), pa.array(whole), batch.column("id").take(owner), batch.column("tie").take(owner),
                pa.array(_pack(start, windows, place)),
            ],
            ["anchor", "whole", "id", "tie", "packed"],
        )


def _cut_strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the stretches that are listed beside the texts."""
    for batch in batches:
        owner, packed, anchors, strings = [], [], [], []
        for i, (text, wanted) in enumerate(zip(batch.column("text"), batch.column("wanted"))):
            data = encoded(text.as_py())
            for x in wanted.as_py():
                start, windows, _ = _unpack(x["packed"])
                owner.append(i)
                packed.append(x["packed"])
                anchors.append(x["anchor"])
                strings.append(data[start : start + windows + LENGTH - 1])
        owner = pa.array(owner, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(anchors, pa.int64()), batch.column("id").take(owner), batch.column("tie").take(owner),
                pa.array(packed, pa.int64()), pa.array(strings, pa.binary()),
            ],
            ["anchor", "id", "tie", "packed", "string"],
        )


def later_windows(strings: list[bytes], place: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, int]:
    """For strings in the order of their places, aligned at ``place``: (string, column) -> the window that begins there
    also begins at an earlier string; and the column of the first one.

    Built column by column from the right: one symbol per string and round.
    """
    n = len(strings)
    sizes = np.fromiter(map(len, strings), np.int64, n)
    left, width = int(place.max()), int((sizes - place).max() + place.max())
    end = 256  # beyond either end of a string
    table = np.full((width, n), end, np.uint16)
    flat = np.frombuffer(b"".join(strings), np.uint8)
    owner = np.repeat(np.arange(n), sizes)
    inside = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    table[inside + (left - place)[owner], owner] = flat
    starts = left - place
    out = np.zeros((width, n), bool)
    order, common = np.arange(n), np.zeros(n + 1, np.int16)  # common[i]: of the i-th string and the one before it
    for column in range(width - 1, -1, -1):
        symbols = table[column, order]  # this column's transform
        move = np.argsort(symbols, kind="stable")
        sorted_symbols = symbols[move]
        same = sorted_symbols[1:] == sorted_symbols[:-1]
        # strings between two neighbours were between them before: the smallest of their common prefixes, and the symbol
        bounds = np.empty(2 * n, np.int64)
        bounds[0::2], bounds[1::2] = np.concatenate([move[:-1] + 1, [n]]), np.concatenate([move[1:] + 1, [n]])
        least = np.minimum.reduceat(common, bounds)[0 : 2 * (n - 1) : 2]
        common = np.zeros(n + 1, np.int16)
        common[1:n] = np.where(same, np.minimum(least + 1, length), 0)
        order = order[move]
        # equal windows stand together; the strings are numbered by their places, so the smallest number is the earliest
        group = np.concatenate([[0], np.flatnonzero(common[1:n] < length) + 1])
        if len(group) < n:
            first = np.minimum.reduceat(order, group)
            later = order != np.repeat(first, np.diff(np.concatenate([group, [n]])))
            whole = (starts[order] <= column) & (column + length <= starts[order] + sizes[order])
            out[column, order] = later & whole
    return out, left


def _collection(rows: pa.Table) -> pa.RecordBatch | None:
    """Spans (start, end) of the windows in one shard's strings that also begin earlier."""
    keys = [(name, "ascending") for name in ("id", "tie", "packed")]
    rows = rows.take(pc.sort_indices(rows, sort_keys=keys, null_placement="at_start"))  # as Spark orders them
    packed = rows.column("packed").to_numpy()
    start, windows, place = _unpack(packed)
    anchor = rows.column("anchor").to_numpy()
    # rows that repeat are the same place
    twice = np.zeros(len(rows), bool)
    by = np.lexsort((np.arange(len(rows)), packed, anchor))
    ids, ties = rows.column("id").to_pylist(), rows.column("tie").to_numpy()
    for a, b in zip(by, by[1:]):
        if packed[a] == packed[b] and anchor[a] == anchor[b] and ids[a] == ids[b] and ties[a] == ties[b]:
            twice[b] = True
    keep = np.flatnonzero(~twice)
    strings = rows.column("string").to_pylist()
    later, left = later_windows([strings[i] for i in keep], place[keep])
    # runs of windows along each string
    edge = np.diff(later.T.astype(np.int8), axis=1, prepend=0, append=0)
    who, begin = np.nonzero(edge == 1)
    _, end = np.nonzero(edge == -1)
    if not len(who):
        return None
    shift = (start + place - left)[keep][who]
    owner = pa.array(keep[who])
    return pa.RecordBatch.from_arrays(
        [
            rows.column("id").combine_chunks().take(owner), rows.column("tie").combine_chunks().take(owner),
            pa.array(shift + begin), pa.array(shift + end + LENGTH - 1),
        ],
        ["id", "tie", "start", "end"],
    )


def _collections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Collections of about ``SHARD`` strings from rows that are sorted by anchor."""
    held: list[pa.Table] = []
    size = 0

    def ready(final: bool):
        nonlocal held, size
        rows = pa.concat_tables(held).combine_chunks()
        anchor = rows.column("anchor").to_numpy()
        cut = len(rows) if final else int(np.searchsorted(anchor == anchor[-1], True))  # the last anchor may go on
        held, size = ([rows.slice(cut)], len(rows) - cut) if cut < len(rows) else ([], 0)
        return _collection(rows.slice(0, cut)) if cut else None

    for batch in batches:
        for part in range(0, batch.num_rows, SHARD):
            held.append(pa.Table.from_batches([batch.slice(part, SHARD)]))
            size += held[-1].num_rows
            if size >= SHARD and (out := ready(False)) is not None:
                yield out
    if held and (out := ready(True)) is not None:
        yield out


def _window_by_window(strings: DataFrame) -> DataFrame:
    """Spans of the windows in the strings that also begin earlier, by the earliest place of each window."""
    each = F.expr("sequence(0, cast((packed >> 8) & 255 as int) - 1)")
    windows = strings.select(
        "anchor", "id", "tie", F.shiftright("packed", 16).alias("from"), "string", F.explode(each).alias("k")
    )
    window = F.substring("string", F.col("k") + 1, F.lit(LENGTH))
    windows = windows.select(
        "anchor", F.xxhash64(window).alias("window"), F.crc32(window).alias("check"), "id", "tie",
        (F.col("from") + F.col("k")).alias("start"),
    )
    windows, keys = settle(windows, "windows"), ["anchor", "window", "check"]
    here = F.struct("id", "tie", "start")
    earliest = windows.groupBy(*keys).agg(F.min(here).alias("first"))
    return windows.join(earliest, keys).where(~F.col("first").eqNullSafe(here)).select(
        "id", "tie", "start", (F.col("start") + LENGTH).alias("end")
    )


SPANS = "array<struct<start:bigint,end:bigint>>"


def repeated_spans(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> tuple[DataFrame, DataFrame]:
    """The rows (id, tie, text) of ``docs``, and (id, tie, spans) for those with bytes that other documents hold earlier.

    ``tie`` tells apart texts that share an id (or have none); rows that are equal in both are one document. A null id
    comes before all others. Spans may overlap; those within a document alone are not among them.
    """
    rows = narrow(docs, id=id_column, text=text_column)
    kind = dict(rows.dtypes)["id"]
    shared = rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR id IS NULL").limit(1).count()
    rows = rows.select("id", (F.xxhash64("text") if shared else F.lit(0).cast("long")).alias("tie"), "text")
    place = f"id {kind}, tie bigint"

    anchors = rows.mapInArrow(_scan_anchors, "anchor bigint")
    repeated = settle(anchors.groupBy("anchor").count().where("count > 1").select("anchor"), "anchors")
    found = rows.mapInArrow(_scan_stretches, f"anchor bigint, whole bigint, {place}, packed bigint")
    found = settle(found.join(repeated, "anchor", "left_semi"), "stretches")

    # equal stretches: all but the earliest go as a whole
    first = found.groupBy("anchor", "whole").agg(F.min(F.struct("id", "tie", "packed")).alias("first"))
    first = settle(first, "first")
    same = F.col("first").eqNullSafe(F.struct("id", "tie", "packed"))
    begin = F.shiftright("packed", 16)
    windows = F.shiftright("packed", 8).bitwiseAND(F.lit(0xFF))
    as_a_whole = found.join(first, ["anchor", "whole"]).where(~same).select(
        "id", "tie", begin.alias("start"), (begin + windows + LENGTH - 1).alias("end")
    )

    # different stretches of one anchor: what has to be compared
    many = first.groupBy("anchor").count().where("count > 1")
    wanted = settle(first.join(many, "anchor").select("anchor", "first.*", "count"), "wanted")
    share = wanted.count() // int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    is_hot = F.col("count") > min(max(share, HOT_LEAST), HOT_MOST)
    lists = wanted.groupBy("id", "tie").agg(F.collect_list(F.struct("anchor", "packed")).alias("wanted"))
    lists = lists.select(F.col("id").alias("of"), F.col("tie").alias("of_tie"), "wanted")
    listed = rows.join(lists, F.col("id").eqNullSafe(F.col("of")) & (F.col("tie") == F.col("of_tie")))
    strings = listed.select("id", "tie", "text", "wanted").mapInArrow(
        _cut_strings, f"anchor bigint, {place}, packed bigint, string binary"
    )
    hot = settle(wanted.where(is_hot).select("anchor").distinct(), "hot")
    strings = settle(strings, "strings")
    cold = strings if hot.isEmpty() else strings.join(hot, "anchor", "left_anti")
    cold = cold.repartition("anchor").sortWithinPartitions("anchor")
    by_column = cold.mapInArrow(_collections, f"{place}, start bigint, end bigint")
    spans = as_a_whole.unionByName(by_column)
    if not hot.isEmpty():
        spans = spans.unionByName(_window_by_window(strings.join(hot, "anchor", "left_semi")))
    spans = spans.groupBy("id", "tie").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    return rows, settle(spans, "spans")


def merged(spans: np.ndarray) -> np.ndarray:
    """Spans (start, end) that do not meet, from any."""
    if not len(spans):
        return spans.reshape(0, 2)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.concatenate([[True], spans[1:, 0] > reach[:-1]])
    begin = np.flatnonzero(new)
    return np.stack([spans[begin, 0], reach[np.concatenate([begin[1:] - 1, [len(spans) - 1]])]], axis=1)


def all_spans(texts: list[bytes], others: list[list]) -> list[np.ndarray]:
    """Spans to remove from each text: ``others``, and stretches that are equal to an earlier one of the same text."""
    found = stretches(texts)
    again = ~_own(found)
    text, start, windows = (x[again] for x in found[:3])
    own = np.stack([start, start + windows + LENGTH - 1], axis=1)
    order = np.argsort(text, kind="stable")
    parts = np.split(own[order], np.searchsorted(text[order], np.arange(1, len(texts)))) if texts else []
    return [merged(np.concatenate([part, np.array(more, np.int64).reshape(-1, 2)])) for part, more in zip(parts, others)]


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": [], "spans": []}
        texts = _texts(batch)
        others = [[(s["start"], s["end"]) for s in spans or ()] for spans in batch.column("spans").to_pylist()]
        for data, found in zip(texts, all_spans(texts, others)):
            kept, at = hashlib.sha256(), 0
            for start, end in found.tolist():
                kept.update(data[at:start])
                at = end
            kept.update(data[at:])
            out["n_bytes"].append(len(data))
            out["n_removed"].append(int((found[:, 1] - found[:, 0]).sum()))
            out["n_spans"].append(len(found))
            out["kept_sha256"].append(kept.hexdigest())
            out["spans"].append([{"start": a, "end": b} for a, b in found.tolist()])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id"), pa.array(out["n_bytes"], pa.int64()), pa.array(out["n_removed"], pa.int64()),
                pa.array(out["n_spans"], pa.int64()), pa.array(out["kept_sha256"], pa.string()),
                pa.array(out["spans"], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            ],
            ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"],
        )


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_removed, n_spans, kept_sha256, spans (bytes, end exclusive).

    A null text is empty; texts under ``LENGTH`` bytes lose nothing; rows with equal id and text are one document and get
    equal results; a null id is the smallest; no rows give no rows; other columns are ignored.
    """
    rows, spans = repeated_spans(docs, id_column, text_column)
    spans = spans.select(F.col("id").alias("of"), F.col("tie").alias("of_tie"), "spans")
    both = rows.join(spans, F.col("id").eqNullSafe(F.col("of")) & (F.col("tie") == F.col("of_tie")), "left")
    kind = dict(rows.dtypes)["id"]
    out = both.select("id", "text", "spans").mapInArrow(
        _kept, f"id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans {SPANS}"
    )
    return out.withColumnRenamed("id", id_column)
