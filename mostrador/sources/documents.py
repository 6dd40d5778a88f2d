"""One JSON document as JSON Lines: the records of several arrays inside it, chunk by chunk, with bounded memory.

What a bracket means is told by what precedes it, so the chunks are read three times before their records are: for the
quotes in each, which tell whether the next begins inside a string; for the brackets that each leaves open or closes, which
tell where in the document the next begins; for the rest of a record that began in the chunk before. The driver holds a few
names for each chunk, and nothing of the records.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import settle

# The document is cut before every "{", so that no more than a record is ever one value. A brace cannot be escaped,
# so no escape sequence is cut.
CUT = "{"
_TOKEN = re.compile(r'"[^"\\]*(?:\\.[^"\\]*)*"|"|[{}\[\]]', re.S)
_STRING_END = re.compile(r'[^"\\]*(?:\\.[^"\\]*)*"', re.S)
# A record that holds no other, up to the next one: nothing is open after it that was not before.
_FLAT = re.compile(r'\{[^{}\[\]"]*+(?:"[^"\\]*+(?:\\.[^"\\]*+)*+"[^{}\[\]"]*+)*+\}[^{}\[\]"]*+', re.S)
_BREAKS = str.maketrans("\r\n", "  ")
#: Characters of records that are passed on at once.
BATCH = 4 << 20

#: Marks instead of a record: the section is there; it is there and no list.
FOUND, NO_LIST = "", "!"


#: Instead of a name: the last string before the chunk.
BEFORE = True
MALFORMED = "malformed JSON document: {}"


class Outline:
    """What a chunk closes that is open before it, and what it leaves open, with the names that are ``steps`` of a path."""

    def __init__(self, steps: set[str], in_string: bool):
        self.steps, self.in_string = steps, in_string
        self.closed: list[str] = []
        self.opened: list[tuple[str, str | bool | None]] = []
        self.last: str | bool | None = BEFORE
        self.begun = False

    def feed(self, piece: str) -> None:
        if not self.in_string and _FLAT.fullmatch(piece):
            self.begun = True
            return
        at = 0
        while True:
            if self.in_string:
                end = _STRING_END.match(piece, at)
                if not end:
                    return
                at, self.in_string, self.last = end.end(), False, None
            token = _TOKEN.search(piece, at)
            if not token:
                return
            text, at = token[0], token.end()
            if text == '"':
                self.in_string = True
            elif text[0] == '"':
                self.last = text[1:-1] if text[1:-1] in self.steps else None
            else:
                self.begun = True
                if text in "{[":
                    self.opened.append(("}" if text == "{" else "]", self.last))
                elif not self.opened:
                    self.closed.append(text)
                elif self.opened.pop()[0] != text:
                    raise ValueError(MALFORMED.format("brackets do not match"))


@dataclass
class Chunk:
    """Where in the document a chunk begins."""

    number: int
    pieces: int
    in_string: bool
    path: list[str | None]
    kinds: list[str]
    last: str | None
    begun_in: int | None  # the chunk in which the record began that is open before this one


class Splitter:
    """Follows a document piece by piece and gives (section, record) for the objects in the arrays at some paths.

    What lies elsewhere is passed over. Only the record that is being read is held. After ``resume`` the first record is
    the rest of the one that is open there, if any is.
    """

    def __init__(self, sections: Mapping[str, str]):
        self.wanted = {tuple(path.split(".")): name for name, path in sections.items()}
        self.deepest = max(map(len, self.wanted))
        self.path: list[str | None] = []  # the name of every open value; None in an array
        self.kinds: list[str] = []
        self.last: str | None = None  # the last string near the top: the name of the value that follows it
        self.in_string = False
        self.record: list[str] | None = None
        self.record_depth, self.section = 0, ""
        self.begun = False

    def resume(self, chunk: Chunk) -> Splitter:
        self.path, self.kinds, self.last, self.in_string = [*chunk.path], [*chunk.kinds], chunk.last, chunk.in_string
        if depth := self.record_of(chunk.path, chunk.kinds):
            self.record, self.record_depth, self.section = [""], depth, self.wanted[tuple(chunk.path[1 : depth - 1])]
        return self

    def record_of(self, path: list[str | None], kinds: list[str]) -> int:
        """The depth of the outermost wanted record that is open there, else 0."""
        for k in range(1, min(len(kinds), self.deepest + 2)):
            if kinds[k - 1 : k + 1] == ["]", "}"] and tuple(path[1:k]) in self.wanted:
                return k + 1
        return 0

    def feed(self, piece: str) -> Iterator[tuple[str, str]]:
        at, kept = 0, 0
        while True:
            if self.in_string:
                end = _STRING_END.match(piece, at)
                if not end:
                    break
                at, self.in_string, self.last = end.end(), False, None
            token = _TOKEN.search(piece, at)
            if not token:
                break
            text, at = token[0], token.end()
            if text == '"':
                self.in_string = True
            elif text[0] == '"':
                if len(self.kinds) <= self.deepest:
                    self.last = text[1:-1]
            elif text in "{[":
                yield from self._open(text)
                if self.record == []:
                    kept, self.record = token.start(), [""]
            else:
                if not self.kinds or self.kinds.pop() != text:
                    raise ValueError(MALFORMED.format("brackets do not match"))
                self.path.pop()
                if self.record is not None and len(self.kinds) < self.record_depth:
                    yield self.section, "".join([*self.record, piece[kept:at]]).translate(_BREAKS)
                    self.record = None
        if self.record is not None:
            self.record.append(piece[kept:])

    def _open(self, text: str) -> Iterator[tuple[str, str]]:
        depth, self.begun = len(self.kinds), True
        inside = self.kinds[-1] if self.kinds else None
        name = self.last if inside == "}" and depth <= self.deepest else None
        if self.record is None and text == "{" and inside == "]" and tuple(self.path[1:]) in self.wanted:
            self.section = self.wanted[tuple(self.path[1:])]
            self.record, self.record_depth = [], depth + 1
        self.path.append(name)
        self.kinds.append("}" if text == "{" else "]")
        if self.record is None and (section := self.wanted.get(tuple(self.path[1:]))) and inside == "}":
            yield section, FOUND if text == "[" else NO_LIST

    def finish(self) -> None:
        if self.kinds or self.in_string or not self.begun:
            raise ValueError(MALFORMED.format("it ends too early"))


def _chunks(batches: Iterable[pa.RecordBatch], begin: Callable, feed: Callable, end: Callable) -> Iterator:
    """``begin`` (file, place), ``feed`` (state, piece) and ``end`` (state, number of pieces) for the chunks of a task, one by
    one; what the last two yield."""
    key, state, n = None, None, 0
    for arrived in batches:
        for piece, file, place in zip(*(arrived.column(c).to_pylist() for c in ("value", "file", "place"))):
            if key != (file, place):
                if key:
                    yield from end(state, n)
                key, n = (file, place), 0
                state = begin(key)
                piece = piece if place == 0 else CUT + piece
            else:
                piece = CUT + piece
            n += 1
            yield from feed(state, piece)
    if key:
        yield from end(state, n)


def _batches(rows: Iterable[tuple], schema: pa.Schema, text: int) -> Iterator[pa.RecordBatch]:
    """Rows in batches of about ``BATCH`` characters of the column ``text``."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[text])
        if size > BATCH:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


_KEY = [("file", pa.string()), ("place", pa.int64())]


def _quotes(pieces: DataFrame) -> list:
    """For each chunk in its order: (file, place, pieces, odd: whether it ends inside a string if it does not begin so)."""
    plain = F.when(F.contains("value", F.lit("\\")), F.regexp_replace("value", r"(?s)\\.", "")).otherwise(F.col("value"))
    quotes = F.sum(F.octet_length(plain) - F.octet_length(F.replace(plain, F.lit('"'))))
    found = pieces.groupBy("file", "place").agg(F.count(F.lit(1)).alias("pieces"), (quotes % 2 == 1).alias("odd"))
    return sorted(found.collect(), key=lambda r: (r.file, r.place))


def _outlines(pieces: DataFrame, quotes: list, steps: set[str]) -> dict[tuple[str, int], dict]:
    begins, inside = {}, False
    for r in quotes:
        begins[r.file, r.place] = inside
        inside ^= r.odd
    schema = pa.schema([*_KEY, ("pieces", pa.int64()), ("outline", pa.string())])

    def outline(batches):
        def begin(key):
            return key, Outline(steps, begins[key])

        def feed(state, piece):
            state[1].feed(piece)
            return ()

        def end(state, n):
            yield *state[0], n, json.dumps(vars(state[1]) | {"steps": None})

        return _batches(_chunks(batches, begin, feed, end), schema, 3)

    found = pieces.mapInArrow(outline, "file string, place bigint, pieces bigint, outline string").collect()
    return {(r.file, r.place): json.loads(r.outline) | {"pieces": r.pieces} for r in found}


def _followed(quotes: list, outlines: dict, sections: Mapping[str, str]) -> dict[tuple[str, int], Chunk]:
    """Where each chunk begins. A file after one whose document is complete begins the next document."""
    whole = Splitter(sections)  # follows the outlines instead of the text
    path, kinds, last, in_string, begun, begun_in, out = [], [], None, False, False, None, {}
    for number, r in enumerate(quotes):
        if r.place == 0 and number and not kinds and not in_string:
            if not begun:
                raise ValueError(MALFORMED.format("it ends too early"))
            begun, last = False, None
        found = outlines[r.file, r.place]
        out[r.file, r.place] = Chunk(number, r.pieces, in_string, [*path], [*kinds], last, begun_in)
        for kind in found["closed"]:
            if not kinds or kinds.pop() != kind:
                raise ValueError(MALFORMED.format("brackets do not match"))
            path.pop()
        kept = len(kinds)
        for kind, name in found["opened"]:
            path.append((last if name is BEFORE else name) if kinds and kinds[-1] == "}" else None)
            kinds.append(kind)
        last = last if found["last"] is BEFORE else found["last"]
        if found["pieces"] != r.pieces or found["in_string"] != in_string ^ r.odd:
            raise ValueError(MALFORMED.format("a backslash outside of a string"))
        in_string, begun = found["in_string"], begun or found["begun"]
        depth = whole.record_of(path, kinds)
        begun_in = None if not depth else number if depth > kept else begun_in
    if quotes and (kinds or in_string or not begun):
        raise ValueError(MALFORMED.format("it ends too early"))
    return out


def _rests(pieces: DataFrame, chunks: dict[tuple[str, int], Chunk], sections: Mapping[str, str]) -> DataFrame:
    """(begun_in, rest): what follows of the record that is open at the end of a chunk, by the number of the chunk."""
    schema = pa.schema([("begun_in", pa.int64()), ("number", pa.int64()), ("rest", pa.string())])

    def rest(batches):
        def begin(key):
            chunk = chunks[key]
            return [chunk, None if chunk.begun_in is None else Splitter(sections).resume(chunk)]

        def feed(state, piece):
            chunk, splitter = state
            if splitter:
                for _, value in splitter.feed(piece):
                    state[1] = None
                    yield chunk.begun_in, chunk.number, value
                    return

        def end(state, n):
            chunk, splitter = state
            if splitter:
                yield chunk.begun_in, chunk.number, "".join(splitter.record).translate(_BREAKS)

        return _batches(_chunks(batches, begin, feed, end), schema, 2)

    found = pieces.mapInArrow(rest, "begun_in bigint, number bigint, rest string")
    parts = F.sort_array(F.collect_list(F.struct("number", "rest")))
    return settle(found.groupBy("begun_in").agg(F.concat_ws("", F.transform(parts, lambda x: x.rest)).alias("rest")), "rests")


def _records(sections: Mapping[str, str], chunks: dict[tuple[str, int], Chunk]):
    schema = pa.schema([("section", pa.string()), ("value", pa.string()), ("begun_in", pa.int64())])

    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def begin(key):
            if key not in chunks:
                raise ValueError(f"{key[0]} is read in other chunks than it was looked through")
            return [chunks[key], Splitter(sections).resume(chunks[key]), chunks[key].begun_in is not None]

        def feed(state, piece):
            for section, value in state[1].feed(piece):
                if state[2]:  # the rest of a record of the chunk before
                    state[2] = False
                else:
                    yield section, value, None

        def end(state, n):
            chunk, splitter, other = state
            if n != chunk.pieces:
                raise ValueError("the document is read in other chunks than it was looked through")
            if splitter.record is not None and not other:
                yield splitter.section, "".join(splitter.record).translate(_BREAKS), chunk.number

        return _batches(_chunks(batches, begin, feed, end), schema, 1)

    return split


#: The least number of chunks of an input, which is the number of cores at the time if nothing is set.
CHUNKS = "spark.sql.files.minPartitionNum"


@contextmanager
def same_chunks(spark: SparkSession) -> Iterator[None]:
    """Files are read in the same chunks within, also when executors come or go."""
    before = spark.conf.get(CHUNKS, None)
    spark.conf.set(CHUNKS, before or str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.unset(CHUNKS) if before is None else spark.conf.set(CHUNKS, before)


def split_document(spark: SparkSession, path: str, sections: Mapping[str, str]) -> DataFrame:
    """(section, value): the records of the arrays at ``sections`` (name to dotted path).

    An empty value marks a section that is there. Each chunk of the document, of ``spark.sql.files.maxPartitionBytes`` at
    most, is followed by one task, from the place in the document where it begins. ``path`` may be a folder of documents, or
    of the parts of a document that is cut between two lines, which follow each other by their names. Use the result within
    ``same_chunks``.
    """
    pieces = spark.read.option("lineSep", CUT).text(path).select(
        "value", "_metadata.file_path", "_metadata.file_block_start"
    ).toDF("value", "file", "place")
    with same_chunks(spark):
        quotes = _quotes(pieces)
        outlines = _outlines(pieces, quotes, {step for where in sections.values() for step in where.split(".")})
        chunks = _followed(quotes, outlines, sections)
        rests = _rests(pieces, chunks, sections) if any(c.begun_in is not None for c in chunks.values()) else None
    found = pieces.mapInArrow(_records(sections, chunks), "section string, value string, begun_in bigint")
    if rests:  # about one record for each chunk
        found = found.join(F.broadcast(rests), "begun_in", "left").withColumn("value", F.concat("value", F.coalesce("rest", F.lit(""))))
    return found.select("section", "value")
