"""Token counts of whole texts by a public tokenizer (operator 8).

Batches go through Arrow and only lengths come back. The texts of a batch are cut into words at places that no
token can span; the distinct words that the worker has not met yet are encoded together, in groups of about equal
bytes, and a text's count is the sum over its words. So a long text is never encoded in one piece.

A cut before a run of spaces is safe when no piece of the vocabulary holds the space mark after another character:
merges then never cross it. The tokenizer puts a space mark before a text, which stands for the space that the cut
removed. ``SafeCounter`` looks this up in the vocabulary and encodes whole texts where it does not hold.
"""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import narrow

#: Bytes of words that are encoded in one call.
BATCH_BYTES = 256 << 10
#: Words whose lengths a worker remembers before it starts anew.
REMEMBERED = 400_000

MARK = "▁"  # stands for a space in the vocabulary

_counters: dict = {}


class SafeCounter:
    """Token counts of texts by a sentencepiece model, word by word where that is safe."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = (self.model.id_to_piece(i) for i in range(self.model.get_piece_size()))
        self.safe = not any(MARK in p.lstrip(MARK) for p in pieces) and self.counts(["a  b", " a "]) == [
            len(self.model.encode("a")) + len(self.model.encode(" b")),
            len(self.model.encode(" a")) + 1,
        ]
        self.known: dict[str, int] = {}

    def counts(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.model.encode(texts, num_threads=1)]

    def cut(self, text: str) -> list[str]:
        """The words of a text; encoding each gives the tokens of the text. The empty word is a lone space mark."""
        words = text.split(" ")
        if "" not in words:
            return words
        out, spaces = [], 0
        for word in words:
            if word:
                out.append(" " * spaces + word)
                spaces = 0
            else:
                spaces += 1
        if spaces:  # the mark before the first of them is the cut itself
            out.append(" " * (spaces - 1))
        return out

    def learn(self, words: Iterable[str]) -> None:
        batch, size = [], 0
        for word in words:
            batch.append(word)
            size += len(word.encode("utf-8", "replace"))
            if size >= BATCH_BYTES:
                self.known.update(zip(batch, self.counts(batch)))
                batch, size = [], 0
        if batch:
            self.known.update(zip(batch, self.counts(batch)))

    def lengths(self, texts: Iterable[str | None]) -> list[int]:
        out = []
        for text in texts:
            if not text:
                out.append(0)
            elif not self.safe or MARK in text:
                out.append(self.counts([text])[0])
            else:
                words = self.cut(text)
                if new := set(words).difference(self.known):
                    if len(self.known) + len(new) > REMEMBERED:
                        self.known.clear()
                        new = set(words)
                    self.known[""] = 1
                    new.discard("")
                    self.learn(new)
                out.append(sum(map(self.known.__getitem__, words)))
        return out


def counter(path: str) -> SafeCounter:
    """One per worker process and model."""
    if path not in _counters:
        _counters[path] = SafeCounter(path)
    return _counters[path]


def token_count(text: Column | str, path: str) -> Column:
    """Tokens of a text column by the sentencepiece model at ``path`` (a path that every worker can read)."""

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        return pd.Series(counter(path).lengths(texts), dtype="int64")

    return count(text)


def count_tokens(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text", limit: int = 4096) -> DataFrame:
    """One row per row of ``docs``: id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    A null or empty text has 0 bytes and 0 tokens; ids may be null or repeated, every row is counted; no rows give
    no rows; other columns are ignored.
    """
    rows = narrow(docs, id=id_column, text=text_column)
    return rows.select(
        F.col("id").alias(id_column),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        token_count("text", path).alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > limit)
