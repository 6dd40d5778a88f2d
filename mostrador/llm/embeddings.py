"""Near-duplicate embeddings by an inverted multi-index (operator 3).

Vectors are cut in halves; a codebook for each half, fitted on a bounded sample, makes the grid of cells that indexes every
vector. From a vector the cells are visited in the order of their distance: the sums of the two halves' distances, of
which a multi-sequence traversal always takes the smallest next. It ends at the number of cells that reaches the target
recall both for made pairs right at the similarity bound, in random directions, and for the real pairs near the bound of some
vectors of the sample, which are compared with all vectors.

A vector does not travel to the cells it visits: its number does, with a code of two bits for each component and the angle between
vector and code. A member of the cell can be linked only if its angle to the code is at most the angle of the bound and that
angle together, so that what the code rules out is no link. Vectors are fetched only for visitors left in a block of members,
and these pairs are verified in double precision.

Only vectors of one label are compared. Equal vectors are one entry. Cells are dealt in blocks of about ``BLOCK`` vectors, and blocks of
visitors meet blocks of members as matrices, so that a cell may hold any number of vectors. A pair of blocks gives
back counts of links and a spanning forest of them, not the pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mostrador.session import settle

from .common import narrow
from .components import components

SIMILARITY = 0.93
#: Vectors that the codebooks and the number of visited cells are fitted on, at most, and the bytes of these.
SAMPLE, SAMPLE_BYTES = 8192, 1 << 26
#: Vectors of the sample whose real pairs are found.
QUERIES = 256
#: Share of pairs at the similarity bound whose cells are visited from each side.
RECALL = 0.99
#: Vectors of a block; vectors for each cell of the grid; most codewords of a half.
BLOCK, PER_CELL, CODEWORDS = 256, 512, 1024
#: Two bits for each component: its sign, and whether it is over ``STEP`` times the mean size; the levels that these stand for.
STEP, LEVELS = 0.98, (0.453, 1.51)


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows at length one; rows whose squares leave the range of doubles are scaled first."""
    with np.errstate(over="ignore", under="ignore"):
        norm = np.linalg.norm(x, axis=1, keepdims=True)
    odd = ~((norm > 1e-140) & (norm < 1e140))[:, 0]
    if odd.any():
        x = x.copy()
        x[odd] /= np.abs(x[odd]).max(axis=1, keepdims=True)
        norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / norm


def _coded(x: np.ndarray, dims: np.ndarray) -> list[bytes]:
    """Two bits for each component of unit rows, of which row i has ``dims[i]``, and a byte with the angle to them, rounded up."""
    own = np.arange(x.shape[1]) < dims[:, None]
    sign, large = x < 0, np.abs(x) > STEP / np.sqrt(dims)[:, None]
    code = np.where(own, np.where(large, LEVELS[1], LEVELS[0]) * np.where(sign, -1, 1), 0)
    cosine = (x * code).sum(axis=1) / np.linalg.norm(code, axis=1)
    angle = np.ceil(np.arccos(np.clip(cosine, 0, 1)) / (np.pi / 2) * 255)
    bits = np.concatenate([np.packbits(sign, axis=1), np.packbits(large, axis=1), angle.astype(np.uint8)[:, None]], axis=1)
    return [row.tobytes() for row in bits]


def _decoded(codes: list[bytes], dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of ``dim`` components that codes stand for, and the most that their vectors' angles to them may be."""
    bits = np.frombuffer(b"".join(codes), np.uint8).reshape(len(codes), -1)
    half = bits.shape[1] // 2
    sign = np.unpackbits(bits[:, :half], axis=1, count=dim)
    large = np.unpackbits(bits[:, half:-1], axis=1, count=dim)
    code = np.where(large, LEVELS[1], LEVELS[0]) * (1.0 - 2.0 * sign)
    return code / np.linalg.norm(code, axis=1, keepdims=True), bits[:, -1] * (np.pi / 2 / 255)


def _halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    middle = x.shape[1] // 2
    return x[:, :middle], x[:, middle:]


def _distances(x: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.maximum((x**2).sum(1)[:, None] - 2 * x @ words.T + (words**2).sum(1), 0)


def _codebook(x: np.ndarray, k: int, rng) -> np.ndarray:
    """``k`` means of the rows."""
    words = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(12):
        near = _distances(x, words).argmin(axis=1)
        for i in range(len(words)):
            if (near == i).any():
                words[i] = x[near == i].mean(axis=0)
    return words


class MultiIndex:
    """Two codebooks, and how many cells of their grid a search visits."""

    def __init__(self, sample: np.ndarray, total: int, similarity: float = SIMILARITY, seed: int = 5):
        rng = np.random.default_rng(seed)
        k = int(min(CODEWORDS, max(2, round(math.sqrt(total / PER_CELL))), max(1, len(sample))))
        self.books = [_codebook(half, k, rng) for half in _halves(sample)]
        self.width = sample.shape[1]
        self.visits = len(self.books[0]) * len(self.books[1])
        if len(sample):
            # partners at the bound, in random directions, from up to 2000 vectors of the sample
            some = sample[rng.permutation(len(sample))[:2000]]
            other = rng.normal(size=some.shape)
            other -= (other * some).sum(1, keepdims=True) * some
            other /= np.maximum(np.linalg.norm(other, axis=1, keepdims=True), 1e-12)
            partner = similarity * some + math.sqrt(1 - similarity**2) * other
            cells = self.cells(partner)
            a, b = (_distances(h, w) for h, w in zip(_halves(some), self.books))
            rank = []
            for i, cell in enumerate(cells):
                sums = (a[i][:, None] + b[i]).ravel()
                rank.append(np.count_nonzero(sums < sums[cell]))
            self.visits = int(np.quantile(rank, RECALL)) + 1

    def ranks(self, queries: np.ndarray, vectors: np.ndarray, alike: np.ndarray, similarity: float = SIMILARITY) -> np.ndarray:
        """For each pair of a query and a vector that are ``alike`` and near the bound, how many cells come before the vector's."""
        cosine = queries @ vectors.T
        query, vector = np.nonzero(alike & (cosine >= similarity) & (cosine <= (1 + similarity) / 2))
        cells, out = self.cells(vectors), [np.zeros(0, np.int64)]
        a, b = (_distances(h, w) for h, w in zip(_halves(queries), self.books))
        for q in np.unique(query):
            sums = (a[q][:, None] + b[q]).ravel()
            out.append(np.searchsorted(np.sort(sums), sums[cells[vector[query == q]]]))
        return np.concatenate(out)

    def fit_visits(self, ranks: np.ndarray, counts: np.ndarray) -> None:
        """Visit at least as many cells as ``RECALL`` of the pairs need."""
        if len(ranks):
            order = np.argsort(ranks)
            enough = np.searchsorted(np.cumsum(counts[order]), RECALL * counts.sum())
            self.visits = max(self.visits, int(ranks[order][min(enough, len(ranks) - 1)]) + 1)

    def prepared(self, vectors: list) -> np.ndarray:
        """Unit vectors, with zeros up to the common width."""
        out = np.zeros((len(vectors), self.width))
        for i, v in enumerate(vectors):
            out[i, : len(v)] = v
        return _unit(out)

    def cells(self, x: np.ndarray) -> np.ndarray:
        first, second = (_distances(h, b).argmin(axis=1) for h, b in zip(_halves(x), self.books))
        return first * len(self.books[1]) + second

    def traverse(self, x: np.ndarray, visits: int) -> np.ndarray:
        """The ``visits`` nearest cells of each row, nearest first.

        Each codeword of the first half holds a pointer to the next one of the second half, by distance; the smallest
        of the sums that the pointers show is visited next, and its pointer moves on.
        """
        a, b = (_distances(h, w) for h, w in zip(_halves(x), self.books))
        order = b.argsort(axis=1)
        b = np.concatenate([np.take_along_axis(b, order, axis=1), np.full((len(x), 1), np.inf)], axis=1)
        pointer = np.zeros(a.shape, np.int64)
        front = a + b[:, :1]
        out, row = np.empty((len(x), visits), np.int64), np.arange(len(x))
        for step in range(visits):
            first = front.argmin(axis=1)
            out[:, step] = first * len(self.books[1]) + order[row, pointer[row, first]]
            pointer[row, first] += 1
            front[row, first] = a[row, first] + b[row, pointer[row, first]]
        return out


def _real_ranks(entries: DataFrame, index: MultiIndex, queries: list, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of the real pairs of ``queries`` (rows of label, dim, embedding) with all entries, and how many have each."""
    labels = np.array([q.label for q in queries], object)
    dims = np.array([q.dim for q in queries])
    held = entries.sparkSession.sparkContext.broadcast((index, index.prepared([q.embedding for q in queries]), labels, dims))

    def find(batches):
        index, x, labels, dims = held.value
        for batch in batches:
            for start in range(0, len(batch), 4096):
                part = batch.iloc[start : start + 4096]
                alike = labels[:, None] == part["label"].to_numpy(object)[None, :]
                alike = alike.astype(bool) & (dims[:, None] == part["dim"].to_numpy()[None, :])
                ranks, n = np.unique(index.ranks(x, index.prepared(part["embedding"].tolist()), alike, similarity), return_counts=True)
                yield pd.DataFrame({"rank": ranks, "n": n})

    found = entries.select("label", "dim", "embedding").mapInPandas(find, "rank bigint, n bigint")
    found = found.groupBy("rank").agg(F.sum("n").alias("n")).collect()  # at most one row for each cell of the grid
    return np.array([r.rank for r in found], np.int64), np.array([r.n for r in found], np.int64)


def _indexed(entries: DataFrame, index: MultiIndex) -> DataFrame:
    held = entries.sparkSession.sparkContext.broadcast(index)

    @F.pandas_udf("cell int, visits array<int>, code binary")
    def place(vectors: pd.Series) -> pd.DataFrame:
        index, cells, visits, codes = held.value, [], [], []
        for start in range(0, len(vectors), 1024):
            part = vectors[start : start + 1024].tolist()
            x = index.prepared(part)
            codes += _coded(x, np.array([len(v) for v in part]))
            cells += index.cells(x).tolist()
            visits += list(index.traverse(x, index.visits).astype(np.int32))
        return pd.DataFrame({"cell": cells, "visits": visits, "code": codes})

    return entries.withColumn("place", place("embedding")).select("*", "place.cell", "place.visits", "place.code").drop("place")


def _forest(links: np.ndarray, nodes: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what the links (pairs of numbers of ``nodes``) connect."""
    parent = list(range(len(nodes)))

    def top(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    out = []
    for i, j in links.tolist():
        a, b = top(i), top(j)
        if a != b:
            parent[max(a, b)] = min(a, b)
            out.append((int(nodes[i]), int(nodes[j])))
    return out


def _screened(batches, similarity: float):
    """(block, entry): visitors that may be linked with a member of a block, by their codes."""
    bound = math.acos(min(max(similarity, -1.0), 1.0)) + 1e-6
    for batch in batches:
        blocks, entries = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        columns = [batch.column(c) for c in ("block", "dim", "members", "vectors", "visitors", "codes")]
        for block, dim, members, vectors, visitors, codes in zip(*columns):
            dim = dim.as_py()
            m_id, v_id = members.values.to_numpy(), visitors.values.to_numpy()
            m = _unit(vectors.values.flatten().to_numpy().astype(np.float64).reshape(len(m_id), dim))
            code, angle = _decoded(codes.as_py(), dim)
            least = np.cos(np.minimum(bound + angle, np.pi))
            near = ((code @ m.T >= least[:, None] - 1e-9) & (v_id[:, None] != m_id)).any(axis=1)
            entries.append(v_id[near])
            blocks.append(np.full(near.sum(), block.as_py(), np.int64))
        yield pa.RecordBatch.from_pydict({"block": np.concatenate(blocks), "entry": np.concatenate(entries)})


def _verified(batches, similarity: float):
    """For each pair of blocks: links to add to entries, and a forest of the links."""
    for batch in batches:
        out = {"a": [], "b": [], "links": []}
        for row in batch.to_pylist():
            members, visitors = row["members"], row["visitors"]
            m = _unit(np.array([x["embedding"] for x in members], np.float64))
            v = _unit(np.array([x["embedding"] for x in visitors], np.float64))
            m_id, v_id = np.array([x["entry"] for x in members]), np.array([x["entry"] for x in visitors])
            linked = (v @ m.T >= similarity) & (v_id[:, None] != m_id)
            if not linked.any():
                continue
            m_n, v_n = np.array([x["n"] for x in members]), np.array([x["n"] for x in visitors])
            # a member that visits the visitor's cell counts the link there
            seen = [set(x["visits"]) for x in members]
            cell = [x["cell"] for x in visitors]
            i, j = np.nonzero(linked)
            back = np.fromiter((cell[a] in seen[b] for a, b in zip(i, j)), bool, len(i))
            for ids, count in (
                (v_id, np.bincount(i, m_n[j], len(v))), (m_id, np.bincount(j[~back], v_n[i[~back]], len(m)))
            ):
                some = np.flatnonzero(count)
                out["a"] += ids[some].tolist()
                out["b"] += [None] * len(some)
                out["links"] += count[some].astype(np.int64).tolist()
            for a, b in _forest(np.stack([i, j + len(v)], axis=1), np.concatenate([v_id, m_id])):
                out["a"].append(a)
                out["b"].append(b)
                out["links"].append(None)
        yield pa.RecordBatch.from_pydict(out, schema=pa.schema([(k, pa.int64()) for k in ("a", "b", "links")]))


def _blocks(rows: DataFrame, keys: list[str], columns: list[str], name: str) -> DataFrame:
    """Arrays of about ``BLOCK`` of the rows of each key, whose blocks are dealt to tasks one by one."""
    # a written table of counts is broadcast if it is small, so that rows are shuffled once, and not by the key alone
    counts = settle(rows.groupBy(*keys).count().select(*keys, F.ceil(F.col("count") / BLOCK).alias("parts")), "counts")
    dealt = rows.join(counts, keys).withColumn("part", F.pmod(F.xxhash64("entry"), F.col("parts"))).repartition(*keys, "part")
    grouped = dealt.groupBy(*keys, "part").agg(F.collect_list(F.struct(*columns)).alias(name))
    return grouped.select(*keys, name)


def link_entries(entries: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(a, b, links): rows with b are links that connect entries, rows without b are numbers of links to add to a.

    ``entries`` has distinct (label, embedding) with entry, rep (its smallest id), dim and n (vectors that are equal).
    """
    total, width = entries.agg(F.count(F.lit(1)), F.max("dim")).first()
    if not total:
        return entries.sparkSession.createDataFrame([], "a bigint, b bigint, links bigint")
    most = max(1, min(SAMPLE, SAMPLE_BYTES // (8 * width)))
    chosen = entries.orderBy(F.xxhash64("embedding"), "entry").limit(most).select("label", "dim", "embedding").collect()
    sample = [r.embedding for r in chosen]
    x = np.zeros((len(sample), max(2, width)))
    for i, v in enumerate(sample):
        x[i, : len(v)] = v
    index = MultiIndex(_unit(x), total, similarity)
    index.fit_visits(*_real_ranks(entries, index, chosen[:QUERIES], similarity))
    placed = settle(_indexed(entries, index), "cells")
    where = ["label", "dim", "cell"]
    members = _blocks(placed, where, ["entry", "n", "embedding", "visits"], "members")
    members = settle(members.withColumn("block", F.monotonically_increasing_id()), "members")
    visiting = placed.select("label", "dim", "entry", "code", F.explode("visits").alias("cell"))
    visitors = settle(_blocks(visiting, where, ["entry", "code"], "visitors"), "visitors")
    met = members.select("block", *where, F.col("members.entry").alias("members"), F.col("members.embedding").alias("vectors")).join(
        visitors.select(*where, F.col("visitors.entry").alias("visitors"), F.col("visitors.code").alias("codes")), where
    )
    met = met.select("block", "dim", "members", "vectors", "visitors", "codes")
    left = settle(met.mapInArrow(lambda batches: _screened(batches, similarity), "block bigint, entry bigint"), "visits")
    fetched = left.join(placed.select("entry", "n", "embedding", "cell"), "entry")
    pairs = members.select("block", "members").join(_blocks(fetched, ["block"], ["entry", "n", "embedding", "cell"], "visitors"), "block")
    pairs = pairs.select("members", "visitors")
    return settle(pairs.mapInArrow(lambda batches: _verified(batches, similarity), "a bigint, b bigint, links bigint"), "links")


def near_duplicates(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label", similarity: float = SIMILARITY
) -> DataFrame:
    """One row per row of ``vectors``: id, n_links (other vectors linked), component_id (smallest id reachable), kept.

    Vectors of one label and one length are linked at a cosine of ``similarity`` or more. A vector that is null, zero or
    holds null or non-finite components, or whose label is null, links with nothing and is its own component. A row without
    an id links with nothing and has no component; rows that share an id are one node of the components. No rows give
    no rows; other columns are ignored.
    """
    rows = narrow(vectors, id=id_column, embedding=vector_column, label=label_column)
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    good = F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
    good = good & F.coalesce(whole, F.lit(False)) & F.coalesce(F.exists("embedding", lambda x: x != 0), F.lit(False))
    able = rows.where(good)
    entries = able.groupBy("label", "embedding").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n"))
    entries = entries.select("*", F.size("embedding").alias("dim"), F.monotonically_increasing_id().alias("entry"))
    entries = settle(entries, "entries")
    found = link_entries(entries.select("entry", "n", "label", "dim", "embedding"), similarity)

    counts = found.where("b IS NULL").groupBy(F.col("a").alias("entry")).agg(F.sum("links").alias("more"))
    of = entries.select("entry", "rep")
    pairs = found.where("b IS NOT NULL").distinct()
    pairs = pairs.join(of.select(F.col("entry").alias("a"), F.col("rep").alias("ra")), "a")
    pairs = pairs.join(of.select(F.col("entry").alias("b"), F.col("rep").alias("rb")), "b")
    # ids that several entries share are one node
    roots = components(pairs.select(F.col("ra").alias("a"), F.col("rb").alias("b")))
    counted = entries.join(counts, "entry", "left").select(
        "label", "embedding", "rep", (F.col("n") - 1 + F.coalesce("more", F.lit(0))).alias("n_links")
    )
    linked = able.join(counted, ["label", "embedding"]).join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    linked = linked.select("id", "n_links", F.coalesce("root", "rep").alias("component_id"))
    alone = rows.where(~good | good.isNull()).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = linked.unionByName(alone)
    return out.select(
        F.col("id").alias(id_column), "n_links", "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )
