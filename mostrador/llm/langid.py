"""Language identification by character language models (operator 5).

One interpolated Kneser-Ney model of order ``ORDER`` per language, learned from every labelled text it may use. A text
is a sequence of lower-case letters in which each run of other characters is one boundary. Executors count the n-grams,
Spark adds the counts; the models are sorted arrays of 64-bit hashes of n-grams and contexts with their logarithms beside
them, looked up by binary search. A text belongs to the language with the lowest cross-entropy per character; the scale
of the confidence and the bounds of the rejection are calibrated on all learnable texts.

Up to ``TYPES`` counted n-grams the models go to every executor. More stay in tables, dealt by n-gram: the same
logarithms are found there by joins, for each distinct n-gram of the texts once, and added up for each text. The order and the
probabilities are the same either way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mostrador.session import settle

from .common import narrow

ORDER = 4
#: Most n-gram types, over all languages, of models that go to every executor.
TYPES = 3_000_000
#: An n-gram of more than one in so many rows is joined without a shuffle.
FREQUENT = 4096
#: Code points that are handled at once.
PIECE, SHARD = 1 << 20, 4 << 20
#: Scales that the confidence is calibrated among, and parts of one for a text, in which its likelihood is added exactly.
SCALES = [float(x) for x in np.geomspace(0.5, 500, 40)]
PARTS = 1e6
#: Intervals that values are counted in, again and again within one of them, until a rank is found.
BINS = 1024
#: Share of a language's own texts that the rejection may refuse.
REFUSED = 0.005
DOUBT = 0.01
UNKNOWN = "und"

_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


def pieces(text: str | None, order: int) -> Iterator[np.ndarray]:
    """The letters (0: boundary) of a text; each array begins with the ``order - 1`` codes before it."""
    text = text or ""
    tail, any_letter = np.zeros(order - 1, np.int32), False
    for start in range(0, len(text), PIECE):
        part = text[start : start + PIECE].lower()
        codes = np.frombuffer(part.encode("utf-32-le", "replace"), np.int32)
        codes = np.where(letters()[codes], codes, 0)
        last = tail[-1] if order > 1 else 0
        keep = (codes != 0) | (np.concatenate([[last], codes[:-1]]) != 0)
        codes = codes[keep]
        if len(codes):
            any_letter = True
            joined = np.concatenate([tail, codes])
            yield joined
            tail = joined[len(joined) - order + 1 :]
    if any_letter and tail[-1:].any():
        yield np.concatenate([tail, np.zeros(1, np.int32)])


def _packed(parts: list[np.ndarray], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All n-grams of the arrays as numbers, the codes that the numbers' 16-bit digits stand for, n-grams per array."""
    flat = np.concatenate(parts)
    known = np.flatnonzero(np.bincount(flat, minlength=1))
    if len(known) > 0xFFFF:
        raise OverflowError
    place = np.zeros(known[-1] + 1, np.uint64)
    place[known] = np.arange(len(known), dtype=np.uint64)
    digits, total = place[flat], len(flat) - order + 1
    grams = np.zeros(total, np.uint64)
    for k in range(order):
        grams = (grams << np.uint64(16)) | digits[k : k + total]
    sizes = np.array([len(p) - order + 1 for p in parts])
    ends = np.cumsum([len(p) for p in parts])
    inside = np.ones(total, bool)
    for end in ends[:-1]:  # n-grams that begin in one array and end in the next
        inside[end - order + 1 : end] = False
    return grams[inside], known, sizes


def _codes(grams: np.ndarray, known: np.ndarray, order: int) -> np.ndarray:
    digits = [(grams >> np.uint64(16 * (order - 1 - k))) & np.uint64(0xFFFF) for k in range(order)]
    return known[np.stack(digits, axis=1).astype(np.int64)] if len(grams) else np.zeros((0, order), np.int64)


def _shards(texts, order: int) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Arrays of letters and the numbers of the texts they are from, ``SHARD`` codes at a time."""
    owners, parts, size = [], [], 0
    for i, text in enumerate(texts):
        for part in pieces(text, order):
            owners.append(i)
            parts.append(part)
            size += len(part)
            if size >= SHARD:
                yield owners, parts
                owners, parts, size = [], [], 0
    if parts:
        yield owners, parts


def _split(owners, parts, order, work) -> None:
    """``work`` on the arrays, in halves where they hold too many different codes."""
    try:
        packed = _packed(parts, order)
    except OverflowError:
        if len(parts) > 1:
            half = len(parts) // 2
            _split(owners[:half], parts[:half], order, work)
            _split(owners[half:], parts[half:], order, work)
        else:
            half = len(parts[0]) // 2
            _split(owners, [parts[0][:half]], order, work)
            _split(owners, [parts[0][half - order + 1 :]], order, work)
        return
    work(owners, *packed)


def _names(codes: np.ndarray) -> np.ndarray:
    """The rows of code points as strings; a space is a boundary."""
    order = codes.shape[1]
    codes = np.where(codes == 0, 32, codes).astype(np.int32)
    return np.frombuffer(codes.tobytes(), f"<U{order}") if len(codes) else np.zeros(0, f"<U{order}")


def count_ngrams(rows: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, gram, n): n-grams of all texts of ``rows`` (lang, text); in ``gram`` a space is a boundary."""

    def count(batches):
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                found: list[pd.DataFrame] = []

                def work(_, grams, known, sizes, found=found, lang=lang):
                    types, n = np.unique(grams, return_counts=True)
                    found.append(pd.DataFrame({"lang": lang, "gram": _names(_codes(types, known, order)), "n": n}))

                for owners, parts in _shards(texts, order):
                    _split(owners, parts, order, work)
                yield from found

    partial = rows.select("lang", "text").mapInPandas(count, "lang string, gram string, n bigint")
    return partial.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def text_ngrams(rows: DataFrame, order: int = ORDER) -> DataFrame:
    """(key, gram, n): the n-grams of each text of ``rows`` (key, text); long texts give some of them more than once."""

    def count(batches):
        for batch in batches:
            keys = batch["key"].to_numpy()
            found: list[pd.DataFrame] = []

            def work(owners, grams, known, lengths, keys=keys, found=found):
                owner = np.repeat(np.array(owners), lengths)
                sort = np.lexsort((grams, owner))
                owner, grams = owner[sort], grams[sort]
                first = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (grams[1:] != grams[:-1])]))
                n = np.diff(np.append(first, len(grams)))
                names = _names(_codes(grams[first], known, order))
                found.append(pd.DataFrame({"key": keys[owner[first]], "gram": names, "n": n}))

            for owners, parts in _shards(batch["text"], order):
                _split(owners, parts, order, work)
                yield from found
                found.clear()

    return rows.select("key", "text").mapInPandas(count, "key binary, gram string, n bigint")


_MIX = np.uint64(0x9E3779B97F4A7C15)


def _hash(codes: np.ndarray) -> np.ndarray:
    """64-bit hashes of the rows of code points."""
    out = np.full(len(codes), codes.shape[1], np.uint64)
    for k in range(codes.shape[1]):
        out = (out ^ codes[:, k].astype(np.uint64)) * _MIX
        out ^= out >> np.uint64(31)
    return out


class Table:
    """Sorted hashes and the values that belong to them."""

    def __init__(self, hashes: np.ndarray, values: np.ndarray):
        order = np.argsort(hashes)
        self.hashes, self.values = hashes[order], values[order].astype(np.float32)

    def look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return self.hashes[place] == hashes, self.values[place]


def _discount(once: int, twice: int) -> float:
    discount = once / (once + 2 * twice) if once else 0.5
    return min(max(discount, 0.1), 0.9)


def _interpolated(n, total, discount, left, lower) -> np.ndarray:
    """Logarithms of probabilities; ``lower`` are those of the order below."""
    return np.log((n - discount) / total + left * lower).astype(np.float32)


class KneserNey:
    """Interpolated Kneser-Ney model of one language, from the code points and counts of its n-grams."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, alphabet: int):
        self.order = codes.shape[1]
        levels = [(codes, counts.astype(np.float64))]  # the highest order has counts, the others continuations
        while levels[-1][0].shape[1] > 1:
            types, n = np.unique(levels[-1][0][:, 1:], axis=0, return_counts=True)
            levels.append((types, n.astype(np.float64)))
        self.grams: list[Table] = []
        self.contexts: list[Table] = []
        self.unseen = 0.0
        for types, n in reversed(levels):
            once, twice = (n == 1).sum(), (n == 2).sum()
            discount = _discount(once, twice)
            context = _hash(types[:, :-1])
            known, place = np.unique(context, return_inverse=True)
            total = np.bincount(place, weights=n)
            left = discount * np.bincount(place) / total
            lower = np.exp(self.log_probability(types[:, 1:])) if self.grams else np.full(len(types), 1.0 / alphabet)
            self.grams.append(Table(_hash(types), _interpolated(n, total[place], discount, left[place], lower)))
            self.contexts.append(Table(known, np.log(left)))
            if len(self.grams) == 1:
                self.unseen = float(np.log(left[0] / alphabet))

    def log_probability(self, codes: np.ndarray) -> np.ndarray:
        """Of the last code of each row after the others."""
        width = codes.shape[1]
        out = np.full(len(codes), self.unseen, np.float32)
        for k in range(min(width, len(self.grams))):
            part = codes[:, width - 1 - k :]
            found, value = self.grams[k].look_up(_hash(part))
            if k:
                seen, left = self.contexts[k].look_up(_hash(part[:, :-1]))
                out = np.where(seen, out + left, out)
            out = np.where(found, value, out)
        return out


def quantiles(rows: DataFrame, share: float) -> dict[int, tuple[int, float]]:
    """For each k of ``rows`` (k int, x double): the number of its values and their exact ``share`` quantile, interpolated.

    Values are counted in ``BINS`` intervals, then within the one that holds the rank, until it holds one value; so no
    task and no collected table grows with the rows.
    """
    ends = rows.groupBy("k").agg(F.count("x").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).collect()
    sizes = {r.k: r.n for r in ends}
    ranks = {k: int((n - 1) * share) for k, n in sizes.items()}
    inside = {r.k: (r.n, r.lo, r.hi) for r in ends}  # the interval that holds the rank, which counts from its beginning
    after = {r.k: r.hi for r in ends}  # the value that follows the interval
    while wanted := [(k, lo, hi) for k, (_, lo, hi) in inside.items() if lo < hi]:
        edges = F.broadcast(rows.sparkSession.createDataFrame(wanted, "k int, lo double, hi double"))
        within = rows.join(edges, "k").where("x >= lo AND x <= hi")
        place = F.least(F.floor((F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * BINS), F.lit(BINS - 1))
        counts = within.groupBy("k", place.alias("place")).agg(F.count("x").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
        bins: dict[int, list] = {}
        for r in sorted(counts.collect(), key=lambda r: (r.k, r.place)):
            bins.setdefault(r.k, []).append(r)
        for k, found in bins.items():
            at = 0
            while ranks[k] >= found[at].n:
                ranks[k] -= found[at].n
                at += 1
            inside[k] = (found[at].n, found[at].lo, found[at].hi)
            after[k] = found[at + 1].lo if at + 1 < len(found) else after[k]
    out = {}
    for k, (n, low, _) in inside.items():
        following = low if ranks[k] + 1 < n else after[k]
        out[k] = sizes[k], low + (following - low) * ((sizes[k] - 1) * share % 1)
    return out


class Decision:
    """What the cross-entropies of a text say: calibration, language, rejection."""

    def __init__(self, languages: list[str]):
        self.languages = languages
        self.scale = 20.0
        self.bounds = np.full(len(languages), np.inf)

    def calibrate(self, scored: DataFrame) -> None:
        """From all rows of ``scored`` (lang, entropies): the scale with the highest likelihood of the labels, of which
        ``DOUBT`` are taken as wrong; bounds that refuse ``REFUSED`` of a language's texts."""
        number, plain = {lang: i for i, lang in enumerate(self.languages)}, Decision(self.languages)  # without the models

        def likelihoods(batches):
            for batch in batches:
                if len(batch):
                    label = batch["lang"].map(number).to_numpy()
                    entropies = np.stack(batch["entropies"].to_list())
                    sums = [np.rint(PARTS * plain._likelihood(label, entropies, scale)).astype(np.int64).sum() for scale in SCALES]
                    yield pd.DataFrame({"scale": SCALES, "value": sums})

        rows = scored.where("lang IS NOT NULL AND entropies IS NOT NULL").select(F.col("lang").cast("string").alias("lang"), "entropies")
        sums = rows.mapInPandas(likelihoods, "scale double, value bigint").groupBy("scale").agg(F.sum("value").alias("value")).collect()
        if not sums:
            return
        self.scale = max((r.value, r.scale) for r in sums)[1]
        place = F.array_position(F.array(*map(F.lit, self.languages)), F.col("lang")).cast("int") - 1
        own = rows.select(place.alias("k"), F.get("entropies", place).alias("x"))
        for k, (n, value) in quantiles(own, 1 - REFUSED).items():
            if n >= 20:
                self.bounds[k] = value

    def _likelihood(self, label: np.ndarray, entropies: np.ndarray, scale: float) -> np.ndarray:
        logs = np.log(np.maximum(self.confidence(entropies, scale), 1e-12))
        own = logs[np.arange(len(label)), label]
        others = (logs.sum(axis=1) - own) / max(1, len(self.languages) - 1)
        return (1 - DOUBT) * own + DOUBT * others

    def confidence(self, entropies: np.ndarray, scale: float | None = None) -> np.ndarray:
        x = -(scale or self.scale) * entropies
        x = np.exp(x - x.max(axis=1, keepdims=True))
        return x / x.sum(axis=1, keepdims=True)

    def judged(self, entropies: np.ndarray, sizes: np.ndarray) -> pd.DataFrame:
        out = pd.DataFrame({"lang": UNKNOWN, "score": 0.0, "accepted": False, "entropy": np.nan}, index=range(len(sizes)))
        some = np.flatnonzero(sizes > 0)
        if self.languages and len(some):
            best = entropies[some].argmin(axis=1)
            lowest = entropies[some, best]
            out.loc[some, "lang"] = np.array(self.languages, object)[best]
            out.loc[some, "score"] = self.confidence(entropies[some])[np.arange(len(some)), best]
            out.loc[some, "accepted"] = (lowest <= self.bounds[best]) & (out.loc[some, "score"].to_numpy() >= 0.5)
            out.loc[some, "entropy"] = lowest
        return out


class LanguageModels(Decision):
    """The models of all languages with their calibration."""

    def __init__(self, rows: list[tuple[str, np.ndarray, np.ndarray]]):
        rows = sorted(rows, key=lambda r: r[0])
        super().__init__([lang for lang, _, _ in rows])
        self.order = rows[0][1].shape[1] if rows else ORDER
        alphabet = len(np.unique(np.concatenate([c[:, -1] for _, c, _ in rows]))) + 1 if rows else 1
        self.models = [KneserNey(codes, counts, alphabet) for _, codes, counts in rows]

    def entropies(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character of each text in each language; the number of characters."""
        sums, sizes = np.zeros((len(texts), len(self.models))), np.zeros(len(texts), np.int64)

        def work(owners, grams, known, lengths):
            types, place = np.unique(grams, return_inverse=True)
            codes = _codes(types, known, self.order)
            table = np.stack([m.log_probability(codes) for m in self.models], axis=1)
            begin = np.cumsum(lengths) - lengths
            owner = np.array(owners)
            for language in range(len(self.models)):
                np.add.at(sums[:, language], owner, np.add.reduceat(table[place, language].astype(np.float64), begin))
            np.add.at(sizes, owner, lengths)

        if self.models:
            for owners, parts in _shards(texts, self.order):
                _split(owners, parts, self.order, work)
        return -sums / np.maximum(sizes, 1)[:, None], sizes

    def scored(self, rows: DataFrame) -> DataFrame:
        """``rows`` without their text, with its entropies; a text without a letter has none."""
        held = rows.sparkSession.sparkContext.broadcast(self)

        @F.pandas_udf("array<double>")
        def entropies(texts: pd.Series) -> pd.Series:
            found, sizes = held.value.entropies(list(texts))
            return pd.Series([x if n else None for x, n in zip(found, sizes)], dtype=object)

        return rows.withColumn("entropies", entropies("text")).drop("text")


_LISTED = "map<int,float>"


def _key(text: Column | str) -> Column:
    return F.unhex(F.md5(F.col(text).cast("binary")))


class StoredModels(Decision):
    """The models of all languages in tables, from their counted n-grams (lang, gram, n).

    For each order a table of n-grams and one of contexts, with the logarithms of the languages that have them. In a join
    from one order to the next a key meets at most as many rows as there are letters.
    """

    def __init__(self, counts: DataFrame, order: int):
        levels = [counts]  # the highest order has counts, the others continuations
        for width in range(order - 1, 0, -1):
            shorter = levels[-1].groupBy("lang", F.substring("gram", 2, width).alias("gram"))
            levels.append(settle(shorter.agg(F.count(F.lit(1)).alias("n")), "ngrams"))
        super().__init__(sorted(r.lang for r in levels[-1].select("lang").distinct().collect()))
        self.order = order
        alphabet = levels[-1].select("gram").distinct().count() + 1
        numbers = {lang: i for i, lang in enumerate(self.languages)}
        self.grams: list[DataFrame] = []
        self.contexts: list[DataFrame] = []
        spark, lower = counts.sparkSession, None

        @F.pandas_udf("float")
        def logarithm(x: pd.Series) -> pd.Series:
            return np.log(x).astype(np.float32)

        @F.pandas_udf("float")
        def value(n: pd.Series, total: pd.Series, discount: pd.Series, left: pd.Series, lower: pd.Series) -> pd.Series:
            return pd.Series(_interpolated(*(x.to_numpy() for x in (n, total, discount, left)), np.exp(lower.to_numpy())))

        @F.pandas_udf("float")
        def first_value(n: pd.Series, total: pd.Series, discount: pd.Series, left: pd.Series) -> pd.Series:
            return pd.Series(_interpolated(*(x.to_numpy() for x in (n, total, discount, left)), 1.0 / alphabet))

        for width, types in enumerate(reversed(levels), 1):
            few = types.groupBy("lang").agg(F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") == 2).alias("twice"))
            discounts = [(r.lang, numbers[r.lang], _discount(r.once, r.twice)) for r in few.collect()]
            discounts = spark.createDataFrame(discounts, "lang string, number int, discount double")
            types = types.withColumn("context", F.substring("gram", 1, width - 1))
            contexts = types.groupBy("lang", "context").agg(F.sum("n").cast("double").alias("total"), F.count(F.lit(1)).alias("kinds"))
            contexts = contexts.join(F.broadcast(discounts), "lang")
            contexts = settle(contexts.withColumn("left", F.col("discount") * F.col("kinds") / F.col("total")), "contexts")
            joined = types.withColumn("n", F.col("n").cast("double")).join(contexts, ["lang", "context"])
            if lower is None:
                valued = joined.withColumn("value", first_value("n", "total", "discount", "left"))
                left = {r.lang: r.left for r in contexts.collect()}  # one context, the empty one, of each language
                self.unseen = [float(np.float32(np.log(left[lang] / alphabet))) for lang in self.languages]
            else:
                joined = joined.withColumn("suffix", F.substring("gram", 2, width - 1)).join(lower, ["lang", "suffix"])
                valued = joined.withColumn("value", value("n", "total", "discount", "left", "lower"))
            valued = settle(valued.select("lang", "number", "gram", "value"), "logarithms")
            lower = valued.select("lang", F.col("gram").alias("suffix"), F.col("value").alias("lower"))
            self.grams.append(self._listed(valued, "gram", F.col("value")))
            self.contexts.append(self._listed(contexts, "context", logarithm("left")))

    def _listed(self, rows: DataFrame, key: str, value: Column) -> DataFrame:
        """One row per ``key``, with the values of the languages by number."""
        pairs = rows.select(key, F.struct("number", value.alias("value")).alias("pair"))
        return settle(pairs.groupBy(key).agg(F.map_from_entries(F.collect_list("pair")).alias("listed")), "listed")

    def log_probabilities(self, grams: DataFrame) -> DataFrame:
        """(gram, logs): of the last letter of each of the distinct n-grams after the others, in every language."""
        wanted = [grams.select("gram")]
        for width in range(self.order - 1, 0, -1):
            wanted.append(wanted[-1].select(F.substring("gram", 2, width).alias("gram")).distinct())
        found = None
        for width, rows in enumerate(reversed(wanted), 1):
            rows = rows.join(self.grams[width - 1].withColumnRenamed("listed", "own"), "gram", "left")
            if found is None:
                rows = rows.withColumn("lower", F.array(*map(F.lit, self.unseen)).cast("array<float>"))
                rows = rows.withColumn("left", F.lit(None).cast(_LISTED))
            else:
                rows = rows.withColumn("suffix", F.substring("gram", 2, width - 1)).withColumn("context", F.substring("gram", 1, width - 1))
                rows = rows.join(found.select(F.col("gram").alias("suffix"), F.col("logs").alias("lower")), "suffix")
                rows = rows.join(self.contexts[width - 1].withColumnRenamed("listed", "left"), "context", "left")
            best = lambda x, i: F.coalesce(F.try_element_at("own", i), x + F.try_element_at("left", i), x)
            found = settle(rows.select("gram", F.transform("lower", best).alias("logs")), "found")
        return found

    def entropies(self, rows: DataFrame) -> DataFrame:
        """(key, entropies) of the texts with a letter of ``rows`` (key, text); equal keys stand for equal texts."""
        parts = settle(text_ngrams(rows.where("text IS NOT NULL"), self.order), "text-ngrams")
        tally = settle(parts.groupBy("gram").agg(F.count(F.lit(1)).alias("rows")), "distinct-ngrams")
        often = (tally.agg(F.sum("rows")).first()[0] or 0) // FREQUENT
        found = self.log_probabilities(tally)
        frequent = F.broadcast(found.join(tally.where(F.col("rows") > often).select("gram"), "gram", "left_semi"))
        others = parts.join(frequent.select("gram"), "gram", "left_anti").join(found, "gram")
        valued = parts.join(frequent, "gram").select("key", "n", "logs").unionByName(others.select("key", "n", "logs"))
        sums = [F.sum(F.col("n") * F.get("logs", F.lit(i)).cast("double")) for i in range(len(self.languages))]
        # a text that is repeated has all its sums that many times
        return valued.groupBy("key").agg(F.transform(F.array(*sums), lambda x: -x / F.sum("n")).alias("entropies"))

    def scored(self, rows: DataFrame) -> DataFrame:
        """``rows`` without their text, with its entropies; a text without a letter has none."""
        keyed = rows.withColumn("key", _key("text"))
        scores = settle(self.entropies(keyed.select("key", "text")), "entropies")
        return keyed.drop("text").join(scores, "key", "left").drop("key")


def _collected(counts: DataFrame) -> list[tuple[str, np.ndarray, np.ndarray]]:
    frame = counts.toPandas()
    out = []
    for lang, rows in frame.groupby("lang"):
        grams = rows["gram"].to_numpy().astype(str)
        order = len(grams[0])
        codes = np.frombuffer(grams.astype(f"<U{order}").tobytes(), np.uint32).reshape(-1, order).astype(np.int64)
        codes[codes == 32] = 0
        out.append((str(lang), codes, rows["n"].to_numpy()))
    return out


def fitted(rows: DataFrame, order: int = ORDER) -> LanguageModels | StoredModels:
    """Models from ``rows`` (lang, text), not calibrated yet: every row with language and text counts."""
    counts = settle(count_ngrams(rows.where("lang IS NOT NULL AND text IS NOT NULL"), order), "ngrams")
    return StoredModels(counts, order) if counts.count() > TYPES else LanguageModels(_collected(counts))


def learn(rows: DataFrame, order: int = ORDER) -> LanguageModels | StoredModels:
    """Models from ``rows`` (lang, text), calibrated on all of them. No rows give no languages."""
    models = fitted(rows, order)
    if models.languages:
        models.calibrate(settle(models.scored(rows.select("lang", "text")), "calibration"))
    return models


def predicted(models: LanguageModels | StoredModels, scored: DataFrame) -> DataFrame:
    """``scored`` with a column p: struct of lang, score, accepted and entropy (of the best language, per character)."""
    decision = Decision(models.languages)
    decision.scale, decision.bounds = models.scale, models.bounds

    @F.pandas_udf("lang string, score double, accepted boolean, entropy double")
    def judge(entropies: pd.Series) -> pd.DataFrame:
        known = entropies.notna().to_numpy()
        table = np.zeros((len(entropies), len(decision.languages)))
        if known.any():
            table[known] = np.stack(entropies[known].to_list())
        return decision.judged(table, known.astype(np.int64))

    return scored.withColumn("p", judge("entropies"))


def identify(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang", folds: int = 4, held: int = 2
) -> DataFrame:
    """One row per row of ``docs``: id, held_out, lang_pred, score, accepted.

    Learned from texts with a language whose crc32(id as text) modulo ``folds`` is not ``held``; ids that are null are
    not learned from. A null text or one without a letter, and any text if nothing can be learned, is ``und`` with score 0
    and not accepted; ``accepted`` is the calibrated rejection. No rows give no rows; other columns are ignored.

    Each text is scored once; the scores of all that may be learned from calibrate the decision.
    """
    rows = narrow(docs, id=id_column, text=text_column, lang=lang_column)
    rows = rows.withColumn("held_out", F.coalesce(F.crc32(F.col("id").cast("string").cast("binary")) % folds == held, F.lit(False)))
    learnable = "id IS NOT NULL AND NOT held_out"
    models = fitted(rows.where(learnable).select("lang", "text"))
    scored = settle(models.scored(rows), "scored")
    if models.languages:
        models.calibrate(scored.where(learnable))
    return predicted(models, scored).select(
        F.col("id").alias(id_column), "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"),
        F.col("p.accepted").alias("accepted"),
    )
