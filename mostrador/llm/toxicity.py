"""Toxicity scores by a bidirectional gated recurrent network with attention pooling (operator 9).

Every word of a text has a word input and character inputs. The word input is the weight of evidence of its hashed form,
the character inputs those of its prefixes and of its character n-grams, all learned from labelled texts. A window of
words runs through a gated recurrent network in both directions; attention pools the states, and a logistic unit gives
the window's logit. All windows of ``WINDOW`` words that overlap by half are scored, whatever the text's length; the text's
score is the calibrated largest logit.

The network is trained in numpy on a bounded sample of labelled texts. Labels are per text, so the windows of a toxic text
that are trained as toxic are those with the most evidence at first, then those that the network itself scores highest.
"""

from __future__ import annotations

import hashlib
import pickle
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SLICE, encoded, fresh, narrow, word_lists
from .decontaminate import WORDS

#: Words of a window, and from one window to the next.
WINDOW, STEP = 32, 16
HIDDEN = 8
#: Hash buckets of words and of character n-grams.
BUCKETS = 1 << 20
PREFIXES, NGRAMS = (4, 6, 7), (4, 5, 7)
#: Labelled texts that are learned from, at most, and bytes of the longest of them.
SAMPLE, LONGEST = 6000, 16 << 10
#: Words that are scored at once.
BATCH = 1 << 17
THRESHOLD = 0.7
ROUNDS, EPOCHS, RATE, LEARNED_AT_ONCE, LEAST_STEPS = 2, 5, 0.02, 512, 150
INPUTS = 6


def lists_of_words(text: str | None) -> Iterator[list[bytes]]:
    """Words in lower case: letters, digits and what is beyond ASCII."""
    return word_lists(encoded((text or "").lower()).translate(WORDS), SLICE)


class Numbers(dict):
    """Words and their numbers; a new word gets the next one."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


class Grams:
    """Buckets of distinct words, of their prefixes and of their character n-grams."""

    def __init__(self, words: list[bytes]):
        flat = np.frombuffer(b"".join(b"<" + w + b">" for w in words), np.uint8).astype(np.uint64)
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
        begin = np.cumsum(sizes) - sizes
        # running sums of each byte times a power that depends on its place make hashes of any stretch
        power = np.cumprod(np.full(len(flat), 0x5851F42D4C957F2D, np.uint64)) if len(flat) else np.zeros(0, np.uint64)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(_mixed(flat + np.uint64(1)) * power)])
        inverse = np.cumprod(np.full(len(flat), pow(0x5851F42D4C957F2D, -1, 1 << 64), np.uint64)) if len(flat) else power

        def stretch(at: np.ndarray, length, salt: int) -> np.ndarray:
            value = (sums[at + length] - sums[at]) * inverse[at]
            return (_mixed(value + np.uint64(salt)) % np.uint64(BUCKETS)).astype(np.int32)

        self.words = stretch(begin, sizes, 1)
        # a prefix longer than the word is the word
        self.prefixes = [stretch(begin, np.minimum(n + 1, sizes), 2 + n) for n in PREFIXES]
        self.owner, self.grams = [], []
        for n in NGRAMS:
            counts = np.maximum(sizes - n + 1, 0)
            owner = np.repeat(np.arange(len(words), dtype=np.int32), counts)
            at = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts) + begin[owner]
            self.owner.append(owner)
            self.grams.append(stretch(at, n, 40 + n))
        self.n = len(words)


def count_buckets(texts: list[np.ndarray], grams: Grams, labels: np.ndarray, fold: np.ndarray, folds: int) -> np.ndarray:
    """(fold, label, kind, bucket): texts that hold the bucket. ``texts`` are the numbers of their distinct words."""
    kinds = [grams.words, *grams.prefixes]
    owner, gram = np.concatenate(grams.owner), np.concatenate(grams.grams)
    order = np.argsort(owner, kind="stable")
    gram, first = gram[order], np.searchsorted(owner[order], np.arange(grams.n + 1))
    del owner, order
    out = np.zeros((folds, 2, len(kinds) + 1, BUCKETS), np.uint16)
    for words, label, f in zip(texts, labels, fold):
        inside = np.concatenate([gram[first[w] : first[w + 1]] for w in words]) if len(words) else words
        for k, bucket in enumerate((*(x[words] for x in kinds), inside)):
            out[f, label, k, np.unique(bucket)] += 1
    return out


class Evidence:
    """Weights of evidence of the buckets, from the numbers of texts of either label that hold them."""

    def __init__(self, count: np.ndarray, n: np.ndarray):
        """``count``: (label, kind, bucket); ``n``: texts of each label."""
        n, share = np.maximum(n, 1), n[1] / max(1, n.sum())
        self.weights = np.zeros(count.shape[1:], np.float16)
        for k in range(count.shape[1]):
            some = np.flatnonzero(count[:, k].any(axis=0))
            # log odds over their standard deviation: a word seen once says little
            hit, miss = count[1, k, some] + max(0.5 * share, 1e-3), count[0, k, some] + 0.5 * (1 - share)
            odds = np.log(hit / (n[1] + 1 - hit).clip(0.5)) - np.log(miss / (n[0] + 1 - miss).clip(0.5))
            self.weights[k, some] = np.tanh(odds / np.sqrt(1 / hit + 1 / miss) / 4)

    def inputs(self, grams: Grams) -> np.ndarray:
        """The inputs of distinct words: word, prefixes, mean and largest of the n-grams."""
        out = np.zeros((grams.n, INPUTS), np.float32)
        out[:, 0] = self.weights[0][grams.words]
        for k, prefix in enumerate(grams.prefixes):
            out[:, 1 + k] = self.weights[1 + k][prefix]
        total, most, number = np.zeros(grams.n), np.zeros(grams.n, np.float32), np.zeros(grams.n)
        for owner, gram in zip(grams.owner, grams.grams):
            if len(owner):
                value = self.weights[-1][gram].astype(np.float32)
                begin = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
                at = owner[begin]
                total[at] += np.add.reduceat(value, begin)
                most[at] = np.maximum(most[at], np.maximum.reduceat(value, begin))
                number[at] += np.diff(np.concatenate([begin, [len(owner)]]))
        out[:, -2] = total / np.maximum(number, 1)
        out[:, -1] = most
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Bidirectional gated recurrent units, attention pooling, a logistic unit."""

    def __init__(self, inputs: int, hidden: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        near = lambda *s: rng.normal(0, 0.3, s).astype(np.float32)
        self.w = {}
        for d in "fb":
            self.w |= {f"W{d}": near(inputs, 3 * hidden), f"U{d}": near(hidden, 3 * hidden), f"b{d}": np.zeros(3 * hidden, np.float32)}
        self.w |= {"A": near(2 * hidden, hidden), "a": near(hidden), "o": near(2 * hidden), "c": np.zeros(1, np.float32)}
        self.hidden = hidden

    def _direction(self, x: np.ndarray, mask: np.ndarray, d: str, keep: bool):
        """States (time, batch, hidden) from projected inputs (time, batch, 3 hidden)."""
        n, U, steps = self.hidden, self.w[f"U{d}"], range(len(x))
        h, states, kept = np.zeros((x.shape[1], n), np.float32), np.empty((*x.shape[:2], n), np.float32), {}
        for t in steps if d == "f" else reversed(steps):
            hu = h @ U[:, : 2 * n]
            gates = _sigmoid(x[t, :, : 2 * n] + hu)
            z, r = gates[:, :n], gates[:, n:]
            g = np.tanh(x[t, :, 2 * n :] + (r * h) @ U[:, 2 * n :])
            new = h + mask[t] * z * (g - h)
            if keep:
                kept[t] = (h, z, r, g)
            h = states[t] = new
        return states, kept

    def forward(self, words: np.ndarray, table: np.ndarray, keep: bool = False):
        """Logits of windows. ``words`` (time, batch): rows of ``table`` (word inputs), -1 beyond the end."""
        mask = (words >= 0)[:, :, None].astype(np.float32)
        states, kept = [], {}
        for d in "fb":
            projected = np.concatenate([table @ self.w[f"W{d}"] + self.w[f"b{d}"], np.zeros((1, 3 * self.hidden), np.float32)])
            s, kept[d] = self._direction(projected[words], mask, d, keep)
            states.append(s)
        both = np.concatenate(states, axis=2)
        inner = np.tanh(both @ self.w["A"])
        weight = np.where(mask[:, :, 0] > 0, inner @ self.w["a"], -1e9)
        weight = np.exp(weight - weight.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = (both * weight[:, :, None]).sum(axis=0)
        logit = pooled @ self.w["o"] + self.w["c"]
        return (logit, (mask, kept, both, inner, weight, pooled)) if keep else logit

    def gradients(self, words: np.ndarray, table: np.ndarray, target: np.ndarray, weights: np.ndarray) -> dict:
        logit, (mask, kept, both, inner, weight, pooled) = self.forward(words, table, keep=True)
        n, w = self.hidden, self.w
        out = {}
        dl = ((_sigmoid(logit) - target) * weights / weights.sum()).astype(np.float32)
        out["o"], out["c"] = pooled.T @ dl, np.array([dl.sum()], np.float32)
        dp = dl[:, None] * w["o"]
        dw = (both * dp).sum(axis=2)
        de = weight * (dw - (weight * dw).sum(axis=0))
        out["a"] = np.einsum("tb,tbh->h", de, inner)
        di = de[:, :, None] * w["a"] * (1 - inner**2)
        out["A"] = np.einsum("tbk,tbh->kh", both, di)
        dboth = weight[:, :, None] * dp + di @ w["A"].T
        padded = np.concatenate([table, np.zeros((1, table.shape[1]), np.float32)])
        for k, d in enumerate("fb"):
            U = w[f"U{d}"]
            dU, dW, db = np.zeros_like(U), np.zeros_like(w[f"W{d}"]), np.zeros(3 * n, np.float32)
            dh = np.zeros((words.shape[1], n), np.float32)
            steps = range(len(words))
            for t in reversed(steps) if d == "f" else steps:
                h, z, r, g = kept[d][t]
                dh = dh + dboth[t, :, k * n : (k + 1) * n]
                dnew = dh * mask[t]
                dz, dg = dnew * (g - h) * z * (1 - z), dnew * z * (1 - g**2)
                drh = dg @ U[:, 2 * n :].T
                dr = drh * h * r * (1 - r)
                dx = np.concatenate([dz, dr, dg], axis=1)
                dU[:, : 2 * n] += h.T @ dx[:, : 2 * n]
                dU[:, 2 * n :] += (r * h).T @ dg
                dW += padded[words[t]].T @ dx
                db += dx.sum(axis=0)
                dh = dh - dnew * z + drh * r + dx[:, : 2 * n] @ U[:, : 2 * n].T
            out |= {f"U{d}": dU, f"W{d}": dW, f"b{d}": db}
        return out

    def train(self, words: np.ndarray, table: np.ndarray, target: np.ndarray, epochs: int, rate: float, seed: int = 11) -> None:
        """Adam on windows (time, all); both labels weigh the same."""
        rng = np.random.default_rng(seed)
        share = np.clip(target.mean(), 1e-3, 1 - 1e-3)
        weights = np.where(target > 0, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
        m, v, step = {}, {}, 0
        parts = max(1, len(target) // min(LEARNED_AT_ONCE, max(32, len(target) // 16)))
        for _ in range(max(epochs, -(-LEAST_STEPS // parts))):
            for part in np.array_split(rng.permutation(len(target)), parts):
                step += 1
                for name, g in self.gradients(*_used(words[:, part], table), target[part], weights[part]).items():
                    m[name] = 0.9 * m.get(name, 0) + 0.1 * g
                    v[name] = 0.999 * v.get(name, 0) + 0.001 * g * g
                    move = m[name] / (1 - 0.9**step) / (np.sqrt(v[name] / (1 - 0.999**step)) + 1e-8)
                    self.w[name] = (self.w[name] - rate * move).astype(np.float32)


def _used(words: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same windows over a table of only the words that they hold."""
    held, place = np.unique(words, return_inverse=True)
    none = int(held[0] == -1)
    return place.reshape(words.shape) - none, table[held[none:]]


def windows(ids: np.ndarray) -> np.ndarray:
    """Word numbers of all windows (time, number) of one text, -1 beyond its end; at least one window."""
    n = max(1, -(-(len(ids) - (WINDOW - STEP)) // STEP))
    padded = np.full((n - 1) * STEP + WINDOW, -1, np.int64)
    padded[: len(ids)] = ids
    return padded[np.arange(n) * STEP + np.arange(WINDOW)[:, None]]


def _numbered(texts) -> tuple[list[bytes], list[np.ndarray]]:
    """The distinct words of the texts, and each text as numbers of words."""
    known, out = Numbers(), []
    for text in texts:
        parts = [known.of(words) for words in lists_of_words(text)]
        out.append(np.concatenate(parts) if parts else np.zeros(0, np.int64))
    return list(known), out


class Toxicity:
    """Evidence, network and calibration."""

    FOLDS = 3

    def __init__(self, texts: list[str], labels: np.ndarray):
        self.line = (1.0, 0.0)
        self.constant = float(np.mean(labels)) if len(labels) else 0.0
        self.network = None
        if len(labels) and 0 < labels.sum() < len(labels):
            self._fit(texts, labels.astype(int))

    def _fit(self, texts: list[str], labels: np.ndarray) -> None:
        words, ids = _numbered(texts)
        grams = Grams(words)
        # a text's own words are no evidence about it: its inputs come from the other folds
        fold = np.arange(len(labels)) % self.FOLDS
        count = count_buckets([np.unique(x) for x in ids], grams, labels, fold, self.FOLDS)
        every = count.sum(axis=0, dtype=np.int32)
        number = np.stack([np.bincount(labels[fold == f], minlength=2) for f in range(self.FOLDS)])
        self.evidence = Evidence(every, number.sum(axis=0))
        table, shift, parts = [], np.zeros(len(labels), np.int64), []
        for f in range(self.FOLDS):
            shift[fold == f] = f * len(words)
            table.append(Evidence(every - count[f], number.sum(axis=0) - number[f]).inputs(grams))
        del count, every, grams
        table = np.concatenate(table)
        for i, x in enumerate(ids):
            parts.append(windows(x))
        where = np.repeat(np.arange(len(parts)), [p.shape[1] for p in parts])
        words_of = np.concatenate(parts, axis=1).astype(np.int32)
        del parts
        words_of = np.where(words_of >= 0, words_of + shift[where].astype(np.int32), np.int32(-1))
        clean = np.flatnonzero(labels[where] == 0)
        best = np.concatenate([table.max(axis=1), np.float32([-1.0])])
        evidence = np.max([best[row] for row in words_of], axis=0)
        self.network = Network(INPUTS, HIDDEN)
        rng = np.random.default_rng(3)
        value = evidence
        for k in range(ROUNDS):
            order = np.lexsort((-value, where))
            best = order[np.concatenate([[True], where[order][1:] != where[order][:-1]])]
            toxic = best[labels[where[best]] == 1]
            hard = best[labels[where[best]] == 0]
            hard = rng.permutation(hard)[: 8 * len(toxic)]
            other = rng.permutation(clean)[: 4 * len(toxic)]
            chosen = np.concatenate([toxic, hard, other])
            self.network.train(words_of[:, chosen], table, labels[where[chosen]].astype(np.float32), EPOCHS, RATE / (1 + k))
            value = self._logits(words_of, table, True)
        most = np.full(len(labels), -np.inf)
        np.maximum.at(most, where, value)
        self._calibrate(most, labels)

    def _logits(self, words: np.ndarray, table: np.ndarray, large: bool = False) -> np.ndarray:
        """``large``: the table holds many more words than a part of the windows."""
        parts = np.array_split(np.arange(words.shape[1]), max(1, words.shape[1] * STEP // BATCH))
        forward = self.network.forward
        return np.concatenate([forward(*_used(words[:, p], table)) if large else forward(words[:, p], table) for p in parts])

    def _calibrate(self, logits: np.ndarray, labels: np.ndarray) -> None:
        """Logistic regression of the label on the largest logit."""
        mean, spread = logits.mean(), logits.std() + 1e-6
        x = np.stack([(logits - mean) / spread, np.ones(len(logits))], axis=1)
        w = np.zeros(2)
        for _ in range(50):
            p = _sigmoid(x @ w)
            curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
            w = w - np.linalg.solve(curve, x.T @ (p - labels) + 1e-3 * w)
        self.line = (w[0] / spread, w[1] - w[0] * mean / spread)

    def scores(self, texts) -> np.ndarray:
        """Calibrated scores; texts are taken together until they have ``BATCH`` words."""
        texts = list(texts)
        if self.network is None:
            return np.full(len(texts), self.constant)
        most = np.full(len(texts), -np.inf)
        known, parts, owners, size = Numbers(), [], [], 0

        def flush():
            nonlocal known, parts, owners, size
            if parts:
                table = self.evidence.inputs(Grams(list(known)))
                logits = self._logits(np.concatenate(parts, axis=1), table)
                np.maximum.at(most, np.repeat(owners, [p.shape[1] for p in parts]), logits)
            known, parts, owners, size = Numbers(), [], [], 0

        for i, text in enumerate(texts):
            tail: list[bytes] = []
            for words in lists_of_words(text):
                if not words:
                    continue
                words = tail + words
                ids = known.of(words)
                parts.append(windows(ids))
                owners.append(i)
                size += len(ids)
                tail = words[len(words) - min(len(words), WINDOW - STEP) :]
                if size >= BATCH:
                    flush()
        flush()
        nothing = np.isneginf(most)
        most[nothing] = 0
        out = _sigmoid(self.line[0] * most + self.line[1])
        out[nothing] = self.constant
        return out


def learn(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic", folds: int = 3, held: int = 1) -> Toxicity:
    """A model from labelled texts whose crc32(id as text) modulo ``folds`` is not ``held``.

    At most ``SAMPLE`` of them, chosen by a hash, of at most ``LONGEST`` bytes. Null ids, texts and labels teach nothing.
    """
    return _unpacked(_learn(docs, labels, id_column, text_column, label_column, folds, held))


def training_sample(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic", folds: int = 3, held: int = 1) -> DataFrame:
    """id, text and label of what a model learns from: of all usable labelled texts the ``SAMPLE`` first by a hash of the id.

    Which texts are usable (not null, at most ``LONGEST`` bytes) is decided before the draw, so labels without such a text
    take no place in it. Only ids are compared for that; texts are read of the chosen ids, which are broadcast. Of several
    labels of an id the higher counts, of several texts the smaller.
    """
    learned = F.crc32(F.col("id").cast("string").cast("binary")) % folds != held
    rows = narrow(docs, id=id_column, text=text_column).where(learned & (F.octet_length("text") <= LONGEST))
    known = narrow(labels, id=id_column, label=label_column).where(learned & F.col("label").isin(0, 1))
    usable = known.groupBy("id").agg(F.max("label").alias("label")).join(rows.select("id"), "id", "left_semi")
    chosen = usable.orderBy(F.xxhash64("id"), "id").limit(SAMPLE)
    found = rows.join(F.broadcast(chosen), "id").groupBy("id").agg(F.min("text").alias("text"), F.first("label").alias("label"))
    return found.orderBy(F.xxhash64("id"), "id").limit(SAMPLE)  # one order, so that reruns learn the same


def _learn(docs, labels, id_column="doc_id", text_column="text", label_column="toxic", folds=3, held=1) -> bytes:
    """The packed model: the driver passes it on without opening it."""
    sample = training_sample(docs, labels, id_column, text_column, label_column, folds, held).select("text", "label")

    def fit(batches):
        texts, labels = [], []
        for batch in batches:
            texts += batch.column("text").to_pylist()
            labels += batch.column("label").to_pylist()
        yield pa.RecordBatch.from_pydict({"model": [_packed(Toxicity(texts, np.array(labels, dtype=int)))]})

    # the sample is bounded, so one task trains on it
    models = sample.coalesce(1).mapInArrow(fit, "model binary").collect()
    return bytes(models[0].model) if models else _packed(Toxicity([], np.zeros(0, int)))


_models: dict[str, Toxicity] = {}


def _packed(model: Toxicity) -> bytes:
    return zlib.compress(pickle.dumps(model), 1)


def _unpacked(packed: bytes) -> Toxicity:
    """One per worker process."""
    key = hashlib.md5(packed).hexdigest()
    if key not in _models:
        _models.clear()
        _models[key] = pickle.loads(zlib.decompress(packed))
    return _models[key]


def toxicity(spark, packed: bytes, text: Column | str) -> Column:
    """Score of a text column by a packed model."""
    held = spark.sparkContext.broadcast(packed)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(_unpacked(held.value).scores(texts), dtype="float64")

    return score(text)


def score_toxicity(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: id, held_out, score, predicted (1 if score >= threshold).

    A text without words has the share of toxic labels as its score, and so has every text if there are not labels of both
    kinds to learn from (0 without any). Rows that repeat score alike; no rows give no rows; other columns are ignored.
    """
    model = _learn(docs, labels, id_column, text_column, label_column)
    rows = narrow(docs, id=id_column, text=text_column)
    held_out = F.coalesce(F.crc32(F.col("id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    rows = rows.select(F.col("id").alias(id_column), held_out.alias("held_out"), toxicity(docs.sparkSession, model, "text").alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def remove_toxic(docs: DataFrame, labels: DataFrame, text_column: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score is below the threshold."""
    name = fresh(docs, "toxicity")
    model = _learn(docs, labels, text_column=text_column)
    out = docs.withColumn(name, toxicity(docs.sparkSession, model, F.col(f"`{text_column}`")))
    return out.where(F.col(name) < threshold).select(*(F.col(f"`{c}`") for c in docs.columns))
