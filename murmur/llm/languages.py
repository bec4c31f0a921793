"""Languages of texts that may mix several: a mixture of n-gram models, its set chosen by penalised likelihood."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur.llm.common import prepare

#: Characters of an n-gram, and the counters n-grams are hashed to; a model is 8 * 2 ** BUCKET_BITS bytes a language.
ORDERS, BUCKET_BITS = (2, 3), 16
#: Languages of a model at most: counters of more don't fit the driver.
LANGUAGES = 256
#: Characters whose n-grams are in memory at a time.
STRIP = 1 << 20
#: Added to every count of the model.
SMOOTHING = 0.05
#: Rounds of expectation and maximisation at most, and the change of a share that ends them.
ROUNDS, STILL = 25, 1e-3
#: What another language must add to the log-likelihood, in units of the logarithm of the text's n-grams.
#: Overlapping n-grams tell the same evidence several times, so it is well over the usual one half.
PENALTY = 6.0
UNKNOWN = "und"
PREDICTION = "lang_pred string, score double, languages array<string>, shares array<double>"


def letters(text: str) -> np.ndarray:
    """The text's code points, letters lower-cased and whatever is between words as one blank."""
    words = "".join([c if c.isalpha() else " " for c in text.lower()]) if not text.isascii() else text.lower().translate(_BLANKED)
    return np.frombuffer((" " + " ".join(words.split()) + " ").encode("utf-32-le"), "<u4")


def grams(code: np.ndarray, first: int | None = None) -> np.ndarray:
    """Hashed n-grams of code points: those that begin within the `first` ones."""
    code, out = code.astype(np.uint64), []
    for order in ORDERS:
        n = max(len(code) - order + 1, 0)
        h = np.zeros(n if first is None else min(n, first), np.uint64)
        for k in range(order):
            h = (h ^ code[k:k + len(h)]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        out.append(h * np.uint64(0xBF58476D1CE4E5B9 + 2 * order) >> np.uint64(64 - BUCKET_BITS))
    return np.concatenate(out).astype(np.int64)


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of the whole text and how often each occurs.

    A very long text is counted strip by strip; a strip sees the characters after it that its last n-grams reach.
    """
    code = letters(text)
    if len(code) <= STRIP:
        return np.unique(grams(code), return_counts=True)
    counts = np.zeros(1 << BUCKET_BITS, np.int64)
    for at in range(0, len(code), STRIP):
        counts += np.bincount(grams(code[at:at + STRIP + max(ORDERS) - 1], STRIP), minlength=1 << BUCKET_BITS)
    used = np.flatnonzero(counts)
    return used, counts[used]


_BLANKED = {c: " " for c in range(128) if not chr(c).isalpha()}


class Model:
    """Languages and each one's likelihood of every bucket."""

    def __init__(self, names: list[str], counts: np.ndarray):
        self.names = names
        smooth = counts + SMOOTHING
        self.likely = (smooth / smooth.sum(1, keepdims=True)).astype(np.float64) if len(names) else counts

    def _shares(self, p: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
        """The mixture's shares by expectation and maximisation, and its log-likelihood."""
        share = np.full(len(p), 1 / len(p))
        if len(p) > 1:
            total = weight.sum()
            for _ in range(ROUNDS):
                new = share * (p @ (weight / (share @ p))) / total
                still = np.abs(new - share).max() < STILL
                share = new
                if still:
                    break
        return share, float(weight @ np.log(share @ p))

    def predict(self, text: str | None) -> tuple[str, float, list[str], list[float]]:
        """The largest language of the chosen set, its share, and the set with its shares, largest first."""
        if not text or not self.names or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, [], []
        bucket, weight = gram_counts(text)
        p = self.likely[:, bucket]
        order = np.argsort(-self._shares(p, weight)[0], kind="stable")
        price = PENALTY * np.log(weight.sum())
        chosen, (share, fit) = order[:1], self._shares(p[order[:1]], weight)
        for size in range(2, len(order) + 1):
            more, better = self._shares(p[order[:size]], weight)
            if better - fit <= price:
                break
            chosen, share, fit = order[:size], more, better
        by = np.argsort(-share, kind="stable")
        names = [self.names[i] for i in chosen[by]]
        return names[0], min(1.0, float(share[by[0]])), names, share[by].tolist()


def train(labelled: DataFrame) -> Model:
    """A model from all rows (text, lang); rows without text or lang teach nothing.

    Each task counts buckets for each language, Spark adds them up, and only the sums, a
    fixed number for a language, come to the driver. More than LANGUAGES values of lang are
    an error: such a column holds something else.
    """
    prepare(labelled.sparkSession)
    n = labelled.select("lang").dropna().distinct().count()
    if n > LANGUAGES:
        raise ValueError(f"lang has {n} values, a model holds {LANGUAGES}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                own = sums.setdefault(lang, np.zeros(1 << BUCKET_BITS, np.int64))
                bucket, weight = gram_counts(text)
                own[bucket] += weight
        for lang, own in sums.items():
            used = np.flatnonzero(own)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(used), pa.string()),
                                              "bucket": pa.array(used, pa.int32()), "n": pa.array(own[used], pa.int64())})
    rows = (labelled.select("text", "lang").dropna().mapInArrow(count, "lang string, bucket int, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())
    names = sorted(rows["lang"].unique())
    counts = np.zeros((len(names), 1 << BUCKET_BITS))
    if len(rows):
        counts[np.searchsorted(names, rows["lang"]), rows["bucket"]] = rows["n"]
    return Model(names, counts)


def predict(frame: DataFrame, model: Model, text: Column) -> Column:
    """lang_pred, score, languages and shares of a text.

    `und` with score 0 for a null text or one without a letter, or if nothing was learned.
    The whole text counts, whatever its length; equal texts are alike whatever their other columns.
    """
    prepare(frame.sparkSession)
    shared = frame.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(PREDICTION)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for batch in batches:
            yield pd.DataFrame([own.predict(t) for t in batch], columns=["lang_pred", "score", "languages", "shares"])
    return run(text)
