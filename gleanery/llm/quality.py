"""Quality classifier: supervised subword embeddings.

A document is the average of hashed vectors: one per word, one per character n-gram of ``<word>`` and one per
adjacent word pair (a word followed by itself falls into one bucket of its own, so stuttering text is seen
whatever the word). A softmax over that average gives the label; vectors and output layer are trained by
numpy stochastic gradient descent on a bounded sample of labelled rows.

The output layer is linear in the average, so for scoring each bucket needs only its projection on the
difference of the two output rows: one float per bucket goes to the executors, and a word's whole subword sum
is computed once and remembered.

Null texts, empty ones and those without words get the probability of no features; without two different labels (an empty table too) every text gets the
smoothed base rate. Long texts are scored whole. Labelled rows that share an id are drawn once; documents that repeat come out as often as they go in, with
equal scores. The score is a column, so no name can clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import fold, labelled_sample, small_batches

BUCKETS = 1 << 18
MIN_N, MAX_N = 3, 4
DIM = 12
#: Labelled documents that training may draw at most (about): the documented bound of its sample.
TRAIN_DOCS = 2500
EPOCHS = 6
CACHE_WORDS = 300_000


@dataclass
class QualityModel:
    """``gain``: each bucket's contribution to the log odds of label 1; ``bias``: the log odds of no features."""

    gain: np.ndarray
    bias: float


def _mix(h: np.ndarray) -> np.ndarray:
    h = h.astype(np.uint64)
    h ^= h >> np.uint64(31)
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    return h & np.uint64(BUCKETS - 1)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter((zlib.crc32(w) for w in words), np.uint64, len(words))


def subwords(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(word index, bucket) of every character n-gram (over UTF-8 bytes) of each ``<word>`` and of the word."""
    joined = b"".join(b"<" + w + b">" for w in words)
    buf = np.frombuffer(joined, np.uint8).astype(np.uint64)
    lens = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    owner = np.repeat(np.arange(len(words)), lens)
    owners, buckets = [np.arange(len(words))], [_mix(word_hashes(words) + np.uint64(0x5BD1E995 << 8))]
    for n in range(MIN_N, MAX_N + 1):
        if len(buf) < n:
            continue
        h = np.zeros(len(buf) - n + 1, np.uint64)
        for k in range(n):
            h = h * np.uint64(1099511628211) + buf[k : len(buf) - n + 1 + k] + np.uint64(1)
        inside = owner[: len(buf) - n + 1] == owner[n - 1 :]
        owners.append(owner[: len(buf) - n + 1][inside])
        buckets.append(_mix(h[inside]))
    return np.concatenate(owners), np.concatenate(buckets).astype(np.int64)


def _pairs(hashes: np.ndarray) -> np.ndarray:
    return _mix((hashes[1:] ^ hashes[:-1]) + np.uint64(0x27D4EB2F << 9)).astype(np.int64)


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, weights): the document's average, weights summing to 1 (or nothing for no words)."""
    words = [w.encode("utf-8", "surrogatepass") for w in text.split()]
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.float32)
    unique, inverse, counts = np.unique(np.array(words, dtype=object), return_inverse=True, return_counts=True)
    owner, bucket = subwords(list(unique))
    pairs = _pairs(word_hashes(list(unique))[inverse])
    buckets, back = np.unique(np.concatenate([bucket, pairs]), return_inverse=True)
    weight = np.bincount(back, np.concatenate([counts[owner], np.ones(len(pairs))]))
    return buckets, (weight / weight.sum()).astype(np.float32)


def train(sample: list[tuple[str, int]], seed: int = 7) -> QualityModel:
    """SGD over the sample; with fewer than two labels in it, the model is the smoothed base rate."""
    rng = np.random.default_rng(seed)
    y = np.array([v for _, v in sample], np.int64)
    rate = (y.sum() + 1) / (len(y) + 2)
    if len(set(y.tolist())) < 2:
        return QualityModel(np.zeros(BUCKETS, np.float32), float(np.log(rate / (1 - rate))))
    rows = [features(t) for t, _ in sample]
    vectors = (rng.random((BUCKETS, DIM), np.float32) - 0.5) / DIM
    out, bias = np.zeros((DIM, 2), np.float32), np.array([np.log(1 - rate), np.log(rate)], np.float32)
    steps, step, lr0 = EPOCHS * len(rows), 0, 0.8
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            idx, w = rows[i]
            lr = lr0 * (1 - step / steps)
            step += 1
            if not len(idx):
                continue
            hidden = w @ vectors[idx]
            z = hidden @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1
            back = out @ p
            out -= lr * np.outer(hidden, p)
            bias -= lr * 0.05 * p
            vectors[idx] -= (lr * 40 * w)[:, None] * back
    return QualityModel((vectors @ (out[:, 1] - out[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


class Scorer:
    """Scores texts; remembers each word's subword sum, its count of features and its hash."""

    def __init__(self, model: QualityModel):
        self.model = model
        self._clear()

    def _clear(self) -> None:
        self.ids: dict[str, int] = {}
        self.sums, self.counts, self.hashes = np.zeros(0, np.float32), np.zeros(0, np.int64), np.zeros(0, np.uint64)

    def _learn(self, words: list[str]) -> None:
        coded = [w.encode("utf-8", "surrogatepass") for w in words]
        owner, bucket = subwords(coded)
        for k, w in enumerate(words, len(self.ids)):
            self.ids[w] = k
        self.sums = np.append(self.sums, np.bincount(owner, self.model.gain[bucket], len(words)).astype(np.float32))
        self.counts = np.append(self.counts, np.bincount(owner, minlength=len(words)))
        self.hashes = np.append(self.hashes, word_hashes(coded))

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        docs = [(t or "").split() for t in texts]
        if len(self.ids) > CACHE_WORDS:
            self._clear()
        if new := list({w for d in docs for w in d}.difference(self.ids)):
            self._learn(new)
        ids = np.fromiter((self.ids[w] for d in docs for w in d), np.int64)
        owner = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
        total = np.bincount(owner, self.sums[ids], len(docs))
        count = np.bincount(owner, self.counts[ids], len(docs))
        if len(ids) > 1:
            same = owner[1:] == owner[:-1]
            total += np.bincount(owner[1:][same], self.model.gain[_pairs(self.hashes[ids])[same]], len(docs))
            count += np.bincount(owner[1:][same], minlength=len(docs))
        z = self.model.bias + total / np.maximum(count, 1)
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit(docs: DataFrame, labels: DataFrame, folds: int = 5, bound: int = TRAIN_DOCS) -> QualityModel:
    """Train on labelled rows whose crc32(doc_id) mod ``folds`` is not 0, ``bound`` of them at most (about)."""
    return train(labelled_sample(docs, labels, "quality", fold(F.col("doc_id"), folds) != 0, bound))


def score(docs: DataFrame, model: QualityModel, text: str = "text"):
    """A column with the probability of label 1 for each whole text. Null and empty texts get that of no
    features. Rows are scored where they lie: no shuffle."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(shared.value)
        for s in batches:
            yield pd.Series(scorer([None if t is None else t for t in s]))

    return run(F.col(text))


def op1_quality(spark, sf_dir):
    from gleanery.llm.common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    out = docs.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), score(docs, model).alias("score"))
    return out.withColumn("predicted", F.when(F.col("score") >= 0.3, 1).otherwise(0))
