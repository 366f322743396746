"""Supervised subword embeddings as a quality classifier.

Every word has hashed features: the word itself and the byte n-grams (3 to 5) of ``<word>``.
A word's vector is the mean of its features' learned vectors; a document's is the mean over its
words, plus one more feature for each word equal to the one before it (the word bigram
``= =``, which no vocabulary hash could generalise); a softmax layer follows. Vectors and layer
are trained together by minibatch stochastic gradient descent in numpy (Adagrad step sizes), in
one task over a bounded labelled sample.

Averaging and the layer are linear, so a fitted model scores a word by the difference of its
two class logits, one float32 per bucket: a fixed size to share whatever the corpus. Scoring is
one Arrow-batched pass over whole texts without a shuffle; a worker keeps the scores of words
it has met in a bounded memo.
"""

from __future__ import annotations

import math
import operator
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import MEMO_ENTRIES, crc32_fold, labelled_sample, train_in_task, worker_state
from starloom.llm.pieces import slices

GRAMS = (3, 4, 5)


@dataclass(frozen=True)
class Settings:
    """Bounds and training parameters."""

    bits: int = 17
    dim: int = 16
    per_label: int = 2000
    max_chars: int = 200_000
    epochs: int = 4
    batch: int = 64
    rate: float = 0.1
    seed: int = 17


@dataclass(frozen=True)
class Model:
    """Class-1 minus class-0 logit of each bucket, of a repeat, and the bias."""

    scores: np.ndarray
    repeat: float
    bias: float


def features(words: list[bytes], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature buckets of distinct words, and the index of the word each belongs to."""
    # words have no line feed, so one call decodes them all
    texts = b"\n".join(words).decode("utf-8", "surrogatepass").split("\n") if words else []
    data = "".join(f"<{w}>" for w in texts)
    lengths = np.fromiter(map(len, texts), np.int64, len(words)) + 2
    ends = np.cumsum(lengths)
    owner = np.repeat(np.arange(len(words)), lengths)
    left = ends[owner] - np.arange(len(data))  # characters from here to the word's end
    letters = np.frombuffer(data.encode("utf-32-le", "surrogatepass"), np.uint32)
    buckets = [np.fromiter((zlib.crc32(w) for w in words), np.uint32, len(words))]
    owners = [np.arange(len(words))]
    for n in GRAMS:
        size = max(0, len(data) - n + 1)
        h = np.full(size, 0x811C9DC5 + n, np.uint32)
        for k in range(n):
            h = (h ^ letters[k : k + size]) * np.uint32(16777619)
        at = np.flatnonzero(left[:size] >= n)
        buckets.append(h[at])
        owners.append(owner[at])
    mixed = np.concatenate(buckets) * np.uint32(2654435769) >> np.uint32(32 - bits)
    return mixed.astype(np.int64), np.concatenate(owners)


def repeats(words: list[bytes]) -> int:
    return sum(map(operator.eq, words, words[1:]))


def train(sample: list[tuple[str, int]], settings: Settings = Settings()) -> Model:
    """Fit on ``(text, label)`` pairs.

    Without any sample every score is 0.5; with one label only, the bias says that label.
    """
    size = 1 << settings.bits
    y = np.array([label for _, label in sample], np.int64)
    if not 0 < y.sum() < len(y):
        return Model(np.zeros(size, np.float32), 0.0, 0.0 if not len(y) else 4.0 * (2 * int(y[0]) - 1))
    ids: dict[bytes, int] = {}
    docs = []  # (distinct word ids, counts, repeats)
    for text, _ in sample:
        words = text.encode("utf-8", "surrogatepass").split()
        found, counts = np.unique([ids.setdefault(w, len(ids)) for w in words], return_counts=True)
        docs.append((found.astype(np.int64), counts, repeats(words)))
    bucket, owner = features(list(ids), settings.bits)
    order = np.argsort(owner, kind="stable")
    bucket = bucket[order]
    per_word = np.bincount(owner, minlength=len(ids))
    starts = np.cumsum(per_word) - per_word

    rng = np.random.default_rng(settings.seed)
    dim = settings.dim
    vectors = (rng.random((size + 1, dim), np.float32) - 0.5) / dim  # the last row: a repeat
    layer, bias = np.zeros((dim, 2), np.float32), np.zeros(2, np.float32)
    seen, seen_layer, seen_bias = np.full((size + 1, dim), 1e-6, np.float32), 1e-6, 1e-6
    for _ in range(settings.epochs):
        shuffled = rng.permutation(len(docs))
        for b in range(0, len(docs), settings.batch):
            chosen = shuffled[b : b + settings.batch]
            part = [docs[d] for d in chosen]
            word = np.concatenate([p[0] for p in part])
            doc = np.repeat(np.arange(len(part)), [len(p[0]) for p in part])
            again = np.array([p[2] for p in part], np.float32)
            total = np.maximum(np.array([p[1].sum() for p in part], np.float32) + again, 1)
            weight = np.concatenate([p[1] for p in part]).astype(np.float32) / total[doc]
            local, at = np.unique(word, return_inverse=True)
            n = per_word[local]
            rows = np.repeat(np.arange(len(local)), n)
            f = bucket[np.repeat(starts[local] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            sums = np.add.reduceat(vectors[f], np.cumsum(n) - n, axis=0) if len(f) else np.zeros((0, dim), np.float32)
            word_vec = sums / n[:, None]
            pooled = np.zeros((len(part), dim), np.float32)
            for k in range(dim):
                pooled[:, k] = np.bincount(doc, word_vec[at, k] * weight, len(part))
            pooled += (again / total)[:, None] * vectors[size]
            logits = pooled @ layer + bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(part)), y[chosen]] -= 1
            p /= len(part)
            g_layer, g_bias, g_pooled = pooled.T @ p, p.sum(axis=0), p @ layer.T
            g_vectors = np.zeros((size + 1, dim), np.float32)
            for k in range(dim):
                g_word = np.bincount(at, weight * g_pooled[doc, k], len(local)) / n
                g_vectors[:size, k] = np.bincount(f, g_word[rows], size)
            g_vectors[size] = (again / total) @ g_pooled
            seen += g_vectors**2
            vectors -= settings.rate * g_vectors / np.sqrt(seen)
            seen_layer, seen_bias = seen_layer + g_layer**2, seen_bias + g_bias**2
            layer -= settings.rate * g_layer / np.sqrt(seen_layer)
            bias -= settings.rate * g_bias / np.sqrt(seen_bias)
    project = vectors @ (layer[:, 1] - layer[:, 0])
    return Model(project[:size].astype(np.float32), float(project[size]), float(bias[1] - bias[0]))


class WordScores:
    """Mean bucket score of words, kept in a bounded memo."""

    def __init__(self, model: Model):
        self.model = model
        self.bits = len(model.scores).bit_length() - 1
        self.memo: dict[bytes, float] = {}

    def learn(self, words: set[bytes]) -> None:
        if len(self.memo) > MEMO_ENTRIES:
            self.memo.clear()
        missing = list(words.difference(self.memo))
        for i in range(0, len(missing), 50_000):
            part = missing[i : i + 50_000]
            bucket, owner = features(part, self.bits)
            sums = np.bincount(owner, self.model.scores[bucket], len(part)) / np.bincount(owner, minlength=len(part))
            self.memo.update(zip(part, sums.tolist(), strict=True))

    def score(self, words: list[bytes]) -> float:
        again = repeats(words)
        total = sum(map(self.memo.__getitem__, words)) + again * self.model.repeat
        z = self.model.bias + total / max(1, len(words) + again)
        return 1 / (1 + math.exp(-max(-500.0, z)))

    def texts(self, texts: list[str]) -> list[float]:
        words = [t.encode("utf-8", "surrogatepass").split() for t in texts]
        self.learn(set().union(*words))
        return [self.score(w) for w in words]


def fit(documents: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Train on the documents of folds 0 and 2 of 3 (crc32 of the id) that have a label."""
    rows = labelled_sample(
        documents, labels, "quality", crc32_fold(F.col("doc_id"), 3) != 1, settings.per_label, settings.max_chars
    )
    return train_in_task(rows, lambda sample: train(sample, settings))


def score_documents(documents: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of every document.

    Null and empty texts have no words and get the score of the bias alone. Repeated rows are
    scored each. Other columns of the input are not carried.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)
    key = ("quality", zlib.crc32(model.scores.tobytes()), model.bias, model.repeat)

    @F.arrow_udf("double")
    def quality(texts: pa.Array) -> pa.Array:
        scores = worker_state(key, lambda: WordScores(shared.value))
        values = [t or "" for t in texts.to_pylist()]
        out = []
        for i, j in slices(values):
            out += scores.texts(values[i:j])
        return pa.array(out, pa.float64())

    return documents.select("doc_id", quality(F.col("text")).alias("score"))


def op5_quality_classifier(spark: SparkSession, documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Train on the training folds' labels, score every whole text; the contract's columns."""
    scored = score_documents(documents, fit(documents, labels))
    return scored.select(
        "doc_id",
        F.coalesce(crc32_fold(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
