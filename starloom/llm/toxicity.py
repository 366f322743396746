"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's probability is the logistic of a bias plus
the weights of its words' hashed features (the word, and its leading 3 to 6 characters, so
that inflected forms share weight); the document's is the noisy-or of its sentences',
``1 - prod(1 - p)``. Only document labels are known: the gradient of the document loss
reaches each sentence through the noisy-or, which is what lets the model say afterwards
which sentences offend. Scoring removes the bias' own share (a sentence without a weighted
word counts as probability 0), so a long clean document does not drift towards 1.

Training runs in numpy, in one task, over a bounded sample (``per_label`` documents of each
label); the model has a fixed size (``buckets`` float32 weights) whatever the corpus. Scoring
is one Arrow-batched pass over whole texts with no shuffle.
"""

from __future__ import annotations

import math
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import Memo, crc32_fold, labelled_sample, train_in_task, worker_state

SENTENCE = re.compile(r"[^.!?\n]+")
PUNCTUATION = " \t,;:\"'()[]{}<>*#$%&|-_"
RESULT = "struct<score:double,spans:array<struct<start:int,stop:int,score:double>>>"
ARROW_RESULT = pa.struct(
    [
        ("score", pa.float64()),
        ("spans", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("score", pa.float64())]))),
    ]
)


@dataclass(frozen=True)
class Settings:
    """Bounds and training parameters."""

    buckets: int = 1 << 18
    per_label: int = 2000
    max_chars: int = 200_000
    min_documents: int = 4
    steps: int = 120
    rate: float = 0.15
    refit_steps: int = 80
    l1: float = 1e-3
    min_weight: float = 0.4
    span_score: float = 0.5


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float
    span_score: float


def word_features(word: str, buckets: int) -> list[int]:
    """Hashed features of one word: itself and its leading 3 to 6 characters."""
    w = word.strip(PUNCTUATION).lower()
    if not w:
        return []
    out = [zlib.crc32(b"w" + w.encode("utf-8", "replace")) % buckets]
    out += [zlib.crc32(b"p" + w[:n].encode("utf-8", "replace")) % buckets for n in range(3, 7) if len(w) > n]
    return out


def train(sample: list[tuple[str, int]], settings: Settings = Settings()) -> Model:
    """Fit weights and bias from ``(text, label)`` pairs.

    Without both labels in the sample the weights stay 0 and the bias gives every sentence
    a negligible probability (nothing is called toxic).
    """
    weights = np.zeros(settings.buckets, np.float32)
    labels = np.array([y for _, y in sample], dtype=np.float64)
    if not 0 < labels.sum() < len(labels):
        return Model(weights, -12.0, settings.span_score)
    word_id: dict[str, int] = {}
    words, sentence_len, sentence_doc = [], [], []
    for d, (text, _) in enumerate(sample):
        for s in SENTENCE.findall(text):
            ids = [word_id.setdefault(w, len(word_id)) for w in s.split()]
            if ids:
                words += ids
                sentence_len.append(len(ids))
                sentence_doc.append(d)
    if not words:
        return Model(weights, -12.0, settings.span_score)
    words, doc_of = np.array(words, np.int32), np.array(sentence_doc, np.int32)
    sentence_of = np.repeat(np.arange(len(sentence_len), dtype=np.int32), sentence_len)
    features = [word_features(w, settings.buckets) for w in word_id]
    feature_word = np.repeat(np.arange(len(features)), [len(f) for f in features])
    feature = np.array([x for f in features for x in f], np.int64)
    # features of too few documents keep weight 0: they cannot be told from noise
    starts = np.searchsorted(feature_word, np.arange(len(features) + 1))
    counts = np.diff(starts)
    in_docs, edges = np.zeros(settings.buckets, np.int64), np.searchsorted(doc_of[sentence_of], np.arange(len(sample) + 1))
    for begin, end in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        rows = np.unique(words[begin:end])
        n = counts[rows]
        places = np.repeat(starts[rows] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        in_docs[np.unique(feature[places])] += 1
    frequent = in_docs >= settings.min_documents
    keep = frequent[feature]
    feature, feature_word = feature[keep], feature_word[keep]

    n_words, n_sentences, n_docs = len(features), len(sentence_len), len(sample)
    w, bias = np.zeros(settings.buckets), -6.0
    m, v = np.zeros(settings.buckets + 1), np.zeros(settings.buckets + 1)
    l1 = settings.l1
    for step in range(1, settings.steps + settings.refit_steps + 1):
        if step == settings.steps + 1:
            # the penalty has chosen the features; refit those alone, almost free of it
            frequent, l1 = w >= settings.min_weight, settings.l1 / 100
            w = w * frequent
        word_score = np.bincount(feature_word, w[feature], n_words)
        z = np.clip(bias + np.bincount(sentence_of, word_score[words], n_sentences), -30, 30)
        total = np.bincount(doc_of, np.log1p(np.exp(z)), n_docs)
        slope = np.where(labels == 0, 1.0, -1.0 / np.expm1(np.clip(total, 1e-6, 30)))
        g_sentence = slope[doc_of] / (1 + np.exp(-z)) / n_docs
        g_word = np.bincount(words, g_sentence[sentence_of], n_words)
        g = np.append(np.bincount(feature, g_word[feature_word], settings.buckets), g_sentence.sum())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        scale = settings.rate / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        move = scale * m / (1 - 0.9**step)
        # proximal step: weights are evidence of toxicity, so they stay at or above 0, and the
        # penalty keeps those of rare features at 0
        w = np.maximum(w - move[:-1] - l1 * scale[:-1], 0) * frequent
        bias -= move[-1]
    return Model(w.astype(np.float32), float(bias), settings.span_score)


def score_text(text: str, word_score: Memo, model: Model) -> tuple[float, list[dict]]:
    """Noisy-or over the sentences of one text, and the spans of offending sentences."""
    total, spans, idle = 0.0, [], math.log1p(math.exp(model.bias))
    get = word_score.__getitem__
    for s in SENTENCE.finditer(text):
        words = s.group().split()
        if not words:
            continue
        evidence = sum(map(get, words))
        if evidence <= 0:
            continue
        z = min(model.bias + evidence, 500.0)
        total += math.log1p(math.exp(z)) - idle
        p = 1 / (1 + math.exp(-z))
        if p >= model.span_score:
            spans.append({"start": s.start(), "stop": s.end(), "score": p})
    return -math.expm1(-total), spans


def scorer(spark: SparkSession, model: Model):
    """A column function text -> struct(score, spans) for this model."""
    shared = spark.sparkContext.broadcast((model.weights, model.bias, model.span_score))
    key = ("toxicity", zlib.crc32(model.weights.tobytes()), model.bias)

    def state():
        weights, bias, span_score = shared.value
        buckets = len(weights)
        memo = Memo(lambda word: float(sum(weights[i] for i in word_features(word, buckets))))
        return Model(weights, bias, span_score), memo

    @F.arrow_udf(RESULT)
    def toxicity(texts: pa.Array) -> pa.Array:
        fitted, memo = worker_state(key, state)
        out = []
        for value in texts:
            score, spans = score_text(value.as_py() or "", memo, fitted)
            out.append({"score": score, "spans": spans})
            memo.trim()
        return pa.array(out, ARROW_RESULT)

    return toxicity


def fit(documents: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Train on the documents of folds 1 to 4 of 5 (crc32 of the id) that have a label."""
    rows = labelled_sample(
        documents, labels, "toxic", crc32_fold(F.col("doc_id"), 5) != 0, settings.per_label, settings.max_chars
    )
    return train_in_task(rows, lambda sample: train(sample, settings))


def score_documents(documents: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score, spans`` of every document.

    Null and empty texts have no sentence, so their score is 0 and they have no spans.
    Repeated rows are scored each. Other columns of the input are not carried. ``spans``
    gives the character ranges of sentences at or above ``span_score``.
    """
    toxicity = scorer(documents.sparkSession, model)
    scored = documents.select("doc_id", toxicity(F.col("text")).alias("t"))
    return scored.select("doc_id", F.col("t.score").alias("score"), F.col("t.spans").alias("spans"))


def accepted(documents: DataFrame, model: Model, below: float = 0.5) -> DataFrame:
    """The documents that score below ``below``, with all their columns."""
    toxicity = scorer(documents.sparkSession, model)
    return documents.where(toxicity(F.col("text"))["score"] < F.lit(below))


def digest(scored: DataFrame) -> DataFrame:
    """The contract's columns: held_out, score, predicted, and the number of spans."""
    return scored.select(
        "doc_id",
        F.coalesce(crc32_fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("spans").alias("n_spans"),
    )


def op2_toxicity(spark: SparkSession, documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Train on the training folds' labels, score every whole text."""
    return digest(score_documents(documents, fit(documents, labels)))



