"""Toxicity scores by logistic regression, trained with FTRL-proximal."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.linear import documents_of, score_texts, sigmoid, train_shards
from tillwise.llm.shared import labelled_sample
from tillwise.llm.words import Powers, Texts, mix, plain_word_bytes, words_of

BITS = 20


def ngrams(texts: Texts, powers: Powers, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Hashed word n-grams and skip-grams: single words, neighbours, and pairs that
    leave one word out. Words are in the texts' case."""
    words = words_of(texts, plain_word_bytes(), powers)
    owner, hashes = words.owner(), words.hashes
    rows, ids = [owner], [hashes]
    for gap in (1, 2):
        same = owner[:-gap] == owner[gap:]
        left, right = hashes[:-gap][same], hashes[gap:][same]
        rows.append(owner[:-gap][same])
        ids.append(mix(left * np.uint64(2 * gap + 1) + (right << np.uint64(1)) + np.uint64(gap)))
    shift = np.uint64(64 - bits)
    return np.concatenate(rows), (np.concatenate(ids) >> shift).astype(np.uint32)


@dataclass(frozen=True)
class Ftrl:
    """Settings of FTRL-proximal (per-coordinate rates, L1 and L2)."""

    alpha: float = 4.0
    beta: float = 1.0
    l1: float = 8.0
    l2: float = 0.0
    epochs: int = 8
    seed: int = 1


def ftrl(docs: list[np.ndarray], labels: np.ndarray, dims: int, how: Ftrl) -> tuple[np.ndarray, float]:
    """Logistic regression over indicator features; the bias carries no penalty."""
    z, n = np.zeros(dims), np.zeros(dims)
    bias_z = bias_n = 0.0
    order = np.random.default_rng(how.seed)

    def weights(at):
        za = z[at]
        over = np.abs(za) - how.l1
        return np.where(over > 0, -np.sign(za) * over / ((how.beta + np.sqrt(n[at])) / how.alpha + how.l2), 0.0)

    for _ in range(how.epochs):
        for i in order.permutation(len(docs)):
            at = docs[i]
            w = weights(at)
            bias = -bias_z * how.alpha / (how.beta + np.sqrt(bias_n))
            g = float(sigmoid(w.sum() + bias)) - labels[i]
            grown = n[at] + g * g
            z[at] += g - (np.sqrt(grown) - np.sqrt(n[at])) / how.alpha * w
            n[at] = grown
            grown = bias_n + g * g
            bias_z += g - (np.sqrt(grown) - np.sqrt(bias_n)) / how.alpha * bias
            bias_n = grown
    return weights(np.arange(dims)), -bias_z * how.alpha / (how.beta + np.sqrt(bias_n))


@dataclass(frozen=True)
class ToxicityModel:
    """Weights other than 0, and the bias. At most 2^20 weights, 8 bytes each."""

    features: np.ndarray
    weights: np.ndarray
    bias: float
    bits: int


def lowered(df: DataFrame) -> DataFrame:
    return df.withColumn("text", F.lower(F.coalesce(F.col("text"), F.lit(""))))


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, *, max_rows: int = 10_000, shards: int = 1, bits: int = BITS, how: Ftrl = Ftrl()
) -> ToxicityModel:
    """Learn ``labels.toxic`` from at most ``max_rows`` labelled texts outside the
    held-out fold. Each of ``shards`` tasks trains on its share and the weights are
    averaged; averaging costs recall of rare words, and the sample is bounded, so one
    share is the default. Without any label every score is 0.5.
    """
    dims = 1 << bits
    sample = lowered(labelled_sample(docs, labels, "toxic", max_rows, shards))

    def fit(shard: pa.Table):
        texts = documents_of(shard["text"], lambda t, p: ngrams(t, p, bits), Powers())
        return ftrl(texts, shard["label"].to_numpy(), dims, how)

    weights, bias = train_shards(sample, fit, dims)
    used = np.flatnonzero(weights)
    return ToxicityModel(used.astype(np.uint32), weights[used].astype(np.float32), bias, bits)


def score_toxicity(docs: DataFrame, model: ToxicityModel, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) for every row of ``docs``, scored on its whole text.

    score is between 0 and 1. A null or empty text, or one without words, gets the score
    of the bias. Rows repeat as they do in ``docs``, null ids included; other columns are
    not read. One pass, no shuffle.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast((model.features, model.weights))
    bias, bits = model.bias, model.bits

    def score(rows, ids, n_rows):
        used, weights = sent.value
        at = np.minimum(np.searchsorted(used, ids), max(len(used) - 1, 0))
        hit = np.flatnonzero(used[at] == ids) if len(used) else np.empty(0, np.int64)
        # Most weights are 0: only the few features that have one are made distinct.
        keys, one = np.unique((rows[hit].astype(np.uint64) << np.uint64(32)) | ids[hit], return_index=True)
        sums = np.bincount((keys >> np.uint64(32)).astype(np.int64), weights[at[hit[one]]], n_rows)
        return sigmoid(sums + bias)

    texts = lowered(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")))
    return score_texts(texts, "doc_id long, score double", ["doc_id"], lambda t, p: ngrams(t, p, bits), score)
