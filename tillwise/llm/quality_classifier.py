"""Quality scores by a support vector machine over naive Bayes log-count ratios."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.linear import distinct_features, documents_of, score_texts, sigmoid, train_shards
from tillwise.llm.shared import labelled_sample
from tillwise.llm.words import SPACE, Powers, Texts, byte_class, map_batches, mix, pieces, plain_word_bytes, spans, span_hashes

BITS = 20
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DIGITS = b"0123456789"


def ngrams(texts: Texts, powers: Powers, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of one to three tokens.

    Tokens are words and runs of symbols. Each n-gram is taken over the tokens as
    written (one and two of them) and over their shapes (one to three): a symbol run is
    its own shape, a word's shape says whether it starts with, ends with or is free of
    capitals, starts with a digit, or repeats the word before it.
    """
    data = texts.data
    word = plain_word_bytes()
    symbol = ~(word | byte_class(SPACE))
    ws, we = spans(texts, word)
    ss, se = spans(texts, symbol)
    starts, ends = np.concatenate((ws, ss)), np.concatenate((we, se))
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], ends[order]
    is_word = order < len(ws)
    hashes = span_hashes(data, starts, ends, powers)
    owner = np.searchsorted(texts.offsets, starts, side="right") - 1
    upper, digit = byte_class(UPPER), byte_class(DIGITS)
    if len(starts):
        shape = upper[data[starts]] * 1 + upper[data[ends - 1]] * 2 + digit[data[starts]] * 4 + (ends - starts == 1) * 8
        again = np.zeros(len(starts), bool)
        again[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1]) & is_word[1:]
        shape = np.where(is_word, (shape + again * 16 + 1).astype(np.uint64), hashes)
    else:
        shape = hashes
    rows, ids = [], []
    for tokens, longest, salt in ((hashes, 2, 1), (shape, 3, 101)):
        gram = np.zeros(len(tokens), np.uint64)
        for size in range(1, longest + 1):
            kept = len(tokens) - size + 1
            if kept <= 0:
                break
            gram = gram[:kept] * np.uint64(0xD6E8FEB86659FD93) + tokens[size - 1 :] + np.uint64(salt)
            same = owner[:kept] == owner[size - 1 :]
            rows.append(owner[:kept][same])
            ids.append(mix(gram[same] + np.uint64(size)))
    if not rows:
        return np.empty(0, np.int64), np.empty(0, np.uint32)
    return np.concatenate(rows), (np.concatenate(ids) >> np.uint64(64 - bits)).astype(np.uint32)


@dataclass(frozen=True)
class Svm:
    """Settings: add-one smoothing of the counts, the cost of the hinge loss, and when
    dual coordinate descent ends."""

    smoothing: float = 1.0
    cost: float = 10.0
    epochs: int = 15
    tolerance: float = 0.01
    seed: int = 1


def log_count_ratios(sample: DataFrame, bits: int, smoothing: float) -> np.ndarray:
    """log of the share of good texts holding a feature over that of bad ones. Counts are
    summed by Spark; at most 2^bits rows reach the driver."""

    def make():
        powers = Powers()

        def each(batch):
            label = batch.column("label").to_numpy()
            for piece in pieces(batch.column("text")):
                ids, first = distinct_features(*ngrams(piece, powers, bits), len(piece))
                good = np.repeat(label[piece.first : piece.first + len(piece)], np.diff(first))
                order = np.argsort(ids, kind="stable")
                begin = np.flatnonzero(np.diff(ids[order], prepend=-1))
                n = np.diff(np.append(begin, len(ids)))
                up = np.add.reduceat(good[order], begin) if len(begin) else n
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[order][begin], pa.int32()), pa.array(up, pa.int64()), pa.array(n - up, pa.int64())],
                    names=["feature", "good", "bad"],
                )

        return each

    counts = (
        map_batches(sample, "feature int, good long, bad long", make)
        .groupBy("feature")
        .agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
        .toArrow()
    )
    good, bad = np.full(1 << bits, smoothing), np.full(1 << bits, smoothing)
    ids = counts["feature"].to_numpy()
    good[ids] += counts["good"].to_numpy()
    bad[ids] += counts["bad"].to_numpy()
    ratios = np.log(good / good.sum()) - np.log(bad / bad.sum())
    seen = np.zeros(1 << bits, bool)
    seen[ids] = True
    return np.where(seen, ratios, 0.0).astype(np.float32)


def dual_coordinate_descent(
    docs: list[np.ndarray], values: list[np.ndarray], labels: np.ndarray, dims: int, how: Svm
) -> tuple[np.ndarray, float]:
    """A linear support vector machine with hinge loss: one dual variable at a time is
    set to its best value, the weights are kept in step. The bias is a feature of
    value 1. Classes weigh inversely to their size."""
    y = np.where(labels > 0, 1.0, -1.0)
    share = np.where(y > 0, (y > 0).mean(), (y < 0).mean())
    cost = how.cost * 0.5 / np.maximum(share, 1e-9)
    square = np.array([float(v @ v) + 1.0 for v in values])
    alpha, w, bias = np.zeros(len(docs)), np.zeros(dims), 0.0
    order = np.random.default_rng(how.seed)
    for _ in range(how.epochs):
        worst = 0.0
        for i in order.permutation(len(docs)):
            at, x = docs[i], values[i]
            gradient = y[i] * (float(w[at] @ x) + bias) - 1.0
            new = min(max(alpha[i] - gradient / square[i], 0.0), cost[i])
            step = (new - alpha[i]) * y[i]
            if step:
                w[at] += step * x
                bias += step
                worst = max(worst, abs(step) * square[i])
                alpha[i] = new
        if worst < how.tolerance:
            break
    return w, bias


def unit(ratios: np.ndarray, ids: np.ndarray) -> np.ndarray:
    x = ratios[ids].astype(np.float64)
    length = np.sqrt(x @ x)
    return x / length if length else x


def calibrate(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """a and b of score = 1 / (1 + exp(-(a * margin + b))), by Newton's method on the
    log loss, with classes weighing the same."""
    y = labels.astype(np.float64)
    share = np.where(y > 0, y.mean(), 1 - y.mean())
    weight = 0.5 / np.maximum(share, 1e-9)
    x = np.stack((margins, np.ones(len(margins))), 1)
    at = np.array([1.0, 0.0])
    for _ in range(50):
        p = sigmoid(x @ at)
        gradient = x.T @ (weight * (p - y)) + 1e-3 * at
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        at = at - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return float(at[0]), float(at[1])


@dataclass(frozen=True)
class QualityModel:
    """Weight times log-count ratio and square of the ratio by feature, bias, and the
    calibration. 2^20 features at most, 8 bytes each."""

    weights: np.ndarray
    squares: np.ndarray
    bias: float
    slope: float
    shift: float
    bits: int


def margins_of(rows, ids, n_rows: int, weights: np.ndarray, squares: np.ndarray, bias: float) -> np.ndarray:
    keys, first = distinct_features(rows, ids, n_rows)
    owner = np.repeat(np.arange(n_rows), np.diff(first))
    length = np.sqrt(np.bincount(owner, squares[keys], n_rows))
    return np.bincount(owner, weights[keys], n_rows) / np.where(length > 0, length, 1) + bias


def fit_quality(
    docs: DataFrame, labels: DataFrame, *, max_rows: int = 16_000, shards: int = 8, bits: int = BITS, how: Svm = Svm()
) -> QualityModel:
    """Learn ``labels.quality`` from at most ``max_rows`` labelled texts outside the
    held-out fold: log-count ratios over all of them, then a support vector machine on
    each of ``shards`` shares, averaged, then one calibration over all of them. Texts
    are scaled to length 1. Without labels every score is 0.5.
    """
    dims = 1 << bits
    sample = labelled_sample(docs, labels, "quality", max_rows, shards)
    ratios = log_count_ratios(sample, bits, how.smoothing)
    sent = sample.sparkSession.sparkContext.broadcast(ratios)

    def fit(shard: pa.Table):
        own = sent.value
        texts = documents_of(shard["text"], lambda t, p: ngrams(t, p, bits), Powers())
        return dual_coordinate_descent(texts, [unit(own, t) for t in texts], shard["label"].to_numpy(), dims, how)

    plain, bias = train_shards(sample, fit, dims)
    weights, squares = plain * ratios, ratios * ratios
    model = sample.sparkSession.sparkContext.broadcast((weights, squares))

    def make():
        powers = Powers()

        def each(batch):
            for piece in pieces(batch.column("text")):
                found = margins_of(*ngrams(piece, powers, bits), len(piece), *model.value, bias)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found), batch.column("label").slice(piece.first, len(piece))], names=["margin", "label"]
                )

        return each

    # At most max_rows pairs of numbers.
    seen = map_batches(sample, "margin double, label int", make).toArrow()
    slope, shift = calibrate(seen["margin"].to_numpy(), seen["label"].to_numpy()) if seen.num_rows else (0.0, 0.0)
    return QualityModel(weights, squares, bias, slope, shift, bits)


def score_quality(docs: DataFrame, model: QualityModel, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) for every row of ``docs``, scored on its whole text.

    score is between 0 and 1. A null or empty text gets the score of the bias. Rows
    repeat as they do in ``docs``, null ids included; other columns are not read. One
    pass, no shuffle.
    """
    sent = docs.sparkSession.sparkContext.broadcast((model.weights, model.squares))
    bias, slope, shift, bits = model.bias, model.slope, model.shift, model.bits

    def score(rows, ids, n_rows):
        return sigmoid(slope * margins_of(rows, ids, n_rows, *sent.value, bias) + shift)

    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return score_texts(texts, "doc_id long, score double", ["doc_id"], lambda t, p: ngrams(t, p, bits), score)


def keep_quality(docs: DataFrame, model: QualityModel, least: float, *, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text scores at least ``least``; see ``score_quality``. All
    columns stay as they are. One pass, no shuffle."""
    sent = docs.sparkSession.sparkContext.broadcast((model.weights, model.squares))
    bias, slope, shift, bits = model.bias, model.slope, model.shift, model.bits

    def make():
        powers = Powers()

        def each(batch):
            good = np.empty(batch.num_rows, bool)
            for piece in pieces(batch.column(text)):
                margin = margins_of(*ngrams(piece, powers, bits), len(piece), *sent.value, bias)
                good[piece.first : piece.first + len(piece)] = sigmoid(slope * margin + shift) >= least
            yield batch.filter(pa.array(good))

        return each

    return map_batches(docs, docs.schema, make)
