"""Hashed n-gram features, training in shards, and scoring, for the linear models."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.words import Powers, map_batches, pieces

Features = Callable  # (Texts, Powers) -> (row of each feature, feature), not distinct


def distinct_features(rows: np.ndarray, features: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, feature) pairs in order: features, and the first one of each row."""
    keys = np.unique((rows.astype(np.uint64) << np.uint64(32)) | features.astype(np.uint64))
    owner = (keys >> np.uint64(32)).astype(np.int64)
    return (keys & np.uint64(0xFFFFFFFF)).astype(np.int64), np.searchsorted(owner, np.arange(n_rows + 1))


def documents_of(texts: pa.Array, features: Features, powers: Powers) -> list[np.ndarray]:
    """The distinct features of each text."""
    out = []
    for piece in pieces(texts):
        ids, first = distinct_features(*features(piece, powers), len(piece))
        ids = ids.astype(np.uint32)
        out += [ids[first[i] : first[i + 1]] for i in range(len(piece))]
    return out


def train_shards(sample: DataFrame, fit: Callable[[pa.Table], tuple[np.ndarray, float]], dims: int) -> tuple[np.ndarray, float]:
    """Train a model on each shard of the sample and average the models.

    ``fit`` gives weights (``dims`` of them) and a bias. Only weights other than 0 come
    back, summed by Spark: at most ``dims`` + 1 rows reach the driver.
    """

    def run(shard: pa.Table) -> pa.Table:
        weights, bias = fit(shard)
        used = np.flatnonzero(weights)
        return pa.table(
            {
                "feature": pa.array(np.append(used, -1), pa.int32()),
                "weight": pa.array(np.append(weights[used], bias), pa.float64()),
            }
        )

    models = sample.groupBy("shard").applyInArrow(run, "feature int, weight double")
    summed = models.groupBy("feature").agg(
        F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("n")
    ).toArrow()
    ids, weight = summed["feature"].to_numpy(), summed["weight"].to_numpy()
    n = summed["n"].to_numpy()
    shards = int(n[ids == -1].max()) if len(ids) else 1
    weights = np.zeros(dims, np.float32)
    weights[ids[ids >= 0]] = weight[ids >= 0] / shards
    return weights, float(weight[ids == -1].sum() / shards)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


def score_texts(
    df: DataFrame,
    schema: str,
    keep: list[str],
    features: Features,
    score: Callable[[np.ndarray, np.ndarray, int], np.ndarray],
) -> DataFrame:
    """Columns ``keep`` and a score of column text, in one pass without a shuffle.

    ``score`` gets the row of each feature, the features, and the number of rows.
    """

    def make():
        powers = Powers()

        def each(batch):
            scores = np.empty(batch.num_rows)
            for piece in pieces(batch.column("text")):
                rows, ids = features(piece, powers)
                scores[piece.first : piece.first + len(piece)] = score(rows, ids, len(piece))
            columns = [batch.column(c) for c in keep] + [pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "score"])

        return each

    return map_batches(df.select(*keep, "text"), schema, make)
