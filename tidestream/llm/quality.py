"""Quality classifier: logistic regression on hashed word n-grams, trained by FTRL updates.

Features are the distinct words and word pairs of the whole text, with runs of symbols as words
of their own, hashed into 2**18 numbers. The score is one sparse dot product per document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidestream.llm.features import DIMENSIONS, dot, word_ngram_features
from tidestream.llm.linear import SAMPLE_ROWS, Ftrl, feature_lists, held_out, labelled_sample, sigmoid, whole_sample
from tidestream.llm.storage import small_batches
from tidestream.llm.words import pieces

EPOCHS = 3
THRESHOLD = 0.3


def train(features: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, **settings) -> np.ndarray:
    """Weights of a logistic model, 0 for features that don't matter."""
    model, order = Ftrl(**settings), np.random.default_rng(20240101)
    for _ in range(epochs):
        for k in order.permutation(len(features)):
            at = np.concatenate([[0], features[k]])
            weights = model.weights(at)
            model.update(at, weights, float(sigmoid(weights.sum()) - labels[k]))
    return model.weights()


def _fit(table: pa.Table) -> pa.Table:
    # Rows in a fixed order, whatever order the tasks finished in.
    features, labels = feature_lists(table), table.column("label").to_numpy()
    order = sorted(range(len(features)), key=lambda k: (labels[k], features[k].tobytes()))
    weights = train([features[k] for k in order], labels[order])
    used = np.flatnonzero(weights)
    return pa.table({"feature": pa.array(used.astype(np.int32)), "weight": pa.array(weights[used])})


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", sample_rows: int = SAMPLE_ROWS) -> np.ndarray:
    """Learn from at most about `sample_rows` labelled documents that are not held out.

    Only their texts are features. Without labelled rows, or with an empty table, all weights are 0
    and scores 0.5. Null and repeated labels, ids and rows are as in `labelled_sample`.
    """
    sample = labelled_sample(docs, labels, label, sample_rows)
    weights = np.zeros(DIMENSIONS)
    for row in whole_sample(sample, word_ngram_features, _fit, "feature int, weight double"):
        weights[row.feature] = row.weight
    return weights


def score_quality(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """One row per document row: doc_id, held_out, score (0 to 1), predicted (1 if score >= 0.3).

    A null or empty text gets the score of a text without features. Very long texts are scored
    whole, one at a time. Null ids and repeated rows are scored like any other, equal texts get
    equal scores, and an empty table gives no rows. Only `doc_id` and `text` are read.
    """
    weights = weights.astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch.column(1)):
                scores = sigmoid(dot(weights, *word_ngram_features(piece)) + float(weights[0]))
                yield pa.RecordBatch.from_arrays([batch.column(0)[piece.rows], pa.array(scores)], names=["doc_id", "score"])

    small_batches(docs.sparkSession)
    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
    predicted = F.when(F.col("score") >= THRESHOLD, 1).otherwise(0)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"))
