"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

P(grade >= k) is the logistic function of w.x - t_k with one weight vector for all ordered
thresholds t_k. The features are the distinct words of the whole text and their beginnings of
five to eight bytes, so that inflected forms share evidence. Labels say only toxic or not; the
grades of the toxic training documents are thirds by how many of the training sample's typical
toxic features they contain. The result is the expected grade.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidestream.llm.features import DIMENSIONS, dot, word_and_prefix_features
from tidestream.llm.linear import SAMPLE_ROWS, Ftrl, feature_lists, held_out, labelled_sample, sigmoid, whole_sample
from tidestream.llm.storage import small_batches
from tidestream.llm.words import pieces

GRADES = 4
EPOCHS = 4
THRESHOLD = 0.25
L1 = 4.0
MIN_DOCUMENTS = 5
MIN_LOG_ODDS = 3.0
MIN_GAP = 0.05


@dataclass
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray


def grades_from_labels(features: list[np.ndarray], toxic: np.ndarray, grades: int = GRADES) -> np.ndarray:
    """Grade 0 for documents that are not toxic, 1 and up for toxic ones by number of toxic features."""
    bad, good = np.zeros(DIMENSIONS), np.zeros(DIMENSIONS)
    for at, label in zip(features, toxic):
        (bad if label > 0 else good)[at] += 1
    odds = np.log((bad + 0.5) / (max(1, (toxic > 0).sum()) + 1)) - np.log((good + 0.5) / (max(1, (toxic <= 0).sum()) + 1))
    typical = (bad >= MIN_DOCUMENTS) & (odds >= MIN_LOG_ODDS)
    found = np.array([typical[at].sum() for at in features])
    result = np.zeros(len(features), np.int64)
    if (toxic > 0).any():
        cuts = np.quantile(found[toxic > 0], np.arange(1, grades - 1) / (grades - 1))
        result[toxic > 0] = 1 + np.searchsorted(cuts, found[toxic > 0], side="left")
    return result


def train(features: list[np.ndarray], grades: np.ndarray, levels: int = GRADES, epochs: int = EPOCHS, **settings) -> OrdinalModel:
    """FTRL updates of the shared weights, adaptive gradient steps of the ordered thresholds."""
    model, order = Ftrl(**{"l1": L1, **settings}), np.random.default_rng(20240101)
    above = np.array([(grades >= k).mean() for k in range(1, levels)]) if len(grades) else np.full(levels - 1, 0.5)
    start = np.clip(above, 1e-3, 1 - 1e-3)
    thresholds = np.log(1 - start) - np.log(start)
    steps = np.ones(levels - 1)
    for _ in range(epochs):
        for k in order.permutation(len(features)):
            at, grade = features[k], int(grades[k])
            weights = model.weights(at)
            f = weights.sum()
            upper = float(sigmoid(thresholds[grade] - f)) if grade < levels - 1 else 1.0
            lower = float(sigmoid(thresholds[grade - 1] - f)) if grade else 0.0
            inside = max(upper - lower, 1e-9)
            model.update(at, weights, 1.0 - upper - lower)
            for j, gradient in ((grade, -upper * (1 - upper) / inside), (grade - 1, lower * (1 - lower) / inside)):
                if 0 <= j < levels - 1:
                    steps[j] += gradient * gradient
                    thresholds[j] -= 0.1 * gradient / np.sqrt(steps[j])
            gaps = np.arange(levels - 1) * MIN_GAP
            thresholds = np.maximum.accumulate(thresholds - gaps) + gaps
    return OrdinalModel(model.weights(), thresholds)


def _fit(table: pa.Table) -> pa.Table:
    features, toxic = feature_lists(table), table.column("label").to_numpy()
    order = sorted(range(len(features)), key=lambda k: (toxic[k], features[k].tobytes()))
    features, toxic = [features[k] for k in order], toxic[order]
    model = train(features, grades_from_labels(features, toxic))
    used = np.flatnonzero(model.weights)
    numbers = np.concatenate([used, -1 - np.arange(GRADES - 1)])
    return pa.table({"feature": pa.array(numbers.astype(np.int32)), "weight": pa.array(np.concatenate([model.weights[used], model.thresholds]))})


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> OrdinalModel:
    """Learn from at most about `sample_rows` labelled documents that are not held out.

    Without labelled rows, or with an empty table, all weights are 0. Null and repeated labels, ids
    and rows are as in `labelled_sample`.
    """
    model = OrdinalModel(np.zeros(DIMENSIONS), np.arange(GRADES - 1, dtype=float))
    sample = labelled_sample(docs, labels, label, sample_rows)
    for row in whole_sample(sample, word_and_prefix_features, _fit, "feature int, weight double"):
        (model.weights if row.feature >= 0 else model.thresholds)[max(row.feature, -1 - row.feature)] = row.weight
    return model


def score_toxicity(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """One row per document row: doc_id, held_out, severity, grade, score, predicted, toxic.

    `severity` is the expected grade (0 to 3), `grade` the likeliest one, `score` the probability
    of any toxicity; `predicted` is 1 and `toxic` true if that is at
    least 0.25. Of equally likely grades the lowest is taken. A null or empty text scores like a
    text without features; very long texts are scored whole, one at a time; null ids and repeated
    rows are scored like any other, and an empty table gives no rows. Only `doc_id` and `text` are read.
    """
    weights, thresholds = model.weights.astype(np.float32), model.thresholds

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch.column(1)):
                f = dot(weights, *word_and_prefix_features(piece))
                above = sigmoid(f[:, None] - thresholds[None, :])
                each = -np.diff(np.concatenate([np.ones((len(f), 1)), above, np.zeros((len(f), 1))], axis=1), axis=1)
                columns = [above.sum(axis=1), each.argmax(axis=1).astype(np.int32), above[:, 0]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[piece.rows], *map(pa.array, columns)], names=["doc_id", "severity", "grade", "score"]
                )

    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = rows.mapInArrow(run, "doc_id long, severity double, grade int, score double")
    predicted = F.when(F.col("score") >= THRESHOLD, 1).otherwise(0)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "severity",
        "grade",
        "score",
        predicted.alias("predicted"),
        (predicted == 1).alias("toxic"),
    )
