"""Training samples and follow-the-regularised-leader updates for sparse linear models."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidestream.llm.features import DIMENSIONS
from tidestream.llm.storage import small_batches
from tidestream.llm.words import pieces

SAMPLE_ROWS = 12_000
_RESOLUTION = 1 << 40


def held_out(doc_id: Column) -> Column:
    """Rows kept for testing: crc32 of the id as text is divisible by 5. Null ids are not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sample_place(key: str) -> Column:
    """A row's place in a fixed range, by the hash of its key."""
    return F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(_RESOLUTION))


def sample_limit(count: int, bound: int) -> int:
    """The places below which about `bound` of `count` rows lie, or all if they are fewer."""
    return int(min(1.0, bound / max(1, count)) * _RESOLUTION)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, bound: int = SAMPLE_ROWS) -> DataFrame:
    """Rows (label, text) to learn from: labelled, not held out, at most about `bound` of them.

    Of several labels of a document the largest counts; null labels and ids are no labels. Of several
    rows with one id the one with the smallest hash of its text counts, so the bound holds however
    often an id is repeated. Without labels, or without their documents, there are no rows. Very
    long texts count whole. Only doc_id and text, and doc_id and the label column, are read.
    """
    known = labels.groupBy("doc_id").agg(F.max(label).cast("double").alias("label"))
    known = known.where("doc_id is not null and label is not null").where(~held_out(F.col("doc_id")))
    chosen = known.where(sample_place("doc_id") < sample_limit(known.count(), bound))
    # The sample's ids and labels are bounded by `bound`: some hundred kilobytes.
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    one = found.groupBy("doc_id").agg(F.max("label").alias("label"), F.min_by("text", F.xxhash64("text")).alias("text"))
    return one.select("label", "text")


def featurise(make):
    """For mapInArrow over (label, text): rows (label, features)."""

    def run(batches):
        for batch in batches:
            for piece in pieces(batch.column(1)):
                values, first = make(piece)
                lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(0)[piece.rows], lists], names=["label", "features"])

    return run


def feature_lists(table: pa.Table) -> list[np.ndarray]:
    lists = table.column("features").combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    values, at = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
    return [values[a:b].astype(np.int64) for a, b in zip(at, at[1:])]


class Ftrl:
    """Per-coordinate FTRL-proximal state; weights below the L1 threshold are exactly 0."""

    def __init__(self, alpha: float = 0.1, beta: float = 1.0, l1: float = 1.0, l2: float = 0.0):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(DIMENSIONS), np.zeros(DIMENSIONS)

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) > self.l1, shrunk, 0.0)

    def update(self, at: np.ndarray, weights: np.ndarray, gradient: float) -> None:
        n = self.n[at]
        rate = (np.sqrt(n + gradient * gradient) - np.sqrt(n)) / self.alpha
        self.z[at] += gradient - rate * weights
        self.n[at] = n + gradient * gradient


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


def whole_sample(rows: DataFrame, make, fit, schema: str) -> list:
    """Fit on a bounded sample in one task; the fitted numbers are bounded by the feature space."""
    small_batches(rows.sparkSession)
    features = rows.mapInArrow(featurise(make), "label double, features array<int>")
    return features.groupBy(F.lit(0).alias("all")).applyInArrow(fit, schema).collect()
