"""Document fingerprints by consistent weighted sampling.

A text is a set of words (A-Z folded) weighted by how often they occur. For each of 64 samples,
every word gets two gamma-distributed numbers and a uniform one from its hash; with its weight
they give a rank, and the word of lowest rank, with its quantised weight, is the sample. Two
texts agree in a sample with a probability equal to their generalised Jaccard similarity, the sum
of smaller over the sum of larger weights. The fingerprint keeps 16 bits of each sample, and its
likeness to another is the share of equal samples.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidestream.llm.storage import small_batches
from tidestream.llm.words import Piece, mix, pieces

SAMPLES = 64
_SAMPLES_AT_ONCE = 16
_LAST_ID = 2**63 - 1
ROWS_PER_RANGE = 2000
LEAST_ERROR = 1e-5  # of the ranks of cuts; with more ranges than this allows for, some are larger
_OUTPUT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
)


def gamma_quantiles(size: int = 1 << 16) -> np.ndarray:
    """The gamma distribution with shape 2 and rate 1 at the middles of equal shares."""
    x = np.concatenate([np.geomspace(1e-6, 1, 60_000, endpoint=False), np.linspace(1, 40, 60_000)])
    below = 1 - (1 + x) * np.exp(-x)
    return np.interp((np.arange(size) + 0.5) / size, below, x)


class Sampler:
    def __init__(self, samples: int = SAMPLES):
        gamma = gamma_quantiles()
        self.samples, self.gamma, self.log_gamma = samples, gamma.astype(np.float32), np.log(gamma).astype(np.float32)
        self.seeds = mix(np.arange(1, samples + 1, dtype=np.uint64) << np.uint64(32))

    def _ranks(self, words: np.ndarray, log_counts: np.ndarray, seeds: np.ndarray) -> np.ndarray:
        """For every word with its weight and every sample: rank above, 16 bits of identity below."""
        x = mix(words[:, None] ^ seeds[None, :])
        r = self.gamma[x & np.uint64(0xFFFF)]
        log_c = self.log_gamma[(x >> np.uint64(16)) & np.uint64(0xFFFF)]
        beta = ((x >> np.uint64(32)) & np.uint64(0xFFFF)).astype(np.float32) / np.float32(65536)
        t = np.zeros(x.shape, np.float32)
        many = np.flatnonzero(log_counts > 0)  # a single occurrence has the level 0
        t[many] = np.floor(log_counts[many, None] / r[many] + beta[many])
        rank = log_c - r * (t - beta + 1)
        bits = rank.view(np.int32)
        sortable = np.where(bits < 0, ~bits, bits | np.int32(-(2**31))).view(np.uint32)
        identity = (x >> np.uint64(48)) ^ (t.astype(np.int64).astype(np.uint64) * np.uint64(40503)) & np.uint64(0xFFFF)
        return (sortable.astype(np.uint64) << np.uint64(16)) | (identity & np.uint64(0xFFFF))

    def fingerprints(self, words: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The samples of each text, as rows of 16-bit numbers; 0 for a text without words."""
        owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
        order = np.lexsort((words, owner))
        words, owner = words[order], owner[order]
        new = np.ones(len(words), bool)
        new[1:] = (words[1:] != words[:-1]) | (owner[1:] != owner[:-1])
        starts = np.flatnonzero(new)
        counts = np.diff(np.append(starts, len(words)))
        words, owner = words[starts], owner[starts]
        # Every different pair of word and count is computed once for all texts.
        _, at, inverse = np.unique(mix(words ^ mix(counts.astype(np.uint64))), return_index=True, return_inverse=True)
        log_counts = np.log(counts[at]).astype(np.float32)
        result = np.zeros((len(first) - 1, self.samples), np.uint16)
        full = np.flatnonzero(np.bincount(owner, minlength=len(first) - 1))
        begins = np.searchsorted(owner, full)
        if len(full):
            for k in range(0, self.samples, _SAMPLES_AT_ONCE):
                ranks = self._ranks(words[at], log_counts, self.seeds[k : k + _SAMPLES_AT_ONCE])
                least = np.minimum.reduceat(ranks[inverse], begins, axis=0)
                result[full, k : k + _SAMPLES_AT_ONCE] = (least & np.uint64(0xFFFF)).astype(np.uint16)
        return result

    def of_piece(self, piece: Piece) -> np.ndarray:
        starts, ends, first = piece.spans()
        return self.fingerprints(piece.hash_spans(starts, ends, fold_case=True), first)


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by as much of the beginning of the following one."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


def _fingerprint_run(sampler: Sampler, ids: list, texts: list[str], following: str) -> pa.RecordBatch:
    """Consecutive documents and the text after the last of them."""
    after = [*texts[1:], following]
    changed = [edited(a, b) for a, b in zip(texts, after)]
    both = pa.array([*texts, following, *changed], pa.large_string())
    found = np.concatenate([sampler.of_piece(piece) for piece in pieces(both)])
    n = len(texts)
    own, new = found[:n], found[n + 1 :]
    columns = [
        pa.array(ids, pa.int64()),
        pa.array([len(t) for t in texts], pa.int64()),
        [hashlib.sha256(t.encode("utf-8", "replace")).hexdigest() for t in changed],
        [row.astype("<u2").tobytes().hex() for row in own],
        [row.astype("<u2").tobytes().hex() for row in new],
        pa.array((own == new).mean(axis=1)),
        pa.array((own == found[1 : n + 1]).mean(axis=1)),
    ]
    names = [c.split()[0] for c in _OUTPUT.split(", ")]
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, pa.string()) for c in columns], names=names)


def _fingerprint_partitions(piece_chars: int = 1 << 19):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler, ids, texts, size, current = Sampler(), [], [], 0, None
        for batch in batches:
            ranges, tails, keys, column = (batch.column(k).to_pylist() for k in range(4))
            for number, tail, doc_id, text in zip(ranges, tails, keys, column):
                text = text or ""
                # The range of the rows before ends with a tail row, so `texts` is empty here.
                current = number if current is None else current
                if texts and (tail or size >= piece_chars):
                    yield _fingerprint_run(sampler, ids, texts, text)
                    ids, texts, size = [], [], 0
                if not tail:
                    ids.append(doc_id)
                    texts.append(text)
                    size += len(text)

    return run


def _in_ranges(docs: DataFrame, rows_per_range: int) -> DataFrame:
    """The documents with a range of about so many rows; ranges follow the order of key and h.

    The ranges are cut at quantiles of the key. A key with more rows than two ranges is cut at equal
    steps of h, so that masses of one id, or of none, are divided too. The driver holds a number per range.
    """
    ranges = max(1, math.ceil(docs.count() / rows_per_range))
    shares = [k / ranges for k in range(1, ranges)]
    number = F.col("key").cast("double")
    cuts = docs.select(number.alias("k")).approxQuantile("k", shares, max(0.25 / ranges, LEAST_ERROR)) if shares else []
    often = docs.groupBy("key").agg(F.count("*").alias("rows")).where(F.col("rows") > 2 * rows_per_range)
    hot = [(r["key"], math.ceil(r["rows"] / rows_per_range)) for r in often.collect()]  # fewer than there are ranges
    splits = [-math.inf, *(sorted({*cuts, *(float(key) for key, _ in hot)}) or [0.0]), math.inf]
    placed = Bucketizer(splits=splits, inputCol="k", outputCol="r").transform(docs.withColumn("k", number))
    if not hot:
        return placed.select(F.col("r").cast("long").alias("range"), "key", "h", "doc_id", "text")
    hot = {float(splits.index(float(key))): (key, steps) for key, steps in hot}
    hot = docs.sparkSession.createDataFrame([(r, *of) for r, of in hot.items()], "r double, hot long, steps long")
    placed = placed.join(F.broadcast(hot), "r", "left")
    # In the range of a hot key come lesser keys, its own steps, and greater ones.
    step = F.shiftright((F.shiftright("h", 33) + (1 << 30)) * F.col("steps"), 31)
    within = F.when(F.col("key") == F.col("hot"), step + 1).when(F.col("key") > F.col("hot"), F.col("steps") + 1).otherwise(0)
    return placed.select((F.col("r").cast("long") * (1 << 32) + within).alias("range"), "key", "h", "doc_id", "text")


def fingerprint_documents(docs: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, in the order of doc_id.

    Rows (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next), one per document row. The edit of a document takes from the next one in the order
    of doc_id, for which the documents are cut into ranges of ids; every range also gets the
    first document of the next range. Null texts are empty; null ids come last; equal ids are
    ordered by the xxHash64 of their texts and then by the texts. Texts without words have the
    fingerprint of zeros and are alike. Very long texts are sampled whole, one at a time. A single
    document is followed by itself, and an empty table gives no rows. Other columns are not read.
    """
    text = F.coalesce("text", F.lit(""))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("h"))
    small_batches(docs.sparkSession)
    numbered = _in_ranges(docs.withColumn("key", F.coalesce("doc_id", F.lit(_LAST_ID))), rows_per_range)
    # One row per range: its first id and hash. The first document of a range follows the last of the one before.
    first = {r["range"]: r["first"] for r in numbered.groupBy("range").agg(F.min(F.struct("key", "h")).alias("first")).collect()}
    filled = sorted(first)
    tails = [(*first[after], before) for before, after in zip(filled, [*filled[1:], *filled[:1]])]
    tails = docs.sparkSession.createDataFrame(tails, "key long, h long, before long")
    head = numbered.join(F.broadcast(tails), ["key", "h"]).groupBy("before").agg(F.min("key").alias("key"), F.min("h").alias("h"), F.min("text").alias("text"))
    head = head.select(F.col("before").alias("range"), F.lit(True).alias("tail"), F.lit(None).cast("long").alias("doc_id"), "text", "key", "h")
    rows = numbered.select("range", F.lit(False).alias("tail"), "doc_id", "text", "key", "h").unionByName(head)
    rows = rows.repartition(F.col("range")).sortWithinPartitions("range", "tail", "key", "h", "text")
    return rows.select("range", "tail", "doc_id", "text").mapInArrow(_fingerprint_partitions(), _OUTPUT)
