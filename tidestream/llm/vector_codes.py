"""Product-quantiser codes of vectors, with memoised grid cells.

A vector of integers is cut into equal parts; each part is replaced by the number of the nearest
entry of its position's codebook. Codebooks begin as the parts of the first vectors and are moved
to the means of their parts a few times.

To find the nearest entry, space is cut into a grid of cubes. The first part that falls into a cube
has the cube's candidates worked out: for every entry the least and the greatest distance to the
cube, and those entries stay whose least distance is not above the smallest greatest one. No other
entry can be the nearest to any point of the cube, not even by a tie. The candidates are kept by
the hash of the cube, so later parts there evaluate a few entries exactly instead of all.

Codebooks are bounded by their size and travel through the driver; vectors never do. The means
come from sums that every task adds up for itself, and are exact integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidestream.llm.words import mix
from tidestream.session import stored

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
MAX_CELLS = 200_000
COMPONENTS_AT_ONCE = 1 << 18


def usable(vector: Column) -> Column:
    """Whether a vector is there and all of its components are finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def integers(values: np.ndarray, length: int) -> np.ndarray:
    """floor(256 x) of every component, held within the range in which distances fit 64 bits."""
    most = int(2**29 / max(length, 1) ** 0.5)
    return np.clip(np.floor(values.astype(np.float64) * SCALE), -most, most).astype(np.int64)


class CellMemo:
    """The nearest of some entries for many points, remembering which entries a grid cell needs."""

    def __init__(self, entries: np.ndarray, max_cells: int = MAX_CELLS):
        self.entries, self.max_cells = entries, max_cells
        # Cubes about half as wide as the entries spread in the direction of most spread.
        self.width = 1 << int(np.log2(max(1.0, entries.std(axis=0).max() / 2)))
        self.evaluated = 0
        self._forget()

    def _forget(self) -> None:
        size, places = self.entries.shape
        self.keys, self.cells = np.zeros(0, np.uint64), np.zeros((0, places), np.int64)
        self.candidates = np.zeros((0, (size + 7) // 8), np.uint8)

    def _not_dominated(self, cells: np.ndarray) -> np.ndarray:
        """For every cell the entries that can be nearest to one of its points, as bits."""
        made = []
        step = max(1, COMPONENTS_AT_ONCE // self.entries.size)
        for at in range(0, len(cells), step):
            low = (cells[at : at + step] * self.width)[:, None, :] - self.entries[None]
            high = low + (self.width - 1)
            least = np.maximum(np.maximum(low, -high), 0)
            most = np.maximum(np.abs(low), np.abs(high))
            least, most = (least * least).sum(axis=2), (most * most).sum(axis=2)
            made.append(np.packbits(least <= most.min(axis=1, keepdims=True), axis=1))
        return np.concatenate(made)

    def _remember(self, keys: np.ndarray, cells: np.ndarray) -> None:
        if len(self.keys) + len(keys) > self.max_cells:
            self._forget()
        keys = np.concatenate([self.keys, keys])
        order = np.argsort(keys, kind="stable")
        self.candidates = np.concatenate([self.candidates, self._not_dominated(cells)])[order]
        self.cells, self.keys = np.concatenate([self.cells, cells])[order], keys[order]

    def _known(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys), bool)
        return self.keys[np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)] == keys

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of every point's nearest entry; of equally near ones the first."""
        if not len(points):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        cells = points // self.width
        hashes = np.zeros(len(points), np.uint64)
        for place in cells.T:
            hashes = mix(hashes * np.uint64(0x9E3779B97F4A7C15) + place.astype(np.uint64))
        keys, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        known = self._known(keys)
        if not known.all():
            if len(self.keys) + (~known).sum() > self.max_cells:
                known[:] = False  # the memo begins anew
            self._remember(keys[~known], cells[first[~known]])
        at = np.searchsorted(self.keys, keys)[inverse]
        bits = self.candidates[at]
        bits[(self.cells[at] != cells).any(axis=1)] = 255  # another cell has the same hash
        point, entry = np.nonzero(np.unpackbits(bits, axis=1, count=len(self.entries)))
        self.evaluated += len(point)
        apart = points[point] - self.entries[entry]
        distance = (apart * apart).sum(axis=1)
        begin = np.searchsorted(point, np.arange(len(points)))
        best = np.minimum.reduceat(distance, begin)
        hit = np.flatnonzero(distance == best[point])
        chosen = hit[np.searchsorted(point[hit], np.arange(len(points)))]
        return entry[chosen], best


def _pieces(batch: pa.RecordBatch, at: int, length: int) -> Iterator[tuple[slice, np.ndarray]]:
    """Some rows of a batch and their vectors as integers."""
    step = max(1, COMPONENTS_AT_ONCE // length)
    for begin in range(0, len(batch), step):
        rows = batch.column(at).slice(begin, step)
        yield slice(begin, begin + len(rows)), integers(rows.flatten().to_numpy(zero_copy_only=False), length).reshape(len(rows), length)


class Quantiser:
    """Codebooks by part position: an array of position x entry x place."""

    def __init__(self, codebooks: np.ndarray):
        self.codebooks = codebooks
        self.parts, self.size, self.width = codebooks.shape
        self.length = self.parts * self.width

    def memos(self) -> list[CellMemo]:
        return [CellMemo(entries) for entries in self.codebooks]

    def sums(self, vectors: DataFrame) -> DataFrame:
        """Rows (part, entry, place, total): sums of the parts nearest to each entry; place -1 counts them."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            memos = self.memos()
            totals = np.zeros((self.parts, self.size, self.width + 1), np.int64)
            for batch in batches:
                for _, rows in _pieces(batch, 0, self.length):
                    for part, memo in enumerate(memos):
                        points = rows[:, part * self.width : (part + 1) * self.width]
                        entry, _ = memo.nearest(points)
                        totals[part, :, 0] += np.bincount(entry, minlength=self.size)
                        for place in range(self.width):
                            # Sums of one piece are far below 2**53, so exact in doubles.
                            totals[part, :, place + 1] += np.bincount(entry, points[:, place], self.size).astype(np.int64)
            part, entry, place = np.nonzero(totals)
            columns = [part.astype(np.int32), entry.astype(np.int32), (place - 1).astype(np.int32), totals[part, entry, place]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["part", "entry", "place", "total"])

        partial = vectors.mapInArrow(run, "part int, entry int, place int, total long")
        return partial.groupBy("part", "entry", "place").agg(F.sum("total").alias("total"))

    def moved(self, vectors: DataFrame) -> Quantiser:
        """The codebooks with every entry at the mean of its parts, rounded down; unused entries stay."""
        totals = np.zeros((self.parts, self.size, self.width + 1), np.int64)
        # One number per component of the codebooks.
        for row in self.sums(vectors).collect():
            totals[row.part, row.entry, row.place + 1] = row.total
        counts = totals[:, :, :1]
        return Quantiser(np.where(counts > 0, totals[:, :, 1:] // np.maximum(counts, 1), self.codebooks))

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.codebooks.ravel().tolist())).encode()).hexdigest()

    def encoded(self, vectors: DataFrame) -> DataFrame:
        """The rows (vec_id, label, embedding) as (vec_id, label, code, error)."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            memos = self.memos()
            for batch in batches:
                for at, rows in _pieces(batch, 2, self.length):
                    found = [m.nearest(rows[:, k * self.width : (k + 1) * self.width]) for k, m in enumerate(memos)]
                    codes = np.stack([entry for entry, _ in found], axis=1).astype(np.uint8).tobytes().hex()
                    step = 2 * self.parts
                    columns = [
                        batch.column(0)[at],
                        batch.column(1)[at],
                        pa.array([codes[k : k + step] for k in range(0, len(codes), step)], pa.string()),
                        pa.array(sum(distance for _, distance in found)),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "code", "error"])

        label = vectors.schema["label"].dataType.simpleString()
        return vectors.mapInArrow(run, f"vec_id long, label {label}, code string, error long")


def fit_codebooks(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Quantiser | None]:
    """The usable vectors, and codebooks after some rounds of moving their entries to the means.

    The codebooks begin as the parts of the usable vectors with the smallest ids.
    """
    embedding = F.col("embedding").cast("array<double>")
    kept = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", embedding.alias("embedding"))
    fitting = (F.size("embedding") > 0) & (F.size("embedding") % parts == 0)
    kept = kept.where(fitting & usable(F.col("embedding")))
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).collect()
    if not first:
        return kept, None
    length = len(first[0].embedding)
    kept = kept.where(F.size("embedding") == length)
    if any(len(row.embedding) != length for row in first):
        first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).collect()
    start = integers(np.array([row.embedding for row in first]), length).reshape(len(first), parts, -1)
    model = Quantiser(np.ascontiguousarray(start.transpose(1, 0, 2)))
    for _ in range(rounds):
        model = model.moved(kept.select("embedding"))
    return kept, model


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """One row per usable vector: vec_id, label, code, error, label_error, codebooks_sha256.

    `vectors` has the columns vec_id, embedding (an array of floats) and label; others are not read.
    A vector that is null or holds a null or a component that is not finite is dropped, and so is
    one whose length is not that of the usable vector with the smallest id or cannot be cut into
    `parts` parts (an empty one too). Components become floor(256 x); those beyond 2**29 over the
    square root of the length are held there, so that distances stay within 64 bits. Long vectors
    are read in slices of 2**18 components. Of equally near entries the first counts. Vectors
    without id come last in the choice of the first entries and equal ids are ordered by their
    vectors; repeated rows each count and each give a row. With fewer vectors than entries the
    codebooks are smaller. An empty table, or one without usable vectors, gives no rows.
    `label_error` sums the errors of a label; null labels are one.
    """
    kept, model = fit_codebooks(vectors, parts, entries, rounds)
    columns = ("vec_id", "label", "code", "error", "label_error", "codebooks_sha256")
    if model is None:
        empty = kept.withColumns({"code": F.lit(""), "error": F.lit(0).cast("long"), "label_error": F.lit(0).cast("long"), "codebooks_sha256": F.lit("")})
        return empty.select(*columns).where("false")
    found = stored(model.encoded(kept), "vector-codes")
    by_label = found.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    joined = found.join(by_label, F.col("label").eqNullSafe(F.col("of")))
    return joined.withColumn("codebooks_sha256", F.lit(model.sha256())).select(*columns)
