"""Best-fit packing of tokenised documents into sequences of fixed length, by best-two-fit.

Token counts are small integers, so all that packing needs is how many pieces there are of each
length: a histogram of at most `capacity` numbers, whatever the size of the corpus. From it a
list of sequence patterns (which lengths, how often) is computed on the driver: fill a sequence
greedily with the longest piece that fits, then, if there is a gap, replace the shortest piece
by two unpacked ones that fill the gap more tightly. The pieces then find their places by their
rank among the pieces of their length, which is counted in blocks. Pieces of full length are
sequences by themselves and need no rank.
"""

from __future__ import annotations

import base64
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidestream.llm.storage import small_batches
from tidestream.llm.words import pieces
from tidestream.session import stored

CAPACITY = 1024
END_ID = 2
BLOCK_ROWS = 50_000
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class Encoder:
    """The ids that the `tokenizers` library gives for a byte-level BPE file, made by a faster one.

    `tiktoken` runs the same merges about four times as fast. Both give the same ids (tested),
    except that a special token written out in a text is one id for `tokenizers`; texts that hold
    one are given to that library.
    """

    def __init__(self, tokenizer_path: str, ranks_path: str, pattern: str):
        import tiktoken

        with open(ranks_path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.fast = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.path, self.slow = tokenizer_path, None

    def encode(self, text: str) -> np.ndarray:
        if "<|" in text:
            if self.slow is None:
                from tokenizers import Tokenizer

                self.slow = Tokenizer.from_file(self.path)
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.asarray(self.fast.encode_to_numpy(text), np.uint32)


def cut(length: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """Start and length of a document's pieces: whole ones at the end, the rest first."""
    rest = length % capacity
    starts = [*([0] if rest else []), *range(rest, length, capacity)]
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], length])]


def _tokenise(tokenizer: tuple[str, str, str], capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(*tokenizer)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for texts in pieces(batch.column(1)):
                rows = []
                for doc_id, text in zip(ids[texts.rows], texts.texts()):
                    tokens = np.append(encoder.encode(text), np.uint32(END_ID)).astype("<u4")
                    for k, (a, n) in enumerate(cut(len(tokens), capacity)):
                        rows.append((doc_id, k, a, n, zlib.crc32(tokens[a : a + n].tobytes())))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _PIECES.split(", ")])

    return run


def two_fit_patterns(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Sequences for a histogram of lengths: (lengths in order, how many such sequences)."""
    left = np.zeros(capacity + 1, np.int64)
    for length, count in counts.items():
        left[length] = count
    patterns = []
    while left.any():
        free, chosen, gap = left.copy(), [], capacity
        while gap and (fits := np.flatnonzero(free[: gap + 1])).size:
            size = int(fits[-1])
            take = min(gap // size, int(free[size]))
            chosen += [size] * take
            free[size] -= take
            gap -= size * take
        if gap and (pair := _best_pair(free, chosen[-1], gap + chosen[-1])):
            chosen[-1:] = pair
        needs = Counter(chosen)
        times = min(int(left[size]) // need for size, need in needs.items())
        for size, need in needs.items():
            left[size] -= need * times
        patterns.append((chosen, times))
    return patterns


def _best_pair(free: np.ndarray, smallest: int, room: int) -> list[int] | None:
    """Two free lengths whose sum is above `smallest` and as near to `room` as possible."""
    for total in range(room, smallest, -1):
        larger = np.arange((total + 1) // 2, total)
        right = (free[larger] > 0) & (free[total - larger] > 0)
        if total % 2 == 0 and right.size and free[total // 2] < 2:
            right[0] = False
        if right.any():
            best = int(larger[np.flatnonzero(right)[-1]])
            return [best, total - best]
    return None


def pack(docs: DataFrame, tokenizer: tuple[str, str, str], capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its token ids and the end id; a null or empty text is the end id alone.
    `tokenizer` holds the path of a `tokenizers` file, the path of the same vocabulary as ranks,
    and the pattern that splits a text before merging. Very long texts are tokenised whole and cut into
    pieces. A null doc_id stays null, repeated rows are packed as separate documents, pieces of the same
    length are interchangeable, and an empty table gives no rows. Only `doc_id` and `text` are read.
    """
    small_batches(docs.sparkSession)
    tokenised = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_tokenise(tokenizer, capacity), _PIECES)
    rows = stored(tokenised.withColumn("row", F.monotonically_increasing_id()), "packing-pieces")
    full = rows.where(F.col("length") == capacity)
    full = full.select(*rows.columns, (2 * F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))

    part = rows.where(F.col("length") < capacity)
    blocks = max(1, -(-rows.count() // BLOCK_ROWS))
    part = part.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
    counted = part.groupBy("length", "block").agg(F.count("*").alias("n"))
    # At most `capacity` rows, however many documents there are.
    histogram = {r.length: r.n for r in counted.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places, used, sequence = [], Counter(), 0
    for lengths, times in two_fit_patterns(histogram, capacity):
        at = 0
        for size in lengths:
            places.append((size, used[size], used[size] + times, sequence, at))
            used[size] += times
            at += size
        sequence += times
    places = docs.sparkSession.createDataFrame(places, "size long, low long, high long, base long, offset long")
    earlier = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = counted.select("length", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = part.join(before, ["length", "block"]).withColumn(
        "rank", F.col("before") + F.row_number().over(Window.partitionBy("length", "block").orderBy("row")) - 1
    )
    # The table of places has a few rows per length, at most some thousands in all.
    right = (F.col("length") == F.col("size")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    placed = ranked.join(F.broadcast(places), right)
    placed = placed.select(*rows.columns, (2 * (F.col("base") + F.col("rank") - F.col("low")) + 1).alias("sequence_id"), "offset")
    return full.union(placed).drop("row")
