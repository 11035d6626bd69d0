"""Words, n-grams and their hashes for a whole Arrow batch of texts at once.

Everything here works on the UTF-8 bytes of many texts together, so a task spends its time in
vectorised numpy code. A word is a maximal run without blanks (0x20, 0x09-0x0D). Batches are cut
into pieces of about a megabyte of text (or one longer text), which bounds the memory of a task
by the longest text, never by the size of a partition. Hashes have 64 bits and do not depend on
the batch a text arrives in.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 20

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_random = np.random.Generator(np.random.PCG64(20240101))
_FOLDED = np.arange(256, dtype=np.uint8)
_FOLDED[ord("A") : ord("Z") + 1] += 32
_STEP = np.uint64(0x9E3779B97F4A7C15)
_LOW_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_LANE_BYTES = 64
_GRAM = _random.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Piece:
    """A few consecutive texts of a batch: `rows` of it, their bytes and where each begins."""

    def __init__(self, rows: slice, data: np.ndarray, offsets: np.ndarray):
        self.rows, self.data, self.offsets = rows, data, offsets

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def spans(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begin and end of every word, and the index of the first word of every text."""
        return self.runs(~_BLANK[self.data])

    def runs(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Maximal runs of true bytes that do not cross texts."""
        begin, end = inside.copy(), inside.copy()
        begin[1:] &= ~inside[:-1]
        end[:-1] &= ~inside[1:]
        edges = self.offsets[(self.offsets > 0) & (self.offsets < len(self.data))]
        begin[edges] = inside[edges]
        end[edges - 1] = inside[edges - 1]
        starts = np.flatnonzero(begin)
        return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, self.offsets)

    def hash_spans(self, starts: np.ndarray, ends: np.ndarray, fold_case: bool = False) -> np.ndarray:
        """A 64-bit hash of the bytes of every span.

        Eight bytes at a time are mixed into the hash, for all spans at once, so no arithmetic
        pattern of bytes cancels out. Spans of more than 64 bytes are rare and get a BLAKE2 hash.
        """
        data = _FOLDED[self.data] if fold_case else self.data
        lanes = np.ndarray((len(data) + 1,), "<u8", np.concatenate([data, np.zeros(8, np.uint8)]).tobytes(), strides=(1,))
        left = ends - starts
        hashes = left.astype(np.uint64) * _STEP
        for done in range(0, _LANE_BYTES, 8):
            at = np.flatnonzero(left > done) if done else slice(None)
            lane = lanes[starts[at] + done] & _LOW_BYTES[np.minimum(left[at] - done, 8)]
            hashes[at] = mix((hashes[at] ^ lane) * _STEP)
        for k in np.flatnonzero(ends - starts > _LANE_BYTES):
            digest = hashlib.blake2b(data[starts[k] : ends[k]].tobytes(), digest_size=8).digest()
            hashes[k] = int.from_bytes(digest, "little")
        return hashes

    def texts(self) -> list[str]:
        raw = self.data.tobytes()
        at = self.offsets.tolist()
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip(at, at[1:])]


def pieces(column: pa.Array) -> Iterator[Piece]:
    """Cut a string column into pieces; null counts as empty."""
    column = pc.fill_null(column, "") if column.null_count else column
    if len(column) == 0:
        return
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        stop = int(np.searchsorted(offsets, offsets[at] + PIECE_BYTES, "right")) - 1
        stop = min(max(stop, at + 1), len(column))
        yield Piece(slice(at, stop), data[offsets[at] : offsets[stop]], offsets[at : stop + 1] - offsets[at])
        at = stop


def ngrams(words: np.ndarray, first: np.ndarray, size: int, whole_if_short: bool = False):
    """Hashes of all runs of `size` words of each text, and where each text begins among them.

    With `whole_if_short`, a text of fewer words gives one hash of its whole word sequence.
    """
    counts = np.diff(first)
    sums = words * _GRAM[0]
    for k in range(1, size):
        sums[:-k] += words[k:] * _GRAM[k]
    kept = np.arange(len(words)) + size <= np.repeat(first[1:], counts)
    made = np.maximum(counts - size + 1, 0)
    if whole_if_short:
        short = np.flatnonzero((counts > 0) & (counts < size))
        for text in short:
            a, b = first[text], first[text + 1]
            sums[a : a + 1] = (words[a:b] * _GRAM[: b - a]).sum(keepdims=True) + _GRAM[32 + b - a : 33 + b - a]
        kept[first[short]] = True
        made[short] = 1
    return mix(sums[kept]), np.concatenate([[0], np.cumsum(made)])


def distinct(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct values of each text."""
    values = values.copy()
    at = first.tolist()
    for a, b in zip(at, at[1:]):
        values[a:b].sort()
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    new[first[:-1][first[:-1] < len(values)]] = True
    upto = np.concatenate([[0], np.cumsum(new)])
    return values[new], upto[first]


def sums_by_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of the values of each text (0 if it has none), modulo 2**64 for hashes."""
    upto = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values, dtype=values.dtype)])
    return upto[first[1:]] - upto[first[:-1]]


def shingle_sets(piece: Piece, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct word shingles of each text, A-Z lower-cased; a shorter text is one shingle."""
    starts, ends, first = piece.spans()
    words = piece.hash_spans(starts, ends, fold_case=True)
    return distinct(*ngrams(words, first, size, whole_if_short=True))
