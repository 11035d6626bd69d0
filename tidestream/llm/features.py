"""Sparse hashed features of texts, shared by the linear models of this package."""

from __future__ import annotations

import numpy as np

from tidestream.llm.words import Piece, _BLANK, distinct, ngrams, sums_by_text

DIMENSIONS = 1 << 18

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[c for c in range(0x21, 0x7F) if not chr(c).isalnum()]] = True


def _index(hashes: np.ndarray) -> np.ndarray:
    """Feature numbers from 1 on; 0 is the constant feature."""
    return (hashes % np.uint64(DIMENSIONS - 1)).astype(np.int64) + 1


def word_and_symbol_spans(piece: Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of symbols and runs of other characters without blanks, each a word of its own."""
    blank, symbol = _BLANK[piece.data], _SYMBOL[piece.data]
    words, marks = piece.runs(~blank & ~symbol), piece.runs(symbol)
    starts, ends = np.concatenate([words[0], marks[0]]), np.concatenate([words[1], marks[1]])
    order = np.argsort(starts, kind="stable")
    return starts[order], ends[order], words[2] + marks[2]


def _merged(parts: list[tuple[np.ndarray, np.ndarray]], texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Several lists of values per text as one list per text."""
    owner = np.concatenate([np.repeat(np.arange(texts), np.diff(first)) for _, first in parts])
    order = np.argsort(owner, kind="stable")
    first = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=texts))]) if texts else np.zeros(1, np.int64)
    return np.concatenate([values for values, _ in parts])[order], first.astype(np.int64)


def word_ngram_features(piece: Piece) -> tuple[np.ndarray, np.ndarray]:
    """The distinct words and pairs of words of each text, symbols apart, case kept."""
    starts, ends, first = word_and_symbol_spans(piece)
    words = piece.hash_spans(starts, ends)
    values, first = _merged([(words, first), ngrams(words, first, 2)], len(piece))
    return distinct(_index(values), first)


def word_and_prefix_features(piece: Piece, prefixes=(5, 6, 7, 8)) -> tuple[np.ndarray, np.ndarray]:
    """The distinct words of each text and their beginnings of some lengths in bytes, A-Z folded."""
    starts, ends, first = piece.runs(~_BLANK[piece.data] & ~_SYMBOL[piece.data])
    parts = [(piece.hash_spans(starts, ends, fold_case=True), first)]
    for k in prefixes:
        long_enough = ends - starts > k
        upto = np.concatenate([[0], np.cumsum(long_enough)])
        salted = piece.hash_spans(starts[long_enough], starts[long_enough] + k, fold_case=True) ^ np.uint64(k)
        parts.append((salted, upto[first]))
    values, first = _merged(parts, len(piece))
    return distinct(_index(values), first)


def dot(weights: np.ndarray, features: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sparse dot product of each text's features with the weights."""
    return sums_by_text(weights[features].astype(np.float64), first)
