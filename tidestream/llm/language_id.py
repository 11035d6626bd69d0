"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. The vector of three letters in a row is the
product of their vectors, rotated by two, one and no places; a text's vector is the sum over its
trigrams. A language's prototype is the sum of the unit vectors of its training texts, and a
text has the language whose prototype has the largest cosine with it.

Letters are case-folded; a-z have a vector each, all other letters of the world share 101 by
hash; runs of anything else are one boundary symbol.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidestream.llm.linear import held_out
from tidestream.llm.storage import small_batches
from tidestream.llm.words import Piece, pieces

PLACES = 1024
LETTERS = 128
UNKNOWN = "und"
SHARPNESS = 20.0
LAST_LETTER = 0x3FFFF  # planes beyond the third hold no letters
DENSE_TEXTS = 16  # trigrams of so many texts of a piece are added by matrix products
GRAMS_AT_ONCE = 2048
PAIRS_AT_ONCE = 512
MIN_LETTERS = 20
LENGTH_CLASSES = 8  # each of twice the letters of the one before it, from MIN_LETTERS on; the last is open
BOUND_QUANTILE = 0.01
NOISE = 5 / PLACES**0.5  # five standard deviations of the cosine of unrelated vectors


def letter_classes() -> np.ndarray:
    """The class of every code point: 0 for none, 1-26 for a-z, 27-127 for other letters."""
    classes = np.zeros(0x110000, np.uint8)
    for code in range(LAST_LETTER + 1):
        if unicodedata.category(chr(code))[0] == "L":
            low = ord(chr(code).lower()[0])
            classes[code] = low - 96 if 97 <= low <= 122 else 27 + low * 40503 % 101
    return classes


def letter_vectors() -> np.ndarray:
    return np.random.Generator(np.random.PCG64(20240101)).choice(np.array([-1, 1], np.int8), (LETTERS, PLACES))


class Profiler:
    """Turns texts into unit vectors."""

    def __init__(self):
        self.classes, letters = letter_classes(), letter_vectors()
        # The product of the first two rotated letters, for all pairs, and the third.
        self.first_two = np.roll(letters, 2, axis=1)[:, None] * np.roll(letters, 1, axis=1)[None]
        self.third = letters

    def _bound(self, grams: np.ndarray) -> np.ndarray:
        """The vectors of trigrams."""
        return self.first_two[grams // LETTERS**2, grams // LETTERS % LETTERS] * self.third[grams % LETTERS]

    def _bundled(self, grams: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
        """For every text the sum of the vectors of its trigrams; whole numbers, so exact in any order.

        Trigrams that many texts share are added by matrix products over blocks of trigrams, all
        others text by text. Either holds some megabytes, however many trigrams there are.
        """
        both, counts = np.unique(grams * texts + owner, return_counts=True)
        grams, owner = both // texts, both % texts
        starts = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]])) if len(grams) else np.zeros(0, np.int64)
        spread = np.diff(np.append(starts, len(grams)))
        number = np.repeat(np.cumsum(spread >= DENSE_TEXTS) - 1, spread)
        dense = np.repeat(spread >= DENSE_TEXTS, spread)
        sums = np.zeros((texts, PLACES), np.float32)
        shared = grams[starts[spread >= DENSE_TEXTS]]
        at, by, times = number[dense], owner[dense], counts[dense]
        for low in range(0, len(shared), GRAMS_AT_ONCE):
            block = slice(*np.searchsorted(at, [low, low + GRAMS_AT_ONCE]))
            width = min(GRAMS_AT_ONCE, len(shared) - low)
            table = np.zeros((texts, width), np.float32)
            table[by[block], at[block] - low] = times[block]
            sums += table @ self._bound(shared[low : low + width]).astype(np.float32)
        order = np.flatnonzero(~dense)
        order = order[np.argsort(owner[order], kind="stable")]
        for low in range(0, len(order), PAIRS_AT_ONCE):
            part = order[low : low + PAIRS_AT_ONCE]
            first = owner[part[0]]
            table = np.zeros((owner[part[-1]] - first + 1, len(part)), np.float32)
            table[owner[part] - first, np.arange(len(part))] = counts[part]
            sums[first : first + len(table)] += table @ self._bound(grams[part]).astype(np.float32)
        return sums

    def vectors(self, piece: Piece) -> tuple[np.ndarray, np.ndarray]:
        """A unit vector per text (0 for a text without letters), and how many letters it has."""
        texts = piece.texts()
        lengths = np.array([len(t) for t in texts])
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        classes, owner = self.classes[codes], np.repeat(np.arange(len(texts)), lengths)
        kept = np.ones(len(classes), bool)
        kept[1:] = (classes[1:] > 0) | (classes[:-1] > 0) | (owner[1:] != owner[:-1])
        classes, owner = classes[kept].astype(np.int64), owner[kept]
        letters = np.bincount(owner[classes > 0], minlength=len(texts))
        # A boundary on both sides of every text.
        ends = np.cumsum(np.bincount(owner, minlength=len(texts)))
        starts = np.concatenate([[0], ends[:-1]])
        sides = np.concatenate([starts, ends])
        owner = np.insert(owner, sides, np.tile(np.arange(len(texts)), 2))
        classes = np.insert(classes, sides, 0)
        order = np.argsort(owner, kind="stable") if np.any(np.diff(owner) < 0) else slice(None)
        classes, owner = classes[order], owner[order]
        whole = (owner[2:] == owner[:-2]) & (classes[1:-1] > 0)
        grams = (classes[:-2] * LETTERS + classes[1:-1]) * LETTERS + classes[2:]
        sums = self._bundled(grams[whole], owner[:-2][whole], len(texts))
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        return sums / np.maximum(norms, 1e-9), letters


@dataclass
class LanguageModel:
    languages: list[str]
    prototypes: np.ndarray


def _labelled(docs: DataFrame) -> DataFrame:
    """The documents to learn from: all that have an id and a language and are not held out."""
    return docs.select("doc_id", "lang", "text").where("lang is not null and doc_id is not null").where(~held_out(F.col("doc_id")))


def fit_languages(docs: DataFrame) -> LanguageModel:
    """Prototypes from the texts and languages of all documents that are not held out.

    Every task adds up its own documents and sends one vector per language. Rows without language
    or id teach nothing.
    """
    small_batches(docs.sparkSession)
    known = _labelled(docs)
    languages = sorted(r.lang for r in known.select("lang").distinct().collect())
    if not languages:
        return LanguageModel([], np.zeros((0, PLACES), np.float32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiler, sums = Profiler(), {}
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            for piece in pieces(batch.column(1)):
                vectors, _ = profiler.vectors(piece)
                for lang in set(langs[piece.rows]):
                    sums[lang] = sums.get(lang, 0) + vectors[langs[piece.rows] == lang].sum(axis=0, dtype=np.float64)
        rows = [(lang, place, value) for lang, total in sums.items() for place, value in enumerate(total)]
        if rows:
            kinds = [pa.string(), pa.int32(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["lang", "place", "value"])

    partial = known.select("lang", "text").mapInArrow(run, "lang string, place int, value double")
    prototypes = np.zeros((len(languages), PLACES))
    # One number per language and place. Rounding makes the sum independent of its order.
    for row in partial.groupBy("lang", "place").agg(F.sum(F.round("value", 6).cast("decimal(30,6)")).cast("double").alias("value")).collect():
        prototypes[languages.index(row.lang), row.place] = row.value
    prototypes /= np.maximum(np.linalg.norm(prototypes, axis=1, keepdims=True), 1e-9)
    return LanguageModel(languages, prototypes.astype(np.float32))


def predict(profiler: Profiler, model: LanguageModel, piece: Piece) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Language, score, largest cosine and number of letters of every text of a piece."""
    vectors, letters = profiler.vectors(piece)
    has_letters = letters > 0
    if not model.languages:
        return [UNKNOWN] * len(piece), np.zeros(len(piece)), np.zeros(len(piece)), letters
    cosines = (vectors @ model.prototypes.T).astype(np.float64)
    best = cosines.argmax(axis=1)
    shares = np.exp(SHARPNESS * (cosines - cosines.max(axis=1, keepdims=True)))
    score = np.where(has_letters, 1.0 / shares.sum(axis=1), 0.0)
    names = [model.languages[k] if known else UNKNOWN for k, known in zip(best, has_letters)]
    return names, score, np.where(has_letters, cosines.max(axis=1), 0.0), letters


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """One row per document row: doc_id, held_out, lang_pred, score, cosine.

    `score` is the share of the best language among all after exponentiation (0 to 1), `cosine`
    the likeness to its prototype. A null text or one without letters is `und` with score 0.
    Very long texts are profiled whole, one at a time. Of equally near prototypes the first language
    in alphabetical order is taken; if none could be learned every text is `und`. Null ids and
    repeated rows are answered like any other, and an empty table gives no rows. Only `doc_id` and
    `text` are read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiler = Profiler()
        for batch in batches:
            for piece in pieces(batch.column(1)):
                names, score, cosine, _ = predict(profiler, model, piece)
                columns = [batch.column(0)[piece.rows], pa.array(names, pa.string()), pa.array(score), pa.array(cosine)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score", "cosine"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = rows.mapInArrow(run, "doc_id long, lang_pred string, score double, cosine double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "cosine")


def length_class(letters: np.ndarray) -> np.ndarray:
    """The class of texts by their number of letters, -1 below MIN_LETTERS."""
    return np.searchsorted(MIN_LETTERS << np.arange(LENGTH_CLASSES), letters, "right") - 1


def fit_bounds(docs: DataFrame, model: LanguageModel) -> np.ndarray:
    """For every length class, the cosine below which a text is in none of the model's languages.

    The bound is what unrelated vectors do not reach by chance, or less if more than a hundredth
    of all labelled texts of that length, which are not held out, lie below it. The beginnings of
    longer texts count for the short classes; a class without texts has the bound of the one
    before it, and before the first class with texts the bound is 0.
    """
    small_batches(docs.sparkSession)
    cuts = [F.substring("text", 1, (MIN_LETTERS << k) * 7 // 4) for k in range(LENGTH_CLASSES - 1)]
    texts = _labelled(docs).select(F.explode(F.array_distinct(F.array(*cuts, F.col("text")))).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiler = Profiler()
        for batch in batches:
            for piece in pieces(batch.column(0)):
                _, _, cosine, letters = predict(profiler, model, piece)
                columns = [pa.array(length_class(letters).astype(np.int32)), pa.array(cosine)]
                yield pa.RecordBatch.from_arrays(columns, names=["class", "cosine"])

    cosines = texts.mapInArrow(run, "class int, cosine double").where("class >= 0")
    # The exact quantile, from how often each cosine of six digits occurs.
    counts = cosines.groupBy("class", F.round("cosine", 6).alias("cosine")).agg(F.count("*").alias("n"))
    low = counts.groupBy("class").agg(F.percentile("cosine", BOUND_QUANTILE, F.col("n")).alias("low")).collect()
    low, bounds = {r["class"]: r.low for r in low}, np.zeros(LENGTH_CLASSES)
    for k in range(LENGTH_CLASSES):
        bounds[k] = min(NOISE, low[k]) if k in low else bounds[max(k - 1, 0)]
    return bounds


def keep_known_languages(
    docs: DataFrame, model: LanguageModel, min_cosine: float = 0.02, min_letters: int = MIN_LETTERS, bounds: np.ndarray | None = None
) -> DataFrame:
    """The documents whose text is in one of the model's languages, with their own columns.

    Rejected are texts without letters, and texts of at least `min_letters` letters that are like
    no prototype: their cosine is below `min_cosine` or below the bound of their length class
    (`fit_bounds`). Shorter texts have too few trigrams to be told apart from any language and
    stay. If no language could be learned, all texts with letters stay. Null and empty texts go; a cosine
    of exactly the bound stays; very long texts are profiled whole. Repeated rows, null ids and any
    other columns pass through, and an empty table gives no rows.
    """
    names = [f.name for f in docs.schema.fields]
    at = names.index("text")
    least = np.maximum(min_cosine, np.zeros(LENGTH_CLASSES) if bounds is None else bounds)
    learned = bool(model.prototypes.any())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiler = Profiler()
        for batch in batches:
            for piece in pieces(batch.column(at)):
                _, _, cosine, letters = predict(profiler, model, piece)
                known = cosine >= least[np.maximum(length_class(letters), 0)]
                keep = (letters > 0) & (known | (letters < min_letters) | (not learned))
                yield batch.slice(piece.rows.start, len(piece)).filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
