"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A fingerprint has 64 bits; a bit is 1 if it is 1 in more than half of the hashes of a text's
three-word shingles. Two fingerprints link when they differ in at most three bits.

Instead of comparing fingerprints, each one emits its variants within half the radius, and two
that link meet at a variant. Half of three is one flipped bit on one side and two on the other:

* every fingerprint emits itself and its 64 variants with one flipped bit; so pairs that differ in
  one or two bits meet;
* three differing bits lie at least twice in the same half of the fingerprint, and the two
  fingerprints differ in parity. Those with an even number of bits emit the 496 variants with two
  flips in the low half, those with an odd number the 496 with two flips in the high half. Either
  way one side reaches the other's variant with one flip.

Variants are shuffled by the half that the two flips leave alone: all variants that share it
travel as one row and unfold after the shuffle, so a fingerprint costs about 50 narrow rows instead
of 561. Fingerprints that are alone in their half are dropped before they unfold.

At most 2,081 fingerprints reach a variant, whatever the data. One of them with at most one
flip links for certain with every other (one plus two bits), so a variant gives a star of links and
never all pairs. A variant reached by two flips only proves nothing that another does not.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidestream.llm.storage import components, join_hot, small_batches
from tidestream.llm.words import _BLANK, _FOLDED, Piece, pieces
from tidestream.session import stored

SHINGLE_WORDS = 3
SEED = 42
RADIUS = 3
HALF = 32
ROWS_PER_PARTITION = 4_000

# The eight bits of a byte as eight bytes of a number, lowest bit first.
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view("<u8").ravel()
_LANE_ROWS = 255  # so many bits add up in a byte


def shingle_spans(piece: Piece, size: int = SHINGLE_WORDS) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The words of a piece with single blanks between them, and begin and end of every shingle.

    A-Z are lower-cased. A text of fewer words is one shingle. The last array tells where the
    shingles of each text begin.
    """
    starts, ends, first = piece.spans()
    blank = _BLANK[piece.data]
    kept = ~blank
    kept[1:] |= blank[1:] & ~blank[:-1]
    kept[ends[ends < len(kept)]] = True
    place = np.cumsum(kept) - 1
    text = np.where(blank, np.uint8(0x20), _FOLDED[piece.data])[kept].tobytes()
    lengths = ends - starts
    starts = place[starts] if len(starts) else starts
    words = np.diff(first)
    made = np.where(words > 0, np.maximum(words - size + 1, 1), 0)
    upto = np.concatenate([[0], np.cumsum(made)])
    begin = np.repeat(first[:-1], made) + np.arange(upto[-1]) - np.repeat(upto[:-1], made)
    last = begin + np.repeat(np.minimum(words, size) - 1, made)
    return text, starts[begin], starts[last] + lengths[last], upto


def fingerprints(piece: Piece) -> np.ndarray:
    """The fingerprint of every text of a piece; 0 for a text without words."""
    text, starts, ends, first = shingle_spans(piece)
    result = np.zeros(len(piece), np.uint64)
    if not len(starts):
        return result
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(text[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist())), np.uint64, len(starts))
    # Bits are counted in bytes over runs of at most 255 hashes of a text, then by text.
    counts = np.diff(first)
    runs = -(-counts // _LANE_ROWS)
    upto = np.concatenate([[0], np.cumsum(runs)])
    begins = np.repeat(first[:-1], runs) + (np.arange(upto[-1]) - np.repeat(upto[:-1], runs)) * _LANE_ROWS
    lanes = np.add.reduceat(_SPREAD[hashes.view(np.uint8).reshape(-1, 8)], begins, axis=0)
    bits = lanes.view(np.uint8).reshape(-1, 64).astype(np.int64)
    full = np.flatnonzero(counts)
    ones = np.add.reduceat(bits, upto[full], axis=0)
    result[full] = np.packbits(2 * ones > counts[full][:, None], axis=1, bitorder="little").view("<u8").ravel()
    return result


def simhash(docs: DataFrame) -> DataFrame:
    """One row per document row: doc_id, fingerprint (a long with the 64 bits)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch.column(1)):
                found = pa.array(fingerprints(piece).view(np.int64))
                yield pa.RecordBatch.from_arrays([batch.column(0)[piece.rows], found], names=["doc_id", "fingerprint"])

    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return rows.mapInArrow(run, "doc_id long, fingerprint long")


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def _literals(masks: list[int]) -> Column:
    return F.array(*[F.lit(_signed(m)).cast("long") for m in masks])


def _singles(half: int) -> list[int]:
    return [1 << k for k in range(HALF * half, HALF * (half + 1))]


def _doubles(half: int) -> list[int]:
    singles = _singles(half)
    return [a | b for k, a in enumerate(singles) for b in singles[:k]]


def _half(value: Column, half: int) -> Column:
    """The low (0) or high (1) half of a fingerprint."""
    return F.shiftrightunsigned(value, HALF) if half else value.bitwiseAND(F.lit((1 << HALF) - 1))


def hamming(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _travelling(prints: DataFrame, radius: int) -> DataFrame:
    """Rows (half, key, flip, fingerprint): what a fingerprint sends to a key, a half of some of its variants.

    `flip` 0 stands for all variants that have the fingerprint's own half as it is; any other is the
    variant with that one bit flipped in the half.
    """
    even = F.bit_count("fingerprint") % 2 == 0
    sent = []
    for half in (1, 0):
        flips = _literals([0, *_singles(half)])
        if half == 0:
            # By the low half: only three bits with two of them in the high half.
            flips = F.when(even, flips).otherwise(_literals([0]))
        rows = prints.select("fingerprint", F.explode(flips).alias("flip"))
        key = _half(F.col("fingerprint").bitwiseXOR(F.col("flip")), half)
        sent.append(rows.select(F.lit(half).alias("half"), key.alias("key"), "flip", "fingerprint"))
    return sent[0].union(sent[1]) if radius == 3 else sent[0]


def _unfolded(rows: DataFrame, radius: int) -> DataFrame:
    """Rows (variant, half, key, fingerprint) of all variants that the travelling rows stand for."""
    even = F.bit_count("fingerprint") % 2 == 0
    own = F.col("flip") == 0
    high, low = F.col("half") == 1, F.col("half") == 0
    near = _literals([0, *_singles(0)])
    masks = F.when(~own, F.array("flip"))
    if radius >= 3:
        masks = masks.when(high & even, _literals([0, *_singles(0), *_doubles(0)])).when(high, near)
        masks = masks.when(low & even, _literals(_singles(1))).otherwise(_literals(_doubles(1)))
    else:
        masks = masks.otherwise(near)
    variants = rows.select("half", "key", "fingerprint", F.explode(masks).alias("mask"))
    return variants.select(F.col("fingerprint").bitwiseXOR(F.col("mask")).alias("variant"), "half", "key", "fingerprint")


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column `fingerprint`) that differ in 1 to `radius` bits.

    Two fingerprints within the radius are joined by an edge or by two that share a hub; every
    edge is within the radius. The radius is 1 to 3.
    """
    if not 1 <= radius <= 3:
        raise ValueError("the radius is 1 to 3")
    spark = prints.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(prints.count() / ROWS_PER_PARTITION))
    sent = _travelling(prints, radius).repartition(parts, "half", "key")
    same_key = Window.partitionBy("half", "key")
    met = sent.withColumns({"least": F.min("fingerprint").over(same_key), "most": F.max("fingerprint").over(same_key)})
    met = met.where("least < most").drop("least", "most")
    flips = F.bit_count(F.col("variant").bitwiseXOR(F.col("fingerprint")))
    at_variant = Window.partitionBy("variant", "half", "key").orderBy(flips, "fingerprint")
    stars = _unfolded(met, radius).withColumns({"hub": F.first("fingerprint").over(at_variant)})
    reached = F.bit_count(F.col("variant").bitwiseXOR(F.col("hub"))) <= 1
    found = stars.where(reached & (F.col("hub") != F.col("fingerprint")) & (hamming("hub", "fingerprint") <= radius))
    return found.select(F.least("hub", "fingerprint").alias("a"), F.greatest("hub", "fingerprint").alias("b")).distinct()


def simhash_components(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One row per document row: doc_id, fingerprint (long), component_id (its smallest reachable doc_id).

    Documents are linked when their fingerprints differ in at most `radius` bits. Null and empty
    texts and those without words have the fingerprint 0 and link like any other; very short texts
    are one shingle; very long texts are read whole, a megabyte of text being held at a time or one
    longer text. Repeated rows each give a row. A null doc_id is never the smallest; a component
    without any id has a null one. Of equal fingerprints none comes before another: only ids decide. An
    empty table gives no rows. Columns other than `doc_id` and `text` are not read.
    """
    rows = stored(simhash(docs), "simhash-documents")
    prints = rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
    prints = stored(prints, "simhash-fingerprints")
    roots = components(links(prints.select("fingerprint"), radius), "simhash-components")
    named = prints.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
    named = named.withColumn("root", F.coalesce("root", "fingerprint"))
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    lookup = stored(named.join(smallest, "root").select("fingerprint", "n", "component_id"), "simhash-named")
    return join_hot(rows, lookup, "fingerprint", "n").select("doc_id", "fingerprint", "component_id")
