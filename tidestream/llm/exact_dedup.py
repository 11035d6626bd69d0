"""Exact de-duplication of texts with a two-pass Bloom filter; built-in functions only.

The first pass sets the cells of every text hash in a filter and keeps the cells that were set
more than once. In the second pass a row whose cells are not all among them is certainly unique
and goes straight to the result. Only the others are shuffled by hash to find their group.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidestream.session import stored

FILTER_BITS_PER_ROW = 16
MAX_FILTER_BITS = 1 << 29
SECTIONS = 2


def normalised(text: Column) -> Column:
    """The text with every run of blanks replaced by one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _cell(section: int, bits: int) -> Column:
    """A row's cell in one section of the filter, counted from 1."""
    per_section = bits // SECTIONS
    return F.pmod(F.xxhash64("text_sha256", F.lit(section)), F.lit(per_section)) + F.lit(1 + section * per_section)


def filter_bits(rows: int, most: int = MAX_FILTER_BITS) -> int:
    """Size of a filter for so many rows, a power of two, never more than `most`."""
    return min(most, max(1 << 16, 1 << (FILTER_BITS_PER_ROW * max(1, rows) - 1).bit_length()))


def bitmaps(cells: DataFrame) -> DataFrame:
    """A column `cell` of numbers from 1 on as bitmaps of 4 KB: (bucket, cells)."""
    return cells.groupBy(F.bitmap_bucket_number("cell").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("cells")
    )


def bit_is_set(bitmap: str, cell: Column) -> Column:
    """Whether the bitmap of the cell's bucket has its bit; false without a bitmap."""
    position = F.bitmap_bit_position(cell)
    byte = F.substring(F.col(bitmap), F.floor(position / 8).cast("int") + 1, F.lit(1))
    return F.coalesce(F.getbit(F.conv(F.hex(byte), 16, 10).cast("long"), (position % 8).cast("int")) == 1, F.lit(False))


def repeated_cells(rows: DataFrame, bits: int) -> DataFrame:
    """Bitmaps of the cells set by more than one row."""
    cells = rows.select(F.explode(F.array(*[_cell(s, bits) for s in range(SECTIONS)])).alias("cell"))
    return bitmaps(cells.groupBy("cell").agg(F.count("*").alias("times")).where("times > 1"))


def exact_groups(docs: DataFrame, max_filter_bits: int = MAX_FILTER_BITS) -> DataFrame:
    """One row per document row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if they are after replacing runs of blanks by one space. Of equal texts the
    row with the smallest doc_id stays (rows without doc_id come last, and of repeated rows with
    the same doc_id one stays). Null text is empty text, and all empty texts are one group. Very long
    texts are hashed whole, and an empty table gives no rows. Other columns are not read.

    The filter takes 16 bits per row. Where that is more than `max_filter_bits` (64 MB), the space of
    hashes is cut into slices that each have a filter of their own and are gone through one after the
    other, each reading its own rows only. So what is broadcast is bounded and no filter is over-full.
    """
    rows = docs.select(F.col("doc_id"), F.sha2(normalised(F.col("text")).cast("binary"), 256).alias("text_sha256"))
    slices = max(1, math.ceil(docs.count() * FILTER_BITS_PER_ROW / max_filter_bits))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    if slices == 1:
        return _groups(stored(rows, "exact-hashes"), max_filter_bits)
    rows = stored(rows.withColumn("slice", F.pmod(F.xxhash64("text_sha256", F.lit("slice")), F.lit(slices)).cast("int")), "exact-hashes", by=("slice",))
    found = [stored(_groups(rows.where(F.col("slice") == s).drop("slice"), max_filter_bits), "exact-slice") for s in range(slices)]
    return docs.sparkSession.read.schema(found[0].schema).parquet(*[frame.stored_at for frame in found])


def _groups(rows: DataFrame, max_filter_bits: int) -> DataFrame:
    """The result of `exact_groups` for hashed rows (doc_id, text_sha256, row), by one filter."""
    bits = filter_bits(rows.count(), max_filter_bits)
    repeated = stored(repeated_cells(rows, bits), "exact-filter")
    probed = rows
    for s in range(SECTIONS):
        section = repeated.select(F.col("bucket").alias(f"bucket{s}"), F.col("cells").alias(f"cells{s}"))
        probed = probed.join(F.broadcast(section), F.bitmap_bucket_number(_cell(s, bits)) == F.col(f"bucket{s}"), "left")
    probed = probed.select(
        *rows.columns,
        F.array_min(F.array(*[bit_is_set(f"cells{s}", _cell(s, bits)) for s in range(SECTIONS)])).alias("maybe"),
    )
    maybe = probed.where("maybe").select(*rows.columns)
    groups = maybe.groupBy("text_sha256").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")).alias("first"), F.count("*").alias("group_size")
    )
    grouped = maybe.join(groups, "text_sha256").select(
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"),
        "text_sha256",
    )
    unique = probed.where("not maybe").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256"
    )
    return unique.union(grouped)
