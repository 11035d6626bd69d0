"""Removal of boilerplate lines: lines that appear on many different sites.

The number of sites of a line is estimated by HyperLogLog sketches, one per line hash. Partial
sketches are merged by the aggregation itself, so a line found in a third of all documents
arrives as one small sketch per task. Lines whose estimate is too near the threshold for the
sketch's error are counted exactly. The decision about a line depends on nothing but its text,
so the result does not depend on order or partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidestream.llm.storage import packed
from tidestream.session import stored

MIN_SITES = 10
MIN_WORDS = 1
LOG_SKETCH_SIZE = 12
MARGIN = 0.05  # three standard errors of a sketch with 2**12 registers

_BLANKS = " \t\r\x0b\x0c"


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _key(line: Column, min_words: int) -> Column:
    """The hash of a line without outer blanks; null for blank lines and those of too few words."""
    bare = F.btrim(line, F.lit(_BLANKS))
    long_enough = bare.rlike(r"^\S+" + r"[\x20\x09-\x0D]+\S+" * (min_words - 1))
    return F.when(long_enough, F.xxhash64(bare))


def boilerplate_lines(docs: DataFrame, min_sites: int = MIN_SITES, min_words: int = MIN_WORDS) -> DataFrame:
    """Hashes of the lines found on at least `min_sites` different sources, as rows (key).

    A null source counts as one site. With `min_words` 1 every line that is not blank counts.
    """
    site = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("none"))
    lines = docs.select(site.alias("site"), F.explode(_lines(F.col("text"))).alias("line"))
    lines = lines.select("site", _key(F.col("line"), min_words).alias("key")).where("key is not null")
    sketches = lines.groupBy("key").agg(F.hll_sketch_agg("site", F.lit(LOG_SKETCH_SIZE)).alias("sketch"))
    spread = sketches.select("key", F.hll_sketch_estimate("sketch").alias("sites"))
    wide = stored(spread.where(F.col("sites") >= min_sites * (1 - MARGIN)), "line-spread")
    near = wide.where(F.col("sites") <= min_sites * (1 + MARGIN)).select("key")
    exact = lines.join(near, "key").groupBy("key").agg(F.count_distinct("site").alias("sites"))
    sure = wide.where(F.col("sites") > min_sites * (1 + MARGIN)).select("key")
    return stored(sure.union(exact.where(F.col("sites") >= min_sites).select("key")), "line-boilerplate")


def _without(lines: Column, gone: Column) -> Column:
    """The lines outside the sorted positions `gone`, joined again, in one pass over the lines."""
    before = F.concat(F.array(F.lit(-1)), gone)
    after = F.concat(gone, F.array(F.size(lines)))
    runs = F.zip_with(before, after, lambda a, b: F.array_append(F.array_repeat(F.lit(True), b - a - 1), F.lit(False)))
    kept = F.zip_with(lines, F.flatten(runs), lambda line, keep: F.when(keep, line))
    return F.array_join(kept, "\n")


def clean_texts(docs: DataFrame, min_sites: int = MIN_SITES, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per row of `docs`: document (all of its columns), text, lines, removed.

    `text` is without boilerplate lines, `lines` is the number of lines of the text and `removed`
    how many went. Lines are what lies between line feeds, compared without outer blanks; blank
    lines and those of fewer than `min_words` words always stay. A text without boilerplate is
    unchanged, a null text stays null with no line, and a text of boilerplate alone becomes empty.
    Very long texts are cleaned whole. A line on exactly `min_sites` sites goes. Rows with the same
    text, null ids and repeated rows all keep their row, and an empty table gives none. Only `text`
    and `source` are read.
    """
    boilerplate = boilerplate_lines(docs, min_sites, min_words)
    text = F.col("document.text")
    keyed = packed(docs).withColumn("t", F.md5(text.cast("binary")))
    lines = docs.select(F.md5(F.col("text").cast("binary")).alias("t"), F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
    hits = lines.select("t", "pos", _key(F.col("line"), min_words).alias("key")).join(boilerplate, "key")
    gone = hits.groupBy("t").agg(F.sort_array(F.collect_set("pos")).alias("gone"))
    marked = keyed.join(gone, "t", "left")
    return marked.select(
        "document",
        F.when(F.col("gone").isNull(), text).otherwise(_without(_lines(text), F.col("gone"))).alias("text"),
        F.when(text.isNull(), 0).otherwise(F.size(_lines(text))).cast("long").alias("lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("removed"),
    )


def remove_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, min_words: int = MIN_WORDS) -> DataFrame:
    """All rows of `docs` with boilerplate lines removed from `text`, as `clean_texts` does.

    Columns and their order are those of `docs`; all but `text` pass through, whatever their names.
    """
    cleaned = clean_texts(docs, min_sites, min_words)
    columns = [F.col("text") if c == "text" else F.col(f"document.`{c}`").alias(c) for c in docs.columns]
    return cleaned.select(*columns)
