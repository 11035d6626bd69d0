"""A mix of documents in which every source has its target share, by pivotal dependent rounding.

All documents of a source have the same expected number of copies, target over size. Its whole
part is taken by every document; the fractions are rounded dependently: two documents pass words
to each other until the fraction of one is 0 or 1, in such a way that the expected words taken
stay the same to the word and every document keeps its chance. A block of documents leaves one
document with a fraction. The leftovers of 64 blocks form a block of the next level, and so on:
a reduction tree with one leftover document per source at the top. So what a source takes differs
from its target by less than one document. All chances come from hashes, so reruns agree.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidestream.llm.storage import packed, running
from tidestream.llm.words import mix
from tidestream.session import stored

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
BLOCK_DOCUMENTS = 4096
FAN_IN = 64
SEED = 20240101

_STEP = "row long, source_id long, block long, size long, key long, chance double"


def word_count(text: str = "text"):
    """Words of a text, runs without blanks; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """Rows (source, source_id, source_size, documents, target), one per source.

    Targets share the sum of all sizes by weight. A source above `most` times its size stops
    there and the others share the excess, until none is above: the common level is found by
    going through the sources in the order in which they reach their stop. Sources may be as many
    as web hosts: both orders are gone through in ranges.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("documents"))
    sources = running(sources.withColumn("one", F.lit(1)), [F.col("source").asc_nulls_last()], {"source_id": "one"}, "mixing-sources")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("source_id") % len(weights) + 1).cast("int"))
    stop = F.col("source_size") * F.lit(float(most))
    sources = sources.withColumns({"weight": weight, "stop": stop}).withColumn("reach", F.col("stop") / F.col("weight"))
    levels = running(sources.drop("one"), [F.col("reach"), F.col("source_id")], {"below": "stop", "weight_below": "weight"}, "mixing-stops")
    total, all_weights = levels.agg(F.sum("source_size"), F.sum("weight")).first()
    if total is None:
        return levels.select("source", "source_id", "source_size", "documents", F.lit(0.0).alias("target"))
    level = (F.lit(float(total)) - F.col("below")) / (F.lit(all_weights) - F.col("weight_below"))
    common = levels.agg(F.min(F.when(F.col("reach") >= level, F.struct(F.col("reach"), level.alias("level"))))).first()[0]
    target = F.col("stop") if common is None else F.least(F.col("stop"), F.lit(common["level"]) * F.col("weight"))
    return levels.select("source", "source_id", "source_size", "documents", target.alias("target"))


def _uniform(keys: np.ndarray, level: int) -> np.ndarray:
    return (mix(keys.view(np.uint64) + np.uint64(SEED + 7919 * level)) >> np.uint64(11)).astype(np.float64) / 2.0**53


def pivotal(sizes: np.ndarray, chances: np.ndarray, uniform: np.ndarray) -> np.ndarray:
    """Round chances to 0 or 1, all but one at most, keeping the sum of size times chance."""
    size, chance, u = sizes.astype(float).tolist(), chances.tolist(), uniform.tolist()
    kept = None
    for j in range(len(size)):
        if not 0.0 < chance[j] < 1.0:
            continue
        if kept is None:
            kept = j
            continue
        i = kept
        up = min(size[i] * (1 - chance[i]), size[j] * chance[j])
        down = min(size[i] * chance[i], size[j] * (1 - chance[j]))
        if u[j] * (up + down) < down:
            full, other = size[i] * (1 - chance[i]) <= size[j] * chance[j], up
            chance[i], chance[j] = (1.0, chance[j] - other / size[j]) if full else (chance[i] + other / size[i], 0.0)
        else:
            empty, other = size[i] * chance[i] <= size[j] * (1 - chance[j]), down
            chance[i], chance[j] = (0.0, chance[j] + other / size[j]) if empty else (chance[i] - other / size[i], 1.0)
        kept = next((k for k in (i, j) if 1e-12 < chance[k] < 1 - 1e-12), None)
        for k in (i, j):
            if k != kept:
                chance[k] = float(round(chance[k]))
    return np.array(chance)


def _round_block(level: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("key", "ascending"), ("row", "ascending")])
        keys = table.column("key").to_numpy()
        chance = pivotal(table.column("size").to_numpy(), table.column("chance").to_numpy(), _uniform(keys, level))
        return table.set_column(table.schema.get_field_index("chance"), "chance", pa.array(chance))

    return run


def _spread(todo: DataFrame) -> DataFrame:
    """The rows with a key of their own where more rows share one than a block holds.

    Rows with the same key are alike in id, size and text, so it does not matter which of them is
    taken, but masses of them must not meet in one block. They are numbered 0, 1, ... in groups of
    about a block's size and the number joins the key, so the outcome does not depend on how the
    table is partitioned.
    """
    hot = stored(todo.groupBy("key").agg(F.count("*").alias("rows")).where(F.col("rows") > BLOCK_DOCUMENTS), "mixing-hot")
    most = hot.agg(F.max("rows")).first()[0]
    if most is None:
        return todo
    groups = math.ceil(most / BLOCK_DOCUMENTS)
    mine = todo.join(hot.select("key"), "key").withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups)))
    sizes = mine.groupBy("key", "group").agg(F.count("*").alias("rows"))
    before = F.sum("rows").over(Window.partitionBy("key").orderBy("group")) - F.col("rows")
    numbered = mine.join(sizes.select("key", "group", before.alias("before")), ["key", "group"])
    number = F.col("before") + F.row_number().over(Window.partitionBy("key", "group").orderBy("row"))
    renamed = numbered.withColumn("own", F.xxhash64("key", number)).drop("key").withColumnRenamed("own", "key")
    return todo.join(hot.select("key"), "key", "left_anti").unionByName(renamed.select(*todo.columns))


def mix_copies(docs: DataFrame, weights=WEIGHTS, most: int = MOST_COPIES, row: str | None = None) -> DataFrame:
    """How often the mix takes every document: (row, doc_id, size, source_size, target, copies).

    A null text has no words, a null source is a source of its own, the last. Documents without
    words take nothing and change no sum. Repeated rows and null ids count as documents. `row`
    names a column that numbers the rows; without it they are numbered here. Columns other than
    `doc_id`, `source`, `text` and that one are not read. Very long texts count whole. Rows with the
    same id, size and text are interchangeable, however many there are; nothing else ties. An empty
    table gives no rows.
    """
    number = F.col(row) if row else F.monotonically_increasing_id()
    sizes = stored(docs.select("doc_id", "source", word_count("text").alias("size"), F.xxhash64("text").alias("t"), number.alias("row")), "mixing-sizes")
    targets = stored(source_targets(sizes, weights, most), "mixing-targets")
    joined = sizes.join(targets.withColumnRenamed("source", "__source"), F.col("source").eqNullSafe(F.col("__source")))
    each = F.when(F.col("size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    joined = joined.select("row", "doc_id", "size", "t", "source_id", "source_size", "documents", "target", each.alias("each"))
    blocks = F.ceil(F.col("documents") / BLOCK_DOCUMENTS)
    fraction = F.col("each") - F.floor("each")
    todo = joined.select("row", "source_id", blocks.alias("blocks"), "size", F.xxhash64("doc_id", "size", "t").alias("key"), fraction.alias("chance"))
    todo = _spread(todo.where("chance > 0 and chance < 1"))
    block = F.pmod(F.xxhash64("key"), F.col("blocks"))
    todo = todo.select("row", "source_id", block.alias("block"), "size", "key", "chance")
    most_blocks = int(targets.agg(F.max(F.ceil(F.col("documents") / BLOCK_DOCUMENTS))).first()[0] or 0)
    settled, level = None, 0
    while True:
        done = stored(todo.groupBy("source_id", "block").applyInArrow(_round_block(level), _STEP), f"mixing-level{level}")
        ready = done.where("chance = 0 or chance = 1")
        settled = ready if settled is None else settled.union(ready)
        left = done.where("chance > 0 and chance < 1")
        if most_blocks <= 1:
            # One document of a source is left: the nearer of none and one more copy.
            settled = settled.union(left.withColumn("chance", F.when(F.col("chance") >= 0.5, 1.0).otherwise(0.0)))
            break
        todo, level = left.withColumn("block", F.floor(F.col("block") / FAN_IN)), level + 1
        most_blocks = -(-most_blocks // FAN_IN)
    extra = settled.select("row", F.col("chance").cast("long").alias("extra"))
    copies = (F.floor("each") + F.coalesce("extra", F.lit(0))).cast("long")
    return joined.join(extra, "row", "left").select("row", "doc_id", "size", "source_size", "target", copies.alias("copies"))


def take_mix(docs: DataFrame, weights=WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """The documents of the mix: every row of `docs` as often as it is taken, same columns.

    Documents without words are in no share and go. Every other column passes through, whatever its
    name.
    """
    numbered = stored(packed(docs).withColumn("row", F.monotonically_increasing_id()), "mixing-documents")
    read = numbered.select("document.doc_id", "document.source", "document.text", "row")
    copies = mix_copies(read, weights, most, row="row").where("copies > 0")
    taken = numbered.join(copies.select("row", "copies"), "row")
    repeated = taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return repeated.select("document.*")
