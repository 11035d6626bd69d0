"""Reading documents, batch sizes, and connected components over stored intermediate tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidestream.session import discard, stored


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of an undirected graph of edges (a, b) as rows (node, root).

    The root is the smallest node of the component. Each round links the larger neighbours of a
    node to its smallest neighbour, then the smaller ones (large star, small star); the number
    of rounds grows with the logarithm of a component's diameter. Only edges move, minima are
    combined before the shuffle, and no list of neighbours is ever gathered.
    """
    links = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    last = None
    while True:
        both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        large = large.distinct()
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(small, "a")
        before, links = links, stored(
            joined.select("a", F.col("m").alias("b")).union(joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct(),
            name,
        )
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        discard(before)
        if tuple(state) == last:
            break
        last = tuple(state)
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))


def running(rows: DataFrame, order: list, sums: dict[str, str], name: str) -> DataFrame:
    """Rows with running sums: column `new` is the sum of column `old`, for {new: old}, over all rows before.

    The rows are cut into ranges of the order. Each range adds up for itself and begins with the totals of
    those before it, so no task sees all rows; only one row per range does. The order has no ties.
    """
    ranged = stored(rows.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), name)
    totals = ranged.groupBy("range").agg(*[F.sum(old).alias(f"total_{old}") for old in set(sums.values())])
    ranges = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    carried = totals.select("range", *[F.coalesce(F.sum(f"total_{old}").over(ranges), F.lit(0)).alias(f"carried_{old}") for old in set(sums.values())])
    inside = Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    made = {new: F.col(f"carried_{old}") + F.coalesce(F.sum(old).over(inside), F.lit(0)) for new, old in sums.items()}
    return ranged.join(carried, "range").withColumns(made).select(*rows.columns, *sums)


def join_hot(rows: DataFrame, lookup: DataFrame, key: str, count: str) -> DataFrame:
    """Rows joined with a lookup table of unique keys that says how often each key occurs.

    Keys that hold more than a thousandth of all rows, fewer than a thousand of them, are
    broadcast, so their rows stay where they are; the others are shuffled. Rows whose key is not in
    the lookup table go.
    """
    total = lookup.agg(F.sum(count)).first()[0] or 0
    often = F.col(count) * 1000 > F.lit(total)
    hot, cold = lookup.where(often).drop(count), lookup.where(~often).drop(count)
    spread = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key)
    return rows.join(F.broadcast(hot), key).unionByName(spread)


def packed(docs: DataFrame) -> DataFrame:
    """All columns of `docs` in one column `document`.

    So columns that an operator adds for itself never meet one of the caller's. The operator reads
    `document.text`, and `select("document.*")` gives the caller's columns back.
    """
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document"))


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Texts go to Python in batches of at most 1,000 rows, which bounds the buffers of a task."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


def text_bytes(docs: DataFrame) -> int:
    """Bytes of all texts, to choose how many buckets a job needs."""
    return int(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
