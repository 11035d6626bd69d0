"""Partitioned Parquet tables: metrics, quarantine, the daily report, baselines.

The metric tables hold one version of each day, which `refresh_days` recomputes from all batches
of the day. The raw events are in `sinks.raw`.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidestream.constants import CLICKSTREAM_TOPIC
from tidestream.operators.enrich import PARTITION_COLUMNS, add_day_partitions

Parts = tuple  # values of the leading partition columns, None for rows without a time


def raw_path(root: str, topic: str = CLICKSTREAM_TOPIC) -> str:
    return f"{root.rstrip('/')}/clickstream/{topic}"


def metric_path(root: str, name: str, topic: str = CLICKSTREAM_TOPIC) -> str:
    return f"{root.rstrip('/')}/analytics/{topic}/{name}"


def quarantine_path(root: str, topic: str = CLICKSTREAM_TOPIC) -> str:
    return f"{root.rstrip('/')}/quarantine/topic={topic}"


def part_path(path: str, parts: Parts) -> str:
    """The folder of a partition of a table, as Spark names it."""
    names = [f"{c}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for c, v in zip(PARTITION_COLUMNS, parts)]
    return "/".join([path, *names])


def batch_path(path: str, batch_id: str) -> str:
    return f"{path}/batch_id={batch_id}"


def write_partitions(df: DataFrame, path: str, columns: Sequence[str], **options: str) -> set[Parts]:
    """Write `df` over its partitions of `path`; returns the partitions that got rows.

    Rows are gathered by partition, but a large one is split over as many tasks as it fills.
    """
    filled = Observation()
    dated = df.observe(filled, F.collect_set(F.struct(*columns)).alias("parts")) if columns else df
    pieces = dated.hint("rebalance", *columns).write.mode("overwrite").options(**options)
    pieces.partitionBy(*columns).parquet(path)
    return {tuple(part) for part in filled.get["parts"]} if columns else set()


def _empty(spark: SparkSession, schema: T.StructType, path: str, drop: Iterable[str]) -> None:
    """Replace a folder by one without rows."""
    kept = T.StructType([f for f in schema.fields if f.name not in set(drop)])
    spark.createDataFrame([], kept).coalesce(1).write.mode("overwrite").parquet(path)


def write_metrics(
    metrics: Mapping[str, DataFrame], root: str, days: set[Parts], topic: str = CLICKSTREAM_TOPIC
) -> None:
    """Metric tables by year, month and day; the given days are replaced, also by nothing.

    The tables do not depend on each other, so their jobs are submitted together and fill
    the executors that the tail of another job leaves idle.
    """
    spark = next(iter(metrics.values())).sparkSession
    columns = PARTITION_COLUMNS[:3]

    def write(name: str) -> None:
        path, dated = metric_path(root, name, topic), add_day_partitions(metrics[name])
        filled = write_partitions(dated, path, columns, partitionOverwriteMode="dynamic")
        for day in days - filled:
            _empty(spark, dated.schema, part_path(path, day), columns)

    with ThreadPoolExecutor(len(metrics)) as pool:
        list(pool.map(inheritable_thread_target(spark)(write), metrics))


def write_quarantine(
    rows: DataFrame, root: str, batch_id: str, topic: str = CLICKSTREAM_TOPIC
) -> None:
    """Rejected rows of a batch, as JSON text with the reason; none replace what there was."""
    write_partitions(rows, batch_path(quarantine_path(root, topic), batch_id), ())


def write_daily_summary(
    summary: DataFrame, root: str, topic: str = CLICKSTREAM_TOPIC, days: Iterable[dt.date] = ()
) -> str:
    """The curated daily report of a topic; a rerun replaces the days it covers and no others.

    Of the given `days`, those that got no row become empty.
    """
    path = f"{root.rstrip('/')}/daily_summary"
    columns = ["topic", "report_date"]
    named = summary.withColumn("topic", F.lit(topic))
    filled = {part[1] for part in write_partitions(named, path, columns, partitionOverwriteMode="dynamic")}
    for day in set(days) - filled:
        _empty(summary.sparkSession, named.schema, f"{path}/topic={topic}/report_date={day}", columns)
    return path


def write_csv(df: DataFrame, path: str) -> None:
    """A small table, such as feature importance, as CSV with a header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def append_baseline(
    metrics: DataFrame, path: str, run_id: str, recorded_at: dt.datetime | None = None
) -> None:
    """Add the prediction metrics of a run to the baseline table."""
    at = F.current_timestamp() if recorded_at is None else F.lit(recorded_at)
    rows = metrics.withColumns({"run_id": F.lit(run_id), "recorded_at": at})
    rows.coalesce(1).write.mode("append").parquet(path)


def append_sketch(sketch: DataFrame, path: str, run_id: str) -> None:
    """Add the score sketch of a run (events, sketch), so that quantiles of any runs can be merged."""
    sketch.withColumn("run_id", F.lit(run_id)).coalesce(1).write.mode("append").parquet(path)


def read_baseline(spark: SparkSession, path: str, before: str | None = None) -> DataFrame | None:
    """The metrics (metric, value) of the run recorded last, `before` another run or at all.

    None if there is no such run yet.
    """
    try:
        rows = spark.read.schema("metric STRING, value DOUBLE, run_id STRING, recorded_at TIMESTAMP").parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    others = rows if before is None else rows.where(F.col("run_id") != before)
    newest = others.agg(F.max(F.struct("recorded_at", "run_id")).alias("run")).first()["run"]
    return None if newest is None else rows.where(F.col("run_id") == newest["run_id"]).select("metric", "value")
