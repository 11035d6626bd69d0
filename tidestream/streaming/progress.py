"""Counts of every batch of every query, kept beyond the life of a query's process."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tidestream.sinks.versions import Files

_COUNTS = "query_id STRING, name STRING, batch BIGINT, at TIMESTAMP, input_rows BIGINT, dropped_rows BIGINT, state_rows BIGINT, millis BIGINT"


class RowCounts(StreamingQueryListener):
    """Writes a small file per query and batch: rows read, rows dropped behind the watermark, rows in state.

    A batch that is repeated after a restart has its number and keeps its first file. Batches without
    input that dropped nothing are left out. Add it with `spark.streams.addListener`.
    """

    def __init__(self, spark: SparkSession, path: str):
        self._files = Files(spark, path)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        states = list(progress.stateOperators)
        dropped = sum(state.numRowsDroppedByWatermark for state in states)
        if not (progress.numInputRows or dropped):
            return
        query = str(progress.id)
        row = {
            "query_id": query,
            "name": progress.name,
            "batch": progress.batchId,
            "at": progress.timestamp,
            "input_rows": progress.numInputRows,
            "dropped_rows": dropped,
            "state_rows": sum(state.numRowsTotal for state in states),
            "millis": progress.durationMs.get("triggerExecution", 0),
        }
        self._files.create(f"query={query}/{progress.batchId:012}.json", json.dumps(row))

    def onQueryTerminated(self, event) -> None:
        pass


def row_counts(spark: SparkSession, path: str) -> DataFrame:
    """One row per query and batch that `RowCounts` has written to this path."""
    return spark.read.schema(_COUNTS).json(f"{path.rstrip('/')}/query=*")


def dropped_in_life(spark: SparkSession, path: str) -> DataFrame:
    """Batches, rows read and rows dropped of every query, over all of its runs."""
    return row_counts(spark, path).groupBy("query_id").agg(
        F.count("*").alias("batches"),
        F.sum("input_rows").alias("input_rows"),
        F.sum("dropped_rows").alias("dropped_rows"),
        F.max("at").alias("last_at"),
    )
