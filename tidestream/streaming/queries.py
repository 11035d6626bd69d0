"""Watermarks, streaming de-duplication and continuously running queries."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidestream.constants import CLICKSTREAM_TOPIC, POLL_INTERVAL
from tidestream.operators.enrich import add_event_time
from tidestream.operators.quality import is_valid
from tidestream.operators.sketches import KEPT, frequent_products, product_minutes
from tidestream.plans.batch import MERGE, store_batch
from tidestream.schemas import CORRUPT_COLUMN
from tidestream.session import batch_settings
from tidestream.sinks.lake import write_quarantine
from tidestream.sources.messages import route_topics, well_formed

WATERMARK = "5 minutes"
SEEN_WITHIN = "1 hour"


def timed_events(events: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Events with a parsed time and a watermark on it.

    Rows without a usable time can be neither windowed nor expired from state, so they are
    left to `start_quarantine`.
    """
    timed = add_event_time(events).where(F.col("event_timestamp").isNotNull())
    return timed.withWatermark("event_timestamp", watermark)


def drop_duplicates_stream(timed: DataFrame, salts: int = 0) -> DataFrame:
    """One row per event_id within the watermark; state is dropped once it has passed.

    With `salts`, the copies of an id are first reduced within that many groups by broker
    offset, so an id that is sent in masses does not end up whole in one task; the second
    step makes the result exact.
    """
    if not salts:
        return timed.dropDuplicatesWithinWatermark(["event_id"])
    if "kafka_metadata" not in timed.columns:
        raise ValueError("salting needs the broker offset in kafka_metadata")
    salt = F.pmod(F.col("kafka_metadata.offset"), F.lit(salts))
    first = timed.withColumn("salt", salt).dropDuplicatesWithinWatermark(["event_id", "salt"])
    return first.drop("salt").dropDuplicatesWithinWatermark(["event_id"])


def valid_stream(events: DataFrame, watermark: str = WATERMARK, salts: int = 0) -> DataFrame:
    """Well-formed, valid, timed and distinct events, ready for the window metrics."""
    if CORRUPT_COLUMN in events.columns:
        events = well_formed(events)
    events = events.where(is_valid("cart_items" in events.columns))
    return drop_duplicates_stream(timed_events(events, watermark), salts)


def flagged_stream(events: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """All rows with an is_valid flag, the input of the streaming error rate.

    Rows without a usable time of their own, malformed ones among them, count at the time the
    broker received them. Only rows without either time are left out.
    """
    timed = add_event_time(events)
    valid = is_valid("cart_items" in events.columns) & F.col("event_timestamp").isNotNull()
    received = F.timestamp_millis("kafka_metadata.timestamp") if "kafka_metadata" in events.columns else F.lit(None)
    flagged = timed.withColumns({"is_valid": valid, "event_timestamp": F.coalesce("event_timestamp", received)})
    return flagged.where(F.col("event_timestamp").isNotNull()).withWatermark("event_timestamp", watermark)


def stored_stream(events: DataFrame) -> DataFrame:
    """The events a stream stores: well-formed, valid and with a usable time, however late.

    What is left out is exactly what `start_quarantine` keeps. There is no watermark here, so
    nothing is dropped for being late; copies are removed within a batch when it is written
    and across batches when the days are read.
    """
    if CORRUPT_COLUMN in events.columns:
        events = well_formed(events)
    timed = events.where(is_valid("cart_items" in events.columns))
    return timed.where(F.try_to_timestamp("timestamp").isNotNull())


def distinct_arrivals(events: DataFrame, seen_within: str = SEEN_WITHIN) -> DataFrame:
    """The first copy of every event_id to arrive, among those that arrive within some time of it.

    The watermark follows the time of arrival and not that of the event, so late events are kept, and
    state is dropped by the clock. Events without an id count as copies of each other.
    """
    arriving = events.withColumn("arrived_at", F.current_timestamp()).withWatermark("arrived_at", seen_within)
    return arriving.dropDuplicatesWithinWatermark(["event_id"]).drop("arrived_at")


def query_identity(spark: SparkSession, checkpoint: str) -> str:
    """A name that a query keeps over restarts and that a new checkpoint does not repeat."""
    metadata = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0]
    return json.loads(metadata)["id"].replace("-", "")


def dropped_rows(query: StreamingQuery) -> int:
    """Rows dropped behind the watermark in the batches that the query still remembers, 100 by default.

    `progress.RowCounts` keeps the counts of a query's whole life.
    """
    states = [state for progress in query.recentProgress for state in progress["stateOperators"]]
    return sum(state["numRowsDroppedByWatermark"] for state in states)


def _trigger(writer, interval: str | None):
    if interval is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=interval)


def start_clickstream(
    events: DataFrame,
    lake: str,
    checkpoint: str,
    topic: str = CLICKSTREAM_TOPIC,
    interval: str | None = POLL_INTERVAL,
    refresh: bool | str = True,
    seen_within: str = SEEN_WITHIN,
) -> StreamingQuery:
    """Each micro-batch through `store_batch`; without an interval, whatever is there now.

    All valid events are stored, late ones too, and the metrics of the days they belong to are
    computed anew, which reads those days. With `refresh` "merge" a batch adds the cells of its own
    events instead, so its cost does not grow with the day: copies that arrive `seen_within` of the
    first are removed by the stream's state, and `current_metrics` has the metrics at any time. Copies
    that come later still, or by another query, count until `rebuild_cells` makes the day again. With
    `refresh` off the metrics are left to a scheduled `refresh_days`. A batch is stored under the
    query's identity and its number: one that is repeated after a failure replaces itself, and
    another query or checkpoint never does.
    """
    spark, identity = events.sparkSession, []
    stream = stored_stream(events)
    if refresh == MERGE:
        stream = distinct_arrivals(stream, seen_within)

    def store(batch: DataFrame, number: int) -> None:
        if not identity:
            identity.append(query_identity(spark, checkpoint))
        with batch_settings(batch.sparkSession):
            store_batch(batch, lake, f"stream_{identity[0]}_{number}", topic, refresh=refresh, spark=spark, distinct=refresh == MERGE)

    writer = stream.writeStream.foreachBatch(store)
    return _trigger(writer.option("checkpointLocation", checkpoint), interval).start()


def start_router(
    messages: DataFrame,
    handlers: Mapping[str, Callable[[DataFrame, int], None]],
    checkpoint: str,
    interval: str | None = POLL_INTERVAL,
) -> StreamingQuery:
    """Hands the broker rows of each micro-batch to the job of their topic.

    A handler gets its rows and the batch number, and sees them again if the batch is
    repeated. Rows of jobs without a handler fail the batch rather than vanish.
    """

    def route(batch: DataFrame, number: int) -> None:
        routed = route_topics(batch).persist()
        try:
            jobs = [r["job"] for r in routed.select("job").distinct().collect()]
            unknown = set(jobs) - set(handlers)
            if unknown:
                raise LookupError(f"no handler for {sorted(unknown)}")
            for job in jobs:
                handlers[job](routed.where(F.col("job") == job).drop("job"), number)
        finally:
            routed.unpersist()

    writer = messages.writeStream.foreachBatch(route).option("checkpointLocation", checkpoint)
    return _trigger(writer, interval).start()


def start_quarantine(
    events: DataFrame,
    lake: str,
    checkpoint: str,
    topic: str = CLICKSTREAM_TOPIC,
    interval: str | None = POLL_INTERVAL,
) -> StreamingQuery:
    """Malformed, invalid and undated rows to the quarantine table, with the reason."""
    timed = add_event_time(events)
    reason = F.when(~is_valid("cart_items" in events.columns), "failed validation").when(
        F.col("event_timestamp").isNull(), "unparsable timestamp"
    )
    if CORRUPT_COLUMN in events.columns:
        malformed = F.col(CORRUPT_COLUMN).isNotNull()
        reason = F.when(malformed, "malformed JSON").otherwise(reason)
    rows = timed.select(
        F.to_json(F.struct(*events.columns)).alias("event"), reason.alias("reason")
    ).where(F.col("reason").isNotNull())

    def store(batch: DataFrame, number: int) -> None:
        identity = query_identity(events.sparkSession, checkpoint)
        write_quarantine(batch, f"{lake}/raw", f"stream_{identity}_{number}", topic)

    writer = rows.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return _trigger(writer, interval).start()


def start_product_summaries(
    events: DataFrame, path: str, checkpoint: str, kept: int = KEPT, interval: str | None = POLL_INTERVAL
) -> StreamingQuery:
    """The most viewed products of every minute, once it can change no more, for `top_products_live`.

    A batch holds whole minutes and lies in a folder named after the query and its number, so one
    that is repeated replaces itself.
    """
    spark = events.sparkSession

    def store(batch: DataFrame, number: int) -> None:
        folder = f"{path.rstrip('/')}/batch={query_identity(spark, checkpoint)}_{number}"
        frequent_products(batch, kept).coalesce(1).write.mode("overwrite").parquet(folder)

    writer = product_minutes(events).writeStream.outputMode("append").foreachBatch(store)
    return _trigger(writer.option("checkpointLocation", checkpoint), interval).start()


def start_window_table(
    windows: DataFrame, path: str, checkpoint: str, interval: str | None = POLL_INTERVAL
) -> StreamingQuery:
    """Window metrics appended to a Parquet table, each window once it can change no more."""
    writer = (
        windows.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return _trigger(writer, interval).start()
