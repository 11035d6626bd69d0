"""Derived event columns: parsed time, device flags, processing metadata, partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidestream.constants import DEVICE_TYPES

PARTITION_COLUMNS = ("year", "month", "day", "hour")


def add_event_time(events: DataFrame) -> DataFrame:
    """event_timestamp, event_date and event_hour; unparsable text gives nulls."""
    parsed = events.withColumn("event_timestamp", F.try_to_timestamp("timestamp"))
    return parsed.withColumns(
        {
            "event_date": F.to_date("event_timestamp"),
            "event_hour": F.hour("event_timestamp"),
        }
    )


def add_device_flags(events: DataFrame) -> DataFrame:
    """is_mobile, is_tablet and is_desktop; null where the device is unknown."""
    device = F.col("device_info.type")
    return events.withColumns({f"is_{name}": device == name for name in DEVICE_TYPES})


def new_batch_id() -> Column:
    """Batch name made from the start time of the query."""
    stamp = F.date_format(F.current_timestamp(), "yyyyMMdd_HHmmss")
    return F.concat(F.lit("batch_"), stamp)


def add_processing_info(
    events: DataFrame, processed_at: Column | None = None, batch_id: str | None = None
) -> DataFrame:
    """processed_at and batch_id, both overridable so that a rerun can repeat them."""
    return events.withColumns(
        {
            "processed_at": F.current_timestamp() if processed_at is None else processed_at,
            "batch_id": new_batch_id() if batch_id is None else F.lit(batch_id),
        }
    )


def enrich_events(
    events: DataFrame, processed_at: Column | None = None, batch_id: str | None = None
) -> DataFrame:
    """All enrichment. The session duration of a single event is a constant 0; the real
    one comes from `session_metrics`."""
    enriched = add_device_flags(add_event_time(events))
    enriched = add_processing_info(enriched, processed_at, batch_id)
    return enriched.withColumn("session_duration_seconds", F.lit(0))


def add_time_partitions(events: DataFrame, time: str = "event_timestamp") -> DataFrame:
    """year, month, day and hour columns of a timestamp."""
    parts = (F.year, F.month, F.dayofmonth, F.hour)
    return events.withColumns({n: part(time) for n, part in zip(PARTITION_COLUMNS, parts)})


def add_day_partitions(metrics: DataFrame, date: str = "event_date") -> DataFrame:
    """year, month and day columns of a date."""
    parts = (F.year, F.month, F.dayofmonth)
    return metrics.withColumns({n: part(date) for n, part in zip(PARTITION_COLUMNS, parts)})


def partition_counts(events: DataFrame) -> DataFrame:
    """Rows per year/month/day/hour partition."""
    return events.groupBy(*PARTITION_COLUMNS).agg(F.count("*").alias("events"))
