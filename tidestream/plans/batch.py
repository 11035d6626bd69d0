"""One batch of events through validation, enrichment, storage and metrics."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidestream.constants import CLICKSTREAM_TOPIC
from tidestream.operators import metrics as m
from tidestream.operators.carts import expand_carts
from tidestream.operators.cells import merge_sessions, merge_totals, metrics_from_cells, total_cells
from tidestream.operators.enrich import PARTITION_COLUMNS, add_day_partitions, add_time_partitions, enrich_events
from tidestream.operators.quality import drop_duplicate_events, freshness, is_valid, validate_events
from tidestream.operators.sessions import session_cells, session_metrics
from tidestream.schemas import EVENT_SCHEMA
from tidestream.sinks import raw
from tidestream.sinks.lake import Parts, metric_path, part_path, write_daily_summary, write_metrics, write_quarantine
from tidestream.sinks.versions import Files
from tidestream.sinks.warehouse import WAREHOUSE_TABLES, replace_days_jdbc
from tidestream.sources.lake import read_parts
from tidestream.sources.messages import conform_events

MERGE = "merge"
CELLS = {"session_cells": (session_cells, merge_sessions), "total_cells": (total_cells, merge_totals)}


def metric_frames(events: DataFrame) -> dict[str, DataFrame]:
    """The five metric tables of enriched events.

    Sessions, hours and devices count events. Products and categories count cart lines, as
    a purchase names its products only there.
    """
    lines = expand_carts(events)
    return {
        "sessions": session_metrics(events),
        "products": m.product_metrics(lines),
        "hourly": m.hourly_metrics(events),
        "categories": m.category_metrics(lines),
        "devices": m.device_metrics(events),
    }


def rejected_rows(events: DataFrame, accept_carts: bool = True) -> DataFrame:
    """Events that fail a row rule, as JSON text with the reason."""
    row = F.to_json(F.struct(*events.columns))
    return events.where(~is_valid(accept_carts)).select(
        row.alias("event"), F.lit("failed validation").alias("reason")
    )


def _no_events(spark: SparkSession) -> DataFrame:
    return enrich_events(spark.createDataFrame([], EVENT_SCHEMA), batch_id="")


def raw_schema(spark: SparkSession) -> T.StructType:
    """The columns of the raw table."""
    return add_time_partitions(_no_events(spark)).schema


def cells_schema(spark: SparkSession, table: str) -> T.StructType:
    return add_day_partitions(CELLS[table][0](_no_events(spark))).schema


def cells_path(lake: str, table: str, topic: str = CLICKSTREAM_TOPIC) -> str:
    return f"{lake.rstrip('/')}/raw/cells/{topic}/{table}"


def read_events(spark: SparkSession, lake: str, topic: str = CLICKSTREAM_TOPIC) -> DataFrame:
    """All raw events of a topic, copies in different batches removed."""
    return drop_duplicate_events(raw.read_raw(spark, f"{lake}/raw", raw_schema(spark), topic))


def read_days(spark: SparkSession, lake: str, days: set, schema: T.StructType, topic: str = CLICKSTREAM_TOPIC) -> DataFrame:
    """The raw events of some days, copies in different batches removed."""
    return drop_duplicate_events(raw.read_raw(spark, f"{lake}/raw", schema, topic, at=days))


def refresh_days(spark: SparkSession, lake: str, days: set, schema: T.StructType, topic: str = CLICKSTREAM_TOPIC) -> None:
    """Recompute the metric tables of some days from all batches stored for them.

    So a session, product or hour has one row however its events were cut into batches, and
    its distinct counts are right. The events of the days are read and de-duplicated once.
    """
    if not days:
        return
    events = read_days(spark, lake, days, schema, topic).persist()
    try:
        write_metrics(metric_frames(events), f"{lake}/processed", days, topic)
    finally:
        events.unpersist()


def _together(spark: SparkSession, jobs: Mapping) -> dict:
    """Independent jobs submitted at once, so that each fills the executors the others leave idle."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        return dict(zip(jobs, pool.map(lambda job: inheritable_thread_target(spark)(job)(), jobs.values())))


def _write_cells(events: DataFrame, lake: str, topic: str, run: str, batch_id: str | None, merged: Mapping[str, DataFrame] | None = None) -> dict:
    """The cells of distinct events as parts of a run; what a version is to say of them."""

    def job(table: str):
        def write() -> dict:
            cells = CELLS[table][0](events) if merged is None else merged[table]
            path = cells_path(lake, table, topic)
            filled = raw.write_parts(add_day_partitions(cells), path, PARTITION_COLUMNS[:3], run)
            return raw.entries(path, f"{lake}/raw", table, filled, run, batch_id)

        return write

    spark = (events if merged is None else next(iter(merged.values()))).sparkSession
    written = _together(spark, {table: job(table) for table in CELLS})
    return {key: entry for part in written.values() for key, entry in part.items()}


def store_batch(
    events: DataFrame,
    lake: str,
    batch_id: str,
    topic: str = CLICKSTREAM_TOPIC,
    processed_at: Column | None = None,
    keep_rejected: bool = False,
    refresh: bool | str = True,
    spark: SparkSession | None = None,
    distinct: bool = False,
) -> tuple[list, T.StructType]:
    """Store a batch of events and refresh the metrics of its days.

    Running a batch_id again replaces what it wrote before, also if fewer or no events are
    left, and also if the run before it died at any point. Late events go to their own day, whose
    metrics are computed anew from all of its events. With `refresh` "merge" the batch's own cells
    are stored instead, in the same version as its events: nothing else is read, and
    `current_metrics` has the metrics up to this batch. Without `refresh` only the raw table is
    written, for a job that calls `refresh_days` at longer intervals. `spark` is the session for
    the metrics, by default that of the events. `distinct` events have no copies among them. Returns the hours that got rows and the schema of
    the raw table.
    """
    spark = spark or events.sparkSession
    events = conform_events(events)
    valid = events.where(is_valid(accept_carts=True)) if distinct else validate_events(events, accept_carts=True)
    enriched = enrich_events(valid, processed_at, batch_id)
    schema = add_time_partitions(enriched).schema
    if refresh == MERGE:
        enriched = enriched.persist()
    try:
        more = (lambda run: _write_cells(enriched, lake, topic, run, batch_id)) if refresh == MERGE else None
        filled, touched, stale = raw.write_raw(enriched, f"{lake}/raw", batch_id, topic, more)
    finally:
        if refresh == MERGE:
            enriched.unpersist()
    if keep_rejected:
        write_quarantine(rejected_rows(events), f"{lake}/raw", batch_id, topic)
    rebuild_cells(spark, lake, stale, topic)
    if refresh is True:
        refresh_days(spark, lake, {part[:3] for part in touched}, schema, topic)
    return sorted(filled, key=repr), schema


def _day_cells(spark: SparkSession, lake: str, state: dict, table: str, days: Iterable[Parts], topic: str) -> DataFrame:
    parts = raw.live_parts(state, table, days)
    return raw.read_parts(spark, f"{lake}/raw", cells_path(lake, table, topic), parts, cells_schema(spark, table))


def current_metrics(spark: SparkSession, lake: str, days: Iterable[Parts], topic: str = CLICKSTREAM_TOPIC) -> dict[str, DataFrame]:
    """The five metric tables of some days, merged from the cells of all batches so far.

    No event is read. Distinct users and sessions are estimates of the merged sketches.
    """
    days = list(days)
    _, state = raw.table_log(spark, f"{lake}/raw", topic).read()
    return metrics_from_cells(*[_day_cells(spark, lake, state, table, days, topic) for table in CELLS])


def publish_days(spark: SparkSession, lake: str, days: Iterable[Parts], topic: str = CLICKSTREAM_TOPIC) -> None:
    """Write the merged metrics of some days to the metric tables."""
    days = set(days)
    write_metrics(current_metrics(spark, lake, days, topic), f"{lake}/processed", days, topic)


def _replace_cells(spark: SparkSession, lake: str, old: dict, cells: Mapping[str, DataFrame], topic: str) -> bool:
    """New parts in place of a day's old ones, unless one of those has changed meanwhile."""
    added = _write_cells(None, lake, topic, raw.new_run(), None, cells)

    def build(now: dict) -> dict | None:
        if any(now.get(key) != e for key, e in old.items()):
            return None
        return {"drop": list(old), "set": added}

    if raw.table_log(spark, f"{lake}/raw", topic).commit(build) is None:
        raw.delete_parts(spark, f"{lake}/raw", added)
        return False
    return True


def compact_cells(spark: SparkSession, lake: str, days: Iterable[Parts], topic: str = CLICKSTREAM_TOPIC) -> list[Parts]:
    """Merge the cells of each of some days into one part per table; returns the days merged."""
    done = []
    for day in days:
        _, state = raw.table_log(spark, f"{lake}/raw", topic).read()
        old = {key: e for table in CELLS for key, e in raw.live_parts(state, table, [day]).items()}
        if len(old) > len(CELLS):
            merged = {table: merge(_day_cells(spark, lake, state, table, [day], topic)) for table, (_, merge) in CELLS.items()}
            if _replace_cells(spark, lake, old, merged, topic):
                done.append(day)
    return done


def sweep_days(spark: SparkSession, lake: str, days: Iterable[Parts], topic: str = CLICKSTREAM_TOPIC, older_than: float = 86_400.0) -> list[str]:
    """Delete what no version names any more of the events and cells of some days."""
    tables = [cells_path("", table, topic).removeprefix("/raw/") for table in CELLS]
    return raw.sweep(spark, f"{lake}/raw", days, topic, older_than, tables)


def rebuild_cells(spark: SparkSession, lake: str, days: Iterable[Parts], topic: str = CLICKSTREAM_TOPIC) -> None:
    """Make the cells of some days again from their events, copies in different batches counted once.

    For days whose merged cells hold a batch that was repeated, and for late copies. A batch that
    comes meanwhile wins, and the day is made again.
    """
    for day in days:
        while True:
            _, state = raw.table_log(spark, f"{lake}/raw", topic).read()
            old = {key: e for table in (*CELLS, raw.RAW) for key, e in raw.live_parts(state, table, [day]).items()}
            events = read_days(spark, lake, {day}, raw_schema(spark), topic)
            if _replace_day(spark, lake, day, old, events, topic):
                break


def _replace_day(spark: SparkSession, lake: str, day: Parts, old: dict, events: DataFrame, topic: str) -> bool:
    events = events.persist()
    try:
        added = _write_cells(events, lake, topic, raw.new_run(), None)
    finally:
        events.unpersist()
    cells = [key for key, e in old.items() if e["table"] in CELLS]

    def build(now: dict) -> dict | None:
        same = {key: e for table in (*CELLS, raw.RAW) for key, e in raw.live_parts(now, table, [day]).items()}
        return {"drop": cells, "set": added} if same == old else None

    if raw.table_log(spark, f"{lake}/raw", topic).commit(build) is None:
        raw.delete_parts(spark, f"{lake}/raw", added)
        return False
    raw.delete_parts(spark, f"{lake}/raw", cells)
    return True


def process_batch(events: DataFrame, lake: str, batch_id: str, topic: str = CLICKSTREAM_TOPIC, **options) -> DataFrame:
    """`store_batch`, and the summary of what the batch has stored."""
    _, schema = store_batch(events, lake, batch_id, topic, **options)
    spark = options.get("spark") or events.sparkSession
    stored = raw.read_raw(spark, f"{lake}/raw", schema, topic, batch_id=batch_id)
    return m.processing_summary(stored).withColumn("batch_id", F.lit(batch_id))


def _two_days(as_of: str) -> list[dt.date]:
    last = dt.date.fromisoformat(as_of[:10])
    return [last - dt.timedelta(days=1), last]


def daily_job(spark: SparkSession, lake: str, as_of: str, topic: str = CLICKSTREAM_TOPIC) -> dict:
    """The scheduled report: how fresh the raw table is, and the daily summary of two days.

    Lists and reads the folders of the as-of day and the day before only. The summary goes to the
    topic's part of the curated table, also as nothing for a day that has become empty, unless
    there is nothing from the as-of day; returns the freshness row.
    """
    days = _two_days(as_of)
    recent = raw.read_raw(spark, f"{lake}/raw", raw_schema(spark), topic, at=[(d.year, d.month, d.day) for d in days])
    state = freshness(recent, as_of).first().asDict()
    if state["status"] != "missing":
        summary = m.daily_summary(drop_duplicate_events(recent), as_of[:10])
        write_daily_summary(summary, f"{lake}/curated", topic, days)
    return state


def load_warehouse(
    spark: SparkSession,
    lake: str,
    connection: Mapping[str, str],
    days: Iterable[dt.date],
    topic: str = CLICKSTREAM_TOPIC,
) -> None:
    """The stored hourly, product and category metrics of some days to the warehouse, over JDBC.

    Only these days' folders are read. They go to a staging table first, and then replace the same days
    of the warehouse's table in one transaction, so a load can be repeated and scheduled.
    """
    days = sorted(set(days))
    for name, target in WAREHOUSE_TABLES.items():
        path = metric_path(f"{lake}/processed", name, topic)
        columns = metric_frames(_no_events(spark))[name]
        schema = add_day_partitions(columns).schema
        found = Files(spark, path)
        folders = [part_path(path, (d.year, d.month, d.day)) for d in days if found.exists(part_path("", (d.year, d.month, d.day)).lstrip("/"))]
        stored = read_parts(spark, path, folders, schema)
        replace_days_jdbc(stored.select(*columns.columns), {**connection, "dbtable": target}, days)
