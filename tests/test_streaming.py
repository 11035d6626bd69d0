"""Streams from a folder of JSON files, drained with available-now triggers."""

from __future__ import annotations

import json
import os

import pytest
from helpers import assert_same, event, events_frame
from pyspark.sql import functions as F

from tidestream.operators import windows
from tidestream.plans.batch import current_metrics, process_batch, read_events
from tidestream.sinks.lake import metric_path, quarantine_path, raw_path
from tidestream.sources.messages import decode_messages, read_event_files
from tidestream.streaming import queries


@pytest.fixture
def inbox(tmp_path):
    """Writes one file of events per call."""
    folder = tmp_path / "inbox"
    folder.mkdir()
    count = iter(range(100))

    def put(*rows):
        lines = [r if isinstance(r, str) else json.dumps(r) for r in rows]
        number = next(count)
        path = folder / f"{number:03d}.json"
        path.write_text("\n".join(lines))
        # A stream takes files in the order of their times; written at once, they may tie.
        os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))

    put.folder = str(folder)
    return put


def drain(spark, frame, tmp_path, name):
    """What the stream has emitted so far, from an append-mode table."""
    path, checkpoint = f"{tmp_path}/{name}", f"{tmp_path}/{name}-checkpoint"
    queries.start_window_table(frame, path, checkpoint, interval=None).awaitTermination()
    return spark.read.schema(frame.schema).parquet(path).collect()


def test_minute_windows_close_behind_the_watermark(spark, inbox, tmp_path):
    inbox(event("1"), event("2", user_id="u2"), event("3", at="2024-01-05T10:30:00Z"))
    stream = queries.valid_stream(read_event_files(spark, inbox.folder))
    rows = drain(spark, windows.category_minute(stream), tmp_path, "minutes")
    assert [(r["total_events"], r["unique_users"]) for r in rows] == [(2, 2)]


def test_late_rows_are_dropped(spark, inbox, tmp_path):
    stream = queries.valid_stream(read_event_files(spark, inbox.folder, max_files=1))
    minutes = windows.category_minute(stream)
    inbox(event("1"))
    inbox(event("2", at="2024-01-05T12:00:00Z"))
    inbox(event("3", at="2024-01-05T12:01:00Z"))
    drain(spark, minutes, tmp_path, "late")
    inbox(event("late", at="2024-01-05T09:00:00Z"), event("4", at="2024-01-05T13:00:00Z"))
    rows = drain(spark, minutes, tmp_path, "late")
    assert {r["window_start"].hour for r in rows} == {10, 12}


def test_rows_dropped_for_being_late_are_counted(spark, inbox, tmp_path):
    stream = queries.valid_stream(read_event_files(spark, inbox.folder, max_files=1))
    minutes = windows.category_minute(stream)
    inbox(event("1", at="2024-01-05T12:00:00Z"))
    inbox(event("2", at="2024-01-05T12:30:00Z"))
    inbox(event("late", at="2024-01-05T09:00:00Z"), event("3", at="2024-01-05T12:31:00Z"))
    query = queries.start_window_table(minutes, f"{tmp_path}/out", f"{tmp_path}/cp", interval=None)
    query.awaitTermination()
    assert queries.dropped_rows(query) == 1


@pytest.mark.parametrize("salts", [0, 3])
def test_duplicates_across_batches(spark, inbox, tmp_path, salts):
    def sent(event_id, offset):
        return event(event_id, kafka_metadata={"topic": "t", "partition": 0, "offset": offset})

    stream = queries.valid_stream(read_event_files(spark, inbox.folder, max_files=1), salts=salts)
    kept = stream.select("event_id", "event_timestamp")
    inbox(sent("a", 1), sent("a", 2), sent("b", 3))
    inbox(sent("a", 4), sent("c", 5))
    rows = drain(spark, kept, tmp_path, "distinct")
    assert sorted(r["event_id"] for r in rows) == ["a", "b", "c"]


def test_clickstream_restarts_without_double_writes(spark, inbox, tmp_path):
    lake, checkpoint = f"{tmp_path}/lake", f"{tmp_path}/checkpoint"

    def run():
        stream = read_event_files(spark, inbox.folder)
        queries.start_clickstream(stream, lake, checkpoint, interval=None).awaitTermination()
        return read_events(spark, lake)

    inbox(event("1"), event("1"), event("2"), "{broken", event("3", at="never"))
    assert sorted(r["event_id"] for r in run().collect()) == ["1", "2"]
    inbox(event("2"), event("4"))
    assert sorted(r["event_id"] for r in run().collect()) == ["1", "2", "4"]
    hourly = spark.read.parquet(metric_path(f"{lake}/processed", "hourly"))
    assert hourly.agg(F.sum("total_events")).first()[0] == 3


def test_nothing_is_lost_and_topics_stay_apart(spark, inbox, tmp_path):
    """Raw and quarantine together hold the input: late, repeated, malformed, after a new start."""
    lake = f"{tmp_path}/lake"

    def run(topic, checkpoint):
        stream = read_event_files(spark, inbox.folder, max_files=1)
        for start, name in ((queries.start_clickstream, "c"), (queries.start_quarantine, "q")):
            start(stream, lake, f"{tmp_path}/{checkpoint}-{name}", topic, interval=None).awaitTermination()

    inbox(event("a", at="2024-01-05T12:00:00Z"), event("b", at="2024-01-05T12:01:00Z"))
    inbox(event("c", at="2024-01-05T14:00:00Z"), event("a", at="2024-01-05T12:00:00Z"))
    inbox(event("late", at="2024-01-05T11:50:00Z"), "{broken", event("n", user_id=None))
    for topic in ("one", "two"):
        run(topic, topic)
    run("one", "other")  # a new checkpoint adds its batches and replaces none
    for topic, copies in (("one", 2), ("two", 1)):
        raw = spark.read.parquet(raw_path(f"{lake}/raw", topic))
        found = sorted(r["event_id"] for r in raw.collect())
        assert found == sorted(["a", "a", "b", "c", "late"] * copies)
        rejected = spark.read.parquet(quarantine_path(f"{lake}/raw", topic))
        assert rejected.count() == 2 * copies
        hourly = spark.read.parquet(metric_path(f"{lake}/processed", "hourly", topic))
        assert {r["event_hour"]: r["total_events"] for r in hourly.collect()} == {11: 1, 12: 2, 14: 1}


@pytest.mark.parametrize("cut", [1, 2, 5])
def test_streamed_metrics_are_those_of_one_batch(spark, inbox, tmp_path, cut):
    rows = [
        event(str(k), ("page_view", "add_to_cart", "purchase", "search")[k % 4], f"2024-01-0{5 + k % 2}T{10 + k % 5}:00:00Z",
              user_id=f"u{k % 2}", session_id=f"s{k % 2}", product_id=f"P{k % 3}")
        for k in range(10)
    ]
    for k in range(0, 10, -(-10 // cut)):
        inbox(*rows[k : k + -(-10 // cut)])
    stream = read_event_files(spark, inbox.folder, max_files=1)
    queries.start_clickstream(stream, f"{tmp_path}/s", f"{tmp_path}/cp", interval=None).awaitTermination()
    process_batch(events_frame(spark, *rows), f"{tmp_path}/b", "b1")
    for name in ("sessions", "products", "hourly", "categories", "devices"):
        streamed, whole = (spark.read.parquet(metric_path(f"{tmp_path}/{x}/processed", name)) for x in "sb")
        assert_same(streamed.select(*whole.columns), whole)


def test_merged_metrics_of_a_stream(spark, inbox, tmp_path):
    """Cells of micro-batches, with copies in other batches, late events and a restart, against one batch."""
    rows = [
        event(str(k), ("page_view", "add_to_cart", "purchase", "search")[k % 4], f"2024-01-0{5 + k % 2}T{10 + k % 5}:00:00Z",
              user_id=f"u{k % 2}", session_id=f"s{k % 2}", product_id=f"P{k % 3}")
        for k in range(12)
    ]
    lake, days = f"{tmp_path}/s", [(2024, 1, 5), (2024, 1, 6)]

    def run():
        stream = read_event_files(spark, inbox.folder, max_files=1)
        queries.start_clickstream(stream, lake, f"{tmp_path}/cp", interval=None, refresh="merge").awaitTermination()

    inbox(*rows[6:], rows[7])
    inbox(*rows[:4], rows[8])
    run()
    inbox(*rows[4:6], rows[0])
    run()
    process_batch(events_frame(spark, *rows), f"{tmp_path}/b", "b1")
    merged = current_metrics(spark, lake, days)
    for name in ("sessions", "products", "hourly", "categories", "devices"):
        whole = spark.read.parquet(metric_path(f"{tmp_path}/b/processed", name))
        columns = merged[name].columns
        assert_same(merged[name].select(*columns), whole.select(*columns))
    assert read_events(spark, lake).count() == 12


def test_quarantine_gives_reasons(spark, inbox, tmp_path):
    inbox(event("1"), "{broken", event("3", at="never"), event("4", user_id=None))
    stream = read_event_files(spark, inbox.folder)
    lake = f"{tmp_path}/lake"
    queries.start_quarantine(stream, lake, f"{tmp_path}/cp", interval=None).awaitTermination()
    rows = spark.read.parquet(f"{lake}/raw/quarantine").collect()
    assert sorted(r["reason"] for r in rows) == [
        "failed validation", "malformed JSON", "unparsable timestamp",
    ]


def test_every_window_metric_runs_on_a_stream(spark, inbox, tmp_path):
    inbox(
        event("1"),
        event("2", "purchase", total_value=7.5),
        event("3", user_id=None),
        event("4", at="2024-01-05T18:00:00Z"),
    )
    source = read_event_files(spark, inbox.folder)
    valid = queries.valid_stream(source)

    def at_ten(rows):
        return [r for r in rows if str(r["window_start"]) == "2024-01-05 10:00:00"]

    revenue = at_ten(drain(spark, windows.revenue_per_hour(valid), tmp_path, "revenue"))
    assert [r["revenue"] for r in revenue] == [7.5]
    users = at_ten(drain(spark, windows.active_users(valid), tmp_path, "users"))
    assert [(r["active_users"], r["status"]) for r in users] == [(1, "red")]
    rate = drain(spark, windows.event_rate(valid), tmp_path, "rate")
    assert sum(r["total_events"] for r in rate) == 10
    conversion = at_ten(drain(spark, windows.conversion_window(valid), tmp_path, "conversion"))
    assert [r["conversion_rate_pct"] for r in conversion] == [100.0]
    errors = drain(spark, windows.error_rate(queries.flagged_stream(source)), tmp_path, "errors")
    assert sum(r["rejected_events"] for r in errors) == 5
    timed = valid.withColumn("processed_at", F.to_timestamp(F.lit("2024-01-05 10:00:02")))
    latency = at_ten(drain(spark, windows.pipeline_latency(timed), tmp_path, "latency"))
    assert [r["p50_seconds"] for r in latency] == [2.0]


def test_every_rejected_message_counts_in_the_error_rate(spark, tmp_path):
    """Malformed, undated and invalid messages, by broker time where they have no other."""
    folder = tmp_path / "messages"
    folder.mkdir()
    values = [json.dumps(event("1")), "{broken", json.dumps(event("2", at="never")), json.dumps(event("3", user_id=None))]
    sent = [{"value": v, "topic": "t", "partition": 0, "offset": k, "timestamp": "2024-01-05T10:00:00Z"} for k, v in enumerate(values)]
    sent.append({**sent[0], "value": json.dumps(event("4", at="2024-01-05T18:00:00Z"))})
    (folder / "a.json").write_text("\n".join(map(json.dumps, sent)))
    schema = "key BINARY, value STRING, topic STRING, `partition` INT, offset BIGINT, timestamp TIMESTAMP"
    stream = decode_messages(spark.readStream.schema(schema).json(str(folder)))
    errors = drain(spark, windows.error_rate(queries.flagged_stream(stream)), tmp_path, "errors")
    assert sum(r["rejected_events"] for r in errors) == 15


def test_topics_go_to_their_jobs(spark, tmp_path):
    folder = tmp_path / "messages"
    folder.mkdir()
    topics = ["retail_clickstream", "retail_transactions", "retail_clickstream", "unknown"]
    (folder / "a.json").write_text("\n".join(json.dumps({"topic": t}) for t in topics))
    seen = {}

    def handler(name):
        return lambda rows, number: seen.update({name: rows.count()})

    jobs = ("clickstream-processing-job", "transaction-processing-job", "default-processing-job")
    stream = spark.readStream.schema("topic STRING").json(str(folder))
    handlers = {job: handler(job) for job in jobs}
    queries.start_router(stream, handlers, f"{tmp_path}/cp", None).awaitTermination()
    assert seen == dict(zip(jobs, (2, 1, 1)))
