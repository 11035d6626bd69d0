"""Versions, runs that die, compaction, and metrics merged from cells."""

from __future__ import annotations

import datetime as dt
import os
import threading

import pytest
from helpers import assert_same, event, events_frame, item
from pyspark.sql import functions as F

from tidestream.plans import batch as jobs
from tidestream.plans.batch import compact_cells, current_metrics, daily_job, process_batch, publish_days, raw_schema, read_events, rebuild_cells, store_batch, sweep_days
from tidestream.sinks import lake, raw
from tidestream.sinks.versions import STATE_EVERY, Files, VersionLog
from tidestream.sources.lake import read_folder

DAY = (2024, 1, 5)
NIGHT = (2024, 1, 6, 0)


def stored_ids(spark, path, **options):
    rows = raw.read_raw(spark, f"{path}/raw", raw_schema(spark), **options).collect()
    return sorted((r["batch_id"], r["event_id"]) for r in rows)


def test_commits_of_several_writers_are_all_kept(spark, tmp_path):
    def write(k):
        log = VersionLog(spark, str(tmp_path))
        for j in range(30):
            log.commit(lambda state: {"set": {f"{k}-{j}": len(state)}})

    threads = [threading.Thread(target=write, args=(k,)) for k in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    version, state = VersionLog(spark, str(tmp_path)).read()
    assert version == 120 and sorted(state.values()) == list(range(120))


def test_versions_are_read_from_the_last_whole_state(spark, tmp_path):
    log, late = VersionLog(spark, str(tmp_path)), VersionLog(spark, str(tmp_path))
    assert log.read() == (0, {}) and late.read() == (0, {})
    for k in range(3 * STATE_EVERY + 2):
        log.commit(lambda state: {"set": {"n": k}, "drop": ["m"]} if k % 2 else {"set": {"m": k}})
    names = log.files.names()
    assert f"change-{1:012}.json" not in names and f"state-{3 * STATE_EVERY:012}.json" in names
    assert late.read() == VersionLog(spark, str(tmp_path)).read() == log.read()
    assert log.commit(lambda state: None) is None


def test_files_are_created_once(spark, tmp_path):
    files = Files(spark, f"{tmp_path}/deep")
    assert files.names() == [] and files.read("a") is None
    assert files.create("a", "é") and not files.create("a", "b") and files.read("a") == "é"
    assert files.names() == ["a"] and files.age("a", 1e12) > 0


STEPS = ("write_parts", "notes", "before", "after")


@pytest.mark.parametrize("step", STEPS)
def test_a_batch_that_dies_and_is_repeated_with_other_rows(spark, tmp_path, monkeypatch, step):
    """Killed while or after it writes, before or after its version: the last input counts."""
    path = str(tmp_path)
    process_batch(events_frame(spark, event("0", at="2024-01-05T10:00:00Z")), path, "other")
    first = events_frame(spark, event("1", at="2024-01-05T10:00:00Z"), event("2", at="2024-01-05T11:00:00Z"))

    class Died(Exception):
        pass

    def die(*args, **kwargs):
        raise Died

    with monkeypatch.context() as patch:
        if step == "write_parts":
            write = raw.write_parts
            patch.setattr(raw, "write_parts", lambda *a: (write(*a), die()))
        elif step == "notes":
            create = Files.create
            patch.setattr(Files, "create", lambda self, name, text: die() if name.startswith("b1/") else create(self, name, text))
        elif step == "before":
            patch.setattr(VersionLog, "commit", die)
        else:
            patch.setattr(raw, "delete_parts", die)
        with pytest.raises(Died):
            process_batch(first, path, "b1")
    seen = [("other", "0")] + ([("b1", "1"), ("b1", "2")] if step == "after" else [])
    assert stored_ids(spark, path) == sorted(seen)  # a reader sees the run whole or not at all
    second = events_frame(spark, event("3", at="2024-01-05T10:00:00Z"))
    process_batch(second, path, "b1")
    assert stored_ids(spark, path) == [("b1", "3"), ("other", "0")]
    hourly = read_folder(spark, lake.metric_path(f"{path}/processed", "hourly"))
    assert {r.event_hour: r.total_events for r in hourly.collect()} == {10: 2}
    raw.sweep(spark, f"{path}/raw", [DAY], older_than=0.0)
    left = read_folder(spark, lake.raw_path(f"{path}/raw"))
    assert sorted(r.event_id for r in left.collect()) == ["0", "3"]


def test_reading_lists_the_wanted_days_only(spark, tmp_path):
    path = str(tmp_path)
    rows = [event(str(d), at=f"2024-01-{d:02}T10:00:00Z") for d in range(1, 8)]
    process_batch(events_frame(spark, *rows), path, "b1")
    two = raw.read_raw(spark, f"{path}/raw", raw_schema(spark), at=[(2024, 1, 4), (2024, 1, 5)])
    assert sorted(r.event_id for r in two.collect()) == ["4", "5"]
    assert len(two.inputFiles()) == 2
    hour = raw.read_raw(spark, f"{path}/raw", raw_schema(spark), at=[(2024, 1, 4, 10), (2024, 1, 5, 9)])
    assert hour.count() == 1
    assert raw.read_raw(spark, f"{path}/raw", raw_schema(spark), topic="none").count() == 0


def test_compaction_of_closed_hours(spark, tmp_path):
    """Many batches become one part an hour; open hours, undated rows and repeats are as they were."""
    path, root = str(tmp_path), f"{tmp_path}/raw"
    times = ["2024-01-05T10:00:00Z", "2024-01-05T11:00:00Z", "2024-01-06T01:00:00Z", "never"]
    for k in range(4):
        rows = [event(f"{k}-{j}", at=t) for j, t in enumerate(times)]
        store_batch(events_frame(spark, *rows), path, f"b{k}", refresh=False)
    before = stored_ids(spark, path)
    assert raw.compact_hours(spark, root, raw_schema(spark), NIGHT) == {(*DAY, 10), (*DAY, 11)}
    assert stored_ids(spark, path) == before
    _, state = raw.table_log(spark, root).read()
    parts = {}
    for e in state.values():
        parts.setdefault(tuple(e["at"]), []).append(e["batch"])
    assert parts[(*DAY, 10)] == [None] and parts[(*DAY, 11)] == [None]
    assert sorted(parts[(2024, 1, 6, 1)]) == ["b0", "b1", "b2", "b3"] == sorted(parts[(None,) * 4])
    assert raw.compact_hours(spark, root, raw_schema(spark), NIGHT) == set()  # nothing is left to do

    # A repeat replaces its rows in the compacted hours as well, also by none and by other hours.
    store_batch(events_frame(spark, event("new", at=times[0])), path, "b1", refresh=False)
    left = [row for row in before if row[0] != "b1"]
    assert stored_ids(spark, path) == sorted([*left, ("b1", "new")])
    store_batch(events_frame(spark), path, "b2", refresh=False)
    left = [row for row in left if row[0] != "b2"]
    assert stored_ids(spark, path) == sorted([*left, ("b1", "new")])
    assert raw.compact_hours(spark, root, raw_schema(spark), NIGHT) == {(*DAY, 10), (*DAY, 11)}
    assert stored_ids(spark, path) == sorted([*left, ("b1", "new")])
    # b1 is repeated once more, after it was compacted for the second time.
    store_batch(events_frame(spark, event("newer", at=times[1])), path, "b1", refresh=False)
    assert stored_ids(spark, path) == sorted([*left, ("b1", "newer")])
    assert raw.sweep(spark, root, [DAY], older_than=3600.0) == []
    assert raw.sweep(spark, root, [DAY], older_than=0.0)
    assert stored_ids(spark, path) == sorted([*left, ("b1", "newer")])


def test_compaction_gives_way_to_a_repeat(spark, tmp_path, monkeypatch):
    """A part that is replaced while its hour is rewritten keeps its new rows."""
    path, root = str(tmp_path), f"{tmp_path}/raw"
    for k in range(2):
        store_batch(events_frame(spark, event(f"{k}")), path, f"b{k}", refresh=False)
    write = raw.write_parts

    def meanwhile(*args):
        filled = write(*args)
        monkeypatch.setattr(raw, "write_parts", write)
        store_batch(events_frame(spark, event("other")), path, "b1", refresh=False)
        return filled

    monkeypatch.setattr(raw, "write_parts", meanwhile)
    assert raw.compact_hours(spark, root, raw_schema(spark), NIGHT) == set()
    assert stored_ids(spark, path) == [("b0", "0"), ("b1", "other")]
    assert raw.compact_hours(spark, root, raw_schema(spark), NIGHT) == {(*DAY, 10)}


def test_daily_reports_of_two_topics(spark, tmp_path):
    path = str(tmp_path)
    loaded = F.to_timestamp(F.lit("2024-01-05 10:30:00"))
    for topic, count in (("one", 2), ("two", 1)):
        rows = [event(str(k)) for k in range(count)] + [event("y", at="2024-01-04T09:00:00Z")]
        process_batch(events_frame(spark, *rows), path, "b1", topic, processed_at=loaded)
        daily_job(spark, path, "2024-01-05 11:00:00", topic)

    def report():
        rows = read_folder(spark, f"{path}/curated/daily_summary").collect()
        return {(r.topic, str(r.report_date)): r.total_events for r in rows}

    assert report() == {("one", "2024-01-05"): 2, ("two", "2024-01-05"): 1, ("one", "2024-01-04"): 1, ("two", "2024-01-04"): 1}
    process_batch(events_frame(spark, event("1")), path, "b1", "one", processed_at=loaded)
    daily_job(spark, path, "2024-01-05 11:00:00", "one")
    assert report() == {("one", "2024-01-05"): 1, ("two", "2024-01-05"): 1, ("two", "2024-01-04"): 1}


def busy_day(n=60):
    kinds = ("page_view", "add_to_cart", "purchase", "search")
    rows = []
    for k in range(n):
        fields = {"user_id": f"u{k % 7}", "session_id": f"s{k % 9}", "product_id": f"P{k % 5}", "product_price": 1.0 + k % 5}
        if kinds[k % 4] == "purchase" and k % 3:
            fields |= {"product_id": None, "product_category": None, "product_price": None}
            fields["cart_items"] = [item(f"P{k % 5}", 2.5, 2), item("P9", 4.0, 1, "Clothing")]
        if k % 11 == 0:
            fields |= {"device_info": None, "product_name": f"name {k}"}
        rows.append(event(str(k), kinds[k % 4], f"2024-01-0{5 + k % 2}T{8 + k % 6:02}:{k % 60:02}:00Z", **fields))
    return rows


def same_metrics(merged, whole):
    for name, frame in whole.items():
        columns = [c for c in frame.columns if c not in ("year", "month", "day")]
        assert set(columns) == set(merged[name].columns)
        doubles = {f.name for f in frame.schema.fields if f.dataType.simpleString() == "double"}
        rounded = [F.round(c, 9).alias(c) if c in doubles else F.col(c) for c in columns]
        assert_same(merged[name].select(*rounded), frame.select(*rounded))


@pytest.mark.parametrize("cut", [1, 7])
def test_merged_cells_give_the_metrics_of_the_day(spark, tmp_path, cut):
    """Whatever the cut into batches, after a repeat, a compaction, and a repeat of what was compacted."""
    path, days = str(tmp_path), [DAY, (2024, 1, 6)]
    rows = busy_day()
    for k in range(cut):
        store_batch(events_frame(spark, *rows[k::cut]), path, f"b{k}", refresh="merge")
    store_batch(events_frame(spark, event("gone", user_id="nobody")), path, "x", refresh="merge")
    store_batch(events_frame(spark), path, "x", refresh="merge")
    whole = jobs.metric_frames(read_events(spark, path))
    same_metrics(current_metrics(spark, path, days), whole)
    if cut > 1:
        assert compact_cells(spark, path, days) == days and compact_cells(spark, path, days) == []
        assert len(sweep_days(spark, path, days, older_than=0.0)) >= 2 * 2 * cut  # two tables of two days
        same_metrics(current_metrics(spark, path, days), whole)
        store_batch(events_frame(spark, *rows[1::cut][:3]), path, "b1", refresh="merge")
        same_metrics(current_metrics(spark, path, days), jobs.metric_frames(read_events(spark, path)))
    publish_days(spark, path, days)
    published = {n: read_folder(spark, lake.metric_path(f"{path}/processed", n)) for n in whole}
    same_metrics({n: f.drop("year", "month", "day") for n, f in published.items()}, jobs.metric_frames(read_events(spark, path)))


def test_a_merge_batch_reads_nothing_else(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    monkeypatch.setattr(raw, "read_raw", lambda *a, **k: pytest.fail("a batch has read the raw table"))
    monkeypatch.setattr(raw, "read_parts", lambda *a, **k: pytest.fail("a batch has read cells"))
    for k in range(3):
        store_batch(events_frame(spark, event(str(k))), path, f"b{k}", refresh="merge")


def test_copies_of_other_batches_until_the_day_is_made_again(spark, tmp_path):
    path = str(tmp_path)
    for k in range(2):
        store_batch(events_frame(spark, event("1"), event(f"own {k}")), path, f"b{k}", refresh="merge")
    assert [r.total_events for r in current_metrics(spark, path, [DAY])["hourly"].collect()] == [4]
    rebuild_cells(spark, path, [DAY])
    assert [r.total_events for r in current_metrics(spark, path, [DAY])["hourly"].collect()] == [3]
    store_batch(events_frame(spark, event("9")), path, "b2", refresh="merge")
    assert [r.total_events for r in current_metrics(spark, path, [DAY])["hourly"].collect()] == [4]
    store_batch(events_frame(spark, event("own 0")), path, "b0", refresh="merge")  # held in the day made again
    assert [r.total_events for r in current_metrics(spark, path, [DAY])["hourly"].collect()] == [4]


def test_sketches_of_many_users_are_near(spark, tmp_path):
    events = spark.range(20_000).select(
        F.col("id").cast("string").alias("event_id"),
        F.lit("page_view").alias("event_type"),
        F.lit("2024-01-05T10:00:00Z").alias("timestamp"),
        F.concat(F.lit("u"), F.col("id") % 9000).alias("user_id"),
        F.concat(F.lit("s"), F.col("id") % 15_000).alias("session_id"),
        F.lit("P1").alias("product_id"),
    )
    for k in range(3):
        store_batch(events.where(F.col("event_id").cast("long") % 3 == k), str(tmp_path), f"b{k}", refresh="merge")
    (hour,) = current_metrics(spark, str(tmp_path), [DAY])["hourly"].collect()
    assert hour.total_events == 20_000
    assert abs(hour.unique_users / 9000 - 1) < 0.05 and abs(hour.unique_sessions / 15_000 - 1) < 0.05


def test_freshness_lists_two_days(spark, tmp_path, monkeypatch):
    """Other days may be many folders; they are not even looked at."""
    path = str(tmp_path)
    loaded = F.to_timestamp(F.lit("2024-01-05 10:30:00"))
    process_batch(events_frame(spark, event("1"), event("2", at="2023-12-01T10:00:00Z")), path, "b1", processed_at=loaded)
    old = lake.part_path(lake.raw_path(f"{path}/raw"), (2023, 12, 1))
    os.chmod(old, 0)
    try:
        assert daily_job(spark, path, "2024-01-05 11:00:00")["status"] == "fresh"
    finally:
        os.chmod(old, 0o755)
    assert dt.date(2024, 1, 5) in {r.report_date for r in read_folder(spark, f"{path}/curated/daily_summary").collect()}
