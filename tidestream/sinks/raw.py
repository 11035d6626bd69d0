"""The raw event table: hourly folders whose live parts are named by versions.

Every run of a batch writes its rows into parts of its own, year/month/day/hour/part=<run>. They
exist for readers once a version names them, for all hours at once; the same version takes away what
an earlier run of the batch had written. A run that dies before its version leaves nothing that is
read, whatever it has written. `compact_hours` replaces the many parts of closed hours by a few files
in the same way, and a batch that is repeated after that is masked out of them.

`read_raw` reads the live parts and lists no folder but theirs. A reader that goes over the folders
themselves sees the same rows except while a job runs, after one that died, or between a
compaction and the `sweep` that deletes what it has replaced.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidestream.constants import CLICKSTREAM_TOPIC
from tidestream.operators.enrich import PARTITION_COLUMNS, add_time_partitions
from tidestream.sinks.lake import Parts, part_path, raw_path, write_partitions
from tidestream.sinks.versions import Files, VersionLog

RAW = "raw"


def table_log(spark: SparkSession, root: str, topic: str = CLICKSTREAM_TOPIC) -> VersionLog:
    return VersionLog(spark, f"{root.rstrip('/')}/versions/{topic}")


def new_run() -> str:
    return uuid.uuid4().hex


def write_parts(df: DataFrame, path: str, columns: Iterable[str], run: str) -> set[Parts]:
    """Rows into parts of this run below their partitions; returns the partitions that got rows."""
    named = df.withColumn("part", F.lit(run))
    filled = write_partitions(named, path, [*columns, "part"], partitionOverwriteMode="dynamic")
    return {part[:-1] for part in filled}


def entries(path: str, root: str, table: str, filled: set[Parts], run: str, batch_id: str | None) -> dict[str, dict]:
    """What a version says of new parts: the folder below `root`, its table, partition and batch."""
    below = path.removeprefix(root.rstrip("/")).lstrip("/")
    return {
        f"{part_path(below, at)}/part={run}": {"table": table, "at": list(at), "batch": batch_id, "masked": []}
        for at in filled
    }


def _hours_before(notes: Files, batch_id: str) -> set[Parts]:
    """All hours that any run of the batch may have written."""
    texts = [notes.read(f"{batch_id}/{name}") for name in notes.names(batch_id) if not name.startswith(".")]
    return {tuple(hour) for text in texts if text for hour in json.loads(text)}


def commit_batch(
    spark: SparkSession, root: str, batch_id: str, added: Mapping[str, dict], topic: str = CLICKSTREAM_TOPIC
) -> tuple[set[Parts], list[Parts]]:
    """Make the parts of a batch's run live in place of its earlier ones.

    The hours are noted first, so that a repeat knows in which compacted hours it has rows. Returns
    the hours touched, and the days whose merged cells hold an earlier run and must be made again.
    """
    notes = Files(spark, f"{root.rstrip('/')}/batches/{topic}")
    before = _hours_before(notes, batch_id)
    hours = {tuple(e["at"]) for e in added.values() if e["table"] == RAW}
    if hours - before:
        notes.create(f"{batch_id}/{new_run()}.json", json.dumps(sorted(map(list, hours | before), key=repr)))
    days = {hour[:3] for hour in before}
    touched, stale, dropped = set(), set(), []

    def build(state: dict) -> dict:
        touched.clear(), stale.clear(), dropped.clear()
        dropped.extend(k for k, e in state.items() if e["batch"] == batch_id and k not in added)
        touched.update(tuple(state[k]["at"]) for k in dropped if state[k]["table"] == RAW)
        masked = {}
        for key, e in state.items():
            if e["batch"] is None and e["table"] == RAW and tuple(e["at"]) in before:
                masked[key] = {**e, "masked": sorted({*e["masked"], batch_id})}
                touched.add(tuple(e["at"]))
            elif e["batch"] is None and e["table"] != RAW and tuple(e["at"]) in days:
                masked[key] = {**e, "stale": True}
                stale.add(tuple(e["at"]))
        return {"drop": list(dropped), "set": {**masked, **added}}

    table_log(spark, root, topic).commit(build)
    delete_parts(spark, root, dropped)
    return hours | touched, sorted(stale, key=repr)


def delete_parts(spark: SparkSession, root: str, folders: Iterable[str]) -> None:
    files = Files(spark, root)
    for folder in folders:
        files.delete(folder)


def write_raw(
    events: DataFrame, root: str, batch_id: str, topic: str = CLICKSTREAM_TOPIC, more: Callable[[str], Mapping[str, dict]] | None = None
) -> tuple[set[Parts], set[Parts], list[Parts]]:
    """Enriched events of a batch by hour; returns the hours filled, the hours touched and stale days.

    Touched are also the hours that an earlier run of this batch had filled. `more` may write other
    parts of the same run meanwhile, which become live with the events.
    """
    path, run = raw_path(root, topic), new_run()
    dated = add_time_partitions(events).drop("batch_id").withColumn("batch_id", F.lit(batch_id))
    with ThreadPoolExecutor(1) as pool:
        others = pool.submit(inheritable_thread_target(events.sparkSession)(more), run) if more else None
        filled = write_parts(dated, path, PARTITION_COLUMNS, run)
        added = entries(path, root, RAW, filled, run, batch_id)
        if others:
            added.update(others.result())
    touched, stale = commit_batch(events.sparkSession, root, batch_id, added, topic)
    return filled, touched, stale


def live_parts(state: dict, table: str, at: Iterable[Parts] | None = None, batch_id: str | None = None) -> dict[str, dict]:
    """The entries of a table, of some partitions (days or hours) or of one batch."""
    wanted = None if at is None else {tuple(p) for p in at}
    lengths = {len(p) for p in wanted or ()}
    return {
        key: e
        for key, e in state.items()
        if e["table"] == table
        and (batch_id is None or e["batch"] == batch_id)
        and (wanted is None or any(tuple(e["at"][:n]) in wanted for n in lengths))
    }


def read_parts(spark: SparkSession, root: str, path: str, parts: Mapping[str, dict], schema: T.StructType) -> DataFrame:
    """The rows of live parts of a table, masked batches left out; no other folder is listed."""
    by_mask: dict[tuple, list[str]] = {}
    for key, e in sorted(parts.items()):
        by_mask.setdefault(tuple(e["masked"]), []).append(f"{root.rstrip('/')}/{key}")
    frames = []
    for masked, folders in by_mask.items():
        rows = spark.read.schema(schema).option("basePath", path).parquet(*folders).select(*schema.names)
        frames.append(rows.where(~F.col("batch_id").isin(*masked)) if masked else rows)
    return reduce(DataFrame.unionByName, frames) if frames else spark.createDataFrame([], schema)


def read_raw(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    topic: str = CLICKSTREAM_TOPIC,
    at: Iterable[Parts] | None = None,
    batch_id: str | None = None,
) -> DataFrame:
    """The live raw events, of some days or hours (`at`) or of one batch."""
    _, state = table_log(spark, root, topic).read()
    return read_parts(spark, root, raw_path(root, topic), live_parts(state, RAW, at, batch_id), schema)


def compact_hours(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    closed_before: Parts,
    topic: str = CLICKSTREAM_TOPIC,
    least_parts: int = 2,
) -> set[Parts]:
    """Rewrite the closed hours that have several parts, a day at a time; returns the hours rewritten.

    Hours before `closed_before` (year, month, day, hour) are closed. Every row stays, with its batch. A
    batch that arrives meanwhile keeps its own part; if one of the rewritten parts is replaced
    meanwhile, the day is left for the next time.
    """
    log, path, done = table_log(spark, root, topic), raw_path(root, topic), set()
    _, state = log.read()
    by_hour: dict[Parts, dict] = {}
    for key, e in live_parts(state, RAW).items():
        by_hour.setdefault(tuple(e["at"]), {})[key] = e
    old = {
        hour: parts
        for hour, parts in by_hour.items()
        if None not in hour and hour < tuple(closed_before) and (len(parts) >= least_parts or any(e["masked"] for e in parts.values()))
    }
    for day in sorted({hour[:3] for hour in old}):
        chosen = {key: e for hour, parts in old.items() if hour[:3] == day for key, e in parts.items()}
        run = new_run()
        filled = write_parts(read_parts(spark, root, path, chosen, schema), path, PARTITION_COLUMNS, run)
        added = entries(path, root, RAW, filled, run, None)

        def build(now: dict, chosen=chosen, added=added) -> dict | None:
            if any(now.get(key) != e for key, e in chosen.items()):
                return None
            return {"drop": list(chosen), "set": added}

        if log.commit(build) is None:
            delete_parts(spark, root, added)
        else:
            done |= {hour for hour in old if hour[:3] == day}
    return done


def _parts_below(files: Files, folder: str) -> list[str]:
    found = []
    for name in files.names(folder):
        if name.startswith("part="):
            found.append(f"{folder}/{name}")
        elif "=" in name:
            found += _parts_below(files, f"{folder}/{name}")
    return found


def sweep(
    spark: SparkSession,
    root: str,
    days: Iterable[Parts],
    topic: str = CLICKSTREAM_TOPIC,
    older_than: float = 86_400.0,
    tables: Iterable[str] = (),
) -> list[str]:
    """Delete the parts of some days that no version names, written more than so many seconds ago.

    Those are parts that a compaction has replaced and parts of runs that died, of the raw table and of
    `tables`, further folders below the root. Give running readers and writers their time. Returns
    the folders deleted.
    """
    files, now, gone = Files(spark, root), time.time(), []
    for table in (raw_path("", topic).lstrip("/"), *tables):
        for day in days:
            gone += [key for key in _parts_below(files, part_path(table, day)) if files.age(key, now) >= older_than]
    # The versions are read after the folders, so a part that was live meanwhile is not among them.
    _, state = table_log(spark, root, topic).read()
    gone = [key for key in gone if key not in state]
    delete_parts(spark, root, gone)
    return gone
