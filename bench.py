"""Benchmark: every registered query, the batch job, BI reports and the stream.

Prints one JSON line. `value` is the sum of the queries' times, each the median of BENCH_REPEAT
runs (3 by default, the first of which also warms up). The model queries reuse the fitted models,
whose training time is listed once as `train_models`. `rates` has events per second of the batch
job and of the clickstream job from JSON files to raw events and mergeable metrics, the 95th
percentile of the seconds that the latter takes for a micro-batch, and the seconds it takes to write
the metric tables of all days from the merged metrics.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from tidestream.operators import predictions
from tidestream.operators.enrich import add_day_partitions, add_event_time
from tidestream.plans import catalog
from tidestream.plans.batch import process_batch, publish_days
from tidestream.session import local_session
from tidestream.sinks.warehouse import create_predictions_table, load_predictions
from tidestream.sources import testdata
from tidestream.sources.messages import read_event_files
from tidestream.streaming.queries import start_clickstream

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEAT = int(os.environ.get("BENCH_REPEAT", "3"))
MODEL_QUERIES = (
    "score_lr",
    "score_gbt",
    "model_metrics",
    "champion",
    "feature_importance",
    "scored_sessions",
    "prediction_export",
)


def run(frame) -> None:
    """Compute every row and column, keep nothing."""
    frame.write.format("noop").mode("overwrite").save()


def seconds(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def note(name: str, value: float) -> None:
    print(f"{name:24s} {value:8.3f}", file=sys.stderr, flush=True)


def bench_queries(spark) -> dict[str, float]:
    times = {}
    for name, query in catalog.QUERIES.items():
        if name in MODEL_QUERIES:
            continue
        times[name] = statistics.median(seconds(lambda: run(query(spark, SF_DIR))) for _ in range(REPEAT))
        note(name, times[name])
    times["train_models"] = seconds(lambda: catalog._models(spark, SF_DIR))
    note("train_models", times["train_models"])
    for name in MODEL_QUERIES:
        query = catalog.QUERIES[name]
        times[name] = statistics.median(seconds(lambda: run(query(spark, SF_DIR))) for _ in range(REPEAT))
        note(name, times[name])
    return times


def bench_reports(spark) -> dict[str, float]:
    """The BI reports over the stored prediction table."""
    create_predictions_table(spark, "bench_predictions")
    load_predictions(catalog._rule_predictions(spark, SF_DIR), "bench_predictions")
    stored = spark.table("bench_predictions")
    times = {}
    for report in (
        predictions.bucket_distribution,
        predictions.funnel_by_device,
        predictions.high_value_sessions,
        predictions.model_by_hour,
    ):
        run(report(stored))
        times[report.__name__] = statistics.median(
            seconds(lambda: run(report(stored))) for _ in range(REPEAT)
        )
        note("report " + report.__name__, times[report.__name__])
    return times


def bench_jobs(spark, work: str) -> dict[str, float]:
    """Events per second of the batch job and of the clickstream job, storage included."""
    events = testdata.clickstream(spark, SF_DIR)
    events.repartition(8).write.parquet(f"{work}/events")
    stored = spark.read.parquet(f"{work}/events")
    total = stored.count()
    names = [f"bench{k}" for k in range(REPEAT)]
    batch = statistics.median(seconds(lambda: process_batch(stored, f"{work}/{n}", n).collect()) for n in names)

    # Files follow each other in time, as they would arrive; the first run is for warming up. A batch
    # takes four of eight files: what arrives in five seconds at 10,000 events a second.
    stored.repartitionByRange(8, "timestamp").write.json(f"{work}/json")

    def stream(name: str):
        source = read_event_files(spark, f"{work}/json", max_files=4)
        query = start_clickstream(source, f"{work}/{name}", f"{work}/{name}-checkpoint", interval=None, refresh="merge")
        query.awaitTermination()
        return query

    stream("warm")
    start = time.perf_counter()
    query = stream("stream")
    streamed = time.perf_counter() - start
    days = {tuple(day) for day in add_day_partitions(add_event_time(stored)).select("year", "month", "day").distinct().collect()}
    published = seconds(lambda: publish_days(spark, f"{work}/stream", days))
    latencies = sorted(p["durationMs"]["triggerExecution"] / 1000 for p in query.recentProgress if p["numInputRows"])
    rates = {
        "batch_events_per_sec": total / batch,
        "clickstream_events_per_sec": total / streamed,
        "publish_days_sec": published,
        "clickstream_p95_batch_sec": latencies[int(0.95 * (len(latencies) - 1))],
    }
    for name, value in rates.items():
        note(name, value)
    return rates


def main() -> None:
    work = tempfile.mkdtemp(prefix="tidestream-bench-")
    settings = {"spark.driver.memory": "12g", "spark.sql.warehouse.dir": f"{work}/warehouse"}
    spark = local_session(CPUS, "tidestream-bench", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    queries = bench_queries(spark)
    reports = bench_reports(spark)
    rates = bench_jobs(spark, work)
    spark.stop()
    result = {
        "metric": "all registered queries, warm",
        "value": round(sum(queries.values()), 3),
        "unit": "sec",
        "queries": {name: round(t, 3) for name, t in queries.items()},
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "bi_reports": {name: round(t, 3) for name, t in reports.items()},
        "rates": {name: round(r, 2) for name, r in rates.items()},
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
