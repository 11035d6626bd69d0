"""Summaries that merge, model metrics in one pass, and two writers of the registry."""

from __future__ import annotations

import json
import os
import random
import threading

import pytest
from helpers import event
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tidestream.operators import sketches
from tidestream.operators.propensity import Candidate, score_metrics
from tidestream.operators.registry import PRODUCTION, ModelRegistry
from tidestream.sources.messages import read_event_files
from tidestream.streaming import queries


def skewed_views(spark, n=20_000, products=400, minutes=30, seed=3):
    """Views of products with counts like 1/rank, over some minutes."""
    rng = random.Random(seed)
    weights = [1 / (k + 1) for k in range(products)]
    chosen = rng.choices(range(products), weights, k=n)
    rows = [(f"P{p}" if i % 50 else None, f"2024-01-05 10:{rng.randrange(minutes):02}:{rng.randrange(60):02}") for i, p in enumerate(chosen)]
    return spark.createDataFrame(rows, "product_id string, at string").withColumn("event_timestamp", F.to_timestamp("at"))


@pytest.mark.parametrize("kept", [15, 40])
def test_frequent_products_within_their_bounds(spark, kept):
    events = skewed_views(spark)
    minutes = sketches.product_minutes(events).cache()
    summaries = sketches.frequent_products(minutes, kept)
    true = {r.product_id: r.n for r in minutes.groupBy("product_id").agg(F.sum("views").alias("n")).collect()}
    bounds = {r.product_id: (r.at_least, r.at_most) for r in sketches.combined_products(summaries).collect()}
    assert all(low <= true[p] <= high for p, (low, high) in bounds.items())
    assert max(r.n for r in summaries.groupBy("window_start").agg(F.count("*").alias("n")).collect()) == kept
    best = sorted(true, key=lambda p: (-true[p], p))[:10]
    exact = sketches.top_products_exact(minutes, summaries)
    assert [(r.product_id, r.views) for r in exact.collect()] == [(p, true[p]) for p in best]
    live = sketches.top_products_live(summaries).collect()
    assert len(live) == 10 and {r.product_id for r in live} >= set(best[:5])
    half = sketches.in_span(summaries, "2024-01-05 10:05:00", "2024-01-05 10:10:00")
    assert {r.window_start.minute for r in half.collect()} == set(range(5, 10))
    minutes.unpersist()


def test_even_views_are_counted_whole(spark):
    """Where no product stands out the summaries can't name the candidates, and the result is still right."""
    rows = [(f"P{k % 97:02}", f"2024-01-05 10:{k % 20:02}:00") for k in range(2000)]
    events = spark.createDataFrame(rows, "product_id string, at string").withColumn("event_timestamp", F.to_timestamp("at"))
    minutes = sketches.product_minutes(events)
    summaries = sketches.frequent_products(minutes, 2)
    assert sketches.top_candidates(summaries) is None
    true = {}
    for product, _ in rows:
        true[product] = true.get(product, 0) + 1
    got = [(r.product_id, r.views) for r in sketches.top_products_exact(minutes, summaries).collect()]
    assert got == sorted(true.items(), key=lambda x: (-x[1], x[0]))[:10]


def test_frequent_products_of_few_or_no_views(spark):
    events = skewed_views(spark, 30, 3, 2)
    summaries = sketches.frequent_products(sketches.product_minutes(events))
    assert {r.left_out for r in summaries.collect()} == {0}
    assert all(r.at_least == r.at_most for r in sketches.combined_products(summaries).collect())
    nothing = sketches.frequent_products(sketches.product_minutes(events.limit(0)))
    assert sketches.top_products_live(nothing).collect() == []
    assert sketches.top_products_exact(sketches.product_minutes(events.limit(0)), nothing).collect() == []


def test_products_and_delays_of_a_stream(spark, tmp_path):
    """Minutes that a stream has closed, as a table, give the same top products and quantiles."""
    folder = tmp_path / "inbox"
    folder.mkdir()
    rng = random.Random(5)
    rows = [event(str(k), at=f"2024-01-05T10:{k // 40:02}:{k % 40:02}Z", product_id=f"P{min(int(rng.expovariate(0.3)), 30)}") for k in range(800)]
    rows.append(event("900", at="2024-01-05T12:00:00Z"))
    for k in range(3):
        (folder / f"{k}.json").write_text("\n".join(map(json.dumps, rows[k * 267 : (k + 1) * 267])))
        os.utime(folder / f"{k}.json", (1_700_000_000 + k,) * 2)
    stream = queries.valid_stream(read_event_files(spark, str(folder), max_files=1))
    late = F.expr("event_timestamp + make_interval(0, 0, 0, 0, 0, 0, cast(event_id as int) % 100)")
    timed = stream.withColumn("processed_at", late)
    frames = {"products": sketches.product_minutes(stream), "delays": sketches.delay_sketches(timed)}
    found = {}
    for name, frame in frames.items():
        queries.start_window_table(frame, f"{tmp_path}/{name}", f"{tmp_path}/{name}-cp", interval=None).awaitTermination()
        found[name] = spark.read.schema(frame.schema).parquet(f"{tmp_path}/{name}")
    true = {}
    for r in rows[:-1]:
        true[r["product_id"]] = true.get(r["product_id"], 0) + 1
    summaries = sketches.frequent_products(found["products"], 8)
    got = sketches.top_products_exact(found["products"], summaries, 3).collect()
    assert [(r.product_id, r.views) for r in got] == sorted(true.items(), key=lambda x: (-x[1], x[0]))[:3]
    queries.start_product_summaries(stream, f"{tmp_path}/live", f"{tmp_path}/live-cp", 8, interval=None).awaitTermination()
    live = spark.read.parquet(f"{tmp_path}/live")
    assert sorted(tuple(r) for r in live.drop("batch").collect()) == sorted(tuple(r) for r in summaries.collect())
    assert [r.product_id for r in sketches.top_products_live(live, 1).collect()] == [got[0].product_id]
    (hour,) = sketches.hourly_delays(found["delays"]).collect()
    assert hour.events == 800 and abs(hour.p50 - 49.5) <= 3 and abs(hour.p95 - 94.5) <= 3


def test_merged_quantiles_are_within_their_rank_error(spark):
    """Sketches of 40 minutes merged to hours and a day; ranks within 2 %, and no values give no row."""
    rows = spark.range(60_000).select(
        F.timestamp_seconds(F.lit(1_704_448_800) + F.col("id") % 7200).alias("event_timestamp"),
        (F.pmod(F.xxhash64("id"), F.lit(100_000)) / 100).alias("seconds"),
    )
    delayed = rows.withColumn("processed_at", F.timestamp_micros(F.unix_micros("event_timestamp") + (F.col("seconds") * 1e6).cast("long")))
    minutes = sketches.delay_sketches(delayed).cache()
    assert minutes.count() == 120
    for found, part in ((sketches.quantiles(minutes), rows), (sketches.hourly_delays(minutes), rows)):
        for r in found.collect():
            values = part if "hour" not in r else part.where(F.date_trunc("hour", "event_timestamp") == F.lit(r["hour"]))
            total = values.count()
            assert r.events == total
            for share, value in ((0.5, r.p50), (0.95, r.p95)):
                assert abs(values.where(F.col("seconds") <= value).count() / total - share) < 0.02
    scores = sketches.score_sketch(rows, "seconds").union(sketches.score_sketch(rows.limit(0), "seconds"))
    (both,) = sketches.quantiles(scores, shares={"p10": 0.1}).collect()
    assert both.events == 60_000 and abs(both.p10 - 100) < 20
    assert sketches.quantiles(sketches.score_sketch(rows.limit(0), "seconds")).collect() == []
    minutes.unpersist()


@pytest.mark.parametrize("levels, parts", [(10_000, 7), (9, 3), (1, 2)])
def test_model_metrics_are_those_of_the_evaluators(spark, levels, parts):
    """Areas, accuracy and F1 to nine digits, with many and with few distinct scores."""
    noise = F.pmod(F.xxhash64("id"), F.lit(levels)) / levels
    rows = spark.range(3000).select(
        F.when(F.col("id") % 5 == 0, "test").otherwise("train").alias("split"),
        (F.pmod(F.xxhash64("id", F.lit(2)), F.lit(1000)) / 1000 < noise).cast("double").alias("label"),
        noise.alias("p"),
        (noise > 0.6).cast("double").alias("prediction"),
    )
    scored = VectorAssembler(inputCols=["prediction", "p"], outputCol="rawPrediction").transform(rows).repartition(parts)
    got = score_metrics(scored)
    assert got == score_metrics(scored, "p")
    for split in ("train", "test"):
        part = scored.where(F.col("split") == split)
        for name, metric in (("auc", "areaUnderROC"), ("pr_auc", "areaUnderPR")):
            evaluator = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="p", metricName=metric, numBins=0)
            assert got[f"{split}_{name}"] == pytest.approx(evaluator.evaluate(part), abs=1e-9)
    test = scored.where("split = 'test'")
    for metric in ("accuracy", "f1"):
        evaluator = MulticlassClassificationEvaluator(labelCol="label", metricName=metric)
        assert got[f"test_{metric}"] == pytest.approx(evaluator.evaluate(test), abs=1e-9)


def test_model_metrics_without_rows_or_with_one_label(spark):
    schema = "split string, label double, prediction double, p double"
    assert set(score_metrics(spark.createDataFrame([], schema), "p").values()) == {0.0}
    one = score_metrics(spark.createDataFrame([("test", 1.0, 1.0, 0.5), ("train", 0.0, 0.0, 0.1)], schema), "p")
    assert (one["test_auc"], one["test_pr_auc"], one["train_auc"], one["train_pr_auc"]) == (1.0, 1.0, 0.0, 0.0)
    assert (one["test_accuracy"], one["test_f1"]) == (1.0, 1.0)


def test_two_writers_of_the_registry(spark, tmp_path):
    """Models registered and promoted at the same time get different versions; one is in Production."""
    model = PipelineModel(stages=[VectorAssembler(inputCols=["a"], outputCol="b")])
    seen, failed = [], []

    def work(k):
        registry = ModelRegistry(spark, str(tmp_path))
        for _ in range(3):
            version = registry.register(Candidate("logistic_regression", model), f"run{k}")
            seen.append(version)
            try:
                registry.promote(version)
            except Exception as error:  # noqa: BLE001
                failed.append(error)

    threads = [threading.Thread(target=work, args=(k,)) for k in range(2)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(seen) == [1, 2, 3, 4, 5, 6] and not failed
    registry = ModelRegistry(spark, str(tmp_path))
    stages = [r.stage for r in registry.current().collect()]
    assert stages.count(PRODUCTION) == 1 and len(stages) == 6
    assert registry.history().count() == 6 + 6 + 5
    assert registry.load_production().stages[0].getOutputCol() == "b"
    with pytest.raises(ValueError):
        registry.promote(99)
