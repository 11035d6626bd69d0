"""Lake tables, warehouse tables and repeated batches."""

from __future__ import annotations

import datetime as dt

import pytest
from helpers import event, events_frame, item, one
from pyspark.sql import functions as F

from tidestream.operators import metrics
from tidestream.operators.enrich import enrich_events
from tidestream.plans.batch import daily_job, load_warehouse, process_batch
from tidestream.sinks import lake, warehouse
from tidestream.sources.lake import preview, read_folder, read_table

TABLES = ("sessions", "products", "hourly", "categories", "devices")


@pytest.fixture
def batch(spark):
    return events_frame(
        spark,
        event("1"),
        event("1"),
        event("2", at="2024-01-06T11:00:00Z"),
        event("3", at="not a time"),
        event("4", user_id=None),
        event(
            "5",
            "purchase",
            product_id=None,
            product_category=None,
            cart_items=[item("P1", 5.0, 2), item("P2", 1.0, 1, "Clothing")],
        ),
    )


def test_batch_job(spark, batch, tmp_path):
    summary = one(process_batch(batch, str(tmp_path), "b1", keep_rejected=True))
    assert summary["total_events_processed"] == 4 and summary["batch_id"] == "b1"
    raw = read_folder(spark, lake.raw_path(f"{tmp_path}/raw"))
    assert raw.count() == 4
    assert raw.where("year = 2024 and month = 1 and day = 6 and hour = 11").count() == 1
    assert raw.where("year is null").count() == 1
    tables = {
        t: read_folder(spark, lake.metric_path(f"{tmp_path}/processed", t)) for t in TABLES
    }
    assert all({"year", "month", "day"} <= set(t.columns) for t in tables.values())
    hourly = tables["hourly"].where("day = 5").agg(F.sum("purchases").alias("n"))
    assert one(hourly)["n"] == 1  # one purchase ...
    products = tables["products"].where("day = 5").agg(F.sum("purchase_count").alias("n"))
    assert one(products)["n"] == 2  # ... of two products
    assert spark.read.parquet(f"{tmp_path}/raw/quarantine").count() == 1


def test_repeated_batch_replaces_itself(spark, batch, tmp_path):
    for batch_id in ("b1", "b2", "b1"):
        process_batch(batch, str(tmp_path), batch_id)
    raw = read_folder(spark, lake.raw_path(f"{tmp_path}/raw"))
    assert {r["batch_id"]: r["count"] for r in raw.groupBy("batch_id").count().collect()} == {
        "b1": 4, "b2": 4,
    }
    hourly = read_folder(spark, lake.metric_path(f"{tmp_path}/processed", "hourly"))
    assert one(hourly.agg(F.sum("total_events").alias("n")))["n"] == 4  # copies count once


def test_batches_of_one_day_and_a_repeat_that_is_empty(spark, tmp_path):
    path = str(tmp_path)
    process_batch(events_frame(spark, event("1"), event("2")), path, "b1", keep_rejected=True)
    rejected = event("4", user_id=None)
    later = event("5", at="2024-01-07T03:00:00Z")
    process_batch(events_frame(spark, event("3"), rejected, later), path, "b2", keep_rejected=True)

    def days(name="hourly"):
        table = read_folder(spark, lake.metric_path(f"{path}/processed", name))
        return {r["day"]: r["n"] for r in table.groupBy("day").agg(F.sum("total_events").alias("n")).collect()}

    assert days() == {5: 3, 7: 1}
    process_batch(events_frame(spark), path, "b2", keep_rejected=True)
    assert days() == {5: 2}
    assert read_folder(spark, lake.raw_path(f"{path}/raw")).count() == 2
    quarantine = spark.read.schema("event STRING, reason STRING").parquet(lake.quarantine_path(f"{path}/raw"))
    assert quarantine.count() == 0


def test_batches_without_valid_events_and_days_that_empty(spark, tmp_path):
    """Rows that vanish only while the job runs, in a plan that can't know it."""
    path, bad = str(tmp_path), event("1", user_id=None)
    folder = f"{path}/in"
    events_frame(spark, bad, bad).write.parquet(folder)
    summary = one(process_batch(spark.read.parquet(folder), path, "b1", keep_rejected=True))
    assert summary["total_events_processed"] == 0
    process_batch(events_frame(spark, event("2")), path, "b2")
    process_batch(spark.read.parquet(folder), path, "b2")
    for name in TABLES:
        table = lake.part_path(lake.metric_path(f"{path}/processed", name), (2024, 1, 5))
        assert spark.read.schema("event_date DATE").parquet(table).count() == 0
    assert spark.read.schema("event_id STRING").parquet(lake.raw_path(f"{path}/raw")).count() == 0


def test_conversion_rates_of_products_in_carts(spark, tmp_path):
    """Views and cart adds name a brand, carts do not; all are one product."""
    named = {"product_name": "Shoe", "product_brand": "Acme"}
    cart = {"product_id": None, "product_category": None, "product_price": None}
    rows = [event("1", **named), event("2", "add_to_cart", **named)]
    rows.append(event("3", "purchase", **cart, cart_items=[item("P1", 10.0, 1), item("P2", 4.0, 2)]))
    process_batch(events_frame(spark, *rows), str(tmp_path), "b1")
    products = read_folder(spark, lake.metric_path(f"{tmp_path}/processed", "products"))
    shoe = one(products.where("product_id = 'P1'"))
    assert shoe["product_brand"] == "Acme" and shoe["purchase_count"] == 1
    assert shoe["view_to_purchase_rate"] == pytest.approx(1 / 3) and shoe["cart_to_purchase_rate"] == 1.0
    assert one(products.where("product_id = 'P2'"))["purchase_count"] == 1


def test_daily_job_reads_two_days(spark, tmp_path):
    path = str(tmp_path)
    rows = [event(str(k), "purchase", f"2024-01-0{d}T10:00:00Z") for k, d in enumerate((1, 4, 5, 5))]
    loaded = F.to_timestamp(F.lit("2024-01-05 10:30:00"))
    process_batch(events_frame(spark, *rows), path, "b1", processed_at=loaded)
    state = daily_job(spark, path, "2024-01-05 11:00:00")
    assert state["status"] == "fresh" and state["age_seconds"] == 1800
    report = read_folder(spark, f"{path}/curated/daily_summary")
    assert {str(r["report_date"]): r["total_purchases"] for r in report.collect()} == {"2024-01-04": 1, "2024-01-05": 2}
    assert daily_job(spark, path, "2024-01-09 11:00:00")["status"] == "missing"
    raw = read_folder(spark, lake.raw_path(f"{path}/raw"))
    recent = raw.where(metrics.since_yesterday("event_date", "2024-01-05", by_parts=True))
    plan = recent._jdf.queryExecution().executedPlan().toString()
    pruned = plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert all(column in pruned for column in ("year", "month", "day"))


def test_empty_batch(spark, tmp_path):
    summary = one(process_batch(events_frame(spark), str(tmp_path), "none"))
    assert summary["total_events_processed"] == 0


def test_partition_filter_reaches_the_scan(spark, batch, tmp_path):
    process_batch(batch, str(tmp_path), "b1")
    raw = read_folder(spark, lake.raw_path(f"{tmp_path}/raw"))
    day = raw.where("year = 2024 and day = 6").select("event_id")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    schema = plan.split("ReadSchema: ")[1]
    assert schema.startswith("struct<event_id:string>")


def test_daily_summary_replaces_only_its_days(spark, batch, tmp_path):
    events = enrich_events(batch, batch_id="b").where("event_date is not null")
    older = metrics.daily_summary(events, "2024-01-06")
    path = lake.write_daily_summary(older, str(tmp_path))
    newer = metrics.daily_summary(events.limit(1), "2024-01-05")
    assert newer.count() == 1
    lake.write_daily_summary(newer, str(tmp_path))
    assert read_folder(spark, path).count() == 2


def test_csv_and_baseline(spark, tmp_path):
    frame = spark.createDataFrame([("a", 0.5)], "feature STRING, importance DOUBLE")
    lake.write_csv(frame, f"{tmp_path}/csv")
    assert one(spark.read.option("header", True).csv(f"{tmp_path}/csv"))["feature"] == "a"
    values = spark.createDataFrame([("m", 1.0)], "metric STRING, value DOUBLE")
    for run in ("r1", "r2"):
        lake.append_baseline(values, f"{tmp_path}/base", run)
    stored = spark.read.parquet(f"{tmp_path}/base")
    assert sorted(r["run_id"] for r in stored.collect()) == ["r1", "r2"]


def test_bulk_load_matches_by_name_and_repeats_safely(spark, batch, tmp_path):
    process_batch(batch, str(tmp_path), "b1")
    spark.sql(
        "CREATE TABLE hourly_clickstream_metrics (event_hour INT, total_events BIGINT, "
        "unique_users BIGINT, event_date DATE) USING parquet PARTITIONED BY (event_date)"
    )
    path = lake.metric_path(f"{tmp_path}/processed", "hourly")
    dated = f"{tmp_path}/dated"
    read_folder(spark, path).where("event_date is not null").write.parquet(dated)
    for _ in range(2):
        warehouse.bulk_load(spark, dated, "hourly_clickstream_metrics")
    assert read_table(spark, "hourly_clickstream_metrics").count() == 2


def test_bulk_load_keeps_other_batches(spark, tmp_path):
    process_batch(events_frame(spark, event("1")), str(tmp_path), "b1")
    process_batch(events_frame(spark, event("2"), event("3")), str(tmp_path), "b2")
    columns = "event_id STRING, event_date DATE, batch_id STRING"
    spark.sql(f"CREATE TABLE loaded_events ({columns}) USING parquet PARTITIONED BY (event_date, batch_id)")
    raw = read_folder(spark, lake.raw_path(f"{tmp_path}/raw"))
    for batch_id in ("b1", "b2", "b2"):
        raw.where(F.col("batch_id") == batch_id).write.mode("overwrite").parquet(f"{tmp_path}/one")
        warehouse.bulk_load(spark, f"{tmp_path}/one", "loaded_events")
    assert read_table(spark, "loaded_events").count() == 3
    spark.sql("CREATE TABLE flat_events (event_id STRING) USING parquet")
    with pytest.raises(ValueError, match="not partitioned"):
        warehouse.bulk_load(spark, f"{tmp_path}/one", "flat_events")


def test_arrays_are_flattened_for_jdbc(spark):
    frame = spark.createDataFrame([(1, ["a", "b"])], "n INT, items ARRAY<STRING>")
    assert one(warehouse.flatten_arrays(frame)) == {"n": 1, "items": "a,b"}
    options = warehouse.jdbc_options("jdbc:x", "t", "u", "p", "org.Driver")
    assert options["dbtable"] == "t" and options["numPartitions"] == "16"


def test_warehouse_load_sends_the_stored_metrics(spark, batch, tmp_path, monkeypatch):
    """Without a database: what would be written, and where."""
    process_batch(batch, str(tmp_path), "b1")
    sent = {}
    monkeypatch.setattr(warehouse, "write_jdbc", lambda df, options, mode: sent.update({(options["dbtable"], mode): df}))
    run = []
    monkeypatch.setattr(warehouse, "run_statements", lambda spark, options, statements: run.append(statements))
    options = warehouse.jdbc_options("jdbc:x", "", "u", "p", "org.Driver")
    for _ in range(2):  # a load can be repeated
        load_warehouse(spark, str(tmp_path), options, [dt.date(2024, 1, 6), dt.date(2024, 1, 9)])
    assert set(sent) == {(f"{name}_staging", "overwrite") for name in warehouse.WAREHOUSE_TABLES.values()}
    hourly = sent["hourly_clickstream_metrics_staging", "overwrite"]
    assert [(str(r.event_date), r.total_events) for r in hourly.collect()] == [("2024-01-06", 1)]
    assert not {"year", "month", "day"} & set(hourly.columns)
    delete, insert = run[0]
    assert delete == "DELETE FROM hourly_clickstream_metrics WHERE event_date IN (DATE '2024-01-06', DATE '2024-01-09')"
    assert insert.startswith("INSERT INTO hourly_clickstream_metrics (event_date, event_hour, ") and insert.endswith(" FROM hourly_clickstream_metrics_staging")
    assert run[:3] == run[3:]
    load_warehouse(spark, str(tmp_path), options, [])
    assert len(run) == 6


def test_predictions_fall_back_to_a_table(spark):
    frame = spark.createDataFrame([("s1", ["a"])], "session_id STRING, categories ARRAY<STRING>")
    jdbc = warehouse.jdbc_options("jdbc:none://x", "t", "u", "p", "no.such.Driver")
    assert warehouse.save_predictions(frame, jdbc, "fallback_predictions") == "table"
    assert warehouse.save_predictions(frame, None, "fallback_predictions") == "table"
    assert one(read_table(spark, "fallback_predictions"))["categories"] == ["a"]


def test_prediction_table_replaces_days(spark):
    from tidestream.schemas import PREDICTION_COLUMNS

    warehouse.create_predictions_table(spark, "stored_predictions")
    blank = [F.lit(None).cast(k).alias(n) for n, k in PREDICTION_COLUMNS.items() if n != "event_date"]
    for days in ((1, 2), (2,)):
        rows = spark.createDataFrame([(f"2024-01-0{d}",) for d in days], "d STRING")
        export = rows.select(*blank, F.to_date("d").alias("event_date"))
        warehouse.load_predictions(export, "stored_predictions")
    assert read_table(spark, "stored_predictions").count() == 2


def test_preview(spark):
    assert preview(spark.range(100), 7).count() == 7
