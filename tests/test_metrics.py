"""Session, product and window metrics on hand-made frames."""

from __future__ import annotations

import datetime as dt

import pytest
from helpers import assert_same, event, events_frame, one
from pyspark.sql import functions as F

from tidestream.operators import features, metrics, predictions, sessions, windows
from tidestream.operators.enrich import enrich_events
from tidestream.operators.sessions import SESSION_KEYS
from tidestream.sources import testdata


def enriched(spark, *rows):
    return enrich_events(events_frame(spark, *rows), batch_id="b")


def test_session_metrics(spark):
    tablet = {"type": "tablet", "os": None, "browser": None}
    frame = enriched(
        spark,
        event("1", at="2024-01-05T10:00:00.9Z", device_info=tablet),
        event("2", "add_to_cart", at="2024-01-05T10:01:00.1Z", product_id="P2"),
        event("3", "search", at="2024-01-05T10:02:00Z"),
        event("4", "purchase", at="2024-01-05T10:03:00Z"),
    )
    row = one(sessions.session_metrics(frame))
    assert row["page_views"] == 4  # events of every type
    assert row["unique_products_viewed"] == 2
    assert (row["add_to_cart_events"], row["purchase_events"], row["search_events"]) == (1, 1, 1)
    assert row["session_duration_seconds"] == 180
    assert row["categories_viewed"] == ["Sports"]
    assert row["category_counts"] == [{"value": "Sports", "n": 3}]
    assert row["devices_used"] == ["mobile", "tablet"]
    assert row["device_type"] == "tablet"
    assert row["converted_to_purchase"] and row["converted_to_cart"]
    full = one(sessions.with_full_lists(sessions.session_metrics(frame)))
    assert full["categories_viewed"] == ["Sports"] * 3
    assert full["devices_used"] == ["mobile"] * 3 + ["tablet"]


def test_session_across_midnight_gives_two_rows(spark):
    frame = enriched(
        spark, event("1", at="2024-01-05T23:59:00Z"), event("2", at="2024-01-06T00:01:00Z")
    )
    rows = sessions.session_metrics(frame).collect()
    assert sorted(str(r["event_date"]) for r in rows) == ["2024-01-05", "2024-01-06"]
    assert {r["session_duration_seconds"] for r in rows} == {0}


def test_full_lists_equal_collected_lists(spark, sf_dir):
    """The counted form loses nothing against gathering every value of the session."""
    from tidestream.sources.testdata import enriched_events

    events = enriched_events(spark, sf_dir)
    mine = sessions.with_full_lists(sessions.session_metrics(events)).select(
        *SESSION_KEYS, "categories_viewed", "devices_used"
    )
    plain = events.groupBy(*SESSION_KEYS).agg(
        F.array_sort(F.collect_list("product_category")).alias("categories_viewed"),
        F.array_sort(F.collect_list("device_info.type")).alias("devices_used"),
    )
    assert_same(mine, plain)


def test_one_hot_session_is_counted_whole(spark):
    """A third of all rows in one session: same totals as a plain aggregate."""
    rows = spark.range(9000).select(
        F.concat(F.lit("e"), F.col("id")).alias("event_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 500)).alias(
            "session_id"
        ),
        F.lit("u").alias("user_id"),
        F.lit("page_view").alias("event_type"),
        F.lit("2024-01-05T10:00:00Z").alias("timestamp"),
        F.concat(F.lit("P"), F.col("id") % 1000).alias("product_id"),
        F.concat(F.lit("C"), F.col("id") % 7).alias("product_category"),
        F.named_struct(F.lit("type"), F.lit("mobile")).alias("device_info"),
    )
    from tidestream.operators.enrich import add_event_time

    hot = one(
        sessions.session_metrics(add_event_time(rows)).where("session_id = 'hot'")
    )
    assert hot["page_views"] == 3000
    assert hot["unique_products_viewed"] == 1000
    assert sum(c["n"] for c in hot["category_counts"]) == 3000


def test_invariants_on_test_tables(spark, sf_dir):
    from tidestream.sources.testdata import enriched_events

    inputs = sessions.session_inputs(sessions.session_metrics(enriched_events(spark, sf_dir)))
    broken = inputs.where(
        "unique_products_viewed > page_views or page_views < 1 or event_hour not between 0 and 23"
        " or day_of_week not between 0 and 6 or session_duration_seconds < 0"
        " or session_id is null or user_id is null"
    )
    assert broken.isEmpty()


def test_rates_without_denominator_are_zero(spark):
    row = one(metrics.product_metrics(enriched(spark, event("1", "purchase"))))
    assert row["cart_to_purchase_rate"] == 0.0
    assert row["view_to_purchase_rate"] == 1.0


def test_daily_reports_start_yesterday(spark):
    frame = enriched(
        spark, *[event(str(d), "purchase", at=f"2024-01-0{d}T10:00:00Z") for d in range(1, 6)]
    )
    days = [str(r["date"]) for r in metrics.daily_activity(frame, "2024-01-05").collect()]
    assert days == ["2024-01-05", "2024-01-04"]
    assert metrics.daily_summary(frame, "2024-01-05").count() == 2
    assert metrics.daily_summary(frame).count() == 0  # by default relative to today


def test_sliding_windows_equal_spark_windows(spark, sf_dir):
    """Folding to panes first gives what the direct sliding window gives."""
    from tidestream.sources.testdata import enriched_events

    events = enriched_events(spark, sf_dir)
    direct = events.groupBy(F.window("event_timestamp", "5 minutes", "1 minute").alias("w")).count()
    direct = direct.selectExpr("w.start window_start", "w.end window_end", "count total_events")
    panes = windows.event_rate(events).select("window_start", "window_end", "total_events")
    assert_same(panes, direct)


def test_conversion_window_without_views(spark):
    rows = windows.conversion_window(enriched(spark, event("1", "purchase"))).collect()
    assert len(rows) == 12
    assert all(r["conversion_rate_pct"] is None and r["status"] is None for r in rows)


def test_error_rate_keeps_events_without_time(spark):
    from tidestream.operators.enrich import add_event_time
    from tidestream.operators.quality import is_valid

    frame = events_frame(spark, event("a", at=""), event("b", user_id=None), event("c"))
    rates = windows.error_rate(add_event_time(frame.withColumn("is_valid", is_valid())))
    rows = {r["window_start"]: r["rejected_events"] for r in rates.collect()}
    assert rows.pop(None) == 1
    assert list(rows.values()) == [1] * 5


def test_status_levels(spark):
    users = [event(str(i), user_id=f"u{i}") for i in range(100)]
    row = one(windows.active_users(enriched(spark, *users)))
    assert (row["active_users"], row["status"]) == (100, "yellow")


def test_pipeline_latency(spark):
    late = F.to_timestamp(F.lit("2024-01-05 10:00:03"))
    frame = enrich_events(events_frame(spark, event("1")), processed_at=late)
    row = one(windows.pipeline_latency(frame))
    assert (row["p50_seconds"], row["p95_seconds"]) == (3.0, 3.0)


def test_features(spark):
    row = {
        "session_id": "s", "user_id": "u", "event_date": dt.date(2024, 1, 6), "event_hour": 6,
        "day_of_week": 5, "page_views": 3, "unique_products_viewed": 2, "add_to_cart_events": 1,
        "search_events": 0, "session_duration_seconds": 60.0, "device_type": "mobile",
        "devices_used": ["mobile"], "categories_viewed": ["Home & Garden"],
        "n_categories_viewed": 1, "converted_to_purchase": False,
    }
    schema = (
        "session_id STRING, user_id STRING, event_date DATE, event_hour INT, day_of_week INT, "
        "page_views BIGINT, unique_products_viewed BIGINT, add_to_cart_events BIGINT, "
        "search_events BIGINT, session_duration_seconds DOUBLE, device_type STRING, "
        "devices_used ARRAY<STRING>, categories_viewed ARRAY<STRING>, n_categories_viewed INT, "
        "converted_to_purchase BOOLEAN"
    )
    made = one(features.engineer_features(spark.createDataFrame([row], schema)))
    assert set(features.feature_columns()) <= set(made)
    assert len(features.feature_columns()) == 19
    assert (made["is_weekend"], made["hour_morning"], made["hour_night"]) == (1, 1, 0)
    assert (made["cat_home_garden"], made["cat_sports"]) == (1, 0)
    assert made["browse_to_product_ratio"] == 0.5
    scored = one(testdata.score_by_rule(spark.createDataFrame([row], schema)))
    assert 0.01 <= scored["probability_purchase"] <= 0.90


@pytest.mark.parametrize(
    ("probability", "bucket"),
    [(0.0, "0-20%"), (0.2, "20-40%"), (0.4, "40-60%"), (0.6, "60-80%"), (0.8, "80-100%")],
)
def test_buckets_are_half_open(spark, probability, bucket):
    from tidestream.functions import probability_bucket

    frame = spark.range(1).select(probability_bucket(F.lit(probability)).alias("b"))
    assert one(frame)["b"] == bucket


def test_drift_flags_large_changes_of_shared_metrics(spark):
    schema = "metric STRING, value DOUBLE"
    base = spark.createDataFrame(
        [("avg_predicted_probability", 0.2), ("predicted_positive_rate", 0.1), ("other", 1.0)],
        schema,
    )
    now = spark.createDataFrame([("avg_predicted_probability", 0.3), ("other", 9.0)], schema)
    row = one(predictions.prediction_drift(now, base))
    assert row["metric"] == "avg_predicted_probability" and row["drift_detected"]


def test_approximate_distinct_counts_take_one_pass(spark):
    rows = spark.range(20_000).selectExpr("concat('u', id % 3000) user_id", "concat('s', id % 900) session_id", "concat('P', id % 40) product_id")
    exact, rough = (one(metrics.processing_summary(rows, approximate)) for approximate in (False, True))
    assert rough["total_events_processed"] == exact["total_events_processed"]
    for name in ("unique_users", "unique_sessions", "unique_products"):
        assert abs(rough[name] - exact[name]) <= 0.15 * exact[name]
    plans = [metrics.processing_summary(rows, a)._jdf.queryExecution().executedPlan().toString() for a in (False, True)]
    assert "Expand" in plans[0] and "Expand" not in plans[1]
