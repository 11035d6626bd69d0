"""The registered queries: one per operator, over the whole test tables.

Dates and times are rendered as text here, and unordered collections as sorted text, so
that results compare by value between engines. Library functions return the proper types.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidestream.functions import render_counts
from tidestream.operators import carts, cells, enrich, features, metrics, predictions, propensity
from tidestream.operators import quality, sessions, sketches, windows
from tidestream.schemas import EVENT_TYPES_BY_COLUMN
from tidestream.session import ensure_checkpoint_dir, stored
from tidestream.sinks import raw
from tidestream.sources import messages, testdata
from tidestream.sources.testdata import AS_OF, TEST_CATEGORIES

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The simulated shift of the drift check.
DRIFT_FACTORS = {"avg_predicted_probability": 1.08, "predicted_positive_rate": 1.02}
PERCENTILE_ACCURACY = 1_000_000


def query(fn: Query) -> Query:
    QUERIES[fn.__name__.removesuffix("_query")] = fn
    return fn


def _day(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd").alias(column)


def _time(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(column)


def _minute(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm").alias(column)


def _round(column: str, digits: int = 6) -> Column:
    return F.round(column, digits).alias(column)


def _sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.session_metrics(testdata.enriched_events(spark, sf_dir))


def _inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.session_inputs(_sessions(spark, sf_dir))


def _rule_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testdata.score_by_rule(_inputs(spark, sf_dir))


def _rule_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predictions.prediction_export(_rule_scored(spark, sf_dir))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return carts.purchase_lines(testdata.cart_purchases(spark, sf_dir))


# -- ingest -------------------------------------------------------------------
@query
def decode_events(spark, sf_dir):
    events = messages.decode_messages(testdata.broker_messages(spark, sf_dir))
    origin = ("topic", "partition", "offset", "key", "timestamp")
    return messages.well_formed(events).select(
        "event_id",
        "event_type",
        "timestamp",
        "user_id",
        "session_id",
        "product_id",
        F.col("device_info.type").alias("device_type"),
        F.col("location.city").alias("city"),
        *[F.col(f"kafka_metadata.{f}").alias(f"kafka_{f}") for f in origin],
    )


@query
def route_topics(spark, sf_dir):
    routed = messages.route_topics(testdata.broker_messages(spark, sf_dir))
    return routed.groupBy("topic", "job").agg(F.count("*").alias("messages"))


@query
def parse_envelope(spark, sf_dir):
    events = messages.parse_envelopes(testdata.envelopes(spark, sf_dir))
    return events.groupBy("event_id", "event_type", "product_id", "product_category").agg(
        F.count("*").alias("messages")
    )


@query
def raw_partition_counts(spark, sf_dir):
    """Written to a raw table in two batches, compacted in part, and read back by its versions."""
    events = testdata.enriched_events(spark, sf_dir)
    root = f"{ensure_checkpoint_dir(spark)}/raw-{raw.new_run()}"
    schema = enrich.add_time_partitions(events).schema
    late = F.pmod(F.xxhash64("event_id"), F.lit(2)) == 1
    for batch_id, rows in (("early", events.where(~late)), ("late", events.where(late))):
        raw.write_raw(rows, root, batch_id)
    first = enrich.add_time_partitions(events).agg(F.min(F.struct("year", "month", "day", "hour")).alias("hour")).first()["hour"]
    if first is not None:
        raw.compact_hours(spark, root, schema, (*first[:3], 24))
    return enrich.partition_counts(raw.read_raw(spark, root, schema))


# -- quality ------------------------------------------------------------------
@query
def valid_keys(spark, sf_dir):
    events = testdata.clickstream(spark, sf_dir, with_products=False)
    return quality.drop_missing_keys(events).select(
        "event_id", "event_type", "user_id", "session_id"
    )


@query
def valid_timestamps(spark, sf_dir):
    events = testdata.clickstream(spark, sf_dir, with_products=False)
    return quality.drop_missing_timestamps(events).select("event_id", "timestamp")


@query
def valid_products(spark, sf_dir):
    events = quality.drop_missing_products(testdata.clickstream(spark, sf_dir))
    return events.select("event_id", "event_type", "product_id")


@query
def validated_events(spark, sf_dir):
    return testdata.valid_events(spark, sf_dir).select(
        "event_id",
        "event_type",
        "timestamp",
        "user_id",
        "session_id",
        "product_id",
        "product_name",
        "product_category",
        "product_brand",
        F.col("device_info.type").alias("device_type"),
        F.col("location.city").alias("city"),
    )


@query
def dedup_events(spark, sf_dir):
    events = testdata.clickstream(spark, sf_dir, with_products=False)
    return quality.drop_duplicate_events(events).select(
        "event_id", "event_type", "timestamp", "user_id", "session_id"
    )


@query
def data_quality(spark, sf_dir):
    report = quality.data_quality(testdata.clickstream(spark, sf_dir))
    return report.withColumn("data_quality_rate", _round("data_quality_rate"))


@query
def freshness(spark, sf_dir):
    events = testdata.enriched_events(spark, sf_dir)
    report = quality.freshness(events, f"{AS_OF} 23:59:59", loaded_at="event_timestamp")
    return report.withColumn("latest", _time("latest"))


# -- enrichment and carts -----------------------------------------------------
@query
def enriched_events(spark, sf_dir):
    events = testdata.enriched_events(spark, sf_dir)
    return events.select(
        "event_id",
        _time("event_timestamp"),
        _day("event_date"),
        "event_hour",
        "session_duration_seconds",
    )


@query
def device_flags(spark, sf_dir):
    events = testdata.enriched_events(spark, sf_dir)
    flags = ("is_mobile", "is_tablet", "is_desktop")
    return events.select("event_id", *[F.col(f).cast("string").alias(f) for f in flags])


@query
def purchase_lines(spark, sf_dir):
    return _lines(spark, sf_dir).select(
        "order_id",
        "event_id",
        "user_id",
        "product_id",
        "quantity",
        "product_price",
        "line_value",
    )


@query
def cart_lines(spark, sf_dir):
    """Lines of carts that hold whole orders."""
    lines = carts.purchase_lines(testdata.whole_carts(spark, sf_dir))
    return lines.select("order_id", "event_id", "line_number", "product_id", "quantity", "line_value")


@query
def order_values(spark, sf_dir):
    return carts.order_values(_lines(spark, sf_dir))


# -- sessions and metrics -----------------------------------------------------
def _merged(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The metric tables from the cells of three batches, without the events of either."""
    events = testdata.enriched_events(spark, sf_dir)
    absent = {c: F.lit(None).cast(kind) for c, kind in EVENT_TYPES_BY_COLUMN.items() if c not in events.columns}
    events = events.withColumns(absent)
    batches = [events.where(F.pmod(F.xxhash64("event_id"), F.lit(3)) == k) for k in range(3)]
    both = [reduce(DataFrame.union, map(make, batches)) for make in (sessions.session_cells, cells.total_cells)]
    return cells.metrics_from_cells(*[stored(frame, "cells") for frame in both])


@query
def session_metrics_merged(spark, sf_dir):
    return _rendered_sessions(_merged(spark, sf_dir)["sessions"])


@query
def hourly_metrics_merged(spark, sf_dir):
    """Without the distinct counts, which are estimates here."""
    hourly = _merged(spark, sf_dir)["hourly"].drop("unique_users", "unique_sessions")
    return hourly.withColumn("event_date", _day("event_date"))


@query
def session_metrics(spark, sf_dir):
    return _rendered_sessions(_sessions(spark, sf_dir))


def _rendered_sessions(rows: DataFrame) -> DataFrame:
    return rows.select(
        "session_id",
        "user_id",
        _day("event_date"),
        "page_views",
        "unique_products_viewed",
        "add_to_cart_events",
        "purchase_events",
        "search_events",
        _time("session_start"),
        _time("session_end"),
        render_counts(F.col("category_counts")).alias("category_counts"),
        render_counts(F.col("device_counts")).alias("device_counts"),
        F.array_join("categories_viewed", ",").alias("categories_viewed"),
        F.array_join("devices_used", ",").alias("devices_used"),
        "session_duration_seconds",
        F.col("converted_to_purchase").cast("int").alias("converted_to_purchase"),
        F.col("converted_to_cart").cast("int").alias("converted_to_cart"),
    )


@query
def product_metrics(spark, sf_dir):
    products = metrics.product_metrics(testdata.enriched_events(spark, sf_dir))
    rounded = ("avg_price", "total_value", "view_to_cart_rate", "view_to_purchase_rate",
               "cart_to_purchase_rate")
    return products.withColumns(
        {"event_date": _day("event_date"), **{c: _round(c) for c in rounded}}
    )


@query
def product_metrics_carts(spark, sf_dir):
    """Products of views and of carts together: purchases name theirs in the cart only."""
    purchases = testdata.whole_carts(spark, sf_dir)
    others = testdata.enriched_events(spark, sf_dir).where("event_type <> 'purchase'")
    blank = [F.lit(None).cast("string").alias(c) for c in ("product_id", *metrics.PRODUCT_NAMES)]
    no_price = F.lit(None).cast("double").alias("product_price")
    kept = ("event_type", "event_date", "user_id", "session_id")
    bought = purchases.select(*kept, *blank, no_price, "cart_items")
    viewed = others.select(*kept, "product_id", *metrics.PRODUCT_NAMES, "product_price")
    events = viewed.unionByName(bought, allowMissingColumns=True)
    events = events.withColumns({c: F.lit(None).cast(t) for c, t in (("quantity", "int"), ("total_value", "double"))})
    products = metrics.product_metrics(carts.expand_carts(events))
    rates = ("view_to_cart_rate", "view_to_purchase_rate", "cart_to_purchase_rate")
    products = products.drop("avg_price", "total_value")
    return products.withColumns({"event_date": _day("event_date"), **{c: _round(c) for c in rates}})


@query
def hourly_metrics(spark, sf_dir):
    hourly = metrics.hourly_metrics(testdata.enriched_events(spark, sf_dir))
    return hourly.withColumn("event_date", _day("event_date"))


@query
def category_metrics(spark, sf_dir):
    categories = metrics.category_metrics(testdata.enriched_events(spark, sf_dir))
    return categories.withColumn("event_date", _day("event_date"))


@query
def device_metrics(spark, sf_dir):
    devices = metrics.device_metrics(testdata.enriched_events(spark, sf_dir))
    return devices.withColumn("event_date", _day("event_date"))


@query
def event_type_counts(spark, sf_dir):
    return metrics.event_type_counts(testdata.enriched_events(spark, sf_dir))


@query
def processing_summary(spark, sf_dir):
    return metrics.processing_summary(testdata.enriched_events(spark, sf_dir))


@query
def daily_activity(spark, sf_dir):
    days = metrics.daily_activity(testdata.enriched_events(spark, sf_dir), AS_OF)
    return days.withColumn("date", _day("date"))


@query
def daily_summary(spark, sf_dir):
    days = metrics.daily_summary(testdata.enriched_events(spark, sf_dir), AS_OF)
    return days.withColumns(
        {"report_date": _day("report_date"), "avg_purchase_value": _round("avg_purchase_value")}
    )


@query
def conversion_rate(spark, sf_dir):
    overall = sessions.conversion_rate(_inputs(spark, sf_dir))
    return overall.withColumn("conversion_rate", _round("conversion_rate"))


@query
def conversion_by_device(spark, sf_dir):
    devices = sessions.conversion_by_device(_inputs(spark, sf_dir))
    return devices.withColumn("conversion_rate", _round("conversion_rate"))


@query
def conversion_by_hour(spark, sf_dir):
    hours = sessions.conversion_by_hour(_inputs(spark, sf_dir))
    return hours.withColumn("conversion_rate", _round("conversion_rate"))


@query
def describe_sessions(spark, sf_dir):
    described = sessions.describe_sessions(_inputs(spark, sf_dir))
    return described.withColumns({c: _round(c) for c in ("mean", "stddev", "min", "max")})


@query
def top_products(spark, sf_dir):
    return metrics.top_products(testdata.enriched_events(spark, sf_dir))


@query
def top_products_recounted(spark, sf_dir):
    """The top ten from summaries of each minute and an exact count of their candidates."""
    minutes = sketches.product_minutes(testdata.enriched_events(spark, sf_dir))
    minutes = stored(minutes, "product-minutes")
    return sketches.top_products_exact(minutes, sketches.frequent_products(minutes, 5))


@query
def geo_distribution(spark, sf_dir):
    return metrics.geo_distribution(testdata.enriched_events(spark, sf_dir))


@query
def category_conversion(spark, sf_dir):
    daily = metrics.category_metrics(testdata.enriched_events(spark, sf_dir))
    total = metrics.category_conversion(daily)
    return total.withColumn("conversion_rate", _round("conversion_rate"))


@query
def top_sellers(spark, sf_dir):
    return metrics.top_sellers(_lines(spark, sf_dir))


@query
def revenue_by_period(spark, sf_dir):
    days = metrics.revenue_by_period(_lines(spark, sf_dir), "day")
    return days.withColumn("period_start", _day("period_start"))


@query
def customer_value(spark, sf_dir):
    customers = metrics.customer_value(_lines(spark, sf_dir))
    return customers.select(
        "user_id",
        "lifetime_value",
        "orders",
        _time("first_purchase"),
        _time("last_purchase"),
    )


# -- window metrics -----------------------------------------------------------
def _with_bounds(frame: DataFrame, **columns: Column) -> DataFrame:
    """Window bounds as text; `columns` replace others."""
    bounds = {c: _minute(c) for c in ("window_start", "window_end")}
    return frame.withColumns({**bounds, **columns})


@query
def category_minute(spark, sf_dir):
    return _with_bounds(windows.category_minute(testdata.enriched_events(spark, sf_dir)))


@query
def event_rate_5m(spark, sf_dir):
    rates = windows.event_rate(testdata.enriched_events(spark, sf_dir))
    return _with_bounds(rates, events_per_second=_round("events_per_second"))


@query
def conversion_1h(spark, sf_dir):
    hours = windows.conversion_window(testdata.enriched_events(spark, sf_dir))
    return _with_bounds(
        hours,
        conversion_rate_pct=F.coalesce(_round("conversion_rate_pct"), F.lit(-1.0)),
        status=F.coalesce("status", F.lit("no views")),
    )


@query
def error_rate_5m(spark, sf_dir):
    events = testdata.clickstream(spark, sf_dir).withColumn("is_valid", quality.is_valid())
    rates = windows.error_rate(enrich.add_event_time(events))
    return _with_bounds(rates, errors_per_second=_round("errors_per_second"))


@query
def active_users_1h(spark, sf_dir):
    return _with_bounds(windows.active_users(testdata.enriched_events(spark, sf_dir)))


@query
def revenue_1h(spark, sf_dir):
    hours = windows.revenue_per_hour(_lines(spark, sf_dir), "line_value")
    return _with_bounds(hours)


# -- features and rule-scored predictions -------------------------------------
@query
def session_inputs(spark, sf_dir):
    return _inputs(spark, sf_dir).withColumns(
        {
            "event_date": _day("event_date"),
            "devices_used": F.array_join("devices_used", ","),
            "categories_viewed": F.array_join("categories_viewed", ","),
            "converted_to_purchase": F.col("converted_to_purchase").cast("int"),
        }
    )


@query
def session_features(spark, sf_dir):
    featured = features.engineer_features(_inputs(spark, sf_dir), TEST_CATEGORIES)
    columns = features.feature_columns(TEST_CATEGORIES)
    return featured.select(
        "session_id",
        "user_id",
        _day("event_date"),
        "device_desktop",
        *[_round(c) if c.startswith(("log_", "browse_")) else c for c in columns],
        F.col("converted_to_purchase").cast("double").alias("label"),
    )


@query
def scored_sessions_rule(spark, sf_dir):
    return _rule_scored(spark, sf_dir).select(
        "session_id", "user_id", _day("event_date"), "probability_purchase", "prediction_label"
    )


@query
def confusion_matrix(spark, sf_dir):
    return predictions.confusion_matrix(_rule_scored(spark, sf_dir))


@query
def prediction_summary(spark, sf_dir):
    summary = predictions.prediction_summary(_rule_scored(spark, sf_dir), PERCENTILE_ACCURACY)
    return summary.withColumns({c: _round(c) for c in summary.columns if "probability" in c})


@query
def prediction_drift(spark, sf_dir):
    summary = predictions.prediction_summary(_rule_scored(spark, sf_dir))
    # A handful of rows, stored as a run stores its baseline; both sides read them.
    baseline = stored(predictions.monitoring_metrics(summary), "baseline")
    current = testdata.shift_metrics(baseline, DRIFT_FACTORS)
    drift = predictions.prediction_drift(current, baseline)
    return drift.withColumns(
        {
            **{c: _round(c) for c in ("baseline", "current", "delta")},
            "drift_detected": F.col("drift_detected").cast("int"),
        }
    )


@query
def bucket_distribution(spark, sf_dir):
    return predictions.bucket_distribution(_rule_predictions(spark, sf_dir))


@query
def funnel_by_device(spark, sf_dir):
    return predictions.funnel_by_device(_rule_predictions(spark, sf_dir))


@query
def high_value_sessions(spark, sf_dir):
    return predictions.high_value_sessions(_rule_predictions(spark, sf_dir))


@query
def model_by_hour(spark, sf_dir):
    return predictions.model_by_hour(_rule_predictions(spark, sf_dir))


@query
def prediction_export_rule(spark, sf_dir):
    export = predictions.prediction_export(_rule_scored(spark, sf_dir), predicted_at=F.to_timestamp(F.lit(AS_OF)))
    return export.withColumns(
        {
            "event_date": _day("event_date"),
            "prediction_timestamp": _time("prediction_timestamp"),
            "categories_viewed": F.array_join("categories_viewed", ","),
        }
    )


def _rule_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The evaluation of two fixed scores: the rule, and the number of cart additions."""
    scored = stored(propensity.assign_split(_rule_scored(spark, sf_dir)), "rule-scores")
    scored = scored.withColumns(
        {"prediction": F.col("prediction_label").cast("double"), "carts": F.col("add_to_cart_events").cast("double")}
    )
    found = {
        propensity.LOGISTIC: propensity.score_metrics(scored, "probability_purchase"),
        propensity.BOOSTING: propensity.score_metrics(scored, "carts"),
    }
    rows = [(model, name, value) for model, values in found.items() for name, value in values.items()]
    return spark.createDataFrame(rows, "model_type STRING, metric STRING, value DOUBLE")


@query
def model_metrics_rule(spark, sf_dir):
    return _rule_metrics(spark, sf_dir).withColumn("value", _round("value"))


@query
def champion_rule(spark, sf_dir):
    best = propensity.pick_champion(_rule_metrics(spark, sf_dir))
    return best.withColumn("test_auc", _round("test_auc"))


# -- models -------------------------------------------------------------------
_trained: dict[tuple[str, str], tuple] = {}


def _prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return propensity.assign_split(
        propensity.add_label(features.engineer_features(_inputs(spark, sf_dir), TEST_CATEGORIES))
    )


def _models(spark: SparkSession, sf_dir: str) -> tuple:
    """Training rows and fitted candidates, once per session and data folder.

    The model queries share them as they would share a model in the registry.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _trained:
        inputs = features.engineer_features(_inputs(spark, sf_dir), TEST_CATEGORIES)
        prepared = propensity.prepare(inputs)
        columns = features.feature_columns(TEST_CATEGORIES)
        _trained[key] = prepared, propensity.train_candidates(prepared, columns)
    return _trained[key]


def _champion(spark: SparkSession, sf_dir: str):
    prepared, candidates = _models(spark, sf_dir)
    table = propensity.metrics_table(spark, candidates)
    return prepared, candidates[propensity.pick_champion(table).first()["model_type"]]


@query
def split_stats(spark, sf_dir):
    stats = propensity.split_stats(_prepared(spark, sf_dir))
    return stats.withColumn("positive_rate", _round("positive_rate"))


@query
def scaled_features(spark, sf_dir):
    """Standardised model inputs of all sessions; the scaler saw the training rows only."""
    columns = features.feature_columns(TEST_CATEGORIES)
    prepared = propensity.prepare(
        features.engineer_features(_inputs(spark, sf_dir), TEST_CATEGORIES)
    )
    scaling = propensity.fit_scaling(prepared.where("split = 'train'"), columns)
    scaled = vector_to_array("features")
    return (
        scaling.transform(prepared)
        .withColumn("scaled", scaled)
        .select(
            "session_id",
            "user_id",
            _day("event_date"),
            "split",
            *[F.round(F.col("scaled")[i], 4).alias(c) for i, c in enumerate(columns)],
        )
    )


def _scores(spark, sf_dir, model_type):
    prepared, candidates = _models(spark, sf_dir)
    scored = propensity.score(candidates[model_type].model, prepared)
    return scored.select(
        "session_id",
        "user_id",
        _day("event_date"),
        "split",
        "label",
        "prediction_label",
        _round("probability_purchase"),
    )


@query
def score_lr(spark, sf_dir):
    return _scores(spark, sf_dir, propensity.LOGISTIC)


@query
def score_gbt(spark, sf_dir):
    return _scores(spark, sf_dir, propensity.BOOSTING)


@query
def model_metrics(spark, sf_dir):
    return propensity.metrics_table(spark, _models(spark, sf_dir)[1])


@query
def champion(spark, sf_dir):
    return propensity.pick_champion(propensity.metrics_table(spark, _models(spark, sf_dir)[1]))


@query
def feature_importance(spark, sf_dir):
    _, best = _champion(spark, sf_dir)
    columns = features.feature_columns(TEST_CATEGORIES)
    return propensity.feature_importance(spark, best.model, columns).limit(10)


@query
def scored_sessions(spark, sf_dir):
    prepared, best = _champion(spark, sf_dir)
    scored = propensity.score(best.model, prepared.where("split = 'test'"))
    return scored.select(
        "session_id", "user_id", "label", "prediction_label", "probability_purchase",
        "page_views", "add_to_cart_events", "device_type",
    )


@query
def prediction_export(spark, sf_dir):
    prepared, best = _champion(spark, sf_dir)
    scored = propensity.score(best.model, prepared.where("split = 'test'"))
    export = predictions.prediction_export(scored, predicted_at=F.to_timestamp(F.lit(AS_OF)))
    return export.withColumns(
        {
            "event_date": _day("event_date"),
            "prediction_timestamp": _time("prediction_timestamp"),
            "categories_viewed": F.array_join("categories_viewed", ","),
        }
    )
