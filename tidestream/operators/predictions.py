"""Scored sessions: export rows, BI reports, distribution and drift."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidestream.constants import (
    DRIFT_ABOVE,
    MODEL_NAME,
    RETARGET_ABOVE,
    RETARGET_ROWS,
)
from tidestream.functions import probability_bucket

DRIFT_METRICS = ("avg_predicted_probability", "predicted_positive_rate")


def prediction_export(
    scored: DataFrame, model_version: str = "1", predicted_at: Column | None = None
) -> DataFrame:
    """Prediction rows for the warehouse, with bucket, model name and version."""
    return scored.select(
        "session_id",
        "user_id",
        "event_date",
        "event_hour",
        "prediction_label",
        F.col("probability_purchase").cast("double").alias("probability_purchase"),
        F.col("label").cast("int").alias("actual_converted"),
        "page_views",
        "add_to_cart_events",
        "unique_products_viewed",
        "session_duration_seconds",
        "device_type",
        "categories_viewed",
        (F.current_timestamp() if predicted_at is None else predicted_at).alias(
            "prediction_timestamp"
        ),
        F.lit(MODEL_NAME).alias("model_name"),
        F.lit(model_version).alias("model_version"),
        probability_bucket(F.col("probability_purchase")).alias("probability_bucket"),
    )


def confusion_matrix(scored: DataFrame) -> DataFrame:
    by_outcome = scored.groupBy("label", "prediction_label").count()
    return by_outcome.orderBy("label", "prediction_label")


def prediction_summary(scored: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """Mean, spread, median, 95th percentile, rows and positives of the predictions."""
    p = "probability_purchase"
    return scored.agg(
        F.avg(p).alias("avg_probability"),
        F.stddev(p).alias("stddev_probability"),
        F.percentile_approx(p, 0.5, accuracy).alias("median_probability"),
        F.percentile_approx(p, 0.95, accuracy).alias("p95_probability"),
        F.count("*").alias("total_predictions"),
        F.sum("prediction_label").alias("predicted_positives"),
    )


def monitoring_metrics(summary: DataFrame) -> DataFrame:
    """A prediction summary as (metric, value) rows."""
    values = {
        "avg_predicted_probability": F.col("avg_probability"),
        "stddev_predicted_probability": F.col("stddev_probability"),
        "median_predicted_probability": F.col("median_probability"),
        "p95_predicted_probability": F.col("p95_probability"),
        "total_predictions": F.col("total_predictions").cast("double"),
        "predicted_positive_rate": F.col("predicted_positives") / F.col("total_predictions"),
    }
    rows = [F.struct(F.lit(n).alias("metric"), v.alias("value")) for n, v in values.items()]
    return summary.select(F.inline(F.array(*rows)))


def prediction_drift(
    current: DataFrame, baseline: DataFrame, threshold: float = DRIFT_ABOVE
) -> DataFrame:
    """Absolute change of the watched metrics that both sides have, flagged above the threshold.

    Both inputs are metric rows, a handful each.
    """
    watched = F.col("metric").isin(*DRIFT_METRICS)
    both = (
        baseline.where(watched)
        .select("metric", F.col("value").alias("baseline"))
        .join(current.select("metric", F.col("value").alias("current")), "metric")
    )
    return both.withColumn("delta", F.abs(F.col("current") - F.col("baseline"))).withColumn(
        "drift_detected", F.col("delta") > threshold
    )


def bucket_distribution(predictions: DataFrame) -> DataFrame:
    """Sessions per probability bucket and their share in percent."""
    counts = predictions.groupBy("probability_bucket").agg(F.count("*").alias("session_count"))
    # One window over all rows is fine here: at most five buckets are left.
    total = F.sum("session_count").over(Window.partitionBy())
    share = F.round(F.col("session_count") * 100.0 / total, 1).cast("double")
    return counts.withColumn("pct", share).orderBy("probability_bucket")


def funnel_by_device(predictions: DataFrame) -> DataFrame:
    """Sessions, predicted conversions and their share in percent per device."""
    share = F.sum("prediction_label") * F.lit(100.0) / F.count("*")
    return (
        predictions.groupBy("device_type")
        .agg(
            F.count("*").alias("sessions"),
            F.sum("prediction_label").alias("predicted_conversions"),
            F.round(share, 1).alias("conversion_rate_pct"),
        )
        .orderBy(F.desc("conversion_rate_pct"), "device_type")
    )


def high_value_sessions(
    predictions: DataFrame, above: float = RETARGET_ABOVE, n: int = RETARGET_ROWS
) -> DataFrame:
    """The retargeting list: the n most probable purchases above the threshold."""
    return (
        predictions.where(F.col("probability_purchase") > above)
        .orderBy(F.desc("probability_purchase"), "session_id", "user_id", "event_date")
        .limit(n)
        .select(
            "session_id",
            "user_id",
            F.round(F.col("probability_purchase") * 100, 1).alias("purchase_probability_pct"),
            "page_views",
            "add_to_cart_events",
            "device_type",
        )
    )


def model_by_hour(predictions: DataFrame) -> DataFrame:
    """Predicted and actual purchases and mean probability in percent per hour of day."""
    return (
        predictions.groupBy("event_hour")
        .agg(
            F.count("*").alias("sessions"),
            F.sum("prediction_label").alias("predicted_purchases"),
            F.sum("actual_converted").alias("actual_purchases"),
            F.round(F.avg("probability_purchase") * 100, 1).alias("avg_probability_pct"),
        )
        .orderBy("event_hour")
    )
