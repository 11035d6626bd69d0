"""Event-time window metrics, for batch and streaming frames.

A sliding window puts each event into span/step windows. Counts and sums add up, so batch
frames are folded to one row per step first and only those rows are multiplied. A stream
groups by the sliding window directly and keeps a single stateful step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidestream.constants import ACTIVE_USER_LEVELS, CONVERSION_LEVELS, REVENUE_LEVELS
from tidestream.functions import is_type, money, traffic_light

_TIME = "event_timestamp"


def _sliding_sums(
    events: DataFrame, span: int, step: int, sums: dict[str, Column], keep_timeless: bool = False
) -> DataFrame:
    """Sum of 0/1 or numeric expressions per window of `span` seconds, every `step` seconds.

    With `keep_timeless`, rows of a batch without an event time form one row with null bounds.
    """
    if events.isStreaming:
        window = F.window(_TIME, f"{span} seconds", f"{step} seconds").alias("window")
        return _flat(events.groupBy(window).agg(*[F.sum(e).alias(n) for n, e in sums.items()]))
    if not keep_timeless:
        events = events.where(F.col(_TIME).isNotNull())
    second = F.unix_timestamp(_TIME)
    panes = events.groupBy((second - F.pmod(second, F.lit(step))).alias("pane")).agg(
        *[F.sum(e).alias(n) for n, e in sums.items()]
    )
    starts = F.when(
        F.col("pane").isNotNull(),
        F.sequence(F.col("pane") - (span - step), F.col("pane"), F.lit(step).cast("long")),
    ).otherwise(F.array(F.lit(None).cast("long")))
    totals = (
        panes.select(F.explode(starts).alias("start"), *sums)
        .groupBy("start")
        .agg(*[F.sum(n).alias(n) for n in sums])
    )
    return totals.select(
        F.timestamp_seconds("start").alias("window_start"),
        F.timestamp_seconds(F.col("start") + span).alias("window_end"),
        *sums,
    )


def _flat(windowed: DataFrame) -> DataFrame:
    return windowed.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *[c for c in windowed.columns if c != "window"],
    )


def _one_if(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def _users_by_window(events: DataFrame, width: str, keys: tuple[str, ...], users: str, exact: bool) -> DataFrame:
    """Events (total_events) and distinct users per window and keys.

    A stream that counts exactly does so in two stateful steps: one row per window, key and user, and
    behind the watermark their number. Either state is dropped with its window. Otherwise the
    users of a stream are a sketch with a standard error of about 5 %.
    """
    window = F.window(_TIME, width).alias("window")
    if events.isStreaming and exact:
        each = events.groupBy(window, *keys, "user_id").agg(F.count("*").alias("n"))
        counted = each.groupBy(F.window("window", width).alias("window"), *keys).agg(
            F.sum("n").alias("total_events"), F.count("user_id").alias(users)
        )
    else:
        distinct = F.approx_count_distinct if events.isStreaming else F.count_distinct
        counted = events.groupBy(window, *keys).agg(F.count("*").alias("total_events"), distinct("user_id").alias(users))
    return _flat(counted)


def category_minute(events: DataFrame, exact: bool = True) -> DataFrame:
    """Events and users per minute and product category."""
    return _users_by_window(events, "1 minute", ("product_category",), "unique_users", exact)


def event_rate(events: DataFrame, span_minutes: int = 5) -> DataFrame:
    """Events per second over the last minutes, every minute."""
    counts = _sliding_sums(events, span_minutes * 60, 60, {"total_events": F.lit(1)})
    seconds = F.lit(span_minutes * 60.0)
    return counts.withColumn("events_per_second", F.col("total_events") / seconds)


def conversion_window(events: DataFrame) -> DataFrame:
    """Purchases per 100 page views over the last hour, every five minutes.

    The rate is null where nothing was viewed.
    """
    counts = _sliding_sums(
        events,
        3600,
        300,
        {
            "purchases": _one_if(is_type("purchase")),
            "page_views": _one_if(is_type("page_view")),
        },
    )
    percent = F.when(
        F.col("page_views") > 0, F.col("purchases") * F.lit(100.0) / F.col("page_views")
    )
    return counts.withColumn("conversion_rate_pct", percent).withColumn(
        "status", traffic_light(F.col("conversion_rate_pct"), CONVERSION_LEVELS)
    )


def error_rate(flagged: DataFrame, span_minutes: int = 5) -> DataFrame:
    """Rejected events per second over the last minutes, from events with an is_valid flag.

    In a batch, events without a usable time are counted in one row with null bounds.
    """
    rejected = {"rejected_events": _one_if(~F.col("is_valid"))}
    windows = _sliding_sums(flagged, span_minutes * 60, 60, rejected, keep_timeless=True)
    seconds = F.lit(span_minutes * 60.0)
    return windows.withColumn("errors_per_second", F.col("rejected_events") / seconds)


def active_users(events: DataFrame, exact: bool = True) -> DataFrame:
    """Users per hour, with the dashboard colour."""
    hourly = _users_by_window(events, "1 hour", (), "active_users", exact).drop("total_events")
    return hourly.withColumn(
        "status", traffic_light(F.col("active_users"), ACTIVE_USER_LEVELS)
    )


def revenue_per_hour(purchases: DataFrame, value: str = "total_value") -> DataFrame:
    """Revenue per hour of purchase events (total_value) or order lines (line_value)."""
    paid = F.col(value)
    if "event_type" in purchases.columns:
        paid = F.when(is_type("purchase"), paid)
    hourly = purchases.groupBy(F.window(_TIME, "1 hour").alias("window")).agg(
        F.coalesce(money(paid), F.lit(0.0)).alias("revenue")
    )
    return _flat(hourly).withColumn("status", traffic_light(F.col("revenue"), REVENUE_LEVELS))


def pipeline_latency(events: DataFrame) -> DataFrame:
    """Median and 95th percentile of processed_at - event time per minute, in seconds."""
    lag = (F.unix_micros("processed_at") - F.unix_micros(_TIME)) / F.lit(1e6)
    per_minute = (
        events.select(_TIME, lag.alias("lag"))
        .groupBy(F.window(_TIME, "1 minute").alias("window"))
        .agg(
            F.count("*").alias("events"),
            F.percentile_approx("lag", 0.5).alias("p50_seconds"),
            F.percentile_approx("lag", 0.95).alias("p95_seconds"),
        )
    )
    return _flat(per_minute)
