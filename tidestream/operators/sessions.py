"""Session metrics, built so that one enormous session cannot sink a task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidestream.functions import flag, is_type, rate, spread_counts

SESSION_KEYS = ("session_id", "user_id", "event_date")
SESSION_MEASURES = (
    "page_views",
    "unique_products_viewed",
    "add_to_cart_events",
    "search_events",
    "session_duration_seconds",
)


def session_cells(events: DataFrame) -> DataFrame:
    """Events folded to cells per session: one for all events, one per product, category and device.

    Grouping by session and cell spreads a hot session over many tasks, and partial aggregation
    leaves few rows of it to shuffle. The product cells make the later distinct count a plain
    one, and the category and device cells are the session's tallies already.
    """
    values = {
        "product": F.col("product_id"),
        "category": F.col("product_category"),
        "device": F.col("device_info.type"),
    }
    of_event = F.struct(F.lit("event").alias("kind"), F.lit(None).cast("string").alias("value"))
    named = [F.when(v.isNotNull(), F.struct(F.lit(k).alias("kind"), v.alias("value"))) for k, v in values.items()]
    rows = events.select(*SESSION_KEYS, "event_type", "event_timestamp", F.inline(F.array_compact(F.array(of_event, *named))))
    return rows.groupBy(*SESSION_KEYS, "kind", "value").agg(
        F.count("*").alias("n"),
        F.count_if(is_type("add_to_cart")).alias("carts"),
        F.count_if(is_type("purchase")).alias("purchases"),
        F.count_if(is_type("search")).alias("searches"),
        F.min("event_timestamp").alias("first_at"),
        F.max("event_timestamp").alias("last_at"),
    )


def session_metrics(events: DataFrame) -> DataFrame:
    """One row per (session, user, day).

    page_views counts events of every type, and a session that crosses midnight gives one
    row per day. categories_viewed and devices_used hold each value once; how often each
    occurred is in category_counts and device_counts, so a session with any number of
    events stays a small row (`with_full_lists` spells the repeats out). device_type is the
    device of the session's first event.
    """
    return sessions_from_cells(session_cells(events))


def sessions_from_cells(cells: DataFrame) -> DataFrame:
    """The rows of `session_metrics` from session cells, one for every key and value."""

    def of(kind: str, value: Column) -> Column:
        return F.when(F.col("kind") == kind, value)

    tally = F.struct(F.col("value").alias("value"), F.col("n").alias("n"))
    first = F.when(F.col("first_at").isNotNull(), F.struct("first_at", "value"))
    counted = (
        cells
        .groupBy(*SESSION_KEYS)
        .agg(
            F.sum(of("event", F.col("n"))).alias("page_views"),
            F.count(of("product", F.col("value"))).alias("unique_products_viewed"),
            F.sum(of("event", F.col("carts"))).alias("add_to_cart_events"),
            F.sum(of("event", F.col("purchases"))).alias("purchase_events"),
            F.sum(of("event", F.col("searches"))).alias("search_events"),
            F.min("first_at").alias("session_start"),
            F.max("last_at").alias("session_end"),
            # One entry per distinct category and per distinct device of the session.
            F.array_sort(F.collect_list(of("category", tally))).alias("category_counts"),
            F.array_sort(F.collect_list(of("device", tally))).alias("device_counts"),
            F.min(of("device", first))["value"].alias("device_type"),
        )
    )
    seconds = F.unix_timestamp("session_end") - F.unix_timestamp("session_start")
    return counted.select(
        *SESSION_KEYS,
        "page_views",
        "unique_products_viewed",
        "add_to_cart_events",
        "purchase_events",
        "search_events",
        "session_start",
        "session_end",
        F.col("category_counts.value").alias("categories_viewed"),
        F.col("device_counts.value").alias("devices_used"),
        "category_counts",
        "device_counts",
        "device_type",
        seconds.alias("session_duration_seconds"),
        (F.col("purchase_events") > 0).alias("converted_to_purchase"),
        (F.col("add_to_cart_events") > 0).alias("converted_to_cart"),
    )


def with_full_lists(sessions: DataFrame) -> DataFrame:
    """categories_viewed and devices_used with one entry per event, in sorted order."""
    return sessions.withColumns(
        {
            "categories_viewed": spread_counts(F.col("category_counts")),
            "devices_used": spread_counts(F.col("device_counts")),
        }
    )


def session_inputs(sessions: DataFrame) -> DataFrame:
    """The session row that features are made from; day_of_week counts from Monday = 0."""
    return sessions.select(
        *SESSION_KEYS,
        F.coalesce(F.hour("session_start"), F.lit(0)).alias("event_hour"),
        F.coalesce(F.weekday("event_date"), F.lit(0)).alias("day_of_week"),
        "page_views",
        "unique_products_viewed",
        "add_to_cart_events",
        "search_events",
        F.coalesce("session_duration_seconds", F.lit(0))
        .cast("double")
        .alias("session_duration_seconds"),
        F.coalesce("device_type", F.lit("unknown")).alias("device_type"),
        "devices_used",
        "categories_viewed",
        F.size("categories_viewed").alias("n_categories_viewed"),
        "converted_to_purchase",
    )


def conversion_rate(sessions: DataFrame) -> DataFrame:
    """Sessions, conversions and the overall conversion rate."""
    return _conversions(sessions.groupBy())


def conversion_by_device(sessions: DataFrame) -> DataFrame:
    """Conversion per device type, best first."""
    by_device = _conversions(sessions.groupBy("device_type"))
    return by_device.orderBy(F.desc("conversion_rate"), "device_type")


def conversion_by_hour(sessions: DataFrame) -> DataFrame:
    """Conversion per hour of the day in which the session began."""
    return _conversions(sessions.groupBy("event_hour")).orderBy("event_hour")


def _conversions(grouped) -> DataFrame:
    return grouped.agg(
        F.count("*").alias("sessions"),
        F.count_if("converted_to_purchase").alias("conversions"),
        rate(F.sum(flag(F.col("converted_to_purchase"))), F.count("*")).alias("conversion_rate"),
    )


def describe_sessions(sessions: DataFrame, measures: tuple[str, ...] = SESSION_MEASURES) -> DataFrame:
    """count, mean, stddev, min and max of each measure, one row per measure."""
    statistics = {"count": F.count, "mean": F.avg, "stddev": F.stddev, "min": F.min, "max": F.max}
    totals = sessions.agg(
        *[
            F.struct(
                F.lit(m).alias("measure"),
                *[f(F.col(m).cast("double")).alias(name) for name, f in statistics.items()],
            ).alias(m)
            for m in measures
        ]
    )
    return totals.select(F.inline(F.array(*measures)))
