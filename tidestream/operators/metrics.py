"""Product, category, device, hourly, daily and revenue metrics.

Sums and counts combine on the map side. Exact distinct counts shuffle by group key and
counted value together, so one hot hour or product is spread over many tasks; several of them
make as many copies of the rows before the shuffle. With `approximate`, they are sketches with a
standard error of about 5 %, which take one pass and combine on the map side too.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidestream.functions import count_type, is_type, money, rate

PRODUCT_KEYS = ("product_id", "event_date")
PRODUCT_NAMES = ("product_name", "product_category", "product_brand")


def _distinct(column: str, approximate: bool) -> Column:
    return F.approx_count_distinct(column) if approximate else F.count_distinct(column)


def product_metrics(events: DataFrame, approximate: bool = False) -> DataFrame:
    """Per product and day: events, users, sessions, cart adds, purchases, price and rates.

    The product is its id. Carts carry no brand and spellings differ between events, so name,
    category and brand are no keys: each is the largest value that the day's events have.
    total_views counts events of every type and total_value sums the price over all of
    them; revenue is in `revenue_per_hour` and `revenue_by_period`.
    """
    totals = (
        events.where(F.col("product_id").isNotNull())
        .groupBy(*PRODUCT_KEYS)
        .agg(
            *[F.max(c).alias(c) for c in PRODUCT_NAMES],
            F.count("*").alias("total_views"),
            _distinct("user_id", approximate).alias("unique_users"),
            _distinct("session_id", approximate).alias("unique_sessions"),
            count_type("add_to_cart").alias("add_to_cart_count"),
            count_type("purchase").alias("purchase_count"),
            F.avg("product_price").alias("avg_price"),
            F.sum("product_price").alias("total_value"),
        )
    )
    views, carts, bought = (
        F.col(c) for c in ("total_views", "add_to_cart_count", "purchase_count")
    )
    return totals.withColumns(
        {
            "view_to_cart_rate": rate(carts, views),
            "view_to_purchase_rate": rate(bought, views),
            "cart_to_purchase_rate": rate(bought, carts),
        }
    )


def hourly_metrics(events: DataFrame, approximate: bool = False) -> DataFrame:
    """Events, users, sessions and events by type per day and hour."""
    return events.groupBy("event_date", "event_hour").agg(
        F.count("*").alias("total_events"),
        _distinct("user_id", approximate).alias("unique_users"),
        _distinct("session_id", approximate).alias("unique_sessions"),
        count_type("page_view").alias("page_views"),
        count_type("add_to_cart").alias("add_to_cart"),
        count_type("purchase").alias("purchases"),
        count_type("search").alias("searches"),
    )


def category_metrics(events: DataFrame, approximate: bool = False) -> DataFrame:
    """Events, users, cart adds and purchases per category and day."""
    return (
        events.where(F.col("product_category").isNotNull())
        .groupBy("product_category", "event_date")
        .agg(
            F.count("*").alias("category_views"),
            _distinct("user_id", approximate).alias("unique_users"),
            count_type("add_to_cart").alias("add_to_cart"),
            count_type("purchase").alias("purchases"),
        )
    )


def device_metrics(events: DataFrame) -> DataFrame:
    """Events per day on mobile, desktop and tablet; unknown devices count nowhere."""
    return events.groupBy("event_date").agg(
        F.count_if("is_mobile").alias("mobile_events"),
        F.count_if("is_desktop").alias("desktop_events"),
        F.count_if("is_tablet").alias("tablet_events"),
    )


def event_type_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type").count()


def processing_summary(events: DataFrame, approximate: bool = False) -> DataFrame:
    """Totals of a batch in one job: events, users, sessions and products."""
    return events.agg(
        F.count("*").alias("total_events_processed"),
        _distinct("user_id", approximate).alias("unique_users"),
        _distinct("session_id", approximate).alias("unique_sessions"),
        _distinct("product_id", approximate).alias("unique_products"),
    )


def since_yesterday(date: str, as_of: str | dt.date | None = None, by_parts: bool = False) -> Column:
    """The date column is no earlier than the day before `as_of` (default today).

    With `by_parts` also by year, month and day columns, which prunes the folders of a table
    divided by them; later days than the as-of day are then left out.
    """
    today = F.current_date() if as_of is None else F.to_date(F.lit(str(as_of)))
    recent = F.col(date) >= F.date_sub(today, 1)
    if not by_parts:
        return recent
    last = dt.date.today() if as_of is None else dt.date.fromisoformat(str(as_of)[:10])
    days = [last - dt.timedelta(days=k) for k in (0, 1)]
    parts = [(F.col("year") == d.year) & (F.col("month") == d.month) & (F.col("day") == d.day) for d in days]
    return recent & (parts[0] | parts[1])


def daily_activity(
    events: DataFrame, as_of: str | None = None, approximate: bool = False
) -> DataFrame:
    """Events, users and purchases of the last two days, newest first."""
    return (
        events.where(since_yesterday("event_date", as_of))
        .groupBy(F.col("event_date").alias("date"))
        .agg(
            F.count("*").alias("total_events"),
            _distinct("user_id", approximate).alias("unique_users"),
            count_type("purchase").alias("purchases"),
        )
        .orderBy(F.desc("date"))
    )


def daily_summary(
    events: DataFrame, as_of: str | None = None, approximate: bool = False
) -> DataFrame:
    """The daily report of the last two days."""
    return (
        events.where(since_yesterday("event_date", as_of))
        .groupBy(F.col("event_date").alias("report_date"))
        .agg(
            F.count("*").alias("total_events"),
            _distinct("user_id", approximate).alias("unique_users"),
            _distinct("session_id", approximate).alias("unique_sessions"),
            count_type("purchase").alias("total_purchases"),
            count_type("add_to_cart").alias("total_add_to_cart"),
            F.avg(F.when(is_type("purchase"), F.col("product_price"))).alias("avg_purchase_value"),
        )
    )


def top_products(events: DataFrame, n: int = 10) -> DataFrame:
    """The n products with the most events."""
    views = (
        events.where(F.col("product_id").isNotNull())
        .groupBy("product_id")
        .agg(F.count("*").alias("views"))
    )
    return views.orderBy(F.desc("views"), "product_id").limit(n)


def geo_distribution(events: DataFrame, approximate: bool = False) -> DataFrame:
    """Events and users per city."""
    return events.groupBy(F.col("location.city").alias("city")).agg(
        F.count("*").alias("total_events"), _distinct("user_id", approximate).alias("unique_users")
    )


def category_conversion(categories: DataFrame) -> DataFrame:
    """Purchases per event of each category, from the daily category metrics."""
    return categories.groupBy("product_category").agg(
        F.sum("category_views").alias("category_views"),
        F.sum("purchases").alias("purchases"),
        rate(F.sum("purchases"), F.sum("category_views")).alias("conversion_rate"),
    )


def top_sellers(lines: DataFrame, n: int = 10) -> DataFrame:
    """The n products with the most units sold."""
    sold = lines.groupBy("product_id").agg(
        F.sum("quantity").alias("units_sold"), money(F.col("line_value")).alias("revenue")
    )
    return sold.orderBy(F.desc("units_sold"), "product_id").limit(n)


def revenue_by_period(lines: DataFrame, period: str = "day") -> DataFrame:
    """Orders, revenue and average order value per day, week, month, ..."""
    return lines.groupBy(F.date_trunc(period, "event_timestamp").alias("period_start")).agg(
        F.count_distinct("order_id").alias("orders"),
        money(F.col("line_value")).alias("revenue"),
        rate(money(F.col("line_value")), F.count_distinct("order_id")).alias("avg_order_value"),
    )


def customer_value(lines: DataFrame) -> DataFrame:
    """Lifetime revenue, orders and first and last purchase of each user."""
    return lines.groupBy("user_id").agg(
        money(F.col("line_value")).alias("lifetime_value"),
        F.count_distinct("order_id").alias("orders"),
        F.min("event_timestamp").alias("first_purchase"),
        F.max("event_timestamp").alias("last_purchase"),
    )
