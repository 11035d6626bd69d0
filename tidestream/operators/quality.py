"""Validation, de-duplication, data quality and freshness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidestream.constants import PRODUCT_EVENT_TYPES

# Columns that say when and how a row was processed; two runs may differ in them.
_PER_RUN = ("processed_at", "batch_id")


def has_keys() -> Column:
    """User, session and event type are all present."""
    return (
        F.col("user_id").isNotNull()
        & F.col("session_id").isNotNull()
        & F.col("event_type").isNotNull()
    )


def has_timestamp() -> Column:
    """The timestamp text is present and not empty (it may still fail to parse)."""
    return F.col("timestamp").isNotNull() & (F.length("timestamp") > 0)


def has_product(accept_carts: bool = False) -> Column:
    """Product events name a product; with `accept_carts`, a filled cart will do too.

    Real purchases list their products in the cart only, so the bare rule loses them all.
    """
    missing = F.col("product_id").isNull()
    if accept_carts:
        missing = missing & ~(F.coalesce(F.size("cart_items"), F.lit(0)) > 0)
    return ~(F.col("event_type").isin(*PRODUCT_EVENT_TYPES) & missing)


def is_valid(accept_carts: bool = False) -> Column:
    """True for events that pass every row rule, false for all others (never null)."""
    rules = has_keys() & has_timestamp() & has_product(accept_carts)
    return F.coalesce(rules, F.lit(False))


def drop_missing_keys(events: DataFrame) -> DataFrame:
    return events.where(has_keys())


def drop_missing_timestamps(events: DataFrame) -> DataFrame:
    return events.where(has_timestamp())


def drop_missing_products(events: DataFrame, accept_carts: bool = False) -> DataFrame:
    return events.where(has_product(accept_carts))


def drop_duplicate_events(events: DataFrame) -> DataFrame:
    """The earliest row per event_id, by parsed time; rows without a usable time come last.

    Copies of the same time are told apart by broker partition and offset, then by a hash of
    the row, so the choice is the same under every partitioning and when a task is repeated.
    Spark keeps only the first row per id of each task before the shuffle, so an id that
    arrives in masses is never gathered in one place. Rows without an id fold into one.
    """
    order = [F.try_to_timestamp("timestamp").asc_nulls_last()]
    if "kafka_metadata" in events.columns:
        order += [F.col(f"kafka_metadata.{c}").asc_nulls_last() for c in ("partition", "offset")]
    order.append(F.xxhash64(*[F.col(f"`{c}`") for c in events.columns if c not in _PER_RUN]))
    ranked = events.withColumn("copy", F.row_number().over(Window.partitionBy("event_id").orderBy(*order)))
    return ranked.where(F.col("copy") == 1).drop("copy")


def validate_events(events: DataFrame, accept_carts: bool = False) -> DataFrame:
    """Row rules first, as filters do not move below a de-duplication, then one row per id."""
    return drop_duplicate_events(events.where(is_valid(accept_carts)))


def data_quality(events: DataFrame, accept_carts: bool = False) -> DataFrame:
    """Events received, valid distinct events, and their share in percent; one pass.

    Valid events without an id all fold into one, as they do in `validate_events`.
    """
    valid = is_valid(accept_carts)
    counts = events.agg(
        F.count("*").alias("total_events"),
        (
            F.count_distinct(F.when(valid, F.col("event_id")))
            + F.coalesce(F.max(F.when(valid & F.col("event_id").isNull(), 1)), F.lit(0))
        ).alias("valid_events"),
    )
    return counts.withColumn(
        "data_quality_rate",
        F.when(F.col("total_events") > 0, F.col("valid_events") * 100.0 / F.col("total_events"))
        .otherwise(F.lit(0.0))
        .cast("double"),
    )


def freshness(
    loaded: DataFrame,
    as_of: str,
    max_age: str = "INTERVAL 1 HOUR",
    loaded_at: str = "processed_at",
) -> DataFrame:
    """Whether the newest row of the as-of day is recent: fresh, stale or missing.

    Reads one day only: by the year/month/day folders where the table has them, else by
    event_date.
    """
    now = F.to_timestamp(F.lit(as_of))
    if {"year", "month", "day"} <= set(loaded.columns):
        year, month, day = (int(part) for part in as_of[:10].split("-"))
        today = (F.col("year") == year) & (F.col("month") == month) & (F.col("day") == day)
    else:
        today = F.col("event_date") == F.to_date(F.lit(as_of[:10]))
    newest = loaded.where(today).agg(F.max(loaded_at).alias("latest"))
    age = F.unix_timestamp(now) - F.unix_timestamp("latest")
    return newest.select(
        "latest",
        age.alias("age_seconds"),
        F.when(F.col("latest").isNull(), "missing")
        .when(F.col("latest") < now - F.expr(max_age), "stale")
        .otherwise("fresh")
        .alias("status"),
    )
