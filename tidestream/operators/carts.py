"""Shopping carts as order lines, and the value of lines and orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidestream.functions import is_type, money

_ITEM_FIELDS = ("product_id", "product_name", "product_category", "product_price", "quantity")


def expand_carts(events: DataFrame) -> DataFrame:
    """One row per cart item; events without a cart keep their single row.

    Item fields take the place of the event's own, total_value becomes the line value and
    line_number counts from 0. Lines share their event_id, so remove duplicate events first.
    """
    lines = events.select("*", F.posexplode_outer("cart_items").alias("line_number", "item"))
    in_cart = F.col("item").isNotNull()
    line_value = F.col("item.product_price") * F.col("item.quantity")
    return lines.withColumns(
        {
            **{f: F.when(in_cart, F.col(f"item.{f}")).otherwise(F.col(f)) for f in _ITEM_FIELDS},
            "total_value": F.when(in_cart, line_value).otherwise(F.col("total_value")),
        }
    ).drop("item", "cart_items")


def purchase_lines(events: DataFrame) -> DataFrame:
    """One row per item bought, with line_value = price x quantity."""
    items = events.where(is_type("purchase")).select(
        "order_id",
        "event_id",
        "user_id",
        "session_id",
        "event_timestamp",
        F.posexplode("cart_items").alias("line_number", "item"),
    )
    return items.select(
        *[c for c in items.columns if c != "item"],
        *[F.col(f"item.{field}").alias(field) for field in _ITEM_FIELDS],
        (F.col("item.product_price") * F.col("item.quantity")).alias("line_value"),
    )


def order_values(lines: DataFrame) -> DataFrame:
    """Number of lines and total value per order."""
    return lines.groupBy("order_id").agg(
        F.count("*").alias("line_count"), money(F.col("line_value")).alias("total_value")
    )
