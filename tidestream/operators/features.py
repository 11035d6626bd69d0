"""Model features from session inputs; every expression stays in Catalyst."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidestream.constants import CATEGORIES, DEVICE_TYPES
from tidestream.functions import category_column, flag

# Log feature and the column it is taken from.
LOG_FEATURES = {
    "log_page_views": "page_views",
    "log_duration": "session_duration_seconds",
    "log_add_to_cart": "add_to_cart_events",
    "log_search": "search_events",
    "log_unique_products": "unique_products_viewed",
}
# First and last hour of each part of the day.
DAY_PARTS = {
    "hour_morning": (6, 11),
    "hour_afternoon": (12, 17),
    "hour_evening": (18, 23),
    "hour_night": (0, 5),
}
LABEL = "converted_to_purchase"


def feature_columns(categories: Sequence[str] = CATEGORIES) -> list[str]:
    """Model inputs in order. Desktop is left out: it follows from the other two devices."""
    return [
        *LOG_FEATURES,
        "device_mobile",
        "device_tablet",
        "is_weekend",
        *DAY_PARTS,
        *[category_column(c) for c in categories],
        "browse_to_product_ratio",
    ]


def engineer_features(inputs: DataFrame, categories: Sequence[str] = CATEGORIES) -> DataFrame:
    """Adds logs, device, weekend, day-part and category flags and the product ratio."""
    products, views = F.col("unique_products_viewed"), F.col("page_views")
    return inputs.withColumns(
        {
            **{name: F.log1p(source) for name, source in LOG_FEATURES.items()},
            **{f"device_{d}": flag(F.col("device_type") == d) for d in DEVICE_TYPES},
            "is_weekend": flag(F.col("day_of_week").isin(5, 6)),
            **{p: flag(F.col("event_hour").between(*hours)) for p, hours in DAY_PARTS.items()},
            **{
                category_column(c): flag(F.array_contains("categories_viewed", c))
                for c in categories
            },
            "browse_to_product_ratio": products / (views + 1),
        }
    )
