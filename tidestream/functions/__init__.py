"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidestream.constants import PROBABILITY_BUCKETS, TOP_BUCKET


def rate(part: Column, whole: Column) -> Column:
    """part / whole as a double, 0 where there is nothing to divide by."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def flag(condition: Column) -> Column:
    """1 or 0; an unknown condition counts as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def money(amounts: Column) -> Column:
    """A sum of amounts in whole cents, exact: it does not depend on the order of summation."""
    exact = F.sum(F.round(amounts, 6).cast("decimal(28,6)"))
    return F.round(exact, 2).cast("double")


def is_type(event_type: str) -> Column:
    return F.col("event_type") == event_type


def count_type(event_type: str) -> Column:
    """Number of events of one type."""
    return F.count_if(is_type(event_type))


def traffic_light(value: Column, levels: tuple[float, float]) -> Column:
    """Dashboard colour of a value; null stays null."""
    yellow, green = levels
    return (
        F.when(value >= green, "green").when(value >= yellow, "yellow").when(value.isNotNull(), "red")
    )


def probability_bucket(probability: Column) -> Column:
    """Label of the half-open fifth that holds a probability."""
    label = F.lit(TOP_BUCKET)
    for bound, name in reversed(PROBABILITY_BUCKETS):
        label = F.when(probability < bound, name).otherwise(label)
    return label


def category_column(category: str) -> str:
    """Feature column of a category: lower case, ' & ' and blanks as one underscore."""
    return "cat_" + category.lower().replace(" & ", "_").replace(" ", "_")


def hash_percent(key: Column) -> Column:
    """A stable 0-99 number per key, the same under every partitioning and engine."""
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long") % 100


def spread_counts(counts: Column) -> Column:
    """array<struct<value, n>> back to a flat array holding each value n times."""
    return F.flatten(F.transform(counts, lambda c: F.array_repeat(c["value"], c["n"].cast("int"))))


def render_counts(counts: Column) -> Column:
    """array<struct<value, n>> as text such as `Clothing:1,Sports:3`."""
    return F.array_join(
        F.transform(counts, lambda c: F.concat(c["value"], F.lit(":"), c["n"].cast("string"))), ","
    )
