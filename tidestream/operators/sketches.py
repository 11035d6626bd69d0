"""Summaries of a span of time that merge into those of longer spans: frequent products, quantiles.

A minute keeps its most viewed products and the largest count it has left out. Over any span, a product
has at least the sum of its kept counts and at most that plus what the minutes without it left out; so
the true top products are among those whose upper bound reaches the n-th lower bound, unless that is
within what a product kept nowhere can have, and an exact count of these few settles the order. Delays and scores are kept as KLL sketches, whose rank error
is about 1.3 % at the default size, merged or not.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_TIME = "event_timestamp"
KEPT = 100
KLL_SIZE = 200


def product_minutes(events: DataFrame) -> DataFrame:
    """Events per minute and product (window_start, product_id, views); batch or stream."""
    named = events.where(F.col("product_id").isNotNull())
    counted = named.groupBy(F.window(_TIME, "1 minute").alias("window"), "product_id").agg(F.count("*").alias("views"))
    return counted.select(F.col("window.start").alias("window_start"), "product_id", "views")


def frequent_products(minutes: DataFrame, kept: int = KEPT) -> DataFrame:
    """The summary of each minute: its `kept` most viewed products and, in every row, the largest count left out.

    `minutes` are whole minutes, in a batch frame; equal counts go by product. A row takes a few bytes, so a day
    is at most 1,440 times `kept` rows, however many products there are.
    """
    order = Window.partitionBy("window_start").orderBy(F.desc("views"), "product_id")
    # One row more than is kept: the first one left out has the largest count left out.
    first = minutes.withColumn("place", F.row_number().over(order)).where(F.col("place") <= kept + 1)
    left_out = F.coalesce(F.max(F.when(F.col("place") == kept + 1, F.col("views"))).over(Window.partitionBy("window_start")), F.lit(0))
    return first.withColumn("left_out", left_out).where(F.col("place") <= kept).drop("place")


def in_span(frame: DataFrame, since: dt.datetime | str, until: dt.datetime | str, time: str = "window_start") -> DataFrame:
    """Rows with `since` <= time < `until`."""
    low, high = (F.to_timestamp(F.lit(str(t))) for t in (since, until))
    return frame.where((F.col(time) >= low) & (F.col(time) < high))


def combined_products(summaries: DataFrame) -> DataFrame:
    """Bounds of the views of every kept product over all minutes of `summaries`: product_id, at_least, at_most."""
    minutes = summaries.groupBy("window_start").agg(F.max("left_out").alias("left_out"))
    everywhere = minutes.agg(F.sum("left_out")).first()[0] or 0
    totals = summaries.groupBy("product_id").agg(F.sum("views").alias("at_least"), F.sum("left_out").alias("own_left_out"))
    # In minutes without the product it has at most what they left out.
    most = F.col("at_least") + F.lit(everywhere) - F.col("own_left_out")
    return totals.select("product_id", "at_least", most.alias("at_most"))


def top_products_live(summaries: DataFrame, n: int = 10) -> DataFrame:
    """The n products with the largest lower bounds, for a dashboard: product_id, at_least, at_most."""
    return combined_products(summaries).orderBy(F.desc("at_least"), "product_id").limit(n)


def top_candidates(summaries: DataFrame, n: int = 10) -> DataFrame | None:
    """All products that can be among the n most viewed, with their bounds.

    None where the summaries can't tell: a product that no minute kept may have as many views as the n-th
    lower bound. More rows per minute (`kept`) help then.
    """
    bounds = combined_products(summaries)
    minutes = summaries.groupBy("window_start").agg(F.max("left_out").alias("left_out"))
    unkept = minutes.agg(F.sum("left_out")).first()[0] or 0
    lower = bounds.orderBy(F.desc("at_least"), "product_id").limit(n)
    nth, found = lower.agg(F.min("at_least"), F.count("*")).first()
    if unkept and (found < n or nth <= unkept):
        return None
    return bounds.where(F.col("at_most") >= F.lit(nth))


def top_products_exact(minutes: DataFrame, summaries: DataFrame, n: int = 10) -> DataFrame:
    """The true n most viewed products of a span, by counting only the candidates of its summaries.

    `minutes` (or events counted by minute) and `summaries` cover the same span. Candidates are a few
    times n rows where counts are skewed; Spark joins them as their measured size allows. Where the
    summaries can't name all candidates, every product is counted.
    """
    candidates = top_candidates(summaries, n)
    rows = minutes if candidates is None else minutes.join(candidates.select("product_id"), "product_id")
    counted = rows.groupBy("product_id").agg(F.sum("views").alias("views"))
    return counted.orderBy(F.desc("views"), "product_id").limit(n)


def delay_sketches(events: DataFrame) -> DataFrame:
    """Per minute, events and a sketch of processed_at - event time in seconds (window_start, events, sketch)."""
    lag = (F.unix_micros("processed_at") - F.unix_micros(_TIME)) / F.lit(1e6)
    grouped = events.select(_TIME, lag.alias("lag")).groupBy(F.window(_TIME, "1 minute").alias("window"))
    made = grouped.agg(F.count("lag").alias("events"), F.kll_sketch_agg_double("lag", F.lit(KLL_SIZE)).alias("sketch"))
    return made.select(F.col("window.start").alias("window_start"), "events", "sketch")


def score_sketch(scored: DataFrame, score: str = "probability_purchase") -> DataFrame:
    """One row (events, sketch) for the scores of a run, to be stored with its baseline."""
    return scored.agg(F.count(score).alias("events"), F.kll_sketch_agg_double(score, F.lit(KLL_SIZE)).alias("sketch"))


def quantiles(sketches: DataFrame, *keys, shares: dict[str, float] | None = None) -> DataFrame:
    """Quantiles of the merged sketches per key (all in one without keys): keys, events, and one column per share.

    Sketches without values are left out; the default is the median and the 95th percentile.
    """
    shares = shares or {"p50": 0.5, "p95": 0.95}
    filled = sketches.where(F.col("events") > 0)
    merged = filled.groupBy(*keys).agg(F.sum("events").alias("events"), F.kll_merge_agg_double("sketch").alias("merged"))
    found = {name: F.kll_sketch_get_quantile_double("merged", F.lit(share)) for name, share in shares.items()}
    return merged.where(F.col("events") > 0).withColumns(found).drop("merged")


def hourly_delays(sketches: DataFrame) -> DataFrame:
    """Delay quantiles of every hour from the sketches of its minutes."""
    return quantiles(sketches, F.date_trunc("hour", "window_start").alias("hour"))
