"""The driver's test tables seen as clickstream events (mapping in FIXTURES.md)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidestream.constants import CLICKSTREAM_TOPIC, TRANSACTIONS_TOPIC
from tidestream.operators.enrich import enrich_events
from tidestream.operators.quality import validate_events
from tidestream.session import configure

# How the test table's event types are read.
_EVENT_NAMES = {"view": "page_view", "click": "add_to_cart", "signup": "search"}
# The six values that p_type takes stand in for the product categories.
TEST_CATEGORIES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
# Weights of the test score, device factors and score limits.
RULE_BASE = 0.025
RULE_CART_WEIGHT = 0.35
RULE_LOG_VIEWS_WEIGHT = 0.018
RULE_LOG_SECONDS_WEIGHT = 0.010
RULE_SEARCH_WEIGHT = 0.012
RULE_DEVICE_FACTORS = {"mobile": 0.75, "tablet": 0.85}
RULE_LIMITS = (0.01, 0.90)
# The test events end in January 2024.
AS_OF = "2024-01-30"


# Declared, so that planning reads no file footers.
_TABLES = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
    "value DOUBLE, props STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
    "p_retailprice DOUBLE",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
    "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
    "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _every(n: int) -> Column:
    """The rows that get a defect: those whose number is a multiple of n."""
    return F.col("number") % n == 0


def clickstream(spark: SparkSession, sf_dir: str, with_products: bool = True) -> DataFrame:
    """All events, some with injected defects (missing fields) and some delivered twice.

    The product lookup is a plain left join: Spark broadcasts `part` where its measured size
    allows, and otherwise adaptive execution splits the partitions of hot products.
    """
    configure(spark)
    source = table(spark, sf_dir, "events")
    names = [F.lit(text) for pair in _EVENT_NAMES.items() for text in pair]
    renamed = F.coalesce(F.try_element_at(F.create_map(*names), F.col("event_type")), "event_type")
    events = source.select(
        F.col("event_id").alias("number"),
        "ts",
        F.col("user_id").alias("uid"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        renamed.alias("kind"),
    )
    part = table(spark, sf_dir, "part")
    if with_products:
        events = events.join(part, F.col("k") == F.col("p_partkey"), "left")
    else:
        blank = {"p_partkey": "long", "p_name": "string", "p_type": "string",
                 "p_retailprice": "double", "p_brand": "string"}
        events = events.withColumns({c: F.lit(None).cast(t) for c, t in blank.items()})

    twice = F.explode(
        F.when(_every(50), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    )
    about_product = ~F.col("kind").isin("search", "error")
    slot = F.col("k") % 5
    device = (
        F.when(F.col("k") % 10 == 9, None)
        .when(slot.isin(0, 1), "desktop")
        .when(slot.isin(2, 3), "mobile")
        .otherwise("tablet")
    )
    no_text = F.lit(None).cast("string")
    no_number = F.lit(None).cast("double")
    return events.withColumn("delivery", twice).select(
        F.concat(F.lit("e_"), F.col("number").cast("string")).alias("event_id"),
        F.when(~_every(61), F.col("kind")).alias("event_type"),
        F.when(_every(71), "")
        .when(~_every(73), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
        .alias("timestamp"),
        F.when(~_every(97), F.concat(F.lit("user_"), F.col("uid").cast("string"))).alias("user_id"),
        F.when(
            ~_every(89),
            F.concat_ws("_", F.lit("s"), F.col("uid").cast("string"), F.to_date("ts").cast("string")),
        ).alias("session_id"),
        F.when(
            about_product & ~_every(41), F.concat(F.lit("P"), F.col("p_partkey").cast("string"))
        ).alias("product_id"),
        F.when(about_product, F.col("p_name")).alias("product_name"),
        F.when(about_product, F.col("p_type")).alias("product_category"),
        F.when(about_product, F.col("p_retailprice")).alias("product_price"),
        F.when(about_product, F.col("p_brand")).alias("product_brand"),
        F.struct(device.alias("type"), no_text.alias("os"), no_text.alias("browser")).alias(
            "device_info"
        ),
        F.struct(
            no_number.alias("latitude"),
            no_number.alias("longitude"),
            F.concat(F.lit("city_"), (F.col("k") % 10).cast("string")).alias("city"),
        ).alias("location"),
    )


def valid_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate_events(clickstream(spark, sf_dir))


def enriched_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_events(valid_events(spark, sf_dir))


def broker_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as broker rows: JSON bytes keyed by user, in six partitions per topic.

    Purchases travel on the transactions topic and errors on one that no job is set up for.
    """
    events = clickstream(spark, sf_dir)
    number = F.substring_index("event_id", "_", -1).cast("long")
    topic = (
        F.when(F.col("event_type") == "purchase", TRANSACTIONS_TOPIC)
        .when(F.col("event_type") == "error", "retail_errors")
        .otherwise(CLICKSTREAM_TOPIC)
    )
    return events.select(
        F.col("user_id").cast("binary").alias("key"),
        F.to_json(F.struct(*events.columns)).cast("binary").alias("value"),
        topic.alias("topic"),
        (number % 6).cast("int").alias("partition"),
        number.alias("offset"),
        F.timestamp_seconds(number).alias("timestamp"),
    )


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as batch envelopes: each holds its event three times over, as a retry would.

    Some envelopes are cut short (malformed) and some hold no messages.
    """
    events = clickstream(spark, sf_dir)
    number = F.substring_index("event_id", "_", -1).cast("long")
    message = F.struct(*events.columns)
    filled = F.when(number % 103 != 0, F.array_repeat(message, 3)).otherwise(
        F.array_repeat(message, 0)
    )
    text = F.to_json(
        F.struct(
            F.lit(CLICKSTREAM_TOPIC).alias("topic"),
            filled.alias("messages"),
            F.lit("2024-01-30T00:00:00Z").alias("timestamp"),
            F.size(filled).alias("batch_size"),
        )
    )
    cut = F.substring(text, 1, 40)
    return events.select(F.when(number % 101 == 0, cut).otherwise(text).alias("value"))


def cart_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid purchases with their order's lines as cart items.

    Each row carries one line, so no order is ever gathered in one place; adaptive execution
    splits an order that holds a large part of all lines. Rows of one purchase share the
    event_id, hence the lines are joined after de-duplication.
    """
    lineitem = table(spark, sf_dir, "lineitem")
    purchases = enriched_events(spark, sf_dir).where(F.col("event_type") == "purchase")
    item = F.struct(
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("product_id"),
        F.lit(None).cast("string").alias("product_name"),
        F.lit(None).cast("string").alias("product_category"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("product_price"),
        F.col("l_quantity").cast("int").alias("quantity"),
    )
    lines = lineitem.select(
        F.concat(F.lit("e_"), F.col("l_orderkey").cast("string")).alias("event_id"),
        F.array(item).alias("cart_items"),
        F.col("l_linenumber").alias("line"),
    )
    number = F.substring_index("event_id", "_", -1)
    return purchases.join(lines, "event_id").withColumn(
        "order_id", F.concat(F.lit("ORD_"), number)
    )


def whole_carts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid purchases with all lines of their order as one cart, in line order.

    An order has a handful of lines, so its cart is a short array.
    """
    lines = cart_purchases(spark, sf_dir).select("event_id", "cart_items", F.col("line").alias("at"))
    item = F.struct("at", F.col("cart_items")[0].alias("item"))
    carts = lines.groupBy("event_id").agg(F.array_sort(F.collect_list(item)).alias("lines"))
    carts = carts.select("event_id", F.col("lines.item").alias("cart_items"))
    purchases = enriched_events(spark, sf_dir).where(F.col("event_type") == "purchase")
    number = F.substring_index("event_id", "_", -1)
    return purchases.join(carts, "event_id").withColumn("order_id", F.concat(F.lit("ORD_"), number))


def score_by_rule(inputs: DataFrame) -> DataFrame:
    """Session inputs with a purchase probability from a fixed formula, as input for the reports."""
    device_factor = F.lit(1.0)
    for device, factor in RULE_DEVICE_FACTORS.items():
        device_factor = F.when(F.col("device_type") == device, factor).otherwise(device_factor)
    raw = (
        F.lit(RULE_BASE)
        + F.lit(RULE_CART_WEIGHT) * F.col("add_to_cart_events")
        + F.lit(RULE_LOG_VIEWS_WEIGHT) * F.log(1 + F.col("page_views"))
        + F.lit(RULE_LOG_SECONDS_WEIGHT) * F.log(1 + F.col("session_duration_seconds"))
        + F.lit(RULE_SEARCH_WEIGHT) * F.col("search_events")
    ) * device_factor
    low, high = RULE_LIMITS
    probability = F.round(F.greatest(F.least(raw, F.lit(high)), F.lit(low)), 6)
    scored = inputs.withColumn("probability_purchase", probability)
    return scored.withColumns(
        {
            "prediction_label": (F.col("probability_purchase") >= 0.5).cast("int"),
            "label": F.col("converted_to_purchase").cast("double"),
        }
    )


def shift_metrics(metrics: DataFrame, factors: Mapping[str, float]) -> DataFrame:
    """Metric rows scaled by a factor each; metrics without a factor are left out."""
    rows = [
        F.struct(F.lit(name).alias("name"), F.lit(factor).alias("factor"))
        for name, factor in factors.items()
    ]
    return (
        metrics.withColumn("shift", F.explode(F.array(*rows)))
        .where(F.col("metric") == F.col("shift.name"))
        .select("metric", (F.col("value") * F.col("shift.factor")).alias("value"))
    )
