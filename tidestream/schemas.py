"""Declared schemas, as DDL text so they serve from_json, readers and tables alike.

Every field is nullable: a missing JSON key reads as null and an unknown one is dropped.
"""

CART_ITEM = (
    "STRUCT<product_id: STRING, product_name: STRING, product_category: STRING, "
    "product_price: DOUBLE, quantity: INT>"
)

# The fields of an event and their types.
_EVENT_FIELDS = {
    "event_id": "STRING",
    "event_type": "STRING",
    "timestamp": "STRING",
    "user_id": "STRING",
    "session_id": "STRING",
    "page_url": "STRING",
    "page_title": "STRING",
    "referrer": "STRING",
    "product_id": "STRING",
    "product_name": "STRING",
    "product_category": "STRING",
    "product_price": "DOUBLE",
    "product_brand": "STRING",
    "device_info": "STRUCT<type: STRING, os: STRING, browser: STRING>",
    "location": "STRUCT<latitude: DOUBLE, longitude: DOUBLE, city: STRING>",
    "user_agent": "STRING",
    "ip_address": "STRING",
    "kafka_metadata": (
        "STRUCT<topic: STRING, partition: INT, offset: BIGINT, key: STRING, timestamp: BIGINT>"
    ),
    # Cart, order and search fields that only some event types carry.
    "quantity": "INT",
    "total_value": "DOUBLE",
    "order_id": "STRING",
    "cart_items": f"ARRAY<{CART_ITEM}>",
    "shipping_method": "STRING",
    "payment_method": "STRING",
    "search_query": "STRING",
    "search_results_count": "INT",
}

EVENT_TYPES_BY_COLUMN = dict(_EVENT_FIELDS)
EVENT_COLUMNS = tuple(_EVENT_FIELDS)
EVENT_SCHEMA = ", ".join(f"`{name}` {kind}" for name, kind in _EVENT_FIELDS.items())

CORRUPT_COLUMN = "_corrupt_record"
EVENT_SCHEMA_WITH_CORRUPT = f"{EVENT_SCHEMA}, `{CORRUPT_COLUMN}` STRING"

# The columns of the prediction table.
PREDICTION_COLUMNS = {
    "session_id": "STRING",
    "user_id": "STRING",
    "event_date": "DATE",
    "event_hour": "INT",
    "prediction_label": "INT",
    "probability_purchase": "DOUBLE",
    "actual_converted": "INT",
    "page_views": "INT",
    "add_to_cart_events": "INT",
    "unique_products_viewed": "INT",
    "session_duration_seconds": "DOUBLE",
    "device_type": "STRING",
    "probability_bucket": "STRING",
    "prediction_timestamp": "TIMESTAMP",
    "model_name": "STRING",
    "model_version": "STRING",
}

RUN_SCHEMA = "run_id STRING, model_type STRING, kind STRING, name STRING, value STRING"
REGISTRY_SCHEMA = (
    "seq BIGINT, name STRING, version INT, run_id STRING, stage STRING, "
    "description STRING, path STRING, changed_at TIMESTAMP"
)
