"""Small hand-made event frames."""

from __future__ import annotations

from tidestream.schemas import EVENT_SCHEMA



def event(event_id, event_type="page_view", at="2024-01-05T10:00:00Z", **fields):
    """One event as a dict; pass None to blank a field."""
    base = {
        "event_id": event_id,
        "event_type": event_type,
        "timestamp": at,
        "user_id": "u1",
        "session_id": "s1",
        "product_id": None if event_type == "search" else "P1",
        "product_category": None if event_type == "search" else "Sports",
        "product_price": None if event_type == "search" else 10.0,
        "device_info": {"type": "mobile", "os": "iOS", "browser": "Safari"},
    }
    return {**base, **fields}


def events_frame(spark, *rows):
    """Events with exactly the declared columns."""
    return spark.createDataFrame([{**r} for r in rows], EVENT_SCHEMA)


def item(product_id, price, quantity, category="Sports"):
    return {
        "product_id": product_id,
        "product_name": f"name of {product_id}",
        "product_category": category,
        "product_price": price,
        "quantity": quantity,
    }


def one(frame):
    """The single row of a frame, as a dict."""
    rows = frame.collect()
    assert len(rows) == 1, rows
    return rows[0].asDict(recursive=True)


def ids(frame):
    return sorted(r["event_id"] for r in frame.select("event_id").collect())


def assert_same(left, right):
    """Both frames hold the same rows, in any order."""
    assert sorted(left.collect(), key=repr) == sorted(right.collect(), key=repr)
