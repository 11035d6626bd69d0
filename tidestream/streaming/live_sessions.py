"""Session metrics of a stream, each session emitted once its day is over.

Every session keeps its cells as keyed state: counts and times of the session, and one entry per
distinct product, category and device. So the state of a session grows with what is different in it
and not with its events, however many those are. A timer at the end of the session's day, in event
time, emits the session behind the watermark and drops its state.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidestream.operators.sessions import SESSION_KEYS, sessions_from_cells

_DAY_MILLIS = 86_400_000
_TALLY = "n BIGINT, carts BIGINT, purchases BIGINT, searches BIGINT, first_at BIGINT, last_at BIGINT"
_CELLS = f"session_id STRING, user_id STRING, event_date DATE, kind STRING, value STRING, {_TALLY}"


class SessionCells(StatefulProcessor):
    """Adds events to the cells of their session and emits the cells when the session's day has passed."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._cells = handle.getMapState("cells", "kind STRING, value STRING", _TALLY)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for batch in rows:
            # A batch is folded before the state is touched, so a hot session costs few state calls.
            batch = batch.assign(event="", product=batch["product_id"], category=batch["product_category"])
            for kind in ("event", "product", "category", "device"):
                folded = batch.groupby(kind).agg(  # rows without a value fall out
                    n=("at", "size"), carts=("is_cart", "sum"), purchases=("is_purchase", "sum"),
                    searches=("is_search", "sum"), first_at=("at", "min"), last_at=("at", "max"),
                )
                for name, *tally in folded.itertuples(name=None):
                    self._add((kind, name), [int(x) for x in tally])
        if not list(self._handle.listTimers()):
            self._handle.registerTimer(self._end_of_day(key))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        made = [
            (*key, kind, None if kind == "event" else value, *tally)
            for (kind, value), tally in ((tuple(k), tuple(v)) for k, v in self._cells.iterator())
        ]
        self._cells.clear()
        columns = [part.split()[0] for part in _CELLS.split(", ")]
        yield pd.DataFrame(made, columns=columns)

    def close(self) -> None:
        pass

    def _add(self, cell: tuple[str, str], new: list[int]) -> None:
        if self._cells.containsKey(cell):
            old = tuple(self._cells.getValue(cell))
            new = [a + b for a, b in zip(old[:4], new[:4])] + [min(old[4], new[4]), max(old[5], new[5])]
        self._cells.updateValue(cell, tuple(new))

    @staticmethod
    def _end_of_day(key) -> int:
        return int((pd.Timestamp(key[2]).value // 1_000_000) + _DAY_MILLIS)


def session_cell_stream(timed: DataFrame) -> DataFrame:
    """The cells of every session whose day lies behind the watermark of `timed`.

    `timed` are valid, distinct, timed events with a watermark, as `valid_stream` gives them. A session
    comes whole, all of its cells in one micro-batch; events that are late for the watermark are dropped.
    """

    def one_if(kind: str):
        return (F.col("event_type") == kind).cast("long")

    rows = timed.select(
        "session_id",
        "user_id",
        F.to_date("event_timestamp").alias("event_date"),
        "event_timestamp",
        F.unix_micros("event_timestamp").alias("at"),
        one_if("add_to_cart").alias("is_cart"),
        one_if("purchase").alias("is_purchase"),
        one_if("search").alias("is_search"),
        "product_id",
        "product_category",
        F.col("device_info.type").alias("device"),
    )
    return rows.groupBy(*SESSION_KEYS).transformWithStateInPandas(
        statefulProcessor=SessionCells(), outputStructType=_CELLS, outputMode="Append", timeMode="EventTime"
    )


def finished_sessions(cells: DataFrame) -> DataFrame:
    """The rows of `session_metrics` from cells that a stream has emitted (a batch of them, or their table)."""
    at = {c: F.timestamp_micros(c) for c in ("first_at", "last_at")}
    return sessions_from_cells(cells.withColumns(at))

