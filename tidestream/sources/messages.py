"""Events from a message broker or JSON files, decoded against the declared schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidestream.constants import BATCH_INTERVAL, BATCH_MESSAGES, DEFAULT_JOB, TOPIC_JOBS
from tidestream.schemas import (
    CORRUPT_COLUMN,
    EVENT_COLUMNS,
    EVENT_SCHEMA_WITH_CORRUPT,
    EVENT_TYPES_BY_COLUMN,
)

_PERMISSIVE = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}


def _parsed(text: Column, schema: str) -> Column:
    """Columns of JSON text, parsed once per row.

    As a one-row generator: a filter on a plain from_json projection would be moved below it
    and parse the text a second time.
    """
    return F.inline(F.array(F.from_json(text, schema, _PERMISSIVE)))


def kafka_options(
    servers: str,
    topics: Sequence[str],
    max_rows: int | None = None,
    starting: str = "latest",
    group: str = "tidestream",
    min_rows: int | None = BATCH_MESSAGES,
    max_delay: str = BATCH_INTERVAL,
) -> dict[str, str]:
    """Reader options: subscribe to the topics, newest messages first seen.

    A batch is cut as soon as `min_rows` messages have come or `max_delay` has passed since the last one,
    whichever is first, and then takes whatever has arrived; without `min_rows` every trigger cuts one.
    `max_rows` bounds a batch, for a first run over a backlog. The trigger of the query sets how often
    this is looked at.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting,
        "groupIdPrefix": group,
    }
    if min_rows is not None:
        options |= {"minOffsetsPerTrigger": str(min_rows), "maxTriggerDelay": max_delay}
    return options if max_rows is None else {**options, "maxOffsetsPerTrigger": str(max_rows)}


def read_kafka(spark: SparkSession, servers: str, topics: Sequence[str], **options) -> DataFrame:
    """Streaming messages of the topics; needs the Kafka connector on the class path."""
    return (
        spark.readStream.format("kafka").options(**kafka_options(servers, topics, **options)).load()
    )


def decode_messages(messages: DataFrame) -> DataFrame:
    """Broker rows (key, value, topic, partition, offset, timestamp) as events.

    Malformed values keep their text in the corrupt column and null in every event field.
    """
    origin = F.struct(
        F.col("topic").alias("topic"),
        F.col("partition").cast("int").alias("partition"),
        F.col("offset").cast("long").alias("offset"),
        F.col("key").cast("string").alias("key"),
        F.unix_millis("timestamp").alias("timestamp"),
    )
    decoded = messages.select(
        origin.alias("origin"), _parsed(F.col("value").cast("string"), EVENT_SCHEMA_WITH_CORRUPT)
    )
    return decoded.select(
        *[F.col("origin" if c == "kafka_metadata" else c).alias(c) for c in EVENT_COLUMNS],
        CORRUPT_COLUMN,
    )


def conform_events(events: DataFrame) -> DataFrame:
    """Exactly the declared event columns: missing ones null, others dropped."""
    present = set(events.columns)
    return events.select(
        *[
            (F.col(c) if c in present else F.lit(None)).cast(kind).alias(c)
            for c, kind in EVENT_TYPES_BY_COLUMN.items()
        ]
    )


def read_event_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Streaming events from a folder of JSON-lines files, all new ones per trigger by default."""
    reader = spark.readStream.schema(EVENT_SCHEMA_WITH_CORRUPT).options(**_PERMISSIVE)
    return (reader if max_files is None else reader.option("maxFilesPerTrigger", max_files)).json(path)


def route_topics(
    messages: DataFrame, jobs: Mapping[str, str] = TOPIC_JOBS, default: str = DEFAULT_JOB
) -> DataFrame:
    """Adds the job that handles each message's topic; unknown topics go to the default."""
    pairs = [F.lit(text) for pair in jobs.items() for text in pair]
    found = F.try_element_at(F.create_map(*pairs), F.col("topic"))
    return messages.withColumn("job", F.coalesce(found, F.lit(default)))


def _envelope_messages(envelopes: DataFrame, column: str) -> DataFrame:
    """One row per message of the envelopes, as text; malformed envelopes give their own text."""
    text = F.col(column)
    parsed = envelopes.select(
        text.alias("envelope"),
        # Checks the outer JSON only; the messages stay text and are parsed one by one.
        F.from_json(text, "messages ARRAY<STRING>", {"mode": "PERMISSIVE"}).alias("outer"),
        F.get_json_object(text, "$").isNull().alias("broken"),
    )
    filled = F.col("envelope").isNotNull() & (F.length(F.trim("envelope")) > 0)
    whole = F.when(F.col("broken") & filled, F.array("envelope"))
    return parsed.select(F.explode(F.coalesce(whole, F.col("outer.messages"))).alias("message"), "broken")


def decode_envelopes(envelopes: DataFrame, column: str = "value") -> DataFrame:
    """Events of batch envelopes held as JSON text, decoded like broker messages.

    One row per message. A message that is not valid keeps its text in the corrupt column and
    null in every event field, and so does an envelope that is not valid JSON; the other
    messages of an envelope are not affected. Empty envelopes give no rows.
    """
    rows = _envelope_messages(envelopes, column)
    decoded = rows.select("message", "broken", _parsed(F.col("message"), EVENT_SCHEMA_WITH_CORRUPT))
    corrupt = F.when(F.col("broken"), F.col("message")).otherwise(F.col(CORRUPT_COLUMN))
    bad = corrupt.isNotNull()
    return decoded.select(*[F.when(~bad, F.col(c)).alias(c) for c in EVENT_COLUMNS], corrupt.alias(CORRUPT_COLUMN))


def parse_envelopes(envelopes: DataFrame, column: str = "value") -> DataFrame:
    """The well-formed events of batch envelopes, one row per message."""
    return well_formed(decode_envelopes(envelopes, column))


def corrupt_envelopes(envelopes: DataFrame, column: str = "value") -> DataFrame:
    """The text of messages and envelopes that give no event, for quarantine."""
    decoded = decode_envelopes(envelopes, column)
    return decoded.select(CORRUPT_COLUMN).where(F.col(CORRUPT_COLUMN).isNotNull())


def well_formed(events: DataFrame) -> DataFrame:
    """Decoded events without the corrupt rows, and without the corrupt column."""
    return events.where(F.col(CORRUPT_COLUMN).isNull()).drop(CORRUPT_COLUMN)
