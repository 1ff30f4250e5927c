"""Sensor messages: encoding, sources, the raw envelope and parsing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coldhaul import schemas
from coldhaul.functions.columns import number, tolerant_timestamp

#: How long after a message its repeats are looked for.
REPEAT_DELAY = "10 minutes"


def json_payload(df: DataFrame, allowed: list[str]) -> DataFrame:
    """Add ``key`` (the vehicle) and ``value`` (JSON strings of the allowed columns present)."""
    present = [c for c in allowed if c in df.columns]
    body = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in present]))
    return df.withColumns({"key": F.col("vehicle_id").cast("string"), "value": body})


def message_stream(spark: SparkSession, fmt: str, topic: str | None = None,
                   path: str | None = None, starting: str = "latest", **options: str) -> DataFrame:
    """Streaming messages as ``key, value, topic, timestamp``.

    ``fmt="kafka"`` subscribes to ``topic`` (broker settings go in ``options``); any file
    format reads message files under ``path``.
    """
    reader = spark.readStream.format(fmt).options(**options)
    if fmt == "kafka":
        raw = reader.option("subscribe", topic).option("startingOffsets", starting).load()
    else:
        raw = reader.schema(schemas.MESSAGE).load(path)
        if topic is not None:
            raw = raw.where(F.col("topic") == topic)
    return raw.select(F.col("key").cast("string"), F.col("value").cast("string"),
                      "topic", "timestamp")


def once(messages: DataFrame, delay: str = REPEAT_DELAY) -> DataFrame:
    """A stream without the messages that were sent again within ``delay``: same topic, vehicle, sensor and event time.

    The watermark follows the time the messages were sent, so a reading that a device holds back is not late. A message sent
    more than ``delay`` before the newest one seen by an earlier batch can't be told from a repeat and is left out;
    :func:`coldhaul.streaming.jobs.late_rows` counts those.
    """
    sent = messages.withColumns({
        "_sent": F.col("timestamp").cast("timestamp"), "_sensor": F.get_json_object("value", "$.sensor_id"),
        "_at": F.get_json_object("value", "$.timestamp")})
    return (sent.withWatermark("_sent", delay).dropDuplicatesWithinWatermark(["topic", "key", "_sensor", "_at"])
            .select(*messages.columns))


def envelope(messages: DataFrame) -> DataFrame:
    """The raw landing row: nothing parsed, partitioned by the message date."""
    return messages.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("value").cast("string").alias("raw_json"),
        "topic",
        F.col("timestamp").alias("kafka_ts"),
        F.current_timestamp().alias("ingestion_ts"),
        F.to_date("timestamp").alias("ingest_date"))


def parse_json(df: DataFrame, column: str, schema: T.StructType) -> DataFrame:
    """The JSON strings of ``column`` as flat string columns.

    A filter on a parsed field would be pushed below a plain projection and parse the text
    again for each field it names; it cannot pass the one-element explode.
    """
    return df.select(F.explode(F.array(F.from_json(column, schema))).alias("j")).select("j.*")


def _numbers(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Cast required numbers, and skip rows where one of them is missing or malformed.

    NaN is a number that says nothing: the row stays, and the reading is null.
    """
    there = reduce(lambda a, b: a & b, [F.col(c).try_cast(kind).isNotNull() for c, kind in kinds.items()])
    return df.where(there).withColumns({c: number(c, kind) for c, kind in kinds.items()})


def typed_quick(pings: DataFrame) -> DataFrame:
    """A bad timestamp keeps the row, without an event time."""
    df = _numbers(pings, {"vehicle_id": "bigint", "lat": "double", "lon": "double",
                          "throttle_pct": "double", "accel_ay_abs": "double",
                          "battery_v": "double"})
    return df.withColumn("event_time", tolerant_timestamp("timestamp"))


def typed_slow(pings: DataFrame) -> DataFrame:
    df = _numbers(pings, {"vehicle_id": "bigint", "fuel_amount_l": "double",
                          "is_door_open": "int", "cargo_temp_c": "double"})
    return df.withColumn("event_time", tolerant_timestamp("timestamp"))


def quick_from_messages(messages: DataFrame) -> DataFrame:
    return typed_quick(parse_json(messages, "value", schemas.QUICK_JSON))


def slow_from_messages(messages: DataFrame) -> DataFrame:
    return typed_slow(parse_json(messages, "value", schemas.SLOW_JSON))
