"""Wire messages to readings and back.

A message is one sample instant of one patient with all its channels in a map; a reading is one
channel's voltage at that instant.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MESSAGE_SCHEMA = (
    "patient_id string, timestamp_ms bigint, sample_index int, channels map<string,double>"
)


def parse_messages(messages: DataFrame, value: str = "value") -> DataFrame:
    """JSON payloads to readings. A payload that is no JSON, or has no channels, gives no row.

    Narrow: no shuffle, usable on streams and tables alike.
    """
    body = F.from_json(F.col(value).cast("string"), MESSAGE_SCHEMA)
    parsed = messages.select(body.alias("m")).select(
        "m.patient_id", "m.timestamp_ms", "m.sample_index", F.explode("m.channels")
    )
    return parsed.withColumnsRenamed({"key": "channel", "value": "voltage"}).withColumn(
        "event_time", F.timestamp_millis("timestamp_ms")
    )


def pack_messages(readings: DataFrame) -> DataFrame:
    """Readings to one JSON message per (patient, time, sample), as bytes in ``value``.

    A reading that comes again (as at-least-once sources send) counts once; of different voltages of one
    channel at one instant the largest counts, a null only if there is no other. Equal readings are dropped
    before the shuffle, so a group is as small as the set of channels.
    """
    entries = F.array_sort(F.collect_set(F.struct("channel", "voltage")))
    grouped = readings.where(F.col("channel").isNotNull()).groupBy(
        "patient_id", "timestamp_ms", "sample_index"
    ).agg(entries.alias("__entries"))

    def last_of_channel(entry: Column, place: Column) -> Column:
        after = F.get("__entries", place + 1)["channel"]
        return after.isNull() | (after != entry["channel"])

    grouped = grouped.withColumn(
        "channels", F.map_from_entries(F.filter("__entries", last_of_channel))
    )
    body = F.struct("patient_id", "timestamp_ms", "sample_index", "channels")
    return grouped.select(F.to_json(body, {"ignoreNullFields": "false"}).cast("binary").alias("value"))
