"""Kafka rows to envelopes, envelopes to the event that counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import parse_message_ts
from ..schemas import ENVELOPE

_CORRUPT = "_corrupt"


def parse_envelope(kafka_df: DataFrame, keep_bad: bool = False) -> DataFrame:
    """Parse the JSON value: offset, kafka_key, record_ts_utc, envelope fields, message_ts_utc.

    Unknown fields are ignored, missing ones are null, text that is not JSON gives nulls.
    ``record_ts_utc`` is the time that the log gave the record. With ``keep_bad`` also topic, partition
    and ``bad_text``: the value where no events could be read from it, else null.
    """
    text = F.col("value").cast("string")
    key = F.col("key").cast("string").alias("kafka_key")
    record = F.col("timestamp").alias("record_ts_utc")
    # As a generator the parse runs once per message. As a plain projection, every filter on a
    # parsed field is pushed below it with a copy of the parse.
    if not keep_bad:
        envelopes = kafka_df.select("offset", key, record, F.inline(F.array(F.from_json(text, ENVELOPE))))
        return envelopes.withColumn("message_ts_utc", parse_message_ts(F.col("timestamp")))
    parsed = F.from_json(text, f"{ENVELOPE}, {_CORRUPT} STRING", {"columnNameOfCorruptRecord": _CORRUPT})
    envelopes = kafka_df.select(
        "topic", "partition", "offset", key, record, text.alias("text"), F.inline(F.array(F.struct(parsed.alias("parsed"))))
    )
    unread = F.col("parsed").isNull() | (F.col(f"parsed.{_CORRUPT}").isNotNull() & F.col("parsed.events").isNull())
    bad = F.when(unread, F.coalesce("text", F.lit(""))).alias("bad_text")
    kept = envelopes.select("topic", "partition", "offset", "kafka_key", "record_ts_utc", bad, "parsed.*").drop(_CORRUPT)
    return kept.withColumn("message_ts_utc", parse_message_ts(F.col("timestamp")))


def first_update_event(envelopes: DataFrame, all_events: bool = False) -> DataFrame:
    """Keep messages whose event is an update; adds the column ``event``.

    Only the first event of a message is read; ``all_events=True`` reads every one and keeps its
    place as ``event_pos``.
    """
    if all_events:
        picked = envelopes.select("*", F.posexplode("events").alias("event_pos", "event"))
        return picked.where(F.col("event.type") == "update")
    picked = envelopes.withColumn("event", F.get("events", F.lit(0)))
    return picked.where(F.col("event.type") == "update")
