"""The message log: live and bounded reads, topic routing, product selection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import epoch_ms, moment
from ..schemas import KAFKA_ROW


@dataclass(frozen=True)
class Tls:
    """Client and trust stores of a TLS-secured broker."""

    keystore: str
    keystore_password: str
    truststore: str
    truststore_password: str
    keystore_type: str = "PKCS12"

    def options(self) -> dict[str, str]:
        return {
            "kafka.security.protocol": "SSL",
            "kafka.ssl.truststore.location": self.truststore,
            "kafka.ssl.truststore.password": self.truststore_password,
            "kafka.ssl.keystore.location": self.keystore,
            "kafka.ssl.keystore.password": self.keystore_password,
            "kafka.ssl.keystore.type": self.keystore_type,
            "kafka.ssl.key.password": self.keystore_password,
        }


@dataclass(frozen=True)
class Feed:
    """A Kafka feed.

    The cap per trigger, if one is set, is the admission control of the stream. ``min_partitions`` splits busy
    topic partitions over more tasks.
    """

    servers: str
    topics: Sequence[str]
    tls: Tls | None = None
    starting_offsets: str = "latest"
    max_offsets_per_trigger: int | None = None
    min_partitions: int | None = None
    fail_on_data_loss: bool = False
    extra: Mapping[str, str] = field(default_factory=dict)

    def connection_options(self) -> dict[str, str]:
        tls = self.tls.options() if self.tls else {}
        return {"kafka.bootstrap.servers": self.servers, **tls, **self.extra}

    def stream_options(self) -> dict[str, str]:
        options = {
            **self.connection_options(),
            "subscribe": ",".join(self.topics),
            "startingOffsets": self.starting_offsets,
            "failOnDataLoss": str(self.fail_on_data_loss).lower(),
        }
        if self.max_offsets_per_trigger is not None:
            options["maxOffsetsPerTrigger"] = str(self.max_offsets_per_trigger)
        if self.min_partitions is not None:
            options["minPartitions"] = str(self.min_partitions)
        return options

    def range_options(self, start: datetime, end: datetime) -> dict[str, str]:
        return {
            **self.connection_options(),
            "subscribe": ",".join(self.topics),
            "startingTimestamp": _millis(start),
            "endingTimestamp": _millis(end),
            "failOnDataLoss": str(self.fail_on_data_loss).lower(),
        }


def read_feed(spark: SparkSession, feed: Feed) -> DataFrame:
    """Live stream of Kafka rows."""
    return spark.readStream.format("kafka").options(**feed.stream_options()).load()


def read_feed_range(
    spark: SparkSession, feed: Feed, start: datetime, end: datetime
) -> DataFrame:
    """Bounded batch read of the log by record time."""
    return spark.read.format("kafka").options(**feed.range_options(start, end)).load()


def read_archive_stream(
    spark: SparkSession, path: str, schema=KAFKA_ROW, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Stream of a Parquet archive of Kafka rows (or of another schema)."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def replay_range(
    archive: DataFrame,
    topic: str,
    start: Column | datetime | str,
    end: Column | datetime | str,
) -> DataFrame:
    """Records of one topic of an archive with ``start <= timestamp < end``, as text."""
    ts = F.col("timestamp")
    return replay_projection(
        archive.where((F.col("topic") == topic) & (ts >= moment(start)) & (ts < moment(end)))
    )


def replay_projection(df: DataFrame) -> DataFrame:
    return df.selectExpr(
        "CAST(key AS STRING) AS key",
        "CAST(value AS STRING) AS value",
        "topic",
        "partition",
        "offset",
        "timestamp",
    )


def route_feed(raw: DataFrame, namespace: str, now: Column | datetime | None = None) -> DataFrame:
    """Raw messages (product_id, message) to Kafka sink rows: key, value, topic, timestamp.

    Channel and time come from the text without a full parse. No channel routes to ``unknown``;
    a missing or bad time falls back to ``now``. Times are cut to milliseconds.
    """
    text = F.col("message")
    channel = F.regexp_extract(text, '"channel":"([^"]*)"', 1)
    has_channel = F.contains(text, F.lit('"channel":"'))
    topic = F.when(has_channel, F.lower(F.replace(channel, F.lit("-"), F.lit("_"))))
    event_ms = epoch_ms(F.regexp_extract(text, '"timestamp":"([^"]*)"', 1))
    fallback_ms = F.unix_millis(moment(now))
    return raw.select(
        F.col("product_id").alias("key"),
        text.alias("value"),
        F.concat(F.lit(f"{namespace}."), F.coalesce(topic, F.lit("unknown"))).alias("topic"),
        F.timestamp_millis(F.coalesce(event_ms, fallback_ms)).alias("timestamp"),
    )


def write_feed(routed: DataFrame, feed: Feed, checkpoint: str):
    """Writer of routed rows to Kafka; each row goes to the topic in its ``topic`` column."""
    return (
        routed.writeStream.format("kafka")
        .options(**feed.connection_options())
        .option("checkpointLocation", checkpoint)
    )


def filter_products(df: DataFrame, products: DataFrame) -> DataFrame:
    """Rows of enabled products. Spark broadcasts the catalogue while its size allows."""
    return df.join(products.where("enabled").select("product_id"), "product_id", "left_semi")


def _millis(value: datetime) -> str:
    if value.tzinfo is None:
        value = value.replace(tzinfo=timezone.utc)
    return str(int(value.timestamp() * 1000))
