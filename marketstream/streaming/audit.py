"""What the state of a stream holds, read from its checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def remembered_ids(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """``trade_id, expires_utc``: the ids by which ``stream_dedup`` tells copies, after its last batch.

    ``batch_id`` asks for the state after another batch that the checkpoint still keeps. Of a query that
    also keeps totals the first stateful operator is read, the one that drops copies.
    """
    reader = spark.read.format("statestore").option("operatorId", 0)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    state = reader.load(checkpoint)
    return state.select(
        F.col("key.trade_id").alias("trade_id"), F.timestamp_micros(F.col("value.expiresAtMicros")).alias("expires_utc")
    )
