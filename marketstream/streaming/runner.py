"""Start streaming queries: session settings, triggers, checkpoints, late-row counts."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROCESSING_TIME = "43 seconds"


def use_utc(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def configure_streaming(spark: SparkSession, batches_to_retain: int = 100) -> SparkSession:
    """UTC, state on RocksDB with changelog checkpoints, bounded checkpoint history."""
    use_utc(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set(
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true"
    )
    spark.conf.set("spark.sql.streaming.minBatchesToRetain", str(batches_to_retain))
    return spark


def start(
    df: DataFrame,
    write_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
    output_mode: str = "append",
    processing_time: str | None = PROCESSING_TIME,
    name: str | None = None,
) -> StreamingQuery:
    """Run ``write_batch`` on every micro-batch; ``processing_time=None`` drains what is there.

    An offset is committed only after ``write_batch`` returned, so it must return only when its
    rows are stored, and raise otherwise.
    """
    writer = (
        df.writeStream.outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write_batch)
    )
    if name:
        writer = writer.queryName(name)
    if processing_time is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=processing_time).start()


def drain(
    df: DataFrame,
    write_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
    output_mode: str = "append",
) -> StreamingQuery:
    """Process everything available now and wait for the end."""
    query = start(df, write_batch, checkpoint, output_mode, processing_time=None)
    query.awaitTermination()
    return query


class LateRows(StreamingQueryListener):
    """Adds up the rows that stateful operators drop as too late, over every report of a session.

    A query keeps only its last reports, a listener sees all of them::

        late = LateRows.watch(spark)
        query = start(...)
        late.of(query)
    """

    def __init__(self) -> None:
        self._rows: dict[str, int] = {}
        self._ended: dict[str, threading.Event] = {}

    @classmethod
    def watch(cls, spark: SparkSession) -> LateRows:
        listener = cls()
        spark.streams.addListener(listener)
        return listener

    def of(self, query: StreamingQuery, seconds: float = 60) -> int:
        """So far; of an ended query, after its last report has come in."""
        run = str(query.runId)
        if not query.isActive and not self._end(run).wait(seconds):
            raise TimeoutError("no report of the query's end")
        return self._rows.get(run, 0)

    def _end(self, run: str) -> threading.Event:
        return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        run = str(event.progress.runId)
        dropped = sum(o.numRowsDroppedByWatermark for o in event.progress.stateOperators)
        self._rows[run] = self._rows.get(run, 0) + dropped

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self._end(str(event.runId)).set()
