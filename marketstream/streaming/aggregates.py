"""Stateful stream operators. State is bounded by the watermark delay."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import normalize_numeric
from ..operators.latest import newest_values
from ..operators.quality import TICKER_REQUIRED, TRADE_REQUIRED, valid_rows
from ..operators.trades import trade_measures
from ..schemas import CANDLE_SCALES, TICKER_SCALES

# Fixed value: a copy of a trade is recognised for ten minutes.
DEDUP_HORIZON = "10 minutes"


def stream_dedup(trades: DataFrame, horizon: str = DEDUP_HORIZON) -> DataFrame:
    """Each trade_id once within the horizon; later rows than that count as late and are dropped.

    Incomplete rows, and times in the future, are left out before they can reach the watermark;
    ``quarantine_rows`` gives them.
    """
    return (
        valid_rows(trades, TRADE_REQUIRED, "trade_time_utc")
        .withWatermark("trade_time_utc", horizon)
        .dropDuplicatesWithinWatermark(["trade_id"])
    )


def stream_with_late(trades: DataFrame, horizon: str = DEDUP_HORIZON) -> DataFrame:
    """``stream_dedup`` with all rows beside it, marked by ``late_candidate``; for ``repairing_writer``.

    Spark drops what lies behind the watermark without a trace; the rows beside it let the sink find
    these, and the incomplete ones. The messages are read twice per batch.
    """
    on_time = stream_dedup(trades, horizon).withColumn("late_candidate", F.lit(False))
    return on_time.unionByName(trades.withColumn("late_candidate", F.lit(True)))


def stream_minute_agg(trades: DataFrame, horizon: str = DEDUP_HORIZON) -> DataFrame:
    """Deduplicated trades to running minute totals; use output mode ``update``.

    Every emitted row holds the absolute totals of its minute, so the sink replaces.
    """
    minute = F.window("trade_time_utc", "1 minute").alias("minute")
    return (
        stream_dedup(trades, horizon)
        .groupBy("product_id", minute)
        .agg(*trade_measures())
        .withColumn("trade_time_utc", F.col("minute.start"))
        .drop("minute")
    )


def stream_latest_tickers(tickers: DataFrame, delay: str = DEDUP_HORIZON) -> DataFrame:
    """Newest ticker per product and minute so far; use output mode ``update``."""
    return _stream_latest(tickers, "ticker_ts_utc", TICKER_SCALES, delay)


def stream_latest_candles(candles: DataFrame, delay: str = DEDUP_HORIZON) -> DataFrame:
    """Newest candle per product and minute so far; use output mode ``update``."""
    return _stream_latest(candles, "candle_ts_utc", CANDLE_SCALES, delay)


def _stream_latest(df: DataFrame, out_ts: str, scales: dict[str, int], delay: str) -> DataFrame:
    minute = F.window("message_ts_utc", "1 minute").alias("minute")
    rows = valid_rows(df, TICKER_REQUIRED, "message_ts_utc").where("last_in_message")
    newest = (
        rows.withWatermark("message_ts_utc", delay)
        .groupBy("product_id", minute)
        .agg(*newest_values(list(scales), "kafka_offset"))
        .withColumn(out_ts, F.col("minute.start"))
        .drop("minute")
    )
    return normalize_numeric(newest, scales)
