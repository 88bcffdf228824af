"""Trades: each id once, then per-minute measures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import minute_bucket, side_volume


def dedup_trades(trades: DataFrame) -> DataFrame:
    """One row per trade_id; rows without an id are dropped.

    Copies are reduced before the shuffle, so an id that is sent very often stays cheap.
    """
    return trades.where(F.col("trade_id").isNotNull()).dropDuplicates(["trade_id"])


def trade_measures() -> list:
    """The five measures. Feed sides are the maker's, so SELL rows are taker buys."""
    side, size = F.col("side"), F.col("size")
    return [
        F.count(F.lit(1)).alias("trade_count"),
        F.sum(size).alias("total_volume"),
        F.sum(side_volume(side, "SELL", size)).alias("buy_volume"),
        F.sum(side_volume(side, "BUY", size)).alias("sell_volume"),
        F.sum("trade_value").alias("notional_value"),
    ]


def minute_trade_agg(trades: DataFrame) -> DataFrame:
    """Measures per product and minute; only partial sums are shuffled."""
    return trades.groupBy(
        "product_id", minute_bucket(F.col("trade_time_utc")).alias("trade_time_utc")
    ).agg(*trade_measures())
