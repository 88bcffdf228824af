"""Explode the item arrays of an update event into typed rows.

A row comes out per item. Items without their own product take the record key. Tickers and candles
of one message share its offset, so ``last_in_message`` marks the item that wins inside it.
Where the events have them, the columns of ``ORIGIN`` come along. With ``raw`` a row also has its offset,
its place in the message (``item_pos``) and its text as it came (``raw_value``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import parse_trade_ts, to_double
from .quality import RECORD_TIME

#: Where a message comes from; kept for what is set aside.
ORIGIN = (RECORD_TIME, "topic", "partition")


def prepare_trades(update_df: DataFrame, raw: bool = False) -> DataFrame:
    """One row per trade: ids, side, size, trade_value, trade_time_utc."""
    item = F.col("item")
    extra = _raw(raw)
    return (
        update_df.select(
            "kafka_key",
            *_origin(update_df),
            *([F.col("offset").alias("kafka_offset")] if raw else []),
            F.posexplode("event.trades").alias("pos", "item"),
        )
        .select(
            *_origin(update_df),
            *extra,
            *(["kafka_offset"] if raw else []),
            item["trade_id"].alias("trade_id"),
            F.coalesce(item["product_id"], "kafka_key").alias("product_id"),
            item["side"].alias("side"),
            to_double(item["price"]).alias("price"),
            to_double(item["size"]).alias("size"),
            parse_trade_ts(item["time"]).alias("trade_time_utc"),
        )
        .withColumn("trade_value", F.col("price") * F.col("size"))
        .drop("price")
    )


def _raw(raw: bool) -> list[Column]:
    return [F.col("pos").alias("item_pos"), F.to_json("item").alias("raw_value")] if raw else []


def prepare_tickers(update_df: DataFrame, raw: bool = False) -> DataFrame:
    """One row per ticker with its figures, mid_price and spread."""
    item = F.col("item")
    bid, ask = F.col("best_bid"), F.col("best_ask")
    return (
        _explode_items(update_df, "tickers")
        .select(
            *_origin(update_df),
            *_raw(raw),
            "kafka_offset",
            "message_ts_utc",
            "last_in_message",
            "product_id",
            to_double(item["price"]).alias("price"),
            to_double(item["best_bid"]).alias("best_bid"),
            to_double(item["best_ask"]).alias("best_ask"),
            to_double(item["price_percent_chg_24_h"]).alias("price_pct_chg_24h"),
            to_double(item["volume_24_h"]).alias("volume_24h"),
            to_double(item["high_24_h"]).alias("high_24h"),
            to_double(item["low_24_h"]).alias("low_24h"),
        )
        .withColumns({"mid_price": (bid + ask) / 2, "spread": ask - bid})
    )


def prepare_candles(update_df: DataFrame, raw: bool = False) -> DataFrame:
    """One row per candle with its figures, range and avg_price."""
    item = F.col("item")
    o, h, lo, c = (F.col(name) for name in ("open", "high", "low", "close"))
    return (
        _explode_items(update_df, "candles")
        .select(
            *_origin(update_df),
            *_raw(raw),
            "kafka_offset",
            "message_ts_utc",
            "last_in_message",
            "product_id",
            *[
                to_double(item[name]).alias(name)
                for name in ("open", "high", "low", "close", "volume")
            ],
        )
        .withColumns({"range": h - lo, "avg_price": (o + h + lo + c) / 4})
    )


def _origin(df: DataFrame) -> list[str]:
    return [c for c in ORIGIN if c in df.columns]


def _explode_items(update_df: DataFrame, array_name: str) -> DataFrame:
    items = F.col(f"event.{array_name}")
    product = F.coalesce(F.col("item")["product_id"], F.col("kafka_key"))
    return update_df.select(
        "offset",
        "kafka_key",
        "message_ts_utc",
        *_origin(update_df),
        items.alias("items"),
        F.posexplode(items).alias("pos", "item"),
    ).select(
        F.col("offset").alias("kafka_offset"),
        "message_ts_utc",
        *_origin(update_df),
        product.alias("product_id"),
        _is_last(product).alias("last_in_message"),
        "pos",
        "item",
    )


def _is_last(product: Column) -> Column:
    """True where no later item of the same message has the same product."""
    size = F.size("items")
    products = F.transform("items", lambda x: F.coalesce(x["product_id"], F.col("kafka_key")))
    steps_from_end = F.array_position(F.reverse(products), product)
    return F.when(size == 1, F.lit(True)).otherwise(steps_from_end == size - F.col("pos"))
