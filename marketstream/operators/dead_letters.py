"""What could not be stored, of all kinds and in one shape, with the text as it came.

``kind`` is message, trade, ticker or candle. A message is a dead letter if no events can be read from
it; an item, if it lacks what its table requires or lies in the future. Items that fail count singly,
the others of their message are stored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .items import prepare_candles, prepare_tickers, prepare_trades
from .quality import CANDLE_REQUIRED, TICKER_REQUIRED, TRADE_REQUIRED, quarantine_rows

NOT_JSON, EMPTY = "not json", "empty"
_ITEMS = (
    ("trade", prepare_trades, TRADE_REQUIRED, "trade_time_utc"),
    ("ticker", prepare_tickers, TICKER_REQUIRED, "message_ts_utc"),
    ("candle", prepare_candles, CANDLE_REQUIRED, "message_ts_utc"),
)


def dead_messages(envelopes: DataFrame) -> DataFrame:
    """Messages from which no events could be read; of ``parse_envelope(..., keep_bad=True)``."""
    bad = envelopes.where("bad_text is not null")
    reason = F.when(F.trim("bad_text") == "", EMPTY).otherwise(NOT_JSON)
    return bad.select(*_shape("message", F.col("kafka_key"), F.col("offset"), F.lit(0), F.col("bad_text"), reason))


def dead_items(update_df: DataFrame) -> DataFrame:
    """Trades, tickers and candles of update events that no table can hold."""
    kinds = []
    for kind, prepare, required, time in _ITEMS:
        bad = quarantine_rows(prepare(update_df, raw=True), required, time)
        kinds.append(
            bad.select(*_shape(kind, F.col("product_id"), F.col("kafka_offset"), F.col("item_pos"), F.col("raw_value"), F.col("missing")))
        )
    return reduce(DataFrame.unionByName, kinds)


def _shape(kind: str, product: Column, offset: Column, pos: Column, text: Column, reason: Column) -> list:
    return [
        F.lit(kind).alias("kind"),
        product.alias("product_id"),
        "topic",
        "partition",
        offset.alias("kafka_offset"),
        pos.cast("int").alias("item_pos"),
        "record_ts_utc",
        text.alias("raw_value"),
        reason.alias("reason"),
    ]
