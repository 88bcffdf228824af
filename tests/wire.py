"""Hand-made messages."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from marketstream.operators import first_update_event, parse_envelope
from marketstream.schemas import KAFKA_ROW

TS = "2024-01-01T00:00:01.123456789Z"


def trade(**changes) -> dict:
    item = {
        "trade_id": "1",
        "product_id": "BTC-USD",
        "price": "100.5",
        "size": "0.2",
        "side": "SELL",
        "time": "2024-01-01T00:00:00.5Z",
    }
    return _changed(item, changes)


def ticker(**changes) -> dict:
    item = {
        "product_id": "BTC-USD",
        "price": "100.5",
        "best_bid": "100.0",
        "best_ask": "101.0",
        "price_percent_chg_24_h": "1.5",
        "volume_24_h": "12.123456789",
        "high_24_h": "110",
        "low_24_h": "90",
    }
    return _changed(item, changes)


def candle(**changes) -> dict:
    item = {
        "product_id": "BTC-USD",
        "open": "1",
        "high": "5",
        "low": "2",
        "close": "4",
        "start": "0",
        "volume": "9",
    }
    return _changed(item, changes)


def message(kind: str, *items: dict, type: str = "update", timestamp: str = TS) -> dict:
    return {
        "channel": kind,
        "timestamp": timestamp,
        "sequence_num": 7,
        "events": [{"type": type, kind: list(items)}],
    }


def trades_message(*items: dict, **options) -> dict:
    return message("trades", *items, **options)


def kafka_rows(spark: SparkSession, *values, key: str = "BTC-USD", offset: int = 0) -> DataFrame:
    """Rows of the log from dicts (as JSON) or raw text, with rising offsets."""
    rows = []
    for n, value in enumerate(values):
        text = value if isinstance(value, str) else json.dumps(value)
        rows.append((key.encode(), text.encode(), "market.any", 0, offset + n, None))
    return spark.createDataFrame(rows, KAFKA_ROW)


def updates(spark: SparkSession, *values, **options) -> DataFrame:
    return first_update_event(parse_envelope(kafka_rows(spark, *values, **options)))


def _changed(item: dict, changes: dict) -> dict:
    item.update(changes)
    return {name: value for name, value in item.items() if value is not ...}
