"""Wire schema, table columns and default names, all fixed values of the data contract."""

from __future__ import annotations

from dataclasses import dataclass

KAFKA_ROW = (
    "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP"
)

# Wire message. Every leaf travels as text except sequence_num.
TRADE_ITEM = (
    "STRUCT<price: STRING, product_id: STRING, side: STRING, size: STRING, "
    "time: STRING, trade_id: STRING>"
)
TICKER_ITEM = (
    "STRUCT<best_ask: STRING, best_ask_quantity: STRING, best_bid: STRING, "
    "best_bid_quantity: STRING, high_24_h: STRING, high_52_w: STRING, low_24_h: STRING, "
    "low_52_w: STRING, price: STRING, price_percent_chg_24_h: STRING, product_id: STRING, "
    "type: STRING, volume_24_h: STRING>"
)
CANDLE_ITEM = (
    "STRUCT<close: STRING, high: STRING, low: STRING, open: STRING, product_id: STRING, "
    "start: STRING, volume: STRING>"
)
EVENT = (
    f"STRUCT<trades: ARRAY<{TRADE_ITEM}>, tickers: ARRAY<{TICKER_ITEM}>, "
    f"candles: ARRAY<{CANDLE_ITEM}>, type: STRING>"
)
ENVELOPE = f"channel STRING, events ARRAY<{EVENT}>, sequence_num BIGINT, timestamp STRING"

# Tables, without the event_hour partition column that every hourly table adds.
RAW_TRADES = (
    "trade_id STRING, product_id STRING, side STRING, size DOUBLE, trade_value DOUBLE, "
    "trade_time_utc TIMESTAMP, inserted_at_utc TIMESTAMP"
)
TRADE_MINUTES = (
    "product_id STRING, trade_time_utc TIMESTAMP, trade_count BIGINT, total_volume DOUBLE, "
    "buy_volume DOUBLE, sell_volume DOUBLE, notional_value DOUBLE"
)
# Sums of all minutes of a product before an hour.
TRADE_CARRIES = "product_id STRING, trade_time_utc TIMESTAMP, volume_before DOUBLE, notional_before DOUBLE"
# kafka_offset is carried so that replayed old data cannot overwrite newer rows.
TICKER_MINUTES = (
    "product_id STRING, ticker_ts_utc TIMESTAMP, price DOUBLE, best_bid DOUBLE, best_ask DOUBLE, "
    "mid_price DOUBLE, spread DOUBLE, price_pct_chg_24h DOUBLE, volume_24h DOUBLE, "
    "high_24h DOUBLE, low_24h DOUBLE, kafka_offset BIGINT"
)
CANDLE_MINUTES = (
    "product_id STRING, candle_ts_utc TIMESTAMP, open DOUBLE, high DOUBLE, low DOUBLE, "
    "close DOUBLE, range DOUBLE, avg_price DOUBLE, kafka_offset BIGINT"
)
PRODUCTS = "name STRING, product_id STRING, enabled BOOLEAN"
LEDGER = (
    "batch_id BIGINT, at_utc TIMESTAMP, state STRING, purpose STRING, version STRING, hours STRING, "
    "source STRING, batch_group BIGINT"
)
QUARANTINE = (
    "trade_id STRING, product_id STRING, side STRING, size DOUBLE, trade_value DOUBLE, "
    "trade_time_utc TIMESTAMP, missing STRING, source STRING, batch_id BIGINT, "
    "quarantined_at_utc TIMESTAMP"
)

# All kinds, with the text as it came; the hour is that of the record, so a retry finds its rows again.
DEAD_LETTERS = (
    "kind STRING, product_id STRING, topic STRING, partition INT, kafka_offset BIGINT, item_pos INT, "
    "record_ts_utc TIMESTAMP, raw_value STRING, reason STRING, source STRING, batch_id BIGINT, "
    "quarantined_at_utc TIMESTAMP"
)
DEAD_LETTER_KEYS = ("source", "batch_id", "kind", "topic", "partition", "kafka_offset", "item_pos")

# Decimal places kept in the snapshot tables.
TICKER_SCALES = {
    "price": 4,
    "best_bid": 4,
    "best_ask": 4,
    "mid_price": 4,
    "spread": 4,
    "price_pct_chg_24h": 4,
    "volume_24h": 8,
    "high_24h": 4,
    "low_24h": 4,
}
CANDLE_SCALES = {"open": 4, "high": 4, "low": 4, "close": 4, "range": 4, "avg_price": 4}

TRADE_MEASURES = ["trade_count", "total_volume", "buy_volume", "sell_volume", "notional_value"]
CHANNELS = ("ticker", "candles", "market_trades")


@dataclass(frozen=True)
class TableNames:
    """Names of the tables inside one catalog database."""

    database: str = "market"
    raw_trades: str = "raw_market_trades"
    trade_minutes: str = "market_trades_agg"
    ticker_minutes: str = "ticker_snapshot"
    candle_minutes: str = "candles_snapshot"
    quarantine: str = "trade_quarantine"
    dead_letters: str = "dead_letters"
    ticker_newest: str = "ticker_newest"
    candle_newest: str = "candle_newest"
    carries: str = "market_trades_carried"

    def full(self, table: str) -> str:
        return f"{self.database}.{table}"
