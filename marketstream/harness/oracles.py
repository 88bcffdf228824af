"""DuckDB twins of the queries, written from the ``events`` table without the wire format."""

from __future__ import annotations

import zlib

from .feed import PRODUCTS

_FEED = """
feed AS (
  SELECT event_id AS "offset", CAST(event_id AS VARCHAR) AS trade_id,
         ['BTC-USD', 'ETH-USD', 'LINK-USD', 'SOL-USD'][user_id % 4 + 1] AS product_id,
         CASE WHEN event_type IN ('purchase', 'signup') THEN 'BUY' ELSE 'SELL' END AS side,
         value AS size,
         CAST(100 + CAST(json_extract_string(props, '$.k') AS INTEGER) AS DOUBLE) AS price,
         make_timestamp(1704067200000000 + (epoch_us(ts) - 1704067200000000) // 60) AS ts,
         event_type
  FROM events
)"""

_NOW = """
now_ AS (SELECT max(ts) AS as_of FROM feed)"""

_TRADES = """
trades AS (
  SELECT trade_id, product_id, side, size, price * size AS trade_value, ts AS trade_time_utc,
         "offset", event_type
  FROM feed
)"""

_MINUTES = """
minutes AS (
  SELECT product_id, date_trunc('minute', ts) AS trade_time_utc,
         CAST(count(*) AS BIGINT) AS trade_count,
         sum(size) AS total_volume,
         sum(CASE WHEN side = 'SELL' THEN size ELSE 0 END) AS buy_volume,
         sum(CASE WHEN side = 'BUY' THEN size ELSE 0 END) AS sell_volume,
         sum(price * size) AS notional_value
  FROM feed GROUP BY 1, 2
)"""

_TICKERS = """
tickers AS (
  SELECT "offset" AS kafka_offset, ts AS message_ts_utc, product_id, event_type, price,
         price - 0.5 AS best_bid,
         price + 0.25 * (1 + "offset" % 5) AS best_ask,
         price - 150 AS price_pct_chg_24h,
         size * 10 AS volume_24h,
         price + 5 AS high_24h,
         price - 5 AS low_24h
  FROM feed
)"""

_TICKER_MINUTES = """
ticker_minutes AS (
  SELECT product_id, date_trunc('minute', message_ts_utc) AS ticker_ts_utc,
         round(arg_max(price, kafka_offset), 4) AS price,
         round(arg_max(best_bid, kafka_offset), 4) AS best_bid,
         round(arg_max(best_ask, kafka_offset), 4) AS best_ask,
         round(arg_max((best_bid + best_ask) / 2, kafka_offset), 4) AS mid_price,
         round(arg_max(best_ask - best_bid, kafka_offset), 4) AS spread,
         round(arg_max(price_pct_chg_24h, kafka_offset), 4) AS price_pct_chg_24h,
         round(arg_max(volume_24h, kafka_offset), 8) AS volume_24h,
         round(arg_max(high_24h, kafka_offset), 4) AS high_24h,
         round(arg_max(low_24h, kafka_offset), 4) AS low_24h,
         max(kafka_offset) AS kafka_offset
  FROM tickers GROUP BY 1, 2
)"""

_CANDLES = """
candles AS (
  SELECT "offset" AS kafka_offset, ts AS message_ts_utc, product_id, event_type, size AS volume,
         price AS open, price + 2 AS high, price - 2 AS low, price + size * 0.04 AS close
  FROM feed
)"""

_CANDLE_MINUTES = """
candle_minutes AS (
  SELECT product_id, date_trunc('minute', message_ts_utc) AS candle_ts_utc,
         round(arg_max(open, kafka_offset), 4) AS open,
         round(arg_max(high, kafka_offset), 4) AS high,
         round(arg_max(low, kafka_offset), 4) AS low,
         round(arg_max(close, kafka_offset), 4) AS close,
         round(arg_max(high - low, kafka_offset), 4) AS range,
         round(arg_max((open + high + low + close) / 4, kafka_offset), 4) AS avg_price,
         max(kafka_offset) AS kafka_offset
  FROM candles GROUP BY 1, 2
)"""

# How often a message is sent, and with which type; and how many items it holds.
_COPIES = """
copies AS (
  SELECT *, 0 AS copy, 'update' AS update_type FROM feed
  UNION ALL
  SELECT *, 1 AS copy, CASE WHEN event_type = 'view' THEN 'snapshot' ELSE 'update' END
  FROM feed WHERE event_type IN ('purchase', 'view')
)"""

_SENT = """
sent AS (
  SELECT *, "offset" * 2 + copy AS kafka_offset,
         CASE WHEN event_type = 'signup' THEN 2 ELSE 1 END AS n_items
  FROM copies WHERE update_type = 'update'
)"""

_CHANNELS = """
channels AS (SELECT unnest(['ticker', 'candles', 'market_trades']) AS channel)"""

_SENT_TRADES = """
sent_trades AS (
  SELECT trade_id, product_id, side, size, price * size AS trade_value, ts AS trade_time_utc,
         event_type
  FROM sent
  UNION ALL
  SELECT trade_id, product_id, side, size, price * size, ts, event_type
  FROM sent WHERE n_items = 2
)"""

# Messages as they are damaged, and the items of those that can be read and are updates.
_DAMAGED = """
messages AS (
  SELECT *, "offset" * 2 + copy AS kafka_offset, ("offset" * 2 + copy) % 13 AS turn FROM copies CROSS JOIN channels
),
items AS (
  SELECT *, 0 AS item_pos FROM messages WHERE update_type = 'update' AND turn NOT IN (1, 2)
  UNION ALL
  SELECT *, 1 FROM messages WHERE update_type = 'update' AND turn NOT IN (1, 2) AND event_type = 'signup'
),
dead AS (
  SELECT 'message' AS kind, product_id, kafka_offset, 0 AS item_pos,
         CASE turn WHEN 1 THEN 'not json' ELSE 'empty' END AS reason
  FROM messages WHERE turn IN (1, 2)
  UNION ALL
  SELECT 'trade', product_id, kafka_offset, item_pos,
         CASE event_type WHEN 'click' THEN 'size,trade_value' ELSE 'trade_id' END
  FROM items WHERE channel = 'market_trades' AND event_type IN ('click', 'view')
  UNION ALL
  SELECT CASE channel WHEN 'ticker' THEN 'ticker' ELSE 'candle' END, product_id, kafka_offset, item_pos, 'message_ts_utc'
  FROM items WHERE channel IN ('ticker', 'candles') AND turn = 3
),
stored AS (
  SELECT 'trade' AS kind, product_id, count(DISTINCT trade_id) AS n
  FROM items WHERE channel = 'market_trades' AND event_type NOT IN ('click', 'view') GROUP BY 2
  UNION ALL
  SELECT CASE channel WHEN 'ticker' THEN 'ticker' ELSE 'candle' END, product_id, count(DISTINCT date_trunc('minute', ts))
  FROM items WHERE channel IN ('ticker', 'candles') AND turn <> 3 GROUP BY 1, 2
)"""

_DEAD_LETTERS = """
SELECT kind, product_id, kafka_offset, CAST(item_pos AS INTEGER) AS item_pos, reason, CAST(1 AS BIGINT) AS n FROM dead
UNION ALL
SELECT kind, product_id, NULL, NULL, 'stored', CAST(n AS BIGINT) FROM stored"""

_TRADE_COLUMNS = "trade_id, product_id, side, size, trade_value, trade_time_utc"
_ROUNDED_MINUTES = """
SELECT product_id, trade_time_utc, trade_count, round(total_volume, 4) AS total_volume,
       round(buy_volume, 4) AS buy_volume, round(sell_volume, 4) AS sell_volume,
       round(notional_value, 4) AS notional_value
FROM minutes"""
_TICKER_COLUMNS = (
    "product_id, ticker_ts_utc, price, best_bid, best_ask, mid_price, spread, "
    "price_pct_chg_24h, volume_24h, high_24h, low_24h"
)
_CANDLE_COLUMNS = "product_id, candle_ts_utc, open, high, low, close, range, avg_price"

_VWAP_CHART = """
SELECT p.product_id, p.ticker_ts_utc AS ts_utc,
       strftime(p.ticker_ts_utc + INTERVAL '330 minutes', '%H:%M') AS time_ist, p.price,
       round(v.rolling_vwap, 4) AS rolling_vwap
FROM (SELECT * FROM ticker_minutes, now_
      WHERE ticker_ts_utc >= as_of - INTERVAL '30 minutes') p
LEFT JOIN (
  SELECT product_id, trade_time_utc,
         sum(notional_value) OVER w / nullif(sum(total_volume) OVER w, 0) AS rolling_vwap
  FROM minutes, now_ WHERE trade_time_utc >= as_of - INTERVAL '30 minutes'
  WINDOW w AS (PARTITION BY product_id ORDER BY trade_time_utc)
) v ON p.product_id = v.product_id AND p.ticker_ts_utc = v.trade_time_utc"""


def _sql(body: str, *parts: str) -> str:
    return "WITH " + ",".join(parts) + body


def _latest(column: str, table: str, ts: str, minutes: str, rows: str) -> str:
    return _sql(
        f"\nSELECT product_id, arg_max({column}, {ts}) AS {column} FROM {table} GROUP BY 1",
        _FEED,
        rows,
        minutes,
    )


def _latest_ticker(column: str) -> str:
    return _latest(column, "ticker_minutes", "ticker_ts_utc", _TICKER_MINUTES, _TICKERS)


def _recent_sum(expression: str, name: str) -> str:
    return _sql(
        f"""
SELECT product_id, {expression} AS {name} FROM minutes, now_
WHERE trade_time_utc >= as_of - INTERVAL '30 minutes' GROUP BY 1""",
        _FEED,
        _NOW,
        _MINUTES,
    )


def _trim(body: str) -> str:
    victims = """
victims AS (
  SELECT trade_id, trade_time_utc FROM trades, now_
  WHERE trade_time_utc < as_of - INTERVAL '10 minutes'
  ORDER BY trade_time_utc, trade_id LIMIT 5000
)"""
    return _sql(body, _FEED, _NOW, _TRADES, victims)


def oracle_sql() -> dict[str, str]:
    minutes = _sql(_ROUNDED_MINUTES, _FEED, _MINUTES)
    ticker_minutes = _sql(f"\nSELECT {_TICKER_COLUMNS}, kafka_offset FROM ticker_minutes",
                          _FEED, _TICKERS, _TICKER_MINUTES)
    candle_minutes = _sql(f"\nSELECT {_CANDLE_COLUMNS}, kafka_offset FROM candle_minutes",
                          _FEED, _CANDLES, _CANDLE_MINUTES)
    quarantine = _sql(
            """
SELECT CASE WHEN event_type = 'click' THEN trade_id END AS trade_id, product_id, side,
       CASE WHEN event_type = 'view' THEN size END AS size,
       CASE WHEN event_type = 'view' THEN trade_value END AS trade_value, trade_time_utc,
       CASE event_type WHEN 'click' THEN 'size,trade_value' ELSE 'trade_id' END AS missing
FROM sent_trades WHERE event_type IN ('click', 'view')""",
            _FEED, _COPIES, _SENT, _SENT_TRADES,
        )
    return {
        "feed_source": _sql(
            """
SELECT 'market.' || channel AS topic, CAST(count(*) AS BIGINT) AS n_messages
FROM copies CROSS JOIN channels GROUP BY 1""",
            _FEED, _COPIES, _CHANNELS,
        ),
        "feed_contents": _sql(
            """
SELECT product_id AS key, 'market.' || channel AS topic,
       CASE product_id WHEN 'BTC-USD' THEN {0} WHEN 'ETH-USD' THEN {1} WHEN 'LINK-USD' THEN {2} ELSE {3} END AS partition,
       "offset" * 2 + copy AS "offset", ts AS record_time,
       '"channel":"' || channel || '","timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '000Z","sequence_num":'
         || "offset" AS said
FROM copies CROSS JOIN channels""".format(*(zlib.crc32(p.encode()) % 3 for p in PRODUCTS)),
            _FEED, _COPIES, _CHANNELS,
        ),
        "replay_range": _sql(
            """
SELECT product_id AS key, trade_id || '|' || side AS value, 'market.' || event_type AS topic,
       CAST(length(event_type) AS INTEGER) AS partition, "offset", ts AS "timestamp"
FROM feed
WHERE event_type = 'purchase' AND ts >= TIMESTAMP '2024-01-01 01:00:00'
  AND ts < TIMESTAMP '2024-01-01 11:00:00'""",
            _FEED,
        ),
        "route_feed": _sql(
            """
SELECT product_id AS key,
       '{' || CASE event_type WHEN 'view' THEN '' WHEN 'click' THEN '"channel":"ticker",'
                              ELSE '"channel":"Market-Trades",' END
           || CASE event_type WHEN 'error' THEN '' ELSE '"timestamp":"'
                              || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z",' END
           || '"sequence_num":' || trade_id || '}' AS value,
       CASE event_type WHEN 'view' THEN 'market.unknown' WHEN 'click' THEN 'market.ticker'
                       ELSE 'market.market_trades' END AS topic,
       CASE event_type WHEN 'error' THEN TIMESTAMP '2024-01-02 00:00:00'
                       ELSE make_timestamp((epoch_us(ts) // 1000) * 1000) END AS record_time
FROM feed""",
            _FEED,
        ),
        "enabled_products": _sql(
            """
SELECT product_id, CAST(count(*) AS BIGINT) AS n, round(sum(size), 4) AS volume
FROM feed WHERE product_id IN ('BTC-USD', 'ETH-USD', 'SOL-USD') GROUP BY 1""",
            _FEED,
        ),
        "insert_new_trades": _sql(
            f"""
SELECT {_TRADE_COLUMNS} FROM trades
WHERE trade_id NOT IN (
  SELECT trade_id FROM trades WHERE trade_time_utc < TIMESTAMP '2024-01-01 07:00:00')""",
            _FEED, _TRADES,
        ),
        "upsert_ticker": ticker_minutes,
        "upsert_candles": candle_minutes,
        "upsert_trade_agg": minutes,
        "hourly_partition_counts": _sql(
            """
SELECT strftime(trade_time_utc, '%Y%m%d_%H') AS event_hour, CAST(count(*) AS BIGINT) AS n
FROM minutes GROUP BY 1""",
            _FEED, _MINUTES,
        ),
        "retention_partitions": _sql(
            """
SELECT strftime(trade_time_utc, '%Y%m%d_%H') AS event_hour, CAST(count(*) AS BIGINT) AS n
FROM minutes, now_
WHERE date_trunc('hour', trade_time_utc) >= date_trunc('hour', as_of) - INTERVAL '1 hour'
GROUP BY 1""",
            _FEED, _NOW, _MINUTES,
        ),
        "trim_victims": _trim("\nSELECT trade_id, trade_time_utc FROM victims"),
        "trim_survivors": _trim(
            """
SELECT trade_id, product_id, trade_time_utc FROM trades
WHERE trade_id NOT IN (SELECT trade_id FROM victims)"""
        ),
        "fanout_counts": _sql(
            """
SELECT 'raw_market_trades' AS table_name, CAST(count(*) AS BIGINT) AS n FROM feed
UNION ALL
SELECT t.name, CAST(count(*) AS BIGINT)
FROM minutes CROSS JOIN (
  SELECT unnest(['market_trades_agg', 'ticker_snapshot', 'candles_snapshot']) AS name) t
GROUP BY 1""",
            _FEED, _MINUTES,
        ),
        "replay_idempotent": minutes,
        "replay_new_checkpoint": minutes,
        "fanout_contents": _sql(
            """
SELECT 'trade' AS kind, trade_id AS item, product_id, trade_time_utc AS ts, round(size, 4) AS a,
       round(trade_value, 4) AS b FROM trades
UNION ALL
SELECT 'minute', CAST(trade_count AS VARCHAR), product_id, trade_time_utc, round(total_volume, 4),
       round(notional_value, 4) FROM minutes
UNION ALL
SELECT 'ticker', '', product_id, ticker_ts_utc, round(price, 4), round(best_ask, 4) FROM ticker_minutes
UNION ALL
SELECT 'candle', '', product_id, candle_ts_utc, round(close, 4), round(avg_price, 4) FROM candle_minutes""",
            _FEED, _TRADES, _MINUTES, _TICKERS, _TICKER_MINUTES, _CANDLES, _CANDLE_MINUTES,
        ),
        "one_product_latest": _sql(
            """
SELECT unnest(['price', 'high_24h', 'low_24h', 'price_pct_chg_24h', 'volume_24h']) AS name,
       unnest([price, high_24h, low_24h, price_pct_chg_24h, volume_24h]) AS value
FROM (SELECT * FROM ticker_minutes WHERE product_id = 'ETH-USD'
      AND ticker_ts_utc BETWEEN TIMESTAMP '2024-01-01 06:00:00' AND TIMESTAMP '2024-01-01 06:17:00'
      ORDER BY ticker_ts_utc DESC LIMIT 1)
UNION ALL
SELECT unnest(['open', 'high', 'low', 'close', 'avg_price', 'range']) AS name,
       unnest([open, high, low, close, avg_price, range]) AS value
FROM (SELECT * FROM candle_minutes WHERE product_id = 'ETH-USD'
      AND candle_ts_utc BETWEEN TIMESTAMP '2024-01-01 06:00:00' AND TIMESTAMP '2024-01-01 06:17:00'
      ORDER BY candle_ts_utc DESC LIMIT 1)""",
            _FEED, _TICKERS, _TICKER_MINUTES, _CANDLES, _CANDLE_MINUTES,
        ),
        "one_product_30m": _sql(
            """
SELECT unnest(['buy_volume_30m', 'sell_volume_30m', 'trade_count_30m']) AS name,
       unnest([round(sum(buy_volume), 4), round(sum(sell_volume), 4),
               CAST(sum(trade_count) AS DOUBLE)]) AS value
FROM minutes WHERE product_id = 'ETH-USD'
  AND trade_time_utc BETWEEN TIMESTAMP '2024-01-01 05:47:00' AND TIMESTAMP '2024-01-01 06:17:00'""",
            _FEED, _MINUTES,
        ),
        "one_product_chart": _sql(
            f"""
SELECT time_ist, price, rolling_vwap FROM ({_VWAP_CHART}) WHERE product_id = 'ETH-USD'
  AND ts_utc <= (SELECT as_of FROM now_)""",
            _FEED,
            """
now_ AS (SELECT TIMESTAMP '2024-01-01 06:17:00' AS as_of)""",
            _MINUTES, _TICKERS, _TICKER_MINUTES,
        ),
        "parse_envelope": _sql(
            """
SELECT "offset" * 2 + copy AS "offset", product_id AS kafka_key, channel,
       "offset" AS sequence_num, ts AS message_ts_utc, CAST(2 AS BIGINT) AS n_events,
       update_type AS first_type
FROM copies CROSS JOIN channels""",
            _FEED, _COPIES, _CHANNELS,
        ),
        "parse_message_ts": _sql(
            """
SELECT "offset" AS event_id,
       CASE event_type
         WHEN 'click' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '123Z'
         WHEN 'view' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z'
         WHEN 'signup' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z'
         WHEN 'error' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z'
         ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+05:30' END AS time_text,
       CASE event_type
         WHEN 'click' THEN ts WHEN 'view' THEN ts
         WHEN 'signup' THEN make_timestamp((epoch_us(ts) // 1000) * 1000) END AS message_ts_utc
FROM feed""",
            _FEED,
        ),
        "first_update_event": _sql(
            """
SELECT kafka_offset AS "offset", product_id AS kafka_key, channel, 'update' AS type,
       CAST(CASE channel WHEN 'market_trades' THEN n_items END AS BIGINT) AS n_trades,
       CAST(CASE channel WHEN 'ticker' THEN n_items END AS BIGINT) AS n_tickers,
       CAST(CASE channel WHEN 'candles' THEN n_items END AS BIGINT) AS n_candles
FROM sent CROSS JOIN channels""",
            _FEED, _COPIES, _SENT, _CHANNELS,
        ),
        "prepare_trades": _sql(
            f"\nSELECT {_TRADE_COLUMNS} FROM sent_trades", _FEED, _COPIES, _SENT, _SENT_TRADES
        ),
        "prepare_tickers": _sql(
            """
SELECT s.kafka_offset, t.message_ts_utc, i.last_in_message, t.product_id,
       CASE WHEN i.last_in_message THEN t.price ELSE t.price - 7 END AS price,
       t.best_bid, t.best_ask, t.price_pct_chg_24h, t.volume_24h, t.high_24h, t.low_24h,
       (t.best_bid + t.best_ask) / 2 AS mid_price, t.best_ask - t.best_bid AS spread
FROM sent s JOIN tickers t ON t.kafka_offset = s."offset"
JOIN (VALUES (true, 1), (false, 2)) i(last_in_message, needs) ON i.needs <= s.n_items""",
            _FEED, _COPIES, _SENT, _TICKERS,
        ),
        "prepare_candles": _sql(
            """
SELECT s.kafka_offset, c.message_ts_utc, i.last_in_message, c.product_id,
       CASE WHEN i.last_in_message THEN c.open ELSE c.open - 7 END AS open,
       c.high, c.low, c.close, c.volume, round(c.high - c.low, 4) AS range,
       round((CASE WHEN i.last_in_message THEN c.open ELSE c.open - 7 END
              + c.high + c.low + c.close) / 4, 4) AS avg_price
FROM sent s JOIN candles c ON c.kafka_offset = s."offset"
JOIN (VALUES (true, 1), (false, 2)) i(last_in_message, needs) ON i.needs <= s.n_items""",
            _FEED, _COPIES, _SENT, _CANDLES,
        ),
        "product_fallback": _sql(
            """
SELECT k.kind, CASE k.kind WHEN 'trade' THEN s.trade_id ELSE CAST(s.kafka_offset AS VARCHAR) END AS item,
       s.product_id
FROM sent s CROSS JOIN (SELECT unnest(['ticker', 'candle', 'trade']) AS kind) k
JOIN (VALUES (1), (2)) i(needs) ON i.needs <= s.n_items""",
            _FEED, _COPIES, _SENT,
        ),
        "safe_casts": _sql(
            """
SELECT "offset" AS event_id,
       CASE WHEN event_type = 'error' THEN 1000.0::DOUBLE
            WHEN event_type NOT IN ('click', 'view') THEN size END AS number
FROM feed""",
            _FEED,
        ),
        "normalize_numeric": _sql(
            """
SELECT "offset" AS event_id,
       CASE WHEN event_type = 'view' THEN 0.0::DOUBLE ELSE round(price / 7, 4) END AS price,
       CASE WHEN event_type = 'view' THEN 0.0::DOUBLE ELSE round(size / 7, 8) END AS volume_24h
FROM feed""",
            _FEED,
        ),
        "minute_bucket": _sql(
            """
SELECT date_trunc('minute', ts) AS minute_start, CAST(count(*) AS BIGINT) AS n
FROM feed GROUP BY 1""",
            _FEED,
        ),
        "valid_rows": _sql(
            f"""
SELECT {_TRADE_COLUMNS} FROM sent_trades WHERE event_type NOT IN ('click', 'view')""",
            _FEED, _COPIES, _SENT, _SENT_TRADES,
        ),
        "quarantine_rows": quarantine,
        "minute_trade_agg": minutes,
        "buy_sell_volume": _sql(
            """
SELECT product_id, date_trunc('minute', ts) AS trade_time_utc,
       round(sum(size), 4) AS total_volume,
       round(sum(CASE WHEN event_type = 'error' THEN size ELSE 0 END), 4) AS buy_volume,
       round(sum(CASE WHEN event_type IN ('purchase', 'signup') THEN size ELSE 0 END), 4)
         AS sell_volume
FROM feed GROUP BY 1, 2""",
            _FEED,
        ),
        "dedup_trades": _sql(f"\nSELECT {_TRADE_COLUMNS} FROM trades", _FEED, _TRADES),
        "buy_volume_30m": _recent_sum("round(sum(buy_volume), 4)", "buy_volume_30m"),
        "sell_volume_30m": _recent_sum("round(sum(sell_volume), 4)", "sell_volume_30m"),
        "trade_count_30m": _recent_sum("CAST(sum(trade_count) AS BIGINT)", "trade_count_30m"),
        "latest_ticker_minute": ticker_minutes,
        "latest_candle_minute": candle_minutes,
        "distinct_on_latest": _sql(
            """
SELECT DISTINCT ON (product_id, date_trunc('minute', ts))
       product_id, date_trunc('minute', ts) AS minute_start, "offset", trade_id, side, price
FROM feed ORDER BY product_id, date_trunc('minute', ts), "offset" DESC""",
            _FEED,
        ),
        "rolling_vwap": _sql(
            """
SELECT product_id, trade_time_utc,
       round(sum(notional_value) OVER w / nullif(sum(total_volume) OVER w, 0), 4) AS rolling_vwap
FROM minutes WINDOW w AS (PARTITION BY product_id ORDER BY trade_time_utc)""",
            _FEED, _MINUTES,
        ),
        "stored_vwap": _sql(
            """
SELECT * FROM (
  SELECT product_id, trade_time_utc,
         round(sum(notional_value) OVER w / nullif(sum(total_volume) OVER w, 0), 4) AS rolling_vwap
  FROM minutes WINDOW w AS (PARTITION BY product_id ORDER BY trade_time_utc)
) WHERE trade_time_utc >= TIMESTAMP '2024-01-01 06:00:00'""",
            _FEED, _MINUTES,
        ),
        "rolling_vwap_and_price": _sql(
            _VWAP_CHART, _FEED, _NOW, _MINUTES, _TICKERS, _TICKER_MINUTES
        ),
        "current_price": _latest_ticker("price"),
        "high_24h": _latest_ticker("high_24h"),
        "low_24h": _latest_ticker("low_24h"),
        "price_change_24h": _latest_ticker("price_pct_chg_24h"),
        "volume_24h": _latest_ticker("volume_24h"),
        "latest_candle": _sql(
            """
SELECT product_id, arg_max(open, candle_ts_utc) AS open, arg_max(high, candle_ts_utc) AS high,
       arg_max(low, candle_ts_utc) AS low, arg_max(close, candle_ts_utc) AS close,
       arg_max(avg_price, candle_ts_utc) AS avg_price, arg_max(range, candle_ts_utc) AS range
FROM candle_minutes GROUP BY 1""",
            _FEED, _CANDLES, _CANDLE_MINUTES,
        ),
        "scalar_functions": _sql(
            """
SELECT "offset" AS event_id, date_trunc('hour', ts) AS hour_start,
       date_trunc('minute', ts) AS minute_start, ts AS parsed,
       strftime(ts + INTERVAL '330 minutes', '%H:%M') AS time_ist,
       ts - INTERVAL '30 minutes' AS half_hour_before,
       strftime(ts, '%Y%m%d_%H') AS hour_label,
       CASE WHEN event_type <> 'view' THEN strftime(ts, '%Y%m%d_%H') END AS label_in_name,
       date_trunc('hour', ts) AS hour_of_label,
       round(price / nullif(price - 150, 0), 4) AS ratio,
       epoch_us(ts) // 1000 AS epoch_ms,
       'market.' || lower(replace(product_id, '-', '_')) AS topic
FROM feed""",
            _FEED,
        ),
        "stream_dedup": _sql(f"\nSELECT {_TRADE_COLUMNS} FROM trades", _FEED, _TRADES),
        "stream_wrong_time": _sql(
            f"""
SELECT {_TRADE_COLUMNS}, CAST(NULL AS VARCHAR) AS missing FROM trades WHERE "offset" % 97 <> 5
UNION ALL
SELECT trade_id, product_id, side, size, trade_value, trade_time_utc + INTERVAL '500 days', 'future'
FROM trades WHERE "offset" % 97 = 5""",
            _FEED, _TRADES,
        ),
        "stream_late_repaired": minutes,
        # Watermarks are cut to milliseconds; an id expires ten minutes after its trade.
        "stream_state": _sql(
            """
SELECT trade_id, ts + INTERVAL '10 minutes' AS expires_utc FROM feed, now_
WHERE ts + INTERVAL '10 minutes' > date_trunc('millisecond', as_of) - INTERVAL '10 minutes'""",
            _FEED, _NOW,
        ),
        "trim_after_failure": _sql(
            """
SELECT m.product_id, m.trade_time_utc, m.trade_count, round(m.total_volume, 4) AS total_volume,
       round(m.buy_volume, 4) AS buy_volume, round(m.sell_volume, 4) AS sell_volume,
       round(m.notional_value, 4) AS notional_value, r.n_raw
FROM minutes m LEFT JOIN (
  SELECT product_id, date_trunc('minute', ts) AS trade_time_utc, CAST(count(*) AS BIGINT) AS n_raw
  FROM feed, now_ WHERE ts >= as_of - INTERVAL '10 minutes' GROUP BY 1, 2
) r ON m.product_id = r.product_id AND m.trade_time_utc = r.trade_time_utc""",
            _FEED, _NOW, _MINUTES,
        ),
        "reopened_tables": _sql(
            """
SELECT m.product_id, m.trade_time_utc, m.trade_count, round(m.total_volume, 4) AS total_volume,
       round(m.buy_volume, 4) AS buy_volume, round(m.sell_volume, 4) AS sell_volume,
       round(m.notional_value, 4) AS notional_value, t.price
FROM minutes m LEFT JOIN ticker_minutes t
  ON m.product_id = t.product_id AND m.trade_time_utc = t.ticker_ts_utc""",
            _FEED, _MINUTES, _TICKERS, _TICKER_MINUTES,
        ),
        "dead_letters": _sql(_DEAD_LETTERS, _FEED, _COPIES, _CHANNELS, _DAMAGED),
        "newest_rows": _sql(
            """
SELECT t.product_id, arg_max(t.price, t.ticker_ts_utc) AS price, arg_max(t.high_24h, t.ticker_ts_utc) AS high_24h,
       arg_max(t.low_24h, t.ticker_ts_utc) AS low_24h,
       arg_max(t.price_pct_chg_24h, t.ticker_ts_utc) AS price_pct_chg_24h,
       arg_max(t.volume_24h, t.ticker_ts_utc) AS volume_24h, any_value(c.open) AS open, any_value(c.high) AS high,
       any_value(c.low) AS low, any_value(c.close) AS close, any_value(c.avg_price) AS avg_price,
       any_value(c.range) AS range
FROM ticker_minutes t JOIN (
  SELECT DISTINCT ON (product_id) * FROM candle_minutes ORDER BY product_id, candle_ts_utc DESC
) c ON t.product_id = c.product_id
GROUP BY 1""",
            _FEED, _TICKERS, _TICKER_MINUTES, _CANDLES, _CANDLE_MINUTES,
        ),
        "stream_minute_agg": minutes,
        "stream_restart": minutes,
        "stream_quarantine": quarantine,
        "stream_minute_valid": _sql(
            _ROUNDED_MINUTES,
            _FEED.replace("FROM events", "FROM events WHERE event_type NOT IN ('click', 'view')"),
            _MINUTES,
        ),
        "stream_latest_ticker": _sql(
            f"\nSELECT {_TICKER_COLUMNS} FROM ticker_minutes", _FEED, _TICKERS, _TICKER_MINUTES
        ),
        "stream_latest_candle": _sql(
            f"\nSELECT {_CANDLE_COLUMNS} FROM candle_minutes", _FEED, _CANDLES, _CANDLE_MINUTES
        ),
        "stream_late_rows": _sql(
            """
SELECT CAST(count(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-01 06:00:00') AS BIGINT) AS n_kept,
       CAST(count(*) FILTER (WHERE ts < TIMESTAMP '2024-01-01 06:00:00') AS BIGINT) AS n_late
FROM feed""",
            _FEED,
        ),
    }
