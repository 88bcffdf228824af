from .items import prepare_candles, prepare_tickers, prepare_trades
from .latest import distinct_on, latest_per_minute, latest_row
from .merge import insert_new, upsert_add, upsert_replace
from .parse import first_update_event, parse_envelope
from .quality import quarantine_rows, valid_rows
from .retention import keep_recent_hours, trim_rows, trim_victims
from .trades import dedup_trades, minute_trade_agg
from .vwap import cumulative_vwap

__all__ = [
    "cumulative_vwap",
    "dedup_trades",
    "distinct_on",
    "first_update_event",
    "insert_new",
    "keep_recent_hours",
    "latest_per_minute",
    "latest_row",
    "minute_trade_agg",
    "parse_envelope",
    "prepare_candles",
    "prepare_tickers",
    "prepare_trades",
    "quarantine_rows",
    "trim_rows",
    "trim_victims",
    "upsert_add",
    "upsert_replace",
    "valid_rows",
]
