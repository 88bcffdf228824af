"""The ten dashboard questions.

Each takes the minute table, ``product_id`` (one product, or ``None`` for all products in one job)
and ``as_of``: nothing later than that counts. The latest-value questions take ``since`` as well,
which bounds how far back the newest value may lie and so how many hours are read. With a product the result has the reported columns only; for
all products it starts with ``product_id``.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import hour_label, local_hhmm, moment
from ..operators.latest import latest_row
from ..operators.vwap import cumulative_vwap
from ..sources.tables import time_slice

WINDOW_MINUTES = 30
ZONE = "Asia/Kolkata"
CANDLE_COLUMNS = ("open", "high", "low", "close", "avg_price", "range")

Moment = Column | datetime | str | None


def current_price(
    tickers: DataFrame, product_id: str | None = None, as_of: Moment = None, since: Moment = None
) -> DataFrame:
    return _latest(tickers, "ticker_ts_utc", ["price"], product_id, as_of, since)


def high_24h(
    tickers: DataFrame, product_id: str | None = None, as_of: Moment = None, since: Moment = None
) -> DataFrame:
    return _latest(tickers, "ticker_ts_utc", ["high_24h"], product_id, as_of, since)


def low_24h(
    tickers: DataFrame, product_id: str | None = None, as_of: Moment = None, since: Moment = None
) -> DataFrame:
    return _latest(tickers, "ticker_ts_utc", ["low_24h"], product_id, as_of, since)


def price_change_24h(
    tickers: DataFrame, product_id: str | None = None, as_of: Moment = None, since: Moment = None
) -> DataFrame:
    return _latest(tickers, "ticker_ts_utc", ["price_pct_chg_24h"], product_id, as_of, since)


def volume_24h(
    tickers: DataFrame, product_id: str | None = None, as_of: Moment = None, since: Moment = None
) -> DataFrame:
    return _latest(tickers, "ticker_ts_utc", ["volume_24h"], product_id, as_of, since)


def latest_candle(
    candles: DataFrame, product_id: str | None = None, as_of: Moment = None, since: Moment = None
) -> DataFrame:
    return _latest(candles, "candle_ts_utc", list(CANDLE_COLUMNS), product_id, as_of, since)


def buy_volume_30m(
    minutes: DataFrame, product_id: str | None = None, as_of: Moment = None
) -> DataFrame:
    return _recent_sum(minutes, "buy_volume", "buy_volume_30m", product_id, as_of)


def sell_volume_30m(
    minutes: DataFrame, product_id: str | None = None, as_of: Moment = None
) -> DataFrame:
    return _recent_sum(minutes, "sell_volume", "sell_volume_30m", product_id, as_of)


def trade_count_30m(
    minutes: DataFrame, product_id: str | None = None, as_of: Moment = None
) -> DataFrame:
    return _recent_sum(minutes, "trade_count", "trade_count_30m", product_id, as_of)


def rolling_vwap_and_price(
    tickers: DataFrame,
    minutes: DataFrame,
    product_id: str | None = None,
    as_of: Moment = None,
    zone: str = ZONE,
) -> DataFrame:
    """Price per minute beside the VWAP since the start of the window, in time order.

    Minutes without trades have a null VWAP; minutes without a ticker do not appear.
    """
    price = _recent(tickers, "ticker_ts_utc", product_id, as_of).select(
        "product_id", F.col("ticker_ts_utc").alias("ts_utc"), "price"
    )
    trades = _recent(minutes, "trade_time_utc", product_id, as_of)
    vwap = cumulative_vwap(trades, short_span=True).withColumnRenamed("trade_time_utc", "ts_utc")
    joined = price.join(vwap, ["product_id", "ts_utc"], "left")
    charted = ["price", "rolling_vwap"]
    label = local_hhmm(F.col("ts_utc"), zone).alias("time_ist")
    if product_id is not None:
        return joined.orderBy("ts_utc").select(label, *charted)
    return joined.orderBy("product_id", "ts_utc").select("product_id", "ts_utc", label, *charted)


def _until(df: DataFrame, ts_col: str, as_of: Moment) -> DataFrame:
    """Rows up to ``as_of``, itself included; also prunes later hours when the table has them."""
    high = moment(as_of)
    rows = df.where(F.col(ts_col) <= high)
    return rows.where(F.col("event_hour") <= hour_label(high)) if "event_hour" in df.columns else rows


def _latest(
    df: DataFrame, ts_col: str, columns: list[str], product_id: str | None, as_of: Moment, since: Moment
) -> DataFrame:
    rows = df if as_of is None else _until(df, ts_col, as_of)
    return latest_row(rows if since is None else time_slice(rows, ts_col, since), ts_col, columns, product_id)


def _recent(df: DataFrame, ts_col: str, product_id: str | None, as_of: Moment) -> DataFrame:
    start = moment(as_of) - F.make_interval(mins=F.lit(WINDOW_MINUTES))
    recent = _until(time_slice(df, ts_col, start), ts_col, as_of)
    return recent if product_id is None else recent.where(F.col("product_id") == product_id)


def _recent_sum(
    minutes: DataFrame, measure: str, name: str, product_id: str | None, as_of: Moment
) -> DataFrame:
    recent = _recent(minutes, "trade_time_utc", product_id, as_of)
    total = F.sum(measure).alias(name)
    return recent.agg(total) if product_id is not None else recent.groupBy("product_id").agg(total)
