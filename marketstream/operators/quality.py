"""Split rows into those a table can hold and those set aside with the reason."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRADE_REQUIRED = ("trade_id", "product_id", "side", "size", "trade_value", "trade_time_utc")
TICKER_REQUIRED = ("product_id", "message_ts_utc")
CANDLE_REQUIRED = ("product_id", "message_ts_utc")


#: How far a clock may be ahead. One time far in the future would move a watermark past all rows.
AHEAD_MINUTES = 60
#: When the log took the record. In a replay this lies in the past, and times are measured against it.
RECORD_TIME = "record_ts_utc"


def valid_rows(df: DataFrame, required: Sequence[str], time: str | None = None) -> DataFrame:
    """Rows that have all required columns, and if ``time`` is named, no time in the future.

    The future begins an hour after the record's own time (``record_ts_utc``, if the rows have it), and
    in any case an hour from now.
    """
    return df.where(_complete(df, required, time))


def quarantine_rows(df: DataFrame, required: Sequence[str], time: str | None = None) -> DataFrame:
    """The other rows, with ``missing``: the required columns that are null, comma separated.

    A time in the future is listed as ``future``.
    """
    reasons = [F.when(F.col(c).isNull(), F.lit(c)) for c in required]
    if time is not None:
        reasons.append(F.when(~_timely(df, time), F.lit("future")))
    return df.where(~_complete(df, required, time)).withColumn("missing", F.concat_ws(",", *reasons))


def _timely(df: DataFrame, time: str) -> Column:
    known = F.current_timestamp()
    if RECORD_TIME in df.columns:
        known = F.least(F.col(RECORD_TIME), known)  # a missing record time is passed over
    ahead = known + F.make_interval(mins=F.lit(AHEAD_MINUTES))
    return F.coalesce(F.col(time) <= ahead, F.lit(True))


def _complete(df: DataFrame, required: Sequence[str], time: str | None) -> Column:
    condition = F.lit(True) if time is None else _timely(df, time)
    for name in required:
        condition = condition & F.col(name).isNotNull()
    return condition
