"""Newest row per key.

``max_by`` per column over a numeric order keeps every aggregation buffer fixed-width, so Spark
hash-aggregates before the shuffle and a hot key costs one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import minute_bucket, normalize_numeric
from ..schemas import CANDLE_SCALES, TICKER_SCALES


def latest_per_minute(
    df: DataFrame, out_ts: str, values: Sequence[str], order_col: str = "kafka_offset"
) -> DataFrame:
    """Row with the highest ``order_col`` per product and message minute, as ``out_ts``.

    Rows without product or message time are dropped, and so are items that a later item of the
    same message supersedes.
    """
    rows = df.where(F.col("product_id").isNotNull() & F.col("message_ts_utc").isNotNull())
    if "last_in_message" in df.columns:
        rows = rows.where("last_in_message")
    return rows.groupBy("product_id", minute_bucket(F.col("message_ts_utc")).alias(out_ts)).agg(
        *newest_values(values, order_col)
    )


def newest_values(values: Sequence[str], order_col: str) -> list[Column]:
    return [F.max_by(v, order_col).alias(v) for v in values] + [F.max(order_col).alias(order_col)]


def latest_ticker_minutes(tickers: DataFrame) -> DataFrame:
    """Ticker snapshot rows: latest per product and minute, nulls 0, rounded."""
    return normalize_numeric(
        latest_per_minute(tickers, "ticker_ts_utc", list(TICKER_SCALES)), TICKER_SCALES
    )


def latest_candle_minutes(candles: DataFrame) -> DataFrame:
    """Candle snapshot rows. The minute is the message's, not the candle's own start."""
    return normalize_numeric(
        latest_per_minute(candles, "candle_ts_utc", list(CANDLE_SCALES)), CANDLE_SCALES
    )


def distinct_on(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """First whole row per key in the given order, for columns of any type.

    Spark limits each key to one row per task before the shuffle (WindowGroupLimit).
    """
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by))
    return df.withColumn("rn", first).where("rn = 1").drop("rn")


def latest_row(
    df: DataFrame, ts_col: str, values: Sequence[str], product_id: str | None = None
) -> DataFrame:
    """Newest values: of one product (a top-1), or of every product (one aggregate)."""
    if product_id is not None:
        return (
            df.where(F.col("product_id") == product_id)
            .orderBy(F.col(ts_col).desc())
            .limit(1)
            .select(*values)
        )
    return df.groupBy("product_id").agg(*[F.max_by(v, ts_col).alias(v) for v in values])


def newest_row(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The whole row with the greatest ``order_by`` per key, for tables of few rows per key."""
    values = [c for c in df.columns if c not in keys]
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*values), F.struct(*order_by)).alias("newest"))
    return newest.select(*keys, "newest.*").select(*df.columns)
