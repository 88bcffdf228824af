"""Cumulative volume-weighted average price."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ratio_or_null


def cumulative_vwap(
    minutes: DataFrame, ts_col: str = "trade_time_utc", short_span: bool = False
) -> DataFrame:
    """product_id, time, rolling_vwap: notional over volume since the first row of the input.

    ``short_span=True`` is for a slice of minutes per product: one window per product. Otherwise
    the running sums are built in two levels, so no task holds the whole history of a product:
    hourly totals carry into windows that each span one product-hour. Rows need product and time.
    """
    if short_span:
        w = Window.partitionBy("product_id").orderBy(ts_col)
        notional, volume = F.sum("notional_value").over(w), F.sum("total_volume").over(w)
        return minutes.select(
            "product_id", ts_col, ratio_or_null(notional, volume).alias("rolling_vwap")
        )

    # The join below implies these null checks. Stated here they hold for both of its sides, which
    # then share one exchange.
    rows = minutes.select(
        "product_id",
        ts_col,
        "notional_value",
        "total_volume",
        F.date_trunc("hour", ts_col).alias("span"),
    ).where(F.col("product_id").isNotNull() & F.col("span").isNotNull())
    earlier = (
        Window.partitionBy("product_id")
        .orderBy("span")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = (
        rows.groupBy("product_id", "span")
        .agg(F.sum("notional_value").alias("n"), F.sum("total_volume").alias("v"))
        .select(
            "product_id",
            "span",
            F.coalesce(F.sum("n").over(earlier), F.lit(0.0)).alias("notional_before"),
            F.coalesce(F.sum("v").over(earlier), F.lit(0.0)).alias("volume_before"),
        )
    )
    inside = Window.partitionBy("product_id", "span").orderBy(ts_col)
    notional = F.col("notional_before") + F.sum("notional_value").over(inside)
    volume = F.col("volume_before") + F.sum("total_volume").over(inside)
    return rows.join(carried, ["product_id", "span"]).select(
        "product_id", ts_col, ratio_or_null(notional, volume).alias("rolling_vwap")
    )
