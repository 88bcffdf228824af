"""Stored sums before each hour, so that a cumulative price of any range reads its hours and little else.

A carry is right whenever it exists: a batch drops those after the first hour that it changes, before
it changes it (``BatchTable.carried``). ``refresh_carries`` makes the missing ones again, from the last
one that is left. Until then a reader starts at an earlier hour and gets the same price.
"""

from __future__ import annotations

import time
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import hour_label, hour_of_label, moment
from ..operators.vwap import cumulative_vwap
from ..sources.tables import HourlyTable, Moment
from .batch_tables import BatchTable

CARRIED = "carried"
_LABEL = "%Y%m%d_%H"


def _after(label: str) -> str:
    return (datetime.strptime(label, _LABEL) + timedelta(hours=1)).strftime(_LABEL)


def refresh_carries(minutes: BatchTable, carries: BatchTable) -> list[str]:
    """Make the carries of the hours that lack one, and of the hour to come; returns these hours.

    Reads the minutes from the last hour on that has a carry.
    """
    carries.recover()
    stored, known = minutes.table.hours(), carries.table.hours()
    base = known[-1] if known else None
    since = [hour for hour in stored if base is None or hour >= base]
    wanted = [hour for hour in (*since, *([_after(since[-1])] if since else [])) if base is None or hour > base]
    if not wanted:
        return []
    hour = F.date_trunc("hour", "trade_time_utc").alias("hour")
    totals = minutes.table.in_hours(since).groupBy("product_id", hour).agg(
        F.sum("total_volume").alias("v"), F.sum("notional_value").alias("n")
    )
    if base is not None:
        before = carries.table.in_hours([base])
        totals = totals.unionByName(
            before.select("product_id", F.col("trade_time_utc").alias("hour"), F.col("volume_before").alias("v"), F.col("notional_before").alias("n"))
        )
    hours = F.explode(F.array(*[hour_of_label(F.lit(h)) for h in wanted])).alias("hour")
    asked = totals.select("product_id").distinct().select("product_id", hours)
    steps = totals.withColumn("asked", F.lit(False)).unionByName(
        asked.withColumns({"v": F.lit(0.0), "n": F.lit(0.0), "asked": F.lit(True)})
    )
    # One row per product and hour; what is asked for an hour comes before the hour's own sums.
    until = Window.partitionBy("product_id").orderBy("hour", F.col("asked").desc()).rowsBetween(Window.unboundedPreceding, 0)
    sums = steps.select("product_id", "hour", "asked", F.sum("v").over(until).alias("v"), F.sum("n").over(until).alias("n"))
    rows = sums.where("asked").select(
        "product_id", F.col("hour").alias("trade_time_utc"), F.col("v").alias("volume_before"), F.col("n").alias("notional_before")
    )
    carries.apply(carries.stage_rows(rows, set(wanted), CARRIED, time.time_ns() // 1000))
    return wanted


def vwap_since(minutes: HourlyTable, carries: HourlyTable, start: Moment, end: Moment | None = None) -> DataFrame:
    """``cumulative_vwap`` over the whole history, of the minutes with ``start <= time < end`` only.

    Reads the minutes from the last carried hour on that is not after ``start``, and a row per product.
    """
    spark, low = minutes.spark, moment(start)
    label = spark.range(1).select(hour_label(low)).first()[0]
    base = max((hour for hour in carries.hours() if hour <= label), default=None)
    columns = ["product_id", "trade_time_utc", "total_volume", "notional_value"]
    if base is None:
        rows = minutes.read() if end is None else minutes.slice(F.lit(0).cast("timestamp"), end)
        rows = rows.select(*columns)
    else:
        first = hour_of_label(F.lit(base))
        before = carries.in_hours([base]).select(
            "product_id",
            (F.col("trade_time_utc") - F.make_interval(secs=F.lit(1))).alias("trade_time_utc"),
            F.col("volume_before").alias("total_volume"),
            F.col("notional_before").alias("notional_value"),
        )
        rows = minutes.slice(first, end).select(*columns).unionByName(before)
    return cumulative_vwap(rows).where(F.col("trade_time_utc") >= low)
