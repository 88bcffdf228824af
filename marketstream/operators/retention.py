"""What retention keeps and removes."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import hour_label, moment

# Fixed value: raw trades live 10 minutes.
TRIM_AGE_MINUTES = 10


def hour_cutoff(as_of: Column | datetime | str | None, keep_hours: int = 1) -> Column:
    """Start of the oldest hour that is kept."""
    return F.date_trunc("hour", moment(as_of)) - F.make_interval(hours=F.lit(keep_hours))


def keep_recent_hours(
    df: DataFrame, as_of: Column | datetime | str | None = None, keep_hours: int = 1
) -> DataFrame:
    """Rows of an hourly table that survive dropping the old partitions."""
    return df.where(F.col("event_hour") >= hour_label(hour_cutoff(as_of, keep_hours)))


def trim_victims(
    df: DataFrame,
    as_of: Column | datetime | str | None = None,
    ts_col: str = "trade_time_utc",
    id_col: str = "trade_id",
    age_minutes: int = TRIM_AGE_MINUTES,
    limit: int | None = None,
) -> DataFrame:
    """Id and time of the rows past the age; with ``limit`` the oldest so many, ties broken by id.

    Without a limit this is one filtered scan. With one, a plain top-n would send ``limit`` rows of every input task to one task. Row counts per hour,
    then per second, first narrow the input to about the rows that can be picked.
    """
    cutoff = moment(as_of) - F.make_interval(mins=F.lit(age_minutes))
    old = df.where(F.col(ts_col) < cutoff).select(id_col, ts_col)
    if limit is None:
        return old
    for unit in ("hour", "second"):
        old = _oldest_buckets(old, ts_col, unit, limit)
    return old.orderBy(ts_col, id_col).limit(limit)


def trim_rows(
    df: DataFrame,
    as_of: Column | datetime | str | None = None,
    ts_col: str = "trade_time_utc",
    id_col: str = "trade_id",
    age_minutes: int = TRIM_AGE_MINUTES,
    limit: int | None = None,
) -> DataFrame:
    """The table without the victims."""
    victims = trim_victims(df, as_of, ts_col, id_col, age_minutes, limit)
    return df.join(victims.select(id_col), id_col, "left_anti")


def _oldest_buckets(df: DataFrame, ts_col: str, unit: str, limit: int) -> DataFrame:
    """Rows up to and including the time bucket in which the ``limit``-th oldest row lies."""
    counts = df.groupBy(F.date_trunc(unit, ts_col).alias("bucket")).agg(F.count("*").alias("n"))
    running = F.sum("n").over(Window.orderBy("bucket"))
    last = (
        counts.select("bucket", "n", running.alias("running"))
        .where(F.col("running") - F.col("n") < limit)
        .agg(F.max("bucket"))
        .scalar()
    )
    return df.where(F.date_trunc(unit, ts_col) <= last)
