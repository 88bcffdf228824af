"""Time columns. The session zone is UTC throughout (see ``streaming.runner.use_utc``)."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed formats.
MESSAGE_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSSSSX"
HOUR_LABEL_FORMAT = "yyyyMMdd_HH"
HOUR_LABEL_REGEX = r"_(\d{8}_\d{2})$"

_UNIX_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def moment(value: Column | datetime | str | None) -> Column:
    """A point in time as a column; ``None`` is now, a naive datetime is UTC.

    A datetime folds to a literal, so comparisons with it reach the Parquet scan.
    """
    if value is None:
        return F.current_timestamp()
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        return F.lit(value).cast("timestamp")
    if value.tzinfo is None:
        value = value.replace(tzinfo=timezone.utc)
    return F.timestamp_micros(F.lit((value - _UNIX_EPOCH) // timedelta(microseconds=1)))


def parse_message_ts(text: Column) -> Column:
    """Envelope time. One pattern takes 1 to 9 fraction digits; other text gives null."""
    return F.try_to_timestamp(text, F.lit(MESSAGE_TS_FORMAT))


def parse_trade_ts(text: Column) -> Column:
    """Trade time: any ISO text, fraction optional; bad text gives null."""
    return text.try_cast("timestamp")


def minute_bucket(ts: Column) -> Column:
    return F.date_trunc("minute", ts)


def hour_label(ts: Column) -> Column:
    """Partition label of the hour that holds ``ts``; labels sort in time order."""
    return F.date_format(ts, HOUR_LABEL_FORMAT)


def hour_of_label(label: Column) -> Column:
    return F.try_to_timestamp(label, F.lit(HOUR_LABEL_FORMAT))


def label_in_name(name: Column) -> Column:
    """Label at the end of a ``<table>_<label>`` name, null when there is none."""
    found = F.regexp_extract(name, HOUR_LABEL_REGEX, 1)
    return F.when(found != "", found)


def epoch_ms(text: Column) -> Column:
    """ISO text to epoch milliseconds, finer fractions cut off; bad text gives null."""
    return F.unix_millis(parse_trade_ts(text))


def local_hhmm(ts: Column, zone: str) -> Column:
    return F.date_format(F.from_utc_timestamp(ts, zone), "HH:mm")
