from .numbers import normalize_numeric, ratio_or_null, side_volume, to_double
from .times import (
    epoch_ms,
    hour_label,
    hour_of_label,
    label_in_name,
    local_hhmm,
    minute_bucket,
    moment,
    parse_message_ts,
    parse_trade_ts,
)

__all__ = [
    "epoch_ms",
    "hour_label",
    "hour_of_label",
    "label_in_name",
    "local_hhmm",
    "minute_bucket",
    "moment",
    "normalize_numeric",
    "parse_message_ts",
    "parse_trade_ts",
    "ratio_or_null",
    "side_volume",
    "to_double",
]
