"""Wire format cases."""

import pytest
import wire
from conftest import utc
from pyspark.sql import functions as F

from marketstream.functions import parse_message_ts, parse_trade_ts, to_double
from marketstream.operators import (
    dedup_trades,
    first_update_event,
    minute_trade_agg,
    parse_envelope,
    prepare_candles,
    prepare_tickers,
    prepare_trades,
    quarantine_rows,
    valid_rows,
)
from marketstream.operators.latest import latest_candle_minutes, latest_ticker_minutes
from marketstream.operators.quality import TRADE_REQUIRED


def trades_of(spark, *values, **options):
    return prepare_trades(wire.updates(spark, *values, **options)).collect()


def test_base_trade_counts_as_taker_buy(spark):
    df = prepare_trades(wire.updates(spark, wire.trades_message(wire.trade())))
    (row,) = df.collect()
    assert row["trade_value"] == pytest.approx(20.1)
    (total,) = minute_trade_agg(df).collect()
    assert (total["buy_volume"], total["sell_volume"], total["trade_count"]) == (0.2, 0.0, 1)


def test_snapshot_is_dropped(spark):
    assert trades_of(spark, wire.trades_message(wire.trade(), type="snapshot")) == []


@pytest.mark.parametrize("value", ['{"events": []}', "{}", "not json", '{"events": null}', ""])
def test_no_event_no_rows(spark, value):
    assert trades_of(spark, value) == []


def test_null_value_gives_no_rows(spark):
    rows = wire.kafka_rows(spark, "{}").withColumn("value", F.lit(None).cast("binary"))
    assert prepare_trades(first_update_event(parse_envelope(rows))).collect() == []


def two_events():
    message = wire.trades_message(wire.trade())
    message["events"].append({"type": "update", "trades": [wire.trade(trade_id="2")]})
    return message


def test_only_first_event_is_read(spark):
    assert [row["trade_id"] for row in trades_of(spark, two_events())] == ["1"]


def test_all_events_on_request(spark):
    parsed = parse_envelope(wire.kafka_rows(spark, two_events()))
    rows = prepare_trades(first_update_event(parsed, all_events=True)).collect()
    assert sorted(row["trade_id"] for row in rows) == ["1", "2"]


def test_product_falls_back_to_key(spark):
    message = wire.trades_message(wire.trade(product_id=...))
    (row,) = trades_of(spark, message, key="ETH-USD")
    assert row["product_id"] == "ETH-USD"


def test_empty_item_array_vanishes(spark):
    assert trades_of(spark, wire.trades_message()) == []


def test_bad_size_is_quarantined_and_good_rows_stay(spark):
    message = wire.trades_message(
        wire.trade(), wire.trade(trade_id="2", size="x"), wire.trade(trade_id=None)
    )
    df = prepare_trades(wire.updates(spark, message))
    assert [row["trade_id"] for row in valid_rows(df, TRADE_REQUIRED).collect()] == ["1"]
    bad = {row["trade_id"]: row["missing"] for row in quarantine_rows(df, TRADE_REQUIRED).collect()}
    assert bad == {"2": "size,trade_value", None: "trade_id"}


def test_null_trade_id_is_discarded(spark):
    df = prepare_trades(wire.updates(spark, wire.trades_message(wire.trade(trade_id=None))))
    assert dedup_trades(df).collect() == []


def test_same_id_twice_counts_once(spark):
    message = wire.trades_message(wire.trade(), wire.trade())
    df = prepare_trades(wire.updates(spark, message, message))
    assert dedup_trades(df).count() == 1


def test_other_side_is_in_total_only(spark):
    message = wire.trades_message(
        wire.trade(side="OTHER"), wire.trade(trade_id="2", side="BUY", size="3")
    )
    (row,) = minute_trade_agg(prepare_trades(wire.updates(spark, message))).collect()
    volumes = row["total_volume"], row["buy_volume"], row["sell_volume"]
    assert volumes == (pytest.approx(3.2), 0.0, 3.0)


def column_value(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("text", "micros"),
    [
        ("2024-01-01T00:00:01.123456789Z", 123456),
        ("2024-01-01T00:00:01.123456Z", 123456),
        ("2024-01-01T00:00:01.123Z", 123000),
        ("2024-01-01T00:00:01Z", None),
        ("2024-01-01T00:00:01.123456+05:30", None),
        ("yesterday", None),
        (None, None),
    ],
)
def test_message_time(spark, text, micros):
    got = column_value(
        spark, F.unix_micros(parse_message_ts(F.lit(text).cast("string")))
    )
    base = 1704067201000000
    assert got == (None if micros is None else base + micros)


@pytest.mark.parametrize(
    ("text", "seconds"),
    [
        ("2024-01-01T00:00:01Z", 1704067201),
        ("2024-01-01T05:30:01+05:30", 1704067201),
        ("2024-01-01T00:00:01.9Z", 1704067201),
        ("soon", None),
    ],
)
def test_trade_time(spark, text, seconds):
    assert column_value(spark, F.unix_seconds(parse_trade_ts(F.lit(text)))) == seconds


@pytest.mark.parametrize(("text", "number"), [("1.5", 1.5), ("x", None), ("", None), ("1e3", 1e3)])
def test_to_double(spark, text, number):
    assert column_value(spark, to_double(F.lit(text))) == number


def ticker_minutes(spark, *values, **options):
    return latest_ticker_minutes(prepare_tickers(wire.updates(spark, *values, **options)))


def test_ticker_null_becomes_zero_and_rounds(spark):
    message = wire.message("tickers", wire.ticker(price=None, best_bid="100.00005"))
    (row,) = ticker_minutes(spark, message).collect()
    assert (row["price"], row["best_bid"], row["volume_24h"]) == (0.0, 100.0001, 12.12345679)
    assert row["spread"] == pytest.approx(1.0, abs=1e-4)


def test_ticker_without_message_time_is_dropped(spark):
    message = wire.message("tickers", wire.ticker(), timestamp="2024-01-01T00:00:01Z")
    assert ticker_minutes(spark, message).collect() == []


def test_highest_offset_wins(spark):
    messages = [
        wire.message("tickers", wire.ticker(price="9"), timestamp="2024-01-01T00:00:01.5Z"),
        wire.message("tickers", wire.ticker(price="5"), timestamp="2024-01-01T00:00:00.5Z"),
    ]
    (row,) = ticker_minutes(spark, *messages, offset=5).collect()
    assert (row["price"], row["kafka_offset"]) == (5.0, 6)


def test_later_item_of_one_message_wins_per_product(spark):
    message = wire.message(
        "tickers",
        wire.ticker(price="1"),
        wire.ticker(price="7", product_id="ETH-USD"),
        wire.ticker(price="2"),
        wire.ticker(price="3", product_id=...),
        wire.ticker(price="8", product_id="ETH-USD"),
    )
    got = {row["product_id"]: row["price"] for row in ticker_minutes(spark, message).collect()}
    assert got == {"BTC-USD": 3.0, "ETH-USD": 8.0}
    rows = prepare_tickers(wire.updates(spark, message)).collect()
    assert len(rows) == 5


def test_candle_minute_is_the_message_minute(spark):
    message = wire.message("candles", wire.candle(start="1704060000"))
    (row,) = latest_candle_minutes(prepare_candles(wire.updates(spark, message))).select(
        "*", F.unix_seconds("candle_ts_utc").alias("s")
    ).collect()
    assert row["s"] == utc("2024-01-01T00:00:00").timestamp()
    assert (row["range"], row["avg_price"]) == (3.0, 3.0)


def test_other_channels_give_no_rows(spark):
    df = wire.updates(spark, wire.message("tickers", wire.ticker()))
    assert prepare_trades(df).count() == 0
    assert prepare_candles(df).count() == 0
    assert prepare_tickers(df).count() == 1
