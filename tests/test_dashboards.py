"""Dashboard questions for one product and for all."""

from datetime import timedelta

import pytest
from conftest import utc

from marketstream.plans import dashboards as d

NOW = utc("2024-01-01T12:00:00")
MINUTES = (
    "product_id STRING, trade_time_utc TIMESTAMP, trade_count BIGINT, total_volume DOUBLE, "
    "buy_volume DOUBLE, sell_volume DOUBLE, notional_value DOUBLE"
)
TICKERS = (
    "product_id STRING, ticker_ts_utc TIMESTAMP, price DOUBLE, price_pct_chg_24h DOUBLE, "
    "volume_24h DOUBLE, high_24h DOUBLE, low_24h DOUBLE"
)
CANDLES = (
    "product_id STRING, candle_ts_utc TIMESTAMP, open DOUBLE, high DOUBLE, low DOUBLE, "
    "close DOUBLE, range DOUBLE, avg_price DOUBLE"
)


def ago(minutes):
    return NOW - timedelta(minutes=minutes)


@pytest.fixture(scope="module")
def minutes(spark):
    rows = [
        ("A", ago(31), 9, 9.0, 9.0, 0.0, 900.0),
        ("A", ago(30), 2, 2.0, 1.5, 0.5, 200.0),
        ("A", ago(10), 3, 3.0, 1.0, 2.0, 330.0),
        ("B", ago(5), 1, 0.0, 0.0, 0.0, 0.0),
    ]
    return spark.createDataFrame(rows, MINUTES)


@pytest.fixture(scope="module")
def tickers(spark):
    rows = [
        ("A", ago(40), 1.0, 0.1, 10.0, 11.0, 0.5),
        ("A", ago(30), 2.0, 0.2, 20.0, 12.0, 0.6),
        ("A", ago(9), 3.0, 0.3, 30.0, 13.0, 0.7),
        ("B", ago(5), 4.0, 0.4, 40.0, 14.0, 0.8),
    ]
    return spark.createDataFrame(rows, TICKERS)


@pytest.mark.parametrize(
    ("question", "column", "answer"),
    [
        (d.current_price, "price", 3.0),
        (d.high_24h, "high_24h", 13.0),
        (d.low_24h, "low_24h", 0.7),
        (d.price_change_24h, "price_pct_chg_24h", 0.3),
        (d.volume_24h, "volume_24h", 30.0),
    ],
)
def test_latest_value(tickers, question, column, answer):
    one = question(tickers, "A")
    assert one.columns == [column]
    assert [row[0] for row in one.collect()] == [answer]
    every = {row["product_id"]: row[column] for row in question(tickers).collect()}
    assert every["A"] == answer
    assert set(every) == {"A", "B"}
    assert question(tickers, "unknown").collect() == []


def test_latest_candle(spark):
    rows = [("A", ago(2), 1.0, 2.0, 3.0, 4.0, 5.0, 6.0), ("A", ago(1), 7.0, 8.0, 9.0, 1.0, 2.0, 3.0)]
    candles = spark.createDataFrame(rows, CANDLES)
    (row,) = d.latest_candle(candles, "A").collect()
    assert row.asDict() == {
        "open": 7.0, "high": 8.0, "low": 9.0, "close": 1.0, "avg_price": 3.0, "range": 2.0
    }


@pytest.mark.parametrize(
    ("question", "answer", "other"),
    [(d.buy_volume_30m, 2.5, 0.0), (d.sell_volume_30m, 2.5, 0.0), (d.trade_count_30m, 5, 1)],
)
def test_recent_sum(minutes, question, answer, other):
    (row,) = question(minutes, "A", NOW).collect()
    assert row[0] == answer
    every = dict(map(tuple, question(minutes, as_of=NOW).collect()))
    assert every == {"A": answer, "B": other}


def test_empty_window_gives_null_for_one_and_no_row_for_all(minutes):
    later = NOW + timedelta(hours=5)
    assert [tuple(r) for r in d.buy_volume_30m(minutes, "A", later).collect()] == [(None,)]
    assert d.buy_volume_30m(minutes, as_of=later).collect() == []


def test_nothing_after_as_of_counts(spark):
    rows = [("A", NOW + timedelta(minutes=m), 1, 1.0, 1.0, 0.0, 2.0) for m in range(-40, 60)]
    minutes = spark.createDataFrame(rows, MINUTES)
    assert d.trade_count_30m(minutes, "A", NOW).first()[0] == 31
    assert d.trade_count_30m(minutes, as_of=NOW).first()["trade_count_30m"] == 31


def test_latest_value_in_the_middle_of_the_data(tickers):
    def price(**asked):
        return [r["price"] for r in d.current_price(tickers, "A", **asked).collect()]

    assert price(as_of=ago(20)) == [2.0]
    assert price(as_of=ago(30)) == [2.0]
    assert price(as_of=ago(35)) == [1.0]
    assert price(as_of=ago(35), since=ago(36)) == []
    assert sorted(map(tuple, d.current_price(tickers, as_of=ago(20)).collect())) == [("A", 2.0)]


def test_chart_for_one_product(tickers, minutes):
    rows = d.rolling_vwap_and_price(tickers, minutes, "A", NOW).collect()
    assert [tuple(row) for row in rows] == [("17:00", 2.0, 100.0), ("17:21", 3.0, None)]


def test_chart_in_another_zone_and_for_all(tickers, minutes):
    rows = d.rolling_vwap_and_price(tickers, minutes, as_of=NOW, zone="UTC").collect()
    got = [(r["product_id"], r["time_ist"], r["price"], r["rolling_vwap"]) for r in rows]
    assert got == [
        ("A", "11:30", 2.0, 100.0),
        ("A", "11:51", 3.0, None),
        ("B", "11:55", 4.0, None),
    ]
