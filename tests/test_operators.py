"""Operators on small relations, and properties that must hold for any input."""

from datetime import timedelta

import pytest
from conftest import utc
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketstream.operators import (
    cumulative_vwap,
    distinct_on,
    insert_new,
    keep_recent_hours,
    minute_trade_agg,
    trim_rows,
    trim_victims,
    upsert_add,
    upsert_replace,
)
from marketstream.schemas import TRADE_MEASURES

TRADES = (
    "trade_id STRING, product_id STRING, side STRING, size DOUBLE, trade_value DOUBLE, "
    "trade_time_utc TIMESTAMP"
)
START = utc("2024-01-01T00:00:00")
KEYS = ["product_id", "trade_time_utc"]
SOME = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)

trade_lists = st.lists(
    st.tuples(
        st.sampled_from(["A", "B"]),
        st.sampled_from(["BUY", "SELL"]),
        st.integers(1, 50),
        st.integers(1, 50),
        st.integers(0, 7200),
        st.booleans(),
    ),
    min_size=1,
    max_size=40,
)


def trades_df(spark, rows):
    data = [
        (str(n), product, side, float(size), float(size * price), START + timedelta(seconds=s))
        for n, (product, side, size, price, s, _) in enumerate(rows)
    ]
    return spark.createDataFrame(data, TRADES)


def as_set(df):
    return sorted(map(str, df.collect()))


@SOME
@given(trade_lists)
def test_adding_parts_equals_whole(spark, rows):
    parts = [[r for r in rows if r[5] is flag] for flag in (True, False)]
    first, second = (minute_trade_agg(trades_df(spark, part)) for part in parts)
    whole = minute_trade_agg(trades_df(spark, rows))
    merged = upsert_add(first, second, KEYS, TRADE_MEASURES)
    columns = [*KEYS, *TRADE_MEASURES]
    assert as_set(merged.select(*columns)) == as_set(whole.select(*columns))


@SOME
@given(trade_lists)
def test_sides_add_up_and_vwap_stays_between_prices(spark, rows):
    minutes = minute_trade_agg(trades_df(spark, rows))
    assert minutes.where("buy_volume + sell_volume <> total_volume").count() == 0
    bounds = {}
    for product, _, _, price, _, _ in rows:
        low, high = bounds.get(product, (price, price))
        bounds[product] = (min(low, price), max(high, price))
    for row in cumulative_vwap(minutes).collect():
        low, high = bounds[row["product_id"]]
        assert low - 1e-9 <= row["rolling_vwap"] <= high + 1e-9


@SOME
@given(trade_lists)
def test_both_vwap_forms_agree(spark, rows):
    minutes = minute_trade_agg(trades_df(spark, rows))
    both = [
        cumulative_vwap(minutes, short_span=short).select(
            *KEYS, F.round("rolling_vwap", 6).alias("v")
        )
        for short in (True, False)
    ]
    assert as_set(both[0]) == as_set(both[1])


@SOME
@given(trade_lists, st.integers(1, 12), st.integers(0, 150))
def test_victims_are_the_oldest_and_survivors_the_rest(spark, rows, limit, age):
    df = trades_df(spark, rows)
    as_of = START + timedelta(hours=2)
    cutoff = as_of - timedelta(minutes=age)
    expired = sorted(
        (START + timedelta(seconds=r[4]), str(n))
        for n, r in enumerate(rows)
        if START + timedelta(seconds=r[4]) < cutoff
    )
    expected = {trade_id for _, trade_id in expired[:limit]}
    victims = trim_victims(df, as_of, age_minutes=age, limit=limit)
    survivors = trim_rows(df, as_of, age_minutes=age, limit=limit)
    assert {row["trade_id"] for row in victims.collect()} == expected
    everything = {str(n) for n in range(len(rows))}
    assert {row["trade_id"] for row in survivors.collect()} == everything - expected


def test_trim_without_limit(spark):
    df = trades_df(spark, [("A", "BUY", 1, 1, s, True) for s in (0, 3000, 7000)])
    victims = trim_victims(df, START + timedelta(hours=2), limit=None)
    assert {row["trade_id"] for row in victims.collect()} == {"0", "1"}


def test_vwap_null_when_no_volume(spark):
    minutes = spark.createDataFrame(
        [("A", START, 0.0, 0.0), ("A", START + timedelta(minutes=1), 10.0, 2.0)],
        "product_id STRING, trade_time_utc TIMESTAMP, notional_value DOUBLE, total_volume DOUBLE",
    )
    for short in (True, False):
        rows = cumulative_vwap(minutes, short_span=short).orderBy("trade_time_utc").collect()
        assert [row["rolling_vwap"] for row in rows] == [None, 5.0]


def test_upsert_replace_keeps_highest_order_and_one_row_per_key(spark):
    ddl = "k STRING, v DOUBLE, o BIGINT"
    target = spark.createDataFrame([("a", 1.0, 10), ("b", 2.0, 10), ("c", None, 10)], ddl)
    batch = spark.createDataFrame(
        [("a", 9.0, 9), ("b", 5.0, 11), ("b", None, 12), ("d", 7.0, 1)], ddl
    )
    got = {row["k"]: (row["v"], row["o"]) for row in upsert_replace(
        target, batch, ["k"], "o").collect()}
    assert got == {"a": (1.0, 10), "b": (None, 12), "c": (None, 10), "d": (7.0, 1)}


def test_insert_new_returns_only_unknown_keys_once(spark):
    target = spark.createDataFrame([("a",), ("b",)], "trade_id STRING")
    batch = spark.createDataFrame([("b",), ("c",), ("c",), (None,)], "trade_id STRING")
    assert [row[0] for row in insert_new(target, batch, ["trade_id"]).collect()] == ["c"]


def test_distinct_on_keeps_whole_rows(spark):
    rows = [("a", 1, "x"), ("a", 3, "z"), ("a", 2, "y"), ("b", 1, None)]
    df = spark.createDataFrame(rows, "k STRING, o INT, s STRING")
    first = distinct_on(df, ["k"], [F.col("o").desc()])
    assert sorted(map(tuple, first.collect())) == [("a", 3, "z"), ("b", 1, None)]


@pytest.mark.parametrize(
    ("hour", "stays"), [("20240101_08", False), ("20240101_09", True), ("20240101_11", True)]
)
def test_cutoff_hour_itself_is_kept(spark, hour, stays):
    df = spark.createDataFrame([(hour,)], "event_hour STRING")
    assert keep_recent_hours(df, utc("2024-01-01T10:35:00")).count() == int(stays)
