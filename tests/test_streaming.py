"""Streams against the batch operators on the same rows, with restarts and late data."""

import random
from datetime import timedelta

import pytest
from conftest import utc
from pyspark.sql import functions as F

from marketstream.operators import dedup_trades, minute_trade_agg
from marketstream.operators.latest import latest_ticker_minutes
from marketstream.schemas import TRADE_MEASURES, TableNames
from marketstream.sources.feed import read_archive_stream
from marketstream.sources.shared import shared_database, shared_dir
from marketstream.streaming import aggregates, sinks
from marketstream.streaming.runner import LateRows, drain

START = utc("2024-01-01T00:00:00")
TRADES = (
    "trade_id STRING, product_id STRING, side STRING, size DOUBLE, trade_value DOUBLE, "
    "trade_time_utc TIMESTAMP"
)
TICKERS = (
    "kafka_offset BIGINT, message_ts_utc TIMESTAMP, last_in_message BOOLEAN, product_id STRING, "
    "price DOUBLE, best_bid DOUBLE, best_ask DOUBLE, mid_price DOUBLE, spread DOUBLE, "
    "price_pct_chg_24h DOUBLE, volume_24h DOUBLE, high_24h DOUBLE, low_24h DOUBLE"
)


def file_of_trades(spark, path, rows):
    spark.createDataFrame(rows, TRADES).coalesce(1).write.mode("append").parquet(path)


def some_trades(first_minute, n, seed, copies_of=()):
    """``n`` trades within ten minutes, a few of them twice, and copies of earlier ones."""
    pick = random.Random(seed)
    rows = []
    for i in range(n):
        at = START + timedelta(minutes=first_minute, seconds=pick.randrange(600))
        size = float(pick.randrange(1, 9))
        side = pick.choice(["BUY", "SELL"])
        rows.append((f"{seed}-{i}", pick.choice("AB"), side, size, size * 3, at))
    rows += pick.sample(rows, n // 5) + list(copies_of)
    pick.shuffle(rows)
    return rows


@pytest.fixture()
def minutes(spark):
    names = TableNames(database=shared_database(spark, "stream"))
    return sinks.MarketTables.of(spark, names).trade_minutes.create()


def totals(df):
    columns = ["product_id", "trade_time_utc", *TRADE_MEASURES]
    return sorted(map(str, df.select(*columns).collect()))


def run_minutes(spark, source, minutes, checkpoint, write=None):
    stream = read_archive_stream(spark, source, TRADES, max_files_per_trigger=1)
    return drain(
        aggregates.stream_minute_agg(stream),
        write or sinks.running_totals_writer(minutes),
        checkpoint,
        "update",
    )


def test_stream_equals_batch_over_files_copies_failures_and_restarts(spark, minutes):
    source, checkpoint = shared_dir(spark, "source"), shared_dir(spark, "checkpoint")
    earlier = []
    for n in range(3):
        rows = some_trades(10 * n, 40, seed=n, copies_of=earlier[:5])
        file_of_trades(spark, source, rows)
        earlier = rows
    sink = sinks.running_totals_writer(minutes)

    def fails_after_writing(df, batch_id):
        sink(df, batch_id)
        if batch_id == 1:
            raise RuntimeError("driver lost")

    with pytest.raises(Exception, match="driver lost"):
        run_minutes(spark, source, minutes, checkpoint, fails_after_writing)
    run_minutes(spark, source, minutes, checkpoint)
    everything = spark.read.schema(TRADES).parquet(source)
    expected = totals(minute_trade_agg(dedup_trades(everything)))
    assert totals(minutes.read()) == expected
    run_minutes(spark, source, minutes, checkpoint)
    assert totals(minutes.read()) == expected
    file_of_trades(spark, source, some_trades(30, 40, seed=9))
    run_minutes(spark, source, minutes, checkpoint)
    everything = spark.read.schema(TRADES).parquet(source)
    assert totals(minutes.read()) == totals(minute_trade_agg(dedup_trades(everything)))


def test_late_trades_are_dropped_and_counted(spark, minutes):
    source, checkpoint = shared_dir(spark, "source"), shared_dir(spark, "checkpoint")
    file_of_trades(spark, source, some_trades(120, 30, seed=1))
    late = LateRows.watch(spark)
    query = run_minutes(spark, source, minutes, checkpoint)
    assert late.of(query) == 0
    before = totals(minutes.read())
    file_of_trades(spark, source, some_trades(0, 20, seed=2))
    query = run_minutes(spark, source, minutes, checkpoint)
    assert late.of(query) == 24
    spark.streams.removeListener(late)
    assert totals(minutes.read()) == before


def test_longer_horizon_takes_late_trades(spark, minutes):
    source, checkpoint = shared_dir(spark, "source"), shared_dir(spark, "checkpoint")
    file_of_trades(spark, source, some_trades(60, 10, seed=1))
    file_of_trades(spark, source, some_trades(0, 10, seed=2))
    stream = read_archive_stream(spark, source, TRADES, max_files_per_trigger=1)
    late = LateRows.watch(spark)
    query = drain(
        aggregates.stream_minute_agg(stream, horizon="3 hours"),
        sinks.running_totals_writer(minutes),
        checkpoint,
        "update",
    )
    everything = spark.read.schema(TRADES).parquet(source)
    assert late.of(query) == 0
    spark.streams.removeListener(late)
    assert totals(minutes.read()) == totals(minute_trade_agg(dedup_trades(everything)))


def test_latest_ticker_stream_equals_batch_in_any_file_order(spark):
    source, checkpoint = shared_dir(spark, "source"), shared_dir(spark, "checkpoint")
    names = TableNames(database=shared_database(spark, "stream"))
    snapshots = sinks.MarketTables.of(spark, names).ticker_minutes.create()
    rows = [
        (n, START + timedelta(seconds=7 * n), n % 4 != 3, "AB"[n % 2], *[float(n)] * 9)
        for n in range(60)
    ]
    for part in (rows[20:40], rows[:20], rows[40:]):
        spark.createDataFrame(part, TICKERS).coalesce(1).write.mode("append").parquet(source)
    stream = read_archive_stream(spark, source, TICKERS, max_files_per_trigger=1)
    drain(
        aggregates.stream_latest_tickers(stream),
        sinks.snapshot_writer(snapshots),
        checkpoint,
        "update",
    )
    expected = latest_ticker_minutes(spark.read.schema(TICKERS).parquet(source))
    got = snapshots.read().select(*expected.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))


def test_malformed_and_future_trades_neither_count_nor_move_the_watermark(spark, minutes):
    source, checkpoint = shared_dir(spark, "source"), shared_dir(spark, "checkpoint")
    good = some_trades(0, 20, seed=1)
    bad = [("bad", "A", "BUY", None, None, START), (None, "A", "BUY", 1.0, 1.0, START)]
    bad.append(("far", "A", "BUY", 1.0, 1.0, utc("2199-01-01T00:00:00")))
    file_of_trades(spark, source, good[:10] + bad)
    file_of_trades(spark, source, good[10:])
    run_minutes(spark, source, minutes, checkpoint)
    assert totals(minutes.read()) == totals(minute_trade_agg(dedup_trades(spark.createDataFrame(good, TRADES))))


def test_stream_dedup_within_and_across_batches(spark):
    source, checkpoint = shared_dir(spark, "source"), shared_dir(spark, "checkpoint")
    out = shared_dir(spark, "out")
    first = some_trades(0, 20, seed=1)
    file_of_trades(spark, source, first)
    file_of_trades(spark, source, some_trades(5, 20, seed=2, copies_of=first))
    stream = read_archive_stream(spark, source, TRADES, max_files_per_trigger=1)
    drain(aggregates.stream_dedup(stream), sinks.archive_writer(out), checkpoint)
    kept = sinks.read_archive(spark, out, TRADES)
    assert kept.count() == kept.select("trade_id").distinct().count() == 40
    assert kept.agg(F.max("trade_time_utc")).first()[0] is not None
