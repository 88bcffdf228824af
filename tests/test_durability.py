"""Tables under failure: trims and batches in turn, readers in between, new catalogs, files that pile up."""

import json
import subprocess
import sys
from datetime import timedelta

import pytest
import wire
from conftest import ROOT, utc
from pyspark.sql import functions as F

from marketstream.operators import cumulative_vwap, prepare_trades
from marketstream.plans import dashboards
from marketstream.schemas import TICKER_MINUTES, TableNames
from marketstream.sources.shared import shared_database, shared_dir
from marketstream.sources.tables import HourlyTable
from marketstream.streaming import sinks
from marketstream.streaming.batch_tables import BatchTable
from marketstream.streaming.carries import refresh_carries, vwap_since
from marketstream.streaming.runner import start

START = utc("2024-01-01T00:00:00")


@pytest.fixture()
def market(spark):
    return sinks.MarketTables.of(spark, TableNames(database=shared_database(spark, "durable"))).create()


def trades(spark, *placed):
    """Trades ``(id, minute)``; their messages come at the same time."""
    items = [wire.trade(trade_id=i, time=(START + timedelta(minutes=m)).strftime("%Y-%m-%dT%H:%M:%SZ")) for i, m in placed]
    return prepare_trades(wire.updates(spark, wire.message("trades", *items))).withColumn("record_ts_utc", F.col("trade_time_utc"))


def state(market):
    raw = sorted(r["trade_id"] for r in market.raw_trades.read().collect())
    return raw, market.trade_minutes.read().agg(F.sum("trade_count")).first()[0]


def fail(*_, **__):
    raise RuntimeError("lost")


def failing(monkeypatch, owner, method, call):
    with monkeypatch.context() as patch:
        patch.setattr(owner, method, fail)
        with pytest.raises(RuntimeError, match="lost"):
            call()


def test_batch_after_a_failed_trim_keeps_its_rows(spark, market, monkeypatch):
    now = START + timedelta(minutes=30)
    sinks.write_trades(trades(spark, ("old", 1), ("mid", 25)), market, "live", 0)
    failing(monkeypatch, BatchTable, "apply", lambda: sinks.trim_raw_trades(market.raw_trades, 1, now))
    sinks.write_trades(trades(spark, ("new", 26)), market, "live", 1)
    sinks.trim_raw_trades(market.raw_trades, 2, now)
    assert state(market) == (["mid", "new"], 3)
    sinks.write_trades(trades(spark, ("new", 26)), market, "live", 2)
    assert state(market) == (["mid", "new"], 3)


def test_trim_after_a_failed_batch_loses_nothing(spark, market, monkeypatch):
    now = START + timedelta(minutes=30)
    sinks.write_trades(trades(spark, ("old", 1)), market, "live", 0)
    batch = trades(spark, ("mid", 25), ("new", 26))
    failing(monkeypatch, BatchTable, "apply", lambda: sinks.write_trades(batch, market, "live", 1))
    sinks.trim_raw_trades(market.raw_trades, 1, now)
    sinks.write_trades(batch, market, "live", 1)
    assert state(market) == (["mid", "new"], 3)


def test_readers_see_an_hour_as_it_was_or_as_it_is(spark, market, monkeypatch):
    """A look between any two steps of the catalog, over hours that change, appear and stay."""
    sinks.write_trades(trades(spark, ("a", 1), ("b", 61), ("c", 121)), market, "live", 0)
    seen, sql = [], spark.sql

    def look(self, text, *args, **kwargs):
        out = sql(text, *args, **kwargs)
        if text.startswith("ALTER TABLE") and "_staged_" not in text and "market_trades_agg" in text:
            rows = spark.table(market.trade_minutes.table.name).groupBy("event_hour").agg(F.sum("trade_count")).collect()
            seen.append({hour[-2:]: n for hour, n in rows})
        return out

    monkeypatch.setattr(type(spark), "sql", look)
    sinks.write_trades(trades(spark, ("d", 2), ("e", 62), ("f", 182)), market, "live", 1)
    monkeypatch.undo()
    assert len(seen) >= 3
    for hours in seen:
        assert hours["00"] in (1, 2) and hours["01"] in (1, 2) and hours["02"] == 1 and hours.get("03", 1) == 1
    assert seen[-1] == {"00": 2, "01": 2, "02": 1, "03": 1}


def test_a_reader_that_has_begun_finds_its_files(spark, market):
    sinks.write_trades(trades(spark, ("a", 1)), market, "live", 0)
    begun = market.trade_minutes.read()
    assert begun.inputFiles()
    sinks.write_trades(trades(spark, ("b", 2)), market, "live", 1)
    assert begun.agg(F.sum("trade_count")).first()[0] in (1, 2)


def test_vacuum_deletes_what_no_hour_refers_to(spark, market):
    for n in range(4):
        sinks.write_trades(trades(spark, (f"t{n}", n)), market, "live", n)
    before = state(market)
    assert market.trade_minutes.vacuum(keep_minutes=60) == []
    assert len(market.trade_minutes.vacuum(keep_minutes=0)) == 3
    assert market.trade_minutes.vacuum(keep_minutes=0) == []
    market.vacuum(0)
    assert state(market) == before
    sinks.write_trades(trades(spark, ("t9", 1)), market, "live", 9)
    assert state(market)[1] == before[1] + 1


@pytest.mark.parametrize("fails", [False, True])
def test_closed_hours_are_compacted_to_few_files(spark, market, monkeypatch, fails):
    raw = market.raw_trades
    for n in range(6):
        sinks.write_trades(trades(spark, *((f"{n}-{i}", i) for i in range(8)), (f"{n}-x", 130)), market, "live", n)
    (hour, open_hour), before = raw.table.hours(), state(market)
    assert len(raw.table.in_hours([hour]).inputFiles()) > raw.table.buckets
    at = START + timedelta(hours=2, minutes=20)
    if fails:
        failing(monkeypatch, BatchTable, "apply", lambda: raw.compact(1, at))
        sinks.write_trades(trades(spark, ("late", 3)), market, "live", 6)
        before = (sorted([*before[0], "late"]), before[1] + 1)
    else:
        open_files = raw.table.in_hours([open_hour]).inputFiles()
        assert raw.compact(1, at) == [hour]
        assert raw.table.in_hours([open_hour]).inputFiles() == open_files
    assert raw.compact(1, at) == []
    assert state(market) == before
    assert len(raw.table.in_hours([hour]).inputFiles()) <= raw.table.buckets + (4 if fails else 0)


OTHER_SESSION = """
import sys
from pyspark.sql import SparkSession, functions as F
from marketstream.schemas import TableNames
from marketstream.streaming import sinks
folder, warehouse = sys.argv[1:]
spark = (SparkSession.builder.master("local[2]").config("spark.sql.warehouse.dir", warehouse)
         .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").getOrCreate())
spark.sql("CREATE DATABASE market")
tables = sinks.MarketTables.of(spark, TableNames(), folder).create()
tables.recover()
raw = sorted(r[0] for r in tables.raw_trades.read().select("trade_id").collect())
print("FOUND", ",".join(raw), tables.trade_minutes.read().agg(F.sum("trade_count")).first()[0],
      tables.trade_minutes.table.hours(), tables.trade_minutes.pending())
"""


def test_another_session_finishes_a_staged_batch(spark, monkeypatch):
    folder = shared_dir(spark, "market")
    market = sinks.MarketTables.of(spark, TableNames(database=shared_database(spark, "durable")), folder).create()
    for n in range(3):
        sinks.write_trades(trades(spark, (f"t{n}", n), (f"u{n}", 60 * n)), market, "live", n)
    market.prune_ledgers()
    market.trade_minutes.table.drop_hours(["20240101_02"])
    batch = trades(spark, ("late", 1), ("new", 200))
    failing(monkeypatch, BatchTable, "apply", lambda: sinks.write_trades(batch, market, "live", 3))
    said = subprocess.run(
        [sys.executable, "-c", OTHER_SESSION, folder, shared_dir(spark, "warehouse").removeprefix("file:")],
        cwd=ROOT, capture_output=True, text=True, timeout=600,
    )
    assert said.returncode == 0, said.stderr[-2000:]
    (found,) = (x for x in said.stdout.splitlines() if x.startswith("FOUND"))
    assert found == "FOUND late,new,t0,t1,t2,u0,u1,u2 7 ['20240101_00', '20240101_01', '20240101_03'] []"


def ticker_rows(spark, *values):
    rows = [("A", START + timedelta(minutes=m), *[float(v)] * 9, offset) for m, v, offset in values]
    return spark.createDataFrame(rows, TICKER_MINUTES)


def test_newest_rows_are_read_without_the_hours(spark, market):
    write = lambda rows, n: sinks.write_snapshots(rows, market.ticker_minutes, market.ticker_newest, "live", n)
    write(ticker_rows(spark, (1, 10, 5), (70, 20, 50)), 0)
    write(ticker_rows(spark, (70, 30, 60)), 1)
    write(ticker_rows(spark, (70, 40, 55), (2, 50, 9)), 2)  # a replay of older rows
    write(ticker_rows(spark, (70, 40, 55), (2, 50, 9)), 2)
    table = market.ticker_newest.table
    price = dashboards.current_price(market.ticker_newest.read())
    assert [tuple(r) for r in price.collect()] == [("A", 30.0)]
    full = dashboards.current_price(market.ticker_minutes.read())
    assert price.collect() == full.collect()
    one = dashboards.current_price(table.row_of("A"), "A")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert one.first()["price"] == 30.0 and table.row_of("B").count() == 0
    assert "bucket#" in plan.split("PartitionFilters:")[1].split("PushedFilters:")[0]
    assert all("ticker_newest" in file for file in one.inputFiles()) and len(one.inputFiles()) == 1


def test_dead_letters_are_set_aside_once_whenever_the_retry_comes(spark, market):
    rows = [
        (b"A", b"{not json", 7), (b"A", None, 8), (None, b" ", 9),
        (b"A", json.dumps(wire.message("tickers", wire.ticker())).replace("2024", "x").encode(), 10),
        (b"A", json.dumps(wire.message("trades", wire.trade(trade_id="1"), wire.trade(trade_id="2", size="x"))).encode(), 11),
    ]
    kafka = spark.createDataFrame(
        [(k, v, "market.x", 0, o, START) for k, v, o in rows],
        "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP",
    )
    write = sinks.feed_writer(market, "live")
    write(kafka, 0)
    write(kafka, 0)
    found = {(r.kafka_offset, r.item_pos): (r.kind, r.reason) for r in market.dead_letters.read().collect()}
    assert market.dead_letters.read().count() == len(found) == 5
    assert found[(7, 0)] == ("message", "not json")
    assert found[(8, 0)] == found[(9, 0)] == ("message", "empty")
    assert found[(10, 0)] == ("ticker", "message_ts_utc")
    assert found[(11, 1)] == ("trade", "size,trade_value")
    texts = {r.kafka_offset: r.raw_value for r in market.dead_letters.read().collect()}
    assert texts[7] == "{not json" and '"size":"x"' in texts[11].replace(" ", "")
    assert state(market) == (["1"], 1)


def test_a_time_after_its_record_is_wrong_even_in_a_replay(spark, market):
    rows = trades(spark, ("1", 0), ("2", 1), ("3", 2)).withColumn(
        "trade_time_utc", F.when(F.col("trade_id") == "2", F.lit("2024-06-01").cast("timestamp")).otherwise(F.col("trade_time_utc"))
    )
    sinks.write_trades(rows, market, "live", 0)
    assert state(market) == (["1", "3"], 2)
    assert [r["missing"] for r in market.quarantine.read().collect()] == ["future"]


def test_a_limited_trim_reads_the_oldest_hours_only(spark, market, monkeypatch):
    rows = [(f"{h}-{i}", 60 * h + i) for h in range(5) for i in range(4)]
    sinks.write_trades(trades(spark, *rows), market, "live", 0)
    raw, read = market.raw_trades, []
    in_hours = HourlyTable.in_hours

    def noted(self, hours):
        read.append(sorted(hours))
        return in_hours(self, hours)

    monkeypatch.setattr(HourlyTable, "in_hours", noted)
    sinks.trim_raw_trades(raw, 1, START + timedelta(hours=9), limit=6)
    monkeypatch.undo()
    assert read == [["20240101_00", "20240101_01"]] * 2
    assert state(market)[0] == sorted(name for name, minute in rows if minute >= 62)


def test_trigger_by_processing_time(spark, market):
    log = shared_dir(spark, "log")
    rows = trades(spark, ("1", 0), ("2", 1))
    rows.coalesce(1).write.parquet(log)
    stream = spark.readStream.schema(rows.schema).parquet(log)
    query = start(stream, lambda df, n: sinks.write_trades(df, market, "live", n), shared_dir(spark, "c"), processing_time="1 second")
    try:
        query.processAllAvailable()
        assert state(market) == (["1", "2"], 2)
        trades(spark, ("3", 2)).coalesce(1).write.mode("append").parquet(log)
        query.processAllAvailable()
        assert state(market) == (["1", "2", "3"], 3)
    finally:
        query.stop()


def vwap(df):
    return sorted((r[0], r[1], round(r[2], 9)) for r in df.collect() if r[2] is not None)


@pytest.mark.parametrize("fails", [False, True])
def test_carries_are_right_or_absent(spark, market, monkeypatch, fails):
    """Against the whole history: after late trades, without a refresh, and after one that failed."""
    minutes, carries = market.trade_minutes, market.carries

    def check(start):
        whole = cumulative_vwap(minutes.read().drop("event_hour")).where(F.col("trade_time_utc") >= F.lit(start))
        assert vwap(vwap_since(minutes.table, carries.table, start)) == vwap(whole)

    sinks.write_trades(trades(spark, *((f"a{m}", m) for m in (1, 70, 200, 290))), market, "live", 0)
    assert refresh_carries(minutes, carries) == ["20240101_00", "20240101_01", "20240101_03", "20240101_04", "20240101_05"]
    assert refresh_carries(minutes, carries) == []
    check(START + timedelta(hours=4))
    sinks.write_trades(trades(spark, ("late", 130), ("now", 295)), market, "live", 1)
    assert carries.table.hours() == ["20240101_00", "20240101_01"]
    check(START + timedelta(hours=3, minutes=10))
    if fails:
        failing(monkeypatch, BatchTable, "apply", lambda: refresh_carries(minutes, carries))
        check(START + timedelta(hours=2))
    refresh_carries(minutes, carries)
    assert carries.table.hours()[-1] == "20240101_05"
    for hours in (0, 2, 3, 4, 5):
        check(START + timedelta(hours=hours))
    sinks.write_trades(trades(spark, ("next", 301)), market, "live", 2)
    assert refresh_carries(minutes, carries) == ["20240101_06"]
    check(START + timedelta(hours=5))


def test_price_from_carries_reads_its_hours_only(spark, market):
    sinks.write_trades(trades(spark, *((f"a{h}", 60 * h) for h in range(6))), market, "live", 0)
    refresh_carries(market.trade_minutes, market.carries)
    asked = vwap_since(market.trade_minutes.table, market.carries.table, START + timedelta(hours=4, minutes=5))
    assert {f.split("event_hour=")[1][:11] for f in asked.inputFiles()} == {"20240101_04", "20240101_05"}
