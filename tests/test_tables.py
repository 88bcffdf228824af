"""Hourly tables, batch tables under retry, and plans."""

from datetime import timedelta

import pytest
import wire
from conftest import utc
from pyspark.sql import functions as F

from marketstream.operators import prepare_trades
from marketstream.schemas import CANDLE_MINUTES, TRADE_MEASURES, TRADE_MINUTES, TableNames
from marketstream.sources.shared import shared_database, shared_dir
from marketstream.sources.tables import HourlyTable, drop_old_partitions, ensure_partitions
from marketstream.streaming import sinks
from marketstream.streaming.batch_tables import BatchTable

ROWS = "id BIGINT, ts TIMESTAMP, v DOUBLE"
START = utc("2024-01-01T00:00:00")


def rows(spark, *values):
    data = [(i, START + timedelta(minutes=m), float(v)) for i, m, v in values]
    return spark.createDataFrame(data, ROWS)


@pytest.fixture()
def table(spark):
    name = f"{shared_database(spark, 'test')}.t"
    return HourlyTable(spark, name, ROWS, "ts", ("id", "ts")).create()


def content(df):
    return sorted((row["id"], row["v"]) for row in df.collect())


def test_append_creates_hours_and_replace_touches_only_its_hours(spark, table):
    table.append(rows(spark, (1, 0, 1), (2, 70, 2), (3, 80, 3)))
    assert table.hours() == ["20240101_00", "20240101_01"]
    table.replace(rows(spark, (2, 70, 9)))
    assert content(table.read()) == [(1, 1.0), (2, 9.0)]


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_an_hour_is_as_many_files_as_buckets(spark, table, adaptive):
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", "UTC")
    session.conf.set("spark.sql.adaptive.enabled", adaptive)
    many = session.range(0, 600, 1, numPartitions=12).select(
        "id", F.timestamp_seconds(1704067200 + F.col("id") % 120 * 60).alias("ts"), F.lit(1.0).alias("v")
    )
    table.append(many)
    assert table.read().count() == 600
    assert len(table.read().inputFiles()) <= 2 * table.buckets
    hour = table.read().where("event_hour = '20240101_00'")
    if adaptive == "false":  # else small partitions are put together
        assert len(hour.inputFiles()) > 1


def test_row_without_time_is_refused(spark, table):
    with pytest.raises(Exception, match="row without time"):
        table.append(spark.createDataFrame([(1, None, 1.0)], ROWS))


def test_slice_reads_only_its_hours_and_columns(spark, table):
    table.append(rows(spark, (1, 0, 1), (2, 70, 2), (3, 130, 3), (4, 190, 4)))
    part = table.slice(START + timedelta(minutes=70), START + timedelta(minutes=130))
    assert content(part) == [(2, 2.0)]
    plan = part.select("id")._jdf.queryExecution().executedPlan().toString()
    assert "event_hour#" in plan.split("PartitionFilters:")[1].split("PushedFilters:")[0]
    assert "GreaterThanOrEqual(ts" in plan
    assert "ReadSchema: struct<id:bigint,ts:timestamp>" in plan


def test_slice_on_the_hour_boundary(spark, table):
    table.append(rows(spark, (1, 59, 1), (2, 60, 2), (3, 120, 3)))
    part = table.slice(START + timedelta(minutes=60), START + timedelta(minutes=120))
    assert content(part) == [(2, 2.0)]


def test_ensure_and_drop_partitions(spark, table):
    now = utc("2024-01-01T10:35:00")
    table.append(rows(spark, (1, 8 * 60, 1), (2, 9 * 60, 2), (3, 10 * 60, 3)))
    ensure_partitions([table], now)
    ensure_partitions([table], now)
    assert table.hours()[-2:] == ["20240101_10", "20240101_11"]
    assert drop_old_partitions([table], now) == {table.name: ["20240101_08"]}
    assert content(table.read()) == [(2, 2.0), (3, 3.0)]


@pytest.fixture()
def totals(spark):
    name = f"{shared_database(spark, 'test')}.totals"
    keys = ("product_id", "trade_time_utc")
    return BatchTable(HourlyTable(spark, name, TRADE_MINUTES, "trade_time_utc", keys)).create()


def minute(spark, *values):
    data = [("A", START + timedelta(minutes=m), n, 1.0 * n, 1.0 * n, 0.0, 2.0 * n) for m, n in values]
    return spark.createDataFrame(data, TRADE_MINUTES)


def counts(table):
    rows = table.read().collect()
    return sorted(((r["event_hour"], r["trade_count"]) for r in rows))


def test_added_batches_count_once(spark, totals):
    totals.add_measures(minute(spark, (0, 1), (61, 2)), TRADE_MEASURES, "live", 0)
    totals.add_measures(minute(spark, (0, 10)), TRADE_MEASURES, "live", 1)
    totals.add_measures(minute(spark, (0, 10)), TRADE_MEASURES, "live", 1)
    assert counts(totals) == [("20240101_00", 11), ("20240101_01", 2)]
    totals.add_measures(minute(spark, (61, 5)), TRADE_MEASURES, "backfill", 1)
    assert counts(totals) == [("20240101_00", 11), ("20240101_01", 7)]


def test_empty_batch_changes_nothing(spark, totals):
    totals.add_measures(minute(spark, (0, 1)), TRADE_MEASURES, "live", 0)
    totals.add_measures(minute(spark, (0, 1)).limit(0), TRADE_MEASURES, "live", 1)
    assert counts(totals) == [("20240101_00", 1)]
    assert totals.is_applied("live", 1)


@pytest.mark.parametrize("broken", ["stage_rows", "apply"])
def test_retry_after_failure_counts_once(spark, totals, monkeypatch, broken):
    totals.add_measures(minute(spark, (0, 1)), TRADE_MEASURES, "live", 0)

    def fail(*_):
        raise RuntimeError("executor lost")

    with monkeypatch.context() as patch:
        patch.setattr(BatchTable, broken, fail)
        with pytest.raises(RuntimeError):
            totals.add_measures(minute(spark, (0, 10)), TRADE_MEASURES, "live", 1)
    for _ in range(2):
        totals.add_measures(minute(spark, (0, 10)), TRADE_MEASURES, "live", 1)
    assert counts(totals) == [("20240101_00", 11)]


def test_retry_after_lost_ledger_entry_counts_once(spark, totals, monkeypatch):
    def fail(*_, **__):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(BatchTable, "record", fail)
        with pytest.raises(RuntimeError):
            totals.add_measures(minute(spark, (0, 3)), TRADE_MEASURES, "live", 0)
    totals.add_measures(minute(spark, (0, 3)), TRADE_MEASURES, "live", 0)
    assert counts(totals) == [("20240101_00", 3)]


def test_old_snapshot_does_not_replace_newer(spark):
    name = f"{shared_database(spark, 'test')}.candles"
    table = BatchTable(
        HourlyTable(spark, name, CANDLE_MINUTES, "candle_ts_utc", ("product_id", "candle_ts_utc"))
    ).create()

    def candle(value, offset):
        return spark.createDataFrame([("A", START, *[float(value)] * 6, offset)], CANDLE_MINUTES)

    table.replace_keys(candle(1, 50), "kafka_offset", "live", 0)
    table.replace_keys(candle(2, 60), "kafka_offset", "live", 1)
    table.replace_keys(candle(3, 55), "kafka_offset", "replay", 0)
    assert [(r["open"], r["kafka_offset"]) for r in table.read().collect()] == [(2.0, 60)]


@pytest.fixture()
def market(spark):
    names = TableNames(database=shared_database(spark, "test"))
    return sinks.MarketTables.of(spark, names).create()


def updates(spark, *ids, offset=0):
    items = [wire.trade(trade_id=i) for i in ids]
    return wire.updates(
        spark,
        wire.message("trades", *items, wire.trade(trade_id="bad", size="x")),
        wire.message("tickers", wire.ticker()),
        wire.message("candles", wire.candle()),
        offset=offset,
    )


def state(market):
    raw = sorted(row["trade_id"] for row in market.raw_trades.read().collect())
    (total,) = market.trade_minutes.read().collect()
    return raw, total["trade_count"], market.quarantine.read().count()


def test_batch_goes_to_all_outputs_and_repeats_do_nothing(spark, market):
    write = sinks.batch_writer(market, "live")
    write(updates(spark, "1", "2"), 0)
    write(updates(spark, "1", "2"), 0)
    assert state(market) == (["1", "2"], 2, 1)
    write(updates(spark, "2", "3"), 1)
    assert state(market) == (["1", "2", "3"], 3, 2)
    assert market.ticker_minutes.read().count() == 1
    assert market.candle_minutes.read().count() == 1


@pytest.mark.parametrize("owner_method", [(HourlyTable, "append"), (BatchTable, "apply")])
def test_failed_trade_batch_is_completed_by_its_retry(spark, market, monkeypatch, owner_method):
    owner, method = owner_method
    original = getattr(owner, method)
    trades = prepare_trades(updates(spark, "1", "2"))

    def fail(self, *args, **kwargs):
        name = self.name if isinstance(self, HourlyTable) else self.table.name
        if name.endswith("raw_market_trades") or owner is BatchTable:
            raise RuntimeError("executor lost")
        return original(self, *args, **kwargs)

    with monkeypatch.context() as patch:
        patch.setattr(owner, method, fail)
        with pytest.raises(RuntimeError):
            sinks.write_trades(trades, market, "live", 0)
    sinks.write_trades(trades, market, "live", 0)
    sinks.write_trades(trades, market, "live", 0)
    assert state(market) == (["1", "2"], 2, 1)


def test_error_in_one_output_is_raised(spark, market, monkeypatch):
    def fail(*_):
        raise RuntimeError("no space")

    monkeypatch.setattr(sinks, "insert_new", fail)
    with pytest.raises(RuntimeError, match="no space"):
        sinks.batch_writer(market, "live")(updates(spark, "1"), 0)


def test_trim_rewrites_touched_hours_and_drops_emptied_ones(spark, market):
    raw = market.raw_trades
    trades = spark.range(6).select(
        F.col("id").cast("string").alias("trade_id"),
        F.lit("A").alias("product_id"),
        F.lit("BUY").alias("side"),
        F.lit(1.0).alias("size"),
        F.lit(1.0).alias("trade_value"),
        F.timestamp_seconds(F.lit(int(START.timestamp())) + F.col("id") * 1800).alias(
            "trade_time_utc"
        ),
        F.current_timestamp().alias("inserted_at_utc"),
    )
    raw.table.append(trades)
    now = START + timedelta(hours=2, minutes=5)
    for _ in range(2):
        sinks.trim_raw_trades(raw, run_id=1, as_of=now, limit=3)
    assert sorted(r["trade_id"] for r in raw.read().collect()) == ["3", "4", "5"]
    assert raw.table.hours() == ["20240101_01", "20240101_02"]
    sinks.trim_raw_trades(raw, run_id=2, as_of=now)
    assert sorted(r["trade_id"] for r in raw.read().collect()) == ["4", "5"]
    assert raw.table.hours() == ["20240101_02"]


def test_shared_dir_follows_the_setting(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    first, second = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert first != second
    if root:
        assert first.startswith(root.rstrip("/"))


def test_retention_over_all_tables(spark, market):
    write = sinks.batch_writer(market, "live")
    write(updates(spark, "1"), 0)
    later = START + timedelta(hours=5)
    dropped = drop_old_partitions(market.final_tables(), later)
    assert set(map(tuple, dropped.values())) == {("20240101_00",)}
    assert market.trade_minutes.read().count() == 0
    assert all(not hours for hours in drop_old_partitions(market.logs(), keep_hours=24).values())
    market.prune_ledgers()
    assert market.trade_minutes.is_applied("live", 0)


def some_trades(spark, *ids):
    return prepare_trades(wire.updates(spark, wire.message("trades", *[wire.trade(trade_id=i) for i in ids])))


def fail(*_, **__):
    raise RuntimeError("lost")


def test_new_checkpoint_numbers_its_own_batches(spark, market):
    sinks.write_trades(some_trades(spark, "1", "2"), market, "first", 0)
    sinks.write_trades(some_trades(spark, "3", "4", "5"), market, "second", 0)
    assert state(market)[:2] == (["1", "2", "3", "4", "5"], 5)


@pytest.mark.parametrize("broken", [(BatchTable, "apply"), (sinks, "recover_trades"), (BatchTable, "stage")])
def test_backfill_between_failure_and_retry(spark, market, monkeypatch, broken):
    live, backfill = some_trades(spark, "1", "2"), some_trades(spark, "2", "3")
    calls = []

    def fails_second(tables):
        calls.append(1)
        if len(calls) > 1:
            raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(*broken, fails_second if broken[0] is sinks else fail)
        with pytest.raises(RuntimeError):
            sinks.write_trades(live, market, "live", 0)
    sinks.write_trades(backfill, market, "backfill", 0)
    sinks.write_trades(live, market, "live", 0)
    assert state(market)[:2] == (["1", "2", "3"], 3)
    assert market.trade_minutes.pending() == market.raw_trades.pending(sinks.ARRIVED) == []


def test_trim_is_finished_after_a_failure(spark, market, monkeypatch):
    raw = market.raw_trades
    trades = some_trades(spark, "1", "2").withColumn("inserted_at_utc", F.current_timestamp())
    raw.table.append(trades)
    later = START + timedelta(days=1)
    with monkeypatch.context() as patch:
        patch.setattr(HourlyTable, "drop_hours", fail)
        with pytest.raises(RuntimeError):
            sinks.trim_raw_trades(raw, run_id=1, as_of=later)
    sinks.trim_raw_trades(raw, run_id=1, as_of=later)
    assert raw.table.hours() == [] and raw.read().count() == 0


def test_ledger_lookup_reads_one_group_of_one_source(spark, totals):
    for batch in (0, 999, 1000, 2500):
        totals.record("live@a", batch)
    entries = spark.table(totals.ledger_name).where("source = 'live@a' and batch_group = 1")
    plan = entries._jdf.queryExecution().executedPlan().toString()
    assert "batch_group#" in plan.split("PartitionFilters:")[1].split("PushedFilters:")[0]
    assert totals.is_applied("live@a", 1000) and not totals.is_applied("other", 1000)
    totals.prune_ledger()
    assert totals.is_applied("live@a", 2500) and not totals.is_applied("live@a", 999)


def test_batch_outside_of_a_stream_needs_a_source(spark, market):
    with pytest.raises(ValueError, match="source"):
        sinks.batch_writer(market)(updates(spark, "1"), 0)


def test_future_time_is_set_aside(spark, market):
    ahead = wire.trade(trade_id="9", time="2199-01-01T00:00:00Z")
    rows = prepare_trades(wire.updates(spark, wire.message("trades", wire.trade(trade_id="1"), ahead)))
    sinks.write_trades(rows, market, "live", 0)
    assert state(market) == (["1"], 1, 1)
    assert market.quarantine.read().first()["missing"] == "future"
