"""One query per operator, each over the whole ``events`` table."""

from __future__ import annotations

import contextlib
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import (
    epoch_ms,
    hour_label,
    hour_of_label,
    label_in_name,
    local_hhmm,
    minute_bucket,
    normalize_numeric,
    parse_message_ts,
    parse_trade_ts,
    ratio_or_null,
    to_double,
)
from ..operators.items import prepare_candles, prepare_tickers, prepare_trades
from ..operators.latest import distinct_on
from ..operators.merge import insert_new, upsert_add, upsert_replace
from ..operators.parse import first_update_event, parse_envelope
from ..operators.quality import RECORD_TIME, TRADE_REQUIRED, quarantine_rows, valid_rows
from ..operators.retention import TRIM_AGE_MINUTES, trim_rows, trim_victims
from ..operators.trades import dedup_trades, minute_trade_agg
from ..operators.vwap import cumulative_vwap
from ..plans import dashboards
from ..schemas import (
    PRODUCTS,
    TRADE_MEASURES,
    TRADE_MINUTES,
    TableNames,
)
from ..sources.feed import (
    filter_products,
    read_archive_stream,
    replay_projection,
    replay_range,
    route_feed,
)
from ..sources.shared import shared_database, shared_dir
from ..sources.tables import HourlyTable
from ..streaming import aggregates, audit, sinks
from ..streaming.batch_tables import kept
from ..streaming.carries import refresh_carries, vwap_since
from ..streaming.runner import LateRows, configure_streaming, drain
from . import feed as f

Query = Callable[[SparkSession, str], DataFrame]

# Fixed values of the checks: where a stored table ends and a batch begins.
STORED_UNTIL = "2024-01-01 07:00:00"
BATCH_FROM = "2024-01-01 06:00:00"
SPLIT_INSIDE_MINUTE = "2024-01-01 06:30:20"
REPLAY_FROM, REPLAY_UNTIL = "2024-01-01 01:00:00", "2024-01-01 11:00:00"
FALLBACK_TIME = "2024-01-02 00:00:00"
TRIM_LIMIT = 5000
AS_OF = "2024-01-01 06:17:00"
ONE_PRODUCT = "ETH-USD"

TRADE_COLUMNS = ("trade_id", "product_id", "side", "size", "trade_value", "trade_time_utc")
VOLUMES = ("total_volume", "buy_volume", "sell_volume", "notional_value")

_QUERIES: dict[str, Query] = {}


def _query(run: Query) -> Query:
    _QUERIES[run.__name__.removesuffix("_query")] = run
    return run


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _out(df: DataFrame, *rounded: str) -> DataFrame:
    """Zone-less timestamps, and sums at four decimals so the order of addition does not show."""
    stamps = {
        name: F.col(name).cast("timestamp_ntz") for name, kind in df.dtypes if kind == "timestamp"
    }
    return df.withColumns({**stamps, **{name: F.round(name, 4) for name in rounded}})


def _since(df: DataFrame, start: str) -> DataFrame:
    return df.where(F.col("ts") >= F.lit(start).cast("timestamp"))


def _until(df: DataFrame, end: str) -> DataFrame:
    return df.where(F.col("ts") < F.lit(end).cast("timestamp"))


def _updates(feed_df: DataFrame, *channels: str, malformed: bool = False) -> DataFrame:
    """The feed packed to messages and parsed back to update events."""
    wire = f.wire_rows(feed_df, channels, malformed) if channels else f.wire_rows(feed_df)
    return first_update_event(parse_envelope(wire))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages to dashboard: parse, flatten, dedup, minute totals, price against VWAP."""
    feed_df = f.feed(spark, sf_dir)
    trades = prepare_trades(_updates(f.wire_source(spark, sf_dir), "market_trades"))
    minutes = minute_trade_agg(dedup_trades(valid_rows(trades, TRADE_REQUIRED)))
    chart = dashboards.rolling_vwap_and_price(
        f.ticker_minutes(feed_df), minutes, as_of=f.newest_time(feed_df)
    )
    return _out(chart, "rolling_vwap")


# Sources, sinks, table maintenance


@_query
def feed_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure_streaming(spark)
    out = shared_dir(spark, "feed_source")
    wire = f.wire_rows(f.feed_stream(spark, sf_dir))
    write = sinks.archive_writer(f"{out}/counts")
    drain(
        wire,
        lambda df, batch_id: write(df.groupBy("topic").agg(F.count("*").alias("n")), batch_id),
        f"{out}/checkpoint",
    )
    counts = sinks.read_archive(spark, f"{out}/counts", "topic STRING, n BIGINT")
    return counts.groupBy("topic").agg(F.sum("n").alias("n_messages"))


@_query
def feed_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages themselves as the stream brings them: key, topic, place, time, and what the text says."""
    configure_streaming(spark)
    out = shared_dir(spark, "feed_contents")
    wire = replay_projection(f.wire_rows(f.feed_stream(spark, sf_dir)))
    drain(wire, sinks.archive_writer(f"{out}/rows"), f"{out}/checkpoint")
    rows = sinks.read_archive(spark, f"{out}/rows", wire.schema)
    said = F.regexp_extract("value", '"channel":"([^"]*)","timestamp":"([^"]*)","sequence_num":([0-9]+)', 0)
    rows = rows.select("key", "topic", "partition", "offset", F.col("timestamp").alias("record_time"), said.alias("said"))
    return _out(rows)


@_query
def replay_range_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = f.feed(spark, sf_dir).select(
        F.encode("product_id", "UTF-8").alias("key"),
        F.encode(F.concat_ws("|", "trade_id", "side"), "UTF-8").alias("value"),
        F.concat(F.lit("market."), "event_type").alias("topic"),
        F.length("event_type").alias("partition"),
        "offset",
        F.col("ts").alias("timestamp"),
    )
    return _out(replay_range(log, "market.purchase", REPLAY_FROM, REPLAY_UNTIL))


@_query
def route_feed_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    channel = (
        F.when(kind == "view", "")
        .when(kind == "click", '"channel":"ticker",')
        .otherwise('"channel":"Market-Trades",')
    )
    time = F.concat(
        F.lit('"timestamp":"'), F.date_format("ts", f.MICROS_FORMAT), F.lit('Z",')
    )
    message = F.concat(
        F.lit("{"),
        channel,
        F.when(kind == "error", "").otherwise(time),
        F.lit('"sequence_num":'),
        F.col("offset").cast("string"),
        F.lit("}"),
    )
    raw = f.feed(spark, sf_dir).select("product_id", message.alias("message"))
    routed = route_feed(raw, "market", F.lit(FALLBACK_TIME).cast("timestamp"))
    return _out(routed.withColumnRenamed("timestamp", "record_time"))


@_query
def enabled_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalogue = spark.createDataFrame(
        [
            ("bitcoin", "BTC-USD", True),
            ("ethereum", "ETH-USD", True),
            ("chainlink", "LINK-USD", False),
            ("solana", "SOL-USD", True),
        ],
        PRODUCTS,
    )
    kept = filter_products(f.feed(spark, sf_dir), catalogue)
    return _out(
        kept.groupBy("product_id").agg(F.count("*").alias("n"), F.sum("size").alias("volume")),
        "volume",
    )


@_query
def insert_new_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed_df = f.feed(spark, sf_dir)
    stored = f.as_trades(_until(feed_df, STORED_UNTIL))
    later = f.as_trades(_since(feed_df, BATCH_FROM))
    resent = f.as_trades(_since(feed_df, BATCH_FROM).where("event_type = 'purchase'"))
    fresh = insert_new(stored, later.unionByName(resent), ["trade_id"])
    return _out(fresh.select(*TRADE_COLUMNS))


@_query
def upsert_ticker(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed_df = f.feed(spark, sf_dir)
    return _out(_upserted(feed_df, f.ticker_minutes, "ticker_ts_utc"))


@_query
def upsert_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed_df = f.feed(spark, sf_dir)
    return _out(_upserted(feed_df, f.candle_minutes, "candle_ts_utc"))


def _upserted(feed_df: DataFrame, minutes: Callable, ts_col: str) -> DataFrame:
    """Even offsets stored, odd ones merged into the same minutes, then the stored ones replayed."""
    odd = F.col("offset") % 2 == 1
    stored, batch = minutes(feed_df.where(~odd)), minutes(feed_df.where(odd))
    keys = ["product_id", ts_col]
    once = upsert_replace(stored, batch, keys, "kafka_offset")
    return upsert_replace(once, stored, keys, "kafka_offset")


@_query
def upsert_trade_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed_df = f.feed(spark, sf_dir)
    merged = upsert_add(
        f.trade_minutes(_until(feed_df, SPLIT_INSIDE_MINUTE)),
        f.trade_minutes(_since(feed_df, SPLIT_INSIDE_MINUTE)),
        ["product_id", "trade_time_utc"],
        TRADE_MEASURES,
    )
    return _out(merged, *VOLUMES)


@_query
def hourly_partition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _stored_trade_minutes(spark, sf_dir)
    return table.read().groupBy("event_hour").agg(F.count("*").alias("n"))


@_query
def retention_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _stored_trade_minutes(spark, sf_dir)
    table.drop_old_partitions(table.read().agg(F.max("trade_time_utc")).scalar())
    return table.read().groupBy("event_hour").agg(F.count("*").alias("n"))


def _stored_trade_minutes(spark: SparkSession, sf_dir: str) -> HourlyTable:
    minutes = f.trade_minutes(f.feed(spark, sf_dir))
    name = f"{shared_database(spark, 'hourly')}.trade_minutes"
    table = HourlyTable(spark, name, TRADE_MINUTES, "trade_time_utc").create()
    table.append(minutes)
    return table


@_query
def trim_victims_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed_df = f.feed(spark, sf_dir)
    return _out(trim_victims(f.as_trades(feed_df), f.newest_time(feed_df), limit=TRIM_LIMIT))


@_query
def trim_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed_df = f.feed(spark, sf_dir)
    rest = trim_rows(f.as_trades(feed_df), f.newest_time(feed_df), limit=TRIM_LIMIT)
    return _out(rest.select("trade_id", "product_id", "trade_time_utc"))


@_query
def fanout_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure_streaming(spark)
    tables = _market_tables(spark, "fanout").create()
    _run_fanout(spark, sf_dir, tables)
    stored = [tables.raw_trades.table, *tables.final_tables()]
    counts = [
        table.read().agg(F.count("*").alias("n")).select(
            F.lit(table.name.split(".")[1]).alias("table_name"), "n"
        )
        for table in stored
    ]
    return reduce(DataFrame.unionByName, counts)


@_query
def replay_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    f.use_utc(spark)
    tables = _market_tables(spark, "replay").create()
    trades = kept(prepare_trades(_updates(f.wire_source(spark, sf_dir), "market_trades")))
    sinks.write_trades(trades, tables, "live", 0)
    sinks.write_trades(trades, tables, "live", 0)  # the same batch again
    sinks.write_trades(trades, tables, "backfill", 0)  # the same trades from another source
    trades.unpersist()
    stored = tables.trade_minutes.read().drop("event_hour")
    return _out(stored, *VOLUMES)


@_query
def fanout_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the fan-out stored, table by table, over twelve batches with copies across them."""
    configure_streaming(spark)
    tables = _market_tables(spark, "fanout").create()
    _run_fanout(spark, sf_dir, tables)
    rows = [
        tables.raw_trades.read().selectExpr(
            "'trade' AS kind", "trade_id AS item", "product_id", "trade_time_utc AS ts", "size AS a", "trade_value AS b"
        ),
        tables.trade_minutes.read().selectExpr(
            "'minute' AS kind", "CAST(trade_count AS STRING) AS item", "product_id", "trade_time_utc AS ts",
            "total_volume AS a", "notional_value AS b",
        ),
        tables.ticker_minutes.read().selectExpr(
            "'ticker' AS kind", "'' AS item", "product_id", "ticker_ts_utc AS ts", "price AS a", "best_ask AS b"
        ),
        tables.candle_minutes.read().selectExpr(
            "'candle' AS kind", "'' AS item", "product_id", "candle_ts_utc AS ts", "close AS a", "avg_price AS b"
        ),
    ]
    return _out(reduce(DataFrame.unionByName, rows), "a", "b")


def _run_fanout(spark: SparkSession, sf_dir: str, tables: sinks.MarketTables) -> None:
    log = shared_dir(spark, "fanout_log")
    f.write_hours(spark, sf_dir, log, range(f.HOURS))
    updates = _updates(f.hourly_stream(spark, sf_dir, log))
    drain(updates, sinks.batch_writer(tables), shared_dir(spark, "fanout"))


@_query
def replay_new_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams with the same batch ids, and a backfill between the failure and the retry of one."""
    f.use_utc(spark)
    tables = _market_tables(spark, "replay").create()
    trades = kept(prepare_trades(_updates(f.wire_source(spark, sf_dir), "market_trades")))
    third = F.pmod(F.crc32("trade_id"), F.lit(3))
    parts = [trades.where(third == n) for n in range(3)]
    sinks.write_trades(parts[0], tables, "live@first", 0)
    _fail_before_apply(parts[1], tables, "live@second", 0)
    sinks.write_trades(parts[2].unionByName(parts[1]), tables, "backfill", 0)
    sinks.write_trades(parts[1], tables, "live@second", 0)
    trades.unpersist()
    return _out(tables.trade_minutes.read().drop("event_hour"), *VOLUMES)


class _Lost(RuntimeError):
    """A failure made on purpose."""


def _fail_before_apply(trades: DataFrame, tables: sinks.MarketTables, source: str, batch_id: int) -> None:
    class Failing(type(tables.trade_minutes)):
        def apply(self, staged) -> None:
            raise _Lost

    broken = replace(tables, trade_minutes=Failing(tables.trade_minutes.table))
    with contextlib.suppress(_Lost):
        sinks.write_trades(trades, broken, source, batch_id)


def _market_tables(spark: SparkSession, purpose: str) -> sinks.MarketTables:
    return sinks.MarketTables.of(spark, TableNames(database=shared_database(spark, purpose)))


@_query
def trim_after_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A trim and a batch that fail when staged, each with others in between, and copies of all that is left."""
    feed_df = f.feed(spark, sf_dir)
    now = feed_df.agg(F.max("ts")).first()[0]
    tables = _market_tables(spark, "trim").create()
    trades = kept(f.as_trades(feed_df))
    turn = F.col("trade_id").cast("bigint") % 4
    raw = tables.raw_trades

    class Failing(type(raw)):
        def apply(self, staged) -> None:
            raise _Lost

    sinks.write_trades(trades.where(turn.isin(1, 3)), tables, "live", 0)
    with contextlib.suppress(_Lost):
        sinks.trim_raw_trades(Failing(raw.table), run_id=0, as_of=now)
    sinks.write_trades(trades.where(turn == 0), tables, "live", 1)
    _fail_before_apply(trades.where(turn == 2), tables, "live", 2)
    sinks.trim_raw_trades(raw, run_id=1, as_of=now)
    sinks.write_trades(trades.where(turn == 2), tables, "live", 2)
    sinks.trim_raw_trades(raw, run_id=2, as_of=now)
    recent = F.col("trade_time_utc") >= F.lit(now) - F.make_interval(mins=F.lit(TRIM_AGE_MINUTES))
    sinks.write_trades(trades.where(recent), tables, "live", 3)
    trades.unpersist()
    kept_ids = raw.read().groupBy("product_id", minute_bucket(F.col("trade_time_utc")).alias("trade_time_utc"))
    joined = tables.trade_minutes.read().drop("event_hour").join(
        kept_ids.agg(F.count("*").alias("n_raw")), ["product_id", "trade_time_utc"], "left"
    )
    return _out(joined, *VOLUMES)


@_query
def reopened_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables in a folder, a batch that fails after staging, and a catalog that knows nothing of it."""
    feed_df = f.feed(spark, sf_dir)
    folder = shared_dir(spark, "reopened")
    trades = kept(f.as_trades(feed_df))
    third = F.pmod(F.crc32("trade_id"), F.lit(3))
    first, second = (
        sinks.MarketTables.of(spark, TableNames(database=shared_database(spark, "reopened")), folder) for _ in range(2)
    )
    first.create()
    sinks.write_trades(trades.where(third == 0), first, "live", 0)
    sinks.write_tickers(f.as_tickers(feed_df), first, "live", 0)
    _fail_before_apply(trades.where(third == 1), first, "live", 1)
    second.create().recover()
    sinks.write_trades(trades.where(third == 1), second, "live", 1)
    sinks.write_trades(trades.where(third >= 1), second, "live", 2)
    trades.unpersist()
    prices = second.ticker_minutes.read().select("product_id", F.col("ticker_ts_utc").alias("trade_time_utc"), "price")
    minutes = second.trade_minutes.read().drop("event_hour")
    return _out(minutes.join(prices, ["product_id", "trade_time_utc"], "left"), *VOLUMES)


@_query
def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged messages of all kinds, each batch twice: what is aside, one by one, and how much is stored."""
    f.use_utc(spark)
    tables = _market_tables(spark, "dead").create()
    wire = kept(f.damaged_rows(f.wire_source(spark, sf_dir)))
    write = sinks.feed_writer(tables, "live")
    for _ in range(2):
        write(wire, 0)
    wire.unpersist()
    aside = tables.dead_letters.read().select("kind", "product_id", "kafka_offset", "item_pos", "reason", F.lit(1).cast("bigint").alias("n"))
    stored = [
        table.read().groupBy("product_id").agg(F.count("*").alias("n")).select(
            F.lit(kind).alias("kind"), "product_id", F.lit(None).cast("bigint").alias("kafka_offset"),
            F.lit(None).cast("int").alias("item_pos"), F.lit("stored").alias("reason"), "n",
        )
        for kind, table in (("trade", tables.raw_trades), ("ticker", tables.ticker_minutes), ("candle", tables.candle_minutes))
    ]
    return reduce(DataFrame.unionByName, [aside, *stored])


@_query
def newest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest-value questions from the table of newest rows, after a replay of old rows."""
    tables = _market_tables(spark, "newest").create()
    feed_df = f.feed(spark, sf_dir)
    odd = F.col("offset") % 2 == 1
    for number, part in enumerate((feed_df.where(odd), feed_df.where(~odd), _until(feed_df, BATCH_FROM))):
        sinks.write_tickers(f.as_tickers(part), tables, "live", number)
        sinks.write_candles(f.as_candles(part), tables, "live", number)
    tickers, candles = tables.ticker_newest.read(), tables.candle_newest.read()
    asked = [
        dashboards.current_price(tickers), dashboards.high_24h(tickers), dashboards.low_24h(tickers),
        dashboards.price_change_24h(tickers), dashboards.volume_24h(tickers), dashboards.latest_candle(candles),
    ]
    return reduce(lambda a, b: a.join(b, "product_id"), asked)


# Projections, filters, predicates


@_query
def parse_envelope_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_envelope(f.wire_rows(f.wire_source(spark, sf_dir)))
    first = F.get("events", F.lit(0))
    return _out(
        parsed.select(
            "offset",
            "kafka_key",
            "channel",
            "sequence_num",
            "message_ts_utc",
            F.size("events").cast("bigint").alias("n_events"),
            first["type"].alias("first_type"),
        )
    )


@_query
def parse_message_ts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, ts = F.col("event_type"), F.col("ts")
    text = (
        F.when(kind == "click", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'123Z'"))
        .when(kind == "view", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
        .when(kind == "signup", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
        .when(kind == "error", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+05:30'"))
    )
    return _out(
        f.feed(spark, sf_dir).select(
            F.col("offset").alias("event_id"),
            text.alias("time_text"),
            parse_message_ts(text).alias("message_ts_utc"),
        )
    )


@_query
def first_update_event_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.col("event")
    return _updates(f.wire_source(spark, sf_dir)).select(
        "offset",
        "kafka_key",
        "channel",
        event["type"].alias("type"),
        F.size(event["trades"]).cast("bigint").alias("n_trades"),
        F.size(event["tickers"]).cast("bigint").alias("n_tickers"),
        F.size(event["candles"]).cast("bigint").alias("n_candles"),
    )


@_query
def prepare_trades_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades = prepare_trades(_updates(f.wire_source(spark, sf_dir), "market_trades"))
    return _out(trades.select(*TRADE_COLUMNS))


@_query
def prepare_tickers_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(prepare_tickers(_updates(f.wire_source(spark, sf_dir), "ticker")).drop(RECORD_TIME))


@_query
def prepare_candles_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    candles = prepare_candles(_updates(f.wire_source(spark, sf_dir), "candles"))
    return _out(candles.drop(RECORD_TIME), "range", "avg_price")


@_query
def product_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed_df = f.wire_source(spark, sf_dir)
    tickers = prepare_tickers(_updates(feed_df, "ticker"))
    candles = prepare_candles(_updates(feed_df, "candles"))
    trades = prepare_trades(_updates(feed_df, "market_trades"))
    items = tickers.selectExpr("'ticker' AS kind", "CAST(kafka_offset AS STRING) AS item", "product_id")
    items = items.unionByName(
        candles.selectExpr("'candle' AS kind", "CAST(kafka_offset AS STRING) AS item", "product_id")
    )
    return items.unionByName(trades.selectExpr("'trade' AS kind", "trade_id AS item", "product_id"))


@_query
def safe_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    text = (
        F.when(kind == "click", "x")
        .when(kind == "view", "")
        .when(kind == "error", "1e3")
        .otherwise(F.col("size").cast("string"))
    )
    return f.feed(spark, sf_dir).select(
        F.col("offset").alias("event_id"), to_double(text).alias("number")
    )


@_query
def normalize_numeric_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    present = F.col("event_type") != "view"
    rows = f.feed(spark, sf_dir).select(
        F.col("offset").alias("event_id"),
        F.when(present, F.col("price") / 7).alias("price"),
        F.when(present, F.col("size") / 7).alias("volume_24h"),
    )
    return normalize_numeric(rows, {"price": 4, "volume_24h": 8})


@_query
def minute_bucket_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    minute = minute_bucket(F.col("ts")).alias("minute_start")
    return _out(f.feed(spark, sf_dir).groupBy(minute).agg(F.count("*").alias("n")))


@_query
def valid_rows_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    updates = _updates(f.wire_source(spark, sf_dir), "market_trades", malformed=True)
    return _out(valid_rows(prepare_trades(updates), TRADE_REQUIRED).select(*TRADE_COLUMNS))


@_query
def quarantine_rows_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    updates = _updates(f.wire_source(spark, sf_dir), "market_trades", malformed=True)
    bad = quarantine_rows(prepare_trades(updates), TRADE_REQUIRED)
    return _out(bad.select(*TRADE_COLUMNS, "missing"))


# Aggregations


@_query
def minute_trade_agg_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(f.trade_minutes(f.feed(spark, sf_dir)), *VOLUMES)


@_query
def buy_sell_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    side = F.when(kind == "view", "OTHER").when(kind != "click", F.col("side"))
    trades = f.as_trades(f.feed(spark, sf_dir).withColumn("side", side))
    sides = ("total_volume", "buy_volume", "sell_volume")
    return _out(minute_trade_agg(trades).select("product_id", "trade_time_utc", *sides), *sides)


@_query
def dedup_trades_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades = prepare_trades(_updates(f.wire_source(spark, sf_dir), "market_trades"))
    return _out(dedup_trades(trades).select(*TRADE_COLUMNS))


@_query
def buy_volume_30m(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed_df = f.feed(spark, sf_dir)
    answer = dashboards.buy_volume_30m(f.trade_minutes(feed_df), as_of=f.newest_time(feed_df))
    return _out(answer, "buy_volume_30m")


@_query
def sell_volume_30m(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed_df = f.feed(spark, sf_dir)
    answer = dashboards.sell_volume_30m(f.trade_minutes(feed_df), as_of=f.newest_time(feed_df))
    return _out(answer, "sell_volume_30m")


@_query
def trade_count_30m(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed_df = f.feed(spark, sf_dir)
    return dashboards.trade_count_30m(f.trade_minutes(feed_df), as_of=f.newest_time(feed_df))


# Windows, joins, latest values


@_query
def latest_ticker_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(f.ticker_minutes(f.feed(spark, sf_dir)))


@_query
def latest_candle_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(f.candle_minutes(f.feed(spark, sf_dir)))


@_query
def distinct_on_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = f.feed(spark, sf_dir).withColumn("minute_start", minute_bucket(F.col("ts")))
    first = distinct_on(rows, ["product_id", "minute_start"], [F.col("offset").desc()])
    return _out(first.select("product_id", "minute_start", "offset", "trade_id", "side", "price"))


@_query
def rolling_vwap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(cumulative_vwap(f.trade_minutes(f.feed(spark, sf_dir))), "rolling_vwap")


@_query
def stored_vwap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cumulative price from stored carries, after a batch of late trades and one not yet carried."""
    tables = _market_tables(spark, "carries").create()
    trades = kept(f.as_trades(f.feed(spark, sf_dir)))
    turn = F.col("trade_id").cast("bigint") % 3
    for number in range(3):
        sinks.write_trades(trades.where(turn == number), tables, "live", number)
        if number < 2:
            refresh_carries(tables.trade_minutes, tables.carries)
    early = vwap_since(tables.trade_minutes.table, tables.carries.table, BATCH_FROM, STORED_UNTIL)
    refresh_carries(tables.trade_minutes, tables.carries)
    late = vwap_since(tables.trade_minutes.table, tables.carries.table, STORED_UNTIL)
    trades.unpersist()
    return _out(early.unionByName(late), "rolling_vwap")


@_query
def rolling_vwap_and_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed_df = f.feed(spark, sf_dir)
    chart = dashboards.rolling_vwap_and_price(
        f.ticker_minutes(feed_df), f.trade_minutes(feed_df), as_of=f.newest_time(feed_df)
    )
    return _out(chart, "rolling_vwap")


@_query
def current_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.current_price(f.ticker_minutes(f.feed(spark, sf_dir)))


@_query
def high_24h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.high_24h(f.ticker_minutes(f.feed(spark, sf_dir)))


@_query
def low_24h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.low_24h(f.ticker_minutes(f.feed(spark, sf_dir)))


@_query
def price_change_24h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.price_change_24h(f.ticker_minutes(f.feed(spark, sf_dir)))


@_query
def volume_24h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.volume_24h(f.ticker_minutes(f.feed(spark, sf_dir)))


@_query
def latest_candle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.latest_candle(f.candle_minutes(f.feed(spark, sf_dir)))


def _stored_snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Ticker, candle and trade minutes in hourly tables, as dashboards read them."""
    tables = _market_tables(spark, "dashboards")
    feed_df = f.feed(spark, sf_dir)
    stored = []
    for table, rows in (
        (tables.ticker_minutes.table, f.ticker_minutes(feed_df)),
        (tables.candle_minutes.table, f.candle_minutes(feed_df)),
        (tables.trade_minutes.table, f.trade_minutes(feed_df)),
    ):
        table.create().append(rows)
        stored.append(table.read())
    return tuple(stored)


@_query
def one_product_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest-value questions for one product, in the middle of the data."""
    tickers, candles, _ = _stored_snapshots(spark, sf_dir)
    at = F.lit(AS_OF).cast("timestamp")
    since = F.lit(BATCH_FROM).cast("timestamp")
    asked = (
        dashboards.current_price, dashboards.high_24h, dashboards.low_24h,
        dashboards.price_change_24h, dashboards.volume_24h,
    )
    rows = []
    for question in asked:
        answer = question(tickers, ONE_PRODUCT, as_of=at, since=since)
        rows.append(answer.select(F.lit(answer.columns[0]).alias("name"), F.col(answer.columns[0]).alias("value")))
    candle = dashboards.latest_candle(candles, ONE_PRODUCT, as_of=at, since=since)
    rows += [candle.select(F.lit(c).alias("name"), F.col(c).alias("value")) for c in candle.columns]
    return reduce(DataFrame.unionByName, rows)


@_query
def one_product_30m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The half-hour sums for one product, in the middle of the data."""
    _, _, minutes = _stored_snapshots(spark, sf_dir)
    at = F.lit(AS_OF).cast("timestamp")
    rows = []
    for question in (dashboards.buy_volume_30m, dashboards.sell_volume_30m, dashboards.trade_count_30m):
        answer = question(minutes, ONE_PRODUCT, as_of=at)
        value = F.round(F.col(answer.columns[0]).cast("double"), 4)
        rows.append(answer.select(F.lit(answer.columns[0]).alias("name"), value.alias("value")))
    return reduce(DataFrame.unionByName, rows)


@_query
def one_product_chart(spark: SparkSession, sf_dir: str) -> DataFrame:
    tickers, _, minutes = _stored_snapshots(spark, sf_dir)
    at = F.lit(AS_OF).cast("timestamp")
    return _out(dashboards.rolling_vwap_and_price(tickers, minutes, ONE_PRODUCT, at), "rolling_vwap")


# Scalar functions


@_query
def scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts")
    iso = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    label = hour_label(ts)
    table_name = F.concat(F.lit("trade_minutes_"), label)
    shown_name = F.when(F.col("event_type") == "view", "trade_minutes").otherwise(table_name)
    return _out(
        f.feed(spark, sf_dir).select(
            F.col("offset").alias("event_id"),
            F.date_trunc("hour", ts).alias("hour_start"),
            minute_bucket(ts).alias("minute_start"),
            parse_trade_ts(iso).alias("parsed"),
            local_hhmm(ts, dashboards.ZONE).alias("time_ist"),
            (ts - F.make_interval(mins=F.lit(30))).alias("half_hour_before"),
            label.alias("hour_label"),
            label_in_name(shown_name).alias("label_in_name"),
            hour_of_label(label).alias("hour_of_label"),
            ratio_or_null(F.col("price"), F.col("price") - 150).alias("ratio"),
            epoch_ms(iso).alias("epoch_ms"),
            F.concat(F.lit("market."), F.lower(F.replace("product_id", F.lit("-"), F.lit("_"))))
            .alias("topic"),
        ),
        "ratio",
    )


# Streaming: the feed in order of time, one hour per trigger, with copies across triggers


def _item_stream(spark: SparkSession, sf_dir: str, log: str, channel: str, malformed: bool = False) -> DataFrame:
    return _updates(f.hourly_stream(spark, sf_dir, log), channel, malformed=malformed)


def _whole_log(spark: SparkSession, sf_dir: str, purpose: str) -> str:
    log = shared_dir(spark, f"{purpose}_log")
    f.write_hours(spark, sf_dir, log, range(f.HOURS))
    return log


@_query
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure_streaming(spark)
    out, log = shared_dir(spark, "stream_dedup"), _whole_log(spark, sf_dir, "stream_dedup")
    trades = prepare_trades(_item_stream(spark, sf_dir, log, "market_trades"))
    trades = aggregates.stream_dedup(trades).select(*TRADE_COLUMNS)
    drain(trades, sinks.archive_writer(f"{out}/trades"), f"{out}/checkpoint")
    return _out(sinks.read_archive(spark, f"{out}/trades", trades.schema))


def _minute_totals(spark: SparkSession, sf_dir: str, log: str, malformed: bool = False) -> DataFrame:
    trades = prepare_trades(_item_stream(spark, sf_dir, log, "market_trades", malformed))
    return aggregates.stream_minute_agg(trades)


@_query
def stream_minute_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_minute_stream(spark, sf_dir, "stream_minute_agg", malformed=False)


@_query
def stream_minute_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Malformed rows in the feed: the totals are those of the valid ones."""
    return _run_minute_stream(spark, sf_dir, "stream_minute_valid", malformed=True)


def _run_minute_stream(spark: SparkSession, sf_dir: str, purpose: str, malformed: bool) -> DataFrame:
    configure_streaming(spark)
    minutes = _market_tables(spark, purpose).trade_minutes.create()
    totals = _minute_totals(spark, sf_dir, _whole_log(spark, sf_dir, purpose), malformed)
    drain(totals, sinks.running_totals_writer(minutes), shared_dir(spark, purpose), "update")
    return _out(minutes.read().drop("event_hour"), *VOLUMES)


@_query
def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure_streaming(spark)
    out, log = shared_dir(spark, "stream_quarantine"), shared_dir(spark, "stream_quarantine_log")
    f.feed(spark, sf_dir).write.parquet(log)
    trades = prepare_trades(_item_stream(spark, sf_dir, log, "market_trades", malformed=True))
    bad = quarantine_rows(trades, TRADE_REQUIRED, "trade_time_utc").select(*TRADE_COLUMNS, "missing")
    drain(bad, sinks.archive_writer(f"{out}/bad"), f"{out}/checkpoint")
    return _out(sinks.read_archive(spark, f"{out}/bad", bad.schema))


@_query
def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the hours, a failure after a batch was written, then the others."""
    configure_streaming(spark)
    minutes = _market_tables(spark, "stream_restart").trade_minutes.create()
    checkpoint, log = shared_dir(spark, "stream_restart"), shared_dir(spark, "stream_restart_log")
    write, half = sinks.running_totals_writer(minutes), f.HOURS // 2

    def write_and_fail(df: DataFrame, batch_id: int) -> None:
        write(df, batch_id)
        raise _Lost

    f.write_hours(spark, sf_dir, log, range(half))
    drain(_minute_totals(spark, sf_dir, log), write, checkpoint, "update")
    f.write_hours(spark, sf_dir, log, range(half, f.HOURS))
    with contextlib.suppress(StreamingQueryException):
        drain(_minute_totals(spark, sf_dir, log), write_and_fail, checkpoint, "update")
    drain(_minute_totals(spark, sf_dir, log), write, checkpoint, "update")
    return _out(minutes.read().drop("event_hour"), *VOLUMES)


@_query
def stream_latest_ticker(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure_streaming(spark)
    snapshots = _market_tables(spark, "stream_ticker").ticker_minutes.create()
    log = _whole_log(spark, sf_dir, "stream_ticker")
    newest = aggregates.stream_latest_tickers(prepare_tickers(_item_stream(spark, sf_dir, log, "ticker")))
    drain(newest, sinks.snapshot_writer(snapshots), shared_dir(spark, "stream_ticker"), "update")
    return _out(snapshots.read().drop("event_hour", "kafka_offset"))


@_query
def stream_latest_candle(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure_streaming(spark)
    snapshots = _market_tables(spark, "stream_candle").candle_minutes.create()
    log = _whole_log(spark, sf_dir, "stream_candle")
    newest = aggregates.stream_latest_candles(prepare_candles(_item_stream(spark, sf_dir, log, "candles")))
    drain(newest, sinks.snapshot_writer(snapshots), shared_dir(spark, "stream_candle"), "update")
    return _out(snapshots.read().drop("event_hour", "kafka_offset"))


@_query
def stream_wrong_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A replay in which some trades are dated long after their messages: these are aside, all others kept."""
    configure_streaming(spark)
    out, log = shared_dir(spark, "stream_wrong"), _whole_log(spark, sf_dir, "stream_wrong")
    wire = f.wire_rows(f.hourly_stream(spark, sf_dir, log), ("market_trades",), wrong_times=True)
    trades = prepare_trades(first_update_event(parse_envelope(wire)))
    kept_rows = aggregates.stream_dedup(trades).select(*TRADE_COLUMNS)
    drain(kept_rows, sinks.archive_writer(f"{out}/trades"), f"{out}/kept")
    bad = quarantine_rows(trades, TRADE_REQUIRED, "trade_time_utc").select(*TRADE_COLUMNS, "missing")
    drain(bad, sinks.archive_writer(f"{out}/bad"), f"{out}/aside")
    aside = sinks.read_archive(spark, f"{out}/bad", bad.schema).dropDuplicates(["trade_id"])
    kept_rows = sinks.read_archive(spark, f"{out}/trades", kept_rows.schema).withColumn("missing", F.lit(None).cast("string"))
    return _out(kept_rows.unionByName(aside))


@_query
def stream_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids that a drained stream still remembers, from its checkpoint."""
    configure_streaming(spark)
    out, log = shared_dir(spark, "stream_state"), _whole_log(spark, sf_dir, "stream_state")
    trades = aggregates.stream_dedup(prepare_trades(_item_stream(spark, sf_dir, log, "market_trades")))
    drain(trades, sinks.archive_writer(f"{out}/trades"), f"{out}/checkpoint")
    return _out(audit.remembered_ids(spark, f"{out}/checkpoint"))


@_query
def stream_late_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A seventh of the trades far behind the watermark, and late copies of others: totals of all, each once."""
    configure_streaming(spark)
    log = shared_dir(spark, "stream_repaired_log")
    f.write_late_hours(spark, sf_dir, log)
    tables = _market_tables(spark, "stream_repaired").create()
    trades = prepare_trades(_item_stream(spark, sf_dir, log, "market_trades"))
    drain(aggregates.stream_with_late(trades), sinks.repairing_writer(tables), shared_dir(spark, "stream_repaired"))
    return _out(tables.trade_minutes.read().drop("event_hour"), *VOLUMES)


@_query
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure_streaming(spark)
    out = shared_dir(spark, "stream_late")
    feed_df = f.feed(spark, sf_dir)
    f.as_trades(_since(feed_df, BATCH_FROM)).write.parquet(f"{out}/feed/on_time")
    archived = f.as_trades(feed_df).schema
    late, counter = 0, LateRows.watch(spark)
    for arrival in ("on_time", "late"):
        if arrival == "late":
            f.as_trades(_until(feed_df, BATCH_FROM)).write.parquet(f"{out}/feed/late")
        trades = aggregates.stream_dedup(read_archive_stream(spark, f"{out}/feed/*", archived))
        query = drain(trades, sinks.archive_writer(f"{out}/trades"), f"{out}/checkpoint")
        late += counter.of(query)
    spark.streams.removeListener(counter)
    kept = sinks.read_archive(spark, f"{out}/trades", trades.schema)
    return kept.agg(F.count("*").alias("n_kept")).withColumn("n_late", F.lit(late).cast("bigint"))
