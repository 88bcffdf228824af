"""``events`` as a market feed, row by row: trades, tickers, candles and the wire messages.

Time runs at one sixtieth, so 30 days of events become 12 hours of trading. All functions take and
return batch or streaming DataFrames. What becomes messages is first dealt over the cores: a message
costs far more than the row it comes from, and a table of one row group is one task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.latest import latest_candle_minutes, latest_ticker_minutes
from ..operators.trades import minute_trade_agg
from ..schemas import CHANNELS
from ..sources import folders
from ..sources.feed import read_archive_stream
from ..streaming.runner import use_utc

# Fixed values of the mapping, the same in the SQL twins.
PRODUCTS = ("BTC-USD", "ETH-USD", "LINK-USD", "SOL-USD")
ORIGIN_MICROS = 1_704_067_200_000_000
SLOWDOWN = 60
HOURS, FILES_PER_HOUR = 12, 2
#: Stored bytes of the table, about 50,000 rows, that one task turns into messages.
DEALT_BYTES = 1 << 20
MICROS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/events.parquet")


def feed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as a file stream, in no order of time. The glob also matches a table of one file."""
    path = f"{sf_dir}/events.parque[t]"
    rows = read_archive_stream(spark, path, events(spark, sf_dir).schema)
    return market_feed(rows.repartition(_tasks(spark, sf_dir), "event_id"))


def _tasks(spark: SparkSession, sf_dir: str, batches: int = 1) -> int:
    """Tasks for each of so many batches: every core has one, and more of them as the table grows."""
    parts = -(-folders.size(spark, f"{sf_dir}/events.parquet") // (batches * DEALT_BYTES))
    return max(spark.sparkContext.defaultParallelism, parts)


def write_hours(spark: SparkSession, sf_dir: str, path: str, hours: range) -> None:
    """Hours of the feed, one after another, as a log would bring them; the last one takes the rest.

    An hour repeats what came in the five minutes before it, so copies arrive in another batch.
    """
    seconds, hour = _arrival()
    _write_in_order(wire_source(spark, sf_dir), path, hours, lambda n: (hour == n) | seconds.between(n * 3600 - 300, n * 3600 - 1))


def write_late_hours(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The feed with every seventh row three hours late, and every eleventh sent again four hours later."""
    _, hour = _arrival()
    late, again = F.col("offset") % 7 == 3, F.col("offset") % 11 == 5

    def arrives(number: int) -> Column:
        return (~late & (hour == number)) | (late & (hour == number - 3)) | (again & (hour == number - 4))

    _write_in_order(wire_source(spark, sf_dir), path, range(HOURS + 4), arrives)


def _arrival() -> tuple[Column, Column]:
    """Seconds since the start, and the hour in which a row arrives."""
    seconds = F.col("ts").cast("long") - ORIGIN_MICROS // 1_000_000
    return seconds, F.least(F.floor(seconds / 3600), F.lit(HOURS - 1))


def _write_in_order(rows: DataFrame, path: str, hours: range, arrives: Callable[[int], Column]) -> None:
    """One part after another, each in a few files; the table is read once for all of them."""
    rows = rows.persist()
    try:
        for number in hours:
            part = rows.where(arrives(number)).repartition(FILES_PER_HOUR)
            part.write.mode("append").parquet(path)
    finally:
        rows.unpersist()


def hourly_stream(spark: SparkSession, sf_dir: str, path: str) -> DataFrame:
    """Stream of what ``write_hours`` wrote: one hour per trigger, its rows dealt over the cores."""
    rows = read_archive_stream(spark, path, feed(spark, sf_dir).schema, FILES_PER_HOUR)
    return rows.repartition(_tasks(spark, sf_dir, HOURS), "offset")


def wire_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed for packing into messages, dealt over the cores."""
    return market_feed(events(spark, sf_dir).repartition(_tasks(spark, sf_dir), "event_id"))


def market_feed(events_df: DataFrame) -> DataFrame:
    """One trade per event: offset, trade_id, product_id, side, size, price, ts, event_type."""
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    slowed = F.lit(ORIGIN_MICROS) + F.call_function("div", micros - ORIGIN_MICROS, F.lit(SLOWDOWN))
    product = F.element_at(
        F.array(*[F.lit(p) for p in PRODUCTS]), (F.col("user_id") % 4 + 1).cast("int")
    )
    return events_df.select(
        F.col("event_id").alias("offset"),
        F.col("event_id").cast("string").alias("trade_id"),
        product.alias("product_id"),
        F.when(F.col("event_type").isin("purchase", "signup"), "BUY").otherwise("SELL").alias(
            "side"
        ),
        F.col("value").alias("size"),
        (F.lit(100) + F.get_json_object("props", "$.k").cast("int")).cast("double").alias("price"),
        F.timestamp_micros(slowed).alias("ts"),
        "event_type",
    )


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market_feed(events(spark, sf_dir))


def as_trades(feed_df: DataFrame) -> DataFrame:
    """The feed in the shape of prepared trades."""
    return feed_df.select(
        "trade_id",
        "product_id",
        "side",
        "size",
        F.col("ts").alias("trade_time_utc"),
        (F.col("price") * F.col("size")).alias("trade_value"),
    )


def as_tickers(feed_df: DataFrame) -> DataFrame:
    """The feed in the shape of prepared tickers."""
    bid, ask = F.col("best_bid"), F.col("best_ask")
    return (
        feed_df.select(
            F.col("offset").alias("kafka_offset"),
            F.col("ts").alias("message_ts_utc"),
            "product_id",
            *[column.alias(name) for name, column in ticker_figures().items()],
        )
        .withColumns({"mid_price": (bid + ask) / 2, "spread": ask - bid})
    )


def as_candles(feed_df: DataFrame) -> DataFrame:
    """The feed in the shape of prepared candles."""
    o, h, lo, c = (F.col(name) for name in ("open", "high", "low", "close"))
    return feed_df.select(
        F.col("offset").alias("kafka_offset"),
        F.col("ts").alias("message_ts_utc"),
        "product_id",
        *[column.alias(name) for name, column in candle_figures().items()],
    ).withColumns({"range": h - lo, "avg_price": (o + h + lo + c) / 4})


def ticker_figures() -> dict[str, Column]:
    price, size = F.col("price"), F.col("size")
    return {
        "price": price,
        "best_bid": price - 0.5,
        "best_ask": price + (F.col("offset") % 5 + 1) * 0.25,
        "price_pct_chg_24h": price - 150,
        "volume_24h": size * 10,
        "high_24h": price + 5,
        "low_24h": price - 5,
    }


def candle_figures() -> dict[str, Column]:
    price, size = F.col("price"), F.col("size")
    return {"open": price, "high": price + 2, "low": price - 2, "close": price + size * 0.04}


def trade_minutes(feed_df: DataFrame) -> DataFrame:
    """Minute aggregates with sums at four decimals, so the order of addition does not show."""
    return minute_trade_agg(as_trades(feed_df))


def ticker_minutes(feed_df: DataFrame) -> DataFrame:
    return latest_ticker_minutes(as_tickers(feed_df))


def candle_minutes(feed_df: DataFrame) -> DataFrame:
    return latest_candle_minutes(as_candles(feed_df))


def newest_time(feed_df: DataFrame) -> Column:
    """The largest time of the feed as a scalar subquery: the ``as_of`` of the checks."""
    return feed_df.agg(F.max("ts")).scalar()


def wire_rows(
    feed_df: DataFrame, channels: tuple[str, ...] = CHANNELS, malformed: bool = False, wrong_times: bool = False
) -> DataFrame:
    """Kafka rows that carry the feed as JSON messages, with the oddities of a real feed.

    Every message has a second event, a decoy that must not be read. Purchases are sent twice.
    Views are followed by a snapshot message. A signup message holds its item twice; for tickers
    and candles the first of the two is stale. Error items lack their product, the key has it.
    With ``malformed``, clicks have a bad size text and views have no trade id. With ``wrong_times``, some
    trades are dated 500 days later than their messages.
    """
    kind = F.col("event_type")
    copies = (
        F.when(kind == "purchase", F.array(F.lit("update"), F.lit("update")))
        .when(kind == "view", F.array(F.lit("update"), F.lit("snapshot")))
        .otherwise(F.array(F.lit("update")))
    )
    texts = F.date_format("ts", MICROS_FORMAT).alias("time_text")
    traded = F.when(F.lit(wrong_times) & wrong_clocks(feed_df), F.col("ts") + F.make_interval(days=F.lit(500))).otherwise(F.col("ts"))
    messages = feed_df.select("*", texts, F.date_format(traded, MICROS_FORMAT).alias("trade_time_text"), F.posexplode(copies).alias("copy", "update_type")).select(
        "*", F.explode(F.array(*[F.lit(c) for c in channels])).alias("channel")
    )
    body = F.struct(
        "channel",
        F.concat("time_text", F.lit("000Z")).alias("timestamp"),
        F.col("offset").alias("sequence_num"),
        F.array(
            _event(F.col("update_type"), F.lit(0), malformed),
            _event(F.lit("update"), F.lit(1000), malformed),
        ).alias("events"),
    )
    return messages.select(
        F.encode("product_id", "UTF-8").alias("key"),
        F.encode(F.to_json(body), "UTF-8").alias("value"),
        F.concat(F.lit("market."), "channel").alias("topic"),
        F.pmod(F.crc32("product_id"), F.lit(3)).cast("int").alias("partition"),
        (F.col("offset") * 2 + F.col("copy")).alias("offset"),
        F.col("ts").alias("timestamp"),
    )


def wrong_clocks(feed_df: DataFrame) -> Column:
    """The rows of the feed whose trade time is wrong in ``wire_rows`` with ``wrong_times``."""
    return feed_df["offset"] % 97 == 5


def damaged_rows(feed_df: DataFrame) -> DataFrame:
    """``wire_rows`` with malformed trades, and of 13 messages one cut short, one empty, and one without time.

    Only tickers and candles need the time of the message.
    """
    wire = wire_rows(feed_df, malformed=True)
    text, turn = F.col("value").cast("string"), F.col("offset") % 13
    value = (
        F.when(turn == 1, F.substring(text, 1, 20))
        .when(turn == 2, F.lit(" "))
        .when(turn == 3, F.regexp_replace(text, '"timestamp":"[^"]*"', '"timestamp":"noon"'))
        .otherwise(text)
    )
    return wire.withColumn("value", F.encode(value, "UTF-8"))


def _event(update_type: Column, price_shift: Column, malformed: bool) -> Column:
    """One event: the array of the message's channel is filled, the other two are absent."""
    is_channel = {c: F.col("channel") == c for c in CHANNELS}
    trade = _trade_item(price_shift, malformed)
    return F.struct(
        update_type.alias("type"),
        F.when(is_channel["market_trades"], _items(trade, trade)).alias("trades"),
        F.when(
            is_channel["ticker"], _items(_ticker_item(price_shift), _ticker_item(F.lit(-7)))
        ).alias("tickers"),
        F.when(
            is_channel["candles"], _items(_candle_item(price_shift), _candle_item(F.lit(-7)))
        ).alias("candles"),
    )


def _items(item: Column, earlier: Column) -> Column:
    return F.when(F.col("event_type") == "signup", F.array(earlier, item)).otherwise(F.array(item))


def _item_product() -> Column:
    return F.when(F.col("event_type") != "error", F.col("product_id")).alias("product_id")


def _text(number: Column, name: str) -> Column:
    return number.cast("string").alias(name)


def _trade_item(price_shift: Column, malformed: bool) -> Column:
    size, trade_id = F.col("size").cast("string"), F.col("trade_id")
    if malformed:
        size = F.when(F.col("event_type") == "click", "x").otherwise(size)
        trade_id = F.when(F.col("event_type") != "view", trade_id)
    return F.struct(
        trade_id.alias("trade_id"),
        _item_product(),
        _text(F.col("price") + price_shift, "price"),
        size.alias("size"),
        F.col("side").alias("side"),
        F.concat("trade_time_text", F.lit("Z")).alias("time"),
    )


def _ticker_item(price_shift: Column) -> Column:
    figures = ticker_figures()
    return F.struct(
        _item_product(),
        _text(figures["price"] + price_shift, "price"),
        _text(figures["best_bid"], "best_bid"),
        _text(figures["best_ask"], "best_ask"),
        _text(figures["price_pct_chg_24h"], "price_percent_chg_24_h"),
        _text(figures["volume_24h"], "volume_24_h"),
        _text(figures["high_24h"], "high_24_h"),
        _text(figures["low_24h"], "low_24_h"),
    )


def _candle_item(price_shift: Column) -> Column:
    figures = candle_figures()
    return F.struct(
        _item_product(),
        _text(figures["open"] + price_shift, "open"),
        *[_text(figures[name], name) for name in ("high", "low", "close")],
        F.lit("0").alias("start"),
        _text(F.col("size"), "volume"),
    )
