"""What a micro-batch does to the tables."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import moment
from ..operators.dead_letters import dead_items, dead_messages
from ..operators.items import ORIGIN, prepare_candles, prepare_tickers, prepare_trades
from ..operators.latest import latest_candle_minutes, latest_ticker_minutes, newest_row
from ..operators.merge import insert_new
from ..operators.parse import first_update_event, parse_envelope
from ..operators.quality import (
    CANDLE_REQUIRED,
    TICKER_REQUIRED,
    TRADE_REQUIRED,
    quarantine_rows,
    valid_rows,
)
from ..operators.retention import TRIM_AGE_MINUTES, trim_victims
from ..operators.trades import dedup_trades, minute_trade_agg
from ..schemas import (
    CANDLE_MINUTES,
    DEAD_LETTER_KEYS,
    DEAD_LETTERS,
    QUARANTINE,
    RAW_TRADES,
    TICKER_MINUTES,
    TRADE_CARRIES,
    TRADE_MEASURES,
    TRADE_MINUTES,
    TableNames,
)
from ..sources.tables import HourlyTable, KeyedTable, with_hour
from .aggregates import DEDUP_HORIZON
from .batch_tables import BatchTable, hours_in, kept

BatchWriter = Callable[[DataFrame, int], None]

ARRIVED = "arrived"
#: A copy of a trade carries the time of the trade; this allows for a corrected one.
DEDUP_MARGIN = timedelta(minutes=TRIM_AGE_MINUTES)


def source_of(batch: DataFrame, source: str | None) -> str:
    """Name of a batch's source: the id of its streaming query, after ``source`` if that is given.

    The id lives in the checkpoint, so a restarted query keeps it and a new checkpoint has another.
    Outside of a stream the source has to be given.
    """
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    named = [part for part in (source, query) if part]
    if not named:
        raise ValueError("a batch outside of a stream needs a source")
    return "@".join(named)


@dataclass(frozen=True)
class MarketTables:
    """All tables of one deployment. ``create`` makes those that are missing."""

    raw_trades: BatchTable
    trade_minutes: BatchTable
    ticker_minutes: BatchTable
    candle_minutes: BatchTable
    quarantine: HourlyTable
    dead_letters: HourlyTable
    ticker_newest: BatchTable
    candle_newest: BatchTable
    carries: BatchTable

    @classmethod
    def of(cls, spark: SparkSession, names: TableNames, folder: str | None = None) -> MarketTables:
        """With a ``folder`` the tables lie there and are found again by a session with an empty catalog."""

        def place(name: str) -> str | None:
            return f"{folder.rstrip('/')}/{name}" if folder else None

        def hourly(name: str, columns: str, ts_col: str, *keys: str) -> HourlyTable:
            return HourlyTable(spark, names.full(name), columns, ts_col, keys, location=place(name))

        def snapshots(name: str, columns: str, ts_col: str) -> BatchTable:
            return BatchTable(hourly(name, columns, ts_col, "product_id", ts_col))

        def newest(name: str, columns: str, ts_col: str) -> BatchTable:
            return BatchTable(KeyedTable(spark, names.full(name), columns, ts_col, ("product_id",), location=place(name)))

        carries = snapshots(names.carries, TRADE_CARRIES, "trade_time_utc")
        return cls(
            BatchTable(hourly(names.raw_trades, RAW_TRADES, "trade_time_utc", "trade_id")),
            BatchTable(snapshots(names.trade_minutes, TRADE_MINUTES, "trade_time_utc").table, carries.table),
            snapshots(names.ticker_minutes, TICKER_MINUTES, "ticker_ts_utc"),
            snapshots(names.candle_minutes, CANDLE_MINUTES, "candle_ts_utc"),
            hourly(names.quarantine, QUARANTINE, "quarantined_at_utc"),
            hourly(names.dead_letters, DEAD_LETTERS, "record_ts_utc", *DEAD_LETTER_KEYS),
            newest(names.ticker_newest, TICKER_MINUTES, "ticker_ts_utc"),
            newest(names.candle_newest, CANDLE_MINUTES, "candle_ts_utc"),
            carries,
        )

    def create(self) -> MarketTables:
        for table in (*self.batch_tables(), *self.logs()):
            table.create()
        return self

    def batch_tables(self) -> list[BatchTable]:
        snapshots = [self.ticker_minutes, self.candle_minutes, self.ticker_newest, self.candle_newest]
        return [self.raw_trades, self.trade_minutes, *snapshots, self.carries]

    def final_tables(self) -> list[HourlyTable]:
        return [self.trade_minutes.table, self.ticker_minutes.table, self.candle_minutes.table]

    def logs(self) -> list[HourlyTable]:
        """Also hourly, usually kept longer than the final tables."""
        return [self.quarantine, self.dead_letters]

    def prune_ledgers(self) -> None:
        for table in self.batch_tables():
            table.prune_ledger()

    def vacuum(self, keep_minutes: int = 60) -> None:
        """Delete the files of hours that have been replaced so long ago."""
        for table in self.batch_tables():
            table.vacuum(keep_minutes)

    def recover(self) -> None:
        """Complete what failed batches have staged."""
        recover_trades(self)
        for table in self.batch_tables()[2:]:
            table.recover()


def write_trades(trades: DataFrame, tables: MarketTables, source: str, batch_id: int) -> None:
    """New trades to the raw table, their measures added to the minute table, bad rows aside.

    The new rows and the totals are staged before anything is stored. Whoever writes next after a
    failure first completes both, so a backfill in between neither repeats nor loses them. Only the
    raw hours of the batch, give or take the dedup horizon, are read.
    """
    minutes, raw = tables.trade_minutes, tables.raw_trades
    recover_trades(tables)
    if minutes.is_applied(source, batch_id):
        return
    incoming = kept(dedup_trades(valid_rows(trades, TRADE_REQUIRED, "trade_time_utc")))
    try:
        first, last = incoming.agg(F.min("trade_time_utc"), F.max("trade_time_utc")).first()
        _set_aside(quarantine_rows(trades, TRADE_REQUIRED, "trade_time_utc"), tables.quarantine, source, batch_id)
        if first is None:
            minutes.record(source, batch_id)
            return
        fresh = insert_new(raw.table.slice(*_around(first, last)), incoming, raw.table.keys)
        stamped = fresh.withColumn("inserted_at_utc", F.current_timestamp())
        arrived = raw.stage_rows(stamped, set(), source, batch_id, ARRIVED)
    finally:
        incoming.unpersist()
    totals = minute_trade_agg(arrived.side.read())
    if minutes.stage(totals, minutes.added(TRADE_MEASURES), source, batch_id) is None:
        minutes.record(source, batch_id)
    recover_trades(tables)


def recover_trades(tables: MarketTables) -> None:
    """Store the rows and totals that are staged; drop rows whose totals never were.

    A trim that failed is completed first: what it has staged leaves out rows that are stored later.
    """
    minutes, raw = tables.trade_minutes, tables.raw_trades
    raw.recover()
    arrived = {(a.source, a.batch_id): a for a in raw.pending(ARRIVED)}
    for staged in minutes.pending():
        rows = arrived.get((staged.source, staged.batch_id))
        if rows is not None and not minutes.is_applied(staged.source, staged.batch_id):
            new = rows.side.read().drop("event_hour")
            first, last = new.agg(F.min("trade_time_utc"), F.max("trade_time_utc")).first()
            raw.table.append(insert_new(raw.table.slice(*_around(first, last)), new, raw.table.keys))
        minutes.apply(staged)
    for rows in arrived.values():
        raw.discard(rows)


def _around(first: datetime, last: datetime) -> tuple[datetime, datetime]:
    return first - DEDUP_MARGIN, last + DEDUP_MARGIN


def write_tickers(tickers: DataFrame, tables: MarketTables, source: str, batch_id: int) -> None:
    rows = latest_ticker_minutes(valid_rows(tickers, TICKER_REQUIRED, "message_ts_utc"))
    write_snapshots(rows, tables.ticker_minutes, tables.ticker_newest, source, batch_id)


def write_candles(candles: DataFrame, tables: MarketTables, source: str, batch_id: int) -> None:
    rows = latest_candle_minutes(valid_rows(candles, CANDLE_REQUIRED, "message_ts_utc"))
    write_snapshots(rows, tables.candle_minutes, tables.candle_newest, source, batch_id)


def write_snapshots(
    rows: DataFrame, minutes: BatchTable, newest: BatchTable | None, source: str, batch_id: int
) -> None:
    """Rows of a minute to the minute table, and the newest row of a product to the table of these."""
    batch = kept(rows)

    @inheritable_thread_target(batch.sparkSession)
    def write_newest() -> None:
        order = (newest.table.ts_col, "kafka_offset")

        def merge(stored: DataFrame, new: DataFrame) -> DataFrame:
            return newest_row(stored.unionByName(new), newest.table.keys, order)

        newest.upsert(newest_row(batch, newest.table.keys, order), merge, source, batch_id)

    try:
        batch.count()  # once, before two jobs ask for it: it may be the output of a stateful stream
        with ThreadPoolExecutor(1) as pool:
            beside = pool.submit(write_newest) if newest is not None else None
            minutes.replace_keys(batch, "kafka_offset", source, batch_id)
        if beside is not None:
            beside.result()
    finally:
        batch.unpersist()


def write_dead_letters(rows: DataFrame, tables: MarketTables, source: str, batch_id: int) -> None:
    """Set rows of ``dead_messages`` and ``dead_items`` aside, each once however often this is repeated.

    They lie in the hours of their records, so a retry, however late, looks there and nowhere else.
    """
    table = tables.dead_letters
    stamps = {
        "source": F.lit(source),
        "batch_id": F.lit(batch_id).cast("bigint"),
        "quarantined_at_utc": F.current_timestamp(),
        "record_ts_utc": F.coalesce("record_ts_utc", F.lit(0).cast("timestamp")),
        "topic": F.coalesce("topic", F.lit("")),
        "partition": F.coalesce("partition", F.lit(0)),
    }
    bad = kept(table.labelled(rows.withColumns(stamps)))
    try:
        hours = hours_in(bad)
        if hours:
            known = table.in_hours(hours).where((F.col("source") == source) & (F.col("batch_id") == batch_id))
            table.append(insert_new(known, bad.drop("event_hour"), table.keys))
    finally:
        bad.unpersist()


def feed_writer(tables: MarketTables, source: str | None = None) -> BatchWriter:
    """``foreachBatch`` function: Kafka rows to the three outputs, and all that is bad to the dead letters.

    Unlike ``batch_writer`` it takes the messages before they are parsed, so nothing vanishes: a row is
    stored, or superseded by a stored one, or a dead letter, or no update by the sender's own word.
    """
    write_updates = batch_writer(tables, source)

    def process_batch(kafka_df: DataFrame, batch_id: int) -> None:
        name = source_of(kafka_df, source)
        parsed = kept(parse_envelope(kafka_df, keep_bad=True))
        try:
            updates = first_update_event(parsed)
            bad = dead_messages(parsed).unionByName(dead_items(updates))
            write_dead_letters(bad, tables, name, batch_id)
            write_updates(updates, batch_id)
        finally:
            parsed.unpersist()

    return process_batch


def repairing_writer(
    tables: MarketTables, horizon: str = DEDUP_HORIZON, source: str | None = None
) -> BatchWriter:
    """``foreachBatch`` function for ``stream_with_late``: late trades are added, none is counted twice.

    Rows at or before the newest stored trade less the horizon may have been dropped by the stream. They go
    with the others through ``write_trades``, which knows the stored ids: a late copy of a counted trade
    changes nothing while the raw table still has the trade.
    """

    def process_batch(df: DataFrame, batch_id: int) -> None:
        name = source_of(df, source)
        batch = kept(df)
        try:
            batch.count()  # a stateful stream commits its state only when its whole output was consumed
            recover_trades(tables)
            behind = F.lit(False)
            newest = newest_stored(tables.raw_trades.table)
            if newest is not None:
                behind = F.col("trade_time_utc") <= F.lit(newest) - F.expr(f"INTERVAL {horizon}")
            every = batch.where("late_candidate")
            late = valid_rows(every, TRADE_REQUIRED, "trade_time_utc").where(behind)
            bad = quarantine_rows(every, TRADE_REQUIRED, "trade_time_utc").drop("missing")
            rows = batch.where(~F.col("late_candidate")).unionByName(late).unionByName(bad)
            write_trades(rows.drop("late_candidate"), tables, name, batch_id)
        finally:
            batch.unpersist()

    return process_batch


def newest_stored(table: HourlyTable) -> datetime | None:
    """The greatest time in the table; reads the last hour that has rows."""
    for hour in reversed(table.hours()):
        (newest,) = table.in_hours([hour]).agg(F.max(table.ts_col)).first()
        if newest is not None:
            return newest
    return None


def batch_writer(tables: MarketTables, source: str | None = None) -> BatchWriter:
    """``foreachBatch`` function: one parsed batch to the three outputs, parsed once.

    The outputs are written side by side and each is retry-safe by itself. Errors propagate, so
    Spark never commits the offsets of a batch that was not stored.
    """
    outputs = (
        (prepare_trades, write_trades),
        (prepare_tickers, write_tickers),
        (prepare_candles, write_candles),
    )

    def process_batch(update_df: DataFrame, batch_id: int) -> None:
        name = source_of(update_df, source)
        needed = ("offset", "kafka_key", *ORIGIN, "message_ts_utc", "event")
        batch = kept(update_df.select(*(c for c in needed if c in update_df.columns)))

        @inheritable_thread_target(batch.sparkSession)
        def write(prepare, store) -> None:
            store(prepare(batch), tables, name, batch_id)

        try:
            with ThreadPoolExecutor(len(outputs)) as pool:
                running = [pool.submit(write, *output) for output in outputs]
            for output in running:
                output.result()
        finally:
            batch.unpersist()

    return process_batch


def running_totals_writer(minutes: BatchTable, source: str | None = None) -> BatchWriter:
    """``foreachBatch`` function for ``stream_minute_agg``.

    The totals of a minute only grow, so the row with the most trades is the newest.
    """
    return lambda df, batch_id: minutes.replace_keys(
        df, "trade_count", source_of(df, source), batch_id
    )


def snapshot_writer(
    snapshots: BatchTable, source: str | None = None, newest: BatchTable | None = None
) -> BatchWriter:
    """``foreachBatch`` function for the latest-per-minute streams."""
    return lambda df, batch_id: write_snapshots(df, snapshots, newest, source_of(df, source), batch_id)


def archive_writer(path: str) -> BatchWriter:
    """``foreachBatch`` function that stores each batch in its own directory, new on a retry."""
    return lambda df, batch_id: df.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def read_archive(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(path).drop("batch")


def trim_raw_trades(
    raw: BatchTable,
    run_id: int,
    as_of: Column | datetime | str | None = None,
    age_minutes: int = TRIM_AGE_MINUTES,
    limit: int | None = None,
) -> None:
    """Delete expired raw trades, the oldest ``limit`` if one is given.

    With a limit only the hours that hold the oldest rows are read, by the counts of their files. Only the
    hours of the victims are rewritten; hours left without rows are dropped. A run that failed is
    completed by the next one, or repeated with the same ``run_id``.
    """
    raw.recover()
    if raw.is_applied("trim", run_id):
        return
    rows = raw.read()
    if limit is not None:
        cutoff = moment(as_of) - F.make_interval(mins=F.lit(age_minutes))
        rows = raw.table.in_hours(raw.table.oldest_hours(cutoff, limit))
    victims = trim_victims(rows, as_of, age_minutes=age_minutes, limit=limit)
    victims = kept(with_hour(victims, raw.table.ts_col))
    try:
        touched = hours_in(victims)
        survivors = raw.table.in_hours(touched).join(victims, "trade_id", "left_anti")
        staged = raw.stage_rows(survivors, touched, "trim", run_id)
    finally:
        victims.unpersist()
    raw.apply(staged)


def _set_aside(bad: DataFrame, quarantine: HourlyTable, source: str, batch_id: int) -> None:
    """Store the incomplete rows once per batch; the look for earlier ones reads two days at most."""
    of_batch = (F.col("source") == source) & (F.col("batch_id") == batch_id)
    recent = quarantine.slice(F.current_timestamp() - F.make_interval(days=F.lit(2)))
    if recent.where(of_batch).isEmpty():
        stamps = {
            "source": F.lit(source),
            "batch_id": F.lit(batch_id).cast("bigint"),
            "quarantined_at_utc": F.current_timestamp(),
        }
        quarantine.append(bad.withColumns(stamps))
