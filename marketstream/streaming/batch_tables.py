"""Hourly tables that take micro-batches exactly once.

A batch is applied in three steps. (1) The new content of the touched hours is written to a side
table of that batch, in a folder of its own, and marked complete. (2) The catalog lets each hour of the
target be the hour in that folder, so a reader sees an hour as it was or as it is now; hours left empty
are dropped. (3) The batch is entered in the ledger, and the side table leaves the catalog. Rows are
written once. Folders that no hour refers to any more go with ``vacuum``.

A batch is named by its source and its id; the source of a stream holds the id of the streaming
query, so a new checkpoint starts a new numbering. A failure before (1) ends leaves the target as it
was. After it, the next batch of any source completes the staged one before it reads the target:
staged content is absolute and must not be put over later changes. Each table has one writer at a
time.

A table with a location outlives its catalog: the ledger lies beside it and also says what was staged
and which folder holds an hour, so ``create`` on the same location finds everything again.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import hour_label
from ..operators.merge import upsert_add, upsert_replace
from ..operators.retention import hour_cutoff
from ..schemas import LEDGER
from ..sources import folders
from ..sources.tables import HourlyTable, Moment

#: Ledger entries of one source in one directory; a lookup reads at most so many.
LEDGER_GROUP = 1000
#: Under this source the ledger says where hours lie, apart from batches.
PLACES = "places"
COMPACTION = "compaction"

Merge = Callable[[DataFrame, DataFrame], DataFrame]


def kept(df: DataFrame) -> DataFrame:
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def hours_in(df: DataFrame, partition: str = HourlyTable.partition) -> set[str]:
    """Hour labels of the rows; as many as there are hours in the batch."""
    return {row[0] for row in df.select(partition).distinct().collect()}


@dataclass(frozen=True)
class Staged:
    """A complete side table: the batch it belongs to and the hours that the batch touches."""

    side: HourlyTable
    source: str
    batch_id: int
    hours: tuple[str, ...]


@dataclass(frozen=True)
class BatchTable:
    """An hourly table with its side tables and its ledger.

    ``carried`` is a table of sums over all earlier hours of this one: those after a changed hour are
    dropped before the change, so that what is left is always right.
    """

    table: HourlyTable
    carried: HourlyTable | None = None

    def create(self) -> BatchTable:
        spark, place = self.table.spark, self.table.location
        self.table.create()
        if self.carried is not None:
            self.carried.create()
        placed = f" LOCATION '{place}_ledger'" if place else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.ledger_name} ({LEDGER}) USING parquet "
            f"PARTITIONED BY (source, batch_group){placed}"
        )
        if place and not spark.sql(f"SHOW PARTITIONS {self.ledger_name}").count():
            self._find_again()
        return self

    def _find_again(self) -> None:
        """Tell an empty catalog what lies at the location: ledger, hours, and batches not yet applied."""
        spark, table = self.table.spark, self.table
        for name, folder in ((self.ledger_name, f"{table.location}_ledger"), (table.name, table.location)):
            if folders.exists(spark, folder):
                spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        entries = spark.table(self.ledger_name)
        for version, hours in self._versions():
            there = [h for h in hours if folders.exists(spark, f"{version}/{table.partition}={h}")]
            table.switch(there, version)
            table.drop_hours(sorted(set(hours) - set(there)))
        done = entries.where("state = 'applied'").select("source", "batch_id").distinct()
        for row in entries.where("state = 'staged'").join(done, ["source", "batch_id"], "left_anti").collect():
            side = self.side(row["source"], row["batch_id"], row["purpose"], row["version"])
            drop(side)
            side.create()
            if folders.exists(spark, row["version"]):
                spark.sql(f"ALTER TABLE {side.name} RECOVER PARTITIONS")
            self._mark(Staged(side, row["source"], row["batch_id"], tuple(_split(row["hours"]))))

    def _versions(self) -> list[tuple[str, list[str]]]:
        """The folders that hold hours now, by the ledger; one entry per folder."""
        applied = self.table.spark.table(self.ledger_name).where("state = 'applied' and version is not null")
        each = applied.select("at_utc", "version", F.explode(F.split("hours", ",")).alias("hour")).where("hour <> ''")
        last = each.groupBy("hour").agg(F.max_by("version", "at_utc").alias("version"))
        grouped = last.groupBy("version").agg(F.sort_array(F.collect_list("hour")).alias("hours"))
        return [(row["version"], row["hours"]) for row in grouped.collect()]

    @property
    def ledger_name(self) -> str:
        return f"{self.table.name}_ledger"

    def read(self) -> DataFrame:
        return self.table.read()

    # Ledger

    def is_applied(self, source: str, batch_id: int) -> bool:
        """Reads the entries of the source and the group of the id only."""
        entries = self.table.spark.table(self.ledger_name).where(
            (F.col("source") == source)
            & (F.col("batch_group") == batch_id // LEDGER_GROUP)
            & (F.col("batch_id") == batch_id)
            & (F.col("state") == "applied")
        )
        return not entries.isEmpty()

    def record(
        self,
        source: str,
        batch_id: int,
        state: str = "applied",
        purpose: str = "staged",
        version: str | None = None,
        hours: Sequence[str] = (),
    ) -> None:
        entry = self.table.spark.range(0, 1, 1, numPartitions=1).select(
            F.lit(batch_id).cast("bigint").alias("batch_id"),
            F.current_timestamp().alias("at_utc"),
            F.lit(state).alias("state"),
            F.lit(purpose).alias("purpose"),
            F.lit(version).cast("string").alias("version"),
            F.lit(",".join(hours)).alias("hours"),
            F.lit(source).alias("source"),
            F.lit(batch_id // LEDGER_GROUP).cast("bigint").alias("batch_group"),
        )
        entry.write.insertInto(self.ledger_name)

    def prune_ledger(self, keep_groups: int = 1) -> None:
        """Drop all but the newest groups of each source: ids only rise, old ones are not retried.

        Where the hours of a table with a location lie is first entered once more, under a source of its own.
        """
        if self.table.location:
            number = int(self.table.spark.sql("SELECT unix_micros(current_timestamp())").first()[0])
            for version, hours in self._versions():
                self.record(PLACES, number, version=version, hours=hours)
        shown = self.table.spark.sql(f"SHOW PARTITIONS {self.ledger_name}")
        part = F.split(F.col("partition"), "/batch_group=")
        newest = shown.select(F.get(part, F.lit(0)).alias("source"), F.get(part, F.lit(1)).cast("bigint").alias("g"))
        for source, last in newest.groupBy("source").agg(F.max("g")).collect():
            old = newest.where((F.col("source") == source) & (F.col("g") <= last - keep_groups)).collect()
            for row in old:
                name = source.removeprefix("source=")
                self.table.spark.sql(
                    f"ALTER TABLE {self.ledger_name} DROP IF EXISTS "
                    f"PARTITION (source='{name}', batch_group={row['g']})"
                )

    # Side tables

    def side(self, source: str, batch_id: int, purpose: str, folder: str) -> HourlyTable:
        """The side table of one batch; not yet created."""
        digest = hashlib.md5(f"{batch_id}:{source}".encode()).hexdigest()[:16]
        return replace(self.table, name=f"{self.table.name}_{purpose}_{digest}", overwrite="static", location=folder)

    def _new_folder(self, purpose: str) -> str:
        return f"{self.table.root()}_{purpose}/{uuid.uuid4().hex}"

    def pending(self, purpose: str = "staged") -> list[Staged]:
        """Complete side tables; those that a failure left incomplete are dropped."""
        database, name = self.table.name.rsplit(".", 1)
        found = []
        for row in self.table.spark.sql(f"SHOW TABLES IN {database} LIKE '{name}_{purpose}_*'").collect():
            side = replace(self.table, name=f"{database}.{row['tableName']}", overwrite="static")
            stored = {r["key"]: r["value"] for r in self.table.spark.sql(f"SHOW TBLPROPERTIES {side.name}").collect()}
            if stored.get("complete") != "true":
                drop(side)
                continue
            side = replace(side, location=stored["folder"])
            found.append(Staged(side, stored["source"], int(stored["batch"]), tuple(_split(stored["hours"]))))
        return found

    def stage_rows(
        self, rows: DataFrame, hours: set[str], source: str, batch_id: int, purpose: str = "staged"
    ) -> Staged:
        """Write rows to the side table of a batch and mark it complete."""
        folder = self._new_folder(purpose)
        side = self.side(source, batch_id, purpose, folder)
        drop(side)
        side.create().replace(rows)
        staged = Staged(side, source, batch_id, tuple(sorted(hours)))
        if self.table.location:
            self.record(source, batch_id, "staged", purpose, folder, staged.hours)
        self._mark(staged)
        return staged

    def _mark(self, staged: Staged) -> None:
        stated = {"source": staged.source, "batch": str(staged.batch_id), "hours": ",".join(staged.hours)}
        stated |= {"folder": staged.side.location, "complete": "true"}
        quoted = {key: value.replace("'", "\\'") for key, value in stated.items()}
        listed = ", ".join(f"'{key}'='{value}'" for key, value in quoted.items())
        self.table.spark.sql(f"ALTER TABLE {staged.side.name} SET TBLPROPERTIES ({listed})")

    def apply(self, staged: Staged) -> None:
        """Switch to the staged hours, drop those left empty, enter the batch. May be repeated."""
        if not self.is_applied(staged.source, staged.batch_id):
            hours = staged.side.hours()
            if self.carried is not None and (hours or staged.hours):
                first = min({*hours, *staged.hours})
                self.carried.drop_hours([hour for hour in self.carried.hours() if hour > first])
            self.table.switch(hours, staged.side.location)
            self.table.drop_hours(sorted(set(staged.hours) - set(hours)))
            touched = sorted({*staged.hours, *hours})
            self.record(staged.source, staged.batch_id, version=staged.side.location, hours=touched)
        drop(staged.side)

    def vacuum(self, keep_minutes: int = 60) -> list[str]:
        """Delete the folders that no hour refers to and that are older than any reader may need them.

        Returns them. Folders of batches that are staged and not yet applied stay.
        """
        spark, root = self.table.spark, self.table.root()
        used = {staged.side.location for purpose in ("staged", "arrived") for staged in self.pending(purpose)}
        for hour in self.table.hours():
            used.add(self.table.place(hour).rsplit("/", 1)[0])
        names = {folder.rsplit("/", 1)[1] for folder in used}
        gone = []
        for purpose in ("staged", "arrived"):
            for folder in folders.older_than(spark, f"{root}_{purpose}", keep_minutes):
                if folder.rsplit("/", 1)[1] not in names:
                    folders.delete(spark, folder)
                    gone.append(folder)
        return gone

    def discard(self, staged: Staged) -> None:
        """Forget a side table that is not to be applied (any more), files included."""
        drop(staged.side)
        if self.table.location:
            self.record(staged.source, staged.batch_id, purpose="discarded")
        folders.delete(self.table.spark, staged.side.location)

    def compact(self, run_id: int, as_of: Moment = None, open_hours: int = 1) -> list[str]:
        """Rewrite closed hours that have more files than ``buckets``; returns them.

        Appends leave a few files each. An hour is closed once ``open_hours`` have passed since it ended.
        Retry-safe like a batch: a run that failed is completed by whoever writes next.
        """
        self.recover()
        if self.is_applied(COMPACTION, run_id):
            return []
        closed = self.table.spark.range(1).select(hour_label(hour_cutoff(as_of, open_hours))).first()[0]
        many = [
            hour
            for hour in self.table.hours()
            if hour < closed and len(self.table.in_hours([hour]).inputFiles()) > self.table.buckets
        ]
        if many:
            rows = self.table.in_hours(many).drop(self.table.partition)
            self.apply(self.stage_rows(rows, set(many), COMPACTION, run_id))
        return many

    def recover(self) -> None:
        """Complete what a failed batch of any source has staged."""
        for staged in self.pending():
            self.apply(staged)

    # Batches

    def stage(self, rows: DataFrame, merge: Merge, source: str, batch_id: int) -> Staged | None:
        """Stage ``merge(stored rows of the touched hours, rows)``; None when there are no rows."""
        batch = kept(self.table.labelled(rows))
        try:
            hours = hours_in(batch, self.table.partition)
            if not hours:
                return None
            columns = [c for c in self.read().columns if c != self.table.partition]
            stored = self.table.in_hours(hours).select(*columns)
            return self.stage_rows(merge(stored, batch.select(*columns)), hours, source, batch_id)
        finally:
            batch.unpersist()

    def upsert(self, rows: DataFrame, merge: Merge, source: str, batch_id: int) -> None:
        """Apply a batch unless the ledger has it.

        The rows are computed even then: a stateful stream commits its state only when its whole
        output was consumed.
        """
        batch = kept(rows)
        try:
            batch.count()
            self.recover()
            if self.is_applied(source, batch_id):
                return
            staged = self.stage(batch, merge, source, batch_id)
            if staged is None:
                self.record(source, batch_id)
            else:
                self.apply(staged)
        finally:
            batch.unpersist()

    def replace_keys(self, rows: DataFrame, order_col: str, source: str, batch_id: int) -> None:
        """Upsert in which the row with the highest ``order_col`` per key stays."""
        self.upsert(rows, self.newest(order_col), source, batch_id)

    def add_measures(
        self, rows: DataFrame, measures: Sequence[str], source: str, batch_id: int
    ) -> None:
        """Upsert that adds to the stored measures."""
        self.upsert(rows, self.added(measures), source, batch_id)

    def newest(self, order_col: str) -> Merge:
        return lambda stored, rows: upsert_replace(stored, rows, self.table.keys, order_col)

    def added(self, measures: Sequence[str]) -> Merge:
        return lambda stored, rows: upsert_add(stored, rows, self.table.keys, measures)


def _split(listed: str) -> list[str]:
    return [hour for hour in listed.split(",") if hour]


def drop(table: HourlyTable) -> None:
    table.spark.sql(f"DROP TABLE IF EXISTS {table.name}")
