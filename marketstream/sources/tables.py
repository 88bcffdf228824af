"""Parquet tables partitioned by hour, in the session catalog.

The partition column ``event_hour`` is a text label derived from the time column, so a filter must
name it to prune; ``time_slice`` does.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime
from typing import ClassVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import hour_label, hour_of_label, moment
from ..operators.retention import hour_cutoff
from . import folders

Moment = Column | datetime | str | None


def time_slice(df: DataFrame, ts_col: str, start: Moment, end: Moment | None = None) -> DataFrame:
    """Rows with ``start <= ts < end``; also prunes hours when the table has them."""
    low = moment(start)
    condition = F.col(ts_col) >= low
    hourly = "event_hour" in df.columns
    if hourly:
        condition = condition & (F.col("event_hour") >= hour_label(low))
    if end is not None:
        high = moment(end)
        condition = condition & (F.col(ts_col) < high)
        if hourly:
            condition = condition & (F.col("event_hour") <= hour_label(high))
    return df.where(condition)


def with_hour(df: DataFrame, ts_col: str) -> DataFrame:
    return df.withColumn("event_hour", hour_label(F.col(ts_col)))


@dataclass(frozen=True)
class HourlyTable:
    """One catalog table with its time column and unique key.

    ``overwrite`` is stored as a table option: ``dynamic`` replaces only the hours that are
    written, ``static`` replaces the whole content. An hour is written by at most ``buckets`` tasks,
    dealt by key: as many files, however many rows it has. With a ``location`` the files lie there and
    outlive the catalog entry.
    """

    spark: SparkSession
    name: str
    columns: str
    ts_col: str
    keys: Sequence[str] = ()
    overwrite: str = "dynamic"
    buckets: int = 4
    location: str | None = None

    #: The partition column.
    partition: ClassVar[str] = "event_hour"

    def create(self) -> HourlyTable:
        placed = f" LOCATION '{self.location}'" if self.location else ""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({self.columns}, {self.partition} STRING) "
            f"USING parquet OPTIONS (partitionOverwriteMode '{self.overwrite}') "
            f"PARTITIONED BY ({self.partition}){placed}"
        )
        return self

    def labelled(self, df: DataFrame) -> DataFrame:
        """``df`` with the partition column."""
        return with_hour(df, self.ts_col)

    def root(self) -> str:
        """The folder of the table."""
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name}")
        return described.where("col_name = 'Location'").first()["data_type"]

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def slice(self, start: Moment, end: Moment | None = None) -> DataFrame:
        return time_slice(self.read(), self.ts_col, start, end)

    def in_hours(self, hours: Iterable[str]) -> DataFrame:
        return self.read().where(F.col(self.partition).isin(sorted(hours)))

    def hours(self) -> list[str]:
        """Labels of the existing partitions; as many as there are stored hours."""
        rows = self.spark.sql(f"SHOW PARTITIONS {self.name}").collect()
        return sorted(row[0].split("=", 1)[1] for row in rows)

    def oldest_hours(self, until: Moment, limit: int) -> list[str]:
        """The oldest hours that hold ``limit`` rows, up to the hour of ``until``.

        Rows are counted from the file footers; no column is read.
        """
        counts = self.read().where(F.col(self.partition) <= hour_label(moment(until))).groupBy(self.partition).count()
        picked, rows = [], 0
        for hour, n in counts.orderBy(self.partition).collect():
            if rows >= limit:
                break
            picked.append(hour)
            rows += n
        return picked

    def append(self, df: DataFrame, by_hour: bool = True) -> None:
        """Append; ``by_hour=False`` writes the partitions of ``df`` as they are."""
        rows = self._by_hour(df) if by_hour else self._shaped(df)
        rows.write.insertInto(self.name)

    def replace(self, df: DataFrame) -> None:
        """Replace the hours that occur in ``df`` (dynamic) or everything (static)."""
        self._by_hour(df).write.insertInto(self.name, overwrite=True)

    def ensure_partitions(self, as_of: Moment = None) -> None:
        """Create the partitions of the current and the next hour."""
        now = moment(as_of)
        later = now + F.make_interval(hours=F.lit(1))
        labels = self.spark.range(1).select(hour_label(now), hour_label(later)).first()
        specs = " ".join(f"PARTITION (event_hour='{label}')" for label in labels)
        self.spark.sql(f"ALTER TABLE {self.name} ADD IF NOT EXISTS {specs}")

    def drop_hours(self, hours: Sequence[str]) -> None:
        """Drop hours with their files, so that no other catalog finds them again."""
        if hours:
            there = set(self.hours()) if self.location else ()
            places = [self.place(hour) for hour in hours if hour in there]
            specs = ", ".join(self._spec(hour) for hour in hours)
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS {specs}")
            for place in places:
                folders.delete(self.spark, place)

    def place(self, hour: str) -> str:
        """The folder of an hour."""
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name} {self._spec(hour)}")
        return described.where("col_name = 'Location'").first()["data_type"]

    def switch(self, hours: Sequence[str], folder: str) -> None:
        """Let hours be what lies in ``folder``, each in one step of the catalog.

        A reader sees the old or the new hour. The old files stay for readers that have begun.
        """
        there = set(self.hours())
        new = [f"{self._spec(h)} LOCATION '{folder}/{self.partition}={h}'" for h in hours if h not in there]
        if new:
            self.spark.sql(f"ALTER TABLE {self.name} ADD IF NOT EXISTS {' '.join(new)}")
        for h in there.intersection(hours):
            self.spark.sql(f"ALTER TABLE {self.name} {self._spec(h)} SET LOCATION '{folder}/{self.partition}={h}'")

    def _spec(self, hour: str) -> str:
        return f"PARTITION ({self.partition}='{hour}')"

    def drop_old_partitions(self, as_of: Moment = None, keep_hours: int = 1) -> list[str]:
        """Drop partitions that start before the cutoff hour; returns their labels."""
        partitions = self.spark.createDataFrame([(h,) for h in self.hours()], "label STRING")
        old = partitions.where(hour_of_label(F.col("label")) < hour_cutoff(as_of, keep_hours))
        labels = sorted(row["label"] for row in old.collect())
        self.drop_hours(labels)
        return labels

    def _shaped(self, df: DataFrame) -> DataFrame:
        return self.labelled(df).select(*self.read().columns)

    def _by_hour(self, df: DataFrame) -> DataFrame:
        """Rows laid out so that an hour is few files: one layout for batches and for streams.

        A row without time has no hour, could never be dropped again, and is refused.
        """
        rows = self._shaped(df)
        hour = F.coalesce("event_hour", F.raise_error(F.lit(f"{self.name}: row without time")))
        bucket = F.pmod(F.hash(*(self.keys or rows.columns)), F.lit(self.buckets))
        return rows.withColumn("event_hour", hour).repartition("event_hour", bucket)


@dataclass(frozen=True)
class KeyedTable(HourlyTable):
    """A table of one row per key, dealt by a hash of the key into ``buckets`` partitions.

    It takes batches like an hourly table; a bucket takes the place of an hour.
    """

    partition: ClassVar[str] = "bucket"

    def labelled(self, df: DataFrame) -> DataFrame:
        number = F.pmod(F.hash(*self.keys), F.lit(self.buckets))
        return df.withColumn("bucket", F.format_string("b%04d", number))

    def row_of(self, *key: str) -> DataFrame:
        """The row of one key; reads its bucket only."""
        wanted = self.read()
        for name, value in zip(self.keys, key, strict=True):
            wanted = wanted.where(F.col(name) == F.lit(value))
        number = F.pmod(F.hash(*(F.lit(value) for value in key)), F.lit(self.buckets))
        return wanted.where(F.col("bucket") == F.format_string("b%04d", number))

    def _by_hour(self, df: DataFrame) -> DataFrame:
        return self._shaped(df).repartition("bucket")


def drop_old_partitions(
    tables: Sequence[HourlyTable], as_of: Moment = None, keep_hours: int = 1
) -> dict[str, list[str]]:
    """Retention over several tables."""
    return {t.name: t.drop_old_partitions(as_of, keep_hours) for t in tables}


def ensure_partitions(tables: Sequence[HourlyTable], as_of: Moment = None) -> None:
    for table in tables:
        table.ensure_partitions(as_of)
