"""What the corpus operators share: word rules, bounded Arrow batches, written steps."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketstream.sources.shared import shared_dir

#: A word is a run of anything but space, tab, line feed, vertical tab, form feed and return.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes of one Arrow batch sent to Python: bounds a task's memory whatever the texts' lengths.
BATCH_BYTES = 8 << 20
_BYTES_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
_SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def small_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes, unless the session already does so."""
    if int(spark.conf.get(_BYTES_SETTING, str(2**31 - 1))) >= 2**31 - 1:
        spark.conf.set(_BYTES_SETTING, str(BATCH_BYTES))


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a step to the shared folder and read it back: lineage ends, and executors may go.

    The step's shuffle files go with its end. Spark would keep them until the driver collects garbage, which
    in jobs of many steps may not be before the disks are full.
    """
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    before = spark.conf.get(_SHUFFLES_GO, None)
    spark.conf.set(_SHUFFLES_GO, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_SHUFFLES_GO) if before is None else spark.conf.set(_SHUFFLES_GO, before)
    return spark.read.schema(df.schema).parquet(path)


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct, whatever their names."""
    return F.struct(*(F.col(f"`{c.replace('`', '``')}`") for c in df.columns))


def texts_as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null becomes empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [value or b"" for value in column.cast(kind).to_pylist()]


def words_of(text: bytes) -> list[bytes]:
    """Words of a text with A-Z lowered; ``bytes`` lowers and splits by exactly those rules."""
    return text.lower().split()


def lowered(text: Column) -> Column:
    """A-Z lowered, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id's decimal digits, modulo ``divisor``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor


def hashed_sample(df: DataFrame, key: Column, rate: float, seed: int) -> DataFrame:
    """The rows whose hashed key falls below ``rate``: the same rows on every run."""
    buckets = 1 << 30
    return df.filter(F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(buckets)) < int(rate * buckets))


def slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Batches of at most so many rows."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
