"""Passages that repeat across documents, by sparse suffix arrays.

Only suffixes that start at a minimiser are kept: in every run of ``WINDOW`` consecutive starts the
one whose first ``PREFIX`` words hash lowest. Two documents that share ``LENGTH = PREFIX + WINDOW - 1``
words choose the same start in them, so none of their suffix pairs is missed. The kept suffixes are
sorted by their beginnings and neighbours compared; a suffix without an equal neighbour is dropped.
The others are extended to the left and right: each stands for the windows of ``LENGTH`` words that
chose it, and these are compared in full. Runs of repeated windows make the passages.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import small_batches, stored, texts_as_bytes, whole_row, words_of

PREFIX, WINDOW = 26, 25
LENGTH = PREFIX + WINDOW - 1
#: Window starts worked on at a time: bounds memory on very long texts.
BLOCK = 1 << 16
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _doc() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text"))


def word_hashes(text: bytes) -> np.ndarray:
    words = words_of(text)
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words, from sums of powers modulo 2**64."""
    if len(words) < size:
        return np.zeros(0, np.uint64)
    powers = np.full(len(words), _BASE, np.uint64)
    powers[0] = 1
    back = np.full(len(words), _INVERSE, np.uint64)
    back[0] = 1
    sums = np.append(np.uint64(0), (words * powers.cumprod(dtype=np.uint64)).cumsum(dtype=np.uint64))
    runs = (sums[size:] - sums[:-size]) * back.cumprod(dtype=np.uint64)[: len(words) - size + 1]
    runs ^= runs >> np.uint64(31)
    return runs * np.uint64(0xBF58476D1CE4E5B9)


def minimisers(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``PREFIX`` words, and for each window of ``LENGTH`` words the start it chooses."""
    keys = run_hashes(words, PREFIX)
    windows = len(keys) - WINDOW + 1
    if windows <= 0:
        return keys, np.zeros(0, np.int64)
    chosen = np.empty(windows, np.int64)
    for start in range(0, windows, BLOCK):
        part = np.lib.stride_tricks.sliding_window_view(keys[start : start + BLOCK + WINDOW - 1], WINDOW)
        chosen[start : start + len(part)] = part.argmin(axis=1) + np.arange(start, start + len(part))
    return keys, chosen


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, places, rows = [], [], []
        for row, text in enumerate(texts_as_bytes(batch.column("text"))):
            key, chosen = minimisers(word_hashes(text))
            starts = chosen[np.flatnonzero(np.diff(chosen, prepend=-1))]
            keys.append(key[starts])
            places.append(starts)
            rows.append(np.full(len(starts), row))
        if rows:
            at = pa.array(np.concatenate(rows).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys).view(np.int64)), batch.column("doc").take(at),
                 batch.column("text_hash").take(at), pa.array(np.concatenate(places).astype(np.int32))],
                ["key", "doc", "text_hash", "place"],
            )


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted suffixes, those equal to a neighbour, and the first and last of the partition.

    ``single`` marks an outer one that has no equal neighbour here; it may have one next door. The
    last row of a batch waits for the next one, with the key before it.
    """
    held: pa.RecordBatch | None = None
    before: int | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        yield from _judged(batch, before, False)
        if batch.num_rows > 1:
            before = batch.column("key")[batch.num_rows - 2].as_py()
        held = batch.slice(batch.num_rows - 1)
    if held is not None:
        yield from _judged(held, before, True)


def _judged(batch: pa.RecordBatch, before: int | None, last: bool) -> Iterator[pa.RecordBatch]:
    """All rows but the last one, or that too if none follows."""
    keys = batch.column("key").to_numpy()
    same = keys[1:] == keys[:-1]
    equal = np.append(before is not None and keys[0] == before, same) | np.append(same, False)
    outer = np.zeros(len(keys), bool)
    outer[0], due = before is None, np.ones(len(keys), bool)
    outer[-1], due[-1] = outer[-1] or last, last
    chosen = np.flatnonzero(due & (equal | outer))
    if len(chosen):
        rows = batch.take(pa.array(chosen))
        yield pa.RecordBatch.from_arrays(
            [*rows.columns, pa.array(outer[chosen]), pa.array(~equal[chosen])], [*batch.schema.names, "outer", "single"]
        )


def repeated_suffixes(docs: DataFrame) -> DataFrame:
    """``(key, doc, text_hash, place)`` of kept suffixes whose beginning occurs more than once."""
    kinds = "key long, doc long, text_hash long, place int"
    rows = docs.select("doc", "text_hash", "text").mapInArrow(_suffixes, kinds)
    rows = stored(rows, "suffixes")
    order = ["key", "doc", "place"]
    sorted_ = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    marked = stored(sorted_.mapInArrow(_neighbours, kinds + ", outer boolean, single boolean"), "neighbours")
    # A run may be cut between partitions: two outer rows with one key belong together.
    again = marked.filter("outer").groupBy("key").count().filter("count > 1").select("key")
    singles = marked.filter("single").join(again, "key", "left_semi")
    return marked.filter("not single").unionByName(singles).drop("outer", "single")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document and kept suffix the run of windows that chose it, and a hash of the whole run."""
    kind = pa.list_(pa.int64())
    for batch in batches:
        found: list[list] = [[], [], [], [], []]
        places = batch.column("places").to_pylist()
        rows = zip(batch.column("doc").to_pylist(), texts_as_bytes(batch.column("text")), places, strict=True)
        for doc, text, kept in rows:
            words = word_hashes(text)
            keys, chosen = minimisers(words)
            windows = run_hashes(words, LENGTH)
            marked = np.zeros(len(words) + 1, bool)
            marked[kept] = True
            starts = np.flatnonzero(np.diff(chosen, prepend=-1))
            ends = np.append(starts[1:], len(chosen))
            wanted = np.flatnonzero(marked[chosen[starts]])
            for start, end in zip(starts[wanted], ends[wanted], strict=True):
                part = windows[start:end]
                place = int(chosen[start])
                digest = xxhash.xxh64_intdigest(part.tobytes(), place - int(start)) >> 1
                row = (doc, int(start), keys[place : place + 1].view(np.int64)[0], digest, part.view(np.int64))
                for column, value in zip(found, row, strict=True):
                    column.append(value)
        columns = [pa.array(column, pa.int64()) for column in found[:4]]
        lengths = np.array([len(w) for w in found[4]], np.int32)
        flat = np.concatenate(found[4]) if found[4] else np.zeros(0, np.int64)
        ends = np.append(0, np.cumsum(lengths)).astype(np.int32)
        columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)).cast(kind))
        yield pa.RecordBatch.from_arrays(columns, ["doc", "start", "key", "run", "windows"])


def repeats(docs: DataFrame) -> DataFrame:
    """``(doc, first_doc, word_start, word_end, removed)``: passages of at least 50 words.

    A passage is a maximal run of words all of whose 50-word windows occur in another document too,
    and first in the same document: ``first_doc``, the least ``doc``. That occurrence has ``removed``
    false, all others true. Words are A-Z lowered; offsets count words, the end is exclusive. ``doc``
    is ``doc_id``, or a hash of the text where that is null. Rows with the same ``doc`` are one
    document and give what any of them holds; null, empty and short texts have no passage. Other
    columns are not read.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(_doc().alias("doc"), F.xxhash64("text").alias("text_hash"), "text").filter("text is not null")
    found = repeated_suffixes(rows)
    places = found.groupBy("doc", "text_hash").agg(F.collect_set("place").alias("places"))
    kinds = "doc long, start long, key long, run long, windows array<long>"
    runs = rows.join(places, ["doc", "text_hash"]).select("doc", "text", "places").mapInArrow(_runs, kinds)
    runs = stored(runs, "runs")
    # Equal windows chose equal suffixes. Where all runs of a suffix are equal, they are settled
    # together; only the others are taken apart and compared window by window.
    keyed = runs.groupBy("key").agg(
        F.min("doc").alias("first_doc"), F.max("doc").alias("last_doc"), (F.min("run") == F.max("run")).alias("alike")
    )
    keyed = keyed.filter("first_doc < last_doc").drop("last_doc")
    size = F.size("windows").cast("long").alias("size")
    whole = runs.select("key", "doc", "start", size).join(keyed.filter("alike"), "key")
    mixed = runs.join(keyed.filter("not alike").select("key"), "key", "left_semi")
    mixed = mixed.select("doc", "start", F.posexplode("windows").alias("step", "window"))
    mixed = mixed.select("doc", (F.col("start") + F.col("step")).alias("start"), "window")
    firsts = mixed.groupBy("window").agg(F.min("doc").alias("first_doc"), F.max("doc").alias("last_doc"))
    firsts = firsts.filter("first_doc < last_doc").drop("last_doc")
    single = mixed.join(firsts, "window").select("doc", "first_doc", "start", F.lit(1).cast("long").alias("size"))
    every = whole.select("doc", "first_doc", "start", "size").unionByName(single)

    order = W.partitionBy("doc", "first_doc").orderBy("start")
    end = F.max(F.col("start") + F.col("size")).over(order.rowsBetween(W.unboundedPreceding, -1))
    opens = (end.isNull() | (F.col("start") > end)).cast("long")
    passages = every.withColumn("opens", opens).withColumn("passage", F.sum("opens").over(order.rowsBetween(W.unboundedPreceding, 0)))
    return passages.groupBy("doc", "first_doc", "passage").agg(
        F.min("start").cast("int").alias("word_start"),
        (F.max(F.col("start") + F.col("size")) - 1 + LENGTH).cast("int").alias("word_end"),
    ).select("doc", "first_doc", "word_start", "word_end", (F.col("doc") != F.col("first_doc")).alias("removed"))


def cut_words(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans, and the white space after each of them."""
    words = list(re.finditer(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", text))
    gone = np.zeros(len(words) + 1, bool)
    for start, end in spans:
        gone[start:end] = True
    lead = text[: words[0].start()] if words else text
    return lead + "".join(w.group() for w, g in zip(words, gone, strict=False) if not g)


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with its columns; each repeated passage stays in its first document only."""
    small_batches(docs.sparkSession)
    spans = repeats(docs).filter("removed").groupBy("doc").agg(
        F.collect_list(F.struct("word_start", "word_end")).alias("spans")
    )

    def cut(text: pa.Array, found: pa.Array) -> pa.Array:
        pairs = zip(text.to_pylist(), found.to_pylist(), strict=True)
        return pa.array(
            [t if t is None or not s else cut_words(t, [tuple(x.values()) for x in s]) for t, s in pairs], pa.string()
        )

    rows = docs.select(whole_row(docs).alias("row"), "text", _doc().alias("doc")).join(spans, "doc", "left")
    changed = F.when(F.col("spans").isNotNull(), F.arrow_udf(cut, "string")("text", "spans")).otherwise(F.col("text"))
    return rows.select(F.col("row").withField("text", changed).alias("row")).select("row.*")
