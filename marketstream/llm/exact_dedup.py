"""Exact duplicates by naming blocks: equal texts, and only those, end up with the same integer name.

A text is cut into blocks of ``BLOCK_BYTES``. The blocks of all texts are sorted and numbered, equal
blocks alike. Then the names of two adjacent blocks form a pair, pairs are sorted and numbered in the
same way, and so on until one name is left of each text. A name stands for one content, so nothing
rests on a hash being free of collisions. Rounds grow with the logarithm of the longest text.

A text that holds a name which occurs nowhere else equals no other one; it leaves the rounds at once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lowered, small_batches, stored, texts_as_bytes, whole_row

BLOCK_BYTES = 2048
#: Names of one sorted partition lie in a range of their own of so many bits.
NAME_BITS = 40
#: The place of a missing right neighbour; names are never negative.
ABSENT = -1


def _cutter(block_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            source, places, blocks, digests = [], [], [], []
            for at, text in enumerate(texts_as_bytes(batch.column("text"))):
                text = text.lower()
                own = [text[i : i + block_bytes] for i in range(0, len(text) or 1, block_bytes)]
                blocks += own
                source += [at] * len(own)
                places += range(len(own))
                digests += [hashlib.sha256(text).hexdigest()] + [None] * (len(own) - 1)
            lead = np.array([xxhash.xxh64_intdigest(b) for b in blocks], np.uint64).view(np.int64)
            source = pa.array(source, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row").take(source),
                    pa.array(places, pa.int32()),
                    batch.column("doc_id").take(source),
                    pa.array(digests, pa.string()),
                    pa.array(lead),
                    pa.array(blocks, pa.binary()),
                ],
                ["row", "pos", "doc_id", "text_sha256", "lead", "block"],
            )

    return cut


def _flat(rows: pa.Table, name: str) -> pa.Array:
    column = rows.column(name).combine_chunks()
    return column.chunk(0) if isinstance(column, pa.ChunkedArray) else column


def _changes(rows: pa.Table, columns: list[str]) -> np.ndarray:
    """For each row but the first: does it differ from the row before?"""
    changed = np.zeros(rows.num_rows - 1, bool)
    for column in (_flat(rows, name) for name in columns):
        changed |= pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
    return changed


def _numberer(lead: list[str], keys: list[str], carried: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Number the rows of one sorted partition, rows with equal ``keys`` alike.

    At the end come rows without ``row``: the keys under the first and the last ``lead`` of the
    partition. Only these can stand in other partitions, too.
    """

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = TaskContext.get().partitionId() << NAME_BITS
        held, fresh = None, True  # the last row, kept back until the next one is known; does it begin a key?
        under_first, under_last, in_first = [], [], True

        def out(rows: pa.Table, names: np.ndarray, single: np.ndarray) -> pa.RecordBatch:
            known = {"name": pa.array(names, pa.int64()), "single": pa.array(single, pa.bool_())}
            columns = {c: _flat(rows, c) for c in carried} | known | {k: pa.nulls(rows.num_rows, rows.schema.field(k).type) for k in keys}
            return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            begins = held is None
            rows = rows if begins else pa.concat_tables([held, rows])
            other_key, other_lead = _changes(rows, keys), np.flatnonzero(_changes(rows, lead)) + 1
            names = name + np.concatenate([[0], np.cumsum(other_key)])
            starts = np.flatnonzero(other_key) + 1
            starts = np.concatenate([[0], starts]) if begins else starts
            if in_first:
                stop = other_lead[0] if len(other_lead) else rows.num_rows
                under_first += [(int(names[i]), rows.slice(i, 1)) for i in starts[starts < stop]]
                in_first = not len(other_lead)
            if len(other_lead):
                under_last = []
            under_last += [(int(names[i]), rows.slice(i, 1)) for i in starts[starts >= (other_lead[-1] if len(other_lead) else 0)]]
            fresh_here = np.concatenate([[fresh], other_key])
            single = fresh_here[:-1] & other_key
            if rows.num_rows > 1:
                yield out(rows.slice(0, rows.num_rows - 1), names[:-1], single)
            held, name, fresh = rows.slice(rows.num_rows - 1), int(names[-1]), bool(fresh_here[-1])
        if held is None:
            return
        yield out(held, np.array([name]), np.array([fresh]))
        edges = dict(under_first + under_last)
        for name, row in edges.items():
            columns = {c: pa.nulls(1, row.schema.field(c).type) for c in carried}
            columns |= {"name": pa.array([name], pa.int64()), "single": pa.array([False])} | {k: _flat(row, k) for k in keys}
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return number


def _named(rows: DataFrame, lead: list[str], keys: list[str]) -> DataFrame:
    """``rows`` with ``name``, one integer per value of ``keys``, in their place, and ``single``: no other row has it.

    ``lead`` depends on ``keys`` alone. The sort spreads the rows of a key by ``row``, so a key that fills
    many partitions costs no task more than its share. Keys at the borders of partitions may have been
    numbered more than once and get the least of their names; there are few of them per partition.
    """
    carried = [c for c in rows.columns if c not in {*lead, *keys}]
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    order = list(dict.fromkeys([*lead, *keys]))
    schema = [f"{c} {kinds[c]}" for c in carried] + ["name long", "single boolean"] + [f"{k} {kinds[k]}" for k in keys]
    dealt = rows.repartitionByRange(*lead, "row").sortWithinPartitions(*order, "row").select(*carried, *order)
    numbered = stored(dealt.mapInArrow(_numberer(lead, keys, carried), ", ".join(schema)), "names")
    same = numbered.filter("row is null").groupBy(*keys).agg(F.collect_set("name").alias("names")).filter(F.size("names") > 1)
    same = same.select(F.explode("names").alias("name"), F.array_min("names").alias("least"))
    joined = numbered.filter("row is not null").join(F.broadcast(same), "name", "left")
    return joined.select(
        *carried, F.coalesce("least", "name").alias("name"), (F.col("single") & F.col("least").isNull()).alias("single")
    )


def identities(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``row, doc_id, text_sha256, level, name, single``: texts are equal when level and name are.

    A-Z are lowered first; null counts as the empty text. Every row of ``docs`` gets one row, repeated
    or null ids too. ``single`` rows were settled early and equal no other one.
    """
    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    blocks = texts.mapInArrow(
        _cutter(block_bytes),
        f"row long, pos int, doc_id {kind}, text_sha256 string, lead long, block binary",
    )
    named = stored(_named(blocks, ["lead"], ["block"]), "named")
    about = named.filter("pos = 0").select("row", "doc_id", "text_sha256")
    settled, level = [], 0
    while True:
        parts = F.sort_array(F.collect_list(F.struct("pos", "name"))).getField("name")
        own = named.groupBy("row").agg(F.min(F.when(F.col("single"), F.col("name"))).alias("alone"), parts.alias("names"))
        own = stored(own, f"level-{level}")
        over = F.col("alone").isNotNull() | (F.size("names") == 1)
        name = F.coalesce("alone", F.get("names", F.lit(0)))
        settled.append(own.filter(over).select("row", F.lit(level).alias("level"), name.alias("name"), F.col("alone").isNotNull().alias("single")))
        rest = own.filter(~over)
        if rest.isEmpty():
            break
        level += 1
        pairs = F.transform(
            F.sequence(F.lit(0), F.expr("(size(names) - 1) div 2").cast("int")),
            lambda i: F.struct(
                i.alias("pos"),
                F.get("names", 2 * i).alias("a"),
                F.coalesce(F.get("names", 2 * i + 1), F.lit(ABSENT)).alias("b"),
            ),
        )
        named = stored(_named(rest.select("row", F.inline(pairs)), ["a", "b"], ["a", "b"]), "named")
    return about.join(reduce(DataFrame.unionByName, settled), "row")


def duplicates(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row of ``docs``, dropped ones too.

    Of equal texts the row with the largest ``doc_id`` stays, a null id being the least; of repeated rows
    under that id just one. Null and empty texts are equal. An empty table gives no rows. Other columns
    are not looked at. ``text_sha256`` is of the text with A-Z lowered.
    """
    named = stored(identities(docs, block_bytes), "identities")
    shared = named.filter(~F.col("single"))
    groups = shared.groupBy("level", "name").agg(
        F.count("*").alias("group_size"), F.max(F.struct("doc_id", "row")).alias("last")
    )
    # Written, so that the join deals both sides itself and can split a group that holds very many rows.
    groups = stored(groups, "groups")
    joined = shared.join(groups, ["level", "name"]).select(
        "doc_id",
        F.col("last.doc_id").alias("keep_id"),
        "group_size",
        (F.col("last.row") == F.col("row")).alias("kept"),
        "text_sha256",
    )
    alone = named.filter("single").select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "text_sha256",
    )
    return joined.unionByName(alone)


def keep_last(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all columns, that stay: one of each set of equal texts, by ``duplicates``.

    Of rows that share id and text but differ in other columns, any one stays.
    """
    kept = duplicates(docs).filter("kept").select(F.col("doc_id").alias("kept_id"), F.col("text_sha256").alias("kept_sha"))
    marked = docs.select(
        whole_row(docs).alias("whole"),
        F.sha2(lowered(F.coalesce("text", F.lit(""))).cast("binary"), 256).alias("sha"),
    )
    same = F.col("whole.doc_id").eqNullSafe(F.col("kept_id")) & (F.col("sha") == F.col("kept_sha"))
    once = marked.join(kept, same, "left_semi").dropDuplicates(["sha"])
    return once.select(*(F.col("whole").getField(c).alias(c) for c in docs.columns))
