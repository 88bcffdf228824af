"""The prefix trie of conversations, with sums over subtrees rolled up in bands of depth.

A node is named by a digest of its turns, chained from the root. Within a band of ``BAND`` levels every
node goes only to its ancestors in that band, which is one grouping for all bands at once. Then, from
the deepest band up, the finished totals of a band's topmost nodes go to their ancestors in the band
above. Rounds are as many as bands, and no row is multiplied by more than ``BAND``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, stored

BAND = 32
#: Bytes of a node's digest: of 10^12 nodes, two share one with a chance of 10^-15.
DIGEST = 16
#: A conversation takes up to five turns of the first one of its hundred.
BLOCK, MOST_SHARED = 100, 6
#: Bytes of decimal ids that are hashed at a time.
PIECE_BYTES = 64 << 10

Batches = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, at, digest, size``: turns in order, numbered from 1; digests stand for role and text."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), role, text)
    rows = conversations.select(F.col("conv_id").cast("long"), "turn", "role", "text").filter("conv_id is not null")
    named = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    digest = F.substring(F.unhex(F.sha2(named.cast("binary"), 256)), 1, DIGEST)
    return rows.select("conv_id", F.row_number().over(order).alias("at"), digest.alias("digest"), F.length(text).cast("long").alias("size"))


def _rebuilt(turns: DataFrame) -> DataFrame:
    """``conv_id, at, digest, size`` after sharing; ``at`` 0 has the number of turns as its ``size``.

    A conversation c takes the first h turns of conversation c - c % 100, then its own from h on; h is
    crc32 of the decimal id, modulo 6.
    """
    shared = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_SHARED).cast("int").alias("h")
    lengths = turns.groupBy("conv_id").agg(F.max("at").alias("own"))
    each = lengths.select("conv_id", "own", shared, (F.col("conv_id") - F.col("conv_id") % BLOCK).alias("base"))
    starts = turns.filter((F.col("at") < MOST_SHARED) & (F.col("conv_id") % BLOCK == 0))
    starts = starts.groupBy(F.col("conv_id").alias("base")).agg(F.sort_array(F.collect_list(F.struct("at", "digest", "size"))).alias("start"))
    taken = F.coalesce(F.slice("start", F.lit(1), F.col("h")), F.expr("cast(array() as array<struct<at:int,digest:binary,size:bigint>>)"))
    taken = each.join(starts, "base", "left").select("conv_id", "own", "h", taken.alias("taken"))
    count = F.size("taken") + F.greatest(F.lit(0), F.col("own") - F.col("h"))
    head = F.struct(F.lit(0).alias("at"), F.lit(None).cast("binary").alias("digest"), count.cast("long").alias("size"))
    before = taken.select("conv_id", F.inline(F.concat(F.array(head), "taken")))
    missing = taken.select("conv_id", (F.col("h") - F.size("taken")).alias("less")).filter("less > 0")
    rest = turns.select("*", shared).filter("at > h").join(missing, "conv_id", "left")
    rest = rest.select("conv_id", (F.col("at") - F.coalesce("less", F.lit(0))).alias("at"), "digest", "size")
    return before.unionByName(rest)


def _chainer(band: int) -> Batches:
    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Digests from the node above its band's topmost one down to the turn's own, one after another.

        Rows come by conversation and place; only the path within the current band is held.
        """
        path, turns = b"", 0
        for batch in batches:
            paths, sizes, ends = [], [], []
            rows = (batch.column(c).to_pylist() for c in ("at", "digest", "size"))
            for at, digest, size in zip(*rows, strict=True):
                if at == 0:
                    path, turns, size = hashlib.blake2b(digest_size=DIGEST).digest(), size, 0
                else:
                    above = path[-DIGEST:]
                    path = (above if at % band == 0 else path) + hashlib.blake2b(above + digest, digest_size=DIGEST).digest()
                paths.append(path)
                sizes.append(size)
                ends.append(at == turns)
            columns = {"conv_id": batch.column("conv_id"), "depth": batch.column("at").cast(pa.int64()), "path": pa.array(paths, pa.binary())}
            columns |= {"size": pa.array(sizes, pa.int64()), "ends": pa.array(ends, pa.bool_())}
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return chain


def _piecer(most: int) -> Batches:
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted ids of a node joined by commas, in pieces of bounded length."""
        key, first, ids, size = None, 0, [], 0
        done: list[tuple] = []

        def out() -> pa.RecordBatch:
            keys, firsts, texts = zip(*done, strict=True) if done else ((), (), ())
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(firsts, pa.int64()), pa.array(texts, pa.string())], ["key", "first", "piece"])

        for batch in batches:
            for k, conv in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
                if k != key or size > most:
                    if ids:
                        done.append((key, first, ",".join(ids)))
                    key, first, ids, size = k, conv, [], 0
                ids.append(str(conv))
                size += len(ids[-1]) + 1
            yield out()
        if ids:
            done.append((key, first, ",".join(ids)))
            yield out()

    return pieces


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the pieces of each node, which come in order."""
    key, running = None, None
    for batch in batches:
        keys, digests = [], []
        for k, piece in zip(batch.column("key").to_pylist(), batch.column("piece").to_pylist(), strict=True):
            if k == key:
                running.update(b"," + piece.encode())
                continue
            if running:
                keys.append(key)
                digests.append(running.hexdigest())
            key, running = k, hashlib.sha256(piece.encode())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(digests, pa.string())], ["key", "ends_sha256"])
    if running:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([running.hexdigest()])], ["key", "ends_sha256"])


def _ends(rows: DataFrame, piece_bytes: int) -> DataFrame:
    """``key, ends_sha256`` of every node at which conversations end.

    A node's ids are sorted and joined in as many tasks as they fill; only the pieces meet in one.
    """
    sorted_ids = rows.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    pieces = sorted_ids.mapInArrow(_piecer(piece_bytes), "key binary, first long, piece string")
    together = pieces.repartition("key").sortWithinPartitions("key", "first")
    return together.mapInArrow(_hashed, "key binary, ends_sha256 string")


def _step(path: str, back: int | Column) -> Column:
    """The digest so many steps above the last one of a path."""
    return F.substr(F.col(path), -DIGEST * (1 + F.lit(back)), F.lit(DIGEST))


def _own_band(path: str, depth: str, band: int) -> Column:
    """A node and its ancestors within its band."""
    return F.transform(F.sequence(F.lit(0), (F.col(depth) % band).cast("int")), lambda i: _step(path, i))


def trie(conversations: DataFrame, band: int = BAND, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """One row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    Turns are ordered by ``turn``, nulls first, then by role and text; null role or text is empty, and
    repeated rows are turns of their own. Rows without ``conv_id`` belong to no conversation and are left
    out. Other columns are not looked at. An empty table has no nodes. ``conv_id`` is the smallest member;
    ``saved_tokens`` counts code points. ``conv_id`` and ``depth`` together name a node.
    """
    small_batches(conversations.sparkSession)
    turns = stored(_turns(conversations), "turns")
    # Written first: above a union of inputs that are dealt alike, Spark 4.1 may leave out the shuffle, and
    # adaptive execution then keeps the inputs in tasks of their own.
    ordered = stored(_rebuilt(turns), "rebuilt").repartition("conv_id").sortWithinPartitions("conv_id", "at")
    rows = stored(ordered.mapInArrow(_chainer(band), "conv_id long, depth long, path binary, size long, ends boolean"), "prefixes")
    nodes = rows.groupBy("path", "depth", "size").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"))
    parent = F.when(F.col("depth") > 0, _step("path", 1))
    saved = (F.col("n_convs") - 1) * F.col("size")
    nodes = stored(nodes.select(_step("path", 0).alias("key"), parent.alias("parent"), "path", "depth", "conv_id", "n_convs", saved.alias("saved")), "nodes")
    children = nodes.filter("parent is not null").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children"))
    leaf = F.col("n_children").isNull().cast("long").alias("leaves")
    nodes = stored(nodes.join(children, "key", "left").select(*nodes.columns, F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), leaf), "nodes")

    sums = [F.sum(c).alias(c) for c in ("saved", "leaves")]
    up = nodes.select(F.explode(_own_band("path", "depth", band)).alias("key"), "saved", "leaves")
    totals = stored(up.groupBy("key").agg(*sums), "band-totals")
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    if deepest >= band:
        topmost = nodes.filter((F.col("depth") > 0) & (F.col("depth") % band == 0)).select("key", F.col("depth").alias("top"), "parent")
        above = nodes.filter(F.col("depth") % band == band - 1).select(F.col("key").alias("parent"), "path", "depth")
        topmost = stored(topmost.join(above, "parent").join(totals, "key").drop("parent"), "band-roots")
        added = None
        for number in range(deepest // band, 0, -1):
            own = topmost.filter(F.col("top") == number * band)
            if added is not None:
                more = added.select("key", F.col("saved").alias("more_saved"), F.col("leaves").alias("more_leaves"))
                own = own.join(more, "key", "left")
                own = own.withColumns({c: F.col(c) + F.coalesce(f"more_{c}", F.lit(0)) for c in ("saved", "leaves")})
            spread = own.select(F.explode(_own_band("path", "depth", band)).alias("key"), "saved", "leaves")
            added = stored(spread.groupBy("key").agg(*sums), "from-below")
            totals = totals.unionByName(added)
        totals = totals.groupBy("key").agg(*sums)

    ends = _ends(rows.filter("ends").select(_step("path", 0).alias("key"), "conv_id"), piece_bytes)
    parents = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    whole = nodes.drop("saved", "leaves").join(totals, "key").join(ends, "key", "left").join(parents, "parent", "left")
    return whole.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
