"""SimHash near-duplicates by a hierarchical index in Gray order.

Fingerprints are ranked by their place in the Gray sequence. Fingerprints next to each other in
that order share leading bits, so a run of ranks with a common prefix is a node of the index; its
upper entry keeps the bits that all of its fingerprints share. Two nodes are compared by these
shared bits alone, and a pair whose accumulated differences exceed the radius is dropped with all
that lies below it. Nodes with few fingerprints are compared in full; larger ones are split into
the nodes of a longer prefix first, as often as needed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches, stored, texts_as_bytes, words_of
from .components import components

SHINGLE_WORDS, SEED, BITS, RADIUS = 3, 42, 64, 2
#: Shingles hashed at a time: bounds memory on very long texts.
BLOCK = 1 << 15
#: Fingerprints a node of the first level holds on average, and comparisons a node pair may take
#: before it is split; both only shape the work.
NODE_TARGET, PAIR_LIMIT, STEP = 32, 1 << 14, 6


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """64 bits; bit i is set if more than half of the shingle hashes have it set."""
    words = words_of(text)
    if not words:
        return 0
    width = min(shingle_words, len(words))
    total, ones = len(words) - width + 1, np.zeros(BITS, np.int64)
    for start in range(0, total, BLOCK):
        part = words[start : start + BLOCK + width - 1]
        shingles = map(b" ".join, zip(*(part[i:] for i in range(width)), strict=False))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), "<u8")
        ones += set_bits(hashes)
    return majority(ones, total)


def set_bits(hashes: np.ndarray) -> np.ndarray:
    """How many of the 64-bit hashes have each bit set."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64)


def majority(ones: np.ndarray, total: int) -> int:
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = np.array([fingerprint(t) for t in texts_as_bytes(batch.column("text"))], np.uint64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").cast(pa.int64()), pa.array(values.view(np.int64))], ["doc_id", "fp"]
        )


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, fp)`` per row, the fingerprint as a signed 64-bit number."""
    small_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(_fingerprints, "doc_id long, fp long")


def gray_rank(fp: Column) -> Column:
    """Place of a bit pattern in the Gray sequence, as the 64 bits of an unsigned number."""
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, shift))
    return fp


def _prefix(rank: Column, depth: int) -> Column:
    return F.shiftrightunsigned(rank, BITS - depth) if depth < BITS else rank


def _pattern(node: Column) -> Column:
    """Leading fingerprint bits that the ranks of a node have in common."""
    return node.bitwiseXOR(F.shiftrightunsigned(node, 1))


def _differences(radius: int) -> Column:
    """At most ``radius`` differing bits among those that both nodes share."""
    shared = F.col("a_shared").bitwiseAND(F.col("b_shared"))
    return F.bit_count(F.col("a_bits").bitwiseXOR(F.col("b_bits")).bitwiseAND(shared)) <= radius


def _nodes(ranked: DataFrame, depth: int) -> DataFrame:
    both, some = F.bit_and("fp"), F.bit_or("fp")
    return ranked.groupBy(_prefix(F.col("rank"), depth).alias("node")).agg(
        F.count("*").alias("size"), both.alias("bits"), F.bitwise_not(both.bitwiseXOR(some)).alias("shared")
    )


def _side(nodes: DataFrame, side: str) -> DataFrame:
    return nodes.select(*(F.col(c).alias(f"{side}_{c}") for c in nodes.columns))


def _first_pairs(nodes: DataFrame, depth: int, radius: int) -> DataFrame:
    """Node pairs whose prefixes differ in few bits, each pair once."""
    masks = [
        sum(1 << bit for bit in bits)
        for count in range(radius + 1)
        for bits in combinations(range(depth), count)
    ]
    near = _side(nodes, "a").withColumn("mask", F.explode(F.array(*map(F.lit, masks))))
    near = near.withColumn("b_node", gray_rank(_pattern(F.col("a_node")).bitwiseXOR(F.col("mask"))))
    near = near.drop("mask").filter("b_node >= a_node")
    return near.join(_side(nodes, "b"), "b_node").filter(_differences(radius))


def _children(pairs: DataFrame, nodes: DataFrame, step: int, radius: int) -> DataFrame:
    parents = pairs.select(F.col("a_node").alias("a_up"), F.col("b_node").alias("b_up"))
    below = nodes.withColumn("up", F.shiftrightunsigned("node", step))
    left, right = (_side(below, side) for side in "ab")
    apart = F.bit_count(_pattern(F.col("a_node")).bitwiseXOR(_pattern(F.col("b_node"))))
    once = (F.col("a_up") != F.col("b_up")) | (F.col("a_node") <= F.col("b_node"))
    return (
        parents.join(left, "a_up")
        .join(right, "b_up")
        .filter(once & (apart <= radius) & _differences(radius))
        .drop("a_up", "b_up")
    )


def _compare(pairs: DataFrame, ranked: DataFrame, depth: int, radius: int) -> DataFrame:
    placed = ranked.select(_prefix(F.col("rank"), depth).alias("node"), "fp")
    left = placed.select(F.col("node").alias("a_node"), F.col("fp").alias("a"))
    right = placed.select(F.col("node").alias("b_node"), F.col("fp").alias("b"))
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))).between(1, radius)
    once = (F.col("a_node") != F.col("b_node")) | (F.col("a") < F.col("b"))
    near = pairs.select("a_node", "b_node").join(left, "a_node").join(right, "b_node")
    return near.filter(close & once).select("a", "b")


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """All pairs ``(a, b)`` of different fingerprints in ``distinct.fp`` within ``radius`` bits.

    Each pair comes once. Exact: a pair of nodes is dropped only if the bits that all fingerprints
    of each share already differ too often. Heavy node pairs are split by ``STEP`` more bits until
    at most ``PAIR_LIMIT`` comparisons remain; at 64 bits a node is one fingerprint.
    """
    ranked = stored(distinct.select("fp", gray_rank(F.col("fp")).alias("rank")), "ranks")
    depth = min(40, max(4, math.ceil(math.log2(max(1, ranked.count()) / NODE_TARGET))))
    pairs = stored(_first_pairs(_nodes(ranked, depth), depth, radius), "node-pairs")
    light, found = F.col("a_size") * F.col("b_size") <= PAIR_LIMIT, []
    while True:
        found.append(_compare(pairs.filter(light), ranked, depth, radius))
        heavy = pairs.filter(~light)
        if heavy.isEmpty():
            return reduce(DataFrame.unionByName, found)
        step = min(STEP, BITS - depth)
        depth += step
        pairs = stored(_children(heavy, _nodes(ranked, depth), step, radius), "node-pairs")


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``(doc_id, fp, component_id)`` for every row of ``docs``.

    ``component_id`` is the least ``doc_id`` reachable over links of at most ``radius`` differing
    bits. Only different fingerprints are linked; rows with the same one share its entry, so a large
    group of copies costs one. Null and empty texts, and texts of white space, have fingerprint zero
    and link as any other. Repeated rows come out as often as they came in. A row without ``doc_id``
    takes part; a component of such rows alone has a null id. Other columns are not read.
    """
    prints = stored(fingerprints(docs), "fingerprints")
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = components(links(distinct, radius))
    placed = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    placed = placed.select("fp", "least", F.coalesce("root", "fp").alias("root"))
    placed = stored(placed, "placed")
    ids = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = placed.join(ids, "root").select("fp", "component_id")
    return prints.join(by_print, "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """The columns of ``docs`` for one document of each group, the one with the least ``doc_id``.

    Exact repeats of that row are kept once; different texts under one id stay or go together. Rows
    without ``doc_id`` are kept, as nothing names them.
    """
    groups = near_duplicates(docs, radius).filter("doc_id = component_id")
    named = docs.filter("doc_id is not null").join(groups.select("doc_id").distinct(), "doc_id", "left_semi")
    named = named.select(*docs.columns)
    return named.dropDuplicates(["doc_id", "text"]).unionByName(docs.filter("doc_id is null"))


def fingerprint_text(fp: Column) -> Column:
    """16 lowercase hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
