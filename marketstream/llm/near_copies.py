"""Near copies by shingle similarity: the share of five-word shingles that two texts have in common.

The Gray-order index of SimHash prints (``simhash_dedup``), here over the five-word shingles, names groups of
texts whose prints lie within ``simhash_dedup.RADIUS`` bits of each other, and every group is a key. At a
similarity of 0.8 prints differ in ten bits on average and in eighteen at times, and so do unrelated ones too
often for any index; for such pairs a text has ``BANDS`` further keys, each made of ``ROWS`` least hash values
(MinHash). A pair just at 0.8 shares none of these once in 1,500 times, a pair at 0.85 once in 10^5.
Candidates share a key; a pair counts only if the similarity of its whole shingle sets reaches ``SIMILARITY``.
Before texts are fetched, a pair is left out if marks of ``MARKS`` bits already show more differences than two
such sets can have; this loses no pair.

Texts that share a key are not compared all with all. In rounds, one text of each key, another one for
each key and round, is compared with those that no link has joined to it yet; it is then done, and a key
is done when its texts are one component. A key with few such pairs left is settled at once. Keys that
hold many unlike texts even so are dealt anew by the rarest shingles of each text: two sets of similarity
0.8 share one of the first fifth, whatever the rest. Of these keys, more and more texts outside of the
largest component are compared in a round, so that rounds grow with the logarithm of the largest key.

The driver's memory goes with the queries and broadcasts it has lately planned, not with rows. So tasks contract
links before their components are sought, one task alone if they are few; a round without similar pairs ends
early, and tables of nodes are joined without broadcasts.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import simhash_dedup
from .common import small_batches, stored, texts_as_bytes, words_of
from .components import components

SHINGLE_WORDS, SEED = 5, 42
#: Similarity as a fraction of whole numbers, so that the bound itself is met exactly.
SIMILARITY = (4, 5)
BANDS, ROWS = 40, 8
#: Bits of a text's marks, and the band of the keys from the Gray-order index.
MARKS, GRAY = 512, -1
#: Bands of the first round, which joins most copies; rounds over all bands; pairs for each text that settle
#: a key; growth of the texts compared in a round of the keys dealt anew.
FIRST_BANDS, ROUNDS, SETTLED, FASTER = 4, 2, 4, 8
#: Shingles put through all hash functions at a time; links that a task contracts at a time.
BLOCK, CONTRACTED = 512, 1 << 18
_MIX = np.random.default_rng(5).integers(0, 1 << 63, (2, BANDS * ROWS, 1)).astype(np.uint64)
_FLIP, _FACTOR = _MIX[0], _MIX[1] << np.uint64(1) | np.uint64(1)


def shingles(text: bytes) -> np.ndarray:
    """Hashes of the different shingles in order; a shorter text is one shingle."""
    words = words_of(text)
    width = min(SHINGLE_WORDS, len(words))
    if not width:
        return np.zeros(0, np.uint64)
    joined = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False))
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, joined, repeat(SEED)), np.uint64))


def band_keys(found: np.ndarray) -> np.ndarray:
    """One key per band, none without shingles."""
    if not len(found):
        return np.zeros(0, np.int64)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(found), BLOCK):
        mixed = (found[start : start + BLOCK] ^ _FLIP) * _FACTOR
        np.minimum(least, mixed.min(axis=1), out=least)
    rows = least.reshape(BANDS, ROWS)
    return np.array([xxhash.xxh64_intdigest(r.tobytes(), i) for i, r in enumerate(rows)], np.uint64).view(np.int64)


def marks(found: np.ndarray) -> np.ndarray:
    """Bit i tells whether an odd number of shingles falls on i: marks differ in at most as many bits as sets in shingles."""
    places = (found * _FACTOR[0] >> np.uint64(64 - MARKS.bit_length() + 1)).astype(np.int64)
    odd = np.bincount(places, minlength=MARKS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def gray_print(found: np.ndarray) -> int:
    return simhash_dedup.majority(simhash_dedup.set_bits(found), len(found))


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        nodes, sizes, keys, prints, marked = [], [], [], [], []
        for text in texts_as_bytes(batch.column("text")):
            found = shingles(text)
            nodes.append(xxhash.xxh64_intdigest(found.tobytes()))
            sizes.append(len(found))
            keys.append(band_keys(found))
            prints.append(gray_print(found))
            marked.append(marks(found))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").cast(pa.int64()),
                batch.column("digest"),
                pa.array(np.array(nodes, np.uint64).view(np.int64)),
                pa.array(sizes, pa.int32()),
                pa.array(keys, pa.list_(pa.int64())),
                pa.array(np.array(prints, np.uint64).view(np.int64)),
                pa.array(marked, pa.list_(pa.int64())),
            ],
            ["doc_id", "digest", "node", "n", "keys", "fp", "marks"],
        )


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return SIMILARITY[1] * both >= SIMILARITY[0] * (len(a) + len(b) - both)


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept, last, known = [], None, np.zeros(0, np.uint64)
        ids, left, right = batch.column("a").to_pylist(), *(texts_as_bytes(batch.column(c)) for c in ("a_text", "b_text"))
        for node, a, b in zip(ids, left, right, strict=True):
            if node != last:
                last, known = node, shingles(a)
            kept.append(similar(known, shingles(b)))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(kept, pa.bool_()))


def _gray_groups(nodes: DataFrame) -> DataFrame:
    """``key, band, node, n``: texts whose prints are joined by the Gray-order index share a key."""
    prints = nodes.filter("n > 0").select("node", "n", "fp")
    roots = stored(_components(simhash_dedup.links(stored(prints.select("fp").distinct(), "prints"))), "print-roots")
    placed = prints.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    key = F.xxhash64(F.lit("gray"), F.coalesce("root", "fp"))
    return placed.select(key.alias("key"), F.lit(GRAY).alias("band"), "node", "n")


def _candidates(prints: DataFrame, nodes: DataFrame) -> DataFrame:
    """``key, band, node, n``: different shingle sets that share a key with another one."""
    banded = prints.select("node", "n", F.posexplode("keys").alias("band", "key")).select("key", "band", "node", "n")
    entries = banded.unionByName(_gray_groups(nodes)).dropDuplicates(["key", "node"])
    shared = entries.groupBy("key").agg(F.count("*").alias("texts")).filter("texts > 1").select("key")
    return stored(entries.join(shared, "key", "left_semi"), "bands")


def _texts(docs: DataFrame, prints: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, text``: one text of each node."""
    chosen = prints.join(nodes, "node", "left_semi").groupBy("node").agg(F.min(F.struct("doc_id", "digest")).alias("row"))
    chosen = chosen.select("node", F.col("row.doc_id").alias("row_id"), F.col("row.digest").alias("row_digest"))
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("digest"))
    same = rows["doc_id"].eqNullSafe(chosen["row_id"]) & (rows["digest"] == chosen["row_digest"])
    return stored(rows.join(chosen, same).select("node", "text").dropDuplicates(["node"]), "node-texts")


def _verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of the different pairs ``(a, b)`` of nodes that are similar."""
    joined = pairs = pairs.select("a", "b")
    for side in "ba":
        needed = texts.join(pairs.select(F.col(side).alias("node")).distinct().hint("merge"), "node", "left_semi")
        needed = needed.select(F.col("node").alias(side), F.col("text").alias(f"{side}_text"))
        joined = joined.join(needed.hint("merge"), side)
    return stored(joined.select("a", "b", "a_text", "b_text").mapInArrow(_verified, "a long, b long"), "similar")


def _size_fits(a: str, b: str) -> Column:
    """Sets of too different sizes cannot be similar."""
    return SIMILARITY[1] * F.least(a, b) >= SIMILARITY[0] * F.greatest(a, b)


def _marks_fit() -> Column:
    """Marks that differ in more bits than two similar sets have different shingles cannot be of such sets."""
    apart = sum(F.bit_count(F.get("a_marks", F.lit(i)).bitwiseXOR(F.get("b_marks", F.lit(i)))) for i in range(MARKS // 64))
    return apart * (SIMILARITY[1] + SIMILARITY[0]) <= (F.col("a_n") + F.col("b_n")) * (SIMILARITY[1] - SIMILARITY[0])


def _round(
    entries: DataFrame, roots: DataFrame | None, marked: DataFrame, number: int, hubs: int = 1
) -> tuple[DataFrame, DataFrame]:
    """Pairs to compare next, with their roots, and the entries that have others left.

    Of a key with m texts in components of c texts each, (m^2 - sum c^2) / 2 pairs may join components.
    With more than one, about ``hubs`` texts of a key outside of a component of half of it are compared.
    """
    if roots is None:
        placed = entries.select("key", "node", "n", F.col("node").alias("root"))
    else:
        joined = entries.select("key", "node", "n").join(roots.hint("merge"), "node", "left")
        placed = joined.select("key", "node", "n", F.coalesce("root", "node").alias("root"))
    placed = stored(placed, "placed")
    turn = F.xxhash64("node", "key", F.lit(number)).alias("turn")
    parts = placed.groupBy("key", "root").agg(F.count("*").alias("c"), F.min(F.struct(turn, "node", "n")).alias("first"))
    keys = parts.groupBy("key").agg(
        F.sum("c").alias("m"),
        F.sum(F.col("c") * F.col("c")).alias("squares"),
        F.min(F.struct("first", "root")).alias("hub"),
        F.max(F.struct("c", "root")).alias("largest"),
    )
    few = F.col("m") * F.col("m") - F.col("squares") <= 2 * SETTLED * F.col("m")
    major = F.when(F.col("largest.c") * 2 > F.col("m"), F.col("largest.root"))
    keys = keys.filter("m * m > squares").select("key", "m", F.col("hub.first.node").alias("first"), few.alias("few"), major.alias("major"))
    here = stored(placed.join(stored(keys, "open"), "key"), "here")
    outside = F.col("major").isNull() | (F.col("root") != F.col("major"))
    chosen = F.col("node") == F.col("first") if hubs == 1 else outside & (F.pmod(turn, "m") < hubs)

    def side(rows: DataFrame, name: str) -> DataFrame:
        rows = rows.select("key", "node", "n", "root", "few").join(marked.hint("merge"), "node")
        return rows.select("key", "few", *(F.col(c).alias(f"{name}_{c}") for c in ("node", "n", "root", "marks")))

    hub, left = side(here.filter(~F.col("few") & chosen), "a").drop("few"), side(here.filter("few"), "a").drop("few")
    other = side(here, "b")
    fits = _size_fits("a_n", "b_n") & _marks_fit()
    stars = other.filter("not few").join(hub, "key").filter("a_root <> b_root").filter(fits)
    settled = other.filter("few").join(left, "key").filter("a_root < b_root").filter(fits)
    pairs = stars.unionByName(settled).select(
        F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b"),
        F.least("a_root", "b_root").alias("a_root"), F.greatest("a_root", "b_root").alias("b_root"),
    )
    rest = here.filter(~F.col("few") & ~chosen).select("key", "node", "n")
    return stored(pairs.dropDuplicates(["a", "b"]), "near"), rest


def _rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for node, text in zip(batch.column("node").to_pylist(), texts_as_bytes(batch.column("text")), strict=True):
            found = shingles(text).view(np.int64)
            nodes = pa.array(np.full(len(found), node, np.int64))
            yield pa.RecordBatch.from_arrays([nodes, pa.array(found)], ["node", "key"])


def _dealt_anew(rest: DataFrame, texts: DataFrame) -> DataFrame:
    """``key, node, n``: the nodes of ``rest`` under the shingles one of which similar sets must share.

    The rarest ones, counted among these nodes, as many as may be missing in the other set, and one.
    """
    nodes = rest.select("node", "n").distinct()
    each = texts.join(nodes, "node", "left_semi").mapInArrow(_rarest, "node long, key long")
    each = stored(each, "shingles")
    common = each.groupBy("key").agg(F.count("*").alias("times"))
    order = Window.partitionBy("node").orderBy("times", "key")
    ranked = each.join(common, "key").withColumn("rank", F.row_number().over(order)).join(nodes, "node")
    must = F.ceil(F.col("n") * SIMILARITY[0] / SIMILARITY[1])
    return stored(ranked.filter(F.col("rank") <= F.col("n") - must + 1).filter("times > 1").select("key", "node", "n"), "rarest")


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of the same components: of those a task holds, each node with the least one it leads to."""
    up: dict[int, int] = {}

    def top(node: int) -> int:
        while (above := up.setdefault(node, node)) != node:
            up[node] = node = up[above]
        return node

    def stars() -> pa.RecordBatch:
        nodes = [node for node, above in up.items() if node != above]
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(map(top, nodes), pa.int64())], ["a", "b"])

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            a, b = top(a), top(b)
            up[max(a, b)] = min(a, b)
        if len(up) >= CONTRACTED:
            yield stars()
            up.clear()
    yield stars()


def _rooted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``node, root`` of all links, which are too few for ``_contracted`` to part them."""
    stars = pa.Table.from_batches(_contracted(batches))
    roots = stars["b"].unique()
    yield from stars.rename_columns(["node", "root"]).to_batches()
    yield pa.RecordBatch.from_arrays([roots, roots], ["node", "root"])


def _components(links: DataFrame) -> DataFrame:
    """``components`` of the links, contracted by tasks first: most of its rounds, and what the driver plans for them, fall away.

    A task takes as many links as it contracts at a time, each with two nodes; if that is all of them, nothing is left to join.
    """
    found = stored(links.select("a", "b").distinct(), "links")
    tasks = found.count() * 2 // CONTRACTED + 1
    found = found.coalesce(tasks)
    if tasks == 1:
        return found.mapInArrow(_rooted, "node long, root long")
    return components(found.mapInArrow(_contracted, "a long, b long"))


def _merged(roots: DataFrame | None, pairs: DataFrame, similar_pairs: DataFrame) -> DataFrame:
    """``node, root`` after similar pairs join the components of their nodes; only the roots are joined anew."""
    if roots is not None and similar_pairs.isEmpty():
        return roots
    joined = pairs.join(similar_pairs.hint("merge"), ["a", "b"], "left_semi")
    moved = stored(_components(joined.select(F.col("a_root").alias("a"), F.col("b_root").alias("b"))), "moved")
    if roots is None:
        return moved
    to = moved.select(F.col("node").alias("root"), F.col("root").alias("new"))
    old = roots.join(to.hint("merge"), "root", "left").select("node", F.coalesce("new", "root").alias("root"))
    return stored(old.unionByName(moved.join(roots.select("node").hint("merge"), "node", "left_anti")), "roots")


def groups(docs: DataFrame, prints: DataFrame, rounds: int = ROUNDS, first_bands: int = FIRST_BANDS) -> DataFrame:
    """``node, root`` of the linked nodes: the components of all similar pairs that share a key."""
    nodes = stored(prints.select("node", "n", "fp", "marks").dropDuplicates(["node"]), "nodes")
    entries = _candidates(prints, nodes)
    texts = _texts(docs, prints, entries.select("node").distinct())
    marked = nodes.select("node", "marks")
    pairs, _ = _round(entries.filter(F.col("band") < first_bands), None, marked, 0)
    roots, number = _merged(None, pairs, _verify(pairs, texts)), 0
    while not entries.isEmpty():
        if number == rounds:
            entries = _dealt_anew(entries, texts)
        number += 1
        pairs, rest = _round(entries, roots, marked, number, FASTER ** max(0, number - rounds))
        entries = stored(rest, "rest")
        if not pairs.isEmpty():
            roots = _merged(roots, pairs, _verify(pairs, texts))
    return roots


def keep_first(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """The columns of ``docs`` for one document of each group of near copies, that of the least ``doc_id``.

    Groups are the components of pairs with similarity 0.8 or more; ``rounds`` changes the work, not them. Texts without words are one group.
    Exact repeats of the kept row are kept once; of different texts under its id in one group, one is
    kept. Rows without ``doc_id`` take part in groups and are all kept, as nothing names them.
    """
    small_batches(docs.sparkSession)
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("digest"))
    prints = rows.mapInArrow(_sketches, "doc_id long, digest long, node long, n int, keys array<long>, fp long, marks array<long>")
    prints = stored(prints, "sketches")
    roots = groups(docs, prints, rounds)
    named = prints.filter("doc_id is not null").join(roots, "node", "left")
    first = named.groupBy(F.coalesce("root", "node").alias("group")).agg(F.min(F.struct("doc_id", "digest")).alias("row"))
    first = stored(first.select(F.col("row.doc_id").alias("row_id"), F.col("row.digest").alias("row_digest")), "kept")
    same = (docs["doc_id"] == first["row_id"]) & (F.xxhash64(docs["text"]) == first["row_digest"])
    kept = docs.join(first, same, "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.unionByName(docs.filter("doc_id is null"))
