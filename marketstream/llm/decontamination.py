"""Benchmark decontamination: SimHash windows of item size, exact shingle index, exact verification.

Windows as long as a benchmark item are laid over a document wherever enough of the item's shingles
lie together; elsewhere no window can reach the similarity asked for, so nothing is lost by that. Each
window gets a SimHash of its words. An exact index of the items' shingles finds the candidates; it
replaces a search by Hamming blocks, which add nothing to the radius, as two fingerprints within it
always share one of ``RADIUS + 1`` blocks. The radius only drops windows that the index admits. The
weighted similarity of the shingles, repeats included, decides.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches, whole_row

SHINGLE_WORDS, SIMILARITY, RADIUS = 5, 0.8, 20
#: Items that one pass over the documents looks for: bounds what is sent to the tasks.
ITEM_BLOCK = 4096
_WORD = re.compile(r"\w+")
_FACTORS = np.array([pow(0x9E3779B97F4A7C15, i + 1, 1 << 64) for i in range(SHINGLE_WORDS)], np.uint64)
_FILTER_BITS = 22
HIT = "array<struct<item_id:bigint,similarity:double,word_start:int,n_words:int,distance:int>>"


def word_hashes(text: str) -> np.ndarray:
    """Hashes of the words, in lower case and without marks around them."""
    words = _WORD.findall(text.lower())
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` words."""
    total = max(0, len(words) - width + 1)
    out = np.full(total, width, np.uint64)
    for i in range(width):
        out += (words[i : i + total] ^ (words[i : i + total] >> np.uint64(29))) * _FACTORS[i]
    return out


def window_prints(words: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """SimHash of the windows of ``size`` words at ``starts``: bits set in over half of the words."""
    first = int(starts.min())
    part = words[first : int(starts.max()) + size].astype("<u8")
    bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    sums = np.vstack([np.zeros((1, 64), np.int64), bits.cumsum(axis=0, dtype=np.int64)])
    ones = sums[starts - first + size] - sums[starts - first]
    return np.packbits(2 * ones > size, axis=1, bitorder="little").view("<u8")[:, 0]


def share_block(prints: np.ndarray, other: int, radius: int) -> np.ndarray:
    """Which fingerprints agree with ``other`` in at least one of ``radius + 1`` blocks."""
    edges = np.linspace(0, 64, radius + 2).round().astype(int)
    apart = prints ^ np.uint64(other)
    found = np.zeros(len(prints), bool)
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        found |= (apart >> np.uint64(low)) & np.uint64((1 << (high - low)) - 1) == 0
    return found


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two shingle multisets."""
    left, right = Counter(a.tolist()), Counter(b.tolist())
    shared = sum((left & right).values())
    return shared / max(1, len(a) + len(b) - shared)


def item_table(items: list[tuple[int | None, str | None]]) -> dict:
    """Plain values of a block of items: words, fingerprint and shingles, and where shingles occur."""
    table: dict = {"ids": [], "words": [], "prints": [], "widths": []}
    where: dict[int, tuple[list, list]] = {}
    for item_id, text in items:
        words = word_hashes(text or "")
        if not len(words):
            continue
        index, width = len(table["ids"]), min(SHINGLE_WORDS, len(words))
        table["ids"].append(item_id)
        table["words"].append(words)
        table["widths"].append(width)
        table["prints"].append(int(window_prints(words, np.array([0]), len(words))[0]))
        keys, owners = where.setdefault(width, ([], []))
        unique = np.unique(shingles(words, width))
        keys.append(unique)
        owners.append(np.full(len(unique), index))
    table["index"] = {}
    for width, (keys, owners) in where.items():
        key, owner = np.concatenate(keys), np.concatenate(owners)
        order = np.argsort(key, kind="stable")
        seen = np.zeros(1 << _FILTER_BITS, bool)
        seen[key >> np.uint64(64 - _FILTER_BITS)] = True
        table["index"][width] = (key[order], owner[order], np.packbits(seen))
    return table


def _candidate_starts(places: np.ndarray, size: int, need: int, last: int) -> np.ndarray:
    """Starts of windows of ``size`` shingles that hold at least ``need`` of the sorted places."""
    if len(places) < need:
        return np.zeros(0, np.int64)
    left, right = places[: len(places) - need + 1], places[need - 1 :]
    low, high = np.maximum(right - size + 1, 0), np.minimum(left, last)
    fits = low <= high
    runs = [np.arange(a, b + 1) for a, b in zip(low[fits], high[fits], strict=True)]
    return np.unique(np.concatenate(runs)) if runs else np.zeros(0, np.int64)


def find_hits(text: str, table: dict, least: float = SIMILARITY, radius: int = RADIUS) -> list[dict]:
    """The best window per item of ``table`` in one text, where it is similar enough."""
    words, found = word_hashes(text), []
    for width, (keys, owners, packed) in table["index"].items():
        mine = shingles(words, width)
        at = (mine >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)
        maybe = np.flatnonzero(packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1)
        first = np.searchsorted(keys, mine[maybe], "left")
        count = np.searchsorted(keys, mine[maybe], "right") - first
        if not count.any():
            continue
        places = np.repeat(maybe, count)
        offsets = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        owner = owners[np.repeat(first, count) + offsets]
        for item in np.unique(owner):
            target = table["words"][item]
            size = min(len(target), len(words))
            theirs, span = shingles(target, width), size - width + 1
            need = math.ceil(least * (len(theirs) + span) / (1 + least) - 1e-9)
            starts = _candidate_starts(places[owner == item], span, max(1, need), len(words) - size)
            if not len(starts):
                continue
            prints = window_prints(words, starts, size)
            distance = np.bitwise_count(prints ^ np.uint64(table["prints"][item]))
            near = share_block(prints, table["prints"][item], radius) & (distance <= radius)
            graded = [(similarity(mine[s : s + span], theirs), -int(s), -int(d))
                      for s, d in zip(starts[near], distance[near], strict=True)]
            if graded and max(graded)[0] >= least:
                value, start, bits = max(graded)
                found.append({"item_id": table["ids"][item], "similarity": value, "word_start": -start,
                              "n_words": size, "distance": -bits})
    return sorted(found, key=lambda h: (h["item_id"] is None, h["item_id"] or 0, h["word_start"]))


def _hits(docs: DataFrame, table: dict, least: float, radius: int) -> Column:
    shared = docs.sparkSession.sparkContext.broadcast(table)
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("similarity", pa.float64()), ("word_start", pa.int32()),
                               ("n_words", pa.int32()), ("distance", pa.int32())]))

    def look(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            yield pa.array([find_hits(t or "", shared.value, least, radius) for t in column.to_pylist()], kind)

    look.__annotations__ = {"texts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(look, HIT)(F.col("text"))


def with_hits(docs: DataFrame, benchmark: DataFrame, least: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """The columns of ``docs`` plus ``hits``: the items each document holds, with their best window.

    ``benchmark`` has ``item_id`` and ``text``. Words are taken in lower case without marks; an item of
    fewer than five words is one shingle, a document shorter than an item is one window. Null and
    empty items and documents hit nothing; repeated items count once. Items are sent in tables of
    about ``ITEM_BLOCK``, all of them in one pass. A column ``hits`` in ``docs`` is replaced.
    """
    small_batches(docs.sparkSession)
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    blocks = max(1, -(-items.count() // ITEM_BLOCK))
    place = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    parts = []
    for block in range(blocks):
        rows = items.filter(place == block).collect()
        table = item_table(sorted(((r.item_id, r.text) for r in rows), key=str))
        parts.append(_hits(docs, table, least, radius))
    return docs.withColumn("hits", reduce(lambda a, b: F.concat(a, b), parts))


def without_hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no item."""
    looked = with_hits(docs.select(whole_row(docs).alias("_row"), "text"), benchmark)
    return looked.filter(F.size("hits") == 0).select("_row.*")
