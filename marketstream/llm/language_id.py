"""Language by cross-parsing: the language whose text explains a document in fewest phrases.

Per language a suffix automaton of a sample of labelled text recognises every substring of it. A
document is cut from left to right into the longest substrings that the automaton knows; phrases are
weighed by the bits it takes to point into that language's text.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches

UNKNOWN = "und"
#: Symbols: 0 for anything but letters, 1 to 62 for the commonest letters, 63 for letters that no sample
#: has, 64 and more for all other letters of the samples; these have their transitions in a sorted array.
SYMBOLS, OTHER = 64, 63
#: Texts are parsed in pieces of this many symbols; a piece begins a new phrase.
PIECE = 2048
FAIL = np.int32(1 << 30)


@dataclass(frozen=True)
class Training:
    """Bounds of the sample of labelled text: letters per language, and over all languages.

    ``documents`` different texts per language give at most ``window`` characters each, from a hashed
    place.
    """

    letters: int = 30_000
    all_letters: int = 1_000_000
    documents: int = 150
    window: int = 800
    seed: int = 6


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the automaton that accepts all substrings; state 0 is the start."""
    nexts: list[dict[int, int]] = [{}]
    links, lengths, last = [-1], [0], 0
    for symbol in symbols:
        state = len(nexts)
        nexts.append({})
        links.append(0)
        lengths.append(lengths[last] + 1)
        at = last
        while at >= 0 and symbol not in nexts[at]:
            nexts[at][symbol] = state
            at = links[at]
        if at >= 0:
            target = nexts[at][symbol]
            if lengths[target] == lengths[at] + 1:
                links[state] = target
            else:
                copy = len(nexts)
                nexts.append(dict(nexts[target]))
                links.append(links[target])
                lengths.append(lengths[at] + 1)
                links[target] = links[state] = copy
                while at >= 0 and nexts[at].get(symbol) == target:
                    nexts[at][symbol] = copy
                    at = links[at]
        last = state
    return nexts


def dense(nexts: list[dict[int, int]]) -> np.ndarray:
    """Next state by state and symbol; where there is none, the state after a restart, plus ``FAIL``.

    The last state follows a symbol that the text lacks: such a symbol is a phrase of its own.
    """
    lost = len(nexts)
    restart = np.full(SYMBOLS, lost, np.int32)
    for symbol, state in nexts[0].items():
        if symbol < SYMBOLS:
            restart[symbol] = state
    table = np.tile(restart | FAIL, (lost + 1, 1))
    table[0] = restart
    for state, row in enumerate(nexts):
        for symbol, target in row.items():
            if symbol < SYMBOLS:
                table[state, symbol] = target
    return table


def sparse(nexts: list[dict[int, int]], at: int) -> tuple[np.ndarray, np.ndarray]:
    """Transitions by letters beyond the dense table: state and symbol as one sorted key, next state."""
    found = sorted((_key(i + at, c), target + at) for i, row in enumerate(nexts) for c, target in row.items() if c >= SYMBOLS)
    keys, targets = zip(*found, strict=True) if found else ((), ())
    return np.array(keys, np.int64), np.array(targets, np.int32)


def _key(state, symbol):
    return state * 0x200000 + symbol


@dataclass
class Model:
    languages: list[str]
    symbol_of: np.ndarray
    table: np.ndarray
    starts: np.ndarray
    bits: np.ndarray
    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    targets: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))


def _symbol_table(letters: list[str]) -> np.ndarray:
    """Symbol of each code point."""
    table = np.zeros(0x110000, np.int32)
    for point in range(0x110000):
        if unicodedata.category(chr(point))[0] == "L":
            table[point] = OTHER
    for i, letter in enumerate(letters):
        table[ord(letter)] = i + 1 if i < OTHER - 1 else i + 2
    return table


def symbols_of(text: str, symbol_of: np.ndarray) -> np.ndarray:
    """Lowered text as symbols, runs of 0 as one."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    found = symbol_of[points]
    return found[(found != 0) | (np.append(found.dtype.type(0), found[:-1]) != 0)]


def joined(windows: list[np.ndarray], limit: int) -> np.ndarray:
    """Windows one after another, each followed by a 0, cut to the greatest length with ``limit`` symbols at most."""
    low, high = 0, max(map(len, windows), default=0)
    while low < high:
        middle = (low + high + 1) // 2
        fits = sum(min(len(w), middle) + 1 for w in windows) <= limit
        low, high = (middle, high) if fits else (low, middle - 1)
    return np.concatenate([np.append(w[:low], 0) for w in windows]).astype(np.int32)


def train(docs: DataFrame, usable: Column | None = None, training: Training | None = None) -> Model:
    """Fit on rows of ``docs(doc_id, text, lang)`` with a language, those that are ``usable`` if given.

    The sample of a language are the ``documents`` different texts of least hash, so copies count
    once. Each gives one window; where they have more than ``letters`` together, all are cut to one
    length, so every text of the sample is learned.
    """
    training = training or Training()
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs if usable is None else docs.filter(usable)
    rows = rows.filter("lang is not null and text is not null and doc_id is not null").select("doc_id", "text", "lang")
    rows = rows.select("lang", "text", F.xxhash64("text", F.lit(training.seed)).alias("place"))
    sizes = {r.lang: r.texts for r in rows.groupBy("lang").agg(F.countDistinct("place").alias("texts")).collect()}
    if not sizes:
        return Model([], np.zeros(0x110000, np.int32), np.zeros((0, SYMBOLS), np.int32), np.zeros(0, np.int32), np.zeros(0))
    # Twice as many as needed pass the rate; the exact number is taken of these.
    rates = spark.createDataFrame(
        [(lang, min(1.0, (2 * training.documents + 50) / size)) for lang, size in sizes.items()], "lang string, rate double"
    )
    buckets = 1 << 30
    drawn = F.pmod("place", F.lit(buckets)) < F.col("rate") * buckets
    spare = F.greatest(F.length("text") - training.window, F.lit(0))
    start = F.pmod(F.xxhash64("text"), spare + 1).cast("int") + 1
    windows = rows.join(F.broadcast(rates), "lang").filter(drawn)
    windows = windows.select("lang", "place", F.substring("text", start, F.lit(training.window)).alias("text"))
    windows = windows.groupBy("lang", "place").agg(F.min("text").alias("text"))
    order = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("place", F.lit(buckets)), "place"))
    chosen = windows.withColumn("at", order).filter(F.col("at") <= training.documents).orderBy("lang", "at").collect()
    limit = min(training.letters, training.all_letters // len(sizes))
    samples: dict[str, list[str]] = {}
    for row in chosen:
        samples.setdefault(row.lang, []).append(row.text)
    counts = Counter(c for texts in samples.values() for t in texts for c in t.lower() if unicodedata.category(c)[0] == "L")
    symbol_of = _symbol_table([c for c, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))])
    languages, tables, rare, starts, bits, at = sorted(samples), [], [], [], [], 0
    for language in languages:
        symbols = joined([symbols_of(t, symbol_of) for t in samples[language]], limit)
        nexts = suffix_automaton(symbols.tolist())
        table = dense(nexts)
        rare.append(sparse(nexts, at))
        tables.append(table + np.int32(at))
        starts.append(at)
        bits.append(np.log2(max(2, len(symbols))))
        at += len(table)
    keys, targets = (np.concatenate(part) for part in zip(*rare, strict=True))
    return Model(languages, symbol_of, np.vstack(tables), np.array(starts, np.int32), np.array(bits), keys, targets)


def _rare_steps(states: np.ndarray, symbols: np.ndarray, model: Model) -> np.ndarray:
    """As ``dense`` has it, next states by letters that are in the sorted array only."""

    def known(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        wanted = _key(at.astype(np.int64), symbols)
        if not len(model.keys):
            return np.zeros(at.shape, bool), np.zeros(at.shape, np.int32)
        place = np.minimum(np.searchsorted(model.keys, wanted), len(model.keys) - 1)
        return model.keys[place] == wanted, model.targets[place]

    first = model.starts[:, None]
    lost = np.append(model.starts[1:], np.int32(len(model.table)))[:, None] - np.int32(1)
    there, target = known(states)
    begins, restart = known(np.broadcast_to(first, states.shape))
    restart = np.where(begins, restart, lost)
    return np.where(there, target, np.where(states == first, restart, restart | FAIL))


def phrases(pieces: list[np.ndarray], model: Model) -> np.ndarray:
    """Number of phrases by piece and language; all pieces and languages advance together."""
    lengths = np.array([len(p) for p in pieces], np.int64)
    order = np.argsort(-lengths, kind="stable")
    grid = np.zeros((int(lengths.max(initial=0)), len(pieces)), np.int32)
    for column, i in enumerate(order):
        grid[: lengths[i], column] = pieces[i]
    running = np.searchsorted(-lengths[order], -np.arange(1, len(grid) + 1), side="right")
    flat, mask = model.table.ravel(), FAIL - np.int32(1)
    states = np.repeat(model.starts[:, None], len(pieces), axis=1)
    count = np.zeros_like(states)
    for row, active in zip(grid, running, strict=True):
        found = flat.take((states[:, :active] << 6) + np.minimum(row[:active], OTHER))
        if row[:active].max() >= SYMBOLS:
            rare = np.flatnonzero(row[:active] >= SYMBOLS)
            found[:, rare] = _rare_steps(states[:, rare], row[rare], model)
        count[:, :active] += found >> 30
        np.bitwise_and(found, mask, out=states[:, :active])
    out = np.zeros((len(pieces), len(model.starts)))
    out[order] = count.T + 1
    return out


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """The columns of ``docs`` plus ``lang_pred`` and ``lang_score``.

    ``lang_pred`` is the language with the least cost per symbol, the first by name in a tie, and
    ``und`` with score 0 for text that is null, has no letter, or if no language was learned. The
    score is the share of the best language, others weighed by how much more they cost. Columns of
    these names in ``docs`` are replaced; only the text goes through Python.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))  # plain values only

    def predicted(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = Model(**shared.value)
        for column in texts:
            names, scores = [UNKNOWN] * len(column), np.zeros(len(column))
            pieces: list[np.ndarray] = []
            owner: list[int] = []
            sizes = np.zeros(len(column))
            for i, text in enumerate(column.to_pylist()):
                symbols = symbols_of(text or "", known.symbol_of)
                if known.languages and symbols.any():
                    sizes[i] = len(symbols)
                    cut = [symbols[s : s + PIECE] for s in range(0, len(symbols), PIECE)]
                    pieces += cut
                    owner += [i] * len(cut)
            if pieces:
                found, where = np.zeros((len(column), len(known.languages))), np.array(owner)
                np.add.at(found, where, phrases(pieces, known))
                rows = np.flatnonzero(sizes)
                cost = found[rows] * known.bits / sizes[rows][:, None]
                best = cost.argmin(axis=1)
                least = cost.min(axis=1, keepdims=True)
                share = 1 / np.exp(-8 * (cost - least) / least).sum(axis=1)
                for i, b, s in zip(rows, best, share, strict=True):
                    names[i], scores[i] = known.languages[b], s
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores)], ["lang_pred", "lang_score"])

    predicted.__annotations__ = {"texts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    both = F.arrow_udf(predicted, "struct<lang_pred:string,lang_score:double>")(F.col("text"))
    named = docs.drop("lang_pred", "lang_score", "_named").withColumn("_named", both)
    return named.select("*", "_named.*").drop("_named")
