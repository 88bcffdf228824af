"""A hashed maximum-entropy language model with class-factored softmax.

P(word | history) = P(class | history) · P(word | class). Classes are the hashed endings of words, the
end of a text has its own. P(class | history) is a maximum-entropy model: the previous word, the two
previous words, the word before the previous one and the last three classes are hashed into rows of
one weight table, and the rows' sums give the classes' scores. P(word | class) has the word alone as
its feature, for which the maximum-entropy solution is the smoothed relative count.

Training takes the documents in disjoint rounds. In each, every task starts from the common weights
and takes gradient steps on its own tokens; rows are then averaged by how often they were used.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches, stored, texts_as_bytes, words_of

CLASSES, ROWS, FEATURES = 32, 1 << 15, 4
END, END_CLASS = b"", CLASSES - 1
SMOOTHING = 0.1
#: Words whose counts are sent to every task: at most this many, 16 bytes each.
SHARED_WORDS = 1 << 19
STEP_TOKENS, SCORE_TOKENS = 4096, 1 << 13
#: Scores of tokens and classes may lie so far apart before each token needs a maximum of its own.
SPREAD = 60
CACHED_WORDS = 200_000
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)


class _Vocabulary(dict):
    """Number of a word in this task, with the word's hash and class."""

    def __init__(self):
        super().__init__()
        self.hashes: list[int] = []
        self.classes: list[int] = []

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self.hashes)
        self.hashes.append(xxhash.xxh64_intdigest(word))
        core = word.rstrip(b".,;:!?*$%&#|\"')") or word
        self.classes.append(xxhash.xxh64_intdigest(core[-3:]) % END_CLASS if word else END_CLASS)
        return number


@dataclass
class _Tokens:
    """Tokens of some documents, one after another, each document closed by its end."""

    hashes: np.ndarray
    classes: np.ndarray
    lengths: np.ndarray

    def features(self) -> np.ndarray:
        """Rows of the weight table by token and feature."""
        place = np.arange(len(self.hashes)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)

        def back(values: np.ndarray, steps: int) -> np.ndarray:
            moved = np.roll(values, steps)
            moved[place < steps] = 1
            return moved

        one, two = back(self.hashes, 1), back(self.hashes, 2)
        kinds = self.classes.astype(np.uint64) + np.uint64(2)
        recent = (back(kinds, 1) * np.uint64(64) + back(kinds, 2)) * np.uint64(64) + back(kinds, 3)
        mixed = [one * _MIX[0], (one ^ (two * _MIX[2])) * _MIX[1], (two ^ _MIX[0]) * _MIX[2], (recent + _MIX[1]) * _MIX[3]]
        return np.stack([(m >> np.uint64(64 - 15)).astype(np.int32) for m in mixed], axis=1)


def _tokenised(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, _Tokens]]:
    known = _Vocabulary()
    for batch in batches:
        if len(known) > CACHED_WORDS:
            known = _Vocabulary()
        parts, lengths = [], []
        for text in texts_as_bytes(batch.column("text")):
            words = words_of(text)
            words.append(END)
            lengths.append(len(words))
            parts.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
        ids = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        hashes, classes = np.array(known.hashes, np.uint64), np.array(known.classes, np.int64)
        yield batch, _Tokens(hashes[ids], classes[ids], np.array(lengths, np.int64))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, tokens in _tokenised(batches):
        keys, first, counts = np.unique(tokens.hashes, return_index=True, return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys.view(np.int64)), pa.array(tokens.classes[first].astype(np.int32)), pa.array(counts)],
            ["word", "class", "n"],
        )


def class_probabilities(weights: np.ndarray, bias: np.ndarray, rows: np.ndarray) -> np.ndarray:
    scores = weights.take(rows[:, 0], axis=0)
    for feature in range(1, FEATURES):
        scores += weights.take(rows[:, feature], axis=0)
    scores += bias
    # One bound for all tokens keeps the exponentials in range unless scores lie very far apart.
    highest = scores.max()
    if highest - scores.min() > SPREAD:
        highest = scores.max(axis=1, keepdims=True)
    scores -= highest
    np.exp(scores, out=scores)
    scores *= (1 / (scores @ np.ones(CLASSES, scores.dtype)))[:, None]
    return scores


def run_sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of the runs of rows that begin at ``starts``; overwrites ``values``.

    Rows are added in pairs, then pairs of pairs: most runs are one row, for which ``np.add.reduceat`` is slow.
    """
    lengths = np.diff(np.append(starts, len(values)))
    place = np.arange(len(values)) - np.repeat(starts, lengths)
    left = np.repeat(lengths, lengths) - place  # rows from here to the end of the run
    step, at = 1, np.arange(len(values))
    while True:
        at = at[(place[at] & (2 * step - 1) == 0) & (left[at] > step)]
        if not len(at):
            return values.take(starts, axis=0)
        values[at] += values.take(at + step, axis=0)
        step *= 2


class Learner:
    """Gradient steps on one task's tokens, from common weights."""

    def __init__(self, weights: np.ndarray, rate: float):
        self.weights, self.rate = weights[:ROWS].copy(), rate
        self.bias = weights[ROWS].copy()
        self.squares = np.full(ROWS, 1.0, np.float32)
        self.uses = np.zeros(ROWS + 1)

    def step(self, rows: np.ndarray, classes: np.ndarray) -> None:
        gap = class_probabilities(self.weights, self.bias, rows)
        gap[np.arange(len(classes)), classes] -= 1
        for feature in range(FEATURES):
            column = rows[:, feature].astype(np.uint16)  # 16 bits sort fastest
            order = np.argsort(column, kind="stable")
            column = column[order]
            starts = np.append(0, np.flatnonzero(column[1:] != column[:-1]) + 1)
            used = column[starts].astype(np.int64)
            slope = run_sums(gap.take(order, axis=0), starts)
            squares = self.squares[used] + np.einsum("ij,ij->i", slope, slope) / CLASSES
            self.squares[used] = squares
            slope *= (self.rate / np.sqrt(squares))[:, None]
            self.weights[used] = self.weights.take(used, axis=0) - slope
            self.uses[used] += np.diff(np.append(starts, len(column)))
        self.bias -= self.rate * (np.ones(len(gap), gap.dtype) @ gap / len(gap))
        self.uses[ROWS] += len(classes)


@dataclass(frozen=True)
class Training:
    rounds: int = 2
    rate: float = 0.25


@dataclass
class Model:
    """Weights (the last row is the bias) and what counts are needed to score."""

    weights: np.ndarray
    tokens: int
    words: int
    class_bits: np.ndarray
    shared_keys: np.ndarray
    shared_counts: np.ndarray


def _class_columns() -> list[str]:
    return [f"w{i}" for i in range(CLASSES)]


def _round(rows: DataFrame, weights: np.ndarray, rate: float) -> np.ndarray:
    """One round: each task learns from its tokens; rows are averaged by use."""
    shared = rows.sparkSession.sparkContext.broadcast(weights)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learner = Learner(shared.value, rate)
        for _, tokens in _tokenised(batches):
            features = tokens.features()
            for start in range(0, len(features), STEP_TOKENS):
                part = slice(start, start + STEP_TOKENS)
                learner.step(features[part], tokens.classes[part])
        used = np.flatnonzero(learner.uses)
        final = np.vstack([learner.weights, learner.bias])[used]
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(learner.uses[used]), *(pa.array(c) for c in final.T.copy())],
            ["row", "uses", *_class_columns()],
        )

    kinds = ", ".join(["row int", "uses double", *(f"{c} float" for c in _class_columns())])
    means = [(F.sum(F.col(c) * F.col("uses")) / F.sum("uses")).cast("float").alias(c) for c in _class_columns()]
    table = rows.mapInArrow(learn, kinds).groupBy("row").agg(*means).toArrow()  # ROWS + 1 rows at most
    out = weights.copy()
    if table.num_rows:
        out[table.column("row").to_numpy()] = np.column_stack([table.column(c).to_numpy() for c in _class_columns()])
    return out


def count_words(docs: DataFrame) -> DataFrame:
    """``(word, class, n)``: hashed words and ends of all documents, counted."""
    small_batches(docs.sparkSession)
    parts = docs.select("text").mapInArrow(_counted, "word long, class int, n long")
    return parts.groupBy("word").agg(F.min("class").alias("class"), F.sum("n").alias("n"))


def _most_frequent(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and counts of the commonest words, sorted by hash; at most ``SHARED_WORDS``."""
    size = F.floor(F.log2("n") * 8)
    bins = counts.groupBy(size.alias("bin")).count().orderBy(F.desc("bin")).collect()  # about 8 per doubling
    total, least = 0, None
    for row in bins:
        total += row["count"]
        if total > SHARED_WORDS:
            break
        least = row["bin"]
    if least is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    table = counts.filter(size >= least).select("word", "n").toArrow()
    keys, n = table.column("word").to_numpy(), table.column("n").to_numpy()
    order = np.argsort(keys)
    return keys[order], n[order]


def train(docs: DataFrame, counts: DataFrame, key: Column, training: Training | None = None) -> Model:
    """Fit on all of ``docs``, dealt into rounds by the hashed ``key``; ``counts`` are its words."""
    training = training or Training()
    small_batches(docs.sparkSession)
    sums = counts.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect()
    n, words = np.zeros(CLASSES), np.zeros(CLASSES)
    for row in sums:
        n[row["class"]], words[row["class"]] = row["n"], row["words"]
    weights = np.zeros((ROWS + 1, CLASSES), np.float32)
    weights[ROWS] = np.log((n + SMOOTHING) / (n + SMOOTHING).sum())  # without context: single words
    for number in range(training.rounds):
        turn = F.pmod(F.xxhash64(key), F.lit(training.rounds)) == number
        weights = _round(docs.filter(turn).select("text"), weights, training.rate)
    keys, shared = _most_frequent(counts)
    return Model(weights, int(n.sum()), int(words.sum()), np.log10(n + SMOOTHING * (words + 1)), keys, shared)


def _rare_words(tokens: _Tokens, rare: np.ndarray) -> pa.Array:
    """For each document its different rare words and how often it has them."""
    doc = np.repeat(np.arange(len(tokens.lengths)), tokens.lengths)[rare]
    words = tokens.hashes.view(np.int64)[rare]
    order = np.lexsort((words, doc))
    doc, words = doc[order], words[order]
    new = np.ones(len(words), bool)
    new[1:] = (words[1:] != words[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    counts = np.diff(np.append(at, len(words)))
    ends = np.searchsorted(doc[at], np.arange(len(tokens.lengths) + 1)).astype(np.int32)
    pairs = pa.StructArray.from_arrays([pa.array(words[at]), pa.array(counts)], ["word", "n"])
    return pa.ListArray.from_arrays(pa.array(ends), pairs)


def _scored(shared):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(**shared.value)
        weights, bias = model.weights[:ROWS], model.weights[ROWS]
        for batch, tokens in _tokenised(batches):
            rows, total = tokens.features(), len(tokens.hashes)
            classes = np.zeros(total)
            for start in range(0, total, SCORE_TOKENS):
                part = slice(start, start + SCORE_TOKENS)
                p = class_probabilities(weights, bias, rows[part])
                classes[part] = np.log10(p[np.arange(len(p)), tokens.classes[part]])
            classes -= model.class_bits[tokens.classes]
            keys, inverse = np.unique(tokens.hashes.view(np.int64), return_inverse=True)
            at = np.minimum(np.searchsorted(model.shared_keys, keys), max(0, len(model.shared_keys) - 1))
            found = model.shared_keys[at] == keys if len(model.shared_keys) else np.zeros(len(keys), bool)
            logs = np.where(found, np.log10(model.shared_counts[at] + SMOOTHING), 0.0) if found.any() else np.zeros(len(keys))
            token_logs, token_found = logs[inverse], found[inverse]
            ends = np.cumsum(tokens.lengths)
            starts = ends - tokens.lengths
            rare = _rare_words(tokens, ~token_found)
            sums = [np.add.reduceat(v, starts) if len(starts) else np.zeros(0)
                    for v in (token_found.astype(np.int64), token_logs, classes)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(tokens.lengths), pa.array(sums[0].astype(np.int64)),
                 pa.array(sums[1]), pa.array(sums[2]), rare],
                ["doc_id", "n_tokens", "n_shared", "shared_logs", "class_logs", "rare"],
            )

    return score


def score(docs: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """``(doc_id, n_tokens, n_known, base_score, score)`` for every row of ``docs``.

    ``base_score`` is the smoothed log10 probability of single words, ``score`` that of the model. Null
    and empty texts are one token, the end. Repeated rows come out as often as they came in; other
    columns are not read. Words beyond the shared ones are looked up by a join, so no count is
    dropped however many words there are.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))  # plain values only
    kinds = (
        "doc_id long, n_tokens long, n_shared long, shared_logs double, class_logs double,"
        " rare array<struct<word:bigint,n:bigint>>"
    )
    parts = docs.select("doc_id", "text").mapInArrow(_scored(shared), kinds)
    parts = stored(parts.withColumn("row", F.monotonically_increasing_id()), "parts")
    rare = parts.select("row", F.explode("rare").alias("r")).select("row", "r.word", F.col("r.n").alias("times"))
    looked = rare.join(counts.select("word", "n"), "word", "left")
    logs = F.log10(F.coalesce("n", F.lit(0)) + SMOOTHING) * F.col("times")
    sums = looked.groupBy("row").agg(
        F.sum(logs).alias("rare_logs"), F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("n_rare")
    )
    both = parts.drop("rare").join(sums, "row", "left")
    words = F.col("shared_logs") + F.coalesce("rare_logs", F.lit(0.0))
    whole = float(np.log10(model.tokens + SMOOTHING * (model.words + 1)))
    return both.select(
        "doc_id",
        "n_tokens",
        (F.col("n_shared") + F.coalesce("n_rare", F.lit(0))).alias("n_known"),
        (words - F.col("n_tokens") * whole).alias("base_score"),
        (words + F.col("class_logs")).alias("score"),
    )
