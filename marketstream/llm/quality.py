"""Quality by ordinal cumulative-link regression on graded ratings.

P(grade > k) = sigmoid(w·x - t_k): one weight vector for all grades, thresholds t in rising order. x
is the text hashed: frequencies of byte trigrams and of word shapes, and a few ratios.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hashed_sample, small_batches, texts_as_bytes, whole_row

HASHED, RATIOS = 2048, 8
WIDTH = HASHED + RATIOS
#: Bytes worked on at a time: bounds memory on very long texts.
BLOCK = 1 << 20
#: Classes of bytes: lower, upper, digit, white space, other ASCII, beyond ASCII.
_CLASS = np.full(256, 4, np.uint8)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 0, 1, 2
_CLASS[[9, 10, 11, 12, 13, 32]] = 3
_CLASS[128:] = 5


def features(text: bytes) -> np.ndarray:
    """Square roots of hashed trigram frequencies, then ratios; all zero for an empty text."""
    x = np.zeros(WIDTH)
    if not text:
        return x
    classes, counts = np.zeros(6), np.zeros(HASHED)
    for start in range(0, len(text), BLOCK):
        data = np.frombuffer(text[start : start + BLOCK + 2], np.uint8)
        classes += np.bincount(_CLASS[data[:BLOCK]], minlength=6)
        wide = data.astype(np.uint32)
        if len(wide) > 2:
            trigrams = (wide[:-2] * 65599 + wide[1:-1]) * 65599 + wide[2:]
            counts += np.bincount((trigrams * np.uint32(2654435761)) >> 21, minlength=HASHED)
    x[:HASHED] = np.sqrt(counts / max(1.0, counts.sum()))
    words, lines = text.split(), text.split(b"\n")
    ratios = classes / len(text)
    x[HASHED : HASHED + 5] = ratios[[1, 2, 3, 4, 5]]
    x[HASHED + 5] = len(set(words)) / max(1, len(words))
    x[HASHED + 6] = len(set(lines)) / len(lines)
    x[HASHED + 7] = min(1.0, np.log1p(len(text)) / 12)
    return x


@dataclass(frozen=True)
class Training:
    """At most about ``sample`` labelled rows are fitted, chosen by hashed id: a stated bound."""

    sample: int = 6000
    epochs: int = 30
    rate: float = 0.05
    decay: float = 1e-5
    seed: int = 8


@dataclass
class Model:
    grades: list[int]
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, x: np.ndarray) -> np.ndarray:
        """P(grade > g) for each grade but the last, per row."""
        scores = np.clip(x @ self.weights, -30, 30)[:, None] - self.thresholds
        return 1 / (1 + np.exp(-scores))

    def expected(self, tails: np.ndarray) -> np.ndarray:
        return self.grades[0] + tails @ np.diff(np.array(self.grades, float))


def fit(x: np.ndarray, grade: np.ndarray, training: Training) -> Model:
    """Gradient descent with momentum-free adaptive steps on the likelihood of the observed grades."""
    grades = sorted({int(g) for g in grade})
    if len(grades) < 2:
        return Model(grades or [0], np.zeros(x.shape[1]), np.zeros(max(0, len(grades) - 1)))
    level = np.searchsorted(grades, grade)
    cuts = np.arange(len(grades) - 1)
    above = level[:, None] > cuts
    share = np.clip(above.mean(axis=0), 1e-3, 1 - 1e-3)
    weights, thresholds = np.zeros(x.shape[1]), -np.log(share / (1 - share))
    squares_w, squares_t = np.full(x.shape[1], 1e-8), np.full(len(cuts), 1e-8)
    order = np.random.default_rng(training.seed)
    for _ in range(training.epochs):
        for rows in np.array_split(order.permutation(len(x)), max(1, len(x) // 64)):
            part, lev = x[rows].astype(float), level[rows]
            tail = 1 / (1 + np.exp(-(np.clip(part @ weights, -30, 30)[:, None] - thresholds)))
            edge = np.hstack([np.ones((len(rows), 1)), tail, np.zeros((len(rows), 1))])
            at = np.arange(len(rows))
            high, low = edge[at, lev], edge[at, lev + 1]
            slope_high, slope_low = high * (1 - high), low * (1 - low)
            mass = np.maximum(high - low, 1e-9)
            pull = (slope_high - slope_low) / mass  # d log P / d score
            move_w = part.T @ pull / len(rows) - training.decay * weights
            move_t = np.zeros(len(cuts))
            np.add.at(move_t, lev[lev > 0] - 1, -(slope_high / mass)[lev > 0])
            inner = lev < len(cuts)
            np.add.at(move_t, lev[inner], (slope_low / mass)[inner])
            move_t /= len(rows)
            squares_w += move_w**2
            squares_t += move_t**2
            weights += training.rate * move_w / np.sqrt(squares_w)
            thresholds += training.rate * move_t / np.sqrt(squares_t)
            thresholds = np.maximum.accumulate(thresholds)
    return Model(grades, weights, thresholds)


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [features(t).astype(np.float32).tobytes() for t in texts_as_bytes(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("grade").cast(pa.int32()), pa.array(rows, pa.binary())], ["grade", "x"]
        )


def train(docs: DataFrame, ratings: DataFrame, training: Training | None = None) -> Model:
    """Fit on ``ratings(doc_id, grade)``. Rows without id or grade are left out.

    The chosen ids are a few thousand at most, so they are sent to every task. Of rows that share a chosen
    id, the least text is learned. Only features reach the driver: ``sample`` rows of 8 KB.
    """
    training = training or Training()
    small_batches(docs.sparkSession)
    rated = ratings.select("doc_id", "grade").filter("doc_id is not null and grade is not null")
    rated = rated.groupBy("doc_id").agg(F.min("grade").alias("grade"))
    rate = min(1.0, training.sample / max(1, rated.count()))
    chosen = hashed_sample(rated, F.col("doc_id"), rate, training.seed) if rate < 1 else rated
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = rows.groupBy("doc_id", "grade").agg(F.min("text").alias("text")).select("grade", "text")
    table = rows.mapInArrow(_extracted, "grade int, x binary").toArrow()
    if not table.num_rows:
        return Model([0], np.zeros(WIDTH), np.zeros(0))
    grade, x = table.column("grade").to_numpy(), np.empty((table.num_rows, WIDTH), np.float32)
    for i, packed in enumerate(table.column("x")):  # no list of rows, whose memory would stay with the driver
        x[i] = np.frombuffer(packed.as_buffer(), np.float32)
    del table, packed
    pa.default_memory_pool().release_unused()
    order = np.lexsort((grade, x.view(f"S{x.itemsize * WIDTH}")[:, 0]))  # the same fit on every run
    x = x[order]
    return fit(x, grade[order], training)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """The columns of ``docs`` plus ``expected_grade`` and ``tail`` (double).

    ``tail`` is P(grade > lowest grade). Every row gets both: null and empty texts score by the
    thresholds alone, and a model of fewer than two grades gives its grade and 0. Columns of these
    names in ``docs`` are replaced; only the text goes through Python.
    """
    small_batches(docs.sparkSession)

    def scored(text: pa.Array) -> pa.Array:
        texts = texts_as_bytes(text)
        values = [np.zeros((0, len(model.thresholds)))]
        for start in range(0, len(texts), 256):
            values.append(model.tails(np.array([features(t) for t in texts[start : start + 256]])))
        tails = np.vstack(values)
        tail = tails[:, 0] if tails.shape[1] else np.zeros(len(texts))
        return pa.StructArray.from_arrays(
            [pa.array(model.expected(tails)), pa.array(tail)], ["expected_grade", "tail"]
        )

    both = F.arrow_udf(scored, "struct<expected_grade:double,tail:double>")(F.col("text"))
    graded = docs.drop("expected_grade", "tail", "_graded").withColumn("_graded", both)
    return graded.select("*", "_graded.*").drop("_graded")


def select(docs: DataFrame, model: Model, least_tail: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose probability of a better than the lowest grade is high enough."""
    graded = score(docs.select(whole_row(docs).alias("_row"), "text"), model)
    return graded.filter(F.col("tail") >= least_tail).select("_row.*")
