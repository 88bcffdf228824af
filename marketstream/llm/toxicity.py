"""Toxic spans by a linear-chain conditional random field over words.

Labelled tokens come from labelled documents: a word, or the beginning of a word, that occurs in many
surroundings in toxic documents and hardly elsewhere marks its tokens there. On these the field is
fitted; its features are hashes of the word, its beginnings and its endings, so unseen forms of a
stem are found as well. Forward-backward gives the probability of each token to be toxic; a document
is scored by the largest and the sum of these, and spans are runs of likely tokens.

The sampled documents are learned whole. Their tokens stay in Spark: counts that label tokens, and the
summaries on which scores are calibrated, are made in tasks. The driver gets counts of marking features,
a bounded number of windows of forty words, and two numbers per document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hashed_sample, small_batches, stored, texts_as_bytes, words_of

BUCKETS = 1 << 22
#: Which features may label a token: the word and its two longer beginnings.
LABELLING, FEATURES = 3, 6
WINDOW = 40
CACHED_WORDS = 400_000
#: Words that one row carries of a text; a longer text has several rows.
SEGMENT = 20_000
_EDGE = b".,;:!?\"'()[]{}*$%&#|<>-_"


def word_features(word: bytes) -> list[int]:
    """Hashes of the word, its first 5, 4 and 3 bytes and its last 4 and 3; marks around it ignored."""
    core = word.strip(_EDGE) or word
    parts = (b"w" + core, b"5" + core[:5], b"4" + core[:4], b"3" + core[:3], b"e" + core[-4:], b"f" + core[-3:])
    return [xxhash.xxh64_intdigest(part) % BUCKETS for part in parts]


@dataclass(frozen=True)
class Training:
    """Bounds of the sample: ``documents`` labelled rows, whole, and ``windows`` of 40 words to fit on.

    ``evidence``: bits by which a feature's toxic surroundings must exceed chance to label tokens;
    ``purity``: share of its occurrences that must be in toxic documents.
    """

    documents: int = 6000
    windows: int = 80_000
    evidence: float = 18.0
    purity: float = 0.9
    epochs: int = 6
    rate: float = 0.3
    seed: int = 5


@dataclass
class Field:
    """Emission weights by feature, log transition scores [from, to], score calibration."""

    weights: dict[int, float] = field(default_factory=dict)
    bias: float = -6.0
    transitions: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    calibration: tuple[float, float, float] = (-4.0, 0.0, 0.0)


class _Emissions(dict):
    """Emission score of a word, remembered; emptied when it grows too large."""

    def __init__(self, model: Field):
        super().__init__()
        self.model = model

    def __missing__(self, word: bytes) -> float:
        weights = self.model.weights
        value = self.model.bias + sum(weights.get(f, 0.0) for f in word_features(word))
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = value
        return value


def marginals(emissions: np.ndarray, lengths: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """P(toxic) of each token; sequences lie one after another in ``emissions``."""
    return forward_backward(emissions, lengths, transitions)[1]


def forward_backward(
    emissions: np.ndarray, lengths: np.ndarray, transitions: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """P(toxic) of each token given what comes up to it, and given its whole sequence.

    A sequence follows a clean token.

    All sequences advance together, the longest first, so a step costs the ones still running.
    """
    out, forward = np.zeros(len(emissions)), np.zeros(len(emissions))
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] > 0]
    if not len(order):
        return forward, out
    starts = (np.cumsum(lengths) - lengths)[order]
    running = np.searchsorted(-lengths[order], -np.arange(1, lengths.max() + 1), side="right")
    odds = np.exp(np.clip(emissions, -30, 30))
    (oo, ot), (to, tt) = np.exp(transitions)
    toxic = np.zeros(len(order))
    for step, count in enumerate(running):
        at = starts[:count] + step
        last = toxic[:count]
        up = (ot + last * (tt - ot)) * odds[at]
        toxic = up / (up + oo + last * (to - oo))
        forward[at] = toxic
    clean_b, toxic_b = np.ones(len(order)), np.ones(len(order))
    for step in range(len(running) - 1, -1, -1):
        at = starts[: running[step]] + step
        a, clean, tox = forward[at], clean_b[: running[step]], toxic_b[: running[step]]
        up = a * tox
        out[at] = up / (up + (1 - a) * clean)
        ahead = odds[at] * tox
        new_clean, new_tox = oo * clean + ot * ahead, to * clean + tt * ahead
        scale = 1 / (new_clean + new_tox)
        clean_b[: running[step]], toxic_b[: running[step]] = new_clean * scale, new_tox * scale
    return forward, out


def _summary(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Largest and log sum of the marginals per document; zero without words."""
    rows = np.zeros((len(lengths), 2))
    full = np.flatnonzero(lengths)
    if len(full):
        starts = (np.cumsum(lengths) - lengths)[full]
        rows[full, 0] = np.maximum.reduceat(values, starts)
        rows[full, 1] = np.log1p(np.add.reduceat(values, starts))
    return rows


def _tokens(packed: bytes) -> np.ndarray:
    """A row of features per word."""
    return np.frombuffer(packed, np.uint32).reshape(-1, FEATURES)


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[bytes, list[int]] = {}
    for batch in batches:
        texts = texts_as_bytes(batch.column("text"))
        for doc, toxic, text in zip(batch.column("doc").to_pylist(), batch.column("toxic").to_pylist(), texts, strict=True):
            words = words_of(text)
            for part, start in enumerate(range(0, len(words) or 1, SEGMENT)):
                rows = []
                for word in words[start : start + SEGMENT]:
                    if word not in known:
                        if len(known) >= CACHED_WORDS // 4:
                            known.clear()
                        known[word] = word_features(word)
                    rows.append(known[word])
                packed = np.array(rows, np.uint32).tobytes()
                columns = [pa.array([doc], pa.string()), pa.array([part], pa.int32()), pa.array([toxic], pa.int32()), pa.array([packed], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc", "part", "toxic", "tokens"])


def _places(found: list[tuple[int, np.ndarray]]) -> tuple[pa.Array, pa.Array]:
    places = np.concatenate([np.full(len(ids), place, np.int32) for place, ids in found])
    return pa.array(places), pa.array(np.concatenate([ids for _, ids in found]).astype(np.int32))


def _seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Which labelling features occur in which document."""
    for batch in batches:
        for doc, toxic, packed in zip(*(batch.column(c).to_pylist() for c in ("doc", "toxic", "tokens")), strict=True):
            tokens = _tokens(packed)
            place, ids = _places([(p, np.unique(tokens[:, p])) for p in range(LABELLING)])
            yield pa.RecordBatch.from_arrays(
                [place, ids, pa.array([doc] * len(ids), pa.string()), pa.array(np.full(len(ids), toxic, np.int32))],
                ["place", "id", "doc", "toxic"],
            )


def _surroundings(wanted: list[np.ndarray]):
    """The words before the wanted features in toxic documents."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for toxic, packed in zip(*(batch.column(c).to_pylist() for c in ("toxic", "tokens")), strict=True):
                tokens = _tokens(packed).astype(np.int64)
                if not toxic or not len(tokens):
                    continue
                before = np.concatenate([[BUCKETS], tokens[:-1, 0]])
                pairs = []
                for place in range(LABELLING):
                    here = np.isin(tokens[:, place], wanted[place])
                    pairs.append((place, np.unique(tokens[here, place] * (BUCKETS + 1) + before[here])))
                place, _ = _places([(p, both // (BUCKETS + 1)) for p, both in pairs])
                both = np.concatenate([both for _, both in pairs])
                yield pa.RecordBatch.from_arrays(
                    [place, pa.array((both // (BUCKETS + 1)).astype(np.int32)), pa.array((both % (BUCKETS + 1)).astype(np.int32))],
                    ["place", "id", "before"],
                )

    return look


def marking_features(sample: DataFrame, training: Training) -> list[np.ndarray]:
    """Per place the features that mark toxic documents; ``sample`` has a row of features per word.

    Toxic occurrences count once per document and once per preceding word, whichever is less, so
    neither a long document nor copies of one weigh much.
    """
    seen = sample.mapInArrow(_seen, "place int, id int, doc string, toxic int").distinct()
    counts = seen.groupBy("place", "id").agg(F.sum("toxic").alias("toxic"), F.count("*").alias("docs"))
    counts = stored(counts, "feature-counts")
    bits = [0.0] * LABELLING
    for place, toxic, docs in counts.groupBy("place").agg(F.sum("toxic"), F.sum("docs")).collect():
        bits[place] = -np.log2(max(1e-3, 1 - (docs - toxic) / max(1, docs)))
    bit = F.element_at(F.array(*map(F.lit, bits)), F.col("place") + 1)

    def marks(there: str) -> Column:
        clean = F.col("docs") - F.col("toxic")
        return (F.col(there) * bit >= training.evidence) & (F.col(there) >= training.purity * (F.col(there) + clean))

    likely = counts.filter(marks("toxic"))
    wanted: list[list[int]] = [[] for _ in range(LABELLING)]
    for place, number in likely.select("place", "id").collect():
        wanted[place].append(number)
    found = sample.mapInArrow(_surroundings([np.array(w, np.int64) for w in wanted]), "place int, id int, before int")
    contexts = found.distinct().groupBy("place", "id").agg(F.count("*").alias("contexts"))
    both = likely.join(contexts, ["place", "id"]).withColumn("there", F.least("contexts", "toxic"))
    out: list[list[int]] = [[] for _ in range(LABELLING)]
    for place, number in both.filter(marks("there")).select("place", "id").collect():
        out[place].append(number)
    return [np.array(sorted(ids), np.int64) for ids in out]


def label_tokens(tokens: np.ndarray, toxic: int, marks: list[np.ndarray]) -> np.ndarray:
    """1 for the tokens of a toxic document that have a marking feature."""
    labels = np.zeros(len(tokens), np.int8)
    if toxic:
        for place, ids in enumerate(marks):
            labels |= np.isin(tokens[:, place], ids)
    return labels


def _counted(marks: list[np.ndarray]):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = total = 0
        for batch in batches:
            for toxic, packed in zip(*(batch.column(c).to_pylist() for c in ("toxic", "tokens")), strict=True):
                tokens = _tokens(packed)
                marked, total = marked + int(label_tokens(tokens, toxic, marks).sum()), total + len(tokens)
        yield pa.RecordBatch.from_arrays([pa.array([marked]), pa.array([total])], ["marked", "total"])

    return count


def _windows(marks: list[np.ndarray], marked_rate: float, random_rate: float, seed: int):
    """Windows around marked tokens, and around as many others as the rate gives."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("doc", "part", "toxic", "tokens")), strict=True)
            for doc, part, toxic, packed in rows:
                tokens = _tokens(packed)
                if not len(tokens):
                    continue
                random = np.random.default_rng([seed, xxhash.xxh64_intdigest(doc), part])
                labels = label_tokens(tokens, toxic, marks)
                marked = np.flatnonzero(labels)
                marked = marked[random.random(len(marked)) < marked_rate]
                others = random.integers(0, len(tokens), random.binomial(len(tokens), random_rate))
                middles = np.concatenate([marked, others])
                size = min(WINDOW, len(tokens))
                starts = np.clip(middles - WINDOW // 2, 0, len(tokens) - size)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([tokens[s : s + size].tobytes() for s in starts], pa.binary()),
                        pa.array([labels[s : s + size].tobytes() for s in starts], pa.binary()),
                    ],
                    ["tokens", "labels"],
                )

    return cut


def fit_field(tokens: np.ndarray, labels: np.ndarray, lengths: np.ndarray, training: Training) -> Field:
    """Likelihood ascent over windows that lie one after another in ``tokens`` and ``labels``."""
    random = np.random.default_rng(training.seed)
    model = Field()
    if not labels.any() or len(tokens) < 2:
        return model
    starts = np.cumsum(lengths) - lengths
    weights, squares = np.zeros(BUCKETS), np.full(BUCKETS, 1e-6)
    bias, moves, moves_squares = -4.0, np.zeros((2, 2)), np.full((2, 2), 1e-6)
    bias_square = 1e-6
    for _ in range(training.epochs):
        for rows in np.array_split(random.permutation(len(lengths)), max(1, len(lengths) // 256)):
            use = np.arange(WINDOW) < lengths[rows][:, None]
            flat, size = (starts[rows][:, None] + np.arange(WINDOW))[use], lengths[rows]
            scores = bias + weights[tokens[flat]].sum(axis=1)
            forward, p = forward_backward(scores, size, moves)
            gap = labels[flat] - p
            touched, place = np.unique(tokens[flat], return_inverse=True)
            slope = np.bincount(place.ravel(), np.repeat(gap, FEATURES)) / len(rows)
            squares[touched] += slope**2
            weights[touched] += training.rate * slope / np.sqrt(squares[touched])
            total = gap.sum() / len(rows)
            bias_square += total**2
            bias += training.rate * total / np.sqrt(bias_square)
            pairs = pair_gaps(forward, p, labels[flat], size, moves) / len(rows)
            moves_squares += pairs**2
            moves += 0.1 * training.rate * pairs / np.sqrt(moves_squares)
    keep = np.flatnonzero(np.abs(weights) > 1e-3)
    model.weights = dict(zip(keep.tolist(), weights[keep].tolist(), strict=True))
    model.bias, model.transitions = float(bias), moves
    return model


def expected_pairs(forward: np.ndarray, p: np.ndarray, lengths: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """P(tag before, tag) of every token but the first of its sequence, as [before, tag, token].

    Given a token's tag, the one before it depends on what comes up to there alone.
    """
    inner = np.ones(len(p), bool)
    inner[(np.cumsum(lengths) - lengths)[lengths > 0]] = False
    before, here = forward[:-1][inner[1:]], p[1:][inner[1:]]
    joint = np.stack([1 - before, before])[:, None, :] * np.exp(moves)[:, :, None]
    return joint / joint.sum(axis=0) * np.stack([1 - here, here])


def pair_gaps(forward, p, labels, lengths, moves) -> np.ndarray:
    """Observed minus expected transitions between neighbouring tokens."""
    inner = np.ones(len(p), bool)
    inner[(np.cumsum(lengths) - lengths)[lengths > 0]] = False
    seen = np.bincount(labels[:-1][inner[1:]] * 2 + labels[1:][inner[1:]], minlength=4)
    return seen.reshape(2, 2) - expected_pairs(forward, p, lengths, moves).sum(axis=2)


def calibrate(summary: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> tuple[float, float, float]:
    """Weighted logistic regression of the document label on the summary, by Newton steps."""
    x = np.column_stack([np.ones(len(summary)), summary])
    w = np.zeros(3)
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(3)
        w += np.linalg.solve(hessian, x.T @ (weight * (toxic - p)) - 0.1 * w)
    return tuple(float(v) for v in w)


def _summed(model: Field):
    """Largest and summed probability of the words of each row."""
    keys = np.array(sorted(model.weights), np.int64)
    values = np.array([model.weights[k] for k in keys.tolist()])
    bias, transitions = model.bias, model.transitions

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tops, sums = [], []
            for packed in batch.column("tokens").to_pylist():
                tokens = _tokens(packed)
                scores = np.full(len(tokens), bias)
                if len(keys):
                    at = np.minimum(np.searchsorted(keys, tokens), len(keys) - 1)
                    scores += np.where(keys[at] == tokens, values[at], 0.0).sum(axis=1)
                p = marginals(scores, np.array([len(tokens)]), transitions)
                tops.append(float(p.max(initial=0.0)))
                sums.append(float(p.sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("toxic"), pa.array(tops, pa.float64()), pa.array(sums, pa.float64())],
                ["doc", "toxic", "top", "total"],
            )

    return summarise


def train(docs: DataFrame, labels: DataFrame, training: Training | None = None) -> Field:
    """Fit on ``labels(doc_id, toxic)``; rows without id or label are left out.

    Half of the sample are toxic rows, if there are so many. The chosen ids are ``documents`` at most
    and are sent to every task. Of rows that share a chosen id, the least text is learned.
    """
    training = training or Training()
    small_batches(docs.sparkSession)
    rated = labels.select("doc_id", "toxic").filter("doc_id is not null and toxic is not null")
    rated = rated.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    sizes = {r.toxic: r["count"] for r in rated.groupBy("toxic").count().collect()}
    chosen = None
    for value, size in sorted(sizes.items()):
        part = rated.filter(F.col("toxic") == value)
        rate = training.documents / 2 / size
        part = hashed_sample(part, F.col("doc_id"), rate, training.seed) if rate < 1 else part
        chosen = part if chosen is None else chosen.unionByName(part)
    if chosen is None:
        return Field()
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = rows.groupBy(F.col("doc_id").cast("string").alias("doc"), "toxic").agg(F.min("text").alias("text"))
    rows = rows.repartition(docs.sparkSession.sparkContext.defaultParallelism, "doc")
    sample = stored(rows.mapInArrow(_featured, "doc string, part int, toxic int, tokens binary"), "toxic-sample")
    marks = marking_features(sample, training)
    marked, total = sample.mapInArrow(_counted(marks), "marked long, total long").agg(F.sum("marked"), F.sum("total")).first()
    if not total:
        return Field()
    wanted = 4 * marked + 12_000
    share = min(1.0, training.windows / wanted)
    cut = _windows(marks, share, min(1.0, share * (3 * marked + 12_000) / total), training.seed)
    table = sample.mapInArrow(cut, "tokens binary, labels binary").toArrow()
    pairs = sorted(zip(table.column("tokens").to_pylist(), table.column("labels").to_pylist(), strict=True))
    del table
    lengths = np.array([len(tags) for _, tags in pairs], np.int64)
    tokens = _tokens(b"".join(t for t, _ in pairs))
    tags = np.frombuffer(b"".join(tags for _, tags in pairs), np.int8)
    del pairs
    model = fit_field(tokens, tags, lengths, training)

    each = sample.mapInArrow(_summed(model), "doc string, toxic int, top double, total double")
    each = each.groupBy("doc", "toxic").agg(F.max("top").alias("top"), F.sum("total").alias("total")).orderBy("doc").toArrow()
    toxic = each.column("toxic").to_numpy()
    summary = np.column_stack([each.column("top").to_numpy(), np.log1p(each.column("total").to_numpy())])
    # Half of the sample is toxic; the weights give the classes the shares that they have among the labels.
    drawn = {value: max(1, int((toxic == value).sum())) for value in sizes}
    weight = np.array([sizes[t] / drawn[t] for t in toxic.tolist()])
    model.calibration = calibrate(summary, toxic, weight * len(weight) / max(1e-9, weight.sum()))
    return model


def _spans(text: bytes, values: np.ndarray, threshold: float) -> list[tuple[int, int]]:
    """Runs of toxic words in code points, end exclusive."""
    words = list(re.finditer(rb"[^\x20\x09-\x0D]+", text))
    found: list[tuple[int, int]] = []
    last, done, points = -2, 0, 0
    for i in np.flatnonzero(values >= threshold):
        start, end = words[i].span()
        points += len(text[done:start].decode())
        begin = points
        points += len(text[start:end].decode())
        done = end
        if i == last + 1:
            found[-1] = (found[-1][0], points)
        else:
            found.append((begin, points))
        last = i
    return found


def score(docs: DataFrame, model: Field, threshold: float = 0.5) -> DataFrame:
    """The columns of ``docs`` plus ``toxicity`` (0 to 1) and ``toxic_spans`` (start, end).

    Spans are in code points. Null and empty texts have no span and the score of a text without toxic
    words. Columns of these names in ``docs`` are replaced; only the text goes through Python.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))  # plain values only
    kind = pa.struct(
        [("toxicity", pa.float64()), ("toxic_spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))]
    )

    def scored(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        field_ = Field(**shared.value)
        emissions = _Emissions(field_)
        c0, c1, c2 = field_.calibration
        for column in texts:
            rows = texts_as_bytes(column)
            values, lengths = [], np.zeros(len(rows), np.int64)
            for i, text in enumerate(rows):
                words = words_of(text)
                lengths[i] = len(words)
                values.append(np.fromiter(map(emissions.__getitem__, words), float, len(words)))
            p = marginals(np.concatenate(values) if values else np.zeros(0), lengths, field_.transitions)
            summary = _summary(p, lengths)
            final = 1 / (1 + np.exp(-np.clip(c0 + c1 * summary[:, 0] + c2 * summary[:, 1], -30, 30)))
            ends = np.cumsum(lengths)
            spans: list[list] = [[] for _ in rows]
            for i in np.flatnonzero(summary[:, 0] >= threshold):
                found = _spans(rows[i], p[ends[i] - lengths[i] : ends[i]], threshold)
                spans[i] = [{"start": a, "end": b} for a, b in found]
            yield pa.StructArray.from_arrays(
                [pa.array(final), pa.array(spans, kind.field("toxic_spans").type)], ["toxicity", "toxic_spans"]
            )

    scored.__annotations__ = {"texts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    both = F.arrow_udf(scored, "struct<toxicity:double,toxic_spans:array<struct<start:int,end:int>>>")(F.col("text"))
    graded = docs.drop("toxicity", "toxic_spans", "_scored").withColumn("_scored", both)
    return graded.select("*", "_scored.*").drop("_scored")
