import math
import timeit
from collections import Counter

import numpy as np
from helpers import docs_table, sentences, with_extras, words
from pyspark.sql import functions as F

from marketstream.llm import language_model as lm


def corpus():
    """Two vocabularies that never mix, so a history tells much about the next word."""
    texts = sentences(150, 31, vocabulary=150) + sentences(150, 32, vocabulary=150)
    return [*enumerate(texts), (500, None), (501, ""), (502, "never seen before"), (3, texts[3]), (None, texts[4])]


def trained(docs, rounds=2):
    counts = lm.stored(lm.count_words(docs), "counts")
    return lm.train(docs, counts, F.col("doc_id"), lm.Training(rounds=rounds)), counts


def test_base_scores_and_shared_words(spark, monkeypatch):
    rows = corpus()
    docs = docs_table(spark, rows)
    learned = docs.filter("doc_id < 250")
    count = Counter()
    for i, t in rows:
        if i is not None and i < 250:
            count.update([*words(t), b""])
    total, kinds = sum(count.values()), len(count)
    want = sorted(
        (str(i), len(words(t)) + 1, sum(count[w] > 0 for w in [*words(t), b""]),
         round(sum(math.log10((count[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in [*words(t), b""]), 6))
        for i, t in rows
    )
    scores = []
    for limit in (lm.SHARED_WORDS, 40, 0):
        monkeypatch.setattr(lm, "SHARED_WORDS", limit)
        model, counts = trained(learned)
        assert (model.tokens, model.words) == (total, kinds) and len(model.shared_keys) <= limit
        got = lm.score(with_extras(docs), model, counts).collect()
        assert sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == want
        scores.append(sorted((str(r.doc_id), round(r.score, 5)) for r in got))
    assert scores[0] == scores[1] == scores[2]


def test_model_beats_single_words_on_held_out_text(spark):
    def ending(texts, ends):
        return [" ".join(w + ends[len(w) % 3] for w in t.split()) for t in texts]

    texts = [t for _, t in corpus()[:300]]
    texts = ending(texts[:150], ("ing", "ung", "ang")) + ending(texts[150:], ("eau", "oux", "ais"))
    docs = docs_table(spark, [*enumerate(texts)])
    held = F.col("doc_id") % 5 == 0
    model, counts = trained(docs.filter(~held))
    row = lm.score(docs.filter(held), model, counts).agg(F.sum("score"), F.sum("base_score")).first()
    assert row[0] > 0.98 * row[1]


def test_probabilities_sum_to_one():
    rnd = np.random.default_rng(1)
    weights = rnd.normal(size=(lm.ROWS, lm.CLASSES)).astype(np.float32)
    rows = rnd.integers(0, lm.ROWS, (50, lm.FEATURES))
    assert np.allclose(lm.class_probabilities(weights, weights[0], rows).sum(axis=1), 1, atol=1e-5)


def test_step_lowers_loss():
    rnd = np.random.default_rng(2)
    learner = lm.Learner(np.zeros((lm.ROWS + 1, lm.CLASSES), np.float32), 0.25)
    rows = rnd.integers(0, 50, (2000, lm.FEATURES)).astype(np.int32)
    classes = rows[:, 0] % lm.CLASSES
    loss = []
    for _ in range(5):
        p = lm.class_probabilities(learner.weights, learner.bias, rows)
        loss.append(-np.log(p[np.arange(2000), classes]).mean())
        learner.step(rows, classes)
    assert loss == sorted(loss, reverse=True)


def test_empty_tables(spark):
    docs = docs_table(spark, [])
    model, counts = trained(docs)
    assert lm.score(docs, model, counts).count() == 0
    row = lm.score(docs_table(spark, [(1, None)]), model, counts).first()
    assert (row.n_tokens, row.n_known, round(row.base_score, 9)) == (1, 0, 0.0)


def test_a_step_sums_the_slopes_of_each_row():
    """Against a plain sum per row, with rows used once, often, and by all tokens."""
    rng = np.random.default_rng(5)
    values = rng.normal(size=(4096, lm.CLASSES)).astype(np.float32)
    for rows in (np.zeros(4096, int), np.arange(4096), np.sort(rng.integers(0, 900, 4096)), np.sort(rng.zipf(1.5, 4096))):
        starts = np.append(0, np.flatnonzero(rows[1:] != rows[:-1]) + 1)
        plain = np.add.reduceat(values.astype(float), starts, axis=0)
        assert np.allclose(lm.run_sums(values.copy(), starts), plain, atol=1e-3)


def test_a_step_takes_far_less_than_a_sum_along_rows():
    """Sums of 4,096 tokens over some 2,400 rows, against ``reduceat``, which took most of a step."""
    rng = np.random.default_rng(6)
    values = rng.normal(size=(4096, lm.CLASSES)).astype(np.float32)
    rows = np.sort(rng.integers(0, 3600, 4096))
    starts = np.append(0, np.flatnonzero(rows[1:] != rows[:-1]) + 1)
    fast = min(timeit.repeat(lambda: lm.run_sums(values.copy(), starts), number=20, repeat=5))
    slow = min(timeit.repeat(lambda: np.add.reduceat(values, starts, axis=0), number=20, repeat=5))
    assert fast < 0.7 * slow
