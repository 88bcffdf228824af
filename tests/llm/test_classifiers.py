import numpy as np
import pytest
from helpers import docs_table, roots, sentences, with_extras
from pyspark.sql import functions as F

from marketstream.llm import components, language_id, quality, toxicity

BAD = ("vilwort", "schmutzig", "nastyone")


def toxic_corpus():
    texts, labels = sentences(400, 41, vocabulary=300), []
    for i in range(len(texts)):
        toxic = i % 4 == 0
        if toxic:
            w = texts[i].split()
            for n in range(3):
                w.insert((i * 7 + n * 5) % len(w), BAD[(i // 4 + n) % 3])
            texts[i] = " ".join(w)
        labels.append((i, int(toxic)))
    return texts, labels


@pytest.fixture(scope="module")
def toxic_model(spark):
    texts, labels = toxic_corpus()
    table = spark.createDataFrame([*labels, (None, 1), (5000, None), (3, labels[3][1])], "doc_id long, toxic int")
    return toxicity.train(docs_table(spark, [*enumerate(texts)]), table.filter("doc_id is null or doc_id % 5 <> 0"))


def test_toxic_documents_and_spans(spark, toxic_model):
    texts, labels = toxic_corpus()
    odd = [(900, None), (901, ""), (902, "é😀 vilwort!! here"), (903, "clean words only"), (0, texts[0])]
    scored = toxicity.score(with_extras(docs_table(spark, [*enumerate(texts), *odd])), toxic_model).collect()
    assert len(scored) == len(texts) + len(odd)
    by = {r.doc_id: r for r in scored}
    held = [i for i, _ in labels if i % 5 == 0]
    right = sum((by[i].toxicity >= 0.5) == bool(labels[i][1]) for i in held)
    assert right / len(held) > 0.95
    for i in held[:20]:
        found = {by[i].text[s.start : s.end] for s in by[i].toxic_spans}
        assert all(any(b in f for b in BAD) for f in found)
    assert [by[902].text[s.start : s.end] for s in by[902].toxic_spans] == ["vilwort!!"]
    assert by[900].toxicity == by[901].toxicity < 0.5 and not by[900].toxic_spans


def test_marginals_equal_enumeration():
    """A sequence follows a clean token."""
    rnd = np.random.default_rng(4)
    lengths = np.array([3, 0, 5, 1, 4])
    scores, moves = rnd.normal(size=lengths.sum()) * 2, rnd.normal(size=(2, 2))
    forward, got = toxicity.forward_backward(scores, lengths, moves)
    pairs, at, pair = toxicity.expected_pairs(forward, got, lengths, moves), 0, 0
    for n in lengths:
        total, marked, seen = 0.0, np.zeros(n), np.zeros((2, 2, max(0, n - 1)))
        for code in range(1 << n):
            tags = [code >> i & 1 for i in range(n)]
            value = sum(scores[at + i] for i in range(n) if tags[i]) + sum(moves[a][b] for a, b in zip([0, *tags], tags, strict=False))
            total += np.exp(value)
            marked += np.array(tags) * np.exp(value)
            for i in range(n - 1):
                seen[tags[i], tags[i + 1], i] += np.exp(value)
        assert np.allclose(got[at : at + n], marked / total)
        assert np.allclose(pairs[:, :, pair : pair + max(0, n - 1)], seen / total)
        at, pair = at + n, pair + max(0, n - 1)


def test_toxicity_without_labels_or_documents(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.train(docs_table(spark, [(1, "a")]), none)
    assert toxicity.score(docs_table(spark, [(1, "a")]), model).first().toxicity < 0.5
    assert toxicity.score(docs_table(spark, []), model).count() == 0


def plain_phrases(text, known):
    count, at = 0, 0
    while at < len(text):
        size = 1
        while at + size < len(text) and tuple(text[at : at + size + 1]) in known:
            size += 1
        at, count = at + size, count + 1
    return count


def test_phrases_equal_plain_parsing():
    rnd = np.random.default_rng(5)
    learned = rnd.integers(0, 4, 300).tolist()
    known = {tuple(learned[i : i + n]) for i in range(300) for n in range(1, 40) if i + n <= 300}
    table = language_id.dense(language_id.suffix_automaton(learned))
    model = language_id.Model(["x"], np.zeros(1, np.uint8), table, np.zeros(1, np.int32), np.ones(1))
    pieces = [rnd.integers(0, 5, n).astype(np.uint8) for n in (1, 50, 7, 200, 50)]
    got = language_id.phrases(pieces, model)[:, 0]
    assert got.tolist() == [plain_phrases(p.tolist(), known) for p in pieces]


def test_rare_letters_follow_the_same_automaton():
    """Phrases do not depend on whether letters lie in the dense table or in the sorted array."""
    rnd = np.random.default_rng(8)
    low = [rnd.integers(1, 30, 400), rnd.integers(1, 30, 300)]
    pieces = [rnd.integers(1, 34, n) for n in (1, 50, 200)] + [low[0][40:160], low[1][:90]]

    def counted(shift):
        tables, rare, starts, at = [], [], [], 0
        for learned in low:
            nexts = language_id.suffix_automaton((learned + shift).tolist())
            tables.append(language_id.dense(nexts) + np.int32(at))
            rare.append(language_id.sparse(nexts, at))
            starts.append(at)
            at += len(tables[-1])
        keys, targets = (np.concatenate(part) for part in zip(*rare))
        model = language_id.Model(["x", "y"], np.zeros(1), np.vstack(tables), np.array(starts, np.int32), np.ones(2), keys, targets)
        return language_id.phrases([p + shift for p in pieces], model)

    assert (counted(0) == counted(50)).all() and (counted(0) == counted(500)).all()


def test_languages_of_rare_scripts(spark):
    """Two small languages in scripts of many letters with words of the same lengths, beside a large Latin one."""
    latin = sentences(200, 61)
    shift = lambda t, base: "".join(chr(base + 97 * (ord(c) - 97) + n % 5) if c != " " else c for n, c in enumerate(t))
    small = sentences(60, 62, vocabulary=100)
    rows = list(enumerate(latin + [shift(t, 0x4E00) for t in small] + [shift(t, 0xAC00) for t in small]))
    docs = docs_table(spark, rows, lang=lambda n: "la" if n < 200 else "zh" if n < 260 else "ko")
    model = language_id.train(docs, F.col("doc_id") % 3 != 0)
    got = {r.doc_id: r.lang_pred for r in language_id.predict(docs, model).collect()}
    assert all(got[i] == ("la" if i < 200 else "zh" if i < 260 else "ko") for i, _ in rows)


def test_every_text_of_the_sample_is_learned(spark):
    """One text holds most rows and sorts first; rows of one id repeat. The other texts are learned all the same."""
    others = [f"z{t}" for t in sentences(40, 63, size=200, vocabulary=3000)]
    copied = "aaa " + sentences(1, 64, size=400)[0]
    rows = [*enumerate(others), *((100 + i, copied) for i in range(200)), *[(7, others[7])] * 30]
    training = language_id.Training(letters=8000, documents=41)
    model = language_id.train(docs_table(spark, rows), training=training)
    per_text = 8000 // 41 - 1
    for text in (*others, copied):
        start = language_id.symbols_of(text, model.symbol_of)
        pieces = [start[i : i + 40] for i in range(0, len(start) - 40, 5)]
        known = sum(language_id.phrases([p], model)[0, 0] == 1 for p in pieces)
        assert known >= (per_text - 60) // 5
    # The sample is bounded, whatever the number of rows.
    assert len(model.table) <= 2 * 8000 + 1


def test_languages(spark):
    a, b = sentences(120, 51, vocabulary=200), [t.translate(str.maketrans("abcdefghijklmnop", "zyxwvutsrqponmlk")) for t in sentences(120, 52, vocabulary=200)]
    rows = [*enumerate(a + b), (900, None), (901, "12 34 ..."), (902, ""), (905, a[0] * 200)]
    docs = docs_table(spark, rows, lang=lambda n: None if n % 11 == 0 else "aa" if n < 120 else "bb")
    model = language_id.train(docs, F.col("doc_id") % 5 != 0)
    got = {r.doc_id: r for r in language_id.predict(with_extras(docs), model).collect()}
    assert model.languages == ["aa", "bb"] and len(got) == len(rows)
    assert all(got[i].lang_pred == ("aa" if i < 120 else "bb") for i in range(240))
    assert [(got[i].lang_pred, got[i].lang_score) for i in (900, 901, 902)] == [("und", 0.0)] * 3
    assert got[905].lang_pred == "aa" and 0 <= got[905].lang_score <= 1
    nothing = language_id.train(docs.filter("lang = 'none'"))
    assert language_id.predict(docs, nothing).filter("lang_pred = 'und'").count() == len(rows)
    assert language_id.predict(docs_table(spark, []), model).count() == 0


def graded_corpus():
    texts = sentences(300, 61)
    rows = []
    for i, t in enumerate(texts):
        grade = i % 3
        rows.append((i, t if grade == 2 else t.upper() if grade == 1 else "".join(c + "#" for c in t), grade))
    return rows


def test_grades(spark):
    rows = graded_corpus()
    docs = with_extras(docs_table(spark, [(i, t) for i, t, _ in rows] + [(900, None), (901, ""), (0, rows[0][1])]))
    ratings = spark.createDataFrame([(i, g) for i, _, g in rows if i % 5] + [(None, 1), (7, None)], "doc_id long, grade int")
    model = quality.train(docs, ratings)
    assert model.grades == [0, 1, 2] and (np.diff(model.thresholds) >= 0).all()
    got = {r.doc_id: r for r in quality.score(docs, model).collect()}
    held = [(i, g) for i, _, g in rows if i % 5 == 0]
    assert sum(round(got[i].expected_grade) == g for i, g in held) / len(held) > 0.9
    assert got[900].tail == got[901].tail
    kept = quality.select(docs, model)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert {i for i, g in held if g == 2} <= set(ids) and not {i for i, g in held if g == 0} & set(ids)


def test_gradient_points_uphill():
    """One grade more for every unit of the single feature: the fit orders rows by it."""
    x = np.repeat(np.linspace(-2, 2, 60), 3)[:, None]
    grade = np.digitize(x[:, 0], [-0.7, 0.7])
    model = quality.fit(x, grade, quality.Training(epochs=200))
    assert model.weights[0] > 0
    assert (np.diff(model.expected(model.tails(x[::3]))) >= 0).all()


def test_quality_edges(spark):
    none = spark.createDataFrame([], "doc_id long, grade int")
    model = quality.train(docs_table(spark, [(1, "a")]), none)
    assert quality.score(docs_table(spark, [(1, "a")]), model).first().tail == 0.0
    assert quality.score(docs_table(spark, []), model).count() == 0


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (200, 100), (300, 300), (0, 500), (7, 8), (8, 7)]
    links += [(1000, 1000 + i) for i in range(1, 60)]
    rows = components.components(spark.createDataFrame([*links, (None, 5)], "a long, b long")).collect()
    nodes = {n for pair in links if pair[0] != pair[1] for n in pair}
    want = roots([p for p in links if p[0] != p[1]], nodes)
    assert {r.node: r.root for r in rows} == want and len(rows) == len(want)


def test_the_whole_of_a_long_text_is_learned(spark, monkeypatch):
    """Toxic words far behind the beginning, and of one id with many rows."""
    texts, labels = toxic_corpus()
    texts = [t + " filler" * 1500 if i % 8 == 4 else t for i, t in enumerate(texts)]
    texts = [" ".join(reversed(t.split())) if i % 8 == 4 else t for i, t in enumerate(texts)]
    rows = [*enumerate(texts), *[(4, texts[4])] * 50]
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(docs_table(spark, rows), table)
    scored = {r.doc_id: r.toxicity for r in toxicity.score(docs_table(spark, list(enumerate(texts))), model).collect()}
    assert sum((scored[i] >= 0.5) == bool(t) for i, t in labels) / len(labels) > 0.97


def test_marking_features_equal_plain_counts(spark):
    training = toxicity.Training(evidence=4.0)
    texts, labels = toxic_corpus()
    rows = [(str(i), 0, t, np.array([toxicity.word_features(w) for w in texts[i].encode().split()], np.uint32).tobytes()) for i, t in labels[:120]]
    sample = spark.createDataFrame([(d, p, t, bytearray(k)) for d, p, t, k in rows], "doc string, part int, toxic int, tokens binary")
    found = toxicity.marking_features(sample, training)
    for place in range(toxicity.LABELLING):
        docs, contexts = {}, {}
        for d, _, t, packed in rows:
            tokens = np.frombuffer(packed, np.uint32).reshape(-1, toxicity.FEATURES)
            for at, row in enumerate(tokens.tolist()):
                docs.setdefault(row[place], set()).add((t, d))
                if t:
                    contexts.setdefault(row[place], set()).add(tokens[at - 1, 0] if at else -1)
        every = sum(map(len, docs.values()))
        clean = sum(1 for seen in docs.values() for t, _ in seen if not t)
        bits, marks = -np.log2(max(1e-3, 1 - clean / every)), []
        for key, seen in docs.items():
            there, elsewhere = sum(t for t, _ in seen), sum(not t for t, _ in seen)
            there = min(there, len(contexts.get(key, ())))
            if there * bits >= training.evidence and there >= training.purity * (there + elsewhere):
                marks.append(key)
        assert found[place].tolist() == sorted(marks)
    assert any(len(f) for f in found)


def test_quality_gradient_equals_differences():
    """One step of the fit against numeric slopes of the likelihood of the observed grades."""
    rnd = np.random.default_rng(3)
    x, grade = rnd.normal(size=(40, 6)), rnd.integers(0, 3, 40)

    def likelihood(w, t):
        tail = 1 / (1 + np.exp(-((x @ w)[:, None] - t)))
        edge = np.hstack([np.ones((40, 1)), tail, np.zeros((40, 1))])
        return np.log(edge[np.arange(40), grade] - edge[np.arange(40), grade + 1]).mean()

    training = quality.Training(epochs=1, rate=1e-6, decay=0.0)
    model = quality.fit(x, grade, training)
    share = (grade[:, None] > np.arange(2)).mean(axis=0)
    w0, t0 = np.zeros(6), -np.log(share / (1 - share))
    slopes = np.array([(likelihood(w0 + d, t0) - likelihood(w0 - d, t0)) / 2e-5 for d in np.eye(6) * 1e-5])
    # Steps are divided by the size of the slope, so signs and near equal lengths remain.
    assert np.array_equal(np.sign(model.weights), np.sign(slopes))
    assert np.allclose(np.abs(model.weights), 1e-6, rtol=0.02)
    fitted = quality.fit(x, grade, quality.Training(epochs=300, rate=0.05))
    assert likelihood(fitted.weights, fitted.thresholds) > likelihood(w0, t0) + 0.01


def test_quality_features_equal_plain_counts():
    """Trigram frequencies and ratios against plain Python, across the blocks of a long text."""
    rnd = np.random.default_rng(1)
    for text in (b"a", b"Ab 1!\nab", bytes(rnd.integers(1, 256, 3000, dtype=np.uint8)), b"xy Z9\n" * (quality.BLOCK // 6 + 10)):
        counts = np.zeros(quality.HASHED)
        for a, b, c in zip(text, text[1:], text[2:], strict=False):
            value = ((a * 65599 + b) * 65599 + c) % (1 << 32)
            counts[(value * 2654435761 % (1 << 32)) >> 21] += 1
        got = quality.features(text)
        assert np.allclose(got[: quality.HASHED], np.sqrt(counts / max(1, counts.sum())))
        shares = [sum(65 <= v <= 90 for v in text), sum(48 <= v <= 57 for v in text), sum(v in b" \t\n\v\f\r" for v in text)]
        assert np.allclose(got[quality.HASHED : quality.HASHED + 3] * len(text), shares)
        assert got[quality.HASHED + 5] == pytest.approx(len(set(text.split())) / max(1, len(text.split())))
