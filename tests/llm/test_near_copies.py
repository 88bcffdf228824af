import random

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from helpers import docs_table, roots, sentences, with_extras, words

from marketstream.llm import near_copies, simhash_dedup


def plain_shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def similarity(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def edited(text, changes, rnd):
    w = text.split()
    for i in rnd.sample(range(len(w)), changes):
        w[i] = f"changed{rnd.random()}"
    return " ".join(w)


def corpus():
    """Texts, edited copies on both sides of 0.8, chains of edits, clean texts, nulls and repeats."""
    rnd = random.Random(4)
    texts = sentences(40, 9, size=120)
    copies = [edited(t, changes, rnd) for t in texts[:20] for changes in (1, 2, 4)]
    chain = [texts[20]]
    for _ in range(6):
        chain.append(edited(chain[-1], 1, rnd))
    # 40 words: a change at the end costs one shingle, so 36 and 4 more give exactly 0.8.
    exact = " ".join(f"e{i}" for i in range(40))
    bounds = [exact, " ".join(exact.split()[:36]) + " x1 x2 x3 x4", exact + " y" * 9, exact + " " + " ".join(f"z{i}" for i in range(9))]
    rows = list(enumerate(texts + copies + chain[1:] + bounds))
    return [*rows, (900, None), (901, ""), (902, " \t"), (903, "one"), (904, "ONE "), (905, "one two"), (None, texts[30]), (7, texts[7])]


def expected(rows):
    sets = [plain_shingles(t) for _, t in rows]
    near = [(a, b) for a in range(len(rows)) for b in range(a) if similarity(sets[a], sets[b]) >= 0.8]
    groups = roots(near, range(len(rows)))
    least = {}
    for at, (i, _) in enumerate(rows):
        if i is not None:
            least[groups[at]] = min(i, least.get(groups[at], i))
    return sorted(least.values())


def test_stage_keeps_one_of_each_group_of_near_copies(spark):
    rows = corpus()
    kept = corpus_pipeline.drop_near_copies(spark, with_extras(docs_table(spark, rows)), "")
    assert "tail" in kept.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == expected(rows)
    assert ids.count(None) == 1


def test_exact_similarity_at_the_bound():
    a = " ".join(f"w{i}" for i in range(40))
    for other in (a + " " + " ".join(f"z{i}" for i in range(9)), a + " " + " ".join(f"z{i}" for i in range(10))):
        sets = [near_copies.shingles(t.encode()) for t in (a, other)]
        assert near_copies.similar(*sets) == (similarity(*map(plain_shingles, (a, other))) >= 0.8)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(3, "a b c d e f"), (3, "a b c d e f"), (2, "a B c d e  f")]])
def test_small_tables(spark, rows):
    kept = near_copies.keep_first(docs_table(spark, rows)).collect()
    assert sorted(r.doc_id for r in kept) == expected(rows)


def short_copies(count):
    """One large group of short near copies, most of them less than 0.8 from one another, and unlike ones."""
    rnd = random.Random(8)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for i in range(count):
        w = list(base)
        for at in rnd.sample(range(60), rnd.choice([0, 1, 1, 2])):
            w[at] = f"x{rnd.random()}"
        rows.append((i, " ".join(w)))
    # Texts that share most of a long notice, and are no copies of one another.
    notice = " ".join(f"n{i}" for i in range(70))
    rows += [(1000 + i, notice + " " + " ".join(f"u{i}.{j}" for j in range(30))) for i in range(count // 2)]
    return rows


@pytest.mark.parametrize("rounds", [0, 2])
def test_groups_are_those_of_all_pairs(spark, rounds):
    """Against all pairs, in a large group of short near copies and in one of texts that share a notice."""
    rows = short_copies(80)
    kept = sorted(r.doc_id for r in near_copies.keep_first(docs_table(spark, rows), rounds).collect())
    assert kept == expected(rows)


def test_pairs_stay_few_in_large_groups(spark, monkeypatch):
    rows = short_copies(160)
    asked = []
    verify = near_copies._verify

    def counted(pairs, texts):
        asked.append(pairs.distinct().count())
        return verify(pairs, texts)

    monkeypatch.setattr(near_copies, "_verify", counted)
    kept = sorted(r.doc_id for r in near_copies.keep_first(docs_table(spark, rows)).collect())
    assert kept == expected(rows)
    assert sum(asked) < 60 * len(rows)


def test_recall_of_the_keys():
    """Pairs planted at similarities from 0.8 to 0.95 that share a key."""
    rnd = random.Random(6)
    hits = {}
    for _ in range(400):
        words = [f"w{rnd.random()}" for _ in range(rnd.choice([60, 150, 400]))]
        other = edited(" ".join(words), rnd.choice([1, 2, 4, 8]), rnd)
        alike = similarity(plain_shingles(" ".join(words)), plain_shingles(other))
        if alike >= 0.8:
            keys = [set(near_copies.band_keys(near_copies.shingles(t.encode())).tolist()) for t in (" ".join(words), other)]
            hits.setdefault(alike < 0.9, []).append(bool(keys[0] & keys[1]))
    assert all(len(h) > 50 and sum(h) >= 0.99 * len(h) for h in hits.values())


def test_candidates_come_from_the_gray_order_index(spark, monkeypatch):
    """With the bands' keys taken away, one-word edits of long texts are found by the index alone."""
    rnd = random.Random(9)
    texts = sentences(6, 3, size=900)
    rows = [*enumerate(texts), *((100 + i, edited(t, 1, rnd)) for i, t in enumerate(texts))]
    prints = [simhash_dedup.majority(simhash_dedup.set_bits(s), len(s)) for s in (near_copies.shingles(t.encode()) for _, t in rows)]
    near = [i for i in range(6) if (prints[i] ^ prints[6 + i]).bit_count() <= simhash_dedup.RADIUS]
    assert len(near) > 2
    candidates = near_copies._candidates
    monkeypatch.setattr(near_copies, "_candidates", lambda p, n: candidates(p, n).filter(f"band = {near_copies.GRAY}"))
    kept = {r.doc_id for r in near_copies.keep_first(docs_table(spark, rows)).collect()}
    assert kept == {i for i, _ in rows} - {100 + i for i in near}


def test_marks_leave_out_no_similar_pair():
    rnd = random.Random(10)
    left_out = 0
    for _ in range(300):
        text = " ".join(f"w{rnd.random()}" for _ in range(rnd.choice([60, 150, 400])))
        sets = [near_copies.shingles(t.encode()) for t in (text, edited(text, rnd.choice([1, 2, 4, 8, 16]), rnd))]
        apart = int(np.bitwise_count((near_copies.marks(sets[0]) ^ near_copies.marks(sets[1])).view(np.uint64)).sum())
        assert apart <= len(np.setxor1d(*sets))
        fits = 9 * apart <= sum(map(len, sets))
        assert fits or not near_copies.similar(*sets)
        left_out += not fits
    assert left_out > 50


def test_tasks_contract_links_to_the_same_components(monkeypatch):
    rnd = random.Random(11)
    links = [(rnd.randrange(-60, 60), rnd.randrange(-60, 60)) for _ in range(70)]
    table = pa.table({"a": [a for a, _ in links], "b": [b for _, b in links]}).to_batches(max_chunksize=10)
    whole = [tuple(r.values()) for batch in near_copies._contracted(table) for r in batch.to_pylist()]
    expected = {i: root for i, root in roots(links, range(-60, 60)).items() if i != root}
    assert dict(whole) == expected
    assert len(whole) == len(expected)
    monkeypatch.setattr(near_copies, "CONTRACTED", 20)
    parts = [tuple(r.values()) for batch in near_copies._contracted(table) for r in batch.to_pylist()]
    assert roots(parts, range(-60, 60)) == roots(links, range(-60, 60))


@pytest.mark.parametrize("many", [False, True])
def test_few_links_need_no_rounds(spark, monkeypatch, many):
    """Links that one task may hold are settled by it; more of them go through the rounds of ``components``."""
    rnd = random.Random(12)
    links = [(rnd.randrange(-60, 60), rnd.randrange(-60, 60)) for _ in range(70)]
    called = []
    components = near_copies.components
    monkeypatch.setattr(near_copies, "components", lambda edges: called.append(edges) or components(edges))
    if many:
        monkeypatch.setattr(near_copies, "CONTRACTED", 40)
    table = spark.createDataFrame([*links, *links], "a long, b long").repartition(5)
    found = [tuple(r) for r in near_copies._components(table).collect()]
    plain = roots(links, range(-60, 60))
    linked = {i for a, b in links if a != b for i in (a, b)}
    assert len(found) == len(dict(found))
    assert {i: root for i, root in found if i in linked} == {i: plain[i] for i in linked}
    assert all(i in linked or i == root for i, root in found)
    assert bool(called) == many
    assert not near_copies._components(table.limit(0)).collect()


def test_driver_plans_few_queries(spark):
    """Jobs of a table whose last rounds find nothing; the driver keeps memory for each."""
    rows = short_copies(80)
    docs = docs_table(spark, rows)
    jobs = spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs
    before = jobs()
    kept = sorted(r.doc_id for r in near_copies.keep_first(docs).collect())
    assert kept == expected(rows)
    assert jobs() - before < 215
