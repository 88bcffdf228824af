import random
import re
from collections import Counter

import numpy as np
import pytest
from helpers import docs_table, sentences, with_extras

from marketstream.llm import decontamination


def tokens(text):
    return re.findall(r"\w+", (text or "").lower())


def shingle_counts(w, k):
    return Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def plain(rows, items):
    want = {}
    for doc, text in rows:
        w = tokens(text)
        for item, item_text in items:
            t = tokens(item_text)
            if not t or not w:
                continue
            k = min(5, len(t))
            theirs, size = shingle_counts(t, k), min(len(t), len(w))
            best = 0.0
            for s in range(len(w) - size + 1):
                mine = shingle_counts(w[s : s + size], k)
                shared = sum((mine & theirs).values())
                best = max(best, shared / max(1, sum((mine | theirs).values())))
            if best >= 0.8:
                want[doc, item] = round(best, 9)
    return want


def cases():
    rnd = random.Random(3)
    items = list(enumerate(sentences(25, 21, size=40)))
    items += [(50, "Only, three words"), (51, "one"), (52, None), (53, " ... "), (54, "same same " * 15), (3, items[3][1])]
    texts = sentences(40, 22, size=100)
    for i in range(25):
        w = items[i][1].split()
        if i % 5 == 1:
            w[0] = "changed"
        if i % 5 == 2:
            w[len(w) // 2] = "changed"
        if i % 5 == 3:
            w = w[: int(len(w) * 0.93)]
        if i % 5 == 4:
            w.insert(len(w) // 2, "added")
        half = texts[i].split()
        cut = rnd.randrange(len(half))
        texts[i] = " ".join(half[:cut] + [x.upper() + ",!" for x in w] + half[cut:])
    texts[30] = " ".join(items[20][1].split()[5:] + items[20][1].split()[:5])
    rows = [*enumerate(texts), (100, None), (101, ""), (102, "only three words"), (103, "same " * 200), (104, items[7][1]), (5, texts[5])]
    return rows, items


def test_hits_equal_brute_force(spark):
    rows, items = cases()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.with_hits(with_extras(docs_table(spark, rows)), benchmark).collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, h.item_id): round(h.similarity, 9) for r in got for h in r.hits} == plain(rows, items)


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    rows, items = cases()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    whole = decontamination.with_hits(docs_table(spark, rows), benchmark).collect()
    monkeypatch.setattr(decontamination, "ITEM_BLOCK", 7)
    parts = decontamination.with_hits(docs_table(spark, rows), benchmark).collect()
    pick = lambda found: sorted((r.doc_id, h.item_id, h.word_start) for r in found for h in r.hits)
    assert pick(whole) == pick(parts)


@pytest.mark.parametrize("radius", [0, 3, 20])
def test_blocks_find_every_print_within_the_radius(radius):
    rnd = random.Random(radius)
    for _ in range(200):
        a, b = rnd.getrandbits(64), 0
        b = a
        for bit in rnd.sample(range(64), radius):
            b ^= 1 << bit
        assert decontamination.share_block(np.array([b], np.uint64), a, radius)[0]


def test_clean_documents_stay(spark):
    rows, items = cases()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = with_extras(docs_table(spark, rows))
    kept = decontamination.without_hits(docs, benchmark)
    hit = {doc for doc, _ in plain(rows, items)}
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, _ in rows if i not in hit)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.without_hits(docs_table(spark, [(1, "a b")]), none).count() == 1
    assert decontamination.with_hits(docs_table(spark, []), none).count() == 0
