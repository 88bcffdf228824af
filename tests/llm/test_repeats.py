from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from helpers import docs_table, sentences, with_extras, words

from marketstream.llm import suffix_dedup


def corpus():
    texts = sentences(60, 11, size=120)
    passage, other = sentences(2, 12, size=90)
    for i in range(0, 12):
        texts[i] = f"{texts[i]} {passage} {texts[i + 1][:40]}"
    for i in range(20, 24):
        texts[i] = texts[i] + " " + " ".join(other.split()[: 49 + i % 3])
    near = texts[30].split()
    near[60] = "edited"
    rows = list(enumerate(texts))
    rows += [(100, texts[30]), (101, " ".join(near)), (102, None), (103, ""), (104, "short text"), (30, texts[30])]
    rows += [(105, ("loop of words " * 80)), (None, texts[31])]
    return rows


def plain(rows, docs):
    where = defaultdict(set)
    for doc, text in zip(docs, (t for _, t in rows), strict=True):
        w = words(text)
        for i in range(len(w) - 49):
            where[tuple(w[i : i + 50])].add(doc)
    want = set()
    for doc, text in zip(docs, (t for _, t in rows), strict=True):
        w = words(text)
        for i in range(len(w) - 49):
            found = where[tuple(w[i : i + 50])]
            if len(found) > 1:
                want.add((doc, i, min(found)))
    return want


@pytest.mark.parametrize("partitions", [3, 40])
def test_passages_equal_brute_force(spark, partitions):
    rows = corpus()
    docs = with_extras(docs_table(spark, rows))
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = suffix_dedup.repeats(docs).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    nameless = next(r.doc for r in docs.select(suffix_dedup._doc().alias("doc"), "doc_id").filter("doc_id is null").collect())
    ids = [nameless if i is None else i for i, _ in rows]
    windows = {(r.doc, i, r.first_doc) for r in got for i in range(r.word_start, r.word_end - 49)}
    assert windows == plain(rows, ids)
    assert len(windows) == sum(r.word_end - r.word_start - 49 for r in got)
    assert all(r.removed == (r.doc != r.first_doc) for r in got)


def test_windows_are_chosen_alike_wherever_they_stand():
    one, two = sentences(2, 5, size=300)
    passage = sentences(1, 6, size=80)[0]
    a = suffix_dedup.word_hashes(f"{one} {passage} {two}".encode())
    b = suffix_dedup.word_hashes(f"{two[:200]} {passage} {one}".encode())
    keys_a, chosen_a = suffix_dedup.minimisers(a)
    keys_b, chosen_b = suffix_dedup.minimisers(b)
    full_a, full_b = (suffix_dedup.run_hashes(w, suffix_dedup.LENGTH) for w in (a, b))
    shared = set(full_a.tolist()) & set(full_b.tolist())
    assert shared
    for value in shared:
        i, j = np.flatnonzero(full_a == value)[0], np.flatnonzero(full_b == value)[0]
        assert keys_a[chosen_a[i]] == keys_b[chosen_b[j]] and chosen_a[i] - i == chosen_b[j] - j


def test_neighbours_across_batches():
    keys = [1, 1, 2, 3, 3, 3, 4, 5, 5, 6]
    columns = [pa.array(keys), pa.array(range(10)), pa.array(range(10)), pa.array(range(10), pa.int32())]
    whole = pa.RecordBatch.from_arrays(columns, ["key", "doc", "text_hash", "place"])
    for size in (1, 2, 3, 10):
        parts = [whole.slice(i, size) for i in range(0, 10, size)]
        rows = [r for b in suffix_dedup._neighbours(iter(parts)) for r in b.to_pylist()]
        assert [(r["key"], r["doc"], r["single"]) for r in rows] == [
            (1, 0, False), (1, 1, False), (3, 3, False), (3, 4, False), (3, 5, False), (5, 7, False), (5, 8, False), (6, 9, True)
        ]


def test_each_passage_stays_once(spark):
    rows = [r for r in corpus() if r[0] is not None]
    docs = docs_table(spark, rows)
    clean = suffix_dedup.without_repeats(docs)
    assert clean.columns == docs.columns and clean.count() == len(rows)
    assert suffix_dedup.repeats(clean.filter("doc_id not in (30, 105)")).filter("removed").count() == 0
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert texts[102] is None and texts[103] == "" and texts[104] == "short text" and texts[100] == ""


def test_empty_table(spark):
    assert suffix_dedup.repeats(docs_table(spark, [])).count() == 0
