import random

import pytest
import xxhash
from helpers import docs_table, roots, sentences, with_extras, words

from marketstream.llm import simhash_dedup


def plain_print(text):
    w = words(text)
    if not w:
        return 0
    shingles = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def corpus():
    texts = sentences(60, 1, size=60)
    near = [t.replace(" ", "  ", 3).upper() for t in texts[:20]]
    edited = [t + " tail" for t in texts[20:35]]
    rows = list(enumerate(texts + near + edited + texts[:5]))
    return [*rows, (500, None), (501, ""), (502, " \t\n"), (503, "one"), (504, "one two"), (None, texts[50]), (7, texts[7])]


def test_groups_equal_brute_force(spark):
    rows = corpus()
    got = simhash_dedup.near_duplicates(with_extras(docs_table(spark, rows))).collect()
    assert len(got) == len(rows)
    prints = {t: plain_print(t) for _, t in rows}
    ids = sorted(set(prints.values()))
    close = [(a, b) for a in ids for b in ids if a < b and (a ^ b).bit_count() <= 2]
    root = roots(close, ids)
    least = {}
    for i, t in rows:
        r = root[prints[t]]
        least[r] = min((x for x in (i, least.get(r)) if x is not None), default=None)
    want = sorted((str(i), prints[t], str(least[root[prints[t]]])) for i, t in rows)
    assert sorted((str(r.doc_id), r.fp % (1 << 64), str(r.component_id)) for r in got) == want


@pytest.mark.parametrize("limit", [1 << 14, 4])
def test_links_are_complete_in_dense_groups(spark, monkeypatch, limit):
    """Hundreds of fingerprints within a few bits of one another, so node pairs have to be split."""
    monkeypatch.setattr(simhash_dedup, "PAIR_LIMIT", limit)
    rnd = random.Random(3)
    centre = rnd.getrandbits(64)
    prints = {centre}
    while len(prints) < 300:
        flipped = centre
        for _ in range(rnd.randint(1, 4)):
            flipped ^= 1 << rnd.randrange(64)
        prints.add(flipped)
    prints |= {rnd.getrandbits(64) for _ in range(100)} | {0, (1 << 64) - 1, 1, 1 << 63}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = simhash_dedup.links(spark.createDataFrame([(p,) for p in signed], "fp long")).collect()
    got = [frozenset((r.a % (1 << 64), r.b % (1 << 64))) for r in found]
    want = {frozenset((a, b)) for a in prints for b in prints if 0 < (a ^ b).bit_count() <= 2}
    assert set(got) == want and len(got) == len(want)


def test_long_text_is_hashed_in_blocks(monkeypatch):
    text = sentences(1, 5, size=400)[0]
    monkeypatch.setattr(simhash_dedup, "BLOCK", 7)
    assert simhash_dedup.fingerprint(text.encode()) == plain_print(text)


def test_keep_first(spark):
    rows = corpus()
    kept = simhash_dedup.keep_first(with_extras(docs_table(spark, rows)))
    assert "tail" in kept.columns
    ids = [r.doc_id for r in kept.collect()]
    groups = simhash_dedup.near_duplicates(docs_table(spark, rows)).collect()
    assert sorted(i for i in ids if i is not None) == sorted({r.component_id for r in groups if r.component_id is not None})
    assert ids.count(None) == 1


def test_empty_table(spark):
    assert simhash_dedup.near_duplicates(docs_table(spark, [])).count() == 0
