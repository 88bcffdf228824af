import random
import re
import zlib
from collections import Counter

import pytest
from helpers import docs_table, with_extras
from pyspark.sql import functions as F

from marketstream.llm import spelling_variants
from marketstream.llm.spelling_variants import Acceptor, Rules


def one_edit(a, b):
    """Plainly: is b reached from a by one change?"""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def plain_words(rows, rules):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % rules.drop_one_in == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= rules.least_letters and n >= rules.least_count}


def plain(counts, rules):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= rules.form_factor * counts[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, n, len(near[w]), form[w], counts.get(form[w]), root(w)) for w, n in counts.items())


def vocabulary(size, seed, letters="abcÀüe", longest=9):
    rnd = random.Random(seed)
    return sorted({"".join(rnd.choice(letters) for _ in range(rnd.randint(6, longest))) for _ in range(size)})


def test_acceptor_is_the_least_one_and_accepts_its_words():
    words = ["abcdef", "abcdeg", "xbcdef", "xbcdeg", "xbcdegg"]
    acceptor = Acceptor(sorted(words))
    # Rests left of a word tell its states apart.
    rests = {frozenset(w[len(p) :] for w in words if w.startswith(p)) for w in words for p in (w[:i] for i in range(len(w) + 1))}
    assert len(acceptor.final) == len(rests)


@pytest.mark.parametrize("words", [[], ["a"], ["", "a", "aa", "aaa", "ab"], vocabulary(400, 1, "ab"), vocabulary(300, 2), ["x" * 5000, "x" * 4999, "x" * 2000 + "y" + "x" * 2999]])
def test_composition_lists_each_near_pair_once(words):
    pairs = [tuple(sorted(p)) for p in Acceptor(sorted(words)).near()]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {(a, b) for a in words for b in words if a < b and one_edit(a, b)}


@pytest.mark.parametrize(("part_words", "letters", "least"), [(2000, "abcÀe", 6), (3, "ab", 6), (1, "abc", 6), (5, "ab", 1), (1, "ab", 1)])
def test_parts_and_their_edges_lose_no_pair(spark, part_words, letters, least):
    words = vocabulary(250, 5, letters) + (["a", "ab", "b", "aab"] if least == 1 else [])
    table = spark.createDataFrame([(w, len(w)) for w in words], "word string, n long")
    found = spelling_variants.near_pairs(table, Rules(least_letters=least, part_words=part_words)).collect()
    pairs = [tuple(sorted((r.a, r.b))) for r in found]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {(a, b) for a in words for b in words if a < b and one_edit(a, b)}
    assert all(r.a_n == len(r.a) and r.b_n == len(r.b) for r in found)


def corpus():
    rnd = random.Random(3)
    common = vocabulary(12, 8, "abcdefghé") + ["schools", "schoolss", "scchoolss", "Straßen"]
    rows = []
    for i in range(60):
        own = [rnd.choice(common) for _ in range(80)]
        own += [w[:j] + rnd.choice("xyz") + w[j + 1 :] for w in common[:4] for j in (rnd.randrange(3),)]
        rows.append((i, rnd.choice([" ", "×", ", ", "1"]).join(w.upper() if rnd.random() < 0.2 else w for w in own)))
    chain = [(100, "mmmmmm " * 5), (101, "mmmmmmm " * 40), (102, "mmmmmmmn " * 210), (103, "mmmmmm mmmmmm")]
    return [*rows, *chain, (None, "schools " * 4), (None, None), (3, ""), (5, "日本 schools"), *rows[:3]]


@pytest.mark.parametrize("drop", [199, 3])
def test_against_plain_python(spark, drop):
    rules, rows = Rules(drop_one_in=drop), corpus()
    out = spelling_variants.variants(with_extras(docs_table(spark, rows)), rules)
    columns = ("word", "n", "n_near", "form", "form_n", "root")
    found = sorted(tuple(r[c] for c in columns) for r in out.collect())
    expected = plain(plain_words(rows, rules), rules)
    assert found == expected
    assert drop == 3 or any(r[3] and r[5] != r[3] for r in expected)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "short words")]])
def test_no_words(spark, rows):
    assert spelling_variants.variants(docs_table(spark, rows)).collect() == []


def test_very_long_text(spark):
    docs = spark.range(1).select(F.col("id").alias("doc_id"), F.expr("repeat('Letters, ', 200000)").alias("text"))
    assert [tuple(r) for r in spelling_variants.variants(docs).select("word", "n", "root").collect()] == [("letters", 200000, "letters")]
