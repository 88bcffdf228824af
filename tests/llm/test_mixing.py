import re
from collections import Counter, defaultdict

import pytest
from helpers import docs_table, sentences, with_extras
from pyspark.sql import functions as F

from marketstream.llm import source_mixing as mixing


def rows_of(count):
    texts = sentences(count, 2, size=30)
    return [*enumerate(texts), (9000, None), (9001, ""), (9002, texts[0]), (9002, texts[0]), (None, texts[1])]


def source(n):
    return None if n % 17 == 0 else ("é" if n % 5 == 0 else "b" if n % 3 == 0 else "a")


def plain_targets(sizes, mixture):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: mixture.weights[i % len(mixture.weights)] for i, s in enumerate(names)}
    wanted, full = mixture.share * sum(sizes.values()), set()
    while True:
        rest = sum(w for s, w in weight.items() if s not in full)
        level = (wanted - sum(2 * sizes[s] for s in full)) / rest if rest else 0
        over = {s for s in names if s not in full and level * weight[s] > 2 * sizes[s]}
        if not over:
            return {s: 2.0 * sizes[s] if s in full else level * weight[s] for s in names}
        full |= over


@pytest.mark.parametrize("share", [1.5, 0.4])
def test_targets_and_takings(spark, share):
    rows = rows_of(400)
    mixture = mixing.Mixture(share=share)
    got = mixing.with_copies(with_extras(docs_table(spark, rows, source)), mixture).collect()
    assert len(got) == len(rows)
    sizes, taken, largest = Counter(), Counter(), Counter()
    for n, (_, text) in enumerate(rows):
        sizes[source(n)] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    want = plain_targets(sizes, mixture)
    for r in got:
        assert r.mix_size == len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        assert r.mix_source_size == sizes[r.source] and r.mix_target == pytest.approx(want[r.source])
        assert 0 <= r.mix_copies <= 2
        taken[r.source] += r.mix_size * r.mix_copies
        largest[r.source] = max(largest[r.source], r.mix_size)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 2 * largest[s]


def test_rerun_and_row_order_agree(spark):
    rows = rows_of(150)
    one = mixing.with_copies(docs_table(spark, rows, source))
    two = mixing.with_copies(docs_table(spark, rows, source).repartition(7))
    counts = [Counter((r.doc_id, r.mix_size, r.source, r.mix_copies) for r in d.collect()) for d in (one, two)]
    assert counts[0] == counts[1]


def test_hot_source_of_one_size_is_cut_into_parts(spark, monkeypatch):
    monkeypatch.setattr(mixing, "PART_ROWS", 10)
    rows = [(i, "a b c d") for i in range(500)]
    got = mixing.with_copies(docs_table(spark, rows, lambda n: "hot" if n < 400 else "x")).collect()
    by = defaultdict(int)
    for r in got:
        by[r.source] += r.mix_size * r.mix_copies
    target = {r.source: r.mix_target for r in got}
    assert all(abs(by[s] - target[s]) <= 4 for s in by)


def test_mixed_rows_and_empty_table(spark):
    rows = rows_of(60)
    docs = docs_table(spark, rows, source)
    mixed = mixing.mixed(docs)
    copies = sum(r.mix_copies for r in mixing.with_copies(docs).collect())
    assert mixed.columns == docs.columns and mixed.count() == copies
    assert mixing.with_copies(docs_table(spark, [])).count() == 0
    assert mixing.with_copies(docs_table(spark, [(1, ""), (2, None)])).count() == 2


def test_plan_has_no_python(spark):
    plan = mixing.mixed(docs_table(spark, [(1, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_rows_without_id_are_taken_alike_however_they_are_dealt(spark):
    rows = [(None, f"w{i} a b c") for i in range(3000)]
    one, two = (mixing.mixed(docs_table(spark, rows, source=lambda i: "s").repartition(n)) for n in (2, 7))
    counts = [Counter(r.text for r in d.collect()) for d in (one, two)]
    assert counts[0] == counts[1] and set(counts[0].values()) == {1, 2}
    parts = mixing.with_copies(docs_table(spark, rows, source=lambda i: "s"))
    assert parts.count() == 3000


def test_columns_of_any_name_are_kept(spark):
    docs = docs_table(spark, [(i, "a b c") for i in range(20)]).withColumn("mix_size", F.lit("mine")).withColumn("a.b", F.lit(1))
    taken = mixing.mixed(docs)
    assert taken.columns == docs.columns
    assert {r.mix_size for r in taken.collect()} == {"mine"}
