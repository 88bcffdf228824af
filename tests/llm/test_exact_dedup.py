import hashlib
import random
from collections import defaultdict

import pytest
from helpers import docs_table, sentences, with_extras

from marketstream.llm import exact_dedup


def plain(rows):
    """The same table worked out in plain Python; of repeated rows any one is kept."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").encode().lower()].append(i)
    out = []
    for text, ids in groups.items():
        last = max(ids, key=lambda i: (i is not None, i or 0))
        sha, left = hashlib.sha256(text).hexdigest(), True
        for i in ids:
            out.append((i, last, len(ids), i == last and left, sha))
            left = left and i != last
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def corpus():
    rnd = random.Random(7)
    texts = sentences(30, 3)
    long = "".join(rnd.choice("abcdefgh ") for _ in range(3000))
    # The same blocks in another order, one more block, and a change in the last letter.
    turned = [long, long[64:] + long[:64], long + "a", long[:-1] + "X", long[:64] * 40, long[:64] * 41, long[:64] * 40]
    upper = [t.upper() for t in texts[:5]]
    copies = [texts[1]] * 60 + [long] * 5 + [texts[2].replace(" ", "  ")]
    rows = list(enumerate(texts + turned + upper + copies))
    odd = [(None, texts[1]), (None, "only null"), (None, "only null"), (500, None), (501, ""), (502, " "), (3, texts[3]), (3, texts[3]), (503, "Ä"), (504, "ä")]
    return rows + odd


@pytest.mark.parametrize("block_bytes", [16, 64, exact_dedup.BLOCK_BYTES])
def test_against_plain_python(spark, block_bytes):
    rows = corpus()
    out = exact_dedup.duplicates(with_extras(docs_table(spark, rows)), block_bytes)
    assert out.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert found(out) == plain(rows)


def test_a_block_that_fills_many_partitions_has_one_name(spark):
    """Whole partitions of one key, in the first round and in a later one."""
    rows = [(i, "same text " * 50) for i in range(400)] + [(1000 + i, "same text " * 50 + f"{i % 7}") for i in range(60)]
    assert found(exact_dedup.duplicates(docs_table(spark, rows), 16)) == plain(rows)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(None, None), (None, "")], [(2, "a"), (1, "A")]])
def test_small_tables(spark, rows):
    assert found(exact_dedup.duplicates(docs_table(spark, rows))) == plain(rows)


def test_kept_rows_have_all_their_columns(spark):
    rows = corpus()
    docs = with_extras(docs_table(spark, rows)).withColumnRenamed("tail", "a.b")
    kept = exact_dedup.keep_last(docs)
    assert kept.columns == docs.columns
    expected = [(i, hashlib.sha256((t or "").encode().lower()).hexdigest()) for i, t in rows]
    last = {s: k for _, k, _, _, s in plain(rows)}
    assert sorted(((r.doc_id, hashlib.sha256((r.text or "").encode().lower()).hexdigest()) for r in kept.collect()), key=str) == sorted(
        {(k, s) for s, k in last.items() if (k, s) in set(expected)}, key=str
    )
