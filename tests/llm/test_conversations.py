import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from helpers import with_extras

from marketstream.llm import conversation_trie

TABLE = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows):
    """The nodes by walking every prefix of every rebuilt conversation."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    whole = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = tuple(own.get(c - c % 100, [])[:h] + ts[h:])
    members = defaultdict(list)
    for c, ts in whole.items():
        for d in range(len(ts) + 1):
            members[ts[:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    sums = {}
    for node in sorted(members, key=len, reverse=True):
        below = [sums[n] for n in children[node]]
        own_saved = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        sums[node] = (sum(b[0] for b in below) or int(not below), own_saved + sum(b[1] for b in below))
    out = []
    for node, ms in members.items():
        ends = ",".join(str(c) for c in sorted(ms) if len(whole[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(ms), len(node), parent, len(ms), len(children[node]), *sums[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows, **options):
    table = with_extras(spark.createDataFrame(rows, TABLE).repartition(3))
    out = conversation_trie.trie(table, **options)
    assert out.columns == COLUMNS
    return sorted((tuple(r) for r in out.collect()), key=str)


def corpus():
    rnd = random.Random(2)
    words = ["hello", "why?", "yes", "", "né", "日本"]
    rows = []
    for c in [*range(0, 40), *range(130, 160), 200, 205, 777, 1000]:
        for t in range(rnd.choice([1, 2, 4, 9])):
            rows.append((c, t, rnd.choice(["user", "assistant"]), rnd.choice(words)))
    rows += [(300 + c, t, "user", "the same") for c in range(30) for t in range(6)]
    odd = [(41, None, "user", "first"), (41, 0, None, "a"), (41, 0, None, None), (41, 0, "b", None), (None, 0, "user", "lost")]
    return rows + odd + rows[:3]


def test_against_plain_python(spark):
    rows = corpus()
    assert found(spark, rows) == plain(rows)


def test_conversations_deeper_than_several_bands(spark):
    rnd = random.Random(1)
    rows = corpus() + [(c, t, "user", f"t{t}" if t < 12 else rnd.choice("ab")) for c in (500, 501, 502, 503, 504) for t in range(30)]
    assert found(spark, rows, band=3) == plain(rows)


def test_long_conversations_cross_real_bands(spark):
    band = conversation_trie.BAND
    rows = [(c, t, "user", f"t{t}" if t < 2 * band + 5 or c < 3 else f"{c}") for c in range(5) for t in range(3 * band + c)]
    assert found(spark, rows) == plain(rows)


def test_many_conversations_end_at_one_node(spark):
    rows = [(c, t, "user", f"x{t}") for c in range(300) for t in range(6)]
    assert found(spark, rows, piece_bytes=20) == plain(rows)


@pytest.mark.parametrize("rows", [[], [(None, 1, "user", "x")], [(7, None, None, None)], [(8, 1, "user", "x" * 300_000), (9, 1, "user", "x")]])
def test_small_tables(spark, rows):
    assert found(spark, rows) == plain(rows)
