"""Small document tables and plain versions of the shared rules."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that operators use inside; tables may bring them along.
EXTRA = ("row", "node", "key", "spans", "fp", "rank", "size", "n", "word", "hits", "linked", "tail")


def docs_table(spark, rows, source=lambda i: f"s{i % 3}", lang=lambda i: "en"):
    """A document table from ``(doc_id, text)``."""
    full = [(i, t, lang(n), source(n), len(t or "")) for n, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, DOCS).repartition(3)


def with_extras(df):
    """The same rows with additional columns of names that operators use inside."""
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit(c) for c in EXTRA})


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def sentences(count: int, seed: int, size: int = 40, vocabulary: int = 400) -> list[str]:
    """Random texts of invented words."""
    rnd = random.Random(seed)
    known = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(2, 8))) for _ in range(vocabulary)]
    return [" ".join(rnd.choice(known) for _ in range(rnd.randint(size // 2, 2 * size))) for _ in range(count)]


def roots(links, nodes):
    """Least reachable node of each node, by plain merging."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
