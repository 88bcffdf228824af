import numpy as np
import pytest
from helpers import roots
from pyspark.sql import functions as F

from marketstream.llm import embedding_dedup

KIND = "vec_id long, embedding array<float>, label int"


def vectors(count=500, size=64, seed=2):
    rnd = np.random.default_rng(seed)
    base = rnd.normal(size=(count, size))
    base[count // 2 :] = base[: count - count // 2] + rnd.normal(size=(count - count // 2, size)) * rnd.choice([0.02, 0.1, 0.2, 0.3], (count - count // 2, 1))
    base[:20] = base[0]
    rows = [(i, v.astype(np.float32).tolist(), int(i % 3)) for i, v in enumerate(base)]
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [0.0] * size, [None] + [1.0] * (size - 1), [nan] + [1.0] * (size - 1), [inf] + [1.0] * (size - 1), [1.0, 2.0], [2.0, 4.0]]
    rows += [(1000 + i, v, 1) for i, v in enumerate(odd)]
    rows += [(2000, rows[0][1], None), (2001, rows[0][1], 0), (2001, rows[0][1], 0), (None, rows[0][1], 0)]
    rows += [(2002, (np.array(rows[0][1]) * 3).tolist(), 0)]
    return rows


def plain(rows, least):
    def unit(v):
        if not v or any(x is None or not np.isfinite(x) for x in v):
            return None
        a = np.array(v, np.float32).astype(float)
        return a / np.sqrt((a**2).sum()) if (a**2).sum() > 0 else None

    units = [unit(v) if label is not None else None for _, v, label in rows]
    links = []
    for i, (a, ua) in enumerate(zip(rows, units, strict=True)):
        for j in range(i):
            ub = units[j]
            if ua is not None and ub is not None and a[2] == rows[j][2] and len(ua) == len(ub) and ua @ ub >= least:
                links.append((i, j))
    root = roots(links, range(len(rows)))
    count = [0] * len(rows)
    for a, b in links:
        count[a] += 1
        count[b] += 1
    least_id = {}
    for i, (v, _, _) in enumerate(rows):
        r = root[i]
        least_id[r] = min((x for x in (v, least_id.get(r)) if x is not None), default=None)
    return sorted((str(v), count[i], str(least_id[root[i]]), v is not None and v == least_id[root[i]]) for i, (v, _, _) in enumerate(rows))


@pytest.mark.parametrize("forest", [embedding_dedup.Forest(leaf=32), embedding_dedup.Forest(leaf=8, tile=16, levels=3)])
def test_links_and_components_equal_brute_force(spark, forest):
    rows = vectors()
    table = spark.createDataFrame(rows, KIND).withColumns({c: F.lit(1) for c in ("entry", "group", "leaf", "n", "usable")})
    got = embedding_dedup.near_duplicates(table, forest=forest).collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in got) == plain(rows, 0.98)


def test_dense_group_is_compared_in_tiles(spark):
    rnd = np.random.default_rng(1)
    near = rnd.normal(size=64) + rnd.normal(size=(300, 64)) * 0.01
    rows = [(i, v.astype(np.float32).tolist(), 1) for i, v in enumerate(near)]
    forest = embedding_dedup.Forest(leaf=32, tile=50)
    got = embedding_dedup.near_duplicates(spark.createDataFrame(rows, KIND), forest=forest).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(299, 0)}


def test_empty_table(spark):
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], KIND)).count() == 0
