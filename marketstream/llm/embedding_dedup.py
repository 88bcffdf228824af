"""Near-duplicate vectors by a forest of random-projection trees.

Every tree projects the vectors on one random direction per level. A node splits at the median of its
projections; vectors close to it go to both sides. Vectors that end in one leaf are compared, and the
pairs found by any tree are united. Equal vectors of one label are one entry throughout.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches, stored
from .components import components


@dataclass(frozen=True)
class Forest:
    """``margin``: distance to the median within which a unit vector goes to both sides.

    Two unit vectors with cosine 0.98 lie 0.2 apart, which a random direction in 64 dimensions sees as
    0.025 on average; a pair is parted only if it lies on both sides of the margin.
    """

    trees: int = 4
    levels: int = 20
    margin: float = 0.025
    leaf: int = 256
    tile: int = 512
    seed: int = 7


def _usable() -> Column:
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    length = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    valid = F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.forall("embedding", number)
    return F.coalesce(valid & (length > 0) & (length < float("inf")), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return values.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(values), -1)


def _units(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors**2).sum(axis=1, keepdims=True))


def _projected(forest: Forest):
    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes):
                rows = batch.filter(pa.array(sizes == size))
                random = np.random.default_rng([forest.seed, int(size)])
                directions = random.normal(size=(int(size), forest.trees * forest.levels))
                directions /= np.sqrt((directions**2).sum(axis=0))
                seen = (_units(_matrix(rows.column("embedding"))) @ directions).astype(np.float32)
                for tree in range(forest.trees):
                    part = seen[:, tree * forest.levels : (tree + 1) * forest.levels]
                    ends = np.arange(len(part) + 1, dtype=np.int32) * forest.levels
                    yield pa.RecordBatch.from_arrays(
                        [rows.column("entry"), rows.column("group"), pa.array(np.full(len(part), tree, np.int32)),
                         pa.ListArray.from_arrays(pa.array(ends), pa.array(part.ravel()))],
                        ["entry", "group", "tree", "seen"],
                    )

    return project


def leaves(entries: DataFrame, forest: Forest) -> DataFrame:
    """``(entry, group, leaf)``: the leaves of all trees that each entry falls into.

    A level is one pass over the entries of nodes that are still too large. A node whose middle half
    is narrower than the margins would only be copied, so it waits for the next direction; what no
    direction parts stays one large leaf and is compared in tiles.
    """
    small_batches(entries.sparkSession)
    node = ["group", "tree", "node"]
    open_ = entries.select("entry", "group", "embedding", F.size("embedding").alias("size")).mapInArrow(
        _projected(forest), "entry long, group string, tree int, seen array<float>"
    )
    open_ = stored(open_.withColumn("node", F.lit(1).cast("decimal(38,0)")), "projections")
    closed = []
    for level in range(forest.levels):
        at = F.get("seen", F.lit(level))
        quarters = F.percentile_approx(at, [0.25, 0.5, 0.75], 1000)
        stats = open_.groupBy(node).agg(F.count("*").alias("n"), quarters.alias("q"))
        placed = stored(open_.join(stats, node), "level")
        small = F.col("n") <= forest.leaf
        closed.append(placed.filter(small).select("entry", *node))
        if placed.filter(~small).isEmpty():
            open_ = None
            break
        wide = F.get("q", F.lit(2)) - F.get("q", F.lit(0)) >= 2 * forest.margin
        middle = F.get("q", F.lit(1))
        below = F.when(at <= middle + forest.margin, F.col("node") * 2)
        above = F.when(at >= middle - forest.margin, F.col("node") * 2 + 1)
        sides = F.when(wide, F.array_compact(F.array(below, above))).otherwise(F.array(F.col("node")))
        sides = sides.cast("array<decimal(38,0)>")
        open_ = placed.filter(~small).select("entry", "group", "tree", "seen", F.explode(sides).alias("node"))
    if open_ is not None:
        closed.append(open_.select("entry", *node))
    leaf = F.xxhash64("tree", "node").alias("leaf")
    return stored(reduce(DataFrame.unionByName, closed).select("entry", "group", leaf), "leaves")


def _compared(least: float):
    kind = pa.schema([("entry", pa.int64()), ("root", pa.int64()), ("links", pa.int64())])

    def compare(table: pa.Table) -> pa.Table:
        """Links within one leaf or between two tiles of it, each pair in its least common leaf only."""
        order = np.argsort(table.column("entry").to_numpy(), kind="stable")
        table = table.take(pa.array(order))
        entry, weight = table.column("entry").to_numpy(), table.column("copies").to_numpy()
        tile, leaf = table.column("tile").to_numpy(), table.column("leaf")[0].as_py()
        units = _units(_matrix(table.column("embedding")))
        near = units @ units.T >= least
        np.fill_diagonal(near, False)
        if table.column("low")[0].as_py() != table.column("high")[0].as_py():
            near &= tile[:, None] != tile[None, :]
        if not near.any():
            return kind.empty_table()
        lists = table.column("leaves").combine_chunks()
        owner = np.repeat(np.arange(len(entry)), np.diff(lists.offsets.to_numpy()))
        ids = lists.flatten().to_numpy()
        earlier = ids < leaf
        _, column = np.unique(ids[earlier], return_inverse=True)
        met = np.zeros((len(entry), int(column.max(initial=-1)) + 1), np.float32)
        met[owner[earlier], column] = 1
        fresh = near & (met @ met.T == 0)
        links = (fresh * weight[None, :]).sum(axis=1)
        root = np.arange(len(entry))
        while True:
            spread = np.where(near, root[None, :], len(entry)).min(axis=1)
            lower = np.minimum(root, spread)
            lower = lower[lower]
            if (lower == root).all():
                break
            root = lower
        touched = near.any(axis=1)
        return pa.table(
            [pa.array(entry[touched]), pa.array(entry[root][touched]), pa.array(links[touched].astype(np.int64))], schema=kind
        )

    return compare


def near_duplicates(vectors: DataFrame, least: float = 0.98, forest: Forest | None = None) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row of ``vectors``.

    Rows link if their labels are equal and not null and their cosine in double precision is at least
    ``least``. Vectors that are null, zero, of no component, or hold null or non-finite components link
    with nothing. Vectors of different length never link. Repeated rows are vectors of their own that
    link with each other. Rows without ``vec_id`` count as links; a component of such rows alone has a
    null id and keeps none. Columns other than ``vec_id``, ``embedding``, ``label`` are not read.
    """
    forest = forest or Forest()
    rows = vectors.select("vec_id", "embedding", "label").withColumn("usable", _usable())
    group = F.concat_ws(":", F.col("label").cast("string"), F.size("embedding").cast("string"))
    usable = rows.filter("usable").select("vec_id", "embedding", group.alias("group"))
    entries = usable.groupBy("group", "embedding").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
    entries = stored(entries.withColumn("entry", F.monotonically_increasing_id()), "entries")

    placed = leaves(entries, forest)
    sizes = placed.groupBy("group", "leaf").agg(F.count("*").alias("n")).filter("n > 1")
    tiles = F.ceil(F.col("n") / forest.tile).cast("int")
    mine = F.when(tiles > 1, F.pmod(F.hash("entry"), tiles)).otherwise(0)
    lists = placed.groupBy("entry").agg(F.array_sort(F.collect_set("leaf")).alias("leaves"))
    spread = placed.join(sizes, ["group", "leaf"]).withColumn("tile", mine)
    spread = spread.withColumn("other", F.explode(F.sequence(F.lit(0), tiles - 1)))
    spread = spread.withColumns({"low": F.least("tile", "other"), "high": F.greatest("tile", "other")})
    full = entries.select("entry", "embedding", "copies").join(lists, "entry")
    members = spread.select("entry", "group", "leaf", "tile", "low", "high").join(full, "entry")
    found = members.groupBy("group", "leaf", "low", "high").applyInArrow(
        _compared(least), "entry long, root long, links long"
    )
    found = stored(found, "found")
    links = found.groupBy("entry").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("entry").alias("a"), F.col("root").alias("b")))

    whole = entries.join(links, "entry", "left").join(roots.withColumnRenamed("node", "entry"), "entry", "left")
    whole = whole.withColumn("root", F.coalesce("root", "entry"))
    ids = whole.groupBy("root").agg(F.min("least").alias("component"))
    whole = whole.join(ids, "root").select(
        "group", "embedding", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component"
    )
    linked = usable.join(whole, ["group", "embedding"]).select("vec_id", "n_links", F.col("component").alias("component_id"))
    alone = rows.filter(~F.col("usable")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    return linked.unionByName(alone).withColumn("kept", kept)
