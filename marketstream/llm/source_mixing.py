"""Mixing sources to target weights by systematic sampling, in DataFrame operations only.

Documents of a source stand in one order: by size class, then by a hashed id. Each is expected to be
taken ``target / source size`` times. The running sum of these expectations plus one random offset is
taken along the order, and a document is emitted once per integer that its share crosses. As the
order follows the size, what a source gives stays within about one of its largest documents of its
target.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import WORD, stored, whole_row

#: A cell of equal source and size class is cut into so many hashed parts, or one more for every
#: ``PART_ROWS`` documents of the input: no part holds more than about that many.
LEAST_PARTS, PART_ROWS = 16, 20_000
OFFSET_STEPS = 1 << 20
RANGES = 64


@dataclass(frozen=True)
class Mixture:
    """Weights repeat over the sources in code point order, null last."""

    weights: tuple[int, ...] = (3, 1, 2)
    share: float = 1.5
    most_copies: int = 2
    seed: str = "mix"

    @property
    def offset(self) -> float:
        """The random offset, from 0 to 1; a binary fraction, so that sums with it are exact."""
        state = 0
        for byte in self.seed.encode():
            state = (state * 1103515245 + 12345 + byte) % (1 << 31)
        return (state % OFFSET_STEPS) / OFFSET_STEPS


def _size_class(size: Column) -> Column:
    """Number of digits and the first two digits: classes are at most a tenth wide."""
    digits = size.cast("string")
    return (F.length(digits) * 100 + F.substring(digits, 1, 2).cast("int")).cast("int")


def _ordinals(sources: DataFrame) -> DataFrame:
    """0, 1, 2, … over the sources in order; no task ranks more than one range of them."""
    ranges = sources.repartitionByRange(RANGES, F.col("mix_key") == "", "mix_key")
    placed = stored(ranges.withColumn("mix_range", F.spark_partition_id()), "sources")
    before = W.orderBy("mix_range").rowsBetween(W.unboundedPreceding, -1)
    counts = placed.groupBy("mix_range").count()  # RANGES rows at most
    starts = counts.select("mix_range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("mix_start"))
    inside = W.partitionBy("mix_range").orderBy(F.col("mix_key") == "", "mix_key")
    place = F.col("mix_start") + F.row_number().over(inside) - 1
    return placed.join(starts, "mix_range").withColumn("mix_place", place).drop("mix_range", "mix_start")


def targets(sources: DataFrame, mixture: Mixture) -> DataFrame:
    """Adds ``mix_target`` to sources with ``mix_key`` and ``mix_source_size``.

    What a full source cannot take is shared again by weight among the others, until none is above
    its limit. Each round sums over all sources; only two sums reach the driver.
    """
    weight = F.element_at(
        F.array(*map(F.lit, mixture.weights)), (F.col("mix_place") % len(mixture.weights) + 1).cast("int")
    )
    weighed = stored(_ordinals(sources).withColumn("mix_weight", weight), "weights")
    limit = F.col("mix_source_size") * mixture.most_copies
    wanted = mixture.share * (weighed.agg(F.sum("mix_source_size")).first()[0] or 0)
    level, full = 0.0, -1
    while True:
        over = F.lit(False) if full < 0 else limit < F.col("mix_weight") * level
        count, taken, weights = weighed.agg(
            F.count_if(over), F.sum(F.when(over, limit)), F.sum(F.when(~over, F.col("mix_weight")))
        ).first()
        if count == full or not weights:
            break
        level, full = (wanted - (taken or 0)) / weights, count
    target = F.when(limit < F.col("mix_weight") * level, limit.cast("double")).otherwise(
        F.col("mix_weight") * F.lit(level)
    )
    return weighed.select("mix_key", "mix_source_size", target.alias("mix_target"))


def with_copies(docs: DataFrame, mixture: Mixture | None = None) -> DataFrame:
    """The columns of ``docs`` plus ``mix_size``, ``mix_source_size``, ``mix_target``, ``mix_copies``.

    The size of a document is its number of words, 0 for null or empty text. A null source is a
    source of its own, last in order; an empty string is a source too. Repeated rows each count. Rows
    without id are placed by their text, and so are those that share one: a rerun takes the same texts.
    Columns of ``docs`` whose names start with ``mix_`` are replaced. Text is shuffled only if it is asked for.
    """
    mixture = mixture or Mixture()
    docs = docs.drop(*(c for c in docs.columns if c.startswith("mix_")))
    key = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
    tie = F.xxhash64("text")
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text "), tie.cast("string")))
    order = F.md5(F.concat_ws(":", F.lit(mixture.seed), name).cast("binary"))
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    sized = docs.withColumns({"mix_key": key, "mix_size": size, "mix_order": order, "mix_tie": tie})
    cell = ["mix_key", "mix_class", "mix_part"]
    slim = stored(sized.select("mix_key", "mix_size", "mix_order"), "sizes")
    parts = max(LEAST_PARTS, -(-slim.count() // PART_ROWS))

    def placed(df: DataFrame) -> DataFrame:
        part = F.conv(F.substring("mix_order", 1, 8), 16, 10).cast("long") % parts
        return df.withColumns({"mix_class": _size_class(F.col("mix_size")), "mix_part": part})

    cells = placed(slim).groupBy(cell).agg(F.count("*").alias("n"), F.sum("mix_size").alias("words"))
    cells = stored(cells, "cells")
    shares = targets(cells.groupBy("mix_key").agg(F.sum("words").alias("mix_source_size")), mixture)

    earlier = W.partitionBy("mix_key").orderBy("mix_class").rowsBetween(W.unboundedPreceding, -1)
    within = W.partitionBy("mix_key", "mix_class").orderBy("mix_part")
    classes = cells.groupBy("mix_key", "mix_class").agg(F.sum("n").alias("n"))
    classes = classes.select("mix_key", "mix_class", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inner = F.coalesce(F.sum("n").over(within.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = cells.withColumn("inner", inner).join(classes, ["mix_key", "mix_class"]).join(shares, "mix_key")
    starts = starts.select(
        *cell, (F.col("before") + F.col("inner")).alias("mix_before"), "mix_source_size", "mix_target"
    )

    place = F.row_number().over(W.partitionBy(*cell).orderBy("mix_order", "mix_size", "mix_tie"))
    ranked = placed(sized).withColumn("mix_place", place).join(starts, cell)
    expected = F.when(F.col("mix_source_size") > 0, F.col("mix_target") / F.col("mix_source_size")).otherwise(0.0)
    upto = F.col("mix_before") + F.col("mix_place")
    crossed = F.floor(upto * expected + mixture.offset) - F.floor((upto - 1) * expected + mixture.offset)
    copies = F.least(crossed, F.lit(mixture.most_copies)).cast("long")
    return ranked.withColumn("mix_copies", copies).drop(*cell, "mix_order", "mix_tie", "mix_place", "mix_before")


def mixed(docs: DataFrame, mixture: Mixture | None = None) -> DataFrame:
    """The columns of ``docs``, whatever their names, each row as often as it is taken."""
    rows = docs.select(whole_row(docs).alias("row"), "doc_id", "source", "text")
    counted = with_copies(rows, mixture).filter("mix_copies > 0")
    copies = F.explode(F.sequence(F.lit(1), F.col("mix_copies").cast("int")))
    return counted.select("row", copies.alias("mix_copy")).select("row.*")
