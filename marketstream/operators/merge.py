"""Keyed merges of a stored relation with a batch, as plain relational results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .latest import newest_values


def insert_new(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Batch rows whose key the target does not hold, one per key.

    The target is first cut to the keys of the batch: a small batch is then the broadcast side
    (Spark checks its size) and the target is only scanned; a large one shuffles both by key once
    and the second join reuses that layout. Copies of a key are reduced before each shuffle.
    """
    keys = list(keys)
    for key in keys:
        batch = batch.where(F.col(key).isNotNull())
    incoming = batch.dropDuplicates(keys)
    known = target.select(*keys).join(batch.select(*keys).distinct(), keys, "left_semi")
    return incoming.join(known, keys, "left_anti")


def upsert_replace(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], order_col: str
) -> DataFrame:
    """Union in which the row with the highest ``order_col`` per key wins."""
    values = [c for c in target.columns if c not in keys and c != order_col]
    merged = target.unionByName(batch.select(*target.columns))
    return merged.groupBy(*keys).agg(*newest_values(values, order_col)).select(*target.columns)


def upsert_add(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], measures: Sequence[str]
) -> DataFrame:
    """Union in which the measures of equal keys are added up."""
    columns = [*keys, *measures]
    return (
        target.select(*columns)
        .unionByName(batch.select(*columns))
        .groupBy(*keys)
        .agg(*[F.sum(m).alias(m) for m in measures])
    )
