"""Parallel append to a JDBC table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def jdbc_options(
    url: str,
    table: str,
    partitions: int = 4,
    batch_size: int = 2000,
    properties: Mapping[str, str] | None = None,
) -> dict[str, str]:
    return {
        "url": url,
        "dbtable": table,
        "numPartitions": str(partitions),
        "batchsize": str(batch_size),
        **(properties or {}),
    }


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    partitions: int = 4,
    batch_size: int = 2000,
    properties: Mapping[str, str] | None = None,
) -> None:
    """Append over ``partitions`` connections, one per partition, in even shares."""
    options = jdbc_options(url, table, partitions, batch_size, properties)
    df.repartition(partitions).write.format("jdbc").options(**options).mode("append").save()
