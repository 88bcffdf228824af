"""Folders of the shared file system, whatever store that is."""

from __future__ import annotations

import time

from pyspark.sql import SparkSession


def _open(spark: SparkSession, folder: str) -> tuple:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), path


def exists(spark: SparkSession, folder: str) -> bool:
    store, path = _open(spark, folder)
    return store.exists(path)


def size(spark: SparkSession, folder: str) -> int:
    """Bytes of a file, or of all files in a folder."""
    store, path = _open(spark, folder)
    return store.getContentSummary(path).getLength()


def older_than(spark: SparkSession, folder: str, minutes: int) -> list[str]:
    """The folders inside ``folder`` that were last changed so long ago."""
    store, path = _open(spark, folder)
    if not store.exists(path):
        return []
    before = (time.time() - 60 * minutes) * 1000
    inside = store.listStatus(path)
    return sorted(f.getPath().toString() for f in inside if f.isDirectory() and f.getModificationTime() <= before)


def delete(spark: SparkSession, folder: str) -> None:
    store, path = _open(spark, folder)
    store.delete(path, True)
