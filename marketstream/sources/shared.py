"""Where jobs keep checkpoints and written tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new directory path under the folder named by ``spark.checkpoint.dir``.

    Only a local session may do without that setting; it gets a temporary directory.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix=f"{purpose}-")


def shared_database(spark: SparkSession, purpose: str) -> str:
    """A new catalog database whose tables live in a shared directory."""
    location = shared_dir(spark, purpose)
    name = f"{purpose}_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{location}'")
    return name
