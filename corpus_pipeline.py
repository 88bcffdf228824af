"""From raw documents to a training mix: five stages, each written before the next one reads it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketstream.llm import decontamination, near_copies, pii, quality, source_mixing
from marketstream.llm.common import stored

#: A trained classifier, word statistics and hashed places have no SQL form; tests compare each stage
#: with a brute-force version.
ORACLE_SQL = None


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fit on the rated documents, keep those more likely than not above the lowest grade."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    ratings = labels.select("doc_id", F.col("quality").alias("grade"))
    return quality.select(docs, quality.train(docs, ratings))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_copies.keep_first(docs)


def drop_benchmark_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.without_hits(docs, benchmark)


def remove_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = pii.sanitise(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per copy taken."""
    return source_mixing.mixed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", drop_low_quality),
    ("near_duplicates", drop_near_copies),
    ("decontamination", drop_benchmark_text),
    ("pii", remove_personal_data),
    ("mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stored(docs, f"stage-{name}")
    return docs
