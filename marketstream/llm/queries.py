"""One query per operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    conversation_trie,
    decontamination,
    embedding_dedup,
    exact_dedup,
    language_id,
    language_model,
    pii,
    quality,
    simhash_dedup,
    source_mixing,
    spelling_variants,
    suffix_dedup,
    toxicity,
)
from .common import remainder, stored


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(_table(spark, sf_dir, "documents"))
    spans = found.spans
    every = F.concat(spans, F.transform("linked", lambda s: F.struct(*(s[c].alias(c) for c in pii.SPAN))))
    return found.select(
        "doc_id",
        *(pii.count_of(spans, kind).alias(f"n_{kind}") for kind in pii.PATTERNS),
        F.sha2(pii.span_text(spans), 256).alias("base_sha256"),
        pii.span_text(F.array_sort(every)).alias("spans"),
        F.size("linked").cast("long").alias("n_linked"),
    )


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    passages = suffix_dedup.repeats(_table(spark, sf_dir, "documents"))
    return passages.select(
        F.col("doc").alias("doc_id"),
        F.col("first_doc").alias("first_doc_id"),
        "word_start",
        "word_end",
        (F.col("word_end") - F.col("word_start")).alias("n_words"),
        "removed",
    )


def op3_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = remainder(F.col("doc_id"), 10) == 0
    learned = docs.filter(~held_out)
    counts = stored(language_model.count_words(learned), "counts")
    model = language_model.train(learned, counts, F.col("doc_id"))
    scored = language_model.score(docs, model, counts)
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = source_mixing.with_copies(_table(spark, sf_dir, "documents"))
    return counted.select(
        "doc_id",
        F.col("mix_size").alias("size"),
        F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"),
        (F.col("mix_size") * F.col("mix_copies")).alias("taken"),
    )


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    held_out = remainder(F.col("doc_id"), 5) == 0
    model = toxicity.train(docs, labels.filter(~held_out))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
        F.size("toxic_spans").alias("n_spans"),
    )


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = remainder(F.col("doc_id"), 5) == 0
    model = language_id.train(docs, ~held_out)
    named = language_id.predict(docs.select("doc_id", "text"), model)
    return named.select("doc_id", held_out.alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    held_out = remainder(F.col("doc_id"), 5) == 0
    ratings = labels.filter(~held_out).select("doc_id", F.col("quality").alias("grade"))
    scored = quality.score(docs.select("doc_id", "text"), quality.train(docs, ratings))
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        "expected_grade",
        F.col("tail").alias("score"),
        (F.col("tail") >= 0.5).alias("kept"),
    )


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    looked = decontamination.with_hits(docs.select("doc_id", "text"), benchmark)
    return looked.select("doc_id", F.explode("hits").alias("hit")).select("doc_id", "hit.*")


def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_dedup.near_duplicates(_table(spark, sf_dir, "documents"))
    return groups.select(
        "doc_id", simhash_dedup.fingerprint_text(groups.fp).alias("fingerprint"), "component_id"
    )


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spelling_variants.variants(_table(spark, sf_dir, "documents"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.trie(_table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query for query in (
        op1_pii,
        op2_suffix_dedup,
        op3_language_model,
        op4_source_mixing,
        op5_toxicity,
        op6_language_id,
        op7_embedding_dedup,
        op8_quality,
        op9_decontamination,
        op10_simhash_dedup,
        op11_exact_dedup,
        op12_spelling_variants,
        op13_conversation_trie,
    )
}
