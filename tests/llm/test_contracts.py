"""Every corpus query and the pipeline as the driver calls them: columns, types, one row per document."""

import re

import corpus_pipeline
import pytest

from marketstream.llm import queries

WHOLE = "one row per document"
CONTRACTS = {
    "op1_pii": (WHOLE, {"doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint", "n_phone": "bigint", "base_sha256": "string", "spans": "string"}),
    "op2_suffix_dedup": ("", {"doc_id": "bigint", "first_doc_id": "bigint", "removed": "boolean"}),
    "op3_language_model": (WHOLE, {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint", "base_score": "double", "score": "double"}),
    "op4_source_mixing": (WHOLE, {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"}),
    "op5_toxicity": (WHOLE, {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}),
    "op6_language_id": (WHOLE, {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"}),
    "op7_embedding_dedup": ("one row per vector", {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean"}),
    "op8_quality": (WHOLE, {"doc_id": "bigint", "held_out": "boolean", "score": "double", "kept": "boolean"}),
    "op9_decontamination": ("", {"doc_id": "bigint"}),
    "op10_simhash_dedup": (WHOLE, {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"}),
    "op11_exact_dedup": (WHOLE, {"doc_id": "bigint", "keep_id": "bigint", "group_size": "bigint", "kept": "boolean", "text_sha256": "string"}),
    "op12_spelling_variants": ("", {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"}),
    "op13_conversation_trie": ("", {c: "bigint" for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")} | {"ends_sha256": "string"}),
}


def test_every_query_has_a_contract():
    assert set(CONTRACTS) == set(queries.QUERIES)


@pytest.mark.parametrize("name", list(CONTRACTS))
def test_columns_types_and_rows(spark, sf_dir, name):
    rows, columns = CONTRACTS[name]
    result = queries.QUERIES[name](spark, sf_dir)
    found = dict(result.dtypes)
    assert {c: found.get(c) for c in columns} == columns
    got = result.collect()
    if rows:
        key, table = ("vec_id", "embeddings") if "vector" in rows else ("doc_id", "documents")
        ids = sorted(r[0] for r in spark.read.parquet(f"{sf_dir}/{table}.parquet").select(key).collect())
        assert sorted(r[key] for r in got) == ids
    for r in got:
        if "score" in found and name in ("op5_toxicity", "op6_language_id", "op8_quality"):
            assert 0 <= r.score <= 1
        for digest in ("base_sha256", "text_sha256", "ends_sha256"):
            assert digest not in found or re.fullmatch("[0-9a-f]{64}", r[digest])
        assert "fingerprint" not in found or re.fullmatch("[0-9a-f]{16}", r.fingerprint)
        assert "predicted" not in found or r.predicted == int(r.score >= 0.5)


def test_pipeline_chains_its_stages(spark, sf_dir):
    """Each stage gets what the one before kept; the last one repeats rows as often as it takes them."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs, left = documents, {r.doc_id for r in documents.select("doc_id").collect()}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "pii", "mixing"]
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == documents.columns
        ids = [r.doc_id for r in docs.select("doc_id").collect()]
        assert set(ids) <= left
        assert name == "mixing" or len(ids) == len(set(ids))
        left = set(ids)
    assert left
    whole = corpus_pipeline.run(spark, sf_dir)
    assert sorted(r.doc_id for r in whole.select("doc_id").collect()) == sorted(ids)
