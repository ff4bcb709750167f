"""Registered queries over whole small tables: one row a document, and their
stated columns."""

import pytest

import __spark_entry__ as E
from auditlens.llm.registry import ORACLE, QUERIES
from tests.conftest import SF

COLUMNS = {
    "op1_dart_minhash": {"doc_id", "class_id"},
    "op3_prefix_doubling": {"doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"},
    "op4_ring_shards": {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"},
    "op6_exact_dedup": {"doc_id", "keep_id", "group_size", "kept", "text_sha256"},
    "op9_imatch": {"doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"},
    "op12_importance_resampling": {"doc_id", "n_features", "weight", "score", "rank"},
    "op13_entropy_mixing": {"doc_id", "size", "source_size", "target", "taken"},
}


def test_entry_has_them():
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())
    assert sorted(q.split("_")[0] for q in QUERIES) == sorted([*(f"op{n}" for n in range(1, 14)), "pipeline"])


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_one_row_a_document(spark, name):
    df = QUERIES[name](spark, SF)
    assert COLUMNS[name] <= set(df.columns)
    ids = [r.doc_id for r in df.collect()]
    assert sorted(ids) == sorted(r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect())
