"""Corpus preparation: language ID, exact dedup, near-dedup, removal of long
repeated strings and packing, each stage on what the one before kept.

Every stage but the last returns documents with all their columns.  Rows whose
language cannot be told (no text, no letter, or two languages whose sizes
differ by less than 0.5 %) go; of equal texts the smallest doc_id stays; of
each near-duplicate class one document stays; repeated strings of
``REPEAT_BYTES`` are cut from texts; the rest is packed into sequences of 2048
tokens (one row a piece).  Empty tables pass through every stage as empty
tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from auditlens.llm.common import documents, fresh_path
from auditlens.llm.exact_dedup import keep_first
from auditlens.llm.language import keep_identified
from auditlens.llm.near_dedup import keep_one
from auditlens.llm.packing import pack_documents
from auditlens.llm.suffix_dedup import remove_repeats


#: Shorter than a passage of fifty words is in nearly all cases.
REPEAT_BYTES = 250
#: The workers keep the tokenizer's caches beside those of the other stages: smaller ones than for packing alone.
CACHES = {"max_chunks": 150_000, "max_pieces": 100_000}


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5."""
    return keep_identified(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6."""
    return keep_first(spark, docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1."""
    return keep_one(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3."""
    return remove_repeats(docs, REPEAT_BYTES)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10."""
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), **CACHES)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("best_fit_packing", pack),
]

#: SQL has no compression, hashing into darts or tokenizer; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written as Parquet."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
