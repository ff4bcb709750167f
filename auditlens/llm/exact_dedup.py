"""Exact deduplication against a persistent digest index.

The index is a Parquet table bucketed and sorted by digest.  A batch of new
documents is reduced to one row per digest (partial aggregation first, so a
group of copies of any size is one row per task), anti-joined with the index
by sort-merge and the remainder appended.  Both the anti-join and the join that
decides on a batch read the index in its buckets, so it is never shuffled: only
the batch's digests move, one row per digest and task, never texts.  Where
copies outnumber the rest, what was looked up is written and joined back, and
Spark splits hot digests.

Rules: texts are equal when identical after replacing each run of ASCII white
space by one space (null counts as empty).  Within a batch the smallest doc_id
of equal texts stays (null ids lose; if all ids are null, one null row stays);
a text that the index already holds is never kept again.  Rows repeated with
the same doc_id and text keep one copy, any one of them where their other
columns differ.  An empty batch appends nothing.  Columns other than the id and
the text pass through untouched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlens.llm.common import discard, fresh_path, partitions, text_or_empty, written

#: White space that equal texts may differ in.
SPACES = r"[\x20\x09-\x0D]+"


def text_digest(col: str | Column = "text") -> Column:
    """Lowercase hex SHA-256 of the normalised text."""
    return F.sha2(F.regexp_replace(text_or_empty(col), SPACES, " "), 256)


class DigestIndex:
    """Digests seen so far with the id that stays for each.

    ``path`` must be a shared folder.  Opening an existing folder again (for
    instance in a later application) continues that index; the number of
    buckets is part of the layout and must stay the same.
    """

    def __init__(self, spark: SparkSession, path: str, n_buckets: int, id_type: T.DataType | None = None):
        self.spark, self.path, self.n_buckets = spark, path, n_buckets
        kind = (id_type or T.LongType()).simpleString()
        self.table = "digest_index_" + "".join(c if c.isalnum() else "_" for c in path)[-80:]
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} (digest STRING, keep_id {kind}) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {n_buckets} BUCKETS LOCATION '{path}'")

    def bucketed(self) -> DataFrame:
        return self.spark.table(self.table)

    def entries(self) -> DataFrame:
        """The index read as plain files, for joins that split hot digests."""
        return self.spark.read.schema("digest STRING, " + self.bucketed().schema["keep_id"].simpleString().replace(":", " ")).parquet(self.path)

    def append(self, batch: DataFrame) -> None:
        """Add the digests of ``batch`` (columns doc_id, digest) that are new."""
        # written first: else the optimizer moves the anti-join below the aggregate and whole groups of copies are shuffled
        first = written(batch.groupBy("digest").agg(F.min("doc_id").alias("keep_id")), "exact-batch")
        fresh = first.join(self.bucketed().select("digest").hint("merge"), "digest", "left_anti")
        fresh.repartition(self.n_buckets, "digest").sortWithinPartitions("digest").write.insertInto(self.table)
        self.spark.catalog.refreshTable(self.table)
        discard(first)

    def close(self) -> None:
        """Take the table out of the catalogue; its files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")

    def decide(self, digests: DataFrame) -> DataFrame:
        """One row per row of ``digests`` (doc_id, digest): doc_id, digest,
        keep_id, group_size over ``digests`` and kept."""
        copies = digests.groupBy("digest", "doc_id").agg(F.count(F.lit(1)).alias("n_rows"))
        rows = written(copies, "exact-rows")
        sizes = rows.groupBy("digest").agg(F.sum("n_rows").alias("group_size"))
        # written, so that the join below has a shuffle on both sides and a hot digest can be split
        groups = written(sizes.repartition(self.n_buckets, "digest").join(self.bucketed().hint("merge"), "digest"), "exact-groups")
        return (rows.join(groups, "digest")
                .select("doc_id", "digest", "keep_id", "group_size", F.explode(F.expr("sequence(1L, n_rows)")).alias("copy"))
                .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1))
                .drop("copy"))


def ingest(spark: SparkSession, digests: DataFrame, n_batches: int = 2) -> DigestIndex:
    """Build an index from ``digests`` in ascending id ranges, batch by batch,
    so that the smallest id of equal texts is met first."""
    index = DigestIndex(spark, fresh_path(spark, "digest-index"), partitions(spark), digests.schema["doc_id"].dataType)
    probs = [i / n_batches for i in range(1, n_batches)]
    cuts = sorted(set(digests.agg(F.percentile_approx("doc_id", probs, 1000)).first()[0] or []))
    bounds = [None, *cuts, None]
    for lo, hi in zip(bounds, bounds[1:], strict=False):
        part = digests
        if lo is not None:
            part = part.where((F.col("doc_id") > lo) | (F.col("doc_id").isNull() if hi is None else F.lit(False)))
        if hi is not None:
            part = part.where(F.col("doc_id") <= hi)
        index.append(part)
    return index


def dedup_rows(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Decision for every document: doc_id, digest, keep_id, group_size, kept."""
    digests = written(docs.select("doc_id", text_digest().alias("digest")), "exact-digests")
    index = ingest(spark, digests)
    decided = index.decide(digests)
    index.close()
    return decided


def keep_first(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns.  Texts meet the rows
    that stay once; rows repeated with id and text are reduced by partial
    aggregates, so they are not gathered whole."""
    inner = {c: f"_k{i}" for i, c in enumerate(docs.columns)}
    keyed = docs.select(F.col("doc_id").alias("_id"), text_digest().alias("_digest"), *[F.col(f"`{c}`").alias(x) for c, x in inner.items()])
    decided = written(dedup_rows(spark, docs).groupBy("doc_id", "digest").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("_n")).where("kept"), "exact-kept")
    kept = decided.select(F.col("doc_id").alias("_keep"), F.col("digest").alias("_kept_digest"), "_n")

    def meeting(kept: DataFrame) -> DataFrame:
        return keyed.join(kept, keyed["_id"].eqNullSafe(kept["_keep"]) & (keyed["_digest"] == kept["_kept_digest"]))

    out = [F.col(x).alias(c) for c, x in inner.items()]
    once = meeting(kept.where("_n = 1")).select(*out)
    if not kept.where("_n > 1").limit(1).count():
        return once
    one_each = meeting(kept.where("_n > 1")).groupBy("_id", "_digest").agg(F.first(F.struct(*inner.values())).alias("_row"))
    return once.unionByName(one_each.select("_row.*").select(*out))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from auditlens.llm.common import documents
    return dedup_rows(spark, documents(spark, sf_dir)).select(
        "doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


OP6_SQL = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""
