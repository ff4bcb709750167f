"""Target-distribution importance resampling over hashed word n-grams.

A text's UTF-8 bytes go through one 256-byte table that lower-cases A-Z and
blanks every separator, ``bytes.split`` yields the words, and the checksum of
an n-gram is the checksum of its first n - 1 words carried on over a space and
the last one.  Every task counts its features by bucket, the counts of all
tasks are summed by bucket, and the ``buckets`` sums of corpus and target (a
fixed number whatever the input) give each bucket its gain.  A second pass adds
up the gains of each document's features.  Draws are the highest scores, a
document's mean gain plus Gumbel noise of its id, which is sampling without
replacement in proportion to the weights; ranks come from a range-partitioned
sort with the partitions' sizes as offsets, so no task sees all rows.

Null and empty texts have no features, weight 0 and are not drawn (they have
fewer words than ``min_words``); a null doc_id is written as nothing in the
noise and ranked after the others of its score; equal scores and ids are ranked
in the order of a written row number; repeated rows count and are ranked each;
an empty table gives no rows, an empty target weighs every bucket by the
corpus alone; other columns than doc_id and text are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlens.llm.common import documents, numbered, written

BUCKETS, GRAMS, MIN_WORDS, SHARE, SEED = 10_000, 2, 20, 25, 7

#: 0-9, a-z and bytes beyond ASCII stay, A-Z become lower case, the rest a space.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


class Checksums(dict):
    """word -> crc32, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        h = self[word] = crc32(word)
        return h


_CHECKSUMS = Checksums()


def split_words(text: str | None) -> list[bytes]:
    return text.encode().translate(TABLE).split() if text else []


def feature_buckets(words: list[bytes], grams: int, buckets: int):
    """The bucket of every run of 1 to ``grams`` words, as a numpy array."""
    import numpy as np

    sums = [list(map(_CHECKSUMS.__getitem__, words))]
    if grams > 1:
        spaced = [b" " + w for w in words]
        for k in range(1, grams):
            sums.append(list(map(crc32, spaced[k:], sums[-1])))
    return np.fromiter(chain.from_iterable(sums), np.uint32, sum(map(len, sums))) % np.uint32(buckets)


def bucket_counts(texts: DataFrame, grams: int = GRAMS, buckets: int = BUCKETS) -> DataFrame:
    """bucket and its number of features over all of ``texts`` (column text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                words = split_words(text)
                if words:
                    total += np.bincount(feature_buckets(words, grams, buckets), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["bucket", "n"])

    return texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """floor(1000 ln(smoothed target share / smoothed corpus share)) of every
    bucket; ``buckets`` rows at most come to the driver from either side."""
    s, t = ({r["bucket"]: r["n"] for r in df.collect()} for df in (corpus, target))
    all_s, all_t = sum(s.values()), sum(t.values())
    return [math.floor(1000 * math.log((t.get(b, 0) + 1) * (all_s + buckets) / ((s.get(b, 0) + 1) * (all_t + buckets)))) for b in range(buckets)]


def weighed(docs: DataFrame, gains: list[int], grams: int = GRAMS) -> DataFrame:
    """doc_id, n_words, n_features and the floored mean gain of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        gain = np.array(gains, np.int64)
        for batch in batches:
            n_words, n_features, weights = [], [], []
            for text in batch.column(1).to_pylist():
                words = split_words(text)
                at = feature_buckets(words, grams, len(gain)) if words else ()
                n_words.append(len(words))
                n_features.append(len(at))
                weights.append(int(gain[at].sum()) // len(at) if words else 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.int64()) for x in (n_words, n_features, weights))], ["doc_id", "n_words", "n_features", "weight"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_words long, n_features long, weight long")


def with_score(rows: DataFrame, seed: int = SEED) -> DataFrame:
    """weight plus floored Gumbel noise of the id, in thousandths."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return rows.withColumn("score", F.col("weight") + F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))))


def resample(docs: DataFrame, target: DataFrame, share: int = SHARE, min_words: int = MIN_WORDS, grams: int = GRAMS, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of every document;
    the floor(share % of those with ``min_words``) best have a rank from 1."""
    gains = bucket_gains(bucket_counts(docs, grams, buckets), bucket_counts(target, grams, buckets), buckets)
    rows = written(with_score(weighed(docs, gains, grams), seed).withColumn("_row", F.monotonically_increasing_id()), "weighed")
    fit = F.col("n_words") >= min_words
    drawn = share * rows.where(fit).count() // 100
    ordered = numbered(rows, [(~fit).cast("int").asc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("_row").asc()], "place")
    return ordered.select("doc_id", "n_words", "n_features", "weight", "score", F.when(F.col("place") < drawn, F.col("place") + 1).alias("rank"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")
