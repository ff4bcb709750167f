"""Raw scans and sinks: pipe-delimited text, partitioned Parquet, CSV metric
tables, and snapshot fingerprints."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlens.functions.columns import NA_STRINGS
from auditlens.session import scratch_path


#: Rows of a compressed text file, which one task reads whole.
FILE_ROWS = 500_000


def write_raw_pipe(df: DataFrame, path: str, compression: str = "none") -> None:
    """Compressed files are not split by a scan, so they are kept short."""
    out = df.write.mode("overwrite").option("sep", "|").option("header", True).option("compression", compression)
    (out if compression == "none" else out.option("maxRecordsPerFile", FILE_ROWS)).csv(path)


def read_raw_pipe(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A1: all-string schema (no inference), splittable scan; the fixed list of
    missing-value strings becomes null in every column."""
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in columns])
    raw = spark.read.schema(schema).option("sep", "|").option("header", True).csv(path)
    return raw.select(*[F.when(~F.col(c).isin(*NA_STRINGS), F.col(c)).alias(c) for c in columns])


def export_splits(df: DataFrame, path: str, split_col: str = "split") -> None:
    """A4: one write, partitioned by split, so readers prune directories."""
    df.write.mode("overwrite").partitionBy(split_col).parquet(path)


def write_table_csv(df: DataFrame, path: str) -> None:
    """A5: small metric table → one CSV file with header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def read_table_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def canonical_text(df: DataFrame, col: str):
    """One text per value: doubles with six decimals, times as microseconds,
    anything else as its string."""
    kind = df.schema[col].dataType
    c = F.col(f"`{col}`")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return c.cast("decimal(30,6)").cast("string")
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.DoubleType, T.FloatType)):
        return F.array_join(F.transform(c, lambda x: x.cast("double").cast("decimal(30,6)").cast("string")), ",", "null")
    if isinstance(kind, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c).cast("string")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c).cast("string")
    return c.cast("string")


def canonical_value(df: DataFrame, col: str):
    """A value that is equal for equal ``canonical_text`` of a column, without
    the way over text for numbers, times and strings."""
    kind = df.schema[col].dataType
    c = F.col(f"`{col}`")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return c.cast("decimal(30,6)")
    plain = (T.IntegralType, T.DecimalType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    return c if isinstance(kind, plain) else canonical_text(df, col)


def content_fingerprint(df: DataFrame) -> DataFrame:
    """Order-insensitive content hash: the exact sum of all row hashes
    (partial sums combine map-side).

    A row's hash is the 60-bit md5 prefix of its text over all columns, in
    which every value is written with its length and nulls are apart.  The
    texts are columns of their own, so each is made once a row."""
    names = [f"_t{i}" for i in range(len(df.columns))]
    texts = df.select(*[canonical_text(df, c).alias(n) for c, n in zip(df.columns, names, strict=True)])
    parts = [F.coalesce(F.concat(F.length(n).cast("string"), F.lit(":"), F.col(n), F.lit(";")), F.lit("-;")) for n in names]
    row = F.conv(F.substring(F.md5(F.concat(*parts)), 1, 15), 16, 10).cast("decimal(38,0)")
    return texts.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(row).cast("decimal(38,0)").alias("content_hash"))


def range_fingerprints(df: DataFrame, key: str, width: int) -> DataFrame:
    """Content hash per range of ``width`` keys (null keys are a range of
    their own): first_key, n_rows, content_hash.

    These hashes are only held against each other, so a row's is one of 64
    bits over its values and which of them are null, made without texts."""
    first = (F.floor(F.col(key) / width) * width).cast("long")
    values = [x for v in (canonical_value(df, c) for c in df.columns) for x in (v, v.isNull())]
    rows = df.select(first.alias("first_key"), F.xxhash64(*values).cast("decimal(38,0)").alias("_hash"))
    return rows.groupBy("first_key").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("_hash").cast("decimal(38,0)").alias("content_hash"))


def changed_ranges(old: DataFrame, new: DataFrame) -> DataFrame:
    """The ranges whose rows differ between two results of
    ``range_fingerprints``: first_key, rows_old and rows_new."""
    o = old.select(F.col("first_key").alias("_k"), F.col("n_rows").alias("rows_old"), F.col("content_hash").alias("_h"))
    j = o.join(new, F.col("_k").eqNullSafe(F.col("first_key")), "full_outer")
    differ = ~(F.col("_h").eqNullSafe(F.col("content_hash")) & F.col("rows_old").eqNullSafe(F.col("n_rows")))
    return j.where(differ).select(F.coalesce("first_key", "_k").alias("first_key"), F.coalesce("rows_old", F.lit(0)).alias("rows_old"), F.coalesce("n_rows", F.lit(0)).alias("rows_new"))


#: Bytes of a file that one hash covers, and hashes under one parent.
BLOCK_BYTES, FAN = 64 * 1024 * 1024, 1024


def block_hashes(spark: SparkSession, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """File, block, n_bytes and SHA-256 of every ``block_bytes`` of the
    files under ``path``, of any size, each block read by one task.

    A block holds the lines that begin in its range (the first line of a file,
    and lines whose first byte is behind the range's first), every line closed
    by a line feed: the ranges in which Spark splits text.  Bytes are hashed as
    they are; a byte-order mark at a file's start is not hashed.  The result is
    written once."""
    import hashlib

    import pyarrow as pa

    def run(batches):
        digest = at = None
        size = 0

        def done():
            return pa.RecordBatch.from_pylist([{"_file": at[0], "start": at[1], "n_bytes": size, "sha256": digest.hexdigest()}], schema)

        schema = pa.schema([("_file", pa.int64()), ("start", pa.int64()), ("n_bytes", pa.int64()), ("sha256", pa.string())])
        for batch in batches:
            files, starts = (batch.column(i).to_numpy() for i in (0, 1))
            lines = batch.column(2).to_pylist()
            cuts = [0, *(i for i in range(1, len(lines)) if files[i] != files[i - 1] or starts[i] != starts[i - 1]), len(lines)]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if lo == hi:
                    continue
                if (int(files[lo]), int(starts[lo])) != at:
                    if at is not None:
                        yield done()
                    at, digest, size = (int(files[lo]), int(starts[lo])), hashlib.sha256(), 0
                text = b"\n".join([*lines[lo:hi], b""])
                digest.update(text)
                size += len(text)
        if at is not None:
            yield done()

    # a session of its own, as the width of splits is a setting
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", block_bytes)
    own.conf.set("spark.sql.files.minPartitionNum", 1)
    out = scratch_path(spark, f"blocks-{uuid.uuid4().hex}")
    lines = own.read.option("lineSep", "\n").text(path).select(F.xxhash64("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary"))
    lines.mapInArrow(run, "_file long, start long, n_bytes long, sha256 string").write.parquet(out)
    blocks = spark.read.parquet(out)
    files = _file_list(spark, path).select(F.xxhash64("path").alias("_file"), "file")
    return blocks.join(files, "_file").select("file", (F.col("start") / block_bytes).cast("long").alias("block"), "n_bytes", "sha256")


def _file_list(spark: SparkSession, path: str) -> DataFrame:
    """path, file (its last part) and length; contents are not read."""
    return spark.read.format("binaryFile").load(path).select("path", F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), "length")


def file_fingerprints(spark: SparkSession, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """File, length, n_blocks and the root of the tree of its block hashes
    (``FAN`` children a parent).  Spark's scans leave empty files out, so they
    have no row; files are named without their folder, so give one at a time."""
    blocks = block_hashes(spark, path, block_bytes)
    nodes = blocks.select("file", F.col("block").alias("at"), "sha256")
    n = blocks.agg(F.max("block")).first()[0]
    width = (n or 0) + 1
    while True:
        child = F.array_sort(F.collect_list(F.struct("at", "sha256")))
        text = F.array_join(F.transform(child, lambda x: F.concat_ws(":", x["at"].cast("string"), x["sha256"])), ";")
        nodes = nodes.groupBy("file", F.floor(F.col("at") / FAN).alias("at")).agg(F.sha2(text, 256).alias("sha256"))
        width = -(-width // FAN)
        if width <= 1:
            break
    counts = blocks.groupBy("file").agg(F.count(F.lit(1)).alias("n_blocks"))
    files = _file_list(spark, path).groupBy("file").agg(F.sum("length").alias("length"))
    j = files.join(counts, "file").join(nodes.select("file", "sha256"), "file")
    return j.select("file", "length", "n_blocks", F.sha2(F.concat_ws(":", F.col("length").cast("string"), "sha256"), 256).alias("root"))


def changed_blocks(old: DataFrame, new: DataFrame) -> DataFrame:
    """file, block and change (added, removed, changed) between two results of
    ``block_hashes`` with equal block size.  A change that shifts lines shows
    in every block behind it."""
    o = old.select("file", "block", F.col("sha256").alias("_old"), F.col("n_bytes").alias("_old_bytes"))
    j = o.join(new, ["file", "block"], "full_outer").where(~F.col("_old").eqNullSafe(F.col("sha256")))
    kind = F.when(F.col("_old").isNull(), "added").when(F.col("sha256").isNull(), "removed").otherwise("changed")
    return j.select("file", "block", kind.alias("change"))
