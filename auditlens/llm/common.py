"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from auditlens.session import scratch_path

#: Rows that a Python worker handles and hands back at a time.
SLICE_ROWS = 512


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def written(df: DataFrame, name: str = "llm") -> DataFrame:
    """Write an intermediate once below the shared checkpoint folder and read
    it back: its lineage is cut and lost executors cost no recomputation."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def discard(*written_ones: DataFrame | None) -> None:
    """Delete tables made by ``written`` that only other written tables were
    made from; nothing that is still lazy may refer to them."""
    for df in written_ones:
        if df is not None:
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._written_at)
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A folder name that no other call uses."""
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in lots of ``SLICE_ROWS``: what is made of a lot
    is small beside the batch, in the worker and in the JVM that reads it."""
    for whole in batches:
        for start in range(0, whole.num_rows, SLICE_ROWS):
            yield whole.slice(start, SLICE_ROWS)


def text_or_empty(col: str | Column = "text") -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def row_keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a unique long ``_row``: the doc_id itself where ids are
    unique, else numbers given to the rows of a written copy."""
    odd = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or doc_id is null").limit(1).count()
    if not odd:
        return docs.withColumn("_row", F.col("doc_id").cast("long"))
    return written(docs.withColumn("_row", F.monotonically_increasing_id()), "row-keyed")


def numbered(df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """``df`` with gapless places from 0 in the order given, as a written table.

    Rows are range partitioned and sorted; a row's place is its place within
    its partition plus the sizes of the partitions before (one row each, so
    the broadcast table is as long as the number of partitions set).  The order
    should tell rows apart, or ties take any order and one range.  ``df`` is
    read twice and should be a written table."""
    n = partitions(df.sparkSession)
    placed = written(df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()), "numbered")
    part = F.shiftrightunsigned("_id", 33).alias("_part")
    sizes = placed.groupBy(part).agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    rows = placed.withColumn("_part", F.shiftrightunsigned("_id", 33))
    return rows.join(F.broadcast(before), "_part").withColumn(out, F.col("_before") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))).drop("_part", "_before", "_id")
