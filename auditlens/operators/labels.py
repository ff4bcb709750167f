"""Family B: label rule, construction log, label distribution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlens.functions.columns import column_to_double, ratio, rnd, to_double

# The label rule (action code -> y) and the meaning of each code.
LABEL_MAP = {1: 1, 2: 1, 3: 0}
ACTION_TAKEN_MEANINGS = {
    1: "Loan originated → y=1",
    2: "Application approved, not accepted → y=1",
    3: "Application denied → y=0",
    4: "Application withdrawn by applicant → DROPPED",
    5: "File closed for incompleteness → DROPPED",
    6: "Purchased loan → DROPPED",
    7: "Preapproval request denied → DROPPED",
    8: "Preapproval request approved but not accepted → DROPPED",
}


def _label(code):
    expr = None
    for k, v in LABEL_MAP.items():
        cond = code == F.lit(float(k))
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    return expr.cast("int")


def apply_label(df: DataFrame, col: str = "action_taken") -> DataFrame:
    """Coerce the action code to a number, map it to ``y`` and drop unmapped
    rows (a filter Catalyst pushes into the Parquet scan)."""
    if col not in df.columns:
        raise ValueError(f"no column {col} to take the label from")
    out = df.withColumn(col, column_to_double(df, col)).withColumn("y", _label(F.col(col)))
    return out.where(F.col("y").isNotNull())


def label_log(df: DataFrame, col: str = "action_taken") -> DataFrame:
    """One row: raw, mappable, dropped, final, positive, negative and shares."""
    if col not in df.columns:
        raise ValueError(f"no column {col} to take the label from")
    y = _label(to_double(col))
    a = df.agg(F.count(F.lit(1)).alias("raw"), F.count(y).alias("mappable"),
               F.sum(F.when(y == 1, 1).otherwise(0)).alias("positive"))
    return a.select(
        F.col("raw").cast("long").alias("raw_rows"), F.col("mappable").cast("long").alias("mappable_rows"),
        (F.col("raw") - F.col("mappable")).cast("long").alias("dropped_rows"),
        F.col("mappable").cast("long").alias("final_rows"),
        F.col("positive").cast("long").alias("positive"),
        (F.col("mappable") - F.col("positive")).cast("long").alias("negative"),
        rnd(ratio("mappable", "raw"), 4).alias("mappable_share"),
        rnd(ratio("positive", "mappable"), 4).alias("positive_share"),
        rnd(ratio(F.col("mappable") - F.col("positive"), "mappable"), 4).alias("negative_share"))


def label_distribution(df: DataFrame, col: str = "action_taken") -> DataFrame:
    """Counts per code with meaning, assigned label, retained flag, share."""
    spark = df.sparkSession
    code = to_double(col)
    counts = df.where(code.isNotNull()).groupBy(code.alias("code")).agg(F.count(F.lit(1)).alias("count"))
    meta = F.broadcast(spark.createDataFrame(
        [(float(k), v, LABEL_MAP.get(k)) for k, v in ACTION_TAKEN_MEANINGS.items()],
        "code DOUBLE, meaning STRING, label_assigned INT"))
    total = counts.agg(F.sum("count").alias("_total"))
    j = counts.join(meta, "code", "left").crossJoin(F.broadcast(total))
    return j.select(F.col("code").alias(col), F.col("count").cast("long").alias("count"),
                    F.coalesce("meaning", F.lit("Unknown")).alias("meaning"), "label_assigned",
                    F.col("code").isin(*[float(k) for k in LABEL_MAP]).alias("retained"),
                    rnd(ratio("count", "_total"), 4).alias("pct_of_total"))
