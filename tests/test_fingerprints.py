"""Hashes of ranges and whole rows: what they tell apart, and no text made twice."""

from pyspark.sql import functions as F

from auditlens.sources import raw as R


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_f7_range_hashes_make_no_texts(spark):
    df = spark.createDataFrame([(1, 0.1234564, "a", None), (2, None, "b", "c"), (3, float("nan"), None, "c")], "k INT, x DOUBLE, s STRING, t STRING")
    assert "md5" not in plan(R.range_fingerprints(df, "k", 10))
    mark = lambda d: R.range_fingerprints(d, "k", 10).first().content_hash
    base = mark(df)
    assert base == mark(df.withColumn("x", F.col("x") + 1e-9))  # six decimals count, as in the texts
    for other in (df.withColumn("x", F.col("x") + 1e-5), df.withColumn("s", F.coalesce("s", F.lit(""))), df.withColumns({"s": F.col("t"), "t": F.col("s")}), df.withColumn("t", F.lit("c"))):
        assert mark(other) != base


def test_content_hash_makes_each_text_once(spark):
    df = spark.createDataFrame([(1, 0.5, "a")], "k INT, x DOUBLE, s STRING")
    assert plan(R.content_fingerprint(df)).count("decimal(30,6)") == 1
