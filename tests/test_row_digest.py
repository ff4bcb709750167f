"""Digests of rows in the label comparison and numbers read without text."""

from pyspark.sql import functions as F

from auditlens.functions.columns import to_double
from auditlens.operators import labels as LB
from auditlens.operators import monitoring as MO
from auditlens.operators.features import clean_numeric


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_f8_row_digest(spark):
    old = spark.createDataFrame([(1, 1, "ab", "c", 0.5), (2, 0, None, "x", None), (3, 1, "q", None, 2.0), (4, 1, "same", None, 1.0)], "k INT, y INT, s STRING, t STRING, x DOUBLE")
    new = spark.createDataFrame([(1, 1, "a", "bc", 0.5), (2, 0, "x", None, None), (3, 1, "q", "", 2.0), (4, 1, "same", None, 1.0)], old.schema)
    got = {r.change: r.n for r in MO.label_diff(old, new, ["k"], row_cols=["s", "t", "x"]).collect()}
    assert got == {"row_changed": 3, "unchanged": 1}
    assert "sha2" not in plan(MO.label_diff(old, new, ["k"], row_cols=["s", "t", "x"]))


def test_f8_f11_numbers_are_not_read_over_text(spark):
    df = spark.createDataFrame([(1, 0.1, " 1.5 "), (3, float("nan"), "x"), (None, float("inf"), "1e3"), (8, 1e22, None)], "action_taken INT, x DOUBLE, s STRING")
    assert "RLIKE" not in plan(LB.apply_label(df)) and [(r.action_taken, r.y) for r in LB.apply_label(df).collect()] == [(1.0, 1), (3.0, 0)]
    assert "RLIKE" not in plan(clean_numeric(df, ["x"]))
    assert clean_numeric(df, ["x", "s"]).select("x", "s").collect() == df.select(to_double("x").alias("x"), to_double("s").alias("s")).collect()
