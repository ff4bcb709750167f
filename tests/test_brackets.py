"""Sketch brackets against numpy, with several rounds of narrowing."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from auditlens.functions.brackets import order_statistics, quantiles


@pytest.mark.parametrize("within,k", [(100_000, 4096), (150, 4096), (60, 512)])
def test_quantiles_match_numpy(spark, within, k):
    rng = np.random.default_rng(3)
    data = {"a": np.round(rng.normal(size=9000), 2), "b": rng.exponential(size=4000), "hot": np.r_[np.full(5000, 7.0), rng.normal(size=50)], "one": np.array([2.5]), "two": np.array([1.0, 4.0])}
    rows = [(g, float(v)) for g, vs in data.items() for v in vs] + [("a", None), ("b", float("nan")), ("none", None)]
    df = spark.createDataFrame(rows, "g STRING, v DOUBLE").repartition(5)
    probs = [0.0, 0.001, 0.25, 0.5, 0.75, 0.9, 0.999, 1.0]
    got = {(r.g, r.p): (r.q, r.below, r.n) for r in quantiles(df, "v", probs, ["g"], k=k, within=within).collect()}
    assert len(got) == len(probs) * len(data)
    for (g, p), (q, below, n) in got.items():
        assert q == pytest.approx(np.quantile(data[g], p), rel=1e-12, abs=1e-12) and n == len(data[g])
        assert below == int((data[g] < q).sum())


def test_without_groups_and_empty(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("v"))
    assert {(r.p, r.q) for r in quantiles(df, "v", [0.5, 1.0], within=100).collect()} == {(0.5, 499.5), (1.0, 999.0)}
    assert quantiles(df.where("false"), "v", [0.5]).collect() == []
    assert quantiles(df.where("false").withColumn("g", F.lit("x")), "v", [0.5], ["g"]).collect() == []


def test_places_outside_the_group(spark):
    df = spark.range(10).select(F.col("id").cast("double").alias("v"))
    got = {r.name: (r.q, r.below) for r in order_statistics(df, "v", [("in", 0.3, F.lit(3)), ("past", 1.0, F.col("n"))]).collect()}
    assert got == {"in": (3.0, 3), "past": (None, None)}
