"""Changed ranges, categorical PSI and the cyclic donor of the permutation."""

import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from auditlens.operators import calibration as CA
from auditlens.operators import explain as EX
from auditlens.operators import monitoring as MO
from auditlens.sources import raw as R


def test_changed_ranges_are_named(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("t"), (F.col("id") / 7).alias("x")).unionByName(
        spark.createDataFrame([(None, "null key", 1.0)], "k LONG, t STRING, x DOUBLE"))
    new = df.where("k is null or k <> 512").withColumn("t", F.when(F.col("k") == 250, None).otherwise(F.col("t"))).unionByName(spark.createDataFrame([(1400, "n", None)], df.schema))
    ranges = {name: R.range_fingerprints(d.repartition(3), "k", 100) for name, d in (("old", df), ("same", df), ("new", new))}
    assert R.changed_ranges(ranges["old"], ranges["same"]).count() == 0
    assert {tuple(r) for r in R.changed_ranges(ranges["old"], ranges["new"]).collect()} == {(200, 100, 100), (500, 100, 99), (1400, 0, 1)}
    nulled = df.withColumn("x", F.when(F.col("k").isNotNull(), F.col("x")))
    assert [tuple(r) for r in R.changed_ranges(ranges["old"], R.range_fingerprints(nulled, "k", 100)).collect()] == [(None, 1, 1)]


def test_psi_of_levels(spark):
    e, a = ["x"] * 50 + ["y"] * 30 + [None] * 20, ["x"] * 20 + ["y"] * 30 + ["z"] * 50
    got = CA.psi_levels(*(spark.createDataFrame([(v, "same") for v in vs], "c STRING, d STRING") for vs in (e, a)), ["c", "d"])
    p, q = (Counter(v or "Missing" for v in vs) for vs in (e, a))
    want = sum(((q[k] / 100 or 1e-4) - (p[k] / 100 or 1e-4)) * math.log((q[k] / 100 or 1e-4) / (p[k] / 100 or 1e-4)) for k in {*p, *q})
    assert {r.feature: r.psi for r in got.collect()} == {"c": round(want, 4), "d": 0.0}


def test_gate(spark):
    old = spark.createDataFrame([(i, "ab"[i % 2], i % 3 % 2, float(i % 10)) for i in range(600)], "k INT, g STRING, y INT, n DOUBLE")
    check = lambda new, cur: {r.check: (r.value, r.passed, r.detail) for r in MO.pretrain_gate(old, new, old, cur, "k", 50, ["n"], ["g"], {"G": "g"}, {"G": "a"}).collect()}
    assert all(p for _, p, _ in check(old, old).values())
    bad = check(old.withColumn("y", F.when(F.col("k").between(120, 180), 1 - F.col("y")).otherwise(F.col("y"))), old.withColumn("n", F.col("n") * 3).withColumn("g", F.lit("a")))
    assert bad["snapshot_ranges_changed"] == (2.0, False, "100 to 199") and not bad["proxy_psi_n"][1] and not bad["proxy_psi_g"][1]


@pytest.mark.parametrize("n,buckets", [(500, 16), (3, 16), (1, 4)])
def test_next_in_hash_order(spark, n, buckets):
    df = spark.range(n).select("id", F.when(F.col("id") % 5 > 0, F.col("id") * 10).alias("v"))
    got = {r.id: r["_next"].v for r in EX.next_in_hash_order(df, ["v"], ["id"], 7, buckets).collect()}
    order = sorted(range(n), key=lambda i: (int(hashlib.md5(f"7|{i}".encode()).hexdigest()[:13], 16), i))
    assert got == {i: (j * 10 if j % 5 else None) for i, j in zip(order, order[1:] + order[:1], strict=True)}
