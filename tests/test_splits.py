"""F2 by cut points against a plain ranking."""

import hashlib
import math
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from auditlens.functions import brackets
from auditlens.operators import splits as SP


def plain(rows, test=0.15, val=0.15):
    strata = defaultdict(list)
    for y, a, b in rows:
        u = int(hashlib.md5(f"42|{a}|{b}".encode()).hexdigest()[:13], 16) / 2**52
        strata[y].append((u, a, b))
    out = {}
    for y, members in strata.items():
        members.sort()
        qt = math.ceil(test * len(members))
        qv = math.ceil(val / (1 - test) * (len(members) - qt))
        for i, m in enumerate(members):
            out[(y, *m[1:])] = "test" if i < qt else "val" if i < qt + qv else "train"
    return out


def test_same_as_ranking_rows(spark):
    rows = [("abc"[i % 3] if i % 10 else None, i, i % 4) for i in range(1500)] + [("solo", 1, 1)]
    df = spark.createDataFrame(rows, "y STRING, a INT, b INT").repartition(5)
    got = {(r.y, r.a, r.b): r.split for r in SP.stratified_split(df, "y", ["a", "b"]).collect()}
    assert got == plain(rows)


def test_no_shuffle_of_rows(spark):
    df = spark.range(5000).select((F.col("id") % 2).alias("y"), "id", F.lit("wide text").alias("t"))
    plan = SP.stratified_split(df, "y", ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_hashes_shared_at_the_cut(spark, monkeypatch):
    """With a hash of few values the order of the keys decides."""
    monkeypatch.setattr(SP, "hash_unit", lambda keys, seed=42: (F.col(keys[0]) % 3) / F.lit(3.0))
    rows = [("s", i) for i in range(100)]
    df = spark.createDataFrame(rows, "y STRING, a INT")
    got = {r.a: r.split for r in SP.stratified_split(df, "y", ["a"]).collect()}
    order = sorted(range(100), key=lambda i: (i % 3, i))
    val = math.ceil(0.15 / 0.85 * 85)
    assert [got[i] for i in order] == ["test"] * 15 + ["val"] * val + ["train"] * (85 - val)


def test_large_strata_are_narrowed(spark, monkeypatch):
    monkeypatch.setattr(brackets, "WITHIN", 100)
    real = brackets.order_statistics
    monkeypatch.setattr(SP, "order_statistics", lambda *a: real(*a, within=100))
    df = spark.range(9000).select((F.col("id") % 2).alias("y"), "id")
    n = Counter((r.y, r.split) for r in SP.stratified_split(df, "y", ["id"]).collect())
    assert {k: v for k, v in n.items()} == {(y, s): c for y in (0, 1) for s, c in (("test", 675), ("val", 675), ("train", 3150))}


def test_empty(spark):
    df = spark.range(0).select((F.col("id") % 2).alias("y"), "id")
    assert SP.stratified_split(df, "y", ["id"]).collect() == []
