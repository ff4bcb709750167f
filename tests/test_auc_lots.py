"""AUC of several scores by lots, perturbation and permutation against all pairs."""

import math
import random

import numpy as np
import pytest

from auditlens.operators import explain as EX
from auditlens.operators.scorehist import auc_of_scores


def plain_auc(pairs):
    pos, neg = ([s for s, y in pairs if y == v] for v in (1, 0))
    if not pos or not neg:
        return None
    key = lambda s: math.inf if math.isnan(s) else s
    return sum((key(p) > key(n)) + (key(p) == key(n)) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("buckets", [1, 4, 64])
def test_auc_of_scores_against_all_pairs(spark, buckets):
    rng = random.Random(5)
    rows = [(rng.choice([0, 1, 1, None]), rng.random(), rng.choice([0.5] * 6 + [0.25, 0.75, rng.random(), None]), rng.choice([1.0, 2.0, float("nan")]), 0.5, None) for _ in range(400)]
    df = spark.createDataFrame(rows, "y INT, a DOUBLE, b DOUBLE, c DOUBLE, d DOUBLE, e DOUBLE")
    got = {r.score: r.auc for r in auc_of_scores(df.repartition(5), list("abcde"), "y", buckets).collect()}
    want = {n: plain_auc([(r[i], r[0]) for r in rows if r[i] is not None and r[0] is not None]) for i, n in enumerate("abcd", 1)}
    assert got == pytest.approx(want)  # e has no score, so no row


def test_auc_of_one_class_and_no_rows(spark):
    df = spark.createDataFrame([(1, 0.1), (1, 0.2)], "y INT, a DOUBLE")
    assert [r.auc for r in auc_of_scores(df, ["a"]).collect()] == [None]
    assert auc_of_scores(df.where("y = 0"), ["a"]).count() == 0


def loans(spark, n=300):
    rng = np.random.default_rng(3)
    return spark.createDataFrame([(i, float(rng.random()), float(rng.random()), int(rng.random() < 0.4), "AB"[i % 2]) for i in range(n)], "k INT, u DOUBLE, v DOUBLE, y INT, g STRING")


MODEL = EX.LinearScore(0.1, {"u": 1.0, "v": -0.5})


def test_f6_rows_are_not_multiplied_into_a_histogram(spark, monkeypatch):
    written = []
    real = EX.materialize
    monkeypatch.setattr(EX, "materialize", lambda d: written.append(real(d)) or written[-1])
    out = EX.perturbation(loans(spark), MODEL, ["u", "v"], ["k"], (0.1, 0.2), "g", "A", 0.4).collect()
    assert len(out) == 8 and {r.group for r in out} == {"A", "B"}
    # scores are written once, one row a row, without the texts of keys and digests
    assert written[0].count() == 300 and {t for _, t in written[0].dtypes} == {"int", "string", "double"}
    rows = loans(spark).withColumn("p", MODEL.score()).collect()
    assert {r.baseline_auc for r in out} == {round(plain_auc([(r.p, r.y) for r in rows]), 4)}


def test_f13_first_rows_of_buckets_need_no_sort(spark):
    df = loans(spark)
    out = {r.feature: r for r in EX.permutation_importance(df, MODEL, ["k"]).collect()}
    nxt = {r.k: r for r in EX.next_in_hash_order(df, ["u", "v"], ["k"], 7, 16).collect()}
    s = lambda u, v: (m := 0.1 + u - 0.5 * v) / (1 + m)
    want = {"u": plain_auc([(s(r["_next"].u, r.v), r.y) for r in nxt.values()]), "v": plain_auc([(s(r.u, r["_next"].v), r.y) for r in nxt.values()])}
    assert {f: r.permuted_auc for f, r in out.items()} == {f: round(a, 4) for f, a in want.items()}
    placed = EX.next_in_hash_order(df, ["u"], ["k"], 7, 16)._jdf.queryExecution().optimizedPlan().toString()
    assert "min(_u" in placed
