"""Hand cases for ranking metrics, thresholds, ordered helpers and golden arithmetic."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from auditlens.functions.ordered import exact_quantiles, running_totals
from auditlens.operators.metrics import classification_cols, evaluate, f1_grid, select_threshold
from auditlens.operators.scorehist import ranking_metrics, score_hist


def scored(spark, ys, ps):
    return spark.createDataFrame([(int(y), float(p)) for y, p in zip(ys, ps)], "y INT, y_prob DOUBLE")


def brute_auc(ys, ps):
    pos = [p for y, p in zip(ys, ps) if y == 1]
    neg = [p for y, p in zip(ys, ps) if y == 0]
    s = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg)
    return s / (len(pos) * len(neg))


def test_auc_ties_match_brute_force(spark):
    rng = np.random.default_rng(1)
    ys = rng.integers(0, 2, 300)
    ps = rng.integers(0, 7, 300) / 7.0
    r = ranking_metrics(score_hist(scored(spark, ys, ps))).first()
    assert r["auc"] == pytest.approx(brute_auc(ys, ps))


def test_auc_invariant_under_monotone_map(spark):
    rng = np.random.default_rng(2)
    ys = rng.integers(0, 2, 200)
    ps = rng.random(200)
    a = ranking_metrics(score_hist(scored(spark, ys, ps))).first()["auc"]
    b = ranking_metrics(score_hist(scored(spark, ys, ps ** 3))).first()["auc"]
    assert a == pytest.approx(b)


def test_one_class_gives_null(spark):
    r = ranking_metrics(score_hist(scored(spark, [1, 1, 1], [0.2, 0.5, 0.9]))).first()
    assert r["auc"] is None and r["ks"] is None


def test_all_scores_equal(spark):
    r = ranking_metrics(score_hist(scored(spark, [0, 1, 0, 1], [0.5] * 4))).first()
    assert r["auc"] == 0.5 and r["ks"] == 0.0 and r["pr_auc"] == 0.5


def test_average_precision_step(spark):
    # sklearn example: y=[0,0,1,1], p=[0.1,0.4,0.35,0.8] -> AP 0.8333
    r = ranking_metrics(score_hist(scored(spark, [0, 0, 1, 1], [0.1, 0.4, 0.35, 0.8]))).first()
    assert r["pr_auc"] == pytest.approx(0.8333333, abs=1e-6)


def test_ks(spark):
    r = ranking_metrics(score_hist(scored(spark, [0, 0, 1, 1], [0.1, 0.2, 0.3, 0.4]))).first()
    assert r["ks"] == 1.0


def test_confusion_sums_to_n(spark):
    rng = np.random.default_rng(3)
    ys, ps = rng.integers(0, 2, 100), rng.random(100)
    r = evaluate(scored(spark, ys, ps), 0.5).first()
    assert r["tp"] + r["fp"] + r["fn"] + r["tn"] == 100


def test_golden_published_counts(spark):
    # published confusion counts must give the published rates
    df = spark.createDataFrame([(862418, 182569, 39224, 105869)], "tp LONG, fp LONG, fn LONG, tn LONG")
    df = df.withColumn("n", F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn"))
    c = classification_cols()
    r = df.select(*[F.round(e, 4).alias(k) for k, e in c.items()]).first()
    assert (r["precision"], r["recall"], r["f1"], r["accuracy"]) == (0.8253, 0.9565, 0.8861, 0.8136)


def test_f1_grid_matches_numpy():
    assert f1_grid() == list(np.linspace(0.01, 0.99, 100))


def test_select_threshold_f1_brute(spark):
    rng = np.random.default_rng(4)
    ys, ps = rng.integers(0, 2, 300), rng.random(300)
    best_t, best = 0.5, -1
    for t in np.linspace(0.01, 0.99, 100):
        pred = ps >= t
        tp = int(((ys == 1) & pred).sum()); fp = int(((ys == 0) & pred).sum()); fn = int(((ys == 1) & ~pred).sum())
        f1 = 2 * tp / (2 * tp + fp + fn) if tp + fp + fn else 0
        if f1 > best:
            best, best_t = f1, t
    got = select_threshold(scored(spark, ys, ps), "f1").first()["threshold"]
    assert got == round(float(best_t), 4)


def test_select_threshold_rate(spark):
    rng = np.random.default_rng(5)
    ys, ps = rng.integers(0, 2, 101), rng.random(101)
    want = round(float(np.percentile(ps, (1 - ys.mean()) * 100)), 4)
    assert select_threshold(scored(spark, ys, ps), "approval_rate").first()["threshold"] == want


def test_unknown_strategy(spark):
    with pytest.raises(ValueError):
        select_threshold(scored(spark, [0, 1], [0.1, 0.9]), "nope")


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(6)
    vals = np.round(rng.normal(size=500), 2)
    grp = rng.integers(0, 3, 500)
    df = spark.createDataFrame([(int(g), float(v)) for g, v in zip(grp, vals)], "g INT, v DOUBLE")
    probs = [0.0, 0.1, 0.25, 0.5, 0.999, 1.0]
    got = {(r["g"], r["p"]): r["q"] for r in exact_quantiles(df, "v", probs, ["g"], n_buckets=5).collect()}
    for g in range(3):
        for p in probs:
            assert got[(g, p)] == pytest.approx(np.percentile(vals[grp == g], p * 100))


def test_running_totals_unchanged_by_buckets(spark):
    df = spark.createDataFrame([(i % 3, float(i % 17), 1) for i in range(200)], "g INT, v DOUBLE, c INT")
    agg = df.groupBy("g", "v").agg(F.sum("c").alias("c"))
    a = {(r["g"], r["v"]): r["cum_c"] for r in running_totals(agg, "v", ["c"], ["g"], n_buckets=1).collect()}
    b = {(r["g"], r["v"]): r["cum_c"] for r in running_totals(agg, "v", ["c"], ["g"], n_buckets=7).collect()}
    assert a == b
