"""Hand cases for fairness, calibration, PSI, triggers, breach islands, survival."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from auditlens.operators import calibration as CA
from auditlens.operators import fairness as FA
from auditlens.operators import monitoring as MO
from auditlens.operators import survival as SU


def fair_df(spark, rows):
    return spark.createDataFrame(rows, "g STRING, y INT, y_prob DOUBLE")


def test_air_reference_is_one_and_ratio(spark):
    rows = [("W", 1, 0.9)] * 8 + [("W", 0, 0.1)] * 2 + [("B", 1, 0.9)] * 4 + [("B", 0, 0.1)] * 6
    t = {r["group"]: r for r in FA.fairness_table(fair_df(spark, rows), {"Race": "g"}, {"Race": "W"}).collect()}
    assert t["W"]["air"] == 1.0 and t["W"]["is_reference"]
    assert t["B"]["air"] == 0.5 and t["B"]["approval_rate"] == 0.4


def test_air_null_when_reference_absent_or_zero(spark):
    rows = [("A", 1, 0.9), ("B", 0, 0.1)]
    t = FA.fairness_table(fair_df(spark, rows), {"Race": "g"}, {"Race": "W"}).collect()
    assert all(r["air"] is None for r in t)
    rows = [("W", 0, 0.1), ("B", 1, 0.9)]
    t = {r["group"]: r["air"] for r in FA.fairness_table(fair_df(spark, rows), {"Race": "g"}, {"Race": "W"}).collect()}
    assert t["B"] is None and t["W"] == 1.0


def test_golden_air_arithmetic(spark):
    # published rates 0.5022 / 0.6281 give AIR 0.7996 (no rounding before dividing)
    r = spark.range(1).select(F.round(F.lit(0.5022) / F.lit(0.6281), 4)).first()[0]
    assert r == 0.7996


def test_ece_null_below_20_and_bins(spark):
    rows19 = [("A", i % 2, 0.3) for i in range(19)]
    rows20 = [("A", i % 2, 0.3) for i in range(20)]
    assert CA.ece(fair_df(spark, rows19)).first()["ece"] is None
    assert CA.ece(fair_df(spark, rows20)).first()["ece"] == pytest.approx(0.2)


def test_bin_edges(spark):
    ps = [0.0, 0.1, 0.3, 0.30000000000000004, 0.6, 0.7, 1.0]
    df = spark.createDataFrame([(1, p) for p in ps], "y INT, y_prob DOUBLE")
    got = [r["bin"] for r in CA.calibration_curve(df).orderBy("bin").collect()]
    edges = np.linspace(0, 1, 11)[1:-1]
    want = sorted(set(int(np.searchsorted(edges, p)) for p in ps))
    assert got == want


def test_psi_identical_is_zero_and_constant_is_null(spark):
    rng = np.random.default_rng(0)
    vals = rng.normal(size=400)
    a = spark.createDataFrame([("x", float(v)) for v in vals] + [("c", 1.0)] * 50, "feature STRING, value DOUBLE")
    r = {x["feature"]: x["psi"] for x in CA.psi_long(a, a).collect()}
    assert r["x"] == 0.0 and r["c"] is None


def test_psi_matches_numpy(spark):
    rng = np.random.default_rng(1)
    e, a = rng.normal(size=500), rng.normal(0.3, 1.2, size=400)
    bp = np.unique(np.percentile(e, np.linspace(0, 100, 11)))
    ec = np.histogram(e, bins=bp)[0] / len(e)
    ac = np.histogram(a, bins=bp)[0] / len(a)
    ec, ac = np.where(ec == 0, 1e-4, ec), np.where(ac == 0, 1e-4, ac)
    want = round(float(np.sum((ac - ec) * np.log(ac / ec))), 4)
    E = spark.createDataFrame([("f", float(v)) for v in e], "feature STRING, value DOUBLE")
    A = spark.createDataFrame([("f", float(v)) for v in a], "feature STRING, value DOUBLE")
    assert CA.psi_long(E, A).first()["psi"] == want


def test_psi_table_missing_feature(spark):
    df = spark.createDataFrame([(float(i),) for i in range(50)], "x DOUBLE")
    r = {x["feature"]: x for x in CA.psi_table(df, df, ["x", "nope"]).collect()}
    assert r["nope"]["interpretation"] == "Feature missing" and r["x"]["interpretation"] == "Stable"


def test_trigger_band_limits(spark):
    vals = [("AUC (overall)", 0.72), ("AIR — Black applicants", 0.70), ("PSI — loan_amount", 0.25),
            ("PSI — income", 0.10), ("Approval rate change vs. baseline (absolute)", -0.05)]
    v = spark.createDataFrame(vals, "metric STRING, value DOUBLE")
    got = {r["metric"]: r["status"] for r in MO.evaluate_triggers(v, MO.rules_table(spark)).collect()}
    assert got["AUC (overall)"] == MO.STATUS_GREEN
    assert got["AIR — Black applicants"] == MO.STATUS_YELLOW
    assert got["PSI — loan_amount"] == MO.STATUS_YELLOW
    assert got["PSI — income"] == MO.STATUS_YELLOW
    assert got["Approval rate change vs. baseline (absolute)"] == MO.STATUS_YELLOW
    assert got["AIR — Female applicants"] == "Unknown"


def test_breach_islands(spark):
    m = lambda y, mo: dt.datetime(y, mo, 1)
    rows = [("BB", m(2020, 1), 0.7), ("BB", m(2020, 2), 0.7),
            ("BoB", m(2020, 1), 0.7), ("BoB", m(2020, 2), 0.9), ("BoB", m(2020, 3), 0.7),
            ("BgB", m(2020, 1), 0.7), ("BgB", m(2020, 3), 0.7)]
    df = spark.createDataFrame(rows, "g STRING, month TIMESTAMP, air DOUBLE")
    got = {r["g"]: r["months"] for r in MO.consecutive_breach(df, ["g"]).collect()}
    assert got == {"BB": 2}


def test_km_simple(spark):
    # times 1,2,2,3 (events 1,1,0,1): S(1)=3/4, S(2)=3/4*2/3=0.5, S(3)=0
    df = spark.createDataFrame([("a", 1.0, 1.0), ("a", 2.0, 1.0), ("a", 2.0, 0.0), ("a", 3.0, 1.0)],
                               "score_factor STRING, end DOUBLE, event DOUBLE")
    c = {r["time"]: r for r in SU.km_curve(df).collect()}
    assert c[1.0]["survival"] == pytest.approx(0.75) and c[2.0]["survival"] == pytest.approx(0.5)
    assert c[3.0]["survival"] == 0.0 and c[2.0]["n_at_risk"] == 3
    t = SU.km_at_time(df, 2.0).first()
    assert t["survival"] == 0.5 and t["n_risk"] == 3 and t["n_event"] == 2 and t["n_censored"] == 1


def test_clean_numeric_and_datetime(spark):
    from auditlens.operators.features import clean_datetime, clean_numeric, encode_dti
    df = spark.createDataFrame([("1e3", "2024-01-02 03:04:05", "36"), (" 7 ", "junk", "36.0"), ("1.0d", None, "<20%"),
                                ("abc", "2024-02-30", "Exempt"), ("", "", "NA"), ("NaN", "", "wat")],
                               "x STRING, t STRING, debt_to_income_ratio STRING")
    out = encode_dti(clean_datetime(clean_numeric(df, ["x", "missing"]), ["t"])).collect()
    assert [r["x"] for r in out] == [1000.0, 7.0, None, None, None, None]
    assert out[0]["t"] is not None and all(r["t"] is None for r in out[1:])
    assert [r["debt_to_income_ratio"] for r in out] == [36.0, 36.0, 10.0, None, None, None]


def test_results_unchanged_under_repartition(spark):
    from auditlens.operators.scorehist import ranking_metrics, score_hist
    rng = np.random.default_rng(9)
    rows = [(str(g), int(y), float(p)) for g, y, p in zip(rng.integers(0, 4, 400), rng.integers(0, 2, 400),
                                                           np.round(rng.random(400), 2))]
    df = fair_df(spark, rows)
    a = sorted(map(tuple, FA.fairness_table(df, {"A": "g"}, {"A": "0"}).collect()))
    b = sorted(map(tuple, FA.fairness_table(df.repartition(7), {"A": "g"}, {"A": "0"}).collect()))
    assert a == b
    ra = ranking_metrics(score_hist(df, ["g"]), ["g"]).orderBy("g").collect()
    rb = ranking_metrics(score_hist(df.repartition(5), ["g"]), ["g"]).orderBy("g").collect()
    assert [r["auc"] for r in ra] == pytest.approx([r["auc"] for r in rb])
