"""Leakage removal and proxy dictionary (ports of the reference's cases)."""

from auditlens.operators.leakage import (IDENTIFIER_FEATURES, POST_DECISION_FEATURES, PROXY_RISK, leakage_report,
                                         proxy_annotate, proxy_risk_table, remove_leakage)


def frame(spark, cols):
    return spark.createDataFrame([tuple(range(len(cols)))] * 3, ", ".join(f"`{c}` INT" for c in cols))


def test_removes_post_decision(spark):
    df = frame(spark, ["income", "loan_amount", "rate_spread", "interest_rate", "denial_reason_1"])
    out = remove_leakage(df).columns
    assert out == ["income", "loan_amount"]


def test_all_denylisted_removed(spark):
    df = frame(spark, POST_DECISION_FEATURES + IDENTIFIER_FEATURES + ["keep"])
    assert remove_leakage(df).columns == ["keep"]


def test_absent_columns_ok_and_rows_kept(spark):
    df = frame(spark, ["a", "b"])
    out = remove_leakage(df)
    assert out.columns == ["a", "b"] and out.count() == 3


def test_extra_columns(spark):
    assert remove_leakage(frame(spark, ["a", "b"]), extra=["b"]).columns == ["a"]


def test_report(spark):
    r = {x["feature"]: x["removed"] for x in leakage_report(frame(spark, ["rate_spread", "x"])).collect()}
    assert r["rate_spread"] and not r["interest_rate"]


def test_proxy_table(spark):
    t = proxy_risk_table(spark).collect()
    assert len(t) == len(PROXY_RISK) == 9
    assert {r["risk_level"] for r in t} <= {"High", "Medium", "Low"}
    assert {r["feature"]: r["risk_level"] for r in t}["census_tract"] == "High"


def test_proxy_annotation_prefix_and_default(spark):
    f = spark.createDataFrame([("county_code_12",), ("income",), ("loan_type_2",), ("state_code",)], "feature STRING")
    got = {r["feature"]: r["proxy_risk_level"] for r in proxy_annotate(f, proxy_risk_table(spark)).collect()}
    assert got == {"county_code_12": "Medium", "income": "Medium", "loan_type_2": "Low", "state_code": "Medium"}
