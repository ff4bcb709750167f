"""Family L: triggers, scorecard and period-over-period monitoring rules."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from auditlens.functions.columns import rnd, safe_div
from auditlens.functions.ordered import materialize
from auditlens.operators import calibration as CA
from auditlens.operators import fairness as FA
from auditlens.operators import monitoring as MO
from auditlens.operators.features import clean_numeric, encode_dti
from auditlens.operators.labels import apply_label, label_distribution
from auditlens.operators.scorehist import ranking_metrics, score_hist
from auditlens.operators.splits import KEY_COLS
from auditlens.plans.common import ATTRS, REFS, SQL_APPS, SQL_SCORED, applications, scored
from auditlens.plans.q_calibration import _long, psi_sql
from auditlens.plans.q_calibration import auc_sql
from auditlens.plans.q_features import VIEW, sql_dti, sql_num, sql_text
from auditlens.plans.registry import query
from auditlens.sources import views as V
from auditlens.plans.sqlgen import bin_sql, dbl, fairness_sql, values

CUT = dt.datetime(1999, 1, 1)
def cut_lit():
    return V.ntz("1999-01-01 00:00:00")
CUT_SQL = "TIMESTAMP '1999-01-01'"
AIR_METRICS = {
    "AIR — Black applicants": ("Race", "MIDDLE EAST"),
    "AIR — Hispanic or Latino applicants": ("Ethnicity", "O"),
    "AIR — Female applicants": ("Sex", "R"),
    "AIR — Applicant sex": ("Sex", "A"),
    "AIR — Applicant age": ("Applicant Age", "1-URGENT"),
}


def _num(df):
    return clean_numeric(encode_dti(df), ["income"])


def periods(spark, sf_dir, cols: list[str] | None = None):
    """Base and current period; with ``cols`` these columns are read once into
    a written table, for queries of several passes."""
    s = _num(scored(spark, sf_dir))
    if cols:
        s = materialize(s.select(*dict.fromkeys([*cols, "event_time", "loan_amount"])))
    base = s.where(F.col("event_time") < cut_lit())
    cur = s.where(F.col("event_time") >= cut_lit()).withColumn("loan_amount", F.col("loan_amount") * F.lit(1.2))
    return base, cur


SQL_NUMS = f"SELECT * REPLACE ({sql_num('income')} AS income, {sql_dti('debt_to_income_ratio')} AS debt_to_income_ratio) FROM ({SQL_SCORED}) s0"
SQL_BASE = f"SELECT * FROM ({SQL_NUMS}) b WHERE event_time < {CUT_SQL}"
SQL_CUR = f"SELECT * REPLACE (loan_amount * {dbl(1.2)} AS loan_amount) FROM ({SQL_NUMS}) c WHERE event_time >= {CUT_SQL}"


def current_metrics_df(spark, sf_dir):
    base, cur = periods(spark, sf_dir, ["y", "y_prob", "income", *ATTRS.values()])
    fair = FA.fairness_table(cur, ATTRS, REFS, 0.5)
    names = spark.createDataFrame([(m, a, g) for m, (a, g) in AIR_METRICS.items()], "metric STRING, attribute STRING, group STRING")
    rows = fair.join(F.broadcast(names), ["attribute", "group"]).select("metric", F.col("air").alias("value"))  # one pass, five rows
    auc = ranking_metrics(score_hist(cur)).select(F.lit("AUC (overall)").alias("metric"), rnd("auc").alias("value"))
    psi = CA.psi_long(CA.to_long(base, ["loan_amount", "income"]), CA.to_long(cur, ["loan_amount", "income"]))
    psi = psi.select(F.concat(F.lit("PSI — "), F.col("feature")).alias("metric"), F.col("psi").alias("value"))
    ece = CA.ece(cur.withColumn("group", F.col("derived_race")), keys=["group"])
    gap = ece.agg(rnd(F.max("ece") - F.min("ece")).alias("value")).select(
        F.lit("Subgroup ECE gap (max across race groups)").alias("metric"), "value")
    ch = approval_change_df(base, cur).select(F.lit("Approval rate change vs. baseline (absolute)").alias("metric"),
                                              F.col("change").alias("value"))
    return rows.unionByName(auc).unionByName(psi).unionByName(gap).unionByName(ch)


def approval_change_df(base, cur, t: float = 0.5):
    pred = (F.col("y_prob") >= F.lit(float(t))).cast("double")
    b = base.agg(F.avg(pred).alias("baseline_rate"))
    c = cur.agg(F.avg(pred).alias("current_rate"))
    return b.crossJoin(c).select(rnd("baseline_rate").alias("baseline_rate"), rnd("current_rate").alias("current_rate"),
                                 rnd(F.col("current_rate") - F.col("baseline_rate")).alias("change"))


def _current_metrics_sql() -> str:
    fair = fairness_sql(SQL_CUR, ATTRS, REFS, [0.5])
    air = " UNION ALL ".join(f"SELECT '{m}' AS metric, air AS value FROM f WHERE attribute = '{a}' AND \"group\" = '{g}'"
                             for m, (a, g) in AIR_METRICS.items())
    psi = psi_sql(_long(SQL_BASE, ["loan_amount", "income"]), _long(SQL_CUR, ["loan_amount", "income"]))
    ece = f"""SELECT CAST(derived_race AS VARCHAR) AS grp, {bin_sql('y_prob')} AS b, count(*) AS nb, sum(y) AS pb, sum(y_prob) AS sb
              FROM ({SQL_CUR}) c GROUP BY ALL"""
    return f"""
WITH f AS ({fair}),
e AS (SELECT grp, CASE WHEN sum(nb) >= 20 THEN round(avg(abs(CAST(pb AS DOUBLE) / nb - sb / nb)), 4) END AS ece FROM ({ece}) x GROUP BY grp),
p AS ({psi}),
ac AS (SELECT round(b.r, 4) AS baseline_rate, round(c.r, 4) AS current_rate, round(c.r - b.r, 4) AS change FROM
       (SELECT avg(CASE WHEN y_prob >= 0.5 THEN 1.0 ELSE 0.0 END) AS r FROM ({SQL_BASE}) x) b,
       (SELECT avg(CASE WHEN y_prob >= 0.5 THEN 1.0 ELSE 0.0 END) AS r FROM ({SQL_CUR}) y) c)
{air}
UNION ALL SELECT 'AUC (overall)', round(auc_raw, 4) FROM ({auc_sql(f'({SQL_CUR})', [])}) a
UNION ALL SELECT 'PSI — ' || feature, psi FROM p
UNION ALL SELECT 'Subgroup ECE gap (max across race groups)', round(max(ece) - min(ece), 4) FROM e
UNION ALL SELECT 'Approval rate change vs. baseline (absolute)', change FROM ac"""


@query("current_metrics", _current_metrics_sql())
def q_current_metrics(spark, sf_dir):
    return current_metrics_df(spark, sf_dir)


_RULES = values([(i, *r) for i, r in enumerate(MO.TRIGGER_RULES)],
                ["rule_order", "metric", "frequency", "green_threshold", "yellow_threshold", "red_threshold", "direction",
                 "use_abs", "red_limit", "yellow_limit", "owner", "action_yellow", "action_red"])


def _triggers_sql() -> str:
    x = "CASE WHEN r.use_abs THEN abs(v.value) ELSE v.value END"
    st = (f"CASE WHEN v.value IS NULL OR isnan(v.value) THEN 'Unknown' "
          f"WHEN (r.direction = 'high' AND {x} < r.red_limit) OR (r.direction <> 'high' AND {x} > r.red_limit) THEN '{MO.STATUS_RED}' "
          f"WHEN (r.direction = 'high' AND {x} < r.yellow_limit) OR (r.direction <> 'high' AND {x} >= r.yellow_limit) THEN '{MO.STATUS_YELLOW}' "
          f"ELSE '{MO.STATUS_GREEN}' END")
    return f"""
WITH v AS ({_current_metrics_sql()}), r AS {_RULES}, j AS (SELECT r.*, v.value, {st} AS status FROM r LEFT JOIN v ON r.metric = v.metric)
SELECT metric, frequency, value AS current_value, green_threshold, yellow_threshold, red_threshold, status, owner,
  CASE WHEN status = 'Unknown' THEN 'Compute metric' WHEN status = '{MO.STATUS_RED}' THEN action_red
       WHEN status = '{MO.STATUS_YELLOW}' THEN action_yellow ELSE 'Continue monitoring' END AS required_action FROM j"""


@query("evaluate_triggers", _triggers_sql())
def q_evaluate_triggers(spark, sf_dir):
    return MO.evaluate_triggers(current_metrics_df(spark, sf_dir), MO.rules_table(spark))


def _rule_rows_sql() -> str:
    """Current-period rows that a rule's metric is computed on."""
    air = " UNION ALL ".join(f"SELECT '{m}' AS metric, count(CASE WHEN {ATTRS[a]} = '{g}' THEN 1 END) AS n FROM c" for m, (a, g) in AIR_METRICS.items())
    return f"WITH c AS ({SQL_CUR}), n AS ({air}), t AS (SELECT count(*) AS n FROM c)"


@query("trigger_rules", f"""
{_rule_rows_sql()}
SELECT r.metric, r.frequency, r.green_threshold AS green, r.yellow_threshold AS yellow, r.red_threshold AS red, r.owner,
       r.action_yellow, r.action_red, CAST(coalesce(n.n, t.n) AS BIGINT) AS n_current
FROM {_RULES} r LEFT JOIN n ON r.metric = n.metric CROSS JOIN t""")
def q_trigger_rules(spark, sf_dir):
    """L1: the playbook with the number of current-period rows behind each
    metric (one aggregate; no metric is computed)."""
    cur = scored(spark, sf_dir).where(F.col("event_time") >= cut_lit())
    counts = cur.agg(F.count(F.lit(1)).alias("_all"), *[F.count(F.when(F.col(ATTRS[a]) == g, 1)).alias(f"_{i}")
                                                        for i, (a, g) in enumerate(AIR_METRICS.values())])
    of_metric = F.create_map(*[x for i, m in enumerate(AIR_METRICS) for x in (F.lit(m), F.col(f"_{i}"))])
    return F.broadcast(MO.rules_table(spark)).crossJoin(counts).select(
        "metric", "frequency", F.col("green_threshold").alias("green"), F.col("yellow_threshold").alias("yellow"),
        F.col("red_threshold").alias("red"), "owner", "action_yellow", "action_red",
        F.coalesce(of_metric[F.col("metric")], F.col("_all")).cast("long").alias("n_current"))


@query("approval_change", f"""
SELECT round(b.r, 4) AS baseline_rate, round(c.r, 4) AS current_rate, round(c.r - b.r, 4) AS change FROM
 (SELECT avg(CASE WHEN y_prob >= 0.5 THEN 1.0 ELSE 0.0 END) AS r FROM ({SQL_BASE}) x) b,
 (SELECT avg(CASE WHEN y_prob >= 0.5 THEN 1.0 ELSE 0.0 END) AS r FROM ({SQL_CUR}) y) c""")
def q_approval_change(spark, sf_dir):
    b, c = periods(spark, sf_dir)
    return approval_change_df(b, c)


def _scorecard_df(spark, sf_dir):
    base, cur = periods(spark, sf_dir)
    auc = ranking_metrics(score_hist(cur)).select(rnd("auc").alias("v"))
    fair = FA.fairness_table(cur, ATTRS, REFS, 0.5).where(~F.col("is_reference")).agg(F.min("air").alias("v"))
    feats = ["loan_amount", "income", "property_value", "combined_loan_to_value_ratio"]
    psi = CA.psi_long(CA.to_long(base, feats), CA.to_long(cur, feats)).agg(F.max("psi").alias("v"))
    rows = [("Performance (AUC)", auc, 0.72, 0.68, True), ("Fairness — AIR", fair, 0.80, 0.70, True),
            ("Robustness — PSI + drift", psi, 0.10, 0.25, False)]
    out = None
    for name, d, g, y, hb in rows:
        r = d.select(F.lit(name).alias("dimension"), F.col("v").alias("value"), MO.score_band(F.col("v"), g, y, hb).alias("score"))
        out = r if out is None else out.unionByName(r)
    return out


def _scorecard_sql() -> str:
    feats = ["loan_amount", "income", "property_value", "combined_loan_to_value_ratio"]
    return f"""
WITH a AS (SELECT round(auc_raw, 4) AS v FROM ({auc_sql(f'({SQL_CUR})', [])}) x),
f AS (SELECT min(air) AS v FROM ({fairness_sql(SQL_CUR, ATTRS, REFS, [0.5])}) y WHERE NOT is_reference),
p AS (SELECT max(psi) AS v FROM ({psi_sql(_long(SQL_BASE, feats), _long(SQL_CUR, feats))}) z)
SELECT 'Performance (AUC)' AS dimension, v AS value, CASE WHEN v IS NULL THEN 'Unknown' WHEN v >= 0.72 THEN 'Green' WHEN v >= 0.68 THEN 'Yellow' ELSE 'Red' END AS score FROM a
UNION ALL SELECT 'Fairness — AIR', v, CASE WHEN v IS NULL THEN 'Unknown' WHEN v >= 0.80 THEN 'Green' WHEN v >= 0.70 THEN 'Yellow' ELSE 'Red' END FROM f
UNION ALL SELECT 'Robustness — PSI + drift', v, CASE WHEN v IS NULL THEN 'Unknown' WHEN v < 0.10 THEN 'Green' WHEN v < 0.25 THEN 'Yellow' ELSE 'Red' END FROM p"""


@query("scorecard", _scorecard_sql())
def q_scorecard(spark, sf_dir):
    return _scorecard_df(spark, sf_dir)


@query("recommendation", f"""
WITH s AS ({_scorecard_sql()}),
c AS (SELECT CAST(sum(CASE WHEN score = 'Green' THEN 1 ELSE 0 END) AS BIGINT) AS n_green,
             CAST(sum(CASE WHEN score = 'Yellow' THEN 1 ELSE 0 END) AS BIGINT) AS n_yellow,
             CAST(sum(CASE WHEN score = 'Red' THEN 1 ELSE 0 END) AS BIGINT) AS n_red FROM s)
SELECT n_green, n_yellow, n_red, CASE WHEN n_red = 0 AND n_yellow <= 2 THEN 'DEPLOY WITH CONDITIONS'
  WHEN n_red = 0 AND n_yellow <= 4 THEN 'DO NOT DEPLOY YET' ELSE 'PAUSE AND REDESIGN' END AS recommendation FROM c""")
def q_recommendation(spark, sf_dir):
    return MO.recommendation(_scorecard_df(spark, sf_dir))


SQL_MONTHLY_SRC = f"SELECT *, date_trunc('month', event_time) AS month FROM ({SQL_SCORED}) s0"


def _monthly(spark, sf_dir):
    s = scored(spark, sf_dir).withColumn("month", V.month_of("event_time"))
    return FA.fairness_table(s, ATTRS, REFS, 0.5, keys=["month"])


@query("monthly_air", fairness_sql(SQL_MONTHLY_SRC, ATTRS, REFS, [0.5], keys=["month"]))
def q_monthly_air(spark, sf_dir):
    return _monthly(spark, sf_dir)


@query("consecutive_breach", f"""
WITH m AS ({fairness_sql(SQL_MONTHLY_SRC, ATTRS, REFS, [0.5], keys=["month"])}),
b AS (SELECT *, year(month) * 12 + month(month) AS mi FROM m WHERE NOT is_reference AND air < 0.8),
i AS (SELECT *, mi - row_number() OVER (PARTITION BY attribute, "group" ORDER BY mi) AS isl FROM b)
SELECT attribute, "group", min(month) AS start_month, max(month) AS end_month, CAST(count(*) AS BIGINT) AS months, min(air) AS min_value
FROM i GROUP BY attribute, "group", isl HAVING count(*) >= 2""")
def q_consecutive_breach(spark, sf_dir):
    m = _monthly(spark, sf_dir).where(~F.col("is_reference"))
    return MO.consecutive_breach(m, ["attribute", "group"], "month", "air", 0.80, 2)


SQL_PERIOD_SRC = f"SELECT *, CASE WHEN event_time < {CUT_SQL} THEN 'baseline' ELSE 'current' END AS period FROM ({SQL_SCORED}) s0"


@query("fnr_gap_widening", f"""
WITH f AS ({fairness_sql(SQL_PERIOD_SRC, ATTRS, REFS, [0.5], keys=["period"])}),
r AS (SELECT period, attribute, fnr AS fnr_ref FROM f WHERE is_reference),
g AS (SELECT f.period, f.attribute, f."group", f.fnr - r.fnr_ref AS gap FROM f JOIN r ON f.period = r.period AND f.attribute = r.attribute
      WHERE NOT f.is_reference),
w AS (SELECT b.attribute, b."group", b.gap AS gap_baseline, c.gap AS gap_current FROM g b JOIN g c
      ON b.attribute = c.attribute AND b."group" = c."group" AND b.period = 'baseline' AND c.period = 'current')
SELECT attribute, "group", round(gap_baseline, 4) AS gap_baseline, round(gap_current, 4) AS gap_current,
       round(CASE WHEN gap_baseline <> 0 THEN (gap_current - gap_baseline) / abs(gap_baseline) END, 4) AS relative_change,
       coalesce((gap_current - gap_baseline) / nullif(abs(gap_baseline), 0) > 0.20, false) AS widening FROM w""")
def q_fnr_gap_widening(spark, sf_dir):
    s = scored(spark, sf_dir).withColumn("period", F.when(F.col("event_time") < cut_lit(), "baseline").otherwise("current"))
    f = FA.fairness_table(s, ATTRS, REFS, 0.5, keys=["period"])
    r = f.where("is_reference").select("period", "attribute", F.col("fnr").alias("fnr_ref"))
    g = f.where(~F.col("is_reference")).join(r, ["period", "attribute"]).select(
        "period", "attribute", "group", (F.col("fnr") - F.col("fnr_ref")).alias("gap"))
    b = g.where("period = 'baseline'").select("attribute", "group", F.col("gap").alias("gb"))
    c = g.where("period = 'current'").select("attribute", "group", F.col("gap").alias("gc"))
    rel = F.try_divide(F.col("gc") - F.col("gb"), F.abs("gb"))
    return b.join(c, ["attribute", "group"]).select(
        "attribute", "group", rnd("gb").alias("gap_baseline"), rnd("gc").alias("gap_current"), rnd(rel).alias("relative_change"),
        F.coalesce(rel > 0.20, F.lit(False)).alias("widening"))


@query("wasserstein", f"""
WITH st AS (SELECT min(loan_amount) AS lo, max(loan_amount) AS hi FROM ({SQL_BASE}) b),
x AS (SELECT (loan_amount - lo) / (hi - lo) AS v, 1 AS ca, 0 AS cb FROM ({SQL_BASE}) b, st
      UNION ALL SELECT (loan_amount - lo) / (hi - lo), 0, 1 FROM ({SQL_CUR}) c, st),
h AS (SELECT v, sum(ca) AS ca, sum(cb) AS cb FROM x WHERE v IS NOT NULL GROUP BY v),
c AS (SELECT v, abs(CAST(sum(ca) OVER (ORDER BY v) AS DOUBLE) / sum(ca) OVER () - CAST(sum(cb) OVER (ORDER BY v) AS DOUBLE) / sum(cb) OVER ()) AS d,
             lead(v) OVER (ORDER BY v) AS vn FROM h)
SELECT round(sum(d * (vn - v)), 6) AS wasserstein FROM c WHERE vn IS NOT NULL""")
def q_wasserstein(spark, sf_dir):
    b, c = periods(spark, sf_dir)
    return MO.wasserstein(b, c, "loan_amount")


@query("completeness_by_group", f"""
WITH s AS ({SQL_NUMS}),
l AS (SELECT CAST(derived_race AS VARCHAR) AS "group", 'income' AS feature, income IS NULL AS miss FROM s
      UNION ALL SELECT CAST(derived_race AS VARCHAR), 'debt_to_income_ratio', debt_to_income_ratio IS NULL FROM s)
SELECT "group", feature, CAST(count(*) AS BIGINT) AS n, round(avg(CAST(miss AS DOUBLE)), 4) AS missing_rate,
       avg(CAST(miss AS DOUBLE)) > 0.2 AS flag FROM l GROUP BY ALL""")
def q_completeness(spark, sf_dir):
    s = _num(scored(spark, sf_dir))
    arr = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).isNull().cast("double").alias("miss"))
                    for c in ["income", "debt_to_income_ratio"]])
    x = s.select(F.col("derived_race").cast("string").alias("group"), F.explode(arr).alias("x")).select("group", "x.*")
    return x.groupBy("group", "feature").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("miss"), 4).alias("missing_rate"),
                                             (F.avg("miss") > 0.2).alias("flag"))


def _decile_sql() -> str:
    qs = ", ".join(f"quantile_cont(y_prob_cont, {dbl(i / 10)})" for i in range(1, 10))
    return f"""
WITH s AS ({SQL_MONTHLY_SRC}), e AS (SELECT month, [{qs}] AS edges FROM s GROUP BY month),
d AS (SELECT s.month, len(list_filter(e.edges, lambda t: t < s.y_prob_cont)) AS decile, s.y FROM s JOIN e ON s.month = e.month)"""


@query("decile_loss", _decile_sql() + """
SELECT month, CAST(decile AS INTEGER) AS decile, CAST(count(*) AS BIGINT) AS n, round(avg(CAST(1 - y AS DOUBLE)), 4) AS loss_rate
FROM d GROUP BY month, decile""")
def q_decile_loss(spark, sf_dir):
    return _deciles(spark, sf_dir).groupBy("month", "decile").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg((1 - F.col("y")).cast("double")), 4).alias("loss_rate"))


def _deciles(spark, sf_dir):
    from auditlens.functions.ordered import exact_quantiles, join_small
    s = scored(spark, sf_dir).withColumn("month", V.month_of("event_time"))
    q = exact_quantiles(s, "y_prob_cont", [i / 10 for i in range(1, 10)], ["month"])
    edges = q.groupBy("month").agg(F.array_sort(F.collect_list("q")).alias("edges"))  # 9 per month
    j = join_small(s, edges, "month")
    return j.select("month", "y", F.size(F.filter("edges", lambda t: t < F.col("y_prob_cont"))).cast("int").alias("decile"))


@query("loss_breach", f"""
WITH s AS ({SQL_MONTHLY_SRC}), b AS (SELECT avg(CAST(1 - y AS DOUBLE)) AS base FROM s WHERE event_time < {CUT_SQL}),
m AS (SELECT month, avg(CAST(1 - y AS DOUBLE)) AS r FROM s WHERE event_time >= {CUT_SQL} GROUP BY month)
SELECT month, round(r, 4) AS loss_rate, round(base, 4) AS baseline_loss_rate, r - base > 0.005 AS breach FROM m, b""")
def q_loss_breach(spark, sf_dir):
    s = scored(spark, sf_dir).withColumn("month", V.month_of("event_time")).withColumn("loss", (1 - F.col("y")).cast("double"))
    b = s.where(F.col("event_time") < cut_lit()).agg(F.avg("loss").alias("base"))
    m = s.where(F.col("event_time") >= cut_lit()).groupBy("month").agg(F.avg("loss").alias("r"))
    return m.crossJoin(F.broadcast(b)).select("month", rnd("r").alias("loss_rate"), rnd("base").alias("baseline_loss_rate"),
                                              (F.col("r") - F.col("base") > 0.005).alias("breach"))


#: A linear score over seven features; ranks are by mean absolute attribution.
DRIFT_COEFS = {"loan_amount": 1 / 400000, "property_value": 1 / 400000, "combined_loan_to_value_ratio": 1 / 90, "income": 1 / 20000,
               "debt_to_income_ratio": 1 / 70, "y_prob": 0.62, "y_prob_cont": 0.33}
DRIFT_FEATS = list(DRIFT_COEFS)
DRIFT_PROT = {n: c for n, c in ATTRS.items()}


def _drift_ranks(df):
    """Features by mean |coef x (value - mean)| within the period."""
    from pyspark.sql import Window

    from auditlens.operators.explain import LinearScore, linear_attributions
    attr = linear_attributions(df, LinearScore(0.0, DRIFT_COEFS), KEY_COLS)
    m = attr.agg(*[F.avg(F.abs(f)).alias(f) for f in DRIFT_FEATS])
    long = m.select(F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("v")) for f in DRIFT_FEATS])).alias("x")).select("x.*")
    return long.withColumn("rank", F.row_number().over(Window.orderBy(F.col("v").desc_nulls_last(), "feature")).cast("int"))  # seven rows


def _drift_rank_sql(src: str) -> str:
    parts = " UNION ALL ".join(f"SELECT '{f}' AS feature, (SELECT avg(abs({dbl(c)} * ({f} - m))) FROM ({src}) a, (SELECT avg({f}) AS m FROM ({src}) b) q) AS v"
                               for f, c in DRIFT_COEFS.items())
    return f"SELECT feature, v, row_number() OVER (ORDER BY v DESC NULLS LAST, feature) AS rk FROM ({parts}) u"


@query("top_feature_drift", f"""
WITH b AS ({_drift_rank_sql(SQL_BASE)}), c AS ({_drift_rank_sql(SQL_CUR)}),
e AS (SELECT *, {', '.join(f'dense_rank() OVER (ORDER BY {col}) - 1 AS "{n}_code"' for n, col in DRIFT_PROT.items())} FROM ({SQL_CUR}) x),
r AS ({' UNION ALL '.join(f"""SELECT '{f}' AS feature, '{n}' AS protected, round(corr(CAST({f} AS DOUBLE), CAST("{n}_code" AS DOUBLE)), 4) AS "corr" FROM e"""
                          for f in DRIFT_FEATS for n in DRIFT_PROT)})
SELECT c.feature, CAST(b.rk AS INTEGER) AS rank_before, CAST(c.rk AS INTEGER) AS "rank", r.protected, r."corr",
       c.rk <= 5 AND b.rk > 5 AS new_in_top5, c.rk <= 5 AND b.rk > 5 AND coalesce(abs(r."corr") > 0.3, false) AS flag
FROM c JOIN b ON b.feature = c.feature JOIN r ON r.feature = c.feature""")
def q_top_feature_drift(spark, sf_dir):
    """Attribution ranks in both periods joined with the correlation of
    each feature with each protected attribute; flagged when a feature is new
    in the top five and |r| > 0.30."""
    from auditlens.operators.explain import proxy_correlation
    from auditlens.operators.features import label_encode
    b, c = periods(spark, sf_dir)
    b, c = materialize(b.select(*KEY_COLS, *DRIFT_FEATS)), materialize(c.select(*KEY_COLS, *DRIFT_FEATS, *DRIFT_PROT.values()))
    coded = c
    for n, col in DRIFT_PROT.items():
        coded = label_encode(coded, col, f"{n}_code")
    corr = proxy_correlation(coded, DRIFT_FEATS, {n: f"{n}_code" for n in DRIFT_PROT}, min_n=2)
    before = _drift_ranks(b).select("feature", F.col("rank").alias("rank_before"))
    j = F.broadcast(_drift_ranks(c)).join(F.broadcast(before), "feature").join(corr, "feature")
    new = (F.col("rank") <= 5) & (F.col("rank_before") > 5)
    return j.select("feature", "rank_before", "rank", "protected", "corr", new.alias("new_in_top5"),
                    (new & F.coalesce(F.abs("corr") > 0.3, F.lit(False))).alias("flag"))


@query("channel_anomaly", f"""
WITH s AS (SELECT channel, CASE WHEN debt_to_income_ratio <> 0 THEN income / debt_to_income_ratio END AS ratio FROM ({SQL_NUMS}) x),
m AS (SELECT channel, count(ratio) AS n, quantile_cont(ratio, 0.5) AS med FROM s WHERE ratio IS NOT NULL GROUP BY channel),
p AS (SELECT quantile_cont(med, 0.5) AS pm FROM m WHERE n >= 20),
d AS (SELECT quantile_cont(abs(med - pm), 0.5) AS mad FROM m, p WHERE n >= 20),
z AS (SELECT m.*, pm, mad, CASE WHEN n >= 20 AND mad <> 0 THEN (med - pm) / (1.4826::DOUBLE * mad) END AS z FROM m, p, d)
SELECT channel, CAST(n AS BIGINT) AS n, round(med, 6) AS median, round(pm, 6) AS pop_median, round(mad, 6) AS mad, round(z, 4) AS robust_z,
       coalesce(abs(z) > 3.5, false) AS flag, n >= 20 AS in_population FROM z""")
def q_channel_anomaly(spark, sf_dir):
    s = _num(scored(spark, sf_dir)).withColumn("ratio", safe_div("income", "debt_to_income_ratio"))
    return MO.robust_outliers(s, "channel", "ratio")


@query("boundary_probing", f"""
WITH p AS (SELECT channel, count(*) AS n, sum(CASE WHEN abs(y_prob - 0.5) <= {dbl(0.05)} THEN 1 ELSE 0 END) AS near
           FROM ({SQL_SCORED}) s GROUP BY channel),
t AS (SELECT CAST(sum(near) AS DOUBLE) / sum(n) AS ps FROM p)
SELECT channel, CAST(n AS BIGINT) AS n, CAST(near AS BIGINT) AS near, round(CAST(near AS DOUBLE) / n, 4) AS near_share,
       round(ps, 4) AS population_share, n >= 20 AND CAST(near AS DOUBLE) / n >= ps * 3.0 AS flag FROM p, t""")
def q_boundary_probing(spark, sf_dir):
    return MO.boundary_probing(scored(spark, sf_dir), "channel")


@query("score_drift", psi_sql(_long(SQL_BASE, ["y_prob_cont"]), _long(SQL_CUR, ["y_prob_cont"])))
def q_score_drift(spark, sf_dir):
    b, c = periods(spark, sf_dir)
    return CA.psi_long(CA.to_long(b, ["y_prob_cont"]), CA.to_long(c, ["y_prob_cont"]))


def snapshot_b(df):
    """Second label snapshot: code 3 -> 2 on line 1, another purpose on line 2,
    line-7 rows removed."""
    return (df.where(F.col("l_linenumber") != 7)
            .withColumn("loan_purpose", F.when(F.col("l_linenumber") == 2, F.lit("X")).otherwise(F.col("loan_purpose")))
            .withColumn("action_taken", F.when((F.col("l_linenumber") == 1) & (F.col("action_taken") == 3), F.lit(2))
                        .otherwise(F.col("action_taken"))))


SQL_SNAP_B = f"""SELECT * REPLACE (CASE WHEN l_linenumber = 1 AND action_taken = 3 THEN 2 ELSE action_taken END AS action_taken,
  CASE WHEN l_linenumber = 2 THEN 'X' ELSE loan_purpose END AS loan_purpose)
FROM ({SQL_APPS}) a WHERE l_linenumber <> 7"""
_KS = ", ".join(KEY_COLS)
#: All columns of a row but its keys and label.
ROW_COLS = [c for c in VIEW if c not in (*KEY_COLS, "y")]


def _lab(src: str) -> str:
    return f"SELECT * REPLACE (CAST(action_taken AS DOUBLE) AS action_taken), CASE WHEN action_taken IN (1, 2) THEN 1 WHEN action_taken = 3 THEN 0 END AS y FROM ({src}) x WHERE action_taken IN (1, 2, 3)"


@query("label_diff", f"""
WITH o AS ({_lab(SQL_APPS)}), n AS ({_lab(SQL_SNAP_B)}),
j AS (SELECT coalesce(o.derived_race, n.derived_race) AS g, o.y AS yo, n.y AS yn,
  ({', '.join(f'o.{c}' for c in ROW_COLS)}) IS DISTINCT FROM ({', '.join(f'n.{c}' for c in ROW_COLS)}) AS other
  FROM o FULL OUTER JOIN n
      ON {' AND '.join(f'o.{k} = n.{k}' for k in KEY_COLS)})
SELECT CAST(g AS VARCHAR) AS "group", CASE WHEN yo IS NULL THEN 'added' WHEN yn IS NULL THEN 'removed'
  WHEN yo IS DISTINCT FROM yn THEN 'flipped' WHEN other THEN 'row_changed' ELSE 'unchanged' END AS change, CAST(count(*) AS BIGINT) AS n FROM j GROUP BY 1, 2""")
def q_label_diff(spark, sf_dir):
    """L19 over whole rows: every column but keys and label decides."""
    a = applications(spark, sf_dir)
    return MO.label_diff(apply_label(a), apply_label(snapshot_b(a)), KEY_COLS, "y", "derived_race", ROW_COLS)


@query("label_shift", f"""
WITH o AS (SELECT CAST(action_taken AS DOUBLE) AS action_taken, count(*) AS c FROM ({SQL_APPS}) a GROUP BY 1),
n AS (SELECT CAST(action_taken AS DOUBLE) AS action_taken, count(*) AS c FROM ({SQL_SNAP_B}) b GROUP BY 1),
j AS (SELECT coalesce(o.action_taken, n.action_taken) AS action_taken, coalesce(o.c, 0) AS co, coalesce(n.c, 0) AS cn FROM o FULL OUTER JOIN n ON o.action_taken = n.action_taken),
s AS (SELECT *, CAST(co AS DOUBLE) / sum(co) OVER () AS so, CAST(cn AS DOUBLE) / sum(cn) OVER () AS sn FROM j),
p AS (SELECT *, CASE WHEN so = 0 THEN 0.0001::DOUBLE ELSE so END AS po, CASE WHEN sn = 0 THEN 0.0001::DOUBLE ELSE sn END AS pn FROM s)
SELECT action_taken, CAST(co AS BIGINT) AS count_old, CAST(cn AS BIGINT) AS count_new, round(so, 4) AS share_old, round(sn, 4) AS share_new,
       round(sn - so, 4) AS share_diff, round((pn - po) * ln(pn / po), 6) AS psi_term FROM p""")
def q_label_shift(spark, sf_dir):
    a = applications(spark, sf_dir)
    return MO.categorical_shift(label_distribution(a), label_distribution(snapshot_b(a)), "action_taken")


#: Keys of a fingerprinted range, and the proxy features of Medium or High risk that the view has.
RANGE_KEYS = 4096
GATE_NUMBERS, GATE_LEVELS = ["income"], ["state_code", "county_code"]


def _ranges_sql(name: str) -> str:
    texts = [sql_text(c, "double" if c == "action_taken" else k) for c, k in VIEW.items()]
    row = " || ".join(f"coalesce(length({t}) || ':' || {t} || ';', '-;')" for t in texts)
    return (f"SELECT l_orderkey // {RANGE_KEYS} * {RANGE_KEYS} AS k, count(*) AS n, sum(CAST(('0x' || substr(md5({row}), 1, 15)) AS HUGEINT)) AS h FROM {name} GROUP BY 1")


def _levels_psi_sql(c: str) -> str:
    side = lambda src: f"SELECT coalesce(CAST({c} AS VARCHAR), 'Missing') AS lv, CAST(count(*) AS DOUBLE) / sum(count(*)) OVER () AS p FROM ({src}) s GROUP BY 1"
    return (f"SELECT 'proxy_psi_{c}' AS \"check\", round(sum((coalesce(a.p, 0.0001::DOUBLE) - coalesce(e.p, 0.0001::DOUBLE)) * ln(coalesce(a.p, 0.0001::DOUBLE) / coalesce(e.p, 0.0001::DOUBLE))), 4) AS value, "
            f"{dbl(0.10)} AS \"limit\", NULL AS detail FROM ({side(SQL_BASE)}) e FULL OUTER JOIN ({side(SQL_CUR)}) a ON e.lv = a.lv")


@query("pretrain_gate", f"""
WITH o AS ({_lab(SQL_APPS)}), n AS ({_lab(SQL_SNAP_B)}), ro AS ({_ranges_sql('o')}), rn AS ({_ranges_sql('n')}),
d AS (SELECT coalesce(ro.k, rn.k) AS k FROM ro FULL OUTER JOIN rn ON ro.k = rn.k WHERE ro.h IS DISTINCT FROM rn.h OR ro.n IS DISTINCT FROM rn.n),
air AS ({fairness_sql(f"SELECT *, CAST(y AS DOUBLE) AS y1 FROM ({_lab(SQL_SNAP_B)}) z", {"Race": "derived_race"}, {"Race": "AFRICA"}, [0.5], p="y1")}),
c AS (SELECT 'snapshot_ranges_changed' AS "check", CAST(count(*) AS DOUBLE) AS value, 0.0::DOUBLE AS "limit",
             CASE WHEN count(*) > 0 THEN CAST(min(k) AS VARCHAR) || ' to ' || CAST(max(k) + {RANGE_KEYS - 1} AS VARCHAR) END AS detail FROM d
  UNION ALL SELECT 'proxy_psi_' || feature, psi, {dbl(0.10)}, NULL FROM ({psi_sql(_long(SQL_BASE, GATE_NUMBERS), _long(SQL_CUR, GATE_NUMBERS))}) p
  UNION ALL {' UNION ALL '.join(_levels_psi_sql(c) for c in GATE_LEVELS)}
  UNION ALL SELECT 'min_air_new_labels', min(air), {dbl(0.80)}, NULL FROM air WHERE NOT is_reference)
SELECT "check", value, "limit", coalesce(CASE WHEN "check" = 'min_air_new_labels' THEN value >= "limit" ELSE value <= "limit" END, false) AS passed, detail FROM c""")
def q_pretrain_gate(spark, sf_dir):
    """Whole-row fingerprints of both label snapshots by key range, the
    drift of every Medium or High proxy feature and AIR under the new labels."""
    a = applications(spark, sf_dir)
    old, new = (apply_label(x).select(*VIEW) for x in (a, snapshot_b(a)))
    b, c = periods(spark, sf_dir, [*GATE_NUMBERS, *GATE_LEVELS])
    return MO.pretrain_gate(old, new, b, c, "l_orderkey", RANGE_KEYS, GATE_NUMBERS, GATE_LEVELS, {"Race": "derived_race"}, {"Race": "AFRICA"})
