"""Family K: explainability with the closed-form linear score."""

from __future__ import annotations

from pyspark.sql import functions as F

from auditlens.functions.columns import rnd
from auditlens.operators import explain as EX
from auditlens.operators.features import clean_numeric, label_encode
from auditlens.operators.leakage import PROXY_RISK, proxy_risk_table
from auditlens.operators.splits import KEY_COLS
from auditlens.plans.common import SQL_SCORED, scored
from auditlens.plans.q_calibration import MODEL, auc_sql, model_sql
from auditlens.plans.q_features import SQL_HSPLIT_U
from auditlens.plans.registry import query
from auditlens.plans.sqlgen import dbl, values

KS = ", ".join(KEY_COLS)
FEATS = list(MODEL.coefs)
C1, C2 = (dbl(MODEL.coefs[f]) for f in FEATS)


@query("linear_attributions", f"""
WITH s AS ({SQL_SCORED}), m AS (SELECT avg(loan_amount) AS m1, avg(combined_loan_to_value_ratio) AS m2 FROM s)
SELECT {KS}, round({C1} * (loan_amount - m1), 6) AS loan_amount, round({C2} * (combined_loan_to_value_ratio - m2), 6) AS combined_loan_to_value_ratio
FROM s CROSS JOIN m""")
def q_linear_attributions(spark, sf_dir):
    a = EX.linear_attributions(scored(spark, sf_dir), MODEL, KEY_COLS)
    return a.select(*KEY_COLS, *[rnd(f, 6).alias(f) for f in FEATS])


_PROXY = values([(i, f, r, j) for i, (f, r, j) in enumerate(PROXY_RISK)], ["dict_order", "feature", "risk_level", "justification"])


@query("top_features", f"""
WITH s AS ({SQL_SCORED}), m AS (SELECT avg(loan_amount) AS m1, avg(combined_loan_to_value_ratio) AS m2 FROM s),
a AS (SELECT 'loan_amount' AS feature, avg(abs({C1} * (loan_amount - m1))) AS v FROM s CROSS JOIN m
      UNION ALL SELECT 'combined_loan_to_value_ratio', avg(abs({C2} * (combined_loan_to_value_ratio - m2))) FROM s CROSS JOIN m),
r AS (SELECT *, row_number() OVER (ORDER BY v DESC, feature) AS "rank" FROM a),
c AS (SELECT r.*, d.risk_level, d.justification, row_number() OVER (PARTITION BY r.feature ORDER BY
        coalesce(r.feature = d.feature, false) DESC, d.dict_order ASC NULLS LAST) AS rn
      FROM r LEFT JOIN {_PROXY} d ON r.feature = d.feature OR starts_with(r.feature, d.feature))
SELECT CAST("rank" AS INTEGER) AS "rank", feature, round(v, 6) AS mean_abs_attribution, coalesce(risk_level, 'Low') AS proxy_risk_level,
       coalesce(justification, '') AS proxy_justification FROM c WHERE rn = 1 AND "rank" <= 20""")
def q_top_features(spark, sf_dir):
    a = EX.linear_attributions(scored(spark, sf_dir), MODEL, KEY_COLS)
    return EX.top_features(a, FEATS, proxy_risk_table(spark), 20)


#: The last one follows race by construction, so that there is a pair to flag.
CORR_FEATS = ["loan_amount", "property_value", "combined_loan_to_value_ratio", "income", "y_prob", "area_index"]
AREA = "length(derived_race) + l_linenumber"
PROT = {"Race": "derived_race", "Sex": "derived_sex", "Age": "applicant_age"}


def _encoded(spark, sf_dir):
    s = clean_numeric(scored(spark, sf_dir), ["income"]).withColumn("area_index", F.expr(AREA).cast("double"))
    for name, c in PROT.items():
        s = label_encode(s, c, f"{name}_code")
    return s


def _corr_sql(limit: float | None = None) -> str:
    codes = ", ".join(f"dense_rank() OVER (ORDER BY {c}) - 1 AS \"{n}_code\"" for n, c in PROT.items())
    parts = []
    for f in CORR_FEATS:
        for n in PROT:
            parts.append(f"""SELECT '{f}' AS feature, '{n}' AS protected,
  CAST(count(CASE WHEN {f} IS NOT NULL AND "{n}_code" IS NOT NULL THEN 1 END) AS BIGINT) AS n,
  round(CASE WHEN count(CASE WHEN {f} IS NOT NULL AND "{n}_code" IS NOT NULL THEN 1 END) >= 20
             THEN corr(CAST({f} AS DOUBLE), CAST("{n}_code" AS DOUBLE)) END, 4) AS "corr" FROM e""")
    from auditlens.plans.q_features import sql_num
    body = f"""
WITH s AS (SELECT * REPLACE ({sql_num('income')} AS income), CAST({AREA} AS DOUBLE) AS area_index FROM ({SQL_SCORED}) s0),
e AS (SELECT *, {codes} FROM s)
{' UNION ALL '.join(parts)}"""
    if limit is None:
        return body
    return f"SELECT *, {dbl(limit)} AS \"limit\" FROM ({body}) x WHERE abs(\"corr\") > {dbl(limit)}"


@query("proxy_correlation", _corr_sql())
def q_proxy_correlation(spark, sf_dir):
    return EX.proxy_correlation(_encoded(spark, sf_dir), CORR_FEATS, {n: f"{n}_code" for n in PROT})


@query("proxy_corr_flags", _corr_sql(0.30))
def q_proxy_corr_flags(spark, sf_dir):
    c = EX.proxy_correlation(_encoded(spark, sf_dir), CORR_FEATS, {n: f"{n}_code" for n in PROT})
    return EX.proxy_corr_flags(c, 0.30)


@query("proxy_corr_flags_tight", _corr_sql(0.15))
def q_proxy_corr_flags_tight(spark, sf_dir):
    c = EX.proxy_correlation(_encoded(spark, sf_dir), CORR_FEATS, {n: f"{n}_code" for n in PROT})
    return EX.proxy_corr_flags(c, 0.15)


@query("case_selection", f"""
WITH s AS (SELECT CAST(derived_race AS VARCHAR) AS "group", {KS}, y_prob, y,
                  CASE WHEN y_prob >= 0.5 AND y = 1 THEN 'TP' WHEN y_prob < 0.5 AND y = 0 THEN 'TN'
                       WHEN y_prob < 0.5 AND y = 1 THEN 'FN' WHEN y_prob >= 0.5 AND y = 0 THEN 'FP' END AS case_type,
                  abs(y_prob - 0.5) <= {dbl(0.05)} AS near FROM ({SQL_SCORED}) s0),
f AS (SELECT *, row_number() OVER (PARTITION BY "group", case_type ORDER BY {KS}, y_prob, y) AS ordinal FROM s
      WHERE case_type IN ('TP', 'TN', 'FN')),
n AS (SELECT *, row_number() OVER (PARTITION BY "group" ORDER BY {KS}, y_prob, y) AS ordinal FROM s WHERE near)
SELECT "group", case_type, CAST(ordinal AS INTEGER) AS ordinal, {KS}, y_prob, y FROM f WHERE ordinal = 1
UNION ALL SELECT "group", 'NEAR_THRESHOLD', CAST(ordinal AS INTEGER), {KS}, y_prob, y FROM n WHERE ordinal <= 2""")
def q_case_selection(spark, sf_dir):
    return EX.case_selection(scored(spark, sf_dir), "derived_race", KEY_COLS)


DELTAS = {"loan_amount": 50000.0, "combined_loan_to_value_ratio": 20.0}


def _cf_sql() -> str:
    rows = []
    for f, d in DELTAS.items():
        x1 = f"loan_amount + {dbl(d)}" if f == "loan_amount" else "loan_amount"
        x2 = f"combined_loan_to_value_ratio + {dbl(d)}" if f != "loan_amount" else "combined_loan_to_value_ratio"
        rows.append(f"""SELECT {KS}, '{f}' AS feature_changed, round({f}, 2) AS original_value, round({f} + {dbl(d)}, 2) AS counterfactual_value,
  {dbl(d)} AS delta, round(op, 4) AS original_prob, round({model_sql(x1, x2)}, 4) AS counterfactual_prob,
  {model_sql(x1, x2)} >= 0.5 AS decision_flipped FROM dn""")
    return f"""WITH s AS ({SQL_SCORED}), dn AS (SELECT *, {model_sql()} AS op FROM s WHERE {model_sql()} < 0.5)
{' UNION ALL '.join(rows)}"""


@query("counterfactuals", _cf_sql())
def q_counterfactuals(spark, sf_dir):
    return EX.counterfactuals(scored(spark, sf_dir), MODEL, DELTAS, KEY_COLS)


@query("counterfactual_flips", f"""
WITH c AS ({_cf_sql()})
SELECT feature_changed, CAST(count(*) AS BIGINT) AS n_scenarios, CAST(sum(CASE WHEN decision_flipped THEN 1 ELSE 0 END) AS BIGINT) AS n_flips,
  CAST(count(DISTINCT CASE WHEN decision_flipped THEN ({KS}) END) AS BIGINT) AS cases_flipped,
  coalesce((SELECT risk_level FROM {_PROXY} d WHERE d.feature = c.feature_changed), 'Low') AS proxy_risk_level
FROM c GROUP BY feature_changed""")
def q_counterfactual_flips(spark, sf_dir):
    cf = EX.counterfactuals(scored(spark, sf_dir), MODEL, DELTAS, KEY_COLS)
    return EX.counterfactual_flips(cf, KEY_COLS, proxy_risk_table(spark))


_SHIFT = f"SELECT y, {', '.join(f'{f}, coalesce(lead({f}) OVER o, first_value({f}) OVER o) AS next_{f}' for f in FEATS)} FROM (SELECT *, {SQL_HSPLIT_U.replace('42|', '7|')} AS u FROM ({SQL_SCORED}) s0) s WINDOW o AS (ORDER BY u, {KS})"


@query("permutation_importance", f"""
WITH p AS ({_SHIFT}),
x AS (SELECT '' AS feature, y, {model_sql()} AS y_prob FROM p
      UNION ALL SELECT '{FEATS[0]}', y, {model_sql(x1=f'next_{FEATS[0]}')} FROM p
      UNION ALL SELECT '{FEATS[1]}', y, {model_sql(x2=f'next_{FEATS[1]}')} FROM p),
a AS ({auc_sql('x', ['feature'])}), b AS (SELECT auc_raw AS base FROM a WHERE feature = '')
SELECT feature, round(base, 4) AS baseline_auc, round(auc_raw, 4) AS permuted_auc, round(base - auc_raw, 4) AS importance FROM a, b WHERE feature <> ''""")
def q_permutation_importance(spark, sf_dir):
    return EX.permutation_importance(scored(spark, sf_dir), MODEL, KEY_COLS)
