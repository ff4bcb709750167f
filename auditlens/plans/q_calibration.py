"""Family J: calibration, PSI drift, perturbation, holdout stress."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from auditlens.operators import calibration as CA
from auditlens.operators.explain import LinearScore, perturbation
from auditlens.operators.metrics import evaluate
from auditlens.operators.splits import KEY_COLS, hash_unit
from auditlens.plans.common import SQL_SCORED, scored, tables
from auditlens.plans.registry import query
from auditlens.plans.sqlgen import bin_sql, dbl
from auditlens.sources import views as V

MODEL = LinearScore(0.05, {"loan_amount": 1 / 200000, "combined_loan_to_value_ratio": 1 / 200})
CUT = "1999-01-01"


def model_sql(x1: str = "loan_amount", x2: str = "combined_loan_to_value_ratio") -> str:
    m = f"(({dbl(MODEL.intercept)} + {dbl(MODEL.coefs['loan_amount'])} * ({x1})) + {dbl(MODEL.coefs['combined_loan_to_value_ratio'])} * ({x2}))"
    return f"({m} / (1.0::DOUBLE + {m}))"


def _cont(spark, sf_dir):
    return scored(spark, sf_dir).withColumn("y_prob", F.col("y_prob_cont"))


SQL_CONT = f"SELECT * REPLACE (y_prob_cont AS y_prob) FROM ({SQL_SCORED}) s0"


@query("calibration_curve", f"""
SELECT {bin_sql('y_prob')} AS bin, CAST(count(*) AS BIGINT) AS n, round(sum(y_prob) / count(*), 6) AS mean_pred,
       round(CAST(sum(y) AS DOUBLE) / count(*), 6) AS frac_pos FROM ({SQL_CONT}) s GROUP BY 1""")
def q_calibration_curve(spark, sf_dir):
    c = CA.calibration_curve(_cont(spark, sf_dir))
    return c.select("bin", "n", F.round("mean_pred", 6).alias("mean_pred"), F.round("frac_pos", 6).alias("frac_pos"))


def _ece_sql(src: str, group: str | None = None) -> str:
    g = f"CAST({group} AS VARCHAR) AS grp, " if group else ""
    gb = "grp, " if group else ""
    return f"""
WITH b AS (SELECT {g}{bin_sql('y_prob')} AS bin, count(*) AS nb, sum(y) AS pb, sum(y_prob) AS sb,
                  sum((y_prob - y) * (y_prob - y)) AS se
           FROM ({src}) s {'WHERE ' + group + ' IS NOT NULL' if group else ''} GROUP BY ALL)
SELECT {gb}CAST(sum(nb) AS BIGINT) AS n, round(CASE WHEN sum(nb) >= 20 THEN avg(abs(CAST(pb AS DOUBLE) / nb - sb / nb)) END, 4) AS ece,
       round(sum(se) / sum(nb), 4) AS brier FROM b {'GROUP BY grp' if group else ''}"""


@query("ece", f"SELECT n, ece FROM ({_ece_sql(SQL_CONT)}) e")
def q_ece(spark, sf_dir):
    return CA.ece(_cont(spark, sf_dir))


@query("calibration_by_group", f"""
SELECT grp AS "group", 'source' AS attribute, n, ece, brier FROM ({_ece_sql(V.SQL_DOCUMENTS_SCORED, 'source')}) e WHERE n >= 20""")
def q_calibration_by_group(spark, sf_dir):
    return CA.calibration_by_group(V.documents_scored(tables(spark, sf_dir)), "source")


@query("ece_gap", f"""
SELECT 'lang' AS attribute, round(max(ece) - min(ece), 4) AS ece_gap, CAST(count(*) AS BIGINT) AS n_groups
FROM ({_ece_sql(V.SQL_DOCUMENTS_SCORED, 'lang')}) e WHERE n >= 20""")
def q_ece_gap(spark, sf_dir):
    return CA.ece_gap(CA.calibration_by_group(V.documents_scored(tables(spark, sf_dir)), "lang"))


def _periods(spark, sf_dir):
    s = scored(spark, sf_dir)
    cut = V.ntz("1999-01-01 00:00:00")
    base = s.where(F.col("event_time") < cut)
    cur = s.where(F.col("event_time") >= cut).withColumn("loan_amount", F.col("loan_amount") * F.lit(1.2))
    return base, cur


SQL_BASE = f"SELECT * FROM ({SQL_SCORED}) s WHERE event_time < TIMESTAMP '{CUT}'"
SQL_CUR = f"SELECT * REPLACE (loan_amount * {dbl(1.2)} AS loan_amount) FROM ({SQL_SCORED}) s WHERE event_time >= TIMESTAMP '{CUT}'"
PSI_FEATURES = ["loan_amount", "property_value", "combined_loan_to_value_ratio", "y_prob"]


def psi_sql(base_long: str, cur_long: str) -> str:
    qs = ", ".join(f"quantile_cont(value, {dbl(i / 10)})" for i in range(11))
    return f"""
WITH e AS (SELECT feature, value FROM ({base_long}) x WHERE value IS NOT NULL),
a AS (SELECT feature, value FROM ({cur_long}) x WHERE value IS NOT NULL),
ed AS (SELECT feature, list_sort(list_distinct([{qs}])) AS edges FROM e GROUP BY feature),
tot AS (SELECT feature, sum(CASE WHEN side = 'e' THEN 1 ELSE 0 END) AS n_e, sum(CASE WHEN side = 'a' THEN 1 ELSE 0 END) AS n_a
        FROM (SELECT feature, 'e' AS side FROM e UNION ALL SELECT feature, 'a' FROM a) GROUP BY feature),
b AS (SELECT x.feature, x.side, CASE WHEN x.value = ed.edges[-1] THEN len(ed.edges) - 2
                                 ELSE len(list_filter(ed.edges, lambda t: t <= x.value)) - 1 END AS bin
      FROM (SELECT feature, value, 'e' AS side FROM e UNION ALL SELECT feature, value, 'a' FROM a) x JOIN ed ON x.feature = ed.feature
      WHERE x.value >= ed.edges[1] AND x.value <= ed.edges[-1]),
cnt AS (SELECT feature, bin, sum(CASE WHEN side = 'e' THEN 1 ELSE 0 END) AS c_e, sum(CASE WHEN side = 'a' THEN 1 ELSE 0 END) AS c_a FROM b GROUP BY ALL),
bins AS (SELECT feature, unnest(range(0, len(edges) - 1)) AS bin FROM ed WHERE len(edges) >= 3),
f AS (SELECT bins.feature, coalesce(CAST(cnt.c_e AS DOUBLE) / tot.n_e, 0.0::DOUBLE) AS pe,
             coalesce(CAST(cnt.c_a AS DOUBLE) / tot.n_a, 0.0::DOUBLE) AS pa
      FROM bins LEFT JOIN cnt ON bins.feature = cnt.feature AND bins.bin = cnt.bin JOIN tot ON bins.feature = tot.feature),
f2 AS (SELECT feature, CASE WHEN pe = 0 THEN 0.0001::DOUBLE ELSE pe END AS pe, CASE WHEN pa = 0 THEN 0.0001::DOUBLE ELSE pa END AS pa FROM f),
p AS (SELECT feature, sum((pa - pe) * ln(pa / pe)) AS psi FROM f2 GROUP BY feature)
SELECT tot.feature, round(p.psi, 4) AS psi, CAST(tot.n_e AS BIGINT) AS n_train, CAST(tot.n_a AS BIGINT) AS n_holdout
FROM tot LEFT JOIN p ON tot.feature = p.feature"""


def _long(src: str, cols: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM ({src}) s{i}" for i, c in enumerate(cols))


@query("psi", psi_sql(_long(SQL_BASE, ["loan_amount"]), _long(SQL_CUR, ["loan_amount"])))
def q_psi(spark, sf_dir):
    b, c = _periods(spark, sf_dir)
    return CA.psi_long(CA.to_long(b, ["loan_amount"]), CA.to_long(c, ["loan_amount"]))


@query("psi_table", f"""
WITH r AS ({psi_sql(_long(SQL_BASE, PSI_FEATURES), _long(SQL_CUR, PSI_FEATURES))})
SELECT feature, psi,
  CASE WHEN psi IS NULL THEN 'Cannot compute' WHEN psi < 0.10 THEN 'Stable' WHEN psi < 0.25 THEN 'Moderate shift — monitor'
       ELSE 'Major shift — review required' END AS interpretation,
  CASE WHEN psi IS NULL THEN 'Cannot compute' WHEN psi < 0.10 THEN 'None' WHEN psi < 0.25 THEN 'Increase monitoring frequency'
       ELSE 'Model review required' END AS action, n_train, n_holdout FROM r
UNION ALL SELECT 'dti_numeric', NULL, 'Feature missing', 'Investigate', 0, 0""")
def q_psi_table(spark, sf_dir):
    b, c = _periods(spark, sf_dir)
    return CA.psi_table(b, c, PSI_FEATURES + ["dti_numeric"])


def auc_sql(src: str, keys: list[str]) -> str:
    """Tie-aware AUC per key group (unrounded) as DuckDB text."""
    kc = "".join(f"{c}, " for c in keys)
    part = f"PARTITION BY {', '.join(keys)} " if keys else ""
    return f"""SELECT {kc}sum(pos * (cum_neg - neg + neg / 2.0::DOUBLE)) / (CAST(max(pp) AS DOUBLE) * max(nn)) AS auc_raw FROM (
  SELECT *, sum(neg) OVER ({part}ORDER BY score) AS cum_neg, sum(pos) OVER ({part.strip()}) AS pp, sum(neg) OVER ({part.strip()}) AS nn
  FROM (SELECT {kc}y_prob AS score, sum(y) AS pos, count(*) - sum(y) AS neg FROM {src} GROUP BY ALL) h) c GROUP BY ALL"""


def _pert_sql() -> str:
    ks = ", ".join(f"CAST({k} AS VARCHAR)" for k in KEY_COLS)
    rows = []
    for i, (f, lv) in enumerate((f, lv) for f in ["loan_amount", "combined_loan_to_value_ratio"] for lv in [0.1, 0.2]):
        u = f"CAST(CAST(('0x' || substr(d, {1 + 8 * i}, 8)) AS BIGINT) AS DOUBLE) / {dbl(2 ** 32)}"
        noise = f"(1.0::DOUBLE - {dbl(lv)} + 2.0::DOUBLE * {dbl(lv)} * ({u}))"
        x1 = f"loan_amount * {noise}" if f == "loan_amount" else "loan_amount"
        x2 = f"combined_loan_to_value_ratio * {noise}" if f != "loan_amount" else "combined_loan_to_value_ratio"
        rows.append(f"SELECT '{f}' AS feature, {dbl(lv)} AS level, y, derived_race AS g, {model_sql(x1, x2)} AS y_prob FROM s")
    return f"""
WITH s AS (SELECT *, md5(concat_ws('|', '42', {ks})) AS d FROM ({SQL_SCORED}) s0), x AS ({' UNION ALL '.join(rows)}),
auc AS ({auc_sql('x', ['feature', 'level'])}),
base AS ({auc_sql(f'(SELECT y, {model_sql()} AS y_prob FROM s)', [])}),
rt AS (SELECT feature, level, g, CAST(sum(CASE WHEN y_prob >= 0.5 THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS r FROM x GROUP BY ALL),
ref AS (SELECT feature, level, r AS rr FROM rt WHERE g = 'AFRICA')
SELECT auc.feature, '±' || CAST(CAST(auc.level * 100 AS INTEGER) AS VARCHAR) || '%' AS noise_level,
       round(base.auc_raw, 4) AS baseline_auc, round(auc.auc_raw, 4) AS perturbed_auc, round(auc.auc_raw - base.auc_raw, 4) + 0.0::DOUBLE AS auc_delta,
       abs(round(auc.auc_raw - base.auc_raw, 4)) < 0.02 AS auc_stable, rt.g AS "group", round(rt.r, 4) AS approval_rate,
       round(CASE WHEN ref.rr > 0 THEN rt.r / ref.rr END, 4) AS air
FROM rt JOIN auc ON auc.feature = rt.feature AND auc.level = rt.level CROSS JOIN base
LEFT JOIN ref ON ref.feature = rt.feature AND ref.level = rt.level"""


@query("perturbation", _pert_sql())
def q_perturbation(spark, sf_dir):
    return perturbation(scored(spark, sf_dir), MODEL, ["loan_amount", "combined_loan_to_value_ratio"], KEY_COLS)


_HOLD = ", ".join(f"'{s}'" for s in V.HOLDOUT_STATES)


@query("holdout_stress", None)
def q_holdout_stress(spark, sf_dir):
    s = _cont(spark, sf_dir)
    split = (F.when(F.col("state_code").isin(*V.HOLDOUT_STATES), F.lit("geo_holdout"))
             .when(hash_unit(KEY_COLS) < 0.15, F.lit("test")))
    e = evaluate(s.withColumn("split", split).where(F.col("split").isNotNull()), 0.5, ["split"])
    t = e.where("split = 'test'").select(F.col("auc").alias("auc_test"), F.col("positive_rate_predicted").alias("approval_test"))
    h = e.where("split = 'geo_holdout'").select(F.col("auc").alias("auc_holdout"),
                                                 F.col("positive_rate_predicted").alias("approval_holdout"))
    j = t.crossJoin(h)
    return j.select("auc_test", "auc_holdout", F.round(F.col("auc_holdout") - F.col("auc_test"), 4).alias("auc_delta"),
                    "approval_test", "approval_holdout",
                    F.round(F.col("approval_holdout") - F.col("approval_test"), 4).alias("approval_delta"))


def _stress_sql() -> str:
    from auditlens.plans.q_metrics import eval_sql
    from auditlens.plans.q_features import SQL_HSPLIT_U
    src = (f"SELECT * FROM (SELECT *, CASE WHEN state_code IN ({_HOLD}) THEN 'geo_holdout' WHEN {SQL_HSPLIT_U} < {dbl(0.15)} "
           f"THEN 'test' END AS split FROM ({SQL_CONT}) s0) s1 WHERE split IS NOT NULL")
    e = eval_sql(src, 0.5, ["split"])
    return f"""
WITH e AS ({e}), t AS (SELECT auc AS auc_test, positive_rate_predicted AS approval_test FROM e WHERE split = 'test'),
h AS (SELECT auc AS auc_holdout, positive_rate_predicted AS approval_holdout FROM e WHERE split = 'geo_holdout')
SELECT auc_test, auc_holdout, round(auc_holdout - auc_test, 4) AS auc_delta, approval_test, approval_holdout,
       round(approval_holdout - approval_test, 4) AS approval_delta FROM t CROSS JOIN h"""


from auditlens.plans.registry import ORACLE as _O  # noqa: E402

_O["holdout_stress"] = _stress_sql()
