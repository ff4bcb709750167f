"""Family I: fairness queries."""

from __future__ import annotations

from auditlens.operators import fairness as FA
from auditlens.plans.common import ATTRS, REFS, SQL_SCORED, scored
from auditlens.plans.registry import query
from auditlens.plans.sqlgen import fairness_sql


@query("fairness_table", fairness_sql(SQL_SCORED, ATTRS, REFS, [0.5]))
def q_fairness_table(spark, sf_dir):
    return FA.fairness_table(scored(spark, sf_dir), ATTRS, REFS, threshold=0.5)

from pyspark.sql import functions as F  # noqa: E402

from auditlens.functions.ordered import materialize  # noqa: E402
from auditlens.operators.features import few_levels  # noqa: E402
from auditlens.operators.metrics import evaluate  # noqa: E402
from auditlens.plans.common import tables  # noqa: E402
from auditlens.plans.sqlgen import dbl, norm_cdf_sql, values  # noqa: E402
from auditlens.sources import views as V  # noqa: E402

_FT = fairness_sql(SQL_SCORED, ATTRS, REFS, [0.5], detail=True)
_COLS = '"attribute", "group", is_reference, n, threshold, approval_rate, air, fpr, fnr, "precision", recall, ece'


@query("air_thresholds", fairness_sql(SQL_SCORED, ATTRS, REFS, [0.3, 0.5, 0.7]))
def q_air_thresholds(spark, sf_dir):
    return FA.air_across_thresholds(scored(spark, sf_dir), ATTRS, REFS, [0.3, 0.5, 0.7])


@query("error_rate_gaps", f"""
WITH f AS ({_FT}), r AS (SELECT attribute, threshold, fpr AS fpr_ref, fnr AS fnr_ref FROM f WHERE is_reference),
j AS (SELECT f.attribute, f."group", f.threshold, f.fpr, r.fpr_ref, f.fnr, r.fnr_ref,
        round(f.fpr - r.fpr_ref, 4) AS fpr_gap,
        round(CASE WHEN r.fpr_ref <> 0 THEN (f.fpr - r.fpr_ref) / r.fpr_ref END * 100, 2) AS fpr_gap_pct,
        round(f.fnr - r.fnr_ref, 4) AS fnr_gap,
        round(CASE WHEN r.fnr_ref <> 0 THEN (f.fnr - r.fnr_ref) / r.fnr_ref END * 100, 2) AS fnr_gap_pct
      FROM f JOIN r ON f.attribute = r.attribute AND f.threshold = r.threshold WHERE NOT f.is_reference)
SELECT *, coalesce(abs(fpr_gap_pct) > 10 OR abs(fnr_gap_pct) > 10, false) AS flag FROM j""")
def q_error_rate_gaps(spark, sf_dir):
    return FA.error_rate_gaps(FA.fairness_table(scored(spark, sf_dir), ATTRS, REFS, 0.5))


def _inter_sql(src: str, a: str, b: str, ra: str, rb: str, t: float, min_n: int) -> str:
    return f"""
WITH c AS (SELECT CAST({a} AS VARCHAR) AS group_a, CAST({b} AS VARCHAR) AS group_b, count(*) AS n,
                  sum(CASE WHEN y_prob >= {dbl(t)} THEN 1 ELSE 0 END) AS pp
           FROM ({src}) s WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY 1, 2),
r AS (SELECT max(CAST(pp AS DOUBLE) / n) AS ref FROM c WHERE group_a = '{ra}' AND group_b = '{rb}')
SELECT group_a, group_b, CAST(n AS BIGINT) AS n,
       CASE WHEN n >= {min_n} THEN round(CAST(pp AS DOUBLE) / n, 4) END AS approval_rate,
       CASE WHEN n >= {min_n} THEN round(CASE WHEN r.ref > 0 THEN (CAST(pp AS DOUBLE) / n) / r.ref END, 4) END AS air_vs_reference,
       n < {min_n} AS suppressed, CASE WHEN n < {min_n} THEN 'n < {min_n} suppressed' ELSE '' END AS note
FROM c CROSS JOIN r"""


@query("intersectional", _inter_sql(SQL_SCORED, "derived_race", "derived_sex", "AFRICA", "N", 0.5, 30))
def q_intersectional(spark, sf_dir):
    return FA.intersectional_table(scored(spark, sf_dir), "derived_race", "derived_sex", "AFRICA", "N", 0.5)


@query("intersectional_docs", _inter_sql(V.SQL_DOCUMENTS_SCORED, "lang", "toxic", "en", "0", 0.5, 30))
def q_intersectional_docs(spark, sf_dir):
    d = V.documents_scored(tables(spark, sf_dir))
    return FA.intersectional_table(d, "lang", "toxic", "en", "0", 0.5)


@query("intersectional_pivot", f"""
WITH t AS ({_inter_sql(SQL_SCORED, "derived_race", "derived_sex", "AFRICA", "N", 0.5, 30)})
SELECT group_a AS race, max(CASE WHEN group_b = 'A' THEN air_vs_reference END) AS "A",
       max(CASE WHEN group_b = 'N' THEN air_vs_reference END) AS "N",
       max(CASE WHEN group_b = 'R' THEN air_vs_reference END) AS "R" FROM t GROUP BY 1""")
def q_intersectional_pivot(spark, sf_dir):
    s = scored(spark, sf_dir)
    t = FA.intersectional_table(s, "derived_race", "derived_sex", "AFRICA", "N", 0.5)
    return t.groupBy(F.col("group_a").alias("race")).pivot("group_b", few_levels(t, "group_b")).agg(F.first("air_vs_reference"))


@query("fairness_significance", f"""
WITH f AS ({_FT}), r AS (SELECT attribute, threshold, n AS rn, pred_pos AS rp FROM f WHERE is_reference),
z AS (SELECT f.*, (CAST(f.pred_pos + r.rp AS DOUBLE) / (f.n + r.rn)) AS pool, r.rn, r.rp
      FROM f LEFT JOIN r ON f.attribute = r.attribute AND f.threshold = r.threshold),
z2 AS (SELECT *, sqrt(pool * (1.0::DOUBLE - pool) * (1.0::DOUBLE / n + 1.0::DOUBLE / rn)) AS se FROM z),
z3 AS (SELECT *, CASE WHEN NOT is_reference AND pool > 0 AND pool < 1 AND se > 0
                      THEN (CAST(pred_pos AS DOUBLE) / n - CAST(rp AS DOUBLE) / rn) / se END AS zs FROM z2)
SELECT "attribute", "group", is_reference, n, threshold, approval_rate, air, round(zs, 4) AS z_stat,
       round({norm_cdf_sql('zs')}, 4) AS p_value FROM z3""")
def q_fairness_significance(spark, sf_dir):
    return FA.significance(FA.fairness_table(scored(spark, sf_dir), ATTRS, REFS, 0.5, detail=True))


def _smd_sql(src: str) -> str:
    long = " UNION ALL ".join(f"SELECT '{n}' AS attribute, CAST({c} AS VARCHAR) AS grp, y_prob FROM s" for n, c in ATTRS.items())
    rf = values(list(REFS.items()), ["attribute", "ref_group"])
    return f"""
WITH s AS ({src}), l AS ({long}),
st AS (SELECT attribute, grp, count(*) AS n, avg(y_prob) AS m, var_pop(y_prob) AS v FROM l WHERE grp IS NOT NULL GROUP BY ALL),
r AS (SELECT st.attribute, st.m AS rm, st.v AS rv FROM st JOIN {rf} rf ON st.attribute = rf.attribute AND st.grp = rf.ref_group)
SELECT st.attribute, st.grp AS "group", CAST(st.n AS BIGINT) AS n, round(st.m, 4) AS mean_score, round(st.m - r.rm, 4) AS me,
       round(CASE WHEN sqrt((r.rv + st.v) / 2.0::DOUBLE) <> 0 THEN (st.m - r.rm) / sqrt((r.rv + st.v) / 2.0::DOUBLE) END, 4) AS smd
FROM st LEFT JOIN r ON st.attribute = r.attribute WHERE st.n >= 30"""


@query("me_smd", _smd_sql(SQL_SCORED))
def q_me_smd(spark, sf_dir):
    return FA.score_gaps(scored(spark, sf_dir), ATTRS, REFS)


@query("fairness_me_smd", f"""
SELECT f.*, m.mean_score, m.me, m.smd FROM ({fairness_sql(SQL_SCORED, ATTRS, REFS, [0.5])}) f
LEFT JOIN ({_smd_sql(SQL_SCORED)}) m ON f.attribute = m.attribute AND f."group" = m."group" """)
def q_fairness_me_smd(spark, sf_dir):
    s = scored(spark, sf_dir)
    f = FA.fairness_table(s, ATTRS, REFS, 0.5)
    m = FA.score_gaps(s, ATTRS, REFS).drop("n")
    return f.join(m, ["attribute", "group"], "left")


_FT_RAW = f"""
WITH f AS ({_FT}), r AS (SELECT attribute, threshold, CAST(pred_pos AS DOUBLE) / n AS ref_raw FROM f WHERE is_reference)
SELECT f.*, r.ref_raw FROM f LEFT JOIN r ON f.attribute = r.attribute AND f.threshold = r.threshold"""


@query("air_violations", f"""
SELECT "attribute", "group", threshold, approval_rate, air, round(ref_raw, 4) AS reference_rate,
       round(ref_raw - CAST(pred_pos AS DOUBLE) / n, 4) AS gap FROM ({_FT_RAW}) x WHERE NOT is_reference AND air < 0.8""")
def q_air_violations(spark, sf_dir):
    return FA.air_violations(FA.fairness_table(scored(spark, sf_dir), ATTRS, REFS, 0.5, detail=True))


def _perf_sql(src: str, groups: list[str], t: float = 0.5, min_n: int = 30) -> str:
    gs = ", ".join(f"CAST({g} AS VARCHAR) AS {g}" for g in groups)
    return f"""
WITH c AS (SELECT {gs}, count(*) AS n, sum(y) AS pos, sum(CASE WHEN y_prob >= {dbl(t)} THEN 1 ELSE 0 END) AS pp,
                  sum(CASE WHEN y_prob >= {dbl(t)} THEN y ELSE 0 END) AS tp FROM ({src}) s GROUP BY ALL HAVING count(*) >= {min_n})
SELECT {', '.join(groups)}, CAST(n AS BIGINT) AS n, round(CAST(pos AS DOUBLE) / n, 4) AS actual_rate,
  round(CAST(pp AS DOUBLE) / n, 4) AS approval_rate, round(CAST(tp + (n - pos - (pp - tp)) AS DOUBLE) / n, 4) AS accuracy,
  round(CASE WHEN pp > 0 THEN CAST(tp AS DOUBLE) / pp ELSE 0.0::DOUBLE END, 4) AS "precision",
  round(CASE WHEN pos > 0 THEN CAST(tp AS DOUBLE) / pos ELSE 0.0::DOUBLE END, 4) AS recall,
  round(CASE WHEN 2 * tp + (pp - tp) + (pos - tp) > 0 THEN CAST(2 * tp AS DOUBLE) / (2 * tp + (pp - tp) + (pos - tp)) ELSE 0.0::DOUBLE END, 4) AS f1,
  round(CASE WHEN n - pos > 0 THEN CAST(pp - tp AS DOUBLE) / (n - pos) END, 4) AS fpr,
  round(CASE WHEN pos > 0 THEN CAST(pos - tp AS DOUBLE) / pos END, 4) AS fnr FROM c"""


@query("performance_by_group", f"""
SELECT 'Race' AS attribute, derived_race AS "group", * EXCLUDE (derived_race) FROM ({_perf_sql(SQL_SCORED, ['derived_race'])}) a
UNION ALL
SELECT 'Sex' AS attribute, derived_sex AS "group", * EXCLUDE (derived_sex) FROM ({_perf_sql(SQL_SCORED, ['derived_sex'])}) b""")
def q_performance_by_group(spark, sf_dir):
    s = scored(spark, sf_dir)
    out = None
    for name, col in [("Race", "derived_race"), ("Sex", "derived_sex")]:
        g = FA.group_performance(s, [col]).withColumnRenamed(col, "group")
        g = g.select(F.lit(name).alias("attribute"), *g.columns)
        out = g if out is None else out.unionByName(g)
    return out


_TIER_SQL = f"CASE WHEN y_prob < {dbl(0.4)} THEN 'Low' WHEN y_prob < {dbl(0.7)} THEN 'Medium' WHEN y_prob IS NOT NULL THEN 'High' END"


@query("risk_tiers", f"""
SELECT {_TIER_SQL} AS tier, CAST(count(*) AS BIGINT) AS n, round(avg(CAST(y AS DOUBLE)), 4) AS actual_rate,
       round(avg(y_prob), 4) AS mean_score FROM ({SQL_SCORED}) s GROUP BY 1""")
def q_risk_tiers(spark, sf_dir):
    s = scored(spark, sf_dir).withColumn("tier", FA.risk_tier())
    return s.groupBy("tier").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(F.col("y").cast("double")), 4).alias("actual_rate"),
                                 F.round(F.avg("y_prob"), 4).alias("mean_score"))


def _tier_sql():
    from auditlens.plans.q_metrics import eval_sql
    tier = _TIER_SQL.replace("y_prob", "y_prob_cont")
    return eval_sql(f"SELECT y, y_prob_cont AS y_prob, {tier} AS tier FROM ({SQL_SCORED}) s0", 0.5, ["tier"])


@query("performance_by_tier", _tier_sql())
def q_performance_by_tier(spark, sf_dir):
    s = scored(spark, sf_dir).withColumn("tier", FA.risk_tier("y_prob_cont")).withColumn("y_prob", F.col("y_prob_cont"))
    return evaluate(s, 0.5, keys=["tier"])


@query("disparate_impact", f"""
SELECT * FROM ({_perf_sql(f"SELECT *, {_TIER_SQL} AS tier FROM ({SQL_SCORED}) s0", ['derived_race', 'tier'])}) x""")
def q_disparate_impact(spark, sf_dir):
    s = scored(spark, sf_dir).withColumn("tier", FA.risk_tier())
    return FA.group_performance(s, ["derived_race", "tier"])


_TIERS = ["Low", "Medium", "High"]


@query("tier_error_pivot", f"""
WITH t AS ({_perf_sql(f"SELECT *, {_TIER_SQL} AS tier FROM ({SQL_SCORED}) s0", ['derived_race', 'tier'])})
SELECT derived_race, {', '.join(f"max(CASE WHEN tier = '{t}' THEN {v} END) AS {v}_{t}" for v in ('fpr', 'fnr') for t in _TIERS)} FROM t GROUP BY 1""")
def q_tier_error_pivot(spark, sf_dir):
    """FPR and FNR of every race by risk tier."""
    s = scored(spark, sf_dir).withColumn("tier", FA.risk_tier())
    return FA.wide(FA.group_performance(s, ["derived_race", "tier"]), "derived_race", "tier", ["fpr", "fnr"], _TIERS)


@query("intersectional_errors", f"SELECT * FROM ({_perf_sql(SQL_SCORED, ['derived_race', 'derived_sex'])}) x")
def q_intersectional_errors(spark, sf_dir):
    return FA.group_performance(scored(spark, sf_dir), ["derived_race", "derived_sex"])


@query("fairness_summary", f"""
WITH f AS ({_FT}), c AS ({_inter_sql(SQL_SCORED, "derived_race", "derived_sex", "AFRICA", "N", 0.5, 30)}),
l AS (SELECT arg_min(group_a || ' × ' || group_b, (air_vs_reference, group_a || ' × ' || group_b)) AS cell, min(air_vs_reference) AS air FROM c WHERE air_vs_reference IS NOT NULL)
SELECT attribute, threshold, CAST(count(*) AS BIGINT) AS n_groups,
       round(max(CAST(pred_pos AS DOUBLE) / n) - min(CAST(pred_pos AS DOUBLE) / n), 4) AS rate_gap,
       arg_min("group", (f.air, "group")) AS lowest_air_group, min(f.air) AS min_air,
       arg_max("group", (fnr, "group")) AS worst_fnr_group, max(fnr) AS max_fnr,
       CAST(sum(CASE WHEN f.air >= 0.8 THEN 1 ELSE 0 END) AS BIGINT) AS n_pass,
       CAST(sum(CASE WHEN f.air < 0.8 THEN 1 ELSE 0 END) AS BIGINT) AS n_fail, max(l.cell) AS lowest_cell, max(l.air) AS lowest_cell_air
FROM f, l GROUP BY attribute, threshold""")
def q_fairness_summary(spark, sf_dir):
    """I18 with the lowest race x sex cell."""
    s = materialize(scored(spark, sf_dir).select("y", "y_prob", *ATTRS.values()))
    cells = FA.intersectional_table(s, "derived_race", "derived_sex", "AFRICA", "N", 0.5)
    return FA.fairness_summary(FA.fairness_table(s, ATTRS, REFS, 0.5, detail=True)).crossJoin(F.broadcast(FA.lowest_cell(cells)))  # one row


SWEEP = [0.4, 0.35, 0.3, 0.25, 0.2]
_RACE = {"Race": "derived_race"}
_RACE_REF = {"Race": "AFRICA"}
_SWEEP_SQL = f"""
WITH f AS ({fairness_sql(SQL_SCORED, _RACE, _RACE_REF, SWEEP, detail=True)}),
r AS (SELECT threshold, CAST(pred_pos AS DOUBLE) / n AS ref FROM f WHERE is_reference),
a AS (SELECT f.attribute, f.threshold, sum(f.n) AS n, sum(f.pred_pos) AS pp, sum(f.tp) AS tp, min(f.air) AS min_air,
             max(r.ref) AS ref FROM f LEFT JOIN r ON f.threshold = r.threshold GROUP BY f.attribute, f.threshold)
SELECT attribute, threshold, round(CAST(pp AS DOUBLE) / n, 4) AS overall_approval_rate, round(ref, 4) AS reference_approval_rate,
       min_air, coalesce(min_air >= 0.8, false) AS passes_80_rule,
       round(CASE WHEN pp > 0 THEN CAST(pp - tp AS DOUBLE) / pp ELSE 0.0::DOUBLE END, 4) AS bad_rate_approved FROM a"""


@query("mitigation_sweep", _SWEEP_SQL)
def q_mitigation_sweep(spark, sf_dir):
    return FA.mitigation_sweep(scored(spark, sf_dir), _RACE, _RACE_REF, SWEEP)


@query("recommended_threshold", f"""
SELECT attribute, max(CASE WHEN passes_80_rule THEN threshold END) AS recommended_threshold, max(threshold) AS max_tested
FROM ({_SWEEP_SQL}) s GROUP BY attribute""")
def q_recommended_threshold(spark, sf_dir):
    return FA.recommended_threshold(FA.mitigation_sweep(scored(spark, sf_dir), _RACE, _RACE_REF, SWEEP))


_SPLIT_SRC = f"""SELECT *, CASE WHEN state_code IN ({', '.join(repr(s) for s in V.HOLDOUT_STATES)}) THEN 'geo_holdout' ELSE 'model' END AS split
FROM ({SQL_SCORED}) s0"""


@query("holdout_fairness", fairness_sql(_SPLIT_SRC, ATTRS, REFS, [0.5], keys=["split"]))
def q_holdout_fairness(spark, sf_dir):
    s = scored(spark, sf_dir).withColumn(
        "split", F.when(F.col("state_code").isin(*V.HOLDOUT_STATES), "geo_holdout").otherwise("model"))
    return FA.fairness_table(s, ATTRS, REFS, 0.5, keys=["split"])
