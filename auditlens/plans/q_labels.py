"""Families B (labels) and C (leakage, proxy risk)."""

from __future__ import annotations

from pyspark.sql import functions as F

from auditlens.operators import labels as LB
from auditlens.operators import leakage as LK
from auditlens.plans.common import SQL_APPS, applications, scored
from auditlens.plans.registry import query
from auditlens.plans.sqlgen import values
from auditlens.sources.views import sql_applications

KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
KS = ", ".join(KEYS)


@query("apply_label", f"""
SELECT {KS}, CAST(action_taken AS DOUBLE) AS action_taken,
       CAST(CASE WHEN action_taken IN (1, 2) THEN 1 WHEN action_taken = 3 THEN 0 END AS INTEGER) AS y
FROM ({SQL_APPS}) a WHERE action_taken IN (1, 2, 3)""")
def q_apply_label(spark, sf_dir):
    return LB.apply_label(applications(spark, sf_dir)).select(*KEYS, "action_taken", "y")


@query("label_log", f"""
WITH a AS (SELECT CASE WHEN action_taken IN (1, 2) THEN 1 WHEN action_taken = 3 THEN 0 END AS y FROM ({SQL_APPS}) a0),
c AS (SELECT count(*) AS raw, count(y) AS mappable, sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS positive FROM a)
SELECT CAST(raw AS BIGINT) AS raw_rows, CAST(mappable AS BIGINT) AS mappable_rows,
       CAST(raw - mappable AS BIGINT) AS dropped_rows, CAST(mappable AS BIGINT) AS final_rows,
       CAST(positive AS BIGINT) AS positive, CAST(mappable - positive AS BIGINT) AS negative,
       round(CAST(mappable AS DOUBLE) / raw, 4) AS mappable_share,
       round(CAST(positive AS DOUBLE) / mappable, 4) AS positive_share,
       round(CAST(mappable - positive AS DOUBLE) / mappable, 4) AS negative_share FROM c""")
def q_label_log(spark, sf_dir):
    return LB.label_log(applications(spark, sf_dir))


_MEANINGS = values([(float(k), v, LB.LABEL_MAP.get(k)) for k, v in LB.ACTION_TAKEN_MEANINGS.items()],
                   ["code", "meaning", "label_assigned"])


@query("label_distribution", f"""
WITH c AS (SELECT CAST(action_taken AS DOUBLE) AS code, count(*) AS cnt FROM ({SQL_APPS}) a GROUP BY 1),
m AS {_MEANINGS}
SELECT c.code AS action_taken, CAST(c.cnt AS BIGINT) AS "count", coalesce(m.meaning, 'Unknown') AS meaning,
       CAST(m.label_assigned AS INTEGER) AS label_assigned, c.code IN (1.0, 2.0, 3.0) AS retained,
       round(CAST(c.cnt AS DOUBLE) / sum(c.cnt) OVER (), 4) AS pct_of_total
FROM c LEFT JOIN m ON c.code = m.code""")
def q_label_distribution(spark, sf_dir):
    return LB.label_distribution(applications(spark, sf_dir))


@query("remove_leakage", f"SELECT * EXCLUDE (interest_rate, rate_spread, lei) FROM ({sql_applications(with_supplier=True)}) a")
def q_remove_leakage(spark, sf_dir):
    return LK.remove_leakage(applications(spark, sf_dir, with_supplier=True))


_PROXY = values([(i, f, r, j) for i, (f, r, j) in enumerate(LK.PROXY_RISK)],
                ["dict_order", "feature", "risk_level", "justification"])
_PRESENT = ["income", "applicant_age", "state_code", "county_code"]


@query("proxy_risk_dim", f"""
WITH a AS ({SQL_APPS}),
n AS ({' UNION ALL '.join(f"SELECT '{c}' AS feature, count({c}) AS n FROM a" for c in _PRESENT)})
SELECT d.feature, d.risk_level, d.justification, CAST(n.n AS BIGINT) AS n_nonnull
FROM {_PROXY} d LEFT JOIN n ON d.feature = n.feature""")
def q_proxy_risk_dim(spark, sf_dir):
    a = applications(spark, sf_dir)
    present = [f for f, _, _ in LK.PROXY_RISK if f in a.columns]
    arr = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).isNotNull().cast("long").alias("nn")) for c in present])
    n = a.select(F.explode(arr).alias("x")).groupBy("x.feature").agg(F.sum("x.nn").alias("n_nonnull"))
    d = LK.proxy_risk_table(spark)
    return d.join(n, "feature", "left").select("feature", "risk_level", "justification",
                                               F.col("n_nonnull").cast("long").alias("n_nonnull"))


_ONEHOT_COLS = ["loan_type", "state_code", "county_code"]


def feature_names(df):
    """Model-matrix style names: numeric names and col_level dummies."""
    arr = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in _ONEHOT_COLS])
    dummies = df.select(F.explode(arr).alias("x")).select(F.concat_ws("_", "x.c", "x.v").alias("feature"))
    nums = df.sparkSession.createDataFrame([("income",), ("loan_amount",), ("applicant_age",)], "feature STRING")
    return dummies.union(nums).distinct()


@query("proxy_annotate", f"""
WITH a AS ({SQL_APPS}),
f AS (SELECT DISTINCT feature FROM (
        {' UNION ALL '.join(f"SELECT '{c}' || '_' || CAST({c} AS VARCHAR) AS feature FROM a" for c in _ONEHOT_COLS)}
        UNION ALL SELECT 'income' UNION ALL SELECT 'loan_amount' UNION ALL SELECT 'applicant_age')),
d AS {_PROXY},
c AS (SELECT f.feature, d.risk_level, d.justification,
             row_number() OVER (PARTITION BY f.feature ORDER BY coalesce(f.feature = d.feature, false) DESC,
                                d.dict_order ASC NULLS LAST) AS rn
      FROM f LEFT JOIN d ON f.feature = d.feature OR starts_with(f.feature, d.feature))
SELECT feature, coalesce(risk_level, 'Low') AS proxy_risk_level, coalesce(justification, '') AS proxy_justification
FROM c WHERE rn = 1""")
def q_proxy_annotate(spark, sf_dir):
    names = feature_names(applications(spark, sf_dir))
    return LK.proxy_annotate(names, LK.proxy_risk_table(spark))
