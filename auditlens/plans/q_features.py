"""Families D (features), E (profiling), F (splits) and A2 (sample)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from auditlens.functions.columns import rnd, to_double
from auditlens.functions.ordered import materialize
from auditlens.operators import audit as AU
from auditlens.operators import features as FE
from auditlens.operators import profiling as PR
from auditlens.operators import splits as SP
from auditlens.plans.common import SQL_APPS, SQL_SCORED, applications, scored
from auditlens.plans.registry import query
from auditlens.plans.sqlgen import dbl, values
from auditlens.session import scratch_path
from auditlens.sources.views import HOLDOUT_STATES, sql_scored

KEYS = SP.KEY_COLS
KS = ", ".join(KEYS)
AU_NOTES = list(AU.STEPS.values())
NUM_RE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def sql_num(c: str) -> str:
    return (f"(CASE WHEN regexp_full_match(trim(CAST({c} AS VARCHAR)), '{NUM_RE}') "
            f"THEN TRY_CAST(trim(CAST({c} AS VARCHAR)) AS DOUBLE) END)")


def sql_dti(c: str) -> str:
    m = " ".join(f"WHEN trim({c}) = '{k}' THEN {dbl(v)}" for k, v in FE.DTI_MIDPOINT_MAP.items() if v is not None)
    n = sql_num(c)
    return f"(CASE {m} WHEN {n} BETWEEN 36 AND 49 AND {n} = floor({n}) THEN {n} END)"


@query("clean_numeric", f"SELECT {KS}, {sql_num('income')} AS income FROM ({SQL_APPS}) a")
def q_clean_numeric(spark, sf_dir):
    return FE.clean_numeric(applications(spark, sf_dir), ["income"]).select(*KEYS, "income")


@query("encode_dti", f"SELECT {KS}, {sql_dti('debt_to_income_ratio')} AS debt_to_income_ratio FROM ({SQL_APPS}) a")
def q_encode_dti(spark, sf_dir):
    return FE.encode_dti(applications(spark, sf_dir)).select(*KEYS, "debt_to_income_ratio")


@query("clean_datetime", f"""
SELECT {KS}, CAST(TRY_CAST(CASE WHEN l_linenumber = 3 THEN 'unknown' ELSE CAST(event_time AS VARCHAR) END AS TIMESTAMP) AS VARCHAR) AS event_time FROM ({SQL_APPS}) a""")
def q_clean_datetime(spark, sf_dir):
    """Times landed as text, some of them no times."""
    a = applications(spark, sf_dir).select(*KEYS, F.when(F.col("l_linenumber") == 3, "unknown").otherwise(F.col("event_time").cast("string")).alias("event_time"))
    return FE.clean_datetime(a, ["event_time", "absent"]).withColumn("event_time", F.col("event_time").cast("string"))


CAPS = ["loan_amount", "income", "property_value", "combined_loan_to_value_ratio"]
NUMS = ["income", "debt_to_income_ratio", "combined_loan_to_value_ratio", "loan_amount", "property_value"]


def _numeric_frame(spark, sf_dir):
    a = scored(spark, sf_dir, with_part=True)
    return FE.clean_numeric(FE.encode_dti(a), ["income"])


SQL_NUMERIC = f"""SELECT * REPLACE ({sql_num('income')} AS income, {sql_dti('debt_to_income_ratio')} AS debt_to_income_ratio)
FROM ({sql_scored(with_part=True)}) s"""


def _long_sql(src: str, cols: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM {src}" for c in cols)


@query("cap_outliers", f"""
WITH s AS ({SQL_NUMERIC}), l AS ({_long_sql('s', CAPS)}),
q AS (SELECT feature, quantile_cont(value, 0.999) AS cap FROM l GROUP BY feature)
SELECT l.feature, round(q.cap, 6) AS cap, CAST(sum(CASE WHEN l.value >= q.cap THEN 1 ELSE 0 END) AS BIGINT) AS n_capped,
       round(avg(CASE WHEN l.value > q.cap THEN q.cap ELSE l.value END), 4) AS mean
FROM l JOIN q ON l.feature = q.feature GROUP BY l.feature, q.cap""")
def q_cap_outliers(spark, sf_dir):
    s = materialize(_numeric_frame(spark, sf_dir).select(*CAPS))
    caps = FE.column_quantiles(s, CAPS, 0.999)
    arr = F.array(*[F.struct(F.lit(c).alias("feature"), F.lit(caps[c]).alias("cap"), F.when(F.col(c) > caps[c], F.lit(caps[c])).otherwise(F.col(c)).alias("value")) for c in CAPS])
    long = s.select(F.explode(arr).alias("x")).select("x.*")
    return long.groupBy("feature", "cap").agg(
        F.sum((F.col("value") >= F.col("cap")).cast("long")).alias("n_capped"),
        F.round(F.avg("value"), 4).alias("mean")).select("feature", rnd("cap", 6).alias("cap"), "n_capped", "mean")


@query("impute_median", f"""
WITH s AS ({SQL_NUMERIC}), l AS ({_long_sql('s', ['income', 'debt_to_income_ratio'])}),
q AS (SELECT feature, quantile_cont(value, 0.5) AS med FROM l GROUP BY feature)
SELECT l.feature, round(q.med, 6) AS median, CAST(sum(CASE WHEN l.value IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_filled,
       round(avg(coalesce(l.value, q.med)), 4) AS mean
FROM l JOIN q ON l.feature = q.feature GROUP BY l.feature, q.med""")
def q_impute_median(spark, sf_dir):
    cols = ["income", "debt_to_income_ratio"]
    s = materialize(_numeric_frame(spark, sf_dir).select(*cols))
    meds = FE.column_quantiles(s, cols, 0.5)
    arr = F.array(*[F.struct(F.lit(c).alias("feature"), F.lit(meds[c]).alias("median"), F.col(c).alias("orig")) for c in cols])
    long = s.select(F.explode(arr).alias("x")).select("x.*")
    return long.groupBy("feature", "median").agg(
        F.sum(F.col("orig").isNull().cast("long")).alias("n_filled"),
        F.round(F.avg(F.coalesce("orig", "median")), 4).alias("mean")).select("feature", rnd("median", 6).alias("median"), "n_filled", "mean")


@query("rare_bucket", f"""
WITH s AS ({SQL_SCORED}), c AS (SELECT coalesce(county_code, 'Missing') AS lv, count(*) OVER (PARTITION BY coalesce(county_code, 'Missing')) AS n FROM s)
SELECT CASE WHEN n < 50 THEN 'Other' ELSE lv END AS county_code, CAST(count(*) AS BIGINT) AS n FROM c GROUP BY 1""")
def q_rare_bucket(spark, sf_dir):
    b = FE.rare_bucket(scored(spark, sf_dir), "county_code", 50)
    return b.groupBy("county_code").agg(F.count(F.lit(1)).alias("n"))


@query("one_hot", f"""
WITH s AS ({SQL_SCORED}), lv AS (SELECT DISTINCT loan_type FROM s WHERE loan_type IS NOT NULL),
keep AS (SELECT loan_type FROM lv WHERE loan_type > (SELECT min(loan_type) FROM lv))
SELECT 'loan_type_' || keep.loan_type AS feature, CAST(count(s.loan_type) AS BIGINT) AS total
FROM keep LEFT JOIN s ON s.loan_type = keep.loan_type GROUP BY 1""")
def q_one_hot(spark, sf_dir):
    s = scored(spark, sf_dir)
    oh = FE.one_hot(s.select("loan_type"), "loan_type", FE.few_levels(s, "loan_type"))
    arr = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("long").alias("v")) for c in oh.columns])
    return oh.select(F.explode(arr).alias("x")).groupBy("x.feature").agg(F.sum("x.v").alias("total"))


FM_CATS = ["loan_type", "loan_purpose", "construction_method", "state_code", "county_code"]


def _fm_sql() -> str:
    num_long = _long_sql("s", NUMS)
    cats = " UNION ALL ".join(f"SELECT '{c}' AS c, coalesce(CAST({c} AS VARCHAR), 'Missing') AS v FROM s" for c in FM_CATS)
    return f"""
WITH s AS ({SQL_NUMERIC}),
cl AS ({_long_sql('s', CAPS)}), caps AS (SELECT feature, quantile_cont(value, 0.999) AS cap FROM cl GROUP BY feature),
nl AS (SELECT l.feature, CASE WHEN l.value > caps.cap THEN caps.cap ELSE l.value END AS value
       FROM ({num_long}) l LEFT JOIN caps ON l.feature = caps.feature),
med AS (SELECT feature, quantile_cont(value, 0.5) AS m FROM nl GROUP BY feature),
numres AS (SELECT nl.feature, round(avg(coalesce(nl.value, med.m)), 4) AS mean, CAST(count(*) AS BIGINT) AS n
           FROM nl JOIN med ON nl.feature = med.feature GROUP BY nl.feature),
cv AS ({cats}),
cnt AS (SELECT c, v, count(*) AS k FROM cv GROUP BY c, v),
b AS (SELECT cv.c, CASE WHEN cnt.k < 50 THEN 'Other' ELSE cv.v END AS v FROM cv JOIN cnt ON cv.c = cnt.c AND cv.v = cnt.v),
lv AS (SELECT DISTINCT c, v FROM b),
keep AS (SELECT c, v FROM (SELECT c, v, row_number() OVER (PARTITION BY c ORDER BY v) AS rn FROM lv) WHERE rn > 1),
catres AS (SELECT keep.c || '_' || keep.v AS feature, round(CAST(count(b.v) AS DOUBLE) / (SELECT count(*) FROM s), 4) AS mean,
                  CAST((SELECT count(*) FROM s) AS BIGINT) AS n
           FROM keep LEFT JOIN b ON b.c = keep.c AND b.v = keep.v GROUP BY 1)
SELECT * FROM numres UNION ALL SELECT * FROM catres"""


@query("feature_matrix", _fm_sql())
def q_feature_matrix(spark, sf_dir):
    """Mean of every entry of the sparse vectors (a share for indicators)."""
    s = materialize(scored(spark, sf_dir, with_part=True).select(*NUMS, *FM_CATS))
    spec = FE.FeatureSpec.fit(s, FM_CATS, NUMS)
    entries = F.arrays_zip(F.col("indices").alias("place"), F.col("values").alias("value"))
    row = F.array(F.struct(F.lit(-1).alias("place"), F.lit(1.0).alias("value")))  # counts the rows
    sums = materialize(spec.transform(s).select(F.explode(F.concat(entries, row)).alias("x")).groupBy("x.place").agg(F.sum("x.value").alias("total")))
    n = sums.where("place = -1").select(F.col("total").cast("long").alias("n"))
    return sums.join(spec.names(), "place").crossJoin(F.broadcast(n)).select("feature", F.round(F.col("total") / F.col("n"), 4).alias("mean"), "n")


@query("standardize", f"""
WITH s AS ({SQL_SCORED}), st AS (SELECT avg(loan_amount) AS m, stddev_pop(loan_amount) AS sd FROM s)
SELECT {KS}, round((loan_amount - m) / sd, 6) AS loan_amount FROM s, st""")
def q_standardize(spark, sf_dir):
    z = FE.standardize(scored(spark, sf_dir).select(*KEYS, "loan_amount"), ["loan_amount"])
    return z.select(*KEYS, rnd("loan_amount", 6).alias("loan_amount"))


_MODE_COLS = ["loan_type", "loan_purpose", "state_code", "derived_race", "derived_sex", "derived_ethnicity", "applicant_age", "debt_to_income_ratio"]
#: Every ninth order lacks its categories, so that there is something to fill.
_HOLES = "l_orderkey % 9 = 0"


@query("impute_mode", f"""
WITH s AS (SELECT {', '.join(f"CASE WHEN {_HOLES} THEN NULL ELSE {c} END AS {c}" for c in _MODE_COLS)} FROM ({SQL_SCORED}) x),
l AS ({' UNION ALL '.join(f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS level FROM s" for c in _MODE_COLS)}),
c AS (SELECT feature, level, count(*) AS n FROM l WHERE level IS NOT NULL GROUP BY ALL),
m AS (SELECT feature, arg_min(level, (-n, level)) AS mode FROM c GROUP BY feature)
SELECT l.feature, coalesce(l.level, m.mode) AS level, CAST(count(*) AS BIGINT) AS n, CAST(count(*) - count(l.level) AS BIGINT) AS n_filled
FROM l JOIN m ON l.feature = m.feature GROUP BY 1, 2""")
def q_impute_mode(spark, sf_dir):
    """Levels of every category after filling nulls with the mode."""
    s = scored(spark, sf_dir).select(*[F.when(~F.expr(_HOLES), F.col(c)).alias(c) for c in _MODE_COLS])
    s = materialize(s)
    marked = s.select(*_MODE_COLS, *[F.col(c).isNull().alias(f"_null_{c}") for c in _MODE_COLS])
    filled = FE.impute_mode(marked, _MODE_COLS)
    arr = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("level"), F.col(f"_null_{c}").alias("was")) for c in _MODE_COLS])
    return filled.select(F.explode(arr).alias("x")).groupBy("x.feature", "x.level").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("x.was").cast("long")).alias("n_filled"))




@query("intersection_col", f"""
SELECT derived_race || ' × ' || derived_sex AS intersection, CAST(count(*) AS BIGINT) AS n FROM ({SQL_SCORED}) s GROUP BY 1""")
def q_intersection(spark, sf_dir):
    d = PR.intersection_col(scored(spark, sf_dir), "derived_race", "derived_sex")
    return d.groupBy("intersection").agg(F.count(F.lit(1)).alias("n"))


@query("label_encode", f"""
WITH s AS ({SQL_SCORED}), lv AS (SELECT DISTINCT applicant_age AS lv FROM s WHERE applicant_age IS NOT NULL)
SELECT s.applicant_age, CAST(dense_rank() OVER (ORDER BY lv.lv) - 1 AS INTEGER) AS applicant_age_code, CAST(count(*) AS BIGINT) AS n
FROM s JOIN lv ON s.applicant_age = lv.lv GROUP BY s.applicant_age, lv.lv""")
def q_label_encode(spark, sf_dir):
    e = FE.label_encode(scored(spark, sf_dir), "applicant_age")
    return e.groupBy("applicant_age", "applicant_age_code").agg(F.count(F.lit(1)).alias("n"))


ATTR_COLS = ["derived_race", "derived_sex", "derived_ethnicity", "applicant_age"]


@query("value_counts", f"""
WITH s AS ({SQL_SCORED}),
l AS ({' UNION ALL '.join(f"SELECT '{c}' AS attribute, CAST({c} AS VARCHAR) AS value FROM s" for c in ATTR_COLS)}),
c AS (SELECT attribute, value, count(*) AS n FROM l GROUP BY ALL)
SELECT attribute, value, CAST(n AS BIGINT) AS n, round(CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY attribute), 4) AS share,
       n < 200 AS small_sample FROM c""")
def q_value_counts(spark, sf_dir):
    return PR.value_counts(scored(spark, sf_dir), ATTR_COLS)


#: Columns of the labelled view and their types.
VIEW = {"l_orderkey": "bigint", "l_linenumber": "int", "l_partkey": "bigint", "l_suppkey": "bigint", "action_taken": "int", "y_prob": "double", "y_prob_cont": "double",
        "derived_race": "string", "derived_sex": "string", "derived_ethnicity": "string", "applicant_age": "string", "state_code": "string", "event_time": "timestamp_ntz",
        "income": "string", "loan_amount": "double", "property_value": "double", "combined_loan_to_value_ratio": "double", "debt_to_income_ratio": "string", "loan_type": "string",
        "loan_purpose": "string", "county_code": "string", "interest_rate": "double", "rate_spread": "double", "channel": "bigint", "y": "int"}
VIEW_NUMBERS = [c for c, t in VIEW.items() if t in ("bigint", "int", "double")]


def sql_text(c: str, kind: str) -> str:
    """DuckDB text of a value, as ``canonical_text`` writes it."""
    return {"double": f"CAST(CAST({c} AS DECIMAL(30, 6)) AS VARCHAR)", "timestamp_ntz": f"CAST(epoch_us({c}) AS VARCHAR)"}.get(kind, f"CAST({c} AS VARCHAR)")


@query("column_summary", f"""
WITH s AS ({SQL_SCORED}), l AS ({_long_sql('s', VIEW_NUMBERS)}),
t AS ({' UNION ALL '.join(f"SELECT '{c}' AS feature, '{k}' AS dtype, {sql_text(c, k)} AS text FROM s" for c, k in VIEW.items())}),
v AS (SELECT feature, dtype, text, count(*) AS n FROM t WHERE text IS NOT NULL GROUP BY ALL),
u AS (SELECT feature, dtype, sum(n) AS n, count(*) AS d, arg_min(text, (-n, text)) AS top, max(n) AS freq FROM v GROUP BY ALL),
b AS (SELECT feature, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS mn, quantile_cont(value, 0.25) AS q25, quantile_cont(value, 0.5) AS q50,
             quantile_cont(value, 0.75) AS q75, max(value) AS mx FROM l GROUP BY feature)
SELECT u.feature, dtype, CAST(n AS BIGINT) AS "count", CAST(d AS BIGINT) AS "unique", true AS unique_exact, top, CAST(freq AS BIGINT) AS freq, true AS top_exact, round(mean, 6) AS mean, round(std, 6) AS std,
       round(mn, 6) AS min, round(q25, 6) AS q25, round(q50, 6) AS q50, round(q75, 6) AS q75, round(mx, 6) AS max
FROM u LEFT JOIN b ON u.feature = b.feature""")
def q_column_summary(spark, sf_dir):
    """E2 over all columns of the labelled view."""
    return PR.column_summary(materialize(scored(spark, sf_dir).select(*VIEW)))


@query("feature_types", f"""
{' UNION ALL '.join(f"SELECT '{c}' AS feature, '{'numeric' if c in VIEW_NUMBERS else 'categorical'}' AS kind, CAST(count({c}) AS BIGINT) AS n FROM ({SQL_SCORED}) s" for c in VIEW)}""")
def q_feature_types(spark, sf_dir):
    """Every column's side by its type, with its number of values."""
    s = scored(spark, sf_dir).select(*VIEW)
    numeric, categorical = FE.infer_feature_types(s)
    arr = F.array(*[F.struct(F.lit(c).alias("feature"), F.lit("numeric" if c in numeric else "categorical").alias("kind"), F.col(c).isNotNull().cast("long").alias("v")) for c in numeric + categorical])
    return s.select(F.explode(arr).alias("x")).groupBy("x.feature", "x.kind").agg(F.sum("x.v").alias("n"))


@query("data_dictionary", f"""
WITH s AS ({SQL_SCORED})
{' UNION ALL '.join(f"SELECT '{c}' AS feature, '{k}' AS dtype, CAST(count(*) - count({c}) AS BIGINT) AS n_missing, "
                    f"{f'round(avg(CAST({c} AS DOUBLE)), 4)' if c in VIEW_NUMBERS else 'CAST(NULL AS DOUBLE)'} AS mean FROM s" for c, k in VIEW.items())}
{' '.join(f"UNION ALL SELECT '{c}' AS feature, 'double' AS dtype, CAST(count(*) - count({e}) AS BIGINT) AS n_missing, round(avg({e}), 4) AS mean FROM s"
          for c, e in (('income', sql_num('income')), ('debt_to_income_ratio', sql_dti('debt_to_income_ratio'))))}""")
def q_data_dictionary(spark, sf_dir):
    """E3 over all columns of the labelled view, and over the numbers that are
    cleaned from its text."""
    return PR.data_dictionary(scored(spark, sf_dir).select(*VIEW), as_numbers=("income", "debt_to_income_ratio"))


SQL_HSPLIT_U = ("CAST(CAST(('0x' || substr(md5('42|' || concat_ws('|', CAST(l_orderkey AS VARCHAR), "
                "CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR))), 1, 13)) "
                f"AS BIGINT) AS DOUBLE) / {dbl(2 ** 52)}")
_HOLD = ", ".join(f"'{s}'" for s in HOLDOUT_STATES)


@query("pipeline_audit", f"""
WITH a AS (SELECT *, CASE WHEN action_taken IN (1, 2) THEN 1 WHEN action_taken = 3 THEN 0 END AS y,
                  state_code IN ({_HOLD}) AS hold, {SQL_HSPLIT_U} AS u FROM ({SQL_APPS}) a0),
r AS (SELECT y, row_number() OVER (PARTITION BY y ORDER BY u, {KS}) AS rk, count(*) OVER (PARTITION BY y) AS n FROM a WHERE y IS NOT NULL AND NOT hold),
q AS (SELECT *, ceil({dbl(0.15)} * n) AS qt FROM r),
q2 AS (SELECT *, ceil({dbl(0.15 / 0.85)} * (n - qt)) AS qv FROM q),
st AS (
  SELECT 1 AS step_no, 'raw' AS step, count(*) AS n, NULL::DOUBLE AS pr FROM a
  UNION ALL SELECT 2, 'labelled', count(y), avg(y) FROM a
  UNION ALL SELECT 3, 'leakage_removed', count(y), avg(y) FROM a
  UNION ALL SELECT 4, 'geo_holdout', count(y), avg(y) FROM a WHERE hold
  UNION ALL SELECT 5, 'model_pool', count(y), avg(y) FROM a WHERE NOT hold
  UNION ALL SELECT 6, 'test', count(y), avg(y) FROM q2 WHERE rk <= qt
  UNION ALL SELECT 7, 'val', count(y), avg(y) FROM q2 WHERE rk > qt AND rk <= qt + qv
  UNION ALL SELECT 8, 'train', count(y), avg(y) FROM q2 WHERE rk > qt + qv)
SELECT CAST(step_no AS INTEGER) AS step_no, step, CAST(n AS BIGINT) AS "rows", round(pr, 4) AS positive_rate, CAST(w.n_columns AS INTEGER) AS n_columns, w.note
FROM st JOIN {values([(i + 1, n, t) for i, (n, t) in enumerate(zip([24, 25, 23, 24, 24, 24, 24, 24], AU_NOTES, strict=True))], ['i', 'n_columns', 'note'])} w ON w.i = st.step_no""")
def q_pipeline_audit(spark, sf_dir):
    """The real steps run once into the split export; their counts ride on
    that job."""
    return AU.audited_export(applications(spark, sf_dir), scratch_path(spark, f"audited-{uuid.uuid4().hex}"), KEYS, HOLDOUT_STATES)


@query("cell_counts", f"""
SELECT CAST(derived_race AS VARCHAR) AS group_a, CAST(derived_sex AS VARCHAR) AS group_b, CAST(count(*) AS BIGINT) AS n,
       count(*) >= 30 AS reportable FROM ({SQL_SCORED}) s GROUP BY 1, 2""")
def q_cell_counts(spark, sf_dir):
    return PR.cell_counts(scored(spark, sf_dir), "derived_race", "derived_sex")


@query("geo_holdout", f"""
SELECT CASE WHEN state_code IN ({_HOLD}) THEN 'geo_holdout' ELSE 'model' END AS split, y, CAST(count(*) AS BIGINT) AS n
FROM ({SQL_SCORED}) s GROUP BY 1, 2""")
def q_geo_holdout(spark, sf_dir):
    g = SP.geo_holdout(scored(spark, sf_dir), HOLDOUT_STATES)
    return g.groupBy("split", "y").agg(F.count(F.lit(1)).alias("n"))


@query("stratified_split", f"""
WITH s AS (SELECT *, {SQL_HSPLIT_U} AS u FROM ({SQL_SCORED}) s0 WHERE state_code NOT IN ({_HOLD})),
r AS (SELECT y, row_number() OVER (PARTITION BY y ORDER BY u, {KS}) AS rk, count(*) OVER (PARTITION BY y) AS n FROM s),
q AS (SELECT *, ceil({dbl(0.15)} * n) AS qt FROM r),
q2 AS (SELECT *, ceil({dbl(0.15 / 0.85)} * (n - qt)) AS qv FROM q)
SELECT CASE WHEN rk <= qt THEN 'test' WHEN rk <= qt + qv THEN 'val' ELSE 'train' END AS split, y, CAST(count(*) AS BIGINT) AS n
FROM q2 GROUP BY 1, 2""")
def q_stratified_split(spark, sf_dir):
    s = scored(spark, sf_dir).where(~F.col("state_code").isin(*HOLDOUT_STATES))
    sp = SP.stratified_split(s, "y", KEYS)
    return sp.groupBy("split", "y").agg(F.count(F.lit(1)).alias("n"))


@query("split_check", f"""
WITH s AS (SELECT y, {SQL_HSPLIT_U} AS u FROM ({SQL_SCORED}) s0 WHERE state_code NOT IN ({_HOLD}))
SELECT CASE WHEN u < {dbl(0.15)} THEN 'test' WHEN u < {dbl(0.30)} THEN 'val' ELSE 'train' END AS split,
       CAST(count(*) AS BIGINT) AS n, round(avg(CAST(y AS DOUBLE)), 4) AS positive_rate FROM s GROUP BY 1""")
def q_split_check(spark, sf_dir):
    s = scored(spark, sf_dir).where(~F.col("state_code").isin(*HOLDOUT_STATES))
    return SP.split_check(SP.hash_split(s, KEYS))


@query("dev_sample", f"""
WITH s AS (SELECT y, {SQL_HSPLIT_U} AS u FROM ({SQL_SCORED}) s0)
SELECT CAST(count(*) AS BIGINT) AS n, round(avg(CAST(y AS DOUBLE)), 4) AS positive_rate FROM s WHERE u < {dbl(0.1)}""")
def q_dev_sample(spark, sf_dir):
    d = SP.dev_sample(scored(spark, sf_dir), 0.1, KEYS)
    return d.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(F.col("y").cast("double")), 4).alias("positive_rate"))
