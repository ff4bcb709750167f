"""Family H (performance metrics) and G4 (decision)."""

from __future__ import annotations

from pyspark.sql import functions as F

from auditlens.operators import metrics as M
from auditlens.operators.scorehist import pr_points, ranking_metrics, roc_points, round_cols, score_hist
from auditlens.plans.common import SQL_SCORED, scored
from auditlens.plans.registry import query
from auditlens.plans.sqlgen import dbl
from auditlens.sources.views import HOLDOUT_STATES

T = 0.5


def model_split_long(df):
    """Scored rows × the two closed-form models, with a hash split column."""
    key = F.concat_ws("|", *[F.col(c).cast("string") for c in
                             ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]])
    u = F.conv(F.substring(F.md5(F.concat(F.lit("42|"), key)), 1, 13), 16, 10).cast("double") / F.lit(float(2 ** 52))
    split = (F.when(F.col("state_code").isin(*HOLDOUT_STATES), F.lit("geo_holdout"))
             .when(u < 0.15, F.lit("test")).when(u < 0.30, F.lit("val")).otherwise(F.lit("train")))
    models = F.array(F.struct(F.lit("tiered").alias("model"), F.col("y_prob").alias("score")),
                     F.struct(F.lit("continuous").alias("model"), F.col("y_prob_cont").alias("score")))
    return (df.select("y", split.alias("split"), F.explode(models).alias("m"))
            .select("m.model", "split", "y", F.col("m.score").alias("y_prob")))


SQL_SPLIT_U = ("CAST(CAST(('0x' || substr(md5('42|' || concat_ws('|', CAST(l_orderkey AS VARCHAR), "
               "CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR))), 1, 13)) "
               f"AS BIGINT) AS DOUBLE) / {dbl(2 ** 52)}")
SQL_SPLIT = (f"CASE WHEN state_code IN ({', '.join(repr(s) for s in HOLDOUT_STATES)}) THEN 'geo_holdout' "
             f"WHEN {SQL_SPLIT_U} < {dbl(0.15)} THEN 'test' WHEN {SQL_SPLIT_U} < {dbl(0.30)} THEN 'val' ELSE 'train' END")
SQL_MODEL_LONG = f"""
SELECT 'tiered' AS model, {SQL_SPLIT} AS split, y, y_prob FROM ({SQL_SCORED}) s0
UNION ALL
SELECT 'continuous' AS model, {SQL_SPLIT} AS split, y, y_prob_cont AS y_prob FROM ({SQL_SCORED}) s1"""


def eval_sql(src: str, threshold: float, keys: list[str] = ()) -> str:
    k = list(keys)
    kc = "".join(f"{c}, " for c in k)
    part = f"PARTITION BY {', '.join(k)} " if k else ""
    return f"""
WITH s AS ({src}),
h AS (SELECT {kc}CAST(y_prob AS DOUBLE) AS score, count(*) AS n, sum(y) AS pos, count(*) - sum(y) AS neg,
        sum((y_prob - y) * (y_prob - y)) AS sse
      FROM s WHERE y_prob IS NOT NULL AND y IS NOT NULL GROUP BY ALL),
c AS (SELECT *, sum(pos) OVER ({part}ORDER BY score) AS cum_pos, sum(neg) OVER ({part}ORDER BY score) AS cum_neg,
        sum(pos) OVER ({part.strip()}) AS "P", sum(neg) OVER ({part.strip()}) AS "Nn" FROM h),
r AS (SELECT {kc}sum(n) AS n, max("P") AS "P", max("Nn") AS "Nn", sum(sse) AS sse,
        sum(pos * (cum_neg - neg + neg / 2.0::DOUBLE)) AS auc_s,
        sum(pos * (CAST("P" - cum_pos + pos AS DOUBLE) / ("P" - cum_pos + pos + "Nn" - cum_neg + neg))) AS ap_s,
        max(abs(CASE WHEN "P" > 0 THEN CAST(cum_pos AS DOUBLE) / "P" END - CASE WHEN "Nn" > 0 THEN CAST(cum_neg AS DOUBLE) / "Nn" END)) AS ks_s,
        sum(CASE WHEN score >= {dbl(threshold)} THEN pos ELSE 0 END) AS tp,
        sum(CASE WHEN score >= {dbl(threshold)} THEN neg ELSE 0 END) AS fp,
        sum(CASE WHEN score < {dbl(threshold)} THEN pos ELSE 0 END) AS fn,
        sum(CASE WHEN score < {dbl(threshold)} THEN neg ELSE 0 END) AS tn
      FROM c GROUP BY ALL)
SELECT {kc}{dbl(threshold)} AS threshold, CAST(n AS BIGINT) AS n,
  round(CASE WHEN "P" > 0 AND "Nn" > 0 THEN auc_s / (CAST("P" AS DOUBLE) * "Nn") END, 4) AS auc,
  round(CASE WHEN "P" > 0 THEN ap_s / "P" END, 4) AS pr_auc,
  round(sse / n, 4) AS brier,
  round(CASE WHEN "P" > 0 AND "Nn" > 0 THEN ks_s END, 4) AS ks,
  round(CAST(tp + tn AS DOUBLE) / n, 4) AS accuracy,
  round(CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0.0::DOUBLE END, 4) AS "precision",
  round(CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0.0::DOUBLE END, 4) AS recall,
  round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0::DOUBLE * tp / (2 * tp + fp + fn) ELSE 0.0::DOUBLE END, 4) AS f1,
  CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tn AS BIGINT) AS tn,
  round(CAST(tp + fp AS DOUBLE) / n, 4) AS positive_rate_predicted,
  round(CAST(tp + fn AS DOUBLE) / n, 4) AS positive_rate_actual
FROM r"""


EVAL_SQL = eval_sql(SQL_SCORED, T)


def _sub(cols):
    return f"SELECT {', '.join(chr(34) + c + chr(34) for c in cols)} FROM ({EVAL_SQL}) e"


@query("decide", f"""SELECT y_pred, CAST(count(*) AS BIGINT) AS n, CAST(sum(y) AS BIGINT) AS pos FROM (
  SELECT y, CAST(y_prob >= {dbl(T)} AS INTEGER) AS y_pred FROM ({SQL_SCORED}) s) GROUP BY y_pred""")
def q_decide(spark, sf_dir):
    d = M.decide(scored(spark, sf_dir), T)
    return d.groupBy("y_pred").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("y").cast("long")).alias("pos"))


@query("confusion", _sub(["threshold", "tp", "fp", "fn", "tn"]))
def q_confusion(spark, sf_dir):
    return M.confusion_counts(scored(spark, sf_dir), T).drop("n")


@query("classification_metrics", _sub(["threshold", "accuracy", "precision", "recall", "f1",
                                       "positive_rate_predicted", "positive_rate_actual"]))
def q_classification(spark, sf_dir):
    c = M.confusion_counts(scored(spark, sf_dir), T)
    return c.select("threshold", *[F.round(e, 4).alias(name) for name, e in M.classification_cols().items()])


def _rank(spark, sf_dir, col):
    r = ranking_metrics(score_hist(scored(spark, sf_dir)))
    return round_cols(r.select("n", col), [col])


@query("roc_auc", _sub(["n", "auc"]))
def q_roc_auc(spark, sf_dir):
    return _rank(spark, sf_dir, "auc")


@query("average_precision", _sub(["n", "pr_auc"]))
def q_ap(spark, sf_dir):
    return _rank(spark, sf_dir, "pr_auc")


@query("ks_stat", _sub(["n", "ks"]))
def q_ks(spark, sf_dir):
    return _rank(spark, sf_dir, "ks")


@query("brier", f"""SELECT CAST(count(*) AS BIGINT) AS n, round(avg((y_prob - y) * (y_prob - y)), 4) AS brier
FROM ({SQL_SCORED}) s""")
def q_brier(spark, sf_dir):
    s = scored(spark, sf_dir)
    return s.agg(F.count(F.lit(1)).alias("n"),
                 F.round(F.avg((F.col("y_prob") - F.col("y")) ** 2), 4).alias("brier"))


@query("evaluate_model", f"SELECT 'tiered' AS model, 'all' AS split, * FROM ({EVAL_SQL}) e")
def q_evaluate(spark, sf_dir):
    e = M.evaluate(scored(spark, sf_dir), T)
    return e.select(F.lit("tiered").alias("model"), F.lit("all").alias("split"), *e.columns)


@query("metrics_comparison", eval_sql(SQL_MODEL_LONG, T, ["model", "split"]))
def q_metrics_comparison(spark, sf_dir):
    return M.evaluate(model_split_long(scored(spark, sf_dir)), T, keys=["model", "split"])


def _curve_sql(kind: str) -> str:
    base = f"""
WITH h AS (SELECT CAST(y_prob AS DOUBLE) AS score, count(*) AS n, sum(y) AS pos, count(*) - sum(y) AS neg
           FROM ({SQL_SCORED}) s GROUP BY 1),
c AS (SELECT *, sum(pos) OVER (ORDER BY score) AS cum_pos, sum(neg) OVER (ORDER BY score) AS cum_neg,
        sum(pos) OVER () AS "P", sum(neg) OVER () AS "Nn" FROM h)"""
    if kind == "roc":
        return base + """,
pts AS (SELECT score AS threshold, CAST("Nn" - cum_neg + neg AS DOUBLE) / "Nn" AS fpr,
               CAST("P" - cum_pos + pos AS DOUBLE) / "P" AS tpr FROM c
        UNION ALL SELECT NULL, 0.0::DOUBLE, 0.0::DOUBLE),
seg AS (SELECT *, (fpr - lag(fpr) OVER (ORDER BY fpr, tpr)) * (tpr + lag(tpr) OVER (ORDER BY fpr, tpr)) / 2.0::DOUBLE AS s FROM pts)
SELECT threshold, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr, round(sum(s) OVER (), 6) AS roc_area FROM seg"""
    return base + """,
p0 AS (SELECT score AS threshold, CAST("P" - cum_pos + pos AS DOUBLE) / "P" AS recall,
              CAST("P" - cum_pos + pos AS DOUBLE) / ("P" - cum_pos + pos + "Nn" - cum_neg + neg) AS "precision",
              ("P" - cum_pos + pos) = "P" AS full_recall FROM c),
pts AS (SELECT threshold, recall, "precision" FROM p0
        WHERE threshold >= (SELECT max(threshold) FROM p0 WHERE full_recall)
        UNION ALL SELECT NULL, 0.0::DOUBLE, 1.0::DOUBLE),
seg AS (SELECT *, (recall - lag(recall) OVER (ORDER BY recall, "precision" DESC)) *
               ("precision" + lag("precision") OVER (ORDER BY recall, "precision" DESC)) / 2.0::DOUBLE AS s FROM pts)
SELECT threshold, round(recall, 6) AS recall, round("precision", 6) AS "precision", round(sum(s) OVER (), 6) AS pr_area FROM seg"""


@query("roc_curve", _curve_sql("roc"))
def q_roc_curve(spark, sf_dir):
    return round_cols(roc_points(score_hist(scored(spark, sf_dir))), ["fpr", "tpr", "roc_area"], 6)


@query("pr_curve", _curve_sql("pr"))
def q_pr_curve(spark, sf_dir):
    return round_cols(pr_points(score_hist(scored(spark, sf_dir))), ["recall", "precision", "pr_area"], 6)


def _grid_sql(select_expr: str) -> str:
    return f"""
WITH g AS (SELECT i, CASE WHEN i = 99 THEN {dbl(0.99)} ELSE {dbl(0.01)} + i * (({dbl(0.99)} - {dbl(0.01)}) / 99) END AS t
           FROM range(0, 100) r(i)),
s AS (SELECT y, y_prob FROM ({SQL_SCORED}) s0),
c AS (SELECT t, sum(CASE WHEN y_prob >= t AND y = 1 THEN 1 ELSE 0 END) AS tp,
             sum(CASE WHEN y_prob >= t AND y = 0 THEN 1 ELSE 0 END) AS fp,
             sum(CASE WHEN y_prob < t AND y = 1 THEN 1 ELSE 0 END) AS fn
      FROM g CROSS JOIN s GROUP BY t),
m AS (SELECT t, CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0.0::DOUBLE END AS prec,
             CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0.0::DOUBLE END AS rec,
             CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0::DOUBLE * tp / (2 * tp + fp + fn) ELSE 0.0::DOUBLE END AS f1 FROM c)
{select_expr}"""


@query("select_threshold_f1", _grid_sql(
    "SELECT 'f1' AS strategy, round(arg_min(t, (-f1, t)), 4) AS threshold FROM m"))
def q_thr_f1(spark, sf_dir):
    return M.select_threshold(scored(spark, sf_dir), "f1")


@query("select_threshold_balance", _grid_sql(
    "SELECT 'precision_recall_balance' AS strategy, round(arg_min(t, (abs(prec - rec), t)), 4) AS threshold FROM m"))
def q_thr_bal(spark, sf_dir):
    return M.select_threshold(scored(spark, sf_dir), "precision_recall_balance")


@query("select_threshold_rate", f"""
WITH s AS (SELECT y, y_prob FROM ({SQL_SCORED}) s0 WHERE y_prob IS NOT NULL),
r AS (SELECT (1.0::DOUBLE - avg(CAST(y AS DOUBLE))) * (count(*) - 1) AS pos FROM s),
o AS (SELECT y_prob, row_number() OVER (ORDER BY y_prob) - 1 AS rk FROM s)
SELECT 'approval_rate' AS strategy,
       round(lo.y_prob + (r.pos - floor(r.pos)) * (hi.y_prob - lo.y_prob), 4) AS threshold
FROM r JOIN o lo ON lo.rk = floor(r.pos) JOIN o hi ON hi.rk = ceil(r.pos)""")
def q_thr_rate(spark, sf_dir):
    return M.select_threshold(scored(spark, sf_dir), "approval_rate")
