"""Family N: survival."""

from __future__ import annotations

from pyspark.sql import functions as F

from auditlens.operators import survival as SU
from auditlens.operators.splits import KEY_COLS
from auditlens.plans.common import tables
from auditlens.plans.registry import query
from auditlens.sources import views as V

KS = ", ".join(KEY_COLS)
COLS = [*KEY_COLS, "start", "end", "event", "score_factor"]


def _iv(spark, sf_dir):
    return SU.interval_frame(V.survival(tables(spark, sf_dir)), COLS)


SQL_IV = f"""SELECT {KS}, start, "end", CAST(event AS DOUBLE) AS event, score_factor FROM ({V.SQL_SURVIVAL}) s
WHERE start IS NOT NULL AND "end" IS NOT NULL AND event IS NOT NULL AND score_factor IS NOT NULL AND "end" > start"""


@query("interval_frame", SQL_IV)
def q_interval_frame(spark, sf_dir):
    return _iv(spark, sf_dir)


SQL_KM = f"""SELECT {KS}, arg_min("end", "end") AS "end", arg_min(event, "end") AS event, arg_min(score_factor, "end") AS score_factor
FROM ({SQL_IV}) x GROUP BY ALL"""


@query("km_frame", SQL_KM)
def q_km_frame(spark, sf_dir):
    return SU.km_frame(_iv(spark, sf_dir), KEY_COLS)


SQL_CURVE = f"""
WITH k AS ({SQL_KM}),
p AS (SELECT score_factor AS grp, "end" AS time, sum(CASE WHEN event = 1 THEN 1 ELSE 0 END) AS d, count(*) AS x FROM k GROUP BY ALL),
c AS (SELECT *, sum(x) OVER (PARTITION BY grp) - sum(x) OVER (PARTITION BY grp ORDER BY time) + x AS n FROM p),
l AS (SELECT *, CASE WHEN CAST(d AS DOUBLE) / n < 1 THEN ln(1.0::DOUBLE - CAST(d AS DOUBLE) / n) ELSE 0.0::DOUBLE END AS lg,
             CASE WHEN CAST(d AS DOUBLE) / n >= 1 THEN 1 ELSE 0 END AS z,
             CASE WHEN n > d THEN CAST(d AS DOUBLE) / (CAST(n AS DOUBLE) * (n - d)) ELSE 0.0::DOUBLE END AS gw FROM c),
s AS (SELECT grp, time, n, d, x, sum(lg) OVER w AS slg, sum(z) OVER w AS sz, sum(gw) OVER w AS sgw FROM l
      WINDOW w AS (PARTITION BY grp ORDER BY time))
SELECT grp AS "group", time, CAST(n AS BIGINT) AS n_at_risk, CAST(d AS BIGINT) AS n_event, CAST(x - d AS BIGINT) AS n_censored,
       CASE WHEN sz > 0 THEN 0.0::DOUBLE ELSE exp(slg) END AS survival, sgw AS var_sum FROM s"""


@query("km_curve", f"SELECT * REPLACE (round(survival, 6) AS survival, round(var_sum, 9) AS var_sum) FROM ({SQL_CURVE}) c")
def q_km_curve(spark, sf_dir):
    c = SU.km_curve(SU.km_frame(_iv(spark, sf_dir), KEY_COLS))
    return c.withColumn("survival", F.round("survival", 6)).withColumn("var_sum", F.round("var_sum", 9))


@query("km_at_time", f"""
WITH k AS ({SQL_KM}), c AS ({SQL_CURVE}),
last AS (SELECT "group", arg_max(survival, time) AS s, arg_max(var_sum, time) AS v FROM c WHERE time <= 730 GROUP BY 1),
ci AS (SELECT *, CASE WHEN s > 0 AND s < 1 THEN exp(-exp(ln(-ln(s)) + {SU.Z975!r} * sqrt(v) / ln(s))) END AS lo,
                 CASE WHEN s > 0 AND s < 1 THEN exp(-exp(ln(-ln(s)) - {SU.Z975!r} * sqrt(v) / ln(s))) END AS hi FROM last),
cnt AS (SELECT score_factor AS "group", sum(CASE WHEN "end" >= 730 THEN 1 ELSE 0 END) AS n_risk,
               sum(CASE WHEN event = 1 AND "end" <= 730 THEN 1 ELSE 0 END) AS n_event,
               sum(CASE WHEN event <> 1 AND "end" <= 730 THEN 1 ELSE 0 END) AS n_censored, count(*) AS entered FROM k GROUP BY 1)
SELECT 730.0::DOUBLE AS time, cnt."group", CAST(n_risk AS BIGINT) AS n_risk, CAST(n_event AS BIGINT) AS n_event,
       CAST(n_censored AS BIGINT) AS n_censored, CAST(entered AS BIGINT) AS entered, round(ci.s, 6) AS survival,
       round((ci.hi - ci.lo) / {2 * 1.96!r}, 6) AS std_err, round(ci.lo, 6) AS lower_95, round(ci.hi, 6) AS upper_95
FROM cnt LEFT JOIN ci ON cnt."group" = ci."group" """)
def q_km_at_time(spark, sf_dir):
    return SU.km_at_time(SU.km_frame(_iv(spark, sf_dir), KEY_COLS), 730)
