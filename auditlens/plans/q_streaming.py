"""Family M: streaming monitors run with availableNow over landed events."""

from __future__ import annotations

from pyspark.sql import functions as F

from auditlens.functions.ordered import exact_quantiles
from auditlens.plans.common import tables
from auditlens.plans.registry import query
from auditlens.plans.sqlgen import dbl
from auditlens.sources import views as V
from auditlens.streaming import monitors as MS

REFERENCE = "view"
BASE_END = "2024-01-08 00:00:00"


def _stream(spark, sf_dir, name):
    return MS.scored_stream(spark, sf_dir, pattern="events.parquet"), MS.new_area(spark, name)


SQL_AIR = f"""
WITH e AS ({V.SQL_SCORED_EVENTS}),
c AS (SELECT date_trunc('day', ts) AS ws, "group", count(*) AS n, sum(CASE WHEN y_prob >= 0.5 THEN 1 ELSE 0 END) AS approved FROM e GROUP BY ALL),
r AS (SELECT ws, CAST(approved AS DOUBLE) / n AS ref FROM c WHERE "group" = '{REFERENCE}')
SELECT CAST(c.ws AS VARCHAR) AS window_start, CAST(c.ws + INTERVAL 1 DAY AS VARCHAR) AS window_end, c."group",
       CAST(n AS BIGINT) AS n, CAST(approved AS BIGINT) AS approved, round(CAST(approved AS DOUBLE) / n, 4) AS approval_rate,
       round(CASE WHEN c."group" = '{REFERENCE}' THEN 1.0::DOUBLE WHEN r.ref > 0 THEN (CAST(approved AS DOUBLE) / n) / r.ref END, 4) AS air
FROM c LEFT JOIN r ON c.ws = r.ws"""


@query("stream_air", SQL_AIR)
def q_stream_air(spark, sf_dir):
    s, area = _stream(spark, sf_dir, "air")
    return MS.window_air(s, area, REFERENCE)


@query("stream_volume", f"""
WITH e AS ({V.SQL_SCORED_EVENTS}),
w AS (SELECT time_bucket(INTERVAL 10 MINUTE, ts) - k * INTERVAL 10 MINUTE AS ws, user_id FROM e, range(0, 6) t(k))
SELECT CAST(ws AS VARCHAR) AS window_start, user_id, CAST(count(*) AS BIGINT) AS n FROM w GROUP BY ALL HAVING count(*) > 2""")
def q_stream_volume(spark, sf_dir):
    s, area = _stream(spark, sf_dir, "volume")
    return MS.volume_anomaly(s, area, 2)


def _psi_reference(spark, sf_dir):
    ev = V.scored_events(tables(spark, sf_dir)).where(F.col("ts") < V.ntz(BASE_END))
    q = exact_quantiles(ev, "y_prob", [i / 10 for i in range(11)]).collect()  # 11 numbers
    edges = sorted(set(r["q"] for r in q))
    from auditlens.functions.ordered import count_at_or_below
    last = edges[-1]
    b = F.when(F.col("y_prob") == last, len(edges) - 2).otherwise(count_at_or_below(F.col("y_prob"), edges) - 1)
    sh = ev.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("c")).collect()  # <= 10 bins
    n = sum(r["c"] for r in sh)
    expected = {i: 0.0 for i in range(len(edges) - 1)}
    for r in sh:
        expected[int(r["bin"])] = r["c"] / n
    return edges, expected


@query("stream_psi", f"""
WITH e AS ({V.SQL_SCORED_EVENTS}), b0 AS (SELECT * FROM e WHERE ts < TIMESTAMP '2024-01-08'),
ed AS (SELECT list_sort(list_distinct([{', '.join(f'quantile_cont(y_prob, {dbl(i / 10)})' for i in range(11))}])) AS edges FROM b0),
bins AS (SELECT unnest(range(0, len(edges) - 1)) AS bin FROM ed),
eb AS (SELECT CASE WHEN y_prob = edges[-1] THEN len(edges) - 2 ELSE len(list_filter(edges, lambda t: t <= y_prob)) - 1 END AS bin FROM b0, ed),
ex AS (SELECT bins.bin, CAST(count(eb.bin) AS DOUBLE) / (SELECT count(*) FROM b0) AS pe FROM bins LEFT JOIN eb ON bins.bin = eb.bin GROUP BY bins.bin),
a AS (SELECT date_trunc('day', ts) AS ws, CASE WHEN y_prob < edges[1] OR y_prob > edges[-1] THEN -1
        WHEN y_prob = edges[-1] THEN len(edges) - 2 ELSE len(list_filter(edges, lambda t: t <= y_prob)) - 1 END AS bin FROM e, ed),
tot AS (SELECT ws, count(*) AS t FROM a GROUP BY ws),
cnt AS (SELECT ws, bin, count(*) AS c FROM a GROUP BY ALL),
f AS (SELECT tot.ws, ex.bin, ex.pe, CAST(coalesce(cnt.c, 0) AS DOUBLE) / tot.t AS pa, tot.t FROM tot CROSS JOIN ex
      LEFT JOIN cnt ON cnt.ws = tot.ws AND cnt.bin = ex.bin),
g AS (SELECT ws, t, CASE WHEN pa = 0 THEN 0.0001::DOUBLE ELSE pa END AS pa, CASE WHEN pe = 0 THEN 0.0001::DOUBLE ELSE pe END AS pe FROM f)
SELECT CAST(ws AS VARCHAR) AS window_start, CAST(max(t) AS BIGINT) AS n, round(sum((pa - pe) * ln(pa / pe)), 4) AS psi FROM g GROUP BY ws""")
def q_stream_psi(spark, sf_dir):
    edges, expected = _psi_reference(spark, sf_dir)
    s, area = _stream(spark, sf_dir, "psi")
    return MS.window_psi(s, area, edges, expected)


@query("stream_breach", f"""
WITH a AS ({SQL_AIR}), b AS (SELECT "group", window_start, air, epoch(CAST(window_start AS TIMESTAMP)) // 86400 AS d FROM a),
s AS (SELECT *, sum(CASE WHEN air < 0.8 THEN 0 ELSE 1 END) OVER (PARTITION BY "group" ORDER BY d) AS brk,
             d - lag(d) OVER (PARTITION BY "group" ORDER BY d) AS gap FROM b),
t AS (SELECT *, sum(CASE WHEN gap IS NULL OR gap = 1 THEN 0 ELSE 1 END) OVER (PARTITION BY "group" ORDER BY d) AS gp FROM s),
u AS (SELECT *, row_number() OVER (PARTITION BY "group", brk, gp ORDER BY d) AS rl FROM t WHERE air < 0.8)
SELECT "group", window_start, air, CAST(rl AS INTEGER) AS run_length FROM u WHERE rl >= 2""")
def q_stream_breach(spark, sf_dir):
    s, area = _stream(spark, sf_dir, "breach")
    air = MS.window_air(s, area, REFERENCE).select("window_start", "group", "air")
    air_landing = f"{area}/air_landing"
    air.write.mode("append").parquet(air_landing)
    return MS.consecutive_breach_stream(spark, air_landing, f"{area}/breach", 0.80)


#: Every tenth event arrives six days late; five days of arrivals land together, as LAND_FILES files.
LAND_FILES = 4


@query("stream_late", """
WITH e AS (SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, date_trunc('day', CAST(ts AS TIMESTAMP)) AS ws,
                  (date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) + CASE WHEN event_id % 10 = 0 THEN 6 ELSE 0 END) // 5 AS batch FROM events),
b AS (SELECT batch, max(date_trunc('millisecond', ts)) AS latest FROM e GROUP BY batch),
m AS (SELECT batch, max(latest) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) - INTERVAL 2 DAY AS mark FROM b),
l AS (SELECT ws, coalesce(ws + INTERVAL 1 DAY <= m.mark, false) AS late FROM e JOIN m ON e.batch = m.batch)
SELECT CAST(ws AS VARCHAR) AS window_start, count(*) AS n_rows, CAST(sum(CASE WHEN late THEN 0 ELSE 1 END) AS BIGINT) AS n_counted,
       CAST(sum(CASE WHEN late THEN 1 ELSE 0 END) AS BIGINT) AS n_late FROM l GROUP BY ws""")
def q_stream_late(spark, sf_dir):
    """M5: events land in order of arrival, some behind the watermark."""
    area = MS.new_area(spark, "late")
    ev = tables(spark, sf_dir).events
    day = F.datediff(F.col("ts").cast("date"), F.lit("1970-01-01").cast("date"))
    arrival = F.floor((day + F.when(F.col("event_id") % 10 == 0, 6).otherwise(0)) / 5)
    ev = ev.withColumn("_arrival", arrival)
    for (k,) in sorted(ev.select("_arrival").distinct().collect()):  # one number per five days
        ev.where(F.col("_arrival") == k).drop("_arrival").repartition(LAND_FILES).write.mode("append").parquet(f"{area}/landing")
    return MS.late_rows(lambda: MS.scored_stream(spark, f"{area}/landing", max_files=LAND_FILES), area)
