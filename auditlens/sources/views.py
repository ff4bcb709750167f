"""Fixture views binding the audit roles to the supplied tables.

Each view is built with the DataFrame API.  Dimension tables of fixed size
(``nation`` 25 rows, ``region`` 5 rows) are broadcast explicitly; joins with
tables that grow with the data (orders, customer, part, supplier) are left
to the optimizer and AQE, which switch to a broadcast only from runtime sizes.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlens.sources.tables import Tables

# Protected-attribute bindings and reference groups of the fixture.
ATTRIBUTES = {
    "Race": "derived_race",
    "Sex": "derived_sex",
    "Ethnicity": "derived_ethnicity",
    "Applicant Age": "applicant_age",
}
REFERENCE_GROUPS = {
    "Race": "AFRICA",
    "Sex": "N",
    "Ethnicity": "F",
    "Applicant Age": "3-MEDIUM",
}
HOLDOUT_STATES = ["NATION_3"]
PERIOD_START = _dt.datetime(1999, 1, 1)


def ntz(text: str):
    """A TIMESTAMP_NTZ literal (independent of the session time zone)."""
    return F.lit(text).cast("timestamp_ntz")


def month_of(col: str):
    """Month start as TIMESTAMP_NTZ (date_trunc returns a zoned timestamp)."""
    return F.date_trunc("month", F.col(col)).cast("timestamp_ntz")


def applications(t: Tables, with_part: bool = False, with_supplier: bool = False) -> DataFrame:
    """One row per line item with application-like columns (raw: all rows,
    ``action_taken`` codes 1..8)."""
    l = t.lineitem
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                        "o_orderdate", "o_orderpriority")
    c = t.customer.select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = F.broadcast(t.nation.select("n_nationkey", "n_name", "n_regionkey"))
    r = F.broadcast(t.region.select("r_regionkey", "r_name"))
    df = (l.join(o, l.l_orderkey == o.o_orderkey)
          .join(c, F.col("o_custkey") == F.col("c_custkey"))
          .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
          .join(r, F.col("n_regionkey") == F.col("r_regionkey")))
    extra = []
    if with_part:
        p = t.part.select("p_partkey", "p_brand")
        df = df.join(p, F.col("l_partkey") == F.col("p_partkey"), "left")
        extra.append(F.col("p_brand").alias("construction_method"))
    if with_supplier:
        s = t.supplier.select("s_suppkey", "s_name")
        df = df.join(s, F.col("l_suppkey") == F.col("s_suppkey"), "left")
        extra.append(F.col("s_name").alias("lei"))
    q = F.col("l_quantity")
    action = (F.when((F.col("o_orderstatus") == "P") & (F.col("l_linestatus") == "O"),
                     F.lit(4) + F.col("l_linenumber") % 5)
              .when((F.col("o_orderstatus") == "O") & (q <= 35), F.lit(3))
              .when(F.col("o_orderstatus") == "P", F.lit(2))
              .otherwise(F.lit(1))).cast("int")
    dti = (F.when(F.col("l_tax") == 0, F.lit("NA"))
           .when(q < 20, F.lit("<20%"))
           .when(q < 30, F.lit("20%-<30%"))
           .when(q < 36, F.lit("30%-<36%"))
           .when(q < 50, q.cast("int").cast("string"))
           .otherwise(F.lit("50%-<60%")))
    return df.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        action.alias("action_taken"),
        (q / F.lit(50.0) * (F.lit(1.0) - F.lit(0.05) * F.col("r_regionkey"))).alias("y_prob"),
        (F.col("l_extendedprice") / F.lit(105000.0)).alias("y_prob_cont"),
        F.col("r_name").alias("derived_race"),
        F.col("l_returnflag").alias("derived_sex"),
        F.col("l_linestatus").alias("derived_ethnicity"),
        F.col("o_orderpriority").alias("applicant_age"),
        F.col("n_name").alias("state_code"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("event_time"),  # wall-clock time, no session zone
        F.when(F.col("c_acctbal") < 0, F.lit("NA")).otherwise(F.col("c_acctbal").cast("string")).alias("income"),
        F.col("l_extendedprice").alias("loan_amount"),
        F.col("o_totalprice").alias("property_value"),
        (F.col("l_extendedprice") / F.col("o_totalprice") * F.lit(100.0)).alias("combined_loan_to_value_ratio"),
        dti.alias("debt_to_income_ratio"),
        F.col("c_mktsegment").alias("loan_type"),
        F.col("l_returnflag").alias("loan_purpose"),
        F.col("o_custkey").cast("string").alias("county_code"),
        F.col("l_discount").alias("interest_rate"),
        F.col("l_tax").alias("rate_spread"),
        F.col("l_suppkey").alias("channel"),
        *extra,
    )


def label_expr(action: str = "action_taken"):
    a = F.col(action)
    return F.when(a.isin(1, 2), F.lit(1)).when(a == 3, F.lit(0)).cast("int")


def scored(t: Tables, **kw) -> DataFrame:
    """Labelled applications (codes 1..3) with ``y`` and the closed-form scores."""
    df = applications(t, **kw)
    return df.where(F.col("action_taken").isin(1, 2, 3)).withColumn("y", label_expr())


def documents_scored(t: Tables) -> DataFrame:
    """labels ⋈ documents: small real groups (n < 20 / n < 30 rules)."""
    d = t.documents.select("doc_id", "lang", "source", "n_chars")
    lab = t.labels
    return (lab.join(d, "doc_id")
            .select("doc_id", F.col("quality").cast("int").alias("y"), "toxic", "lang", "source", "n_chars",
                    (F.col("n_chars") / (F.col("n_chars") + F.lit(2000.0))).alias("y_prob")))


def survival(t: Tables) -> DataFrame:
    l = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_returnflag")
    o = t.orders.select("o_orderkey", "o_orderdate", "o_orderpriority")
    return (l.join(o, l.l_orderkey == o.o_orderkey)
            .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                    F.lit(0.0).alias("start"),
                    F.datediff(F.col("l_shipdate").cast("date"), F.col("o_orderdate").cast("date"))
                    .cast("double").alias("end"),
                    (F.col("l_returnflag") == "R").cast("int").alias("event"),
                    F.col("o_orderpriority").alias("score_factor")))


def scored_events(t: Tables) -> DataFrame:
    e = t.events
    return e.select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id",
                    F.col("event_type").alias("group"),
                    (F.col("value") / (F.col("value") + F.lit(50.0))).alias("y_prob"))


# ---------------------------------------------------------------------------
# DuckDB text of the same views, used only by the SQL oracle.
# ---------------------------------------------------------------------------

def sql_applications(with_part: bool = False, with_supplier: bool = False) -> str:
    extra_cols = ""
    extra_joins = ""
    if with_part:
        extra_cols += ", p.p_brand AS construction_method"
        extra_joins += " LEFT JOIN part p ON l.l_partkey = p.p_partkey"
    if with_supplier:
        extra_cols += ", s.s_name AS lei"
        extra_joins += " LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey"
    return f"""
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
  CAST(CASE WHEN o.o_orderstatus = 'P' AND l.l_linestatus = 'O' THEN 4 + l.l_linenumber % 5
       WHEN o.o_orderstatus = 'O' AND l.l_quantity <= 35 THEN 3
       WHEN o.o_orderstatus = 'P' THEN 2 ELSE 1 END AS INTEGER) AS action_taken,
  l.l_quantity / CAST(50 AS DOUBLE) * (CAST(1 AS DOUBLE) - CAST(0.05 AS DOUBLE) * r.r_regionkey) AS y_prob,
  l.l_extendedprice / CAST(105000 AS DOUBLE) AS y_prob_cont,
  r.r_name AS derived_race, l.l_returnflag AS derived_sex, l.l_linestatus AS derived_ethnicity,
  o.o_orderpriority AS applicant_age, n.n_name AS state_code,
  CAST(l.l_shipdate AS TIMESTAMP) AS event_time,
  CASE WHEN c.c_acctbal < 0 THEN 'NA' ELSE CAST(c.c_acctbal AS VARCHAR) END AS income,
  l.l_extendedprice AS loan_amount, o.o_totalprice AS property_value,
  l.l_extendedprice / o.o_totalprice * CAST(100 AS DOUBLE) AS combined_loan_to_value_ratio,
  CASE WHEN l.l_tax = 0 THEN 'NA' WHEN l.l_quantity < 20 THEN '<20%'
       WHEN l.l_quantity < 30 THEN '20%-<30%' WHEN l.l_quantity < 36 THEN '30%-<36%'
       WHEN l.l_quantity < 50 THEN CAST(CAST(l.l_quantity AS INTEGER) AS VARCHAR)
       ELSE '50%-<60%' END AS debt_to_income_ratio,
  c.c_mktsegment AS loan_type, l.l_returnflag AS loan_purpose,
  CAST(o.o_custkey AS VARCHAR) AS county_code,
  l.l_discount AS interest_rate, l.l_tax AS rate_spread, l.l_suppkey AS channel{extra_cols}
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey{extra_joins}"""


def sql_scored(**kw) -> str:
    return f"""
SELECT *, CAST(CASE WHEN action_taken IN (1, 2) THEN 1 WHEN action_taken = 3 THEN 0 END AS INTEGER) AS y
FROM ({sql_applications(**kw)}) a WHERE action_taken IN (1, 2, 3)"""


SQL_DOCUMENTS_SCORED = """
SELECT lab.doc_id, CAST(lab.quality AS INTEGER) AS y, lab.toxic, d.lang, d.source, d.n_chars,
       d.n_chars / (d.n_chars + CAST(2000 AS DOUBLE)) AS y_prob
FROM labels lab JOIN documents d ON lab.doc_id = d.doc_id"""

SQL_SURVIVAL = """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, CAST(0 AS DOUBLE) AS start,
       CAST(date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) AS DOUBLE) AS "end",
       CAST(l.l_returnflag = 'R' AS INTEGER) AS event, o.o_orderpriority AS score_factor
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""

SQL_SCORED_EVENTS = """
SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, user_id, event_type AS "group",
       value / (value + CAST(50 AS DOUBLE)) AS y_prob
FROM events"""
