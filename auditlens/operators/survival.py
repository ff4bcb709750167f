"""Family N: survival frames and Kaplan-Meier curves with Greenwood
log-log intervals, computed with distributed running totals per group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlens.functions.columns import rnd, to_double
from auditlens.functions.ordered import running_totals

Z975 = 1.959963984540054  # two-sided 95 % normal quantile


def interval_frame(df: DataFrame, cols: list[str]) -> DataFrame:
    """Numeric id/start/end/event, drop rows with nulls, keep end > start."""
    out = df.select(*cols)
    out = out.withColumns({c: to_double(c) for c in ("start", "end", "event") if c in cols})
    out = out.dropna()
    if {"start", "end"} <= set(cols):
        out = out.where(F.col("end") > F.col("start"))
    return out


def km_frame(df: DataFrame, id_cols: list[str], order_col: str = "end", extra: list[str] = ()) -> DataFrame:
    """One row per id (smallest ``order_col`` first) with numeric end and
    event, nulls dropped.  A min-aggregate per id, so no window or sort."""
    s = F.struct(F.col(order_col).alias("_o"), *[F.col(c) for c in ["end", "event", "score_factor", *extra]])
    one = df.groupBy(*id_cols).agg(F.min(s).alias("_s"))
    return (one.select(*id_cols, to_double("_s.end").alias("end"), to_double("_s.event").alias("event"),
                       F.col("_s.score_factor").alias("score_factor"), *[F.col(f"_s.{c}").alias(c) for c in extra])
            .dropna())


def km_events(df: DataFrame, group_col: str = "score_factor", time_col: str = "end", event_col: str = "event") -> DataFrame:
    """Events and exits per (group, time): the only pass over the rows,
    written once to the shared folder; curves and counts derive from it."""
    from auditlens.functions.ordered import materialize
    ev = (F.col(event_col) == 1).cast("long")
    per = (df.where(F.col(group_col).isNotNull()).groupBy(F.col(group_col).alias("group"), F.col(time_col).alias("time"))
           .agg(F.sum(ev).alias("n_event"), F.count(F.lit(1)).alias("n_exit")))
    return materialize(per)


def km_curve(df: DataFrame, group_col: str = "score_factor", time_col: str = "end", event_col: str = "event",
             per: DataFrame | None = None) -> DataFrame:
    """(group, time, n_at_risk, n_event, n_censored, survival, var_sum)
    at every distinct time.  survival = exp(Σ log(1 − d/n)) with a zero
    guard; var_sum = Σ d / (n (n − d)) (Greenwood)."""
    per = per if per is not None else km_events(df, group_col, time_col, event_col)
    g = "group"
    cum = running_totals(per, "time", ["n_exit"], [g], checkpoint=False, totals=["n_exit"])
    c = cum.withColumn("n_at_risk", F.col("all_n_exit") - F.col("cum_n_exit") + F.col("n_exit"))
    frac = F.col("n_event") / F.col("n_at_risk")
    c = (c.withColumn("_log", F.when(frac < 1, F.log(F.lit(1.0) - frac)).otherwise(F.lit(0.0)))
         .withColumn("_zero", (frac >= 1).cast("long"))
         .withColumn("_gw", F.when(F.col("n_at_risk") > F.col("n_event"),
                                   F.col("n_event") / (F.col("n_at_risk") * (F.col("n_at_risk") - F.col("n_event"))))
                     .otherwise(F.lit(0.0))))
    c2 = running_totals(c.select(g, "time", "n_at_risk", "n_event", "n_exit", "_log", "_zero", "_gw"), "time",
                        ["_log", "_zero", "_gw"], [g])
    surv = F.when(F.col("cum__zero") > 0, F.lit(0.0)).otherwise(F.exp("cum__log"))
    return c2.select(g, "time", F.col("n_at_risk").cast("long").alias("n_at_risk"),
                     F.col("n_event").cast("long").alias("n_event"),
                     (F.col("n_exit") - F.col("n_event")).cast("long").alias("n_censored"),
                     surv.alias("survival"), F.col("cum__gw").alias("var_sum"))


def km_at_time(df: DataFrame, t: float, group_col: str = "score_factor", time_col: str = "end",
               event_col: str = "event") -> DataFrame:
    """Survival at time t (last curve point at or before t), log-log 95 %
    interval, se = width / (2·1.96), and counts at risk / events / censored
    / entered — all from the per-(group, time) event table."""
    per = km_events(df, group_col, time_col, event_col)
    curve = km_curve(df, per=per).where(F.col("time") <= F.lit(float(t)))
    last = curve.groupBy("group").agg(F.max_by(F.struct("survival", "var_sum"), "time").alias("_l"))
    ls = F.log(F.col("_l.survival"))
    ok = (F.col("_l.survival") > 0) & (F.col("_l.survival") < 1)
    lower = F.when(ok, F.exp(-F.exp(F.log(-ls) + F.lit(Z975) * F.sqrt(F.col("_l.var_sum")) / ls)))
    upper = F.when(ok, F.exp(-F.exp(F.log(-ls) - F.lit(Z975) * F.sqrt(F.col("_l.var_sum")) / ls)))
    at_or_before = F.col("time") <= F.lit(float(t))
    counts = per.groupBy("group").agg(
        F.sum(F.when(F.col("time") >= F.lit(float(t)), F.col("n_exit")).otherwise(0)).alias("n_risk"),
        F.sum(F.when(at_or_before, F.col("n_event")).otherwise(0)).alias("n_event"),
        F.sum(F.when(at_or_before, F.col("n_exit") - F.col("n_event")).otherwise(0)).alias("n_censored"),
        F.sum("n_exit").alias("entered"))
    j = counts.join(last.select("group", F.col("_l.survival").alias("survival"), lower.alias("lower_95"),
                                upper.alias("upper_95")), "group", "left")
    return j.select(F.lit(float(t)).alias("time"), "group", *[F.col(c).cast("long").alias(c) for c in
                                                              ["n_risk", "n_event", "n_censored", "entered"]],
                    rnd("survival", 6).alias("survival"),
                    rnd((F.col("upper_95") - F.col("lower_95")) / F.lit(2 * 1.96), 6).alias("std_err"),
                    rnd("lower_95", 6).alias("lower_95"), rnd("upper_95", 6).alias("upper_95"))
