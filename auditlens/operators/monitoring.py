"""Family L: review triggers, scorecard and monitoring rules over periods."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from auditlens.functions.columns import rnd, safe_div, when_chain
from auditlens.functions.ordered import exact_quantiles, materialize, running_totals

# The review-trigger playbook.  direction 'high' = higher is
# better (red below red_limit, yellow below yellow_limit); 'low' = lower is
# better (red above red_limit, yellow from yellow_limit); use_abs compares |v|.
# The actions are this library's own wording; callers may pass rules of theirs.
TRIGGER_LIMITS = [
    ("AUC (overall)", "Monthly", ">= 0.72", "0.68 – 0.72", "< 0.68", "high", False, 0.68, 0.72, "ML Engineer"),
    ("AIR — Black applicants", "Monthly", ">= 0.80", "0.70 – 0.80", "< 0.70", "high", False, 0.70, 0.80, "Fairness Officer"),
    ("AIR — Hispanic or Latino applicants", "Monthly", ">= 0.80", "0.70 – 0.80", "< 0.70", "high", False, 0.70, 0.80, "Fairness Officer"),
    ("AIR — Female applicants", "Monthly", ">= 0.80", "0.70 – 0.80", "< 0.70", "high", False, 0.70, 0.80, "Fairness Officer"),
    ("AIR — Applicant sex", "Monthly", ">= 0.80", "0.70 – 0.80", "< 0.70", "high", False, 0.70, 0.80, "Fairness Officer"),
    ("AIR — Applicant age", "Monthly", ">= 0.80", "0.70 – 0.80", "< 0.70", "high", False, 0.70, 0.80, "Fairness Officer"),
    ("PSI — loan_amount", "Quarterly", "< 0.10", "0.10 – 0.25", "> 0.25", "low", False, 0.25, 0.10, "Data Owner"),
    ("PSI — income", "Quarterly", "< 0.10", "0.10 – 0.25", "> 0.25", "low", False, 0.25, 0.10, "Data Owner"),
    ("Subgroup ECE gap (max across race groups)", "Quarterly", "< 0.05", "0.05 – 0.10", "> 0.10", "low", False, 0.10, 0.05, "Fairness Officer"),
    ("Approval rate change vs. baseline (absolute)", "Monthly", "+/- 5%", "+/- 5-10%", "+/- > 10%", "low", True, 0.10, 0.05, "Compliance"),
]


def _actions(metric: str) -> tuple[str, str]:
    """(yellow, red) action of a metric."""
    kind = metric.split(" ")[0]
    return {
        "AUC": ("compare feature distributions with training", "stop serving and plan a new fit"),
        "AIR": ("find where the groups part and tell compliance", "stop serving and audit again"),
        "PSI": ("look at the feature's distribution and its source", "review the feature and a new fit"),
        "Subgroup": ("look at calibration by group", "calibrate again before going on"),
    }.get(kind, ("explain the change to compliance", "compliance decides whether to go on"))


TRIGGER_RULES = [(*row, *_actions(row[0])) for row in TRIGGER_LIMITS]
RULE_SCHEMA = ("rule_order INT, metric STRING, frequency STRING, green_threshold STRING, yellow_threshold STRING, "
               "red_threshold STRING, direction STRING, use_abs BOOLEAN, red_limit DOUBLE, yellow_limit DOUBLE, owner STRING, "
               "action_yellow STRING, action_red STRING")
STATUS_RED, STATUS_YELLOW, STATUS_GREEN = "🔴 Red", "🟡 Yellow", "🟢 Green"


def rules_table(spark: SparkSession, rules=None) -> DataFrame:
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rules or TRIGGER_RULES)], RULE_SCHEMA)


def band_status(v, direction, red_limit, yellow_limit, use_abs):
    x = F.when(use_abs, F.abs(v)).otherwise(v)
    high = direction == F.lit("high")
    red = F.when(high, x < red_limit).otherwise(x > red_limit)
    yellow = F.when(high, x < yellow_limit).otherwise(x >= yellow_limit)
    return when_chain([(v.isNull() | F.isnan(v), F.lit("Unknown")), (red, F.lit(STATUS_RED)),
                       (yellow, F.lit(STATUS_YELLOW))], F.lit(STATUS_GREEN))


def evaluate_triggers(values: DataFrame, rules: DataFrame) -> DataFrame:
    """L2: rules left join (metric, value); Unknown when missing, else red ->
    yellow -> green with the required action."""
    j = F.broadcast(rules).join(values, "metric", "left")  # rules: one row per metric
    st = band_status(F.col("value"), F.col("direction"), F.col("red_limit"), F.col("yellow_limit"), F.col("use_abs"))
    action = when_chain([(st == "Unknown", F.lit("Compute metric")), (st == STATUS_RED, F.col("action_red")),
                         (st == STATUS_YELLOW, F.col("action_yellow"))], F.lit("Continue monitoring"))
    return j.select("metric", "frequency", F.col("value").alias("current_value"), "green_threshold", "yellow_threshold",
                    "red_threshold", st.alias("status"), "owner", action.alias("required_action"))


def score_band(v, green: float, yellow: float, higher_better: bool = True):
    if higher_better:
        return when_chain([(v.isNull(), F.lit("Unknown")), (v >= green, F.lit("Green")), (v >= yellow, F.lit("Yellow"))],
                          F.lit("Red"))
    return when_chain([(v.isNull(), F.lit("Unknown")), (v < green, F.lit("Green")), (v < yellow, F.lit("Yellow"))],
                      F.lit("Red"))


def recommendation(scorecard: DataFrame) -> DataFrame:
    """No red and <= 2 yellow -> deploy with conditions; no red and <= 4
    yellow -> not yet; else pause and redesign."""
    c = scorecard.agg(F.sum((F.col("score") == "Red").cast("long")).alias("n_red"),
                      F.sum((F.col("score") == "Yellow").cast("long")).alias("n_yellow"),
                      F.sum((F.col("score") == "Green").cast("long")).alias("n_green"))
    rec = when_chain([((F.col("n_red") == 0) & (F.col("n_yellow") <= 2), F.lit("DEPLOY WITH CONDITIONS")),
                      ((F.col("n_red") == 0) & (F.col("n_yellow") <= 4), F.lit("DO NOT DEPLOY YET"))],
                     F.lit("PAUSE AND REDESIGN"))
    return c.select("n_green", "n_yellow", "n_red", rec.alias("recommendation"))


def consecutive_breach(monthly: DataFrame, keys: list[str], month_col: str = "month", value_col: str = "air",
                       limit: float = 0.80, min_run: int = 2) -> DataFrame:
    """Runs of >= min_run consecutive calendar months with value < limit
    (gaps-and-islands on a month index; windows are per key group over
    monthly aggregates)."""
    mi = F.year(month_col) * 12 + F.month(month_col)
    b = monthly.where(F.col(value_col) < limit).withColumn("_mi", mi)
    w = Window.partitionBy(*keys).orderBy("_mi")
    isl = b.withColumn("_island", F.col("_mi") - F.row_number().over(w))
    runs = isl.groupBy(*keys, "_island").agg(F.min(month_col).alias("start_month"), F.max(month_col).alias("end_month"),
                                             F.count(F.lit(1)).alias("months"), F.min(value_col).alias("min_value"))
    return runs.where(F.col("months") >= min_run).drop("_island").withColumn("months", F.col("months").cast("long"))


def wasserstein(a: DataFrame, b: DataFrame, col: str) -> DataFrame:
    """1-D Wasserstein distance Σ |F(v_i) − G(v_i)| (v_{i+1} − v_i) over
    the merged distinct values, both sides min-max scaled by side a.

    Cumulative shares come from distributed running totals; the next value
    is found by an equi-join on the distinct-value rank (no global window)."""
    stats = a.agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"))
    sc = lambda d: d.crossJoin(F.broadcast(stats)).select(
        safe_div(F.col(col) - F.col("_lo"), F.col("_hi") - F.col("_lo")).alias("v"))
    h = (sc(a).withColumn("_ca", F.lit(1)).withColumn("_cb", F.lit(0))
         .unionByName(sc(b).withColumn("_ca", F.lit(0)).withColumn("_cb", F.lit(1)))
         .where(F.col("v").isNotNull()).groupBy("v").agg(F.sum("_ca").alias("ca"), F.sum("_cb").alias("cb"),
                                                         F.lit(1).alias("one")))
    cum = running_totals(h, "v", ["ca", "cb", "one"], totals=["ca", "cb"])
    c = cum.select("v", F.col("cum_one").alias("r"), F.abs(F.col("cum_ca") / F.col("all_ca") - F.col("cum_cb") / F.col("all_cb")).alias("d"))
    nxt = c.select((F.col("r") - 1).alias("r"), F.col("v").alias("v_next"))
    return c.join(nxt, "r").agg(rnd(F.sum(F.col("d") * (F.col("v_next") - F.col("v"))), 6).alias("wasserstein"))


def robust_outliers(df: DataFrame, group_col: str, value_col: str, z_limit: float = 3.5, min_n: int = 20) -> DataFrame:
    """Per-group median vs the median and MAD of group medians; robust
    z = (median − pop_median) / (1.4826 · MAD).  Groups with at least
    ``min_n`` values form the population; smaller ones are reported with a
    null z and no flag.  All medians exact and distributed; the per-group
    table is written once."""
    med = exact_quantiles(df, value_col, [0.5], [group_col]).select(group_col, F.col("q").alias("median"))
    cnt = df.where(F.col(value_col).isNotNull()).groupBy(group_col).agg(F.count(F.lit(1)).alias("n"))
    per = materialize(med.join(cnt, group_col))
    pop = per.where(F.col("n") >= min_n)
    pm = exact_quantiles(pop, "median", [0.5], checkpoint=False).select(F.col("q").alias("pop_median"))
    pm = materialize(pm)
    dev = pop.crossJoin(F.broadcast(pm)).select(F.abs(F.col("median") - F.col("pop_median")).alias("_ad"))
    mad = exact_quantiles(dev, "_ad", [0.5]).select(F.col("q").alias("mad"))
    j = per.crossJoin(F.broadcast(pm)).crossJoin(F.broadcast(mad))  # one row each
    z = F.when(F.col("n") >= min_n, F.try_divide(F.col("median") - F.col("pop_median"), F.lit(1.4826) * F.col("mad")))
    return j.select(group_col, F.col("n").cast("long").alias("n"), rnd("median", 6).alias("median"),
                    rnd("pop_median", 6).alias("pop_median"), rnd("mad", 6).alias("mad"), rnd(z, 4).alias("robust_z"),
                    F.coalesce(F.abs(z) > z_limit, F.lit(False)).alias("flag"), (F.col("n") >= min_n).alias("in_population"))


def boundary_probing(scored: DataFrame, actor_col: str, threshold: float = 0.5, band: float = 0.05, p: str = "y_prob",
                     min_n: int = 20, ratio_limit: float = 3.0) -> DataFrame:
    """Share of an actor's scores within ±band of the threshold vs the
    population share; flagged when n >= min_n and share >= ratio_limit × population."""
    near = (F.abs(F.col(p) - F.lit(float(threshold))) <= F.lit(float(band))).cast("long")
    per = scored.groupBy(actor_col).agg(F.count(F.lit(1)).alias("n"), F.sum(near).alias("near"))
    pop = per.agg((F.sum("near") / F.sum("n")).alias("pop_share"))
    j = per.crossJoin(F.broadcast(pop))
    share = F.col("near") / F.col("n")
    return j.select(actor_col, F.col("n").cast("long").alias("n"), F.col("near").cast("long").alias("near"),
                    rnd(share).alias("near_share"), rnd("pop_share").alias("population_share"),
                    ((F.col("n") >= min_n) & (share >= F.col("pop_share") * ratio_limit)).alias("flag"))


def row_digest(cols: list[str]):
    """128-bit digest of a row's columns: two hashes of other seeds over every
    value and whether it is null, so that nulls and borders count."""
    values = [x for c in cols for x in (F.col(c), F.col(c).isNull())]
    return F.struct(F.xxhash64(F.lit(1), *values).alias("a"), F.xxhash64(F.lit(2), *values).alias("b"))


def label_diff(old: DataFrame, new: DataFrame, keys: list[str], label: str = "y", group_col: str | None = None,
               row_cols: list[str] | None = None) -> DataFrame:
    """Added / removed / flipped labels between two snapshots (full
    outer join on the key), per group; with ``row_cols``, rows whose label is
    the same but any of these columns differs are `row_changed`."""
    d = (lambda name: [row_digest(row_cols).alias(name)]) if row_cols else (lambda name: [])
    o = old.select(*keys, F.col(label).alias("_old"), *([F.col(group_col).alias("_go")] if group_col else []), *d("_do"))
    n = new.select(*keys, F.col(label).alias("_new"), *([F.col(group_col).alias("_gn")] if group_col else []), *d("_dn"))
    j = o.join(n, keys, "full_outer")
    g = F.coalesce("_go", "_gn") if group_col else F.lit("all")
    cases = [(F.col("_old").isNull(), F.lit("added")), (F.col("_new").isNull(), F.lit("removed")),
             (~F.col("_old").eqNullSafe(F.col("_new")), F.lit("flipped"))]
    if row_cols:
        cases.append((~F.col("_do").eqNullSafe(F.col("_dn")), F.lit("row_changed")))
    change = when_chain(cases, F.lit("unchanged"))
    return (j.groupBy(g.cast("string").alias("group"), change.alias("change")).agg(F.count(F.lit(1)).alias("n"))
            .withColumn("n", F.col("n").cast("long")))


def categorical_shift(old_counts: DataFrame, new_counts: DataFrame, key: str, eps: float = 1e-4) -> DataFrame:
    """Share per category in both versions, difference and PSI term."""
    o = old_counts.select(key, F.col("count").alias("c_old"))
    n = new_counts.select(key, F.col("count").alias("c_new"))
    j = o.join(n, key, "full_outer").fillna(0, ["c_old", "c_new"])
    w = Window.partitionBy()  # categories: bounded list
    j = (j.withColumn("s_old", F.col("c_old") / F.sum("c_old").over(w))
         .withColumn("s_new", F.col("c_new") / F.sum("c_new").over(w)))
    po = F.when(F.col("s_old") == 0, F.lit(eps)).otherwise(F.col("s_old"))
    pn = F.when(F.col("s_new") == 0, F.lit(eps)).otherwise(F.col("s_new"))
    return j.select(key, F.col("c_old").cast("long").alias("count_old"), F.col("c_new").cast("long").alias("count_new"),
                    rnd("s_old").alias("share_old"), rnd("s_new").alias("share_new"),
                    rnd(F.col("s_new") - F.col("s_old")).alias("share_diff"),
                    rnd((pn - po) * F.log(pn / po), 6).alias("psi_term"))


def pretrain_gate(old: DataFrame, new: DataFrame, base: DataFrame, current: DataFrame, key: str, width: int, numbers: list[str], levels: list[str],
                  attributes: dict, references: dict, psi_limit: float = 0.10, air_limit: float = 0.80) -> DataFrame:
    """Check, value, limit, passed and detail before a retraining.

    Two labelled snapshots are compared by content hashes of key ranges, so
    that only hashes move and the keys from the first to the last change are
    named; proxy features must not have drifted between two periods; the least
    impact ratio of the new labels must hold.  A value that cannot be computed
    does not pass."""
    from auditlens.operators import calibration as CA
    from auditlens.operators import fairness as FA
    from auditlens.sources.raw import changed_ranges, range_fingerprints

    differ = changed_ranges(range_fingerprints(old, key, width), range_fingerprints(new, key, width))
    named = F.concat(F.min("first_key").cast("string"), F.lit(" to "), (F.max("first_key") + width - 1).cast("string"))
    rows = [differ.agg(F.count(F.lit(1)).cast("double").alias("value"), named.alias("detail")).select(
        F.lit("snapshot_ranges_changed").alias("check"), "value", F.lit(0.0).alias("limit"), (F.col("value") <= 0).alias("passed"), "detail")]
    psi = CA.psi_long(CA.to_long(base, numbers), CA.to_long(current, numbers)).select("feature", "psi")
    psi = psi.unionByName(CA.psi_levels(base, current, levels)) if levels else psi
    rows.append(psi.select(F.concat(F.lit("proxy_psi_"), "feature").alias("check"), F.col("psi").alias("value"), F.lit(psi_limit).alias("limit"),
                           F.coalesce(F.col("psi") <= psi_limit, F.lit(False)).alias("passed"), F.lit(None).cast("string").alias("detail")))
    table = FA.fairness_table(new.withColumn("y_prob", F.col("y").cast("double")), attributes, references, 0.5)
    air = table.where(~F.col("is_reference")).agg(F.min("air").alias("value"))
    rows.append(air.select(F.lit("min_air_new_labels").alias("check"), "value", F.lit(air_limit).alias("limit"), F.coalesce(F.col("value") >= air_limit, F.lit(False)).alias("passed"),
                           F.lit(None).cast("string").alias("detail")))
    return rows[0].unionByName(rows[1]).unionByName(rows[2])
