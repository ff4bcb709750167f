"""Subgroup fairness: AIR, error rates, calibration error, significance.

All attributes are handled in one pass: the protected columns are unpivoted
to (attribute, group) rows, partially aggregated map-side into
(attribute, group, calibration bin, threshold bucket) cells, and every metric
is arithmetic over those cells.  Reference rates come from a join with a
table of at most one row per attribute.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlens.functions.columns import norm_cdf, ratio, rnd, safe_div, uniform_bin
from auditlens.functions.ordered import count_at_or_below


def attribute_long(scored: DataFrame, attributes: dict[str, str], keys=(), y="y", p="y_prob",
                   extra_cols=()) -> DataFrame:
    """Unpivot protected columns into (keys…, attribute, group, _y, _p)."""
    present = [(name, c) for name, c in attributes.items() if c in scored.columns]
    if not present:
        raise ValueError("none of the protected attribute columns is present")
    arr = F.array(*[F.struct(F.lit(name).alias("attribute"), F.col(c).cast("string").alias("group"))
                    for name, c in present])
    return (scored.select(*keys, *extra_cols, F.col(y).cast("int").alias("_y"),
                          F.col(p).cast("double").alias("_p"), F.explode(arr).alias("_a"))
            .select(*keys, *extra_cols, "_y", "_p", "_a.attribute", "_a.group")
            .where(F.col("group").isNotNull()))


def _refs_frame(spark: SparkSession, reference_groups: dict[str, str]) -> DataFrame:
    rows = [(k, str(v)) for k, v in reference_groups.items()]
    return F.broadcast(spark.createDataFrame(rows, "attribute STRING, ref_group STRING"))


def subgroup_counts(scored: DataFrame, attributes: dict[str, str], thresholds: list[float],
                    keys=(), y="y", p="y_prob", n_bins: int = 10) -> DataFrame:
    """(keys…, attribute, group, threshold, n, pos, pred_pos, tp, ece) for
    every threshold; ece is the unweighted bin-gap mean (null when n < 20).

    A linear chain with no branches, so the input is read once:
    rows → (group, calibration bin) partial counts with one conditional sum
    per threshold → (group) totals and the mean bin gap."""
    k = list(keys)
    ts = sorted(set(float(t) for t in thresholds))
    long = attribute_long(scored, attributes, k, y, p)
    g = k + ["attribute", "group"]
    pred = [(F.col("_p") >= F.lit(t)).cast("long") for t in ts]
    cells = long.groupBy(*g, uniform_bin(F.col("_p"), n_bins).alias("_bin")).agg(
        F.count(F.lit(1)).alias("_n"), F.sum("_y").alias("_pos"), F.sum("_p").alias("_sp"),
        *[F.sum(pr).alias(f"_pp{j}") for j, pr in enumerate(pred)],
        *[F.sum(pr * F.col("_y")).alias(f"_tp{j}") for j, pr in enumerate(pred)])
    per_group = cells.groupBy(*g).agg(
        F.sum("_n").alias("n"), F.sum("_pos").alias("pos"),
        F.avg(F.abs(F.col("_pos") / F.col("_n") - F.col("_sp") / F.col("_n"))).alias("_ece"),
        *[F.sum(f"_pp{j}").alias(f"_pp{j}") for j in range(len(ts))],
        *[F.sum(f"_tp{j}").alias(f"_tp{j}") for j in range(len(ts))])
    arr = F.array(*[F.struct(F.lit(t).alias("threshold"), F.col(f"_pp{j}").alias("pred_pos"),
                             F.col(f"_tp{j}").alias("tp")) for j, t in enumerate(ts)])
    return per_group.select(*g, F.col("n").cast("long").alias("n"), F.col("pos").cast("long").alias("pos"),
                            F.when(F.col("n") >= 20, F.col("_ece")).alias("ece"), F.explode(arr).alias("_t")) \
                    .select(*g, "_t.threshold", "n", "pos", F.col("_t.pred_pos").cast("long").alias("pred_pos"),
                            F.col("_t.tp").cast("long").alias("tp"), "ece")


def fairness_from_counts(counts: DataFrame, reference_groups: dict[str, str], keys=()) -> DataFrame:
    """Rates, AIR vs the reference group of each attribute, error rates.  The
    reference rate is a window over the small per-group table (no self-join)."""
    from pyspark.sql import Window
    k = list(keys)
    spark = counts.sparkSession
    refs = _refs_frame(spark, reference_groups)
    c = counts.withColumn("approval_rate_raw", safe_div("pred_pos", "n"))
    with_ref = c.join(refs, "attribute", "left")
    w = Window.partitionBy(*k, "attribute", "threshold")
    j = with_ref.withColumn("_ref_rate", F.max(F.when(F.col("group") == F.col("ref_group"),
                                                      F.col("approval_rate_raw"))).over(w))
    is_ref = F.coalesce(F.col("group") == F.col("ref_group"), F.lit(False))
    air = F.when(is_ref, F.lit(1.0)).otherwise(
        F.when(F.col("_ref_rate") > 0, F.col("approval_rate_raw") / F.col("_ref_rate")))
    fp = F.col("pred_pos") - F.col("tp")
    neg = F.col("n") - F.col("pos")
    fn = F.col("pos") - F.col("tp")
    return j.select(
        *k, "attribute", "group", is_ref.alias("is_reference"), "n",
        F.col("threshold").cast("double").alias("threshold"),
        rnd("approval_rate_raw").alias("approval_rate"),
        rnd(air).alias("air"),
        rnd(safe_div(fp, neg)).alias("fpr"),
        rnd(safe_div(fn, F.col("pos"))).alias("fnr"),
        rnd(ratio("tp", "pred_pos", 0.0)).alias("precision"),
        rnd(ratio("tp", "pos", 0.0)).alias("recall"),
        rnd("ece").alias("ece"),
        F.col("approval_rate_raw"), F.col("_ref_rate").alias("ref_rate_raw"),
        F.col("pos"), F.col("pred_pos"), F.col("tp"))


FAIRNESS_COLUMNS = ["attribute", "group", "is_reference", "n", "threshold", "approval_rate", "air",
                    "fpr", "fnr", "precision", "recall", "ece"]


def fairness_table(scored: DataFrame, attributes: dict[str, str], reference_groups: dict[str, str],
                   threshold: float = 0.5, y: str = "y", p: str = "y_prob", keys=(),
                   detail: bool = False) -> DataFrame:
    """Master fairness table: one row per (attribute, group)."""
    counts = subgroup_counts(scored, attributes, [threshold], keys, y, p)
    t = fairness_from_counts(counts, reference_groups, keys)
    return t if detail else t.select(*keys, *FAIRNESS_COLUMNS)


def air_across_thresholds(scored: DataFrame, attributes, reference_groups, thresholds=(0.3, 0.5, 0.7),
                          y="y", p="y_prob", keys=(), detail: bool = False) -> DataFrame:
    counts = subgroup_counts(scored, attributes, list(thresholds), keys, y, p)
    t = fairness_from_counts(counts, reference_groups, keys)
    return t if detail else t.select(*keys, *FAIRNESS_COLUMNS)


def significance(fair_detail: DataFrame, keys=()) -> DataFrame:
    """Pooled one-tailed two-proportion z-test of each non-reference group's
    approval rate against its reference group, from exact counts."""
    k = list(keys)
    ref = (fair_detail.where("is_reference")
           .select(*k, "attribute", "threshold", F.col("n").alias("_rn"), F.col("pred_pos").alias("_rp")))
    j = fair_detail.join(ref, k + ["attribute", "threshold"], "left")
    n1, x1, n2, x2 = F.col("n"), F.col("pred_pos"), F.col("_rn"), F.col("_rp")
    pool = (x1 + x2) / (n1 + n2)
    se = F.sqrt(pool * (F.lit(1.0) - pool) * (F.lit(1.0) / n1 + F.lit(1.0) / n2))
    z = F.when(~F.col("is_reference") & (pool > 0) & (pool < 1) & (se > 0),
               (x1 / n1 - x2 / n2) / se)
    return j.select(*k, "attribute", "group", "is_reference", "n", "threshold", "approval_rate", "air",
                    rnd(z).alias("z_stat"), rnd(norm_cdf(z)).alias("p_value"))


def intersectional_table(scored: DataFrame, col_a: str, col_b: str, ref_a: str, ref_b: str,
                         threshold: float = 0.5, p: str = "y_prob", min_n: int = 30) -> DataFrame:
    """Cell approval rates for col_a × col_b with AIR vs the reference cell;
    cells with n < min_n are suppressed (rate and AIR null) with a note."""
    pred = (F.col(p) >= F.lit(float(threshold))).cast("int")
    cells = (scored.where(F.col(col_a).isNotNull() & F.col(col_b).isNotNull())
             .groupBy(F.col(col_a).cast("string").alias("group_a"), F.col(col_b).cast("string").alias("group_b"))
             .agg(F.count(F.lit(1)).alias("n"), F.sum(pred).alias("_pp")))
    ref = (cells.where((F.col("group_a") == ref_a) & (F.col("group_b") == ref_b))
           .select(safe_div("_pp", "n").alias("_ref")))
    j = cells.crossJoin(F.broadcast(ref.unionByName(cells.sparkSession.createDataFrame([], "_ref DOUBLE"))
                                    .agg(F.max("_ref").alias("_ref"))))
    rate = safe_div("_pp", "n")
    supp = F.col("n") < min_n
    return j.select(
        "group_a", "group_b", F.col("n").cast("long").alias("n"),
        F.when(~supp, rnd(rate)).alias("approval_rate"),
        F.when(~supp, rnd(F.when(F.col("_ref") > 0, rate / F.col("_ref")))).alias("air_vs_reference"),
        supp.alias("suppressed"),
        F.when(supp, F.lit(f"n < {min_n} suppressed")).otherwise(F.lit("")).alias("note"))


def lowest_cell(cells: DataFrame) -> DataFrame:
    """The reported cell of least AIR (one row; nulls without one)."""
    low = F.min(F.struct(F.col("air_vs_reference").alias("air"), F.concat_ws(" × ", "group_a", "group_b").alias("cell")))
    return cells.where("air_vs_reference is not null").agg(low.alias("_low")).select(F.col("_low.cell").alias("lowest_cell"), F.col("_low.air").alias("lowest_cell_air"))


def wide(rows: DataFrame, index: str, by: str, values: list[str], levels: list[str]) -> DataFrame:
    """One row an index value, one column a value and level
    (``<value>_<level>``); missing combinations are null."""
    cells = [F.max(F.when(F.col(by) == level, F.col(v))).alias(f"{v}_{level}") for v in values for level in levels]
    return rows.groupBy(index).agg(*cells)


def error_rate_gaps(fair: DataFrame, keys=(), limit_pct: float = 10.0) -> DataFrame:
    """FPR / FNR gap of each group vs its reference group, absolute and
    in percent of the reference rate; flag when either exceeds ``limit_pct``."""
    k = list(keys)
    ref = fair.where("is_reference").select(*k, "attribute", "threshold",
                                            F.col("fpr").alias("fpr_ref"), F.col("fnr").alias("fnr_ref"))
    j = fair.where(~F.col("is_reference")).join(ref, k + ["attribute", "threshold"], "inner")
    out = j.select(*k, "attribute", "group", "threshold", "fpr", "fpr_ref", "fnr", "fnr_ref",
                   rnd(F.col("fpr") - F.col("fpr_ref")).alias("fpr_gap"),
                   rnd(safe_div(F.col("fpr") - F.col("fpr_ref"), "fpr_ref") * 100, 2).alias("fpr_gap_pct"),
                   rnd(F.col("fnr") - F.col("fnr_ref")).alias("fnr_gap"),
                   rnd(safe_div(F.col("fnr") - F.col("fnr_ref"), "fnr_ref") * 100, 2).alias("fnr_gap_pct"))
    flag = (F.abs(F.col("fpr_gap_pct")) > limit_pct) | (F.abs(F.col("fnr_gap_pct")) > limit_pct)
    return out.withColumn("flag", F.coalesce(flag, F.lit(False)))


def score_gaps(scored: DataFrame, attributes, reference_groups, p="y_prob", min_n: int = 30, keys=()) -> DataFrame:
    """Mean-score difference (ME) and standardized mean difference
    (SMD, pooled population variances) of each group vs the reference."""
    k = list(keys)
    long = attribute_long(scored, attributes, k, "y", p)
    st = long.groupBy(*k, "attribute", "group").agg(
        F.count(F.lit(1)).alias("n"), F.avg("_p").alias("_m"), F.var_pop("_p").alias("_v"))
    refs = _refs_frame(scored.sparkSession, reference_groups)
    r = (st.join(refs, "attribute").where(F.col("group") == F.col("ref_group"))
         .select(*k, "attribute", F.col("_m").alias("_rm"), F.col("_v").alias("_rv")))
    j = st.where(F.col("n") >= min_n).join(r, k + ["attribute"], "left")
    me = F.col("_m") - F.col("_rm")
    smd = F.try_divide(me, F.sqrt((F.col("_rv") + F.col("_v")) / F.lit(2.0)))
    return j.select(*k, "attribute", "group", F.col("n").cast("long").alias("n"), rnd("_m").alias("mean_score"),
                    rnd(me).alias("me"), rnd(smd).alias("smd"))


def air_violations(fair: DataFrame, limit: float = 0.80, keys=()) -> DataFrame:
    """Non-reference groups with AIR below the limit."""
    k = list(keys)
    return (fair.where(~F.col("is_reference") & (F.col("air") < limit))
            .select(*k, "attribute", "group", "threshold", "approval_rate", "air",
                    rnd("ref_rate_raw").alias("reference_rate"),
                    rnd(F.col("ref_rate_raw") - F.col("approval_rate_raw")).alias("gap")))


def group_performance(scored: DataFrame, group_cols: list[str], threshold: float = 0.5, y="y", p="y_prob",
                      min_n: int = 30) -> DataFrame:
    """Confusion-based rates per group (cells with n < min_n dropped)."""
    pred = (F.col(p) >= F.lit(float(threshold))).cast("int")
    yy = F.col(y).cast("int")
    c = scored.groupBy(*[F.col(g).cast("string").alias(g) for g in group_cols]).agg(
        F.count(F.lit(1)).alias("n"), F.sum(yy).alias("pos"), F.sum(pred).alias("pp"), F.sum(yy * pred).alias("tp"))
    c = c.where(F.col("n") >= min_n)
    fp = F.col("pp") - F.col("tp")
    fn = F.col("pos") - F.col("tp")
    tn = F.col("n") - F.col("pos") - fp
    return c.select(*group_cols, F.col("n").cast("long").alias("n"),
                    rnd(safe_div("pos", "n")).alias("actual_rate"), rnd(safe_div("pp", "n")).alias("approval_rate"),
                    rnd(safe_div(F.col("tp") + tn, "n")).alias("accuracy"),
                    rnd(ratio("tp", "pp", 0.0)).alias("precision"), rnd(ratio("tp", "pos", 0.0)).alias("recall"),
                    rnd(ratio(2 * F.col("tp"), 2 * F.col("tp") + fp + fn, 0.0)).alias("f1"),
                    rnd(safe_div(fp, F.col("n") - F.col("pos"))).alias("fpr"), rnd(safe_div(fn, "pos")).alias("fnr"))


def risk_tier(p="y_prob", low: float = 0.4, high: float = 0.7):
    """Low below ``low``, Medium below ``high``, else High."""
    return (F.when(F.col(p) < low, F.lit("Low")).when(F.col(p) < high, F.lit("Medium"))
            .when(F.col(p).isNotNull(), F.lit("High")))


def fairness_summary(fair: DataFrame, limit: float = 0.80, keys=()) -> DataFrame:
    """Per attribute: rate spread, lowest-AIR group, worst FNR group,
    counts of groups at / below the AIR limit."""
    k = list(keys)
    return fair.groupBy(*k, "attribute", "threshold").agg(
        F.count(F.lit(1)).alias("n_groups"),
        rnd(F.max("approval_rate_raw") - F.min("approval_rate_raw")).alias("rate_gap"),
        F.min_by("group", F.struct("air", "group")).alias("lowest_air_group"),
        F.min("air").alias("min_air"),
        F.max_by("group", F.struct("fnr", F.col("group"))).alias("worst_fnr_group"),
        F.max("fnr").alias("max_fnr"),
        F.sum((F.col("air") >= limit).cast("long")).alias("n_pass"),
        F.sum((F.col("air") < limit).cast("long")).alias("n_fail"))


def mitigation_sweep(scored: DataFrame, attributes: dict[str, str], reference_groups: dict[str, str],
                     thresholds=(0.4, 0.35, 0.3, 0.25, 0.2), limit: float = 0.80, y="y", p="y_prob") -> DataFrame:
    """Per threshold: overall approval rate, reference rate, min AIR,
    pass flag and bad rate among approved (1 - precision), one pass."""
    counts = subgroup_counts(scored, attributes, list(thresholds), (), y, p)
    fair = fairness_from_counts(counts, reference_groups)
    per_t = fair.groupBy("attribute", "threshold").agg(
        F.sum("n").alias("_n"), F.sum("pred_pos").alias("_pp"), F.sum("tp").alias("_tp"),
        F.max("ref_rate_raw").alias("_ref"), F.min("air").alias("min_air"))
    return per_t.select("attribute", "threshold",
                        rnd(safe_div("_pp", "_n")).alias("overall_approval_rate"),
                        rnd("_ref").alias("reference_approval_rate"), "min_air",
                        F.coalesce(F.col("min_air") >= limit, F.lit(False)).alias("passes_80_rule"),
                        rnd(ratio(F.col("_pp") - F.col("_tp"), "_pp", 0.0)).alias("bad_rate_approved"))


def recommended_threshold(sweep: DataFrame) -> DataFrame:
    """Highest threshold that passes the AIR rule (null if none)."""
    return sweep.groupBy("attribute").agg(
        F.max(F.when(F.col("passes_80_rule"), F.col("threshold"))).alias("recommended_threshold"),
        F.max("threshold").alias("max_tested"))
