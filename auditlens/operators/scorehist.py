"""The shared score histogram and the ranking metrics derived from it.

``score_hist`` = scored.groupBy(keys, score).agg(n, pos): one shuffle with
map-side partial aggregation.  AUC, average precision, KS, ROC/PR curves and
Brier are sums over it, and its cumulative columns come from
``running_totals`` (distributed, no single-task global window).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auditlens.functions.columns import ratio, rnd, safe_div
from auditlens.functions.ordered import count_below, default_buckets, materialize, running_totals, with_group_total


def score_hist(scored: DataFrame, keys: list[str] | tuple = (), y: str = "y", p: str = "y_prob",
               materialized: bool = True) -> DataFrame:
    """(keys…, score, n, pos, neg, sse) with one row per distinct score.

    The histogram is written once to the shared checkpoint folder, so every
    metric derived from it (edges, totals, cumulative counts, confusion
    counts) reads it instead of recomputing the scored input."""
    k = list(keys)
    h = (scored.where(F.col(p).isNotNull() & F.col(y).isNotNull())
         .groupBy(*k, F.col(p).cast("double").alias("score"))
         .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(y).cast("long")).alias("pos"),
              F.sum((F.col(p) - F.col(y)) * (F.col(p) - F.col(y))).alias("sse"))
         .withColumn("neg", F.col("n") - F.col("pos")))
    return materialize(h) if materialized else h


def cumulative(hist: DataFrame, keys: list[str] | tuple = ()) -> DataFrame:
    """Add totals (N_all, P, Nn) and inclusive cumulative counts (cum_pos, cum_neg,
    i.e. scores <= this one) per key group."""
    c = running_totals(hist, "score", ["pos", "neg"], list(keys), checkpoint=False, totals=["pos", "neg", "n", "sse"], keep_bucket=True)
    return c.withColumnsRenamed({"all_pos": "P", "all_neg": "Nn", "all_n": "N_all", "all_sse": "tot_sse"})


def ranking_metrics(hist: DataFrame, keys: list[str] | tuple = ()) -> DataFrame:
    """Per key group: n, pos, auc (tie-aware), pr_auc (step average precision),
    ks, brier — unrounded."""
    k = list(keys)
    c = cumulative(hist, k)
    tp_ge = F.col("P") - F.col("cum_pos") + F.col("pos")      # positives with score >= this
    fp_ge = F.col("Nn") - F.col("cum_neg") + F.col("neg")
    auc_term = F.col("pos") * (F.col("cum_neg") - F.col("neg") + F.col("neg") / F.lit(2.0))
    ap_term = F.col("pos") * safe_div(tp_ge, tp_ge + fp_ge)
    ks_term = F.abs(safe_div("cum_pos", "P") - safe_div("cum_neg", "Nn"))
    agg = c.groupBy(*k).agg(
        F.first("N_all").alias("n"), F.first("P").alias("pos"), F.first("Nn").alias("neg"),
        F.first("tot_sse").alias("sse_total"),
        F.sum(auc_term).alias("_auc"), F.sum(ap_term).alias("_ap"),
        F.max(ks_term).alias("_ks"))
    return agg.select(
        *k, F.col("n").cast("long").alias("n"), F.col("pos").cast("long").alias("pos"),
        F.when((F.col("pos") > 0) & (F.col("neg") > 0),
               F.col("_auc") / (F.col("pos").cast("double") * F.col("neg"))).alias("auc"),
        F.when(F.col("pos") > 0, F.col("_ap") / F.col("pos")).alias("pr_auc"),
        F.when((F.col("pos") > 0) & (F.col("neg") > 0), F.col("_ks")).alias("ks"),
        ratio("sse_total", "n").alias("brier"))


def _lots(scores: DataFrame, n_buckets: int) -> tuple[list[float], list[float]]:
    """Edges that cut the scores into about ``n_buckets`` equal lots, and the
    scores so frequent that one fills a lot alone (two bounded lists)."""
    at = F.array(*[F.lit(i / n_buckets) for i in range(1, n_buckets)])
    row = scores.agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("_s", F.lit(4096)).alias("k"))
    found = row.select(F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("k", at)).alias("e")).first()["e"] or []
    return sorted(set(found)), sorted({e for e, after in zip(found, found[1:], strict=False) if e == after})


def auc_of_scores(rows: DataFrame, scores: list[str], y: str = "y", n_buckets: int | None = None) -> DataFrame:
    """Tie-aware AUC (unrounded) of several score columns of the same rows:
    score (its column's name) and auc.

    Each score goes once to a lot of its range, which is ordered on its own.
    The pairs won in a lot are the rank sum of its positives less that of
    positives alone; the negatives of lower lots come from a table of one row a
    score and lot.  A score that fills a lot alone is only counted.  ``rows``
    is read three times and should be written; null scores and labels do not
    count, NaN is the highest score."""
    arr = F.array(*[F.struct(F.lit(i).alias("_i"), F.col(c).cast("double").alias("_s")) for i, c in enumerate(scores)])
    long = (rows.where(F.col(y).isNotNull()).select(F.col(y).cast("long").alias("_y"), F.explode(arr).alias("_x"))
            .select("_x._i", "_x._s", "_y").where(F.col("_s").isNotNull()))
    edges, frequent = _lots(long.where(~F.isnan("_s")), n_buckets or default_buckets(rows))
    alone = F.col("_s").isin(frequent) if frequent else F.lit(False)
    lot = (F.lit(2) * count_below(F.col("_s"), edges)).alias("_lot")  # a score counted alone comes behind the lot that it ends
    pos, neg = F.sum("_y").alias("_pos"), F.sum(F.lit(1) - F.col("_y")).alias("_neg")
    order = Window.partitionBy("_i", "_lot").orderBy("_s")
    last = F.count(F.lit(1)).over(order.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = long.where(~alone).select("_i", lot, "_s", "_y").withColumns({"_first": F.rank().over(order), "_last": last})
    won = F.sum(F.when(F.col("_y") == 1, F.col("_first") + F.col("_last"))) / F.lit(2.0) - F.sum("_y") * (F.sum("_y") + F.lit(1)) / F.lit(2.0)
    per = ranked.groupBy("_i", "_lot").agg(pos, neg, F.coalesce(won, F.lit(0.0)).alias("_won"))
    if frequent:
        counted = long.where(alone).groupBy("_i", "_s").agg(pos, neg)
        per = per.unionByName(counted.select("_i", (lot + F.lit(1)).alias("_lot"), "_pos", "_neg", (F.col("_pos") * F.col("_neg") / F.lit(2.0)).alias("_won")))
    per = materialize(per)  # at most scores x lots rows
    below = F.coalesce(F.sum("_neg").over(Window.partitionBy("_i").orderBy("_lot").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = per.withColumn("_below", below).groupBy("_i").agg(F.sum("_pos").alias("_p"), F.sum("_neg").alias("_n"), F.sum(F.col("_won") + F.col("_pos") * F.col("_below")).alias("_w"))
    name = F.element_at(F.array(*[F.lit(c) for c in scores]), F.col("_i") + 1)
    return sums.select(name.alias("score"), F.when((F.col("_p") > 0) & (F.col("_n") > 0), F.col("_w") / (F.col("_p").cast("double") * F.col("_n"))).alias("auc"))


def roc_points(hist: DataFrame, keys: list[str] | tuple = ()) -> DataFrame:
    """ROC curve: one point per distinct score threshold (fpr, tpr at
    score >= threshold) plus the origin; ``roc_area`` is the trapezoid area.

    The point above a threshold is the one of all higher scores, which the
    running totals already hold, so no window spans the curve."""
    k = list(keys)
    c = cumulative(hist, k)
    fp_gt, tp_gt = F.col("Nn") - F.col("cum_neg"), F.col("P") - F.col("cum_pos")  # higher scores only
    pts = c.select(*k, "_rb", F.col("score").alias("threshold"),
                   safe_div(fp_gt + F.col("neg"), "Nn").alias("fpr"), safe_div(tp_gt + F.col("pos"), "P").alias("tpr"),
                   safe_div(fp_gt, "Nn").alias("_fpr0"), safe_div(tp_gt, "P").alias("_tpr0"))
    seg = (F.col("fpr") - F.col("_fpr0")) * (F.col("tpr") + F.col("_tpr0")) / F.lit(2.0)
    area = with_group_total(pts, k, seg, "roc_area").drop("_rb", "_fpr0", "_tpr0")
    origin = area.groupBy(*k).agg(F.max("roc_area").alias("roc_area")).select(
        *k, F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"), "roc_area")
    return area.unionByName(origin)


def pr_points(hist: DataFrame, keys: list[str] | tuple = ()) -> DataFrame:
    """Precision-recall curve: thresholds from the top score down to the
    highest one that reaches full recall, plus the (recall 0, precision 1)
    end point; ``pr_area`` is the trapezoid area over recall."""
    k = list(keys)
    c = cumulative(hist, k)
    fp_gt, tp_gt = F.col("Nn") - F.col("cum_neg"), F.col("P") - F.col("cum_pos")
    tp, fp = tp_gt + F.col("pos"), fp_gt + F.col("neg")
    # full recall is reached above a threshold when no positive has its score or a lower one
    c = c.where((F.col("cum_pos") > 0) | ((F.col("P") == 0) & (F.col("cum_neg") == F.col("Nn"))))
    pts = c.select(*k, "_rb", F.col("score").alias("threshold"), safe_div(tp, "P").alias("recall"), safe_div(tp, tp + fp).alias("precision"),
                   F.coalesce(safe_div(tp_gt, "P"), F.lit(0.0)).alias("_r0"),
                   F.when(tp_gt + fp_gt > 0, safe_div(tp_gt, tp_gt + fp_gt)).otherwise(F.lit(1.0)).alias("_p0"))
    seg = (F.col("recall") - F.col("_r0")) * (F.col("precision") + F.col("_p0")) / F.lit(2.0)
    area = with_group_total(pts, k, seg, "pr_area").drop("_rb", "_r0", "_p0")
    end = area.groupBy(*k).agg(F.max("pr_area").alias("pr_area")).select(
        *k, F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("recall"), F.lit(1.0).alias("precision"), "pr_area")
    return area.unionByName(end)


def round_cols(df: DataFrame, cols: list[str], digits: int = 4) -> DataFrame:
    return df.select(*[rnd(c, digits).alias(c) if c in cols else F.col(c) for c in df.columns])
