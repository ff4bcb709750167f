"""Family J: calibration, drift (PSI), perturbation and holdout stress."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlens.functions.brackets import quantiles
from auditlens.functions.columns import rnd, safe_div, uniform_bin, when_chain
from auditlens.functions.ordered import materialize


def calibration_curve(scored: DataFrame, n_bins: int = 10, keys=(), y="y", p="y_prob") -> DataFrame:
    """Non-empty uniform bins with mean score and observed positive rate."""
    k = list(keys)
    return (scored.where(F.col(p).isNotNull())
            .groupBy(*k, uniform_bin(F.col(p), n_bins).alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(y).cast("long")).alias("pos"),
                 F.sum(F.col(p)).alias("sum_p"))
            .select(*k, "bin", F.col("n").cast("long").alias("n"),
                    (F.col("sum_p") / F.col("n")).alias("mean_pred"), (F.col("pos") / F.col("n")).alias("frac_pos")))


def ece(scored: DataFrame, n_bins: int = 10, keys=(), y="y", p="y_prob", min_n: int = 20,
        weighted: bool = False) -> DataFrame:
    """Unweighted mean of bin gaps (reference definition) or the
    count-weighted textbook ECE; null when n < min_n."""
    k = list(keys)
    c = calibration_curve(scored, n_bins, k, y, p)
    gap = F.abs(F.col("frac_pos") - F.col("mean_pred"))
    agg = c.groupBy(*k).agg(F.sum("n").alias("n"), F.avg(gap).alias("_u"),
                            (F.sum(gap * F.col("n")) / F.sum("n")).alias("_w"))
    val = F.col("_w") if weighted else F.col("_u")
    return agg.select(*k, F.col("n").cast("long").alias("n"), rnd(F.when(F.col("n") >= min_n, val)).alias("ece"))


def calibration_by_group(scored: DataFrame, group_col: str, n_bins: int = 10, y="y", p="y_prob",
                         min_n: int = 20) -> DataFrame:
    """ECE and Brier per group with n >= min_n."""
    g = scored.where(F.col(group_col).isNotNull()).withColumn("group", F.col(group_col).cast("string"))
    e = ece(g, n_bins, ["group"], y, p, min_n)
    b = g.groupBy("group").agg(F.avg((F.col(p) - F.col(y)) ** 2).alias("_b"))
    return (e.join(b, "group").where(F.col("n") >= min_n)
            .select("group", F.lit(group_col).alias("attribute"), "n", "ece", rnd("_b").alias("brier")))


def ece_gap(by_group: DataFrame) -> DataFrame:
    """Largest ECE difference across groups of each attribute."""
    return by_group.groupBy("attribute").agg(
        rnd(F.max("ece") - F.min("ece")).alias("ece_gap"), F.count(F.lit(1)).alias("n_groups"))


# ---------------------------------------------------------------- PSI

PSI_PROBS = [i / 10 for i in range(11)]


def psi_band(psi):
    """One band function for interpretation and action (null -> cannot compute)."""
    interp = when_chain([(psi.isNull(), F.lit("Cannot compute")), (psi < 0.10, F.lit("Stable")),
                         (psi < 0.25, F.lit("Moderate shift — monitor"))], F.lit("Major shift — review required"))
    action = when_chain([(psi.isNull(), F.lit("Cannot compute")), (psi < 0.10, F.lit("None")),
                         (psi < 0.25, F.lit("Increase monitoring frequency"))], F.lit("Model review required"))
    return interp, action


def psi_long(expected: DataFrame, actual: DataFrame, n_bins: int = 10, eps: float = 1e-4) -> DataFrame:
    """J5 for many features at once.  Inputs are long (feature, value).

    Edges: exact percentiles 0,10,…,100 of the expected side, de-duplicated;
    fewer than 3 edges -> null.  Bins are [e_i, e_{i+1}) with the last one
    closed; values outside the edges stay in the denominator only.
    """
    probs = [i / n_bins for i in range(n_bins + 1)]
    e = expected.where(F.col("value").isNotNull()).select("feature", F.col("value").cast("double").alias("value"))
    a = actual.where(F.col("value").isNotNull()).select("feature", F.col("value").cast("double").alias("value"))
    # edges and the number of expected values below each come from sketch brackets, so the expected side's
    # bins need no further pass; the actual side is binned row by row in one map-side aggregate
    q = quantiles(e, "value", probs, ["feature"])
    cuts = materialize(q.groupBy("feature").agg(F.array_sort(F.collect_set(F.struct("q", "below"))).alias("cuts"), F.first("n").alias("n_e")))  # one row a feature
    edges = cuts.select("feature", F.col("cuts.q").alias("edges"))
    last = F.element_at("edges", -1)
    idx = F.size(F.filter("edges", lambda x: x <= F.col("value"))) - 1
    inside = (F.col("value") >= F.element_at("edges", 1)) & (F.col("value") <= last)
    binx = F.when(~inside | F.col("edges").isNull(), F.lit(-1)).when(F.col("value") == last, F.size("edges") - 2).otherwise(idx)
    ca = materialize(a.join(F.broadcast(edges), "feature", "left").groupBy("feature", binx.alias("bin")).agg(F.count(F.lit(1)).alias("c_a")))  # features x bins rows
    tot = (cuts.select("feature", "n_e").join(ca.groupBy("feature").agg(F.sum("c_a").alias("n_a")), "feature", "full_outer")
           .select("feature", F.coalesce("n_e", F.lit(0)).alias("n_e"), F.coalesce("n_a", F.lit(0)).alias("n_a")))
    bins = cuts.where(F.size("cuts") >= 3).select("feature", "n_e", "cuts", F.explode(F.sequence(F.lit(0), F.size("cuts") - 2)).alias("bin"))
    upto = F.when(F.col("bin") == F.size("cuts") - 2, F.col("n_e")).otherwise(F.get("cuts", F.col("bin") + 1)["below"])
    bins = bins.select("feature", "bin", (upto - F.get("cuts", F.col("bin"))["below"]).alias("c_e"))
    full = (bins.join(ca, ["feature", "bin"], "left").join(tot, "feature")
            .withColumn("pe", F.coalesce(safe_div("c_e", "n_e"), F.lit(0.0)))
            .withColumn("pa", F.coalesce(safe_div("c_a", "n_a"), F.lit(0.0))))
    full = (full.withColumn("pe", F.when(F.col("pe") == 0, F.lit(eps)).otherwise(F.col("pe")))
            .withColumn("pa", F.when(F.col("pa") == 0, F.lit(eps)).otherwise(F.col("pa"))))
    psi = full.groupBy("feature").agg(F.sum((F.col("pa") - F.col("pe")) * F.log(F.col("pa") / F.col("pe"))).alias("psi"))
    return (tot.join(psi, "feature", "left")
            .select("feature", rnd("psi").alias("psi"), F.col("n_e").cast("long").alias("n_train"),
                    F.col("n_a").cast("long").alias("n_holdout")))


def psi_levels(expected: DataFrame, actual: DataFrame, cols: list[str], eps: float = 1e-4) -> DataFrame:
    """PSI of categories over their levels (nulls are the level Missing), all
    columns at once: feature and psi."""

    def shares(df: DataFrame, out: str) -> DataFrame:
        arr = F.array(*[F.struct(F.lit(c).alias("feature"), F.coalesce(F.col(c).cast("string"), F.lit("Missing")).alias("level")) for c in cols])
        n = materialize(df.select(F.explode(arr).alias("_x")).groupBy("_x.feature", "_x.level").agg(F.count(F.lit(1)).alias("_n")))  # one row a level
        total = n.groupBy("feature").agg(F.sum("_n").alias("_t"))
        return n.join(F.broadcast(total), "feature").select("feature", "level", (F.col("_n") / F.col("_t")).alias(out))

    both = shares(expected, "pe").join(shares(actual, "pa"), ["feature", "level"], "full_outer")
    pe, pa = (F.coalesce(F.col(c), F.lit(eps)) for c in ("pe", "pa"))
    return both.groupBy("feature").agg(rnd(F.sum((pa - pe) * F.log(pa / pe))).alias("psi"))


def to_long(df: DataFrame, cols: list[str]) -> DataFrame:
    arr = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in cols])
    return df.select(F.explode(arr).alias("_x")).select("_x.feature", "_x.value")


def psi_table(train: DataFrame, holdout: DataFrame, features: list[str], n_bins: int = 10) -> DataFrame:
    """PSI, band and action per feature in one job; features absent on
    either side give a 'Feature missing' row."""
    spark = train.sparkSession
    ok = [f for f in features if f in train.columns and f in holdout.columns]
    missing = [f for f in features if f not in ok]
    res = psi_long(to_long(train, ok), to_long(holdout, ok), n_bins) if ok else None
    interp, action = psi_band(F.col("psi"))
    out = None
    if res is not None:
        out = res.select("feature", "psi", interp.alias("interpretation"), action.alias("action"),
                         F.col("n_train").cast("long").alias("n_train"), F.col("n_holdout").cast("long").alias("n_holdout"))
    if missing:
        m = spark.createDataFrame([(f, None, "Feature missing", "Investigate", 0, 0) for f in missing],
                                  "feature STRING, psi DOUBLE, interpretation STRING, action STRING, n_train BIGINT, n_holdout BIGINT")
        out = m if out is None else out.unionByName(m)
    return out
