"""Family K: attributions, importance, proxy correlation, case selection,
counterfactuals; plus the closed-form linear score used by model-free
robustness checks (J7, K1, K6)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from auditlens.functions.columns import rnd
from auditlens.functions.ordered import default_buckets, materialize
from auditlens.operators.leakage import proxy_annotate
from auditlens.operators.scorehist import auc_of_scores
from auditlens.operators.splits import hash_unit


@dataclass
class LinearScore:
    """score = m / (1 + m) with margin m = intercept + Σ coef·x (a monotone
    rational link, exact in any engine)."""
    intercept: float
    coefs: dict

    def margin(self, cols: dict | None = None):
        cols = cols or {}
        m = F.lit(float(self.intercept))
        for f, c in self.coefs.items():
            m = m + F.lit(float(c)) * cols.get(f, F.col(f))
        return m

    def score(self, cols: dict | None = None):
        m = self.margin(cols)
        return m / (F.lit(1.0) + m)


def perturbation(scored: DataFrame, model: LinearScore, features: list[str], keys: list[str],
                 levels=(0.10, 0.20), group_col: str = "derived_race", reference: str = "AFRICA",
                 threshold: float = 0.5, y: str = "y", seed: int = 42) -> DataFrame:
    """Multiplicative uniform noise per (feature, level) scenario; AUC
    delta against the baseline and each group's approval rate and AIR at
    ``threshold``.

    Narrow rows with the score of every scenario are written once (a 128-bit
    digest of the row key gives four uniform numbers of 32 bits).  AUCs come
    from one pass over lots of scores, the group counts of all scenarios from
    a map-side aggregate of one row a group."""
    feats = [f for f in features if f in scored.columns]
    scen = [(f, float(lv)) for f in feats for lv in levels]
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    blocks = [F.md5(F.concat(text, F.lit("" if b == 0 else f"|{b}"))).alias(f"_d{b}") for b in range(-(-len(scen) // 4))]
    unit = [F.conv(F.substring(F.col(f"_d{i // 4}"), 1 + 8 * (i % 4), 8), 16, 10).cast("double") / F.lit(float(2 ** 32)) for i in range(len(scen))]
    noise = [F.lit(1.0) - F.lit(lv) + F.lit(2.0) * F.lit(lv) * u for (_, lv), u in zip(scen, unit, strict=True)]
    # scenario 0 is the unperturbed baseline, scored in the same pass
    scores = [model.score()] + [model.score({f: F.col(f) * v}) for (f, _), v in zip(scen, noise, strict=True)]
    names = [f"_p{i}" for i in range(len(scores))]
    x = scored.select(*model.coefs.keys(), F.col(y).alias("y"), F.col(group_col).cast("string").alias("group"), *blocks)
    base = materialize(x.select("y", "group", *[s.alias(n) for s, n in zip(scores, names, strict=True)]))
    which = F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(lv).alias("level"), F.lit(n).alias("score")) for (f, lv), n in zip([("none", 0.0), *scen], names, strict=True)])
    of = base.sparkSession.range(1).select(F.explode(which).alias("_s")).select("_s.*")  # one row a scenario
    auc = materialize(auc_of_scores(base, names).join(of, "score").select("feature", "level", "auc"))  # one row a scenario
    approved = [F.sum((F.col(n) >= F.lit(float(threshold))).cast("long")).alias(n) for n in names]
    groups = base.groupBy("group").agg(F.count(F.lit(1)).alias("_n"), *approved)
    per = F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(lv).alias("level"), (F.col(n) / F.col("_n")).alias("_r")) for (f, lv), n in zip([("none", 0.0), *scen], names, strict=True)])
    rates = materialize(groups.select("group", F.explode(per).alias("_s")).select("group", "_s.*"))  # scenarios x groups rows
    ref = rates.where(F.col("group") == reference).select("feature", "level", F.col("_r").alias("_ref"))
    auc_b = auc.where(F.col("feature") == "none").select(F.col("auc").alias("base"))
    j = (rates.where(F.col("feature") != "none").join(ref, ["feature", "level"], "left").join(auc, ["feature", "level"]).crossJoin(F.broadcast(auc_b)))
    delta = F.col("auc") - F.col("base")
    return j.select("feature", F.concat(F.lit("±"), (F.col("level") * 100).cast("int").cast("string"), F.lit("%")).alias("noise_level"),
                    rnd("base").alias("baseline_auc"), rnd("auc").alias("perturbed_auc"), rnd(delta).alias("auc_delta"),
                    (F.abs(rnd(delta)) < 0.02).alias("auc_stable"), "group", rnd("_r").alias("approval_rate"),
                    rnd(F.when(F.col("_ref") > 0, F.col("_r") / F.col("_ref"))).alias("air"))


def linear_attributions(df: DataFrame, model: LinearScore, keys: list[str]) -> DataFrame:
    """K1: coef·(x − mean x) per feature (exact for a linear margin with
    independent features); one aggregate for the means, one projection."""
    feats = list(model.coefs)
    means = df.agg(*[F.avg(f).alias(f"_m_{f}") for f in feats])
    j = df.crossJoin(F.broadcast(means))
    return j.select(*keys, *[(F.lit(float(model.coefs[f])) * (F.col(f) - F.col(f"_m_{f}"))).alias(f) for f in feats])


def top_features(attr: DataFrame, features: list[str], proxy: DataFrame, n: int = 20) -> DataFrame:
    """K2: mean |attribution| per feature, rank, proxy annotation (top n)."""
    arr = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("v")) for f in features])
    m = (attr.select(F.explode(arr).alias("_x")).groupBy("_x.feature")
         .agg(F.avg(F.abs("_x.v")).alias("mean_abs_attribution")))
    ranked = m.withColumn("rank", F.row_number().over(Window.orderBy(F.col("mean_abs_attribution").desc(), "feature")))
    ranked = ranked.where(F.col("rank") <= n)  # the top-n report is the feature
    ann = proxy_annotate(ranked, proxy)
    return ann.select("rank", "feature", rnd("mean_abs_attribution", 6).alias("mean_abs_attribution"),
                      "proxy_risk_level", "proxy_justification")


def proxy_correlation(df: DataFrame, features: list[str], protected: dict[str, str], min_n: int = 20) -> DataFrame:
    """K3: Pearson r of every feature × encoded protected column in one
    aggregate (pairs with a null are skipped); null when fewer than min_n pairs."""
    aggs = []
    for f in features:
        for name, c in protected.items():
            aggs.append(F.corr(F.col(f).cast("double"), F.col(c).cast("double")).alias(f"r|{f}|{name}"))
            aggs.append(F.count(F.when(F.col(f).isNotNull() & F.col(c).isNotNull(), 1)).alias(f"n|{f}|{name}"))
    one = df.agg(*aggs)
    arr = F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(name).alias("protected"),
                             F.col(f"`r|{f}|{name}`").alias("r"), F.col(f"`n|{f}|{name}`").alias("n"))
                    for f in features for name in protected])
    x = one.select(F.explode(arr).alias("_x")).select("_x.*")
    return x.select("feature", "protected", F.col("n").cast("long").alias("n"),
                    rnd(F.when(F.col("n") >= min_n, F.col("r"))).alias("corr"))


def proxy_corr_flags(corr: DataFrame, limit: float = 0.30) -> DataFrame:
    """Pairs with |r| above the limit."""
    return corr.where(F.abs("corr") > limit).withColumn("limit", F.lit(float(limit)))


def case_selection(scored: DataFrame, group_col: str, keys: list[str], threshold: float = 0.5,
                   band: float = 0.05, y="y", p="y_prob") -> DataFrame:
    """K5: first TP, TN and FN case per group (smallest key) and the first
    two cases within ±band of the threshold, in one pass."""
    pred = F.col(p) >= F.lit(float(threshold))
    cls = (F.when(pred & (F.col(y) == 1), "TP").when(~pred & (F.col(y) == 0), "TN")
           .when(~pred & (F.col(y) == 1), "FN").when(pred & (F.col(y) == 0), "FP"))
    near = F.abs(F.col(p) - F.lit(float(threshold))) <= F.lit(float(band))
    kstruct = F.struct(*[F.col(k) for k in keys], F.col(p).alias("y_prob"), F.col(y).alias("y"))
    base = scored.select(F.col(group_col).cast("string").alias("group"), cls.alias("case_type"), near.alias("_near"), kstruct.alias("k"))
    tagged = base.select("group", "k", F.explode(F.array_compact(F.array(
        F.when(F.col("case_type").isin("TP", "TN", "FN"), F.struct("case_type", F.lit(1).alias("most"))),
        F.when(F.col("_near"), F.struct(F.lit("NEAR_THRESHOLD").alias("case_type"), F.lit(2).alias("most")))))).alias("t")).select("group", "k", "t.*")
    # the rank limit is applied in each task before the shuffle, so two rows a group and task move
    first = Window.partitionBy("group", "case_type").orderBy("k")
    allc = tagged.withColumn("ordinal", F.row_number().over(first)).where("ordinal <= 2").where("ordinal <= most")
    return allc.select("group", "case_type", "ordinal", *[F.col(f"k.{k}").alias(k) for k in keys],
                       F.col("k.y_prob").alias("y_prob"), F.col("k.y").alias("y"))


def counterfactuals(scored: DataFrame, model: LinearScore, deltas: dict[str, float], keys: list[str],
                    threshold: float = 0.5) -> DataFrame:
    """K6: every denied row × every (feature, delta): add the delta, rescore,
    flag a flip.  The delta list is a literal array exploded per row."""
    denied = scored.withColumn("original_prob", model.score()).where(F.col("original_prob") < F.lit(float(threshold)))
    arr = F.array(*[F.struct(F.lit(f).alias("feature_changed"), F.lit(float(d)).alias("delta")) for f, d in deltas.items()
                    if f in scored.columns])
    x = denied.select(*keys, *model.coefs.keys(), "original_prob", F.explode(arr).alias("_d")).select("*", "_d.*").drop("_d")
    cols = {f: F.when(F.col("feature_changed") == f, F.col(f) + F.col("delta")).otherwise(F.col(f)) for f in model.coefs}
    orig_val = when_value(list(model.coefs), "feature_changed")
    out = x.withColumn("counterfactual_prob", model.score(cols)).withColumn("original_value", orig_val)
    return out.select(*keys, "feature_changed", rnd("original_value", 2).alias("original_value"),
                      rnd(F.col("original_value") + F.col("delta"), 2).alias("counterfactual_value"), "delta",
                      rnd("original_prob").alias("original_prob"), rnd("counterfactual_prob").alias("counterfactual_prob"),
                      (F.col("counterfactual_prob") >= F.lit(float(threshold))).alias("decision_flipped"))


def when_value(features: list[str], selector: str):
    expr = None
    for f in features:
        expr = F.when(F.col(selector) == f, F.col(f)) if expr is None else expr.when(F.col(selector) == f, F.col(f))
    return expr


def counterfactual_flips(cf: DataFrame, keys: list[str], proxy: DataFrame) -> DataFrame:
    """K7: flips and distinct cases flipped per feature, exact-match proxy
    label with default Low."""
    k = F.struct(*[F.col(c) for c in keys])
    agg = cf.groupBy("feature_changed").agg(
        F.count(F.lit(1)).alias("n_scenarios"), F.sum(F.col("decision_flipped").cast("long")).alias("n_flips"),
        F.count_distinct(F.when(F.col("decision_flipped"), k)).alias("cases_flipped"))
    d = F.broadcast(proxy.select(F.col("feature").alias("feature_changed"), "risk_level"))
    return agg.join(d, "feature_changed", "left").select(
        "feature_changed", F.col("n_scenarios").cast("long").alias("n_scenarios"), F.col("n_flips").cast("long").alias("n_flips"),
        F.col("cases_flipped").cast("long").alias("cases_flipped"), F.coalesce("risk_level", F.lit("Low")).alias("proxy_risk_level"))


def next_in_hash_order(rows: DataFrame, cols: list[str], keys: list[str], seed: int, n_buckets: int) -> DataFrame:
    """``rows`` with ``_next``: a struct of ``cols`` of the row that follows in
    the order of a seeded hash (then keys), the first row following the last.

    The hash is uniform, so equal ranges of it are even buckets; each is
    ordered in a window of its own, and its last row takes the first row of the
    next bucket from a table of one row a bucket."""
    u = hash_unit(keys, seed)
    held = materialize(rows.withColumns({"_u": u, "_b": F.floor(u * n_buckets)}))
    order = [F.col(c) for c in ("_u", *keys)]
    # a bucket's least hash by a map-side aggregate, then the first of the few rows that have it
    least = held.groupBy("_b").agg(F.min("_u").alias("_u"))
    firsts = held.join(F.broadcast(least), ["_b", "_u"]).groupBy("_b").agg(F.min_by(F.struct(*cols), F.struct(*order)).alias("_first"))
    along = Window.orderBy("_b")  # one row a bucket
    after = firsts.select("_b", F.coalesce(F.lead("_first").over(along), F.first("_first").over(along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("_after"))
    following = F.lead(F.struct(*cols)).over(Window.partitionBy("_b").orderBy(*order))
    return held.withColumn("_following", following).join(F.broadcast(after), "_b").withColumn("_next", F.coalesce("_following", "_after")).drop("_u", "_b", "_following", "_after")


def permutation_importance(scored: DataFrame, model: LinearScore, keys: list[str], y: str = "y", seed: int = 7) -> DataFrame:
    """AUC drop when one feature's values are permuted across rows: every
    row takes the value of the next row in a seeded hash order (one shuffle)."""
    feats = list(model.coefs)
    paired = next_in_hash_order(scored.select(*keys, y, *feats), feats, keys, seed, default_buckets(scored))
    names = ["_p", *[f"_p_{f}" for f in feats]]
    scores = [model.score(), *[model.score({f: F.col(f"_next.{f}")}) for f in feats]]
    # the order is made once, scores of all rows are written
    x = materialize(paired.select(F.col(y).alias("y"), *[s.alias(n) for s, n in zip(scores, names, strict=True)]))
    feature = F.substring("score", 4, 1000)  # '' is the baseline
    auc = materialize(auc_of_scores(x, names).select(feature.alias("feature"), "auc"))  # one row a feature
    b = auc.where("feature = ''").select(F.col("auc").alias("base"))
    return auc.where("feature <> ''").crossJoin(F.broadcast(b)).select("feature", rnd("base").alias("baseline_auc"), rnd("auc").alias("permuted_auc"),
                                                                       rnd(F.col("base") - F.col("auc")).alias("importance"))
