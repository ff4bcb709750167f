"""Family E: the preparation pipeline with its row counts.

Counts ride on the export: every step is observed where it happens in the one
plan that writes the splits, so nothing is read again to be counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from auditlens.functions.columns import rnd
from auditlens.operators.labels import apply_label
from auditlens.operators.leakage import remove_leakage
from auditlens.operators.splits import split_by_cuts, split_cuts
from auditlens.sources.raw import export_splits

#: Steps in order, with what each one does.
STEPS = {
    "raw": "all rows as landed",
    "labelled": "rows whose action code has a label; the rest is dropped",
    "leakage_removed": "same rows without post-decision and identifier columns",
    "geo_holdout": "rows of the held-out states, never fitted on",
    "model_pool": "all other rows, to be split by label",
    "test": "first 15 % of each label by seeded hash, rounded up",
    "val": "next 15 % of each label, rounded up on the rest",
    "train": "what is left of the pool",
}


def _observed(df: DataFrame, name: str, *aggs) -> tuple[DataFrame, Observation]:
    seen = Observation(name)
    return df.observe(seen, *aggs), seen


def audited_export(df: DataFrame, path: str, keys: list[str], holdout_states: list[str], action: str = "action_taken",
                   state: str = "state_code", seed: int = 42) -> DataFrame:
    """Label, remove leakage, hold out states, split by label and write the
    parts below ``path``; returns step_no, step, rows, positive_rate, n_columns
    and note of every step.  Steps without rows have a null rate."""
    held = F.coalesce(F.col(state).isin(*holdout_states), F.lit(False))
    count, positive = F.count(F.lit(1)), F.sum("y")
    # the split's cut points are learned first, on the same rows unobserved
    cuts = split_cuts(remove_leakage(apply_label(df, action)).where(~held), "y", keys, seed=seed)
    raw, o_raw = _observed(df, "raw", count.alias("n"))
    labelled, o_labelled = _observed(apply_label(raw, action), "labelled", count.alias("n"), positive.alias("p"))
    clean, o_clean = _observed(remove_leakage(labelled), "clean", count.alias("n"), positive.alias("p"))
    split = split_by_cuts(clean, cuts, "y", keys, seed)
    split = split.withColumn("split", F.when(held, F.lit("geo_holdout")).otherwise(F.col("split")))
    parts = ["geo_holdout", "test", "val", "train"]
    of = {p: F.col("split") == p for p in parts}
    split, o_split = _observed(split, "split", *[F.count(F.when(c, 1)).alias(f"n_{p}") for p, c in of.items()], *[F.sum(F.when(c, F.col("y"))).alias(f"p_{p}") for p, c in of.items()])
    export_splits(split, path)
    s = o_split.get
    found = {"raw": (o_raw.get["n"], None, len(df.columns)), "labelled": (o_labelled.get["n"], o_labelled.get["p"], len(labelled.columns)),
             "leakage_removed": (o_clean.get["n"], o_clean.get["p"], len(clean.columns))}
    found |= {p: (s[f"n_{p}"], s[f"p_{p}"] or 0, len(split.columns)) for p in parts}
    pool = [found[p] for p in parts[1:]]
    found["model_pool"] = (sum(n for n, _, _ in pool), sum(p for _, p, _ in pool), len(split.columns))
    rows = [(i + 1, step, found[step][0], found[step][1], found[step][2], note) for i, (step, note) in enumerate(STEPS.items())]
    out = df.sparkSession.createDataFrame(rows, "step_no INT, step STRING, rows LONG, _p LONG, n_columns INT, note STRING")
    return out.select("step_no", "step", "rows", rnd(F.try_divide(F.col("_p").cast("double"), F.col("rows"))).alias("positive_rate"), "n_columns", "note")
