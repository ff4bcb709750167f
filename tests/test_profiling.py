"""E2 with and without full counts, and E4 on a small hand table."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from auditlens.operators import audit as AU
from auditlens.operators import profiling as PR

TEXTS = ["x"] * 40 + ["y"] * 40 + [f"t{i}" for i in range(500)] + [None] * 20
NUMBERS = [float(i % 7) for i in range(590)] + [None] * 10


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(t, n, i, None) for i, (t, n) in enumerate(zip(TEXTS, NUMBERS, strict=True))]
    return spark.createDataFrame(rows, "text STRING, number DOUBLE, `odd name` INT, nothing STRING").repartition(3)


@pytest.mark.parametrize("exact_values", [1_000_000, 100])
def test_summary(frame, exact_values):
    got = {r.feature: r for r in PR.column_summary(frame, exact_values=exact_values).collect()}
    assert list(sorted(got)) == ["nothing", "number", "odd name", "text"]
    t = got["text"]
    assert (t["count"], t.top, t.freq, t.dtype, t["mean"]) == (580, "x", 40, "string", None)
    assert t.unique_exact == (exact_values > 502) and abs(t.unique - 502) <= (0 if t.unique_exact else 10) and t.top_exact
    n = got["number"]
    values = [v for v in NUMBERS if v is not None]
    top = min(Counter(values).items(), key=lambda x: (-x[1], f"{x[0]:.6f}"))
    assert (n["count"], n.unique, n.unique_exact, float(n.top), n.freq) == (590, 7, True, *top)
    assert n["mean"] == round(np.mean(values), 6) and n["std"] == round(np.std(values, ddof=1), 6) and (n.q25, n.q50, n.q75) == tuple(np.quantile(values, [0.25, 0.5, 0.75]))
    i = got["odd name"]
    assert i.freq == 1 and i.top_exact and (i.min, i.max) == (0, 599)
    assert (got["nothing"]["count"], got["nothing"].unique, got["nothing"].top) == (0, 0, None)


def test_summary_of_texts_alone_and_of_nothing(spark, frame):
    assert [r["mean"] for r in PR.column_summary(frame, ["text"]).collect()] == [None]
    assert {r["count"] for r in PR.column_summary(frame.where("false")).collect()} == {0}


def test_top_not_certain(spark):
    """More values than the sketch tracks, all equally rare: the count is true, the claim is not made."""
    df = spark.range(5000).select(F.col("id").cast("string").alias("v"))
    r = PR.frequent_values(df, ["v"], exact_values=10, tracked=1000).first()
    assert r.freq in (None, 1) and not r.top_exact and not r.unique_exact and abs(r.unique - 5000) < 150


def test_dictionary_of_all_columns(frame):
    got = {r.feature: (r.dtype, r.n_missing, r["mean"]) for r in PR.data_dictionary(frame.drop("odd name")).collect()}
    assert got["text"] == ("string", 20, None) and got["nothing"][1] == 600 and got["number"][:2] == ("double", 10)


def test_audited_export(spark, tmp_path):
    rows = [(i, str(i % 8 + 1), "S1" if i % 5 == 0 else "S2" if i % 7 else None, 0.1) for i in range(400)]
    df = spark.createDataFrame(rows, "id INT, action_taken STRING, state_code STRING, interest_rate DOUBLE")
    out = {r.step: r for r in AU.audited_export(df, str(tmp_path / "x"), ["id"], ["S1"]).orderBy("step_no").collect()}
    assert list(out) == list(AU.STEPS)
    lab = [(i, int(a) < 3, s) for i, a, s, _ in rows if int(a) <= 3]
    held = [r for r in lab if r[2] == "S1"]
    assert (out["raw"].rows, out["raw"].positive_rate) == (400, None)
    for step in ("labelled", "leakage_removed"):
        assert (out[step].rows, out[step].positive_rate) == (len(lab), round(sum(r[1] for r in lab) / len(lab), 4))
    assert out["labelled"].n_columns == 5 and out["leakage_removed"].n_columns == 4
    assert out["geo_holdout"].rows == len(held) and out["model_pool"].rows == len(lab) - len(held) == sum(out[s].rows for s in ("test", "val", "train"))
    back = spark.read.parquet(str(tmp_path / "x"))
    assert {r.split: r["count"] for r in back.groupBy("split").count().collect()} == {s: out[s].rows for s in ("geo_holdout", "test", "val", "train")}
    assert "interest_rate" not in back.columns


def test_audit_of_an_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "id INT, action_taken STRING, state_code STRING")
    assert {(r.rows, r.positive_rate) for r in AU.audited_export(df, str(tmp_path / "x"), ["id"], ["S1"]).collect()} == {(0, None)}
