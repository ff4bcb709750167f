"""Fits read rows that are dealt over all cores and prepared once."""

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from auditlens.functions.columns import to_double
from auditlens.functions.ordered import materialize, spread
from auditlens.operators import ml as ML
from auditlens.operators import prepare as PP


def rows(spark, n=600):
    data = [("NA" if i % 9 == 0 else str(float(i * 37 % 101)), float(i % 13), "abc"[i % 3], int((i * 37 % 101) + 10 * (i % 3) > 50), 1.0) for i in range(n)]
    return spark.createDataFrame(data, "income STRING, loan_amount DOUBLE, kind STRING, y INT, weight DOUBLE").coalesce(1)


def test_spread_is_even(spark):
    one = materialize(rows(spark))
    sizes = [r["count"] for r in spread(one).groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= 2 * spark.sparkContext.defaultParallelism and max(sizes) < 3 * min(sizes)


def test_raw_rows_of_the_models_are_in_many_files(spark, tmp_path):
    from auditlens.plans import load_all
    load_all()
    from auditlens.plans import q_models as Q
    from tests.conftest import SF
    assert len(Q._raw(spark, SF).inputFiles()) >= spark.sparkContext.defaultParallelism


def test_fit_on_vectors_is_the_pipeline_fit(spark):
    df = rows(spark)
    pipe = ML.logistic_pipeline(ML.preprocessing_stages(["income", "loan_amount"], ["kind"], ["income"], 5), 600, max_iter=200)
    plain, once = pipe.fit(df), ML.fit_on_vectors(pipe, df)
    assert list(once.stages[-1].coefficients.toArray()) == pytest.approx(list(plain.stages[-1].coefficients.toArray()), abs=1e-4)
    assert len(once.stages) == len(plain.stages) and ML.feature_names(once, df) == ML.feature_names(plain, df)


def test_rows_are_prepared_once_for_both_fits_of_boosting(spark, monkeypatch):
    calls = []
    fit = PP.TabularPreparer._fit
    monkeypatch.setattr(PP.TabularPreparer, "_fit", lambda self, d: calls.append(1) or fit(self, d))
    df = rows(spark)
    _, losses = ML.fit_with_patience(ML.preprocessing_stages(["income"], ["kind"]), df, df, max_iter=6, patience=30, block=2)
    assert len(losses) == 6 and len(calls) == 1


def test_numbers_of_text_and_of_numbers(spark):
    odd = [1.5, -0.0, float("inf"), float("-inf"), float("nan"), 1e300, None]
    df = spark.createDataFrame([(v, None if v is None else str(v)) for v in odd], "v DOUBLE, t STRING")
    got = df.select(PP.numbers("v", df.schema).alias("a"), to_double("v").alias("b"), to_double("t").alias("c")).collect()
    assert [r.a for r in got] == [r.b for r in got] == [r.c for r in got] == [1.5, -0.0, None, None, None, 1e300, None]
    ints = spark.createDataFrame([(2**53 + 1,), (-7,), (None,)], "v LONG")
    assert [r.a == r.b for r in ints.select(PP.numbers("v", ints.schema).alias("a"), to_double("v").alias("b")).where("a is not null").collect()] == [True, True]
    assert Pipeline(stages=ML.preprocessing_stages(["v"], [])).fit(df).transform(df).count() == 7
