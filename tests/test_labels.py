"""Label rule and distribution (ports of the reference's label cases)."""

import pytest
from pyspark.sql import functions as F

from auditlens.operators.labels import LABEL_MAP, apply_label, label_distribution, label_log


def df_of(spark, values, col="action_taken", extra=None):
    rows = [(v,) if extra is None else (v, e) for v, e in zip(values, extra or values)]
    schema = f"{col} STRING" if isinstance(values[0], str) else f"{col} INT"
    if extra is not None:
        schema += ", loan_amount INT"
    return spark.createDataFrame(rows, schema)


def ys(df):
    return [r["y"] for r in df.orderBy(F.monotonically_increasing_id()).collect()]


def test_basic_mapping(spark):
    assert ys(apply_label(df_of(spark, [1, 2, 3]))) == [1, 1, 0]


def test_drops_4_to_8(spark):
    assert apply_label(df_of(spark, [4, 5, 6, 7, 8])).count() == 0


def test_mixed_input(spark):
    r = apply_label(df_of(spark, list(range(1, 9))))
    assert r.count() == 3
    assert {x["action_taken"] for x in r.collect()} == {1, 2, 3}


def test_y_integer(spark):
    assert dict(apply_label(df_of(spark, [1, 3])).dtypes)["y"] == "int"


def test_positive_rate(spark):
    r = apply_label(df_of(spark, [1, 1, 3])).agg(F.avg("y")).first()[0]
    assert r == pytest.approx(2 / 3)


def test_preserves_other_columns(spark):
    r = apply_label(df_of(spark, [1, 3], extra=[200000, 150000])).collect()
    assert sorted(x["loan_amount"] for x in r) == [150000, 200000]


def test_raises_if_missing(spark):
    with pytest.raises(ValueError, match="action_taken"):
        apply_label(spark.createDataFrame([(1,)], "some_other_col INT"))


def test_string_codes(spark):
    assert apply_label(df_of(spark, ["1", "2", "3", "4"])).count() == 3


def test_bad_text_dropped(spark):
    assert apply_label(df_of(spark, [" 1 ", "1.0d", "abc", "", "NaN", "3"])).count() == 2


def test_all_denied_and_approved(spark):
    assert apply_label(df_of(spark, [3, 3, 3])).agg(F.sum("y")).first()[0] == 0
    assert apply_label(df_of(spark, [1, 2, 1])).agg(F.avg("y")).first()[0] == 1.0


def test_distribution_covers_all(spark):
    t = {r["action_taken"]: r for r in label_distribution(df_of(spark, list(range(1, 9)))).collect()}
    assert set(t) == {float(i) for i in range(1, 9)}
    assert t[1.0]["retained"] and not t[4.0]["retained"]
    assert t[3.0]["label_assigned"] == 0 and t[5.0]["label_assigned"] is None
    assert sum(r["pct_of_total"] for r in t.values()) == pytest.approx(1.0)


def test_distribution_unknown_meaning(spark):
    t = label_distribution(df_of(spark, [1, 9])).collect()
    assert {r["meaning"] for r in t if r["action_taken"] == 9.0} == {"Unknown"}


def test_label_log(spark):
    r = label_log(df_of(spark, [1, 2, 3, 4, 5])).first()
    assert (r["raw_rows"], r["final_rows"], r["positive"], r["negative"], r["dropped_rows"]) == (5, 3, 2, 1, 2)


def test_label_map_constant():
    assert LABEL_MAP == {1: 1, 2: 1, 3: 0}
