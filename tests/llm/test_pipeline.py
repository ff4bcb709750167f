"""The five stages against plain expectations, and edge cases."""

import corpus_pipeline
from auditlens.llm.common import fresh_path


def stages(spark, docs):
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = fresh_path(spark, f"test-{name}")
        stage(spark, out[-1], "unused").write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_stages_take_effect(spark, table, words):
    labelled = [(i, " ".join(words[(7 * i) % 900 : (7 * i) % 900 + 60]) + f" {words[i]}", "aa") for i in range(60)]
    text = " ".join(words[1000:1100])
    near = text.replace(words[1050], "changed", 1)
    passage = " ".join(words[1500:1600])
    rows = [*labelled, (100, text), (101, text.replace(" ", "\n")), (102, near), (103, None), (104, "12 34"),
            (105, "before one " + passage + " after one"), (106, "quite other words " + passage + " than that " + " ".join(words[1700:1800])), (107, " ".join(words[2000:2050]))]
    docs, told, exact, near_out, cut, packed = stages(spark, table(rows, extra=["extra", "kept"]))
    for df in (told, exact, near_out, cut):
        assert df.columns == docs.columns
    ids = [{r.doc_id for r in df.collect()} for df in (docs, told, exact, near_out, cut)]
    assert ids[0] - ids[1] == {103, 104}
    assert ids[1] - ids[2] == {101}
    assert {100, 102} & ids[3] == {100} and {105, 106, 107} <= ids[3]
    assert ids[4] == ids[3]
    left = {r.doc_id: r.text for r in cut.collect()}
    assert passage not in left[105] and passage not in left[106] and left[105].startswith("before one")
    assert left[107] == " ".join(words[2000:2050])
    assert {r.doc_id for r in packed.collect()} == ids[4]


def test_empty_tables_pass(spark, table):
    for df in stages(spark, table([])):
        assert df.collect() == []


def test_odd_rows_do_not_crash(spark, table):
    rows = [(None, None), (None, "a b c"), (1, ""), (1, "x y z " * 30), (1, "x y z " * 30), (2, " ")]
    assert stages(spark, table(rows))[-1].columns[:2] == ["doc_id", "piece"]


def test_run_returns_packed_rows(spark):
    from tests.conftest import SF

    got = corpus_pipeline.run(spark, SF).collect()
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert 0.8 * n < len({r.doc_id for r in got}) <= n
    assert all(r.length <= 2048 for r in got)
