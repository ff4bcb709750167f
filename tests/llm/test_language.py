"""Operator 5: held-out accuracy, contract, edge cases."""

from pyspark.sql import functions as F

from auditlens.llm.language import UNKNOWN, accepted, fit, held_out, keep_identified, predict
from tests.conftest import SF


def test_held_out_accuracy(spark):
    from auditlens.llm.registry import QUERIES

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = QUERIES["op5_compression_language"](spark, SF)
    both = got.join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(both) == docs.count()
    test = [r for r in both if r.held_out]
    assert len(test) > 30
    assert sum(r.lang == r.lang_pred for r in test) >= 0.95 * len(test)
    assert all(0 <= r.score <= 1 for r in both)


def test_lang_is_no_input_of_a_prediction(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    dictionaries = fit(docs)
    hidden = predict(docs.withColumn("lang", F.lit(None).cast("string")), dictionaries, ["doc_id"])
    assert {tuple(r) for r in hidden.collect()} == {tuple(r) for r in predict(docs, dictionaries, ["doc_id"]).collect()}
    masked = docs.withColumn("lang", F.when(~held_out(), F.col("lang")))
    assert fit(masked) == dictionaries


def test_edges(spark, table):
    train = [(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog sat there", "en"), ("le chat et le chien sont ici", "fr")] * 20)]
    odd = [(100, None), (101, ""), (102, "123 !?"), (103, "the dog and the cat"), (104, "le chien et le chat"), (104, "le chien et le chat"), (None, "the cat sat"), (105, "the dog and " * 20_000)]
    docs = table([*train, *odd], extra=["score", "_text"])
    got = [tuple(r) for r in predict(docs, fit(docs), ["doc_id"]).collect()]
    assert len(got) == len(train) + len(odd)
    by = {g[0]: g[1] for g in got}
    assert by[100] == by[101] == by[102] == UNKNOWN
    assert by[103] == by[105] == by[None] == "en" and by[104] == "fr"
    kept = keep_identified(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 100 not in ids and 102 not in ids and ids.count(104) == 2


def test_no_labels_and_empty(spark, table):
    docs = table([(1, "some text"), (2, None)])
    assert fit(docs) == []
    assert {r.lang_pred for r in predict(docs, [], ["doc_id"]).collect()} == {UNKNOWN}
    assert predict(docs, [], ["doc_id"]).where(accepted()).collect() == []
    assert keep_identified(table([])).collect() == []


def test_long_texts_of_one_language_are_accepted(spark):
    from auditlens.llm.language import MIN_MARGIN, Classifier

    docs = spark.read.parquet(SF.replace("sf0.001", "sf0.1") + "/documents.parquet")
    classify = Classifier(fit(docs))
    texts = {}
    for r in docs.where(held_out()).where("lang is not null and text is not null").orderBy("doc_id").collect():
        texts.setdefault(r.lang, []).append(r.text)
    long = {lang: "\n".join(x) for lang, x in texts.items() if sum(map(len, x)) > 500_000}
    assert len(long) >= 3
    for lang, text in long.items():
        for whole in (text, text * (10_000_000 // len(text))):
            found, margin = classify(whole)
            assert found == lang and margin >= 4 * MIN_MARGIN, (lang, len(whole), margin)


def test_signs_are_no_letters():
    from auditlens.llm.language import has_letter

    assert not any(map(has_letter, ["½ ½", "Ⅷ ⅔", "12 ٣", "_ ²", ""])) and all(map(has_letter, ["½a", "ª", "字", "ʰ", "É"]))


def test_texts_travel_once_and_in_slices(spark, monkeypatch):
    """A second copy of the text, or a whole batch handed back at once, takes the executors' memory."""
    from auditlens.llm import language as L

    docs = spark.createDataFrame([(i, None if i % 7 == 0 else f"the word {i} of the house and the garden", "en" if i % 2 else "de", i * 0.5, f"x{i}") for i in range(1300)],
                                 "doc_id LONG, text STRING, lang STRING, score DOUBLE, `a.b` STRING")
    sent = []
    frame = type(docs)
    real = frame.mapInArrow

    def seen(self, run, schema, *rest):
        sent.append(self)

        def sized(batches):
            for out in run(batches):
                assert out.num_rows <= L.SLICE_ROWS
                yield out

        return real(self, sized, schema, *rest)

    monkeypatch.setattr(frame, "mapInArrow", seen)
    monkeypatch.setattr(L, "accepted", lambda: F.col("lang_pred") != UNKNOWN)
    out = keep_identified(docs)
    assert out.columns == docs.columns
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, docs.where("text is not null").collect()))
    assert [len(df.columns) for df in sent] == [len(docs.columns)] and "struct" not in sent[0].schema.simpleString()[6:]
    assert predict(docs, [], ["doc_id"]).count() == 1300
    assert predict(docs, [], []).columns == ["lang_pred", "score"]
