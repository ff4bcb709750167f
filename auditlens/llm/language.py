"""Language identification by compression.

Each language has a zstandard raw-content dictionary made of words from
labelled documents.  A text is lower-cased and cut into blocks of
``BLOCK_WORDS`` words; each block is reduced to its distinct words (so that its
own repeats cannot outweigh the dictionary) and compressed with every
dictionary; the language with the smallest sum over all blocks wins.  A run of zero bytes
in front keeps zstandard from storing short texts uncompressed.  The score is
the relative margin between the two smallest sums; a margin below
``MIN_MARGIN`` is a rejection.  A dictionary saves a bounded number of bytes of
one result, so that without blocks the margin would fall with a text's length.

The training sample is bounded by parameters: per language the
``SAMPLE_DOCS`` documents with the smallest hash of their id, ``SAMPLE_WORDS``
distinct words of each, ``DICT_BYTES`` in all.  Everything else covers every
row and whole texts.

Null texts and texts without a letter are `und` with score 0 and rejected; ties
go to the language with more labelled documents, then to the name;
repeated rows are judged alike; without labelled rows every text is `und`;
an empty table gives no rows.  Columns other than doc_id, text and lang are
left alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from auditlens.llm.common import SLICE_ROWS, documents

SAMPLE_DOCS = 256
SAMPLE_WORDS = 128
SPARE = 4
DICT_BYTES = 110 << 10
FILLER = bytes(64)
LEVEL = 6
MIN_MARGIN = 0.005
BLOCK_WORDS = 4096
UNKNOWN = "und"

WORD = re.compile(r"\w+")
LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    """Whether any character is a letter (the pattern also takes signs such as
    fractions and Roman numerals, which are not)."""
    return any(m.group().isalpha() for m in LETTER.finditer(text))


def held_out(col: str = "doc_id") -> Column:
    return F.crc32(F.col(col).cast("string").cast("binary")) % 4 == 2


def class_sizes(labelled: DataFrame) -> dict[str, int]:
    """Rows of each language (one row a language)."""
    return {r["lang"]: r["n"] for r in labelled.where("lang is not null").groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}


def learn(labelled: DataFrame) -> list[tuple[str, bytes]]:
    """(language, dictionary), the language with most rows first.

    ``labelled`` has doc_id, text and lang.  Rows whose id hashes below a limit
    set by the language's count are drawn first, about ``SPARE`` times the rows
    wanted whatever the table's size; of these the smallest hashes are taken.
    """
    sizes = class_sizes(labelled)
    if not sizes:
        return []
    mixed = F.crc32(F.concat(F.lit("sample-"), F.col("doc_id").cast("string")).cast("binary"))
    limits = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1 << 32, SPARE * SAMPLE_DOCS * (1 << 32) // n))])
    words = F.slice(F.array_distinct(F.split(F.lower("text"), r"[^\p{L}\p{N}_]+")), 1, SAMPLE_WORDS)
    drawn = (labelled.where("lang is not null and text is not null").withColumn("_h", mixed).where(F.col("_h") < limits[F.col("lang")])
             .select("lang", "doc_id", "_h", words.alias("words")))
    ranked = drawn.withColumn("_n", F.row_number().over(Window.partitionBy("lang").orderBy("_h", "doc_id")))
    sample: dict[str, list] = {}
    for row in ranked.where(F.col("_n") <= SAMPLE_DOCS).orderBy("lang", "_n").collect():  # bounded by the parameters above
        sample.setdefault(row["lang"], []).append(row["words"])
    out = []
    for lang, docs in sorted(sample.items(), key=lambda x: (-sizes[x[0]], x[0])):
        content = b""
        for ws in docs:
            content += " ".join(ws).encode() + b" "
            if len(content) >= DICT_BYTES:
                break
        out.append((lang, content[:DICT_BYTES]))
    return out


class Classifier:
    """Predicts (language, margin) of one text."""

    def __init__(self, dictionaries: list[tuple[str, bytes]]):
        import zstandard

        params = zstandard.ZstdCompressionParameters.from_level(LEVEL, min_match=3, write_content_size=False, write_checksum=False, write_dict_id=False)
        self.langs = [lang for lang, _ in dictionaries]
        self.squeeze = [
            zstandard.ZstdCompressor(compression_params=params, dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)).compress
            for _, content in dictionaries]

    def __call__(self, text: str | None) -> tuple[str, float]:
        if not text or not self.langs or not has_letter(text):
            return UNKNOWN, 0.0
        words = WORD.findall(text.lower())
        sizes = [0] * len(self.squeeze)
        for start in range(0, len(words), BLOCK_WORDS):
            data = FILLER + " ".join(dict.fromkeys(words[start : start + BLOCK_WORDS])).encode()
            sizes = [size + len(squeeze(data)) for size, squeeze in zip(sizes, self.squeeze, strict=True)]
        best = min(sizes)
        lang = self.langs[sizes.index(best)]
        if len(sizes) == 1:
            return lang, 1.0
        second = sorted(sizes)[1]
        return lang, (second - best) / second


def predict(docs: DataFrame, dictionaries: list[tuple[str, bytes]], keep: list[str]) -> DataFrame:
    """``keep`` columns of ``docs`` plus lang_pred and score; only the text is
    judged."""

    kept = list(dict.fromkeys(["text", *keep]))  # the text travels once

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classify = Classifier(dictionaries)
        for whole in batches:
            for start in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(start, SLICE_ROWS)
                found = [classify(t) for t in batch.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(kept.index(c)) for c in keep), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
                    [*(f"_k{i}" for i in range(len(keep))), "_lang_pred", "_score"])

    narrow = docs.select(*[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(kept)])
    kinds = "".join(f"_k{i} {docs.schema[c].dataType.simpleString()}, " for i, c in enumerate(keep))
    out = narrow.mapInArrow(run, f"{kinds}_lang_pred string, _score double")
    return out.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], F.col("_lang_pred").alias("lang_pred"), F.col("_score").alias("score"))


def fit(docs: DataFrame) -> list[tuple[str, bytes]]:
    """Dictionaries from the rows that are not held out, largest class first."""
    return learn(docs.where(~held_out()))


def accepted() -> Column:
    return (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= MIN_MARGIN)


def keep_identified(docs: DataFrame) -> DataFrame:
    """The documents whose language is told with a sufficient margin, with all
    their columns (a language of UNKNOWN or a narrow margin is a rejection)."""
    names = docs.columns
    places = [f"_{i}" for i in range(len(names))]  # a column may have the name of a result
    judged = predict(docs, fit(docs), names).toDF(*places, "lang_pred", "score")
    return judged.where(accepted()).select(*places).toDF(*names)


def op5_compression_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    out = predict(docs, fit(docs), ["doc_id"])
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", accepted().alias("accepted"))
