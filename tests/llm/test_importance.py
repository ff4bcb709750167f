"""Operator 12 against plain Python, and the numbering helper."""

import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from auditlens.llm.common import numbered
from auditlens.llm.importance import resample, split_words

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, grams, buckets):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    return len(words), [crc32(" ".join(words[i:i + k]).encode()) % buckets for k in range(1, grams + 1) for i in range(len(words) - k + 1)]


def expected(docs, target, share=25, min_words=20, grams=2, buckets=10_000):
    s, t = (Counter(b for text in texts for b in features(text, grams, buckets)[1]) for texts in ([d[1] for d in docs], target))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets)))) for b in range(buckets)]
    rows = []
    for i, text in docs:
        n, f = features(text, grams, buckets)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    fit = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0]))
    rank = {r: k + 1 for k, r in enumerate(fit[: share * len(fit) // 100])}
    return [(*r, rank.get(r)) for r in rows]


def key(r):
    return tuple((x is None, x) for x in r)


def benchmark(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "item_id LONG, text STRING")


@pytest.mark.parametrize("grams", [1, 2, 3])
def test_same_as_plain_python(spark, table, words, grams):
    rng = random.Random(grams)
    docs = [(i, " ".join(rng.choice(words[:400]) + rng.choice(["", ",", "É", "_x", " ", "\t7"]) for _ in range(rng.randint(0, 70)))) for i in range(200)]
    docs += [(900, None), (901, ""), (902, "?!"), (None, "Ab cd " * 30), (904, "LONG text " * 100_000)]
    target = [" ".join(rng.choice(words[:50]) for _ in range(60)) for _ in range(20)] + [None]
    got = resample(table(docs, ["rank", "score"]), benchmark(spark, target), grams=grams, buckets=500)
    want = expected(docs, target, grams=grams, buckets=500)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    assert sum(r[-1] is not None for r in want) > 20


def test_repeats_ties_and_empty(spark, table):
    bench = benchmark(spark, ["one two three"])
    assert resample(table([]), bench).collect() == []
    docs = [(4, "one two three " * 10)] * 6 + [(5, "x")] + [(None, "one two three " * 10)] * 4
    rows = resample(table(docs), bench, share=50).collect()
    assert len(rows) == 11 and sorted(r["rank"] for r in rows if r["rank"]) == [1, 2, 3, 4, 5]
    none = resample(table(docs), benchmark(spark, []), share=50).collect()
    assert sorted(r.n_features for r in none) == [1] + [59] * 10


def test_split_is_the_pattern():
    text = "".join(map(chr, range(0, 0x250))) + "　  Zß9"
    assert [w.decode() for w in split_words(text)] == WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))


def test_numbered_is_gapless_and_ordered(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 1000).alias("k"), F.col("id"))
    rows = sorted(numbered(df, [F.col("k").desc(), F.col("id").asc()], "place").collect(), key=lambda r: r.place)
    assert [r.place for r in rows] == list(range(5000))
    assert [(r.k, r.id) for r in rows] == sorted(((r.k, r.id) for r in rows), key=lambda x: (-x[0], x[1]))
    assert numbered(df.where("false"), [F.col("id").asc()], "place").count() == 0
