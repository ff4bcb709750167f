"""Pairs of a large group of near copies that are looked at exactly."""

import random

from auditlens.llm import near_dedup as N


def test_pairs_within_a_group_follow_its_size(spark, monkeypatch):
    rng = random.Random(3)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(200):
        words = list(base)
        for _ in range(2):
            words[rng.randrange(300)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    looked, similar = [], N.similar
    monkeypatch.setattr(N, "similar", lambda pairs, cells, t: looked.append(pairs.count()) or similar(pairs, cells, t))
    classes = N.near_classes(spark.createDataFrame(rows, "doc_id LONG, text STRING")).collect()
    assert {r.class_id for r in classes} == {0} and sum(r.kept for r in classes) == 1
    assert sum(looked) <= 4 * len(rows)
