"""Operator 1: signatures, classes against brute force, edge cases."""

import random
from collections import Counter

import numpy as np

from auditlens.llm.graph import components
from auditlens.llm.near_dedup import LOW, WordHashes, dart_signature, keep_one, may_hold, near_classes, shingle_cells


def shingles(text):
    w = (text or "").lower().split()
    k = min(5, len(w))
    return Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if w else Counter()


def jaccard(a, b):
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def brute_classes(rows):
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if sets[a] and sets[b] and jaccard(sets[a], sets[b]) >= 0.8:
                lo, hi = sorted((find(a), find(b)))
                parent[hi] = lo
    return {i: find(i) for i in ids}


def edited(rng, words, text, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = rng.choice(words)
    return " ".join(w)


def corpus(words):
    rng = random.Random(7)
    rows, i = [], 0
    for n in (12, 60, 300):
        for _ in range(6):
            base = " ".join(rng.choices(words, k=n))
            for edits in (0, 0, n // 200, n // 100, n // 60, n // 10):
                rows.append((i, edited(rng, words, base, edits)))
                i += 1
    common = " ".join(rng.choices(words, k=150))  # one passage that many texts share
    for _ in range(40):
        rows.append((i, common + " " + " ".join(rng.choices(words, k=60))))
        i += 1
    rows += [(900, None), (901, ""), (902, " \n"), (903, "one two"), (904, "One  TWO"), (905, "two one"), (906, "la " * 400), (907, "la " * 410), (908, "la " * 900)]
    return rows


def test_classes_equal_brute_force(spark, table, words):
    rows = corpus(words)
    got = {r.doc_id: r for r in near_classes(table(rows, extra=["node", "label"])).collect()}
    want = brute_classes(rows)
    assert {i: r.class_id for i, r in got.items()} == want
    sizes = Counter(want.values())
    assert all(r.class_size == sizes[r.class_id] and r.kept == (r.doc_id == r.class_id) for r in got.values())


def test_large_group_of_near_copies_is_one_class(spark, table, words):
    rng = random.Random(8)
    base = " ".join(rng.choices(words, k=400))
    rows = [(i, edited(rng, words, base, 4)) for i in range(150)] + [(500 + i, base) for i in range(60)]
    got = near_classes(table(rows)).collect()
    assert {r.class_id for r in got} == {0} and {r.class_size for r in got} == {210} and sum(r.kept for r in got) == 1


def test_estimate_follows_weighted_jaccard(words):
    rng, hashes = random.Random(9), WordHashes()
    errors = []
    for n in (30, 200, 2000):
        for share in (0.02, 0.1, 0.3):
            a = " ".join(rng.choices(words, k=n))
            b = edited(rng, words, a, max(1, int(n * share / 5)))
            sa, sb = (dart_signature(shingle_cells(t.split(), hashes), 256) for t in (a, b))
            errors.append(abs(np.mean(sa == sb) - jaccard(shingles(a), shingles(b))))
    assert np.mean(errors) < 0.04 and max(errors) < 0.12


def test_remembered_hashes_stay_few():
    """A worker keeps them through all stages."""
    hashes = WordHashes()
    first = hashes["w0"]
    assert max(hashes[f"w{i}"] and len(hashes) for i in range(250_000)) <= 100_000
    assert hashes["w0"] == first


def test_repeated_rows_and_nulls(spark, table):
    text = "a b c d e f g h"
    got = near_classes(table([(1, text), (1, text), (None, text), (None, None), (2, text)])).collect()
    assert len(got) == 5 and sum(r.kept for r in got) == 2
    assert {(r.class_id, r.class_size) for r in got if r.node is not None} == {(1, 4)}


def test_keep_one_has_all_columns(spark, table):
    text = "a b c d e f g h"
    docs = table([(4, text), (3, text + " i"), (3, text), (None, text), (7, None)], extra=["_row2"])
    got = keep_one(docs)
    assert got.columns == docs.columns
    assert len(got.collect()) == 2  # one of the four copies, and the null text


def test_empty(spark, table):
    assert near_classes(table([])).collect() == []
    assert keep_one(table([])).collect() == []


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(bytes([i]), bytes([i + 1])) for i in range(40)] + [(bytes([100]), bytes([101]))], "a binary, b binary")
    got = {bytes(r.node)[0]: bytes(r.label)[0] for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_sketches_of_unrelated_long_texts_do_not_agree():
    """The sketch byte comes from bits that neither rank nor coordinate fix."""
    rng = np.random.default_rng(2)
    for n in (300, 20_000, 100_000):
        a, b = ((dart_signature(np.unique(rng.integers(0, 2**64, n, dtype=np.uint64)), 256) >> np.uint64(32)) & np.uint64(0xFF) for _ in range(2))
        assert np.count_nonzero(a == b) <= 8


def test_may_hold_is_exact_for_short_texts_and_near_for_long_ones():
    rng = np.random.default_rng(4)
    for n, shared in ((20, 18), (200, 177), (200, 179), (511, 456), (5000, 4650), (5000, 3700)):
        pool = np.unique(rng.integers(0, 2**32, 3 * n, dtype=np.uint64)).astype("<u4")
        rng.shuffle(pool)
        a, b = np.sort(pool[:n]), np.sort(np.r_[pool[:shared], pool[n : 2 * n - shared]])
        want = shared >= 0.8 * (2 * n - shared) - 1e-9
        assert may_hold(a[:LOW], b[:LOW]) == want, (n, shared)
