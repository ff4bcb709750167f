"""Operator 9 against a plain Python version."""

import hashlib
import random
import re

import xxhash
from pyspark.sql import functions as F

from auditlens.llm import imatch as M


def dealt(term):
    seed_hash = xxhash.xxh64(term.encode(), seed=42).intdigest()
    return xxhash.xxh64(M.SEED.to_bytes(4, "little"), seed=seed_hash).intdigest() >> 48


def terms(text):
    return {t for t in re.split(r"[^\w]+|_", text.lower()) if t}


def brute(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: r[0])
    bounds = M.subset_bounds()
    df = {}
    for _, t in rows:
        for x in terms(t):
            df[x] = df.get(x, 0) + 1
    band = {x for x, n in df.items() if n >= M.MIN_DOCS and n <= M.MAX_SHARE * len(rows)}

    def signed(h):
        return h - (1 << 64) if h >= 1 << 63 else h

    def fp(text):
        own = sorted(t for t in terms(text) & band if dealt(t) < bounds[-1])
        out = []
        for lo, hi in zip([0, *bounds], bounds, strict=False):
            sub = [t for t in own if lo <= dealt(t) < hi]
            out.append(signed(xxhash.xxh64(" ".join(sub).encode(), seed=42).intdigest()) if sub else None)
        return [*out, None if own else signed(xxhash.xxh64(" ".join(sorted(terms(text))).encode(), seed=42).intdigest())]

    def like(a, b):
        either = [(x, y) for x, y in zip(a, b, strict=True) if x is not None or y is not None]
        return sum(x == y for x, y in either) / len(either)

    result = {}
    for n, (i, t) in enumerate(rows):
        nxt = rows[(n + 1) % len(rows)][1]
        half = len(t) // 2
        e = t[: len(t) - half] + nxt[:half]
        result[i] = (len(t), hashlib.sha256(e.encode()).hexdigest(), fp(t), fp(e), like(fp(t), fp(e)), like(fp(t), fp(nxt)))
    return result


def run(df):
    return {r.doc_id: (r.n_chars, r.edited_sha256, r.fp, r.edited_fp, r.ne, r.nn) for r in M.fingerprints(df).select(
        "*", M.likeness(F.col("fp"), F.col("edited_fp")).alias("ne"), M.likeness(F.col("fp"), F.col("next_fp")).alias("nn")).collect()}


def test_equals_brute_force(spark, table, words):
    rng = random.Random(4)
    some = words[:800]
    rows = [(3 * i, " ".join(rng.choices(some, k=rng.choice([2, 30, 150])))) for i in range(120)]
    rows += [(1, "Éa é, ça; ÇA"), (4, None), (7, ""), (10, "!!"), (13, rows[5][1]), (16, rows[5][1]), (1000, "w " * 30_000 + words[3])]
    got, want = run(table(rows, extra=["_row2", "term"])), brute(rows)
    assert got.keys() == want.keys()
    for i in want:
        assert got[i][:2] == want[i][:2]
        assert got[i][2] == want[i][2] and got[i][3] == want[i][3], i
        assert abs(got[i][4] - want[i][4]) < 1e-12 and abs(got[i][5] - want[i][5]) < 1e-12
    assert got[13][2] == got[16][2]
    assert sum(x[4] for x in got.values()) > 5 * sum(x[5] for x in got.values())


def test_edges(spark, table):
    assert M.fingerprints(table([])).collect() == []
    one = M.fingerprints(table([(5, "abc def")])).collect()
    assert [(r.doc_id, r.n_chars, r.edited_sha256) for r in one] == [(5, 7, hashlib.sha256(b"abc abc").hexdigest())]
    got = M.fingerprints(table([(1, "a b"), (1, "a b"), (None, "c d"), (2, "e")])).collect()
    assert sorted((r.doc_id or 0) for r in got) == [0, 1, 1, 2]


def test_empty_fingerprint_text():
    assert M.subset_bounds(((2, 2),)) == [1 << 14, 1 << 15]


def test_lexicons_keep_most_of_the_band_and_cover_it():
    assert M.subset_bounds()[-1] == M.DEAL
    shares = [2.0 ** -power for n, power in M.SUBSETS for _ in range(n)]
    assert all(sum(shares[i] for i in kept) > 0.65 for kept in M.LEXICONS)
    assert {i for kept in M.LEXICONS for i in kept} == set(range(len(shares)))


def test_one_changed_word_leaves_a_lexicon(spark, table, words):
    rng = random.Random(8)
    base = rng.sample(words, 60)
    texts = [" ".join(base)] * 2 + [" ".join(w for w in base if w != out) for out in base[:25]]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, " ".join(rng.choices(words, k=40))) for i in range(900)]
    fps = {r.doc_id: r.lex for r in M.fingerprints(table(rows)).select("doc_id", M.lexicon_hashes(F.col("fp")).alias("lex")).collect()}
    assert all(any(x == y for x, y in zip(fps[0], fps[2 + i], strict=True)) for i in range(25))
    assert any(fps[0] != fps[2 + i] for i in range(25))
    assert not any(x == y for x, y in zip(fps[100], fps[101], strict=True))


def test_a_large_group_of_near_copies_does_not_leave_the_band(spark, table, words):
    rng = random.Random(6)
    base = rng.sample(words, 80)
    copies = [" ".join(rng.choice(words) if i == at else w for i, w in enumerate(base)) for at in range(80)]
    rows = [(i, t) for i, t in enumerate(copies + [" ".join(base)] * 20)]
    rows += [(1000 + i, " ".join(rng.choices(words, k=40))) for i in range(200)]
    got = M.fingerprints(table(rows)).where("doc_id < 99").select(M.likeness(F.col("fp"), F.col("next_fp")).alias("near")).collect()
    assert sum(r.near for r in got) / len(got) > 0.7


def test_heavy_ids_are_cut_into_ranges(spark):
    """A third of the rows without id and a third with one id: no range holds
    much more than its share, and ranges follow (id, row)."""
    from auditlens.llm.imatch import cuts_below, range_cuts

    keyed = spark.range(9000).selectExpr("if(id % 3 = 0, null, if(id % 3 = 1, 77, id)) AS doc_id", "id * 1000003 AS _row")
    cuts = range_cuts(keyed, 32)
    assert len(cuts) <= 64
    value = F.coalesce(F.col("doc_id").cast("double"), F.lit(float("-inf")))
    rows = keyed.withColumn("_range", cuts_below(value, F.col("_row").cast("double"), cuts)).collect()
    order = sorted(rows, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r._row))
    at = [r._range for r in order]
    assert at == sorted(at)
    sizes = [at.count(x) for x in set(at)]
    assert max(sizes) <= 2 * 9000 / 32


def test_neighbours_with_null_and_repeated_ids(spark, table):
    rows = [(None, f"null {i} alpha beta") for i in range(60)] + [(5, f"five {i} gamma delta") for i in range(60)] + [(i, f"own {i} text") for i in range(10, 70)]
    got = M.fingerprints(table(rows)).collect()
    assert len(got) == len(rows)
    edited = set()
    for a, b in [(x, y) for x in rows for y in rows]:
        half = len(a[1]) // 2
        edited.add((a[0], hashlib.sha256((a[1][: len(a[1]) - half] + b[1][:half]).encode()).hexdigest()))
    assert all((r.doc_id, r.edited_sha256) in edited for r in got)
    by_id = {i: t for i, t in rows[120:]}
    for r in got:
        if r.doc_id is not None and r.doc_id >= 10:
            t, n = by_id[r.doc_id], len(by_id[r.doc_id]) // 2
            following = by_id.get(r.doc_id + 1)
            if following:
                assert r.edited_sha256 == hashlib.sha256((t[: len(t) - n] + following[:n]).encode()).hexdigest()


def test_the_plan_does_not_grow_with_the_number_of_ranges(spark):
    """The driver holds several copies of the plan: a condition for each cut filled its heap."""
    from bisect import bisect_left

    from auditlens.llm.imatch import cuts_below

    cuts = sorted({(float("-inf"), 3.0), *[(float(v), float("inf")) for v in range(0, 9000, 3)], *[(600.0, float(r)) for r in range(5, 400, 7)]})
    keys = [(None, 3), (None, 4), (-1, 0), (0, 9), (1, 0), (600, 5), (600, 6), (600, 398), (601, 0), (8997, 1), (8998, 1), (10**15, 2)]
    df = spark.createDataFrame(keys, "v LONG, r LONG")
    value = F.coalesce(F.col("v").cast("double"), F.lit(float("-inf")))
    for some in (cuts, cuts[:1], cuts[:2], cuts[:1000], []):
        out = df.withColumn("_n", cuts_below(value, F.col("r").cast("double"), some))
        for x in out.collect():
            assert x["_n"] == bisect_left(some, (float("-inf") if x["v"] is None else float(x["v"]), float(x["r"]))), x
    plan = df.withColumn("_n", cuts_below(value, F.col("r").cast("double"), cuts))._jdf.queryExecution().analyzed().toString()
    assert plan.count("CASE WHEN") <= 2
