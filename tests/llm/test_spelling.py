"""Operator 11 against all pairs of words."""

import random
import re
from collections import Counter
from zlib import crc32

import pytest

from auditlens.llm.spelling import Leaf, one_edit, path_of, steps, variant_groups


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def expected(rows, min_count=3):
    total = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{'' if doc is None else doc}:{word}".encode())
            if h % 97 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1:]
            total[word] += 1
    n = {w: c for w, c in total.items() if len(w) >= 5 and c >= min_count}
    close = {w: [v for v in n if near(w, v)] for w in n}
    form = {w: f for w, v in close.items() if v for f in [min(v, key=lambda x: (-n[x], x))] if n[f] >= 2 * n[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {w: (n[w], len(close[w]), form.get(w), n.get(form.get(w)), root(w)) for w in n}


def got(df):
    rows = [(r.word, (r.n, r.n_near, r.form, r.form_n, r.root)) for r in df.collect()]
    assert len(dict(rows)) == len(rows)
    return dict(rows)


def corpus(seed, n_docs=250, letters="aeinrtgqÉéÿ"):
    rng = random.Random(seed)
    stems = ["".join(rng.choice(letters) for _ in range(rng.randint(4, 9))) for _ in range(60)]

    def word():
        w = rng.choice(stems[: rng.randint(1, 60)])
        at = rng.randrange(len(w))
        kind = rng.random()
        if kind < 0.15:
            w = w[:at] + rng.choice(letters) + w[at + 1:]
        elif kind < 0.25:
            w = w[:at] + w[at + 1:]
        elif kind < 0.35:
            w = w[:at] + rng.choice(letters) + w[at:]
        return w.upper() if rng.random() < 0.1 else w

    return [(i, " ".join(word() for _ in range(40))) for i in range(n_docs)]


@pytest.mark.parametrize("limit", [8192, 5])
def test_same_as_all_pairs(spark, table, limit):
    """With the small limit the trie is cut to its full depth and shares are dealt."""
    rows = corpus(1) + [(None, "Straße straße straßen"), (None, "STRASSE"), (7000, ""), (7001, None), (7002, "12 ×÷ x"), (7003, "abcdef " * 3 + "abcdeg " * 7 + "abcdegh " * 15)]
    want = expected(rows)
    assert sum(v[2] is not None for v in want.values()) > 30 and any(want[v[2]][2] for v in want.values() if v[2])
    assert got(variant_groups(table(rows, ["word", "n", "path"]), limit=limit, asked=4 * limit)) == want


def test_words_of_one_path_are_dealt(spark, table):
    """Hundreds of words with the same letters, in shares of ten."""
    rng = random.Random(3)
    words = sorted({"".join(rng.sample("aeinrt", 6)) for _ in range(300)})
    rows = [(i, " ".join(words)) for i in range(5)]
    assert got(variant_groups(table(rows), limit=10, asked=25, edit_every=10**12)) == expected([], 3) | {
        w: (5, sum(near(w, v) for v in words), None, None, w) for w in words}


def test_empty_ties_repeats_and_long_texts(spark, table):
    assert got(variant_groups(table([]))) == {}
    assert got(variant_groups(table([(1, None), (2, ""), (3, "a b c")]))) == {}
    rows = [(5, "planet " * 3 + "planed " * 6 + "planer " * 6)] * 2 + [(6, "lantern " * 200_000 + "lanterns " * 50_000)]
    want = expected(rows)
    assert got(variant_groups(table(rows))) == want
    assert want["planet"][2] == "planed" and want["lanterns"][2] == "lantern"


def test_leaf_index_and_budget():
    words = sorted({"".join(random.Random(i).sample("abcdefg", 7)) for i in range(400)})
    leaf = Leaf([(path_of(w), w, 1) for w in words])
    for a in ("abcdefg", "abcdeff", "bbcdefg", "abcdef", "bcdefg", "abcefg"):
        assert sorted(e[1] for e in leaf.maybe(a) if one_edit(a, e[1])) == [w for w in words if near(a, w)]
    assert one_edit("abc", "abcd") and one_edit("xabc", "abc") and not one_edit("abc", "abc") and not one_edit("abc", "axbd")
    ways = steps("\x01\x00\x02", 0, 3, 1, 1)
    assert len(ways) == len(set(ways)) and ("\x02\x00\x01", 0, 0) in ways and ("\x00\x00\x03", 0, 0) not in ways
    assert steps("\x01\x00", 0, 2, 0, 1) == [("\x01\x00", 0, 1), ("\x00\x00", 0, 0)]


def test_words_beyond_the_counted_letters(spark, table):
    """Counts beyond what a path can hold: both words have one path."""
    a = "e" * 60_000
    rows = [(1, f"{a} {a} {a} {a}e {a}e {a}e")]
    want = got(variant_groups(table(rows), edit_every=10**12))
    assert {len(w): v[1] for w, v in want.items()} == {60_000: 1, 60_001: 1}
