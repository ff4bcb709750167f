"""Spelling variant grouping by a frequency-vector trie.

A word's path in the trie is the number of its letters in each of the
successive letter groups ``GROUPS``.  Two words at an edit distance of one
have paths that differ by one surplus (an inserted letter), by one surplus and
one deficit (a replaced letter) or not at all (a letter replaced by one of its
group).  So a depth-first search that may spend one surplus and one deficit
reaches every near word's leaf, and the words of that leaf are verified.  A
node with few words is a leaf at once; it bursts into children when it fills.
Every near pair is met once, from the word whose (path, word) is smaller: its
first differing group then has the surplus, so deficits come second.

The trie is cut into subtries that fit a task.  Words are keyed by the first
levels of their path; where a key holds more than ``SUBTRIE`` words its words go
on to a deeper cut.  Searches walk the same cuts and spend their budget on the
way, so a search becomes a handful of rows (subtrie, budget left) and meets the
subtrie in one cogrouped task.  Subtries with many searches are copied for
bounded shares of them (``ASKED``), and words that share a whole path are dealt
into bounded shares as well, so what a task holds is bounded.

Runs of letters are counted in the tasks that read the texts and summed by
word; only distinct words move.  Null and empty texts have no words; a null
doc_id is written as nothing before the colon; repeated rows count each; an
empty table gives no rows; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlens.functions.ordered import join_small
from auditlens.llm.common import discard, documents, written

MIN_LENGTH, MIN_COUNT, EDIT_EVERY, FORM_RATIO = 5, 3, 97, 2
#: Letters of a trie level, from the more to the less telling ones.
GROUPS = ("e", "a", "i", "n", "r", "t", "o", "s", "l", "u", "d", "c", "m", "p", "gq", "bx", "vj", "hz", "fw", "ky",
          "À-Ï", "Ð-ß", "à-ï", "ð-ÿ")
#: Levels after which the trie may be cut.
CUTS = (3, 5, 8, 12, 18, len(GROUPS))
#: Words of a subtrie, and searches that one copy of it answers.
SUBTRIE, ASKED = 16_384, 65_536
#: Distinct words that a task holds before it passes them on.
HELD = 400_000
#: Entries of a leaf before it bursts.
FEW = 12

# ---------------------------------------------------------------- words

def letter_runs(text: str, min_length: int) -> list[str]:
    """Maximal runs of letters with A-Z in lower case, long enough ones only."""
    low = text.encode().lower().decode()  # bytes.lower changes A-Z alone
    return re.findall(f"[a-zÀ-ÿ]{{{min_length},}}", low)


def edited(run: str, h: int, every: int) -> str:
    """``run`` without its code point h % length, where ``every`` divides h."""
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, edit_every: int = EDIT_EVERY) -> DataFrame:
    """word and n of every distinct result of enough letters and occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            return pa.RecordBatch.from_arrays([pa.array(totals.keys(), pa.string()), pa.array(totals.values(), pa.int64())], ["word", "n"])

        totals: Counter[str] = Counter()
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not text:
                    continue
                seed = crc32(f"{doc}:".encode())
                for word, n in Counter(letter_runs(text, min_length)).items():
                    h = crc32(word.encode(), seed)
                    if h % edit_every == 0:
                        word = edited(word, h, edit_every)
                        if len(word) < min_length:
                            continue
                    totals[word] += n
                if len(totals) > HELD:
                    yield rows()
                    totals = Counter()
        yield rows()

    texts = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), "text")
    return texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# ---------------------------------------------------------------- trie

def levels() -> dict[str, int]:
    """letter -> level."""
    out = {}
    for at, group in enumerate(GROUPS):
        lo, _, hi = group.partition("-")
        out |= dict.fromkeys(map(chr, range(ord(lo), ord(hi) + 1)) if hi else group, at)
    return out


_LEVELS = levels()
#: Counts are characters of the path; a count beyond this bound (no character stands for it) is kept as the bound.
MOST = 0xD000


def path_of(word: str) -> str:
    """The counts of a word's letters by group, one character each, so that
    paths compare as their counts do."""
    counts = [0] * len(GROUPS)
    for c in word:
        counts[_LEVELS[c]] += 1
    return "".join(map(chr, counts)) if len(word) <= MOST else "".join([chr(min(c, MOST)) for c in counts])


def with_paths(words: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = pa.array(map(path_of, batch.column(0).to_pylist()), pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, paths], ["word", "n", "path"])

    return words.select("word", "n").mapInArrow(run, "word string, n long, path string")


def steps(path: str, lo: int, hi: int, surplus: int, deficit: int) -> list[tuple[str, int, int]]:
    """Ways through levels lo to hi within the budget: (counts, surplus left,
    deficit left).  A deficit may be spent only after the surplus."""
    ways = [(path[lo:hi], surplus, deficit)]
    for i in range(lo, hi):
        if surplus:
            more = path[lo:i] + chr(ord(path[i]) + 1)
            ways.append((more + path[i + 1:hi], 0, deficit))
            if deficit:
                ways += [(more + path[i + 1:j] + chr(ord(path[j]) - 1) + path[j + 1:hi], 0, 0) for j in range(i + 1, hi) if path[j] > "\0"]
        elif deficit and path[i] > "\0":
            ways.append((path[lo:i] + chr(ord(path[i]) - 1) + path[i + 1:hi], 0, 0))
    return ways


def advance(searches: DataFrame, lo: int, hi: int) -> DataFrame:
    """Searches at the cut ``lo`` (their node and budget) taken to cut ``hi``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            take, nodes, s_left, d_left = [], [], [], []
            rows = [batch.column(name).to_pylist() for name in ("path", "node", "surplus", "deficit")]
            for i, (path, node, s, d) in enumerate(zip(*rows, strict=True)):
                for counts, s1, d1 in steps(path, lo, hi, s, d):
                    take.append(i)
                    nodes.append(node + counts)
                    s_left.append(s1)
                    d_left.append(d1)
            out = batch.select(["word", "n", "path"]).take(pa.array(take, pa.int64()))
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(nodes, pa.string()), pa.array(s_left, pa.int8()), pa.array(d_left, pa.int8())],
                                             ["word", "n", "path", "node", "surplus", "deficit"])

    return searches.mapInArrow(run, "word string, n long, path string, node string, surplus byte, deficit byte")


def cut_trie(words: DataFrame, limit: int) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """The words with their subtrie (node, as long as its depth), the searches
    with the subtries they enter, and the written tables both are read from."""
    one = F.lit(1).cast("byte")
    searches = words.select("word", "n", "path", F.lit("").alias("node"), one.alias("surplus"), one.alias("deficit"))
    left, lo, placed, entering, kept = words, 0, [], [], []
    for depth in CUTS:
        left = left.withColumn("node", F.substring("path", 1, depth))
        searches = advance(searches, lo, depth)
        full = None
        if depth < CUTS[-1]:
            full = written(left.groupBy("node").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > limit).select("node"), "trie-full")
            kept.append(full)
        if full is None or not full.limit(1).count():
            placed.append(left)
            entering.append(searches)
            break
        marked = full.withColumn("goes_on", F.lit(True))
        left = written(join_small(left, marked, "node", "left"), "trie-words")
        searches = written(join_small(searches, marked, "node", "left"), "trie-searches")
        kept += [left, searches]
        placed.append(left.where("goes_on is null").drop("goes_on"))
        entering.append(searches.where("goes_on is null").drop("goes_on"))
        left, searches, lo = left.where("goes_on").drop("goes_on", "node"), searches.where("goes_on").drop("goes_on"), depth
    return union_all(placed), union_all(entering), kept


def union_all(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    return whole


class Leaf:
    """Few words, or all words of one whole path."""

    __slots__ = ("entries", "halves")

    def __init__(self, entries):
        self.entries: list[tuple[str, str, int]] = entries  # path, word, n
        self.halves: dict = {}

    def maybe(self, a: str):
        """Entries that may be one edit away from ``a``."""
        if len(self.entries) <= 4 * FEW:
            return self.entries
        # words of one path have one length; the edit lies in one half, so the other half is equal
        longer, h = len(self.entries[0][1]) - len(a), len(a) // 2
        if longer not in (0, 1):
            return self.entries  # only counts beyond MOST
        if longer not in self.halves:
            first, second = {}, {}
            for e in self.entries:
                first.setdefault(e[1][:h], []).append(e)
                second.setdefault(e[1][h + longer:], []).append(e)
            self.halves[longer] = first, second
        first, second = self.halves[longer]
        return [*first.get(a[:h], ()), *(e for e in second.get(a[h:], ()) if e[1][:h] != a[:h])]


def one_edit(a: str, b: str) -> bool:
    """The edit distance of a and b is exactly one."""
    longer = len(b) - len(a)
    if longer < 0:
        a, b, longer = b, a, -longer
    if longer > 1:
        return False
    at = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            return a[at + 1 - longer:] == b[at + 1:]
        at += 1
    return longer == 1  # inserted at the end; else equal


def build(entries, depth: int) -> dict | Leaf:
    """The subtrie below a cut: nested dicts of counts down to leaves."""
    if len(entries) <= FEW or depth == len(GROUPS):
        return Leaf(entries)
    children: dict[str, list] = {}
    for e in entries:
        children.setdefault(e[0][depth], []).append(e)
    return {c: build(part, depth + 1) for c, part in children.items()}


def leaves(root: dict | Leaf, path: str, depth: int, surplus: int, deficit: int) -> list[Leaf]:
    """Depth-first search: the leaves within the budget."""
    out, stack = [], [(root, depth, surplus, deficit)]
    while stack:
        node, at, s, d = stack.pop()
        if node.__class__ is Leaf:
            out.append(node)
            continue
        c = path[at]
        if c in node:
            stack.append((node[c], at + 1, s, d))
        if s:
            up = chr(ord(c) + 1)
            if up in node:
                stack.append((node[up], at + 1, 0, d))
        elif d and c > "\0":
            down = chr(ord(c) - 1)
            if down in node:
                stack.append((node[down], at + 1, 0, 0))
    return out


def search(trie: pa.Table, searches: pa.Table) -> pa.Table:
    """Near pairs of one subtrie, each in both directions: word, near, near_n."""
    words, nears, ns = [], [], []
    if trie.num_rows and searches.num_rows:
        depth = len(trie["node"][0].as_py())
        root = build(list(zip(*(trie[c].to_pylist() for c in ("path", "word", "n")), strict=True)), depth)
        found: dict[tuple, list[Leaf]] = {}
        for a, n, path, s, d in zip(*(searches[c].to_pylist() for c in ("word", "n", "path", "surplus", "deficit")), strict=True):
            key = (path, s, d)
            if key not in found:
                found[key] = leaves(root, path, depth, s, d)
            size = len(a)
            for leaf in found[key]:
                for other, b, m in leaf.maybe(a):
                    if -2 < len(b) - size < 2 and (path < other or (path == other and a < b)) and one_edit(a, b):
                        words += (a, b)
                        nears += (b, a)
                        ns += (m, n)
    return pa.table({"word": pa.array(words, pa.string()), "near": pa.array(nears, pa.string()), "near_n": pa.array(ns, pa.int64())})


def near_pairs(words: DataFrame, limit: int = SUBTRIE, asked: int = ASKED) -> tuple[DataFrame, list[DataFrame]]:
    """word, near, near_n for every two words at an edit distance of one (each
    pair in both directions), and the written tables it is read from."""
    trie, searches, kept = cut_trie(words, limit)
    searches = written(searches, "trie-entering")
    shares = lambda df, most, out: df.groupBy("node").agg(F.ceil(F.count(F.lit(1)) / most).alias(out)).where(f"{out} > 1")
    one = F.lit(1).cast("long")
    dealt = written(shares(trie, limit, "t").join(shares(searches, asked, "s"), "node", "full").select("node", F.coalesce("t", one).alias("t"), F.coalesce("s", one).alias("s")), "trie-shares")
    h = F.xxhash64("word")

    def with_shares(rows: DataFrame) -> DataFrame:
        return join_small(rows, dealt, "node", "left").withColumns({"t": F.coalesce("t", one), "s": F.coalesce("s", one)})

    subtries = with_shares(trie).select("word", "n", "path", "node", F.pmod(h, "t").alias("t"), F.explode(F.expr("sequence(0L, s - 1)")).alias("s"))
    entering = with_shares(searches).select("word", "n", "path", "surplus", "deficit", "node", F.explode(F.expr("sequence(0L, t - 1)")).alias("t"), F.pmod(h, "s").alias("s"))
    pairs = subtries.groupBy("node", "t", "s").cogroup(entering.groupBy("node", "t", "s")).applyInArrow(search, "word string, near string, near_n long")
    return pairs, [*kept, searches, dealt]


# ---------------------------------------------------------------- forms

def roots(forms: DataFrame) -> DataFrame:
    """word and root of every word that has a form, by pointer jumping (a form
    has at least twice the word's count, so there are no circles)."""
    now = written(forms.where("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        up = now.select(F.col("word").alias("up"), F.col("root").alias("top"))
        new = written(now.join(up.hint("merge"), now["root"] == up["up"], "left").select("word", F.coalesce("top", "root").alias("root"), F.col("top").isNotNull().alias("moved")), "roots")
        moved = new.where("moved").limit(1).count()
        discard(now)
        now = new
        if not moved:
            return now.select("word", "root")


def variant_groups(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, edit_every: int = EDIT_EVERY, ratio: int = FORM_RATIO, limit: int = SUBTRIE, asked: int = ASKED) -> DataFrame:
    """word, n, n_near, form, form_n and root of every word."""
    words = written(with_paths(word_counts(docs, min_length, min_count, edit_every)), "words")
    pairs, kept = near_pairs(words, limit, asked)
    best = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("k"), "near")).alias("best"))
    has_form = -F.col("best.k") >= ratio * F.col("n")
    forms = written(words.select("word", "n").join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(has_form, F.col("best.near")).alias("form"), F.when(has_form, -F.col("best.k")).alias("form_n")), "forms")
    discard(words, *kept)
    return forms.join(roots(forms), "word", "left").withColumn("root", F.coalesce("root", "word"))


def op11_frequency_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variant_groups(documents(spark, sf_dir)).select("word", "form", "root", "n", "n_near", "form_n")
