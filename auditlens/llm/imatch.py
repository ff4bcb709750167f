"""I-Match fingerprints over several randomised lexicons.

The lexicon holds the terms whose document frequency lies in a band: in two
documents at least and in ``MAX_SHARE`` of them at most (a band of inverse
document frequency).  For the upper limit a large class of copies or near
copies counts as one document, so that no group can push its own words out of
the band: rows are classed by four coarse sketches (the four smallest term
hashes in four orders), and each row of a class above ``CLASS_SHARE`` weighs
one over the size of the largest class it is in.  A seeded hash deals all its terms into disjoint slices
of different rates; for each slice the document's terms are sorted and hashed.
A randomised lexicon is all slices but some (``LEXICONS``): it keeps about
70 % of the terms and its fingerprint is the hash of its slices' hashes, so
two texts agree in it if they have the same terms in it.  Each pair of the
dense slices is left out by one lexicon.  The likeness of two fingerprints is
the share of equal slices among those in which either text has a term (dense
slices tell near copies, sparse ones also partial overlap).  A text without
any term of the band is fingerprinted by all its terms instead.

No term of a text is shuffled.  Terms are counted by partial aggregates; those
above the band are few whatever the table's size (their shares of documents
sum up to the mean number of terms of a text) and are put into the plan; those
in a single document go back to that document, and to the one before it, with
the rows of the window that finds the next document.  The half-and-half text
has at most two terms that neither source has, cut at its seams; only those
are joined with the counted terms.  The windows are over ranges of (id, row):
an id that fills more than a range (null ids among them) is cut by its rows'
numbers.  Each range also receives the first document of the following one, so
none spans the table.

Null texts are empty; texts without terms share one fingerprint; repeated ids
are ordered by row; the last document's next is the first, a single one's next
is itself; an empty table gives no rows; columns other than doc_id and text
are not read.
"""

from __future__ import annotations

import random
from collections import Counter
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from auditlens.functions.ordered import count_at_or_below
from auditlens.llm.common import discard, documents, partitions, row_keyed, text_or_empty, written

#: (slices, share of the lexicon in each as a power of 1/2); together they are all of it
SUBSETS = ((7, 3), (6, 6), (8, 8))
MAX_SHARE = 0.05
MIN_DOCS = 2
#: A class with more rows than both counts as one document.
CLASS_SHARE = MAX_SHARE / 10
CLASS_ROWS = 3
#: Orders of the term hashes that rows are classed by, and terms in a sketch.
CLASS_ORDERS = (0, 0x5A17C3E94B2D6F80, 0x33D1E6A80F7B924C, 0x6E4B09D75C83F21A)
CLASS_TERMS = 4
#: Weight of one document.
ONE = 1 << 30
SEED = 9
#: Terms are dealt by 16 bits of their hash.
DEAL = 1 << 16


def subset_bounds(subsets=SUBSETS) -> list[int]:
    """End of each subset's share of the 16-bit deal."""
    out, at = [], 0
    for n, power in subsets:
        for _ in range(n):
            at += DEAL >> power
            out.append(at)
    return out


def lexicons(subsets=SUBSETS, seed: int = SEED) -> list[list[int]]:
    """The slices that each randomised lexicon keeps: all but a pair of the
    dense ones and a seeded choice of 3 in 10 of the others."""
    rng, (dense, _) = random.Random(seed), subsets[0]
    others = range(dense, sum(n for n, _ in subsets))
    return [[i for i in range(dense) if i not in pair] + [i for i in others if rng.random() >= 0.3] for pair in combinations(range(dense), 2)]


LEXICONS = lexicons()


def dealt(term: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(term, F.lit(SEED)), 48)


def pieces_of(text: Column) -> Column:
    return F.split(F.lower(text), r"[^\p{L}\p{N}]+")


def distinct_terms(text: Column) -> Column:
    return F.filter(F.array_distinct(pieces_of(text)), lambda t: t != "")


def place(deal: Column, bounds: list[int]) -> Column:
    """Number of the slice that a term belongs to."""
    return count_at_or_below(deal, bounds[:-1])


def classes(hashes: Column) -> Column:
    """One key for each order of the term hashes: texts with few different
    terms share one at least, others seldom do."""

    def least_in(mask: int) -> Column:
        return F.slice(F.sort_array(F.transform(hashes, lambda h: h.bitwiseXOR(F.lit(mask)))), 1, CLASS_TERMS)

    return F.array(*[F.xxhash64(x, F.lit(i)) for i, x in enumerate(map(least_in, CLASS_ORDERS))])


def with_terms(keyed: DataFrame) -> DataFrame:
    """The rows with ``_t``, their distinct terms, and the hashes ``_h`` of
    these; columns of their own, so that each is made once a pass."""
    return keyed.withColumn("_t", distinct_terms(F.col("text"))).withColumn("_h", F.transform("_t", lambda t: F.xxhash64(t)))


def weighted(keyed: DataFrame) -> tuple[DataFrame, int]:
    """The rows with their terms ``_t`` and weight ``_w``, and the sum of the
    weights.  The class keys are written, so that sizes and weights are counted
    without the texts."""
    n = keyed.count()
    keys = written(with_terms(keyed).select(classes(F.col("_h")).alias("keys")), "imatch-classes")
    large = keys.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(
        (F.col("n") > CLASS_ROWS) & (F.col("n") > F.lit(CLASS_SHARE) * F.lit(n))).collect()  # at most one over the share for each order
    if not large:
        discard(keys)
        return keyed.withColumn("_t", distinct_terms(F.col("text"))).withColumn("_w", F.lit(ONE)), n * ONE
    sizes = F.create_map(*[F.lit(x) for r in large for x in (r["key"], r["n"])])

    def weight(keys_of: Column) -> Column:
        return F.floor(F.lit(ONE) / F.array_max(F.transform(keys_of, lambda k: F.coalesce(F.element_at(sizes, k), F.lit(1).cast("long")))))

    total = keys.agg(F.sum(weight(F.col("keys"))).alias("w")).first()["w"]
    discard(keys)
    return with_terms(keyed).withColumn("_w", weight(classes(F.col("_h")))), total


def vocabulary(rows: DataFrame) -> DataFrame:
    """Each term with its number of rows, their weight and one row that has it."""
    terms = rows.select("_row", "doc_id", "_w", F.explode("_t").alias("term"))
    return terms.groupBy("term").agg(F.count(F.lit(1)).alias("n"), F.sum("_w").alias("w"), F.min("_row").alias("_row"), F.min("doc_id").alias("doc_id"))


def range_cuts(keyed: DataFrame, n_ranges: int) -> list[tuple[float, float]]:
    """Interior ends (id, row), ascending, of about equal ranges of the rows by
    (id, row); at most twice ``n_ranges``.  Null ids count as the lowest."""
    value = F.coalesce(F.col("doc_id").cast("double"), F.lit(float("-inf")))
    ids = keyed.select(value.alias("v"), F.col("_row").cast("double").alias("r"))
    ends = ids.agg(F.percentile_approx("v", [i / n_ranges for i in range(1, n_ranges)], 10000).alias("e")).first()["e"] or []
    times = Counter(ends)
    heavy = [v for v, n in times.items() if n > 1]  # ids that fill a range or more
    cuts = [(v, float("inf")) for v in times]
    if heavy:
        shares = [i / (max(times.values()) + 1) for i in range(1, max(times.values()) + 1)]
        rows = ids.where(F.col("v").isin(heavy)).groupBy("v").agg(F.percentile_approx("r", shares, 10000).alias("r")).collect()  # one row a heavy id
        for found in rows:
            wanted = times[found["v"]]
            cuts += [(found["v"], found["r"][len(shares) * i // (wanted + 1)]) for i in range(1, wanted + 1)]
    return sorted(set(cuts))


def cuts_below(value: Column, row: Column, cuts: list[tuple[float, float]]) -> Column:
    """Number of ``cuts`` strictly below (value, row): a binary search in two
    constant arrays, so that the plan does not grow with the number of cuts
    (the driver holds several copies of it)."""
    if not cuts:
        return F.lit(0)
    values, rows = (F.split(F.lit(",".join(repr(float(c[i])) for c in cuts)), ",").cast("array<double>") for i in (0, 1))
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(cuts).bit_length()))])

    def further(found: Column, step: Column) -> Column:
        v, r = (F.get(x, found + step - 1) for x in (values, rows))  # null beyond the last cut
        return F.when((value > v) | ((value == v) & (row > r)), found + step).otherwise(found)

    return F.aggregate(steps, F.lit(0), further)


def placed_with_rare(keyed: DataFrame, rare: DataFrame):
    """_range, _ghost, _row, doc_id, text and rare (the row's terms of no other
    row) in ascending id order within ranges, and the window over them; the
    first row of the following range comes last in each, as a ghost."""
    cuts = range_cuts(keyed, 4 * partitions(keyed.sparkSession))
    value, row_no = F.coalesce(F.col("doc_id").cast("double"), F.lit(float("-inf"))), F.col("_row").cast("double")
    ranged = lambda df: df.withColumn("_range", cuts_below(value, row_no, cuts))
    order = F.struct("doc_id", "_row")
    firsts = sorted((r["_range"], r["first"]["_row"]) for r in  # one row a range
                    ranged(keyed.select("doc_id", "_row")).groupBy("_range").agg(F.min(order).alias("first")).collect())
    placed = ranged(keyed.select("_row", "doc_id", "text", F.lit(None).cast("array<string>").alias("rare"), F.lit(1).alias("_kind")).unionByName(
        rare.select("_row", "doc_id", F.lit(None).cast("string").alias("text"), "rare", F.lit(0).alias("_kind"))))
    ghosts = keyed.sparkSession.createDataFrame([(row, firsts[i - 1][0]) for i, (_, row) in enumerate(firsts)], "_row LONG, _range INT")
    extra = placed.drop("_range").join(F.broadcast(ghosts), "_row")  # two rows a range
    rows = placed.withColumn("_ghost", F.lit(0)).unionByName(extra.withColumn("_ghost", F.lit(1)))
    w = Window.partitionBy("_range").orderBy("_ghost", F.col("doc_id").asc_nulls_first(), "_row", "_kind")
    none = F.array().cast("array<string>")
    own = F.when((F.lag("_kind").over(w) == 0) & (F.lag("_row").over(w) == F.col("_row")), F.lag("rare").over(w))
    return rows.withColumn("rare", F.coalesce(F.when(F.col("_kind") == 1, own), none)).where("_kind = 1"), w


def slices(terms: Column, bounds: list[int]) -> Column:
    """The terms of each slice, sorted and joined by blanks: one sort of all
    terms with a mark in front of each slice."""
    deals = F.transform(terms, lambda t: F.struct(dealt(t).alias("d"), t.alias("t")))
    dealt_terms = F.transform(deals, lambda x: F.struct(place(x["d"], bounds).alias("p"), x["t"].alias("t")))
    marks = F.array(*[F.struct(F.lit(i).alias("p"), F.lit("").alias("t")) for i in range(len(bounds))])
    line = F.concat_ws(" ", F.transform(F.sort_array(F.concat(dealt_terms, marks)), lambda x: F.when(x["t"] == "", F.lit("\x01")).otherwise(x["t"])))
    return F.transform(F.slice(F.split(line, "\x01"), 2, len(bounds)), lambda p: F.trim(p))


def slice_hashes(sliced: Column, whole: Column) -> Column:
    """One hash for each slice (null where the text has no term in it) and,
    last, ``whole`` where no slice has one."""
    hashes = F.transform(sliced, lambda p: F.when(p != "", F.xxhash64(p)))
    return F.concat(hashes, F.array(F.when(~F.exists(sliced, lambda p: p != ""), whole)))


def lexicon_hashes(fp: Column) -> Column:
    """One hash for each randomised lexicon (null where the text has no term in it)."""
    return F.array(*[F.when(F.coalesce(*[fp[i] for i in kept]).isNotNull(), F.xxhash64(*[fp[i] for i in kept])) for kept in LEXICONS])


def likeness(a: Column, b: Column) -> Column:
    """Share of equal hashes among the places that either has."""
    both = F.arrays_zip(a.alias("x"), b.alias("y"))
    either = F.size(F.filter(both, lambda p: p["x"].isNotNull() | p["y"].isNotNull()))
    same = F.size(F.filter(both, lambda p: p["x"] == p["y"]))
    return F.when(either > 0, same / either).otherwise(F.lit(0.0))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fp, edited_fp and next_fp (arrays of
    slice hashes and, last, of all terms where no slice has one)."""
    bounds = subset_bounds()
    keyed = row_keyed(docs).select("_row", "doc_id", text_or_empty().alias("text"))
    rows, total = weighted(keyed)
    counted = written(vocabulary(rows), "imatch-vocabulary")
    within = F.col("w") <= F.lit(MAX_SHARE) * F.lit(total)
    common = [r["term"] for r in counted.where((F.col("n") >= MIN_DOCS) & ~within).select("term").collect()]  # bounded: see above
    band = counted.where((F.col("n") >= MIN_DOCS) & within).select("term")
    rare = counted.where("n = 1").groupBy("_row").agg(F.min("doc_id").alias("doc_id"), F.collect_list("term").alias("rare"))
    placed, w = placed_with_rare(keyed, rare)

    def kept(terms: Column, without: Column) -> Column:
        return F.array_except(F.filter(terms, lambda t: ~t.isin(common)) if common else terms, without)

    whole = lambda terms: F.xxhash64(F.concat_ws(" ", F.array_sort(terms)))
    own = (placed.withColumn("_t", distinct_terms(F.col("text"))).withColumn("_s", slices(kept(F.col("_t"), F.col("rare")), bounds))
           .withColumn("fp", slice_hashes(F.col("_s"), whole(F.col("_t")))).drop("_t", "_s"))
    pairs = own.select("*", *[F.lead(c).over(w).alias(f"next_{c}") for c in ("text", "rare", "fp")]).where("_ghost = 0")
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    front = F.substring("text", F.lit(1), n - half)
    seams = F.array_distinct(F.array(F.element_at("_p", F.size(pieces_of(front))), F.element_at("_p", F.lit(-1))))
    halves = (pairs.withColumn("_edited", F.concat(front, F.substring("next_text", F.lit(1), half))).withColumn("_p", pieces_of(F.col("_edited")))
              .withColumn("_seams", F.filter(seams, lambda t: t != "")).withColumn("_e", F.filter(F.array_distinct("_p"), lambda t: t != ""))
              .withColumn("_s", slices(kept(F.col("_e"), F.concat("rare", "next_rare", "_seams")), bounds)))
    at = lambda t: place(dealt(t), bounds)
    base = written(halves.select(
        "_row", "doc_id", n.cast("long").alias("n_chars"), F.sha2("_edited", 256).alias("edited_sha256"), "fp", slice_hashes(F.col("_s"), whole(F.col("_e"))).alias("edited_fp"),
        "next_fp", F.transform("_seams", lambda t: F.struct(t.alias("term"), at(t).alias("p"), F.get(F.col("_s"), at(t)).alias("others"))).alias("_seams")), "imatch-base")
    found = (base.select("_row", F.explode("_seams").alias("_x")).select("_row", "_x.*").join(band.hint("merge"), "term")
             .groupBy("_row").agg(F.collect_list(F.struct("term", "p", "others")).alias("_found")))

    def with_seams(h: Column, i: Column) -> Column:
        here = F.filter("_found", lambda x: x["p"] == i)
        terms = F.concat(F.filter(F.split(F.get(here, F.lit(0))["others"], " "), lambda t: t != ""), F.transform(here, lambda x: x["term"]))
        return F.when(F.size(here) > 0, F.xxhash64(F.concat_ws(" ", F.array_sort(terms)))).when(i < len(bounds), h)

    edited = F.when(F.col("_found").isNull(), F.col("edited_fp")).otherwise(F.transform("edited_fp", with_seams))
    return base.join(found.hint("merge"), "_row", "left").select("doc_id", "n_chars", "edited_sha256", "fp", edited.alias("edited_fp"), "next_fp")


def shown(fp: str) -> Column:
    """The hashes of the lexicons, then those of the slices."""
    return F.array_join(F.transform(F.concat(lexicon_hashes(F.col(fp)), F.col(fp)), lambda h: F.lower(F.hex(h))), "-", "")


def op9_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fingerprints(documents(spark, sf_dir))
    return out.select("doc_id", "n_chars", "edited_sha256", shown("fp").alias("fingerprint"), shown("edited_fp").alias("edited_fingerprint"),
                      likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"), likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))
