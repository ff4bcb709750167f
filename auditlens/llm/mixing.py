"""Mixing sources to target weights by entropy balancing.

Targets: sources in code-point order (null last) share the words of all
documents by repeating weights; a source that would need more than ``COPIES``
times its words stops there and the excess is shared again.  That is one level
``k`` with target = least(k * weight, COPIES * words), found by raising ``k``
until no more sources stop; each round is one small aggregate.

Rates: every document gets a rate of 0 to ``COPIES``, as near to 1 as the
targets allow.  Nearness is relative entropy (r ln r - r), weighted per
document by sqrt(size * mean size of its source), under one token constraint a
source: the sum of size * rate is the target.  The convex dual has one
multiplier L a source and the solution is the exponential tilt
rate = least(COPIES, exp(L * z)) with z = sqrt(size / mean size).  All
sources' multipliers are found together by Newton steps, kept in a bracket and
halved where a step leaves it.  Rates depend on source and size only, so a step
is one aggregate over (source, size) counts and a table of one row a source;
sums are exact decimals, so reruns and other partitionings agree.

Copies: rates are rounded by running sums over each source's sizes from large
to small (systematic rounding: whole copies are given out where the running sum
of rates passes a half), which leaves an error of less than one large document
a source.  A last pass takes up to ``SPARE`` documents of every (source, power
of two of size) that can give or take a copy and fits the rest of the error,
large ones first.  ``COPIES`` bounds a document's copies throughout.

Hot (source, size) groups are cut into parts of ``PART`` documents that are
rounded as groups of their own.  Null, empty and blank texts have size 0 and
are taken 0 times; a source without words has target 0; null doc_ids and
repeated rows are documents like others (equal ones may get different numbers
of copies, by one at most); other columns than doc_id, source and text are not
read; a table without words takes nothing, an empty one gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from auditlens.functions.ordered import join_small
from auditlens.llm.common import discard, documents, numbered, written

WEIGHTS, COPIES = (5, 2, 1), 3
#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
PART, SPARE, STEPS = 20_000, 8, 80
#: Rates are kept in billionths, so that their sums are whole numbers.
UNIT = 10**9


def exact(x: Column, places: int = 6) -> Column:
    return x.cast(f"decimal(38,{places})")


def keyed(col: str) -> Column:
    """The column as text that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col(col).cast("string")), F.lit(""))


def size_column(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def document_groups(docs: DataFrame) -> DataFrame:
    """Documents of equal id, source and size as one row: _doc, _key (id and
    source, never null), doc_id, source, size and their number m.  They are
    told apart by nothing that decides, so results do not depend on the order
    of rows."""
    rows = docs.select(keyed("doc_id").alias("_doc"), keyed("source").alias("_key"), "doc_id", "source", size_column().alias("size"))
    return rows.groupBy("_doc", "_key", "size").agg(F.any_value("doc_id").alias("doc_id"), F.any_value("source").alias("source"), F.count(F.lit(1)).alias("m"))


def with_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, copies: int = COPIES) -> DataFrame:
    """Sources (_key, source, source_size, n_docs) with their weight and target."""
    w = F.array(*[F.lit(float(x)) for x in weights])
    ranked = numbered(sources, [F.col("source").asc_nulls_last()], "place").withColumn("weight", F.element_at(w, (F.col("place") % len(weights) + 1).cast("int")))
    cap = F.col("source_size") * float(copies)
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level = None
    while True:
        stops = F.lit(False) if level is None else F.lit(level) * F.col("weight") > cap
        fixed, open_weight = ranked.agg(F.sum(F.when(stops, cap).otherwise(0.0)), F.sum(F.when(stops, 0.0).otherwise(F.col("weight")))).first()
        new = (total - fixed) / open_weight if open_weight else level
        if new is None or (level is not None and new <= level):
            break
        level = new
    level = level or 0.0
    return ranked.select("_key", "source", "source_size", "n_docs", "weight", F.least(F.lit(level) * F.col("weight"), cap).alias("target"))


def rate(multiplier: str | Column, copies: int) -> Column:
    """The tilt of a size; a null multiplier means as many copies as allowed."""
    return F.coalesce(F.least(F.lit(float(copies)), F.exp(F.col(multiplier) * F.col("z"))), F.lit(float(copies)))


def newton(cells: DataFrame, sources: DataFrame, copies: int = COPIES, steps: int = STEPS) -> DataFrame:
    """_key and multiplier of every source from (source, size) counts: one
    aggregate a step for all sources together."""
    wanted = sources.where("source_size > 0")
    state = written(wanted.select("_key", "source_size", "n_docs", "target", F.lit(0.0).alias("at"), F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi"),
                                  (F.col("target") >= F.col("source_size") * float(copies)).alias("full")).withColumn("done", F.col("full")), "multipliers")
    for _ in range(steps):
        if not state.where("not done").limit(1).count():
            break
        live = join_small(cells, state.where("not done").select("_key", (F.col("source_size") / F.col("n_docs")).alias("mean"), "at"), "_key")
        tilt = live.withColumn("z", F.sqrt(F.col("size") / F.col("mean"))).withColumn("r", F.least(F.lit(float(copies)), F.exp(F.col("at") * F.col("z"))))
        mass = F.col("n") * F.col("size") * F.col("r")
        sums = tilt.groupBy("_key").agg(F.sum(exact(mass)).cast("double").alias("value"), F.sum(exact(F.when(F.col("r") < copies, mass * F.col("z")).otherwise(0.0))).cast("double").alias("slope"))
        j = state.join(sums.withColumnRenamed("_key", "_of"), F.col("_key") == F.col("_of"), "left")
        low = F.col("value") < F.col("target")
        lo, hi = F.when(low, F.col("at")).otherwise(F.col("lo")), F.when(low, F.col("hi")).otherwise(F.col("at"))
        step = F.col("at") + F.try_divide(F.col("target") - F.col("value"), F.col("slope"))
        halved = F.when(F.col("new_lo").isNull(), F.col("new_hi") * 2 - 1).when(F.col("new_hi").isNull(), F.col("new_lo") * 2 + 1).otherwise((F.col("new_lo") + F.col("new_hi")) / 2)
        inside = step.isNotNull() & (F.col("new_lo").isNull() | (step > F.col("new_lo"))) & (F.col("new_hi").isNull() | (step < F.col("new_hi"))) & (F.abs(step - F.col("at")) <= F.abs(F.col("at")) + 1)
        hit = F.abs(F.col("value") - F.col("target")) <= F.greatest(F.lit(0.25), F.col("target") * 1e-9)
        nxt = j.withColumn("new_lo", lo).withColumn("new_hi", hi).select(
            "_key", "source_size", "n_docs", "target", F.when(F.col("done") | hit, F.col("at")).when(inside, step).otherwise(halved).alias("at"),
            F.col("new_lo").alias("lo"), F.col("new_hi").alias("hi"), "full", (F.col("done") | hit).alias("done"))
        new = written(nxt, "multipliers")
        discard(state)
        state = new
    return state.select("_key", F.when(~F.col("full"), F.col("at")).alias("multiplier"), (F.col("source_size") / F.col("n_docs")).alias("mean"))


def rounded(parts: DataFrame, multipliers: DataFrame, copies: int = COPIES) -> DataFrame:
    """Parts (_key, size, part, n) with ``base`` copies of every document and
    one more for ``extra`` of them."""
    rated = join_small(parts, multipliers, "_key").withColumn("z", F.sqrt(F.col("size") / F.col("mean")))
    rated = rated.select("_key", "size", "part", "n", F.round(rate("multiplier", copies) * UNIT).cast("decimal(38,0)").alias("rate"),
                         F.floor(F.log2("size")).cast("int").alias("octave"))
    rated = written(rated.withColumn("due", (F.col("n").cast("decimal(18,0)") * F.col("rate")).cast("decimal(38,0)")), "rated")
    # running sums per (source, octave), octaves (at most 32 a source) offset by the larger ones
    octaves = rated.groupBy("_key", "octave").agg(F.sum("due").alias("_due"))
    larger = Window.partitionBy("_key").orderBy(F.col("octave").desc()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = octaves.select("_key", "octave", F.coalesce(F.sum("_due").over(larger), F.lit(0)).alias("_before"))
    w = Window.partitionBy("_key", "octave").orderBy(F.col("size").desc(), "part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = rated.join(offsets, ["_key", "octave"]).withColumn("_upto", (F.col("_before") + F.sum("due").over(w)).cast("decimal(38,0)"))
    whole = lambda x: F.expr(f"({x} + {UNIT // 2}) div {UNIT}")
    given = summed.withColumn("_given", whole("_upto") - whole("(_upto - due)")).withColumn("base", F.expr(f"rate div {UNIT}"))
    return given.select("_key", "size", "part", "base", (F.col("_given") - F.col("n") * F.col("base")).alias("extra"))


def fit_rest(group):
    """Of one source's spare documents, those that give or take a copy so that
    the error left is as small as large-first choice makes it."""
    import pandas as pd

    rest = int(group["rest"].iat[0])
    left, chosen = abs(rest), []
    for row in group.sort_values(["size", "h", "_doc", "chunk"], ascending=[False, True, True, True]).itertuples():
        if row.size <= left:
            left -= row.size
            chosen.append((row._1, row._2, row.size, row.chunk, 1 if rest > 0 else -1))
    return pd.DataFrame(chosen, columns=["_doc", "_key", "size", "chunk", "change"])


def mixed_groups(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, copies: int = COPIES) -> tuple[DataFrame, DataFrame]:
    """Document groups (cut into chunks of ``PART``) with the copies k that
    their m documents take together, and the sources with their targets."""
    groups = written(document_groups(docs), "mix-groups")
    cells = written(groups.where("size > 0").groupBy("_key", "size").agg(F.sum("m").alias("n")), "mix-cells")
    per = groups.groupBy("_key").agg(F.any_value("source").alias("source"), F.sum(F.col("size") * F.col("m")).alias("source_size"), F.sum(F.when(F.col("size") > 0, F.col("m")).otherwise(0)).alias("n_docs"))
    sources = written(with_targets(written(per, "mix-sources"), weights, copies), "mix-targets")
    multipliers = newton(cells, sources, copies)
    # hot (source, size) cells are rounded in parts
    large = cells.where(F.col("n") > PART).select("_key", "size", F.ceil(F.col("n") / PART).alias("parts"))
    chunked = groups.withColumn("chunk", F.explode(F.expr(f"sequence(0L, (m - 1) div {PART})"))).withColumn("m", F.least(F.col("m") - F.col("chunk") * PART, F.lit(PART).cast("long")))
    h = F.xxhash64("_doc", "chunk")
    dealt = join_small(chunked.withColumn("h", h), large, ["_key", "size"], "left")
    dealt = written(dealt.withColumn("part", F.coalesce(F.pmod("h", "parts"), F.lit(0).cast("long"))).drop("parts"), "mix-dealt")
    parts = dealt.where("size > 0").groupBy("_key", "size", "part").agg(F.sum("m").alias("n"))
    upto = F.sum("m").over(Window.partitionBy("_key", "size", "part").orderBy("h", "_doc", "chunk").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    more = F.greatest(F.lit(0), F.least(F.col("m"), F.col("extra") - (F.col("upto") - F.col("m"))))
    first = dealt.join(rounded(parts, multipliers, copies), ["_key", "size", "part"]).withColumn("upto", upto).withColumn("k", F.col("m") * F.col("base") + more)
    first = written(first.select("_doc", "_key", "size", "chunk", "m", "h", "k"), "mix-copies")
    got = first.groupBy("_key").agg(F.sum(F.col("k") * F.col("size")).alias("got"))
    rest = sources.join(got, "_key").select("_key", F.round(F.col("target") - F.col("got")).cast("long").alias("rest")).where("rest <> 0")
    can = F.when(F.col("rest") > 0, F.col("k") < copies * F.col("m")).otherwise(F.col("k") > 0) & (F.col("size") <= F.abs("rest"))
    some = Window.partitionBy("_key", "octave").orderBy("h", "_doc", "chunk")
    spare = (join_small(first, rest, "_key").where(can).select("_doc", "_key", "size", "chunk", "h", "rest", F.floor(F.log2("size")).alias("octave"))
             .withColumn("nth", F.row_number().over(some)).where(F.col("nth") <= SPARE))
    change = spare.select("_doc", "_key", "size", "chunk", "h", "rest").groupBy("_key").applyInPandas(fit_rest, "_doc string, _key string, size long, chunk long, change long")
    final = join_small(first, change, ["_doc", "_key", "size", "chunk"], "left").select("_doc", "_key", "size", "chunk", (F.col("k") + F.coalesce("change", F.lit(0))).alias("k"))
    out = dealt.join(final.hint("merge"), ["_doc", "_key", "size", "chunk"], "left").withColumn("k", F.coalesce("k", F.lit(0).cast("long")))
    return out.select("_doc", "_key", "size", "chunk", "doc_id", "source", "m", "k"), sources


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, copies: int = COPIES) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken, one row a
    document."""
    groups, sources = mixed_groups(docs, weights, copies)
    each = groups.withColumn("nth", F.explode(F.expr("sequence(1L, m)"))).withColumn("copies", F.expr("k div m + if(nth <= k % m, 1, 0)"))
    return join_small(each, sources.select("_key", "source_size", "target"), "_key").select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, copies: int = COPIES) -> DataFrame:
    """The mixture: every document with all its columns as often as it is
    taken, and ``_copy`` from 1."""
    groups, _ = mixed_groups(docs, weights, copies)
    held = written(docs.withColumns({"_doc": keyed("doc_id"), "_key": keyed("source"), "_size": size_column(), "_row": F.monotonically_increasing_id()}), "mix-texts")
    # the place of a document among those of its group decides which copies it gets
    placed = numbered(held.select("_doc", "_key", "_size", "_row"), [F.col(c).asc() for c in ("_doc", "_key", "_size", "_row")], "place")
    whole = groups.groupBy("_doc", "_key", F.col("size").alias("_size")).agg(F.sum("m").alias("m"), F.sum("k").alias("k")).where("k > 0")
    starts = placed.groupBy("_doc", "_key", "_size").agg(F.min("place").alias("start"))
    on = ["_doc", "_key", "_size"]
    given = placed.join(whole.join(starts, on).hint("merge"), on).withColumn("_times", F.expr("k div m + if(place - start < k % m, 1, 0)")).where("_times > 0")
    return (held.join(given.select("_row", "_times").hint("merge"), "_row").withColumn("_copy", F.explode(F.expr("sequence(1L, _times)")))
            .select(*docs.columns, "_copy"))


def op13_entropy_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir))
