"""Exact order statistics from mergeable sketches and exact brackets.

A KLL sketch a group (combined map-side, a few ten KB whatever the input) gives
for every wanted rank a bracket of values that holds it.  One more pass counts
the values below and between the brackets and, by value, those inside; the
wanted values are then read off exactly.  Where a bracket of a very large group
would still hold more than ``WITHIN`` values, it is narrowed first by a sketch
of its own content (each such pass divides it by about fifty).  Nothing is
written but one row a group and bracket, and of a group only the values inside
its brackets (``WITHIN`` a bracket) meet in a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auditlens.functions.ordered import join_small, materialize

SKETCH, WITHIN, GRID = 4096, 100_000, 64


def sketch_error(k: int) -> float:
    """Rank error of a sketch of size k, with half as much again to spare."""
    return 1.5 * 2.296 / k**0.9021


def _cells(values: DataFrame, brackets: DataFrame, groups: list[str]) -> DataFrame:
    """Each value's cell (number of brackets that end below it) and whether it
    lies in that cell's bracket."""
    b = brackets.select(*groups, "_los", "_his")
    j = join_small(values, b, groups) if groups else values.crossJoin(F.broadcast(b))  # one row without groups
    cell = F.size(F.filter("_his", lambda h: h < F.col("_v")))
    return j.withColumn("_cell", cell).withColumn("_in", F.coalesce(F.get("_los", F.col("_cell")) <= F.col("_v"), F.lit(False))).drop("_los", "_his")


def _offsets(per_cell: DataFrame, groups: list[str], n: str) -> Column:
    """Values in the cells before, over a table of one row a group and cell."""
    return F.coalesce(F.sum(n).over(Window.partitionBy(*groups).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _narrowed(values: DataFrame, brackets: DataFrame, wanted: DataFrame, groups: list[str], k: int) -> DataFrame:
    """Brackets cut down by sketches of what they hold; a group whose sketch
    missed a wanted rank falls back to one bracket over everything."""
    inside = F.when(F.col("_in"), F.col("_v"))
    cells = _cells(values, brackets, groups).groupBy(*groups, "_cell").agg(
        F.count(F.lit(1)).alias("_n"), F.count(inside).alias("_n_in"), F.kll_sketch_agg_double(inside, F.lit(k)).alias("_sketch"))
    cells = materialize(cells)
    at = cells.withColumn("_from", _offsets(cells, groups, "_n") + F.col("_n") - F.col("_n_in")).where("_n_in > 0")
    grid = F.kll_sketch_get_quantile_double("_sketch", F.array(*[F.lit(i / GRID) for i in range(GRID + 1)]))
    at = at.select(*groups, "_cell", "_from", "_n_in", grid.alias("_grid"))
    held = (F.floor("pos") >= F.col("_from")) & (F.ceil("pos") < F.col("_from") + F.col("_n_in"))
    hit = (wanted.join(at, groups) if groups else wanted.crossJoin(at)).where(held)
    slack = sketch_error(k) * GRID
    lo = F.greatest(F.lit(0.0), F.floor((F.floor("pos") - F.col("_from")) * GRID / F.col("_n_in") - slack)).cast("int")
    hi = F.least(F.lit(float(GRID)), F.ceil((F.ceil("pos") + 1 - F.col("_from")) * GRID / F.col("_n_in") + slack)).cast("int")
    new = hit.groupBy(*groups).agg(F.count(F.lit(1)).alias("_hits"), F.array_sort(F.collect_list(F.get("_grid", lo))).alias("_l"), F.array_sort(F.collect_list(F.get("_grid", hi))).alias("_h"))
    need = wanted.groupBy(*groups).agg(F.count(F.lit(1)).alias("_need"))
    j = brackets.select(*groups, "n").join(need, groups, "left").join(new, groups, "left") if groups else brackets.select("n").crossJoin(need).crossJoin(new)
    whole = F.coalesce(F.col("_hits") < F.col("_need"), F.col("_need") > 0)
    return materialize(j.select(*groups, "n", F.when(whole, F.array(F.lit(float("-inf")))).otherwise(F.col("_l")).alias("_los"),
                                F.when(whole, F.array(F.lit(float("inf")))).otherwise(F.col("_h")).alias("_his")))


def order_statistics(df: DataFrame, value: str, wanted: list[tuple[str, float, Column]], groups: list[str] | tuple = (),
                     k: int = SKETCH, within: int = WITHIN) -> DataFrame:
    """For every group and wanted (name, about which share of the rows, exact
    0-based place as a column of ``n``): ``*groups, name, n, pos, q, below``.

    ``q`` is the value at the place (between two places interpolated linearly)
    and ``below`` the number of values smaller than it.  Null and NaN values do
    not count; places outside a group have null ``q``; groups must not be null.
    ``df`` is read twice (more often for groups of many millions)."""
    g = list(groups)
    values = df.select(*g, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    sketches = values.groupBy(*g).agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("_v", F.lit(k)).alias("_sketch")).where("n > 0")
    e = sketch_error(k)
    shares = sorted(p for _, p, _ in wanted)
    few = F.col("n") <= within
    at = lambda sign: F.kll_sketch_get_quantile_double("_sketch", F.array(*[F.lit(min(1.0, max(0.0, p + sign * e))) for p in shares]))
    brackets = materialize(sketches.select(*g, "n", F.when(few, F.array(F.lit(float("-inf")))).otherwise(at(-1)).alias("_los"),
                                           F.when(few, F.array(F.lit(float("inf")))).otherwise(at(1)).alias("_his")))
    places = F.array(*[F.struct(F.lit(name).alias("name"), pos.cast("double").alias("pos")) for name, _, pos in wanted])
    asked = brackets.select(*g, "n", F.explode(places).alias("_w")).select(*g, "n", "_w.name", "_w.pos")
    real = asked.where("pos >= 0 and pos <= n - 1")
    held = 2 * e * (brackets.agg(F.max("n")).first()[0] or 0)
    while held > within:
        brackets = _narrowed(values, brackets, real, g, k)
        held *= 2 / GRID + 2 * e
    runs = _cells(values, brackets, g).groupBy(*g, "_cell", F.when(F.col("_in"), F.col("_v")).alias("_x")).agg(F.count(F.lit(1)).alias("_c"))
    # at most WITHIN values a bracket: a group's runs are few enough for one ordered pass
    upto = F.sum("_c").over(Window.partitionBy(*g).orderBy("_cell", F.col("_x").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    runs = runs.withColumn("_to", upto).where("_x is not null").select(*g, "_x", (F.col("_to") - F.col("_c")).alias("_from"), "_to")
    lo, hi = ((F.col("_from") <= f("pos")) & (f("pos") < F.col("_to")) for f in (F.floor, F.ceil))
    # the wanted places (one row a group and name) meet the runs of their brackets
    places = real.select(*g, "name", "pos")
    hit = (join_small(runs, places, g) if g else runs.crossJoin(F.broadcast(places))).where(lo | hi)
    found = hit.groupBy(*g, "name", "pos").agg(F.max(F.when(lo, F.col("_x"))).alias("_x_lo"), F.max(F.when(hi, F.col("_x"))).alias("_x_hi"),
                                               F.max(F.when(lo, F.col("_from"))).alias("_f_lo"), F.max(F.when(hi, F.col("_from"))).alias("_f_hi"))
    q = F.col("_x_lo") + (F.col("pos") - F.floor("pos")) * (F.col("_x_hi") - F.col("_x_lo"))
    found = found.select(*g, "name", q.alias("q"), F.when(q == F.col("_x_lo"), F.col("_f_lo")).otherwise(F.col("_f_hi")).alias("below"))
    return asked.join(found, [*g, "name"], "left").select(*g, "name", "n", "pos", "q", "below")


def quantiles(df: DataFrame, value: str, probs: list[float], groups: list[str] | tuple = (), k: int = SKETCH, within: int = WITHIN) -> DataFrame:
    """Exact quantiles with linear interpolation: ``*groups, p, q, below, n``."""
    wanted = [(repr(float(p)), float(p), F.lit(float(p)) * (F.col("n") - 1)) for p in probs]
    return order_statistics(df, value, wanted, groups, k, within).select(*groups, F.col("name").cast("double").alias("p"), "q", "below", "n")
