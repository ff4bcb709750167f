"""Distributed ordered computations: running totals, exact quantiles,
threshold sweeps.

A cumulative window with no partition key moves every row into one task.
These helpers keep such work distributed:

* values are range-bucketed on approximate quantile edges (a bounded list of
  ``n_buckets`` numbers, the only thing that reaches the driver);
* per-bucket totals (≤ groups × buckets rows) give each bucket its offset;
* the running sum inside a bucket is an ordinary window partitioned by
  (group keys, bucket), so each task holds about rows / buckets rows.

A hot value or group is a single row once the input is aggregated on
(group, value), so skew cannot pile rows into one task.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Different values of a group that are ordered in one piece.
WHOLE_GROUP = 100_000


def default_buckets(df: DataFrame) -> int:
    try:
        n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    except Exception:  # pragma: no cover
        n = 200
    return max(8, 2 * n)


def range_edges(df: DataFrame, col: str, n_buckets: int, accuracy: int = 10000) -> list[float]:
    """Approximate interior quantile edges of ``col`` (bounded list)."""
    if n_buckets <= 1:
        return []
    probs = [i / n_buckets for i in range(1, n_buckets)]
    row = df.agg(F.percentile_approx(F.col(col).cast("double"), probs, accuracy).alias("e")).first()
    edges = row["e"] if row is not None else None
    return sorted(set(e for e in (edges or []) if e is not None))


def count_below(value: Column, edges: list[float]) -> Column:
    """Number of ``edges`` strictly below ``value`` as a balanced CASE tree
    (log2(len(edges)) comparisons per row, stays in codegen)."""

    def build(lo: int, hi: int) -> Column:
        if lo >= hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(value > F.lit(float(edges[mid])), build(mid + 1, hi)).otherwise(build(lo, mid))

    return build(0, len(edges))


def count_at_or_below(value: Column, points: list[float]) -> Column:
    """Number of sorted ``points`` that are <= ``value`` (CASE tree)."""

    def build(lo: int, hi: int) -> Column:
        if lo >= hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(value >= F.lit(float(points[mid])), build(mid + 1, hi)).otherwise(build(lo, mid))

    return build(0, len(points))


def materialize(df: DataFrame) -> DataFrame:
    """Write an (aggregated) intermediate as Parquet below the shared
    checkpoint folder and read it back, cutting its lineage, so that the
    edge-sampling job and the main job do not both recompute the upstream
    plan.  Files in the shared folder survive executor loss."""
    import uuid

    from auditlens.session import scratch_path
    path = scratch_path(df.sparkSession, f"mat-{uuid.uuid4().hex}")
    with shuffles_dropped(df.sparkSession):
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


@contextmanager
def shuffles_dropped(spark):
    """The shuffle files of what is written inside are deleted as each write
    ends; left to itself Spark keeps them until its driver collects garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def forget(df: DataFrame) -> None:
    """Deletes what ``materialize`` wrote for ``df``, once no result will read it."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if path.rsplit("/", 1)[1].startswith("mat-"):
            delete_folder(df.sparkSession.sparkContext, path)


def delete_folder(sc, path: str) -> None:
    """Deletes a written intermediate, wherever the shared folder is."""
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)


def written_spread(df: DataFrame) -> DataFrame:
    """``df`` written in files for all cores.  What comes in fewer files is
    dealt and written again; larger data, which has them, is not shuffled."""
    once = materialize(df)
    if len(once.inputFiles()) >= _wide(df.sparkSession):
        return once
    again = materialize(spread(once))
    forget(once)
    return again


def _wide(spark) -> int:
    return max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt evenly over all cores.  Rows that are cheap to hold and dear
    to work on (a fit reads them in every iteration) otherwise stay in the few
    partitions that adaptive execution makes by bytes."""
    return df.repartition(_wide(df.sparkSession))


def running_totals(df: DataFrame, order_col: str, sum_cols: list[str],
                   partition_cols: list[str] | tuple = (), prefix: str = "cum_",
                   n_buckets: int | None = None, checkpoint: bool = True,
                   totals: list[str] | tuple = (), keep_bucket: bool = False) -> DataFrame:
    """Add ``cum_<c>`` = sum of ``c`` over rows of the same partition whose
    ``order_col`` is <= the current one (ties included), and ``all_<c>`` = the
    partition's total for each column of ``totals``.

    Totals travel in the bucket-offset table (at most partitions x buckets
    rows), so rows meet them on (partition, bucket) and never on the partition
    alone.  ``keep_bucket`` leaves the bucket number as ``_rb``.
    Null ``order_col`` rows are dropped; partition keys must be non-null.
    The input should already be aggregated on (partition, order value).
    """
    pcols = list(partition_cols)
    b = n_buckets or default_buckets(df)
    base = df.where(F.col(order_col).isNotNull())
    if checkpoint:
        base = materialize(base)
    edges = range_edges(base, order_col, b)
    tmp = base.withColumn("_rb", count_below(F.col(order_col).cast("double"), edges))
    per = tmp.groupBy(*pcols, "_rb").agg(*[F.sum(c).alias(f"_t_{c}") for c in dict.fromkeys([*sum_cols, *totals])])
    w_prev = Window.partitionBy(*pcols).orderBy("_rb").rowsBetween(Window.unboundedPreceding, -1)
    w_all = Window.partitionBy(*pcols)
    offsets = per.select(*pcols, "_rb",
                         *[F.coalesce(F.sum(f"_t_{c}").over(w_prev), F.lit(0)).alias(f"_o_{c}") for c in sum_cols],
                         *[F.sum(f"_t_{c}").over(w_all).alias(f"all_{c}") for c in totals])
    if not pcols:
        offsets = F.broadcast(offsets)  # at most len(edges)+1 rows
    joined = tmp.join(offsets, [*pcols, "_rb"], "inner")
    w_in = (Window.partitionBy(*pcols, "_rb").orderBy(order_col)
            .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    out = joined
    for c in sum_cols:
        out = out.withColumn(f"{prefix}{c}", F.col(f"_o_{c}") + F.sum(c).over(w_in))
    return out.drop(*([] if keep_bucket else ["_rb"]), *[f"_o_{c}" for c in sum_cols])


def numbered(df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """``df`` with gapless places from 0 in the order given.

    Rows are range partitioned, sorted and written once; a row's place is its
    place within its partition plus the sizes of the partitions before (one row
    each, so the broadcast table is as long as the number of partitions set).
    ``df`` is read twice (once to find the ranges) and should be written or small."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = materialize(df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()))
    rows = placed.withColumn("_part", F.shiftrightunsigned("_id", 33))  # the partition is in the id's upper bits
    sizes = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return rows.join(F.broadcast(before), "_part").withColumn(out, F.col("_before") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))).drop("_part", "_before", "_id")


def with_group_total(df: DataFrame, keys: list[str] | tuple, value, out: str) -> DataFrame:
    """Add the sum of ``value`` per key group to rows that carry ``_rb``:
    bucket sums first, their total over the small table, then a join on
    (group, bucket)."""
    k = list(keys)
    per = df.groupBy(*k, "_rb").agg(F.sum(value).alias("_s"))
    tot = per.select(*k, "_rb", F.sum("_s").over(Window.partitionBy(*k)).alias(out))
    return df.join(tot if k else F.broadcast(tot), [*k, "_rb"], "left")  # without keys: one row a bucket


def join_small(rows: DataFrame, table: DataFrame, on, how: str = "inner", limit: int = 10_000) -> DataFrame:
    """Join rows with an aggregated lookup table.  The table is written and
    counted first: up to ``limit`` rows it is broadcast, so rows with few
    distinct keys are not gathered by key; beyond that Spark shuffles both
    sides and splits hot keys."""
    t = materialize(table)
    return rows.join(F.broadcast(t) if t.count() <= limit else t, on, how)


def exact_quantiles_at(df: DataFrame, value_col: str, probs: DataFrame,
                       group_cols: list[str] | tuple = (), n_buckets: int | None = None,
                       weight_col: str | None = None, checkpoint: bool = True) -> DataFrame:
    """Exact quantiles with linear interpolation (NumPy default, SQL
    ``percentile`` / ``quantile_cont``), computed without gathering a group's
    values in one task.  ``probs`` holds (*group_cols, p) rows, so the
    probability may itself come from the data.

    Wanted ranks are first resolved to (group, bucket) on the table of bucket
    counts; only the values of those buckets are ranked and joined.  Where no
    group has more than ``WHOLE_GROUP`` different values, each is one bucket.
    Returns ``(*group_cols, p DOUBLE, q DOUBLE)``.
    """
    g = list(group_cols)
    w = F.col(weight_col).cast("long") if weight_col else F.lit(1).cast("long")
    vals = (df.where(F.col(value_col).isNotNull())
            .select(*g, F.col(value_col).cast("double").alias("_v"), w.alias("_w"))
            .groupBy(*g, "_v").agg(F.sum("_w").alias("_n")))
    if checkpoint:
        vals = materialize(vals)
    if g and not n_buckets:  # counts by group and bucket would be as many rows as the values of small groups
        largest = vals.groupBy(*g).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
        n_buckets = 1 if largest <= WHOLE_GROUP else None
    edges = range_edges(vals, "_v", n_buckets or default_buckets(df))
    tmp = vals.withColumn("_rb", count_below(F.col("_v"), edges))
    w_prev = Window.partitionBy(*g).orderBy("_rb").rowsBetween(Window.unboundedPreceding, -1)
    counts = tmp.groupBy(*g, "_rb").agg(F.sum("_n").alias("_t")).select(
        *g, "_rb", "_t", F.coalesce(F.sum("_t").over(w_prev), F.lit(0)).alias("_before"),
        F.sum("_t").over(Window.partitionBy(*g)).alias("_N"))
    tot = counts.select(*g, "_N").distinct()
    if g and not set(g) <= set(probs.columns):
        # one list of probabilities for every group (bounded: len(probs) rows)
        tp = tot.crossJoin(F.broadcast(probs.select(F.col("p").cast("double").alias("p"))))
    else:
        tp = probs.select(*g, F.col("p").cast("double").alias("p"))
        tp = tp.join(tot, g, "inner") if g else tp.crossJoin(tot)
    targets = (tp.withColumn("_pos", F.col("p") * (F.col("_N") - 1))
               .withColumn("_lo", F.floor("_pos")).withColumn("_hi", F.ceil("_pos"))
               .select(*g, "p", "_pos", "_lo",
                       F.explode(F.array(
                           F.struct(F.lit(0).alias("role"), F.col("_lo").alias("rank")),
                           F.struct(F.lit(1).alias("role"), F.col("_hi").alias("rank")))).alias("t"))
               .select(*g, "p", "_pos", "_lo", "t.role", "t.rank"))
    c = counts.select(*[F.col(x).alias(f"_c_{x}") for x in g], "_rb", "_t", "_before")
    cond = (F.col("_before") <= F.col("rank")) & (F.col("rank") < F.col("_before") + F.col("_t"))
    for x in g:
        cond = cond & (F.col(x) == F.col(f"_c_{x}"))
    # both sides are small: groups x probabilities and groups x buckets
    wanted = targets.join(c if g else F.broadcast(c), cond).select(
        *g, "_rb", "p", "_pos", "_lo", "role", (F.col("rank") - F.col("_before")).alias("_in"))
    wanted = materialize(wanted)
    open_buckets = wanted.select(*g, "_rb").distinct()
    w_in = Window.partitionBy(*g, "_rb").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = tmp.join(open_buckets, [*g, "_rb"], "left_semi").withColumn("_end", F.sum("_n").over(w_in))
    hit = wanted.join(ranked, [*g, "_rb"]).where((F.col("_in") < F.col("_end")) & (F.col("_in") >= F.col("_end") - F.col("_n")))
    res = (hit.groupBy(*g, "p", "_pos", "_lo")
           .agg(F.max(F.when(F.col("role") == 0, F.col("_v"))).alias("_vlo"),
                F.max(F.when(F.col("role") == 1, F.col("_v"))).alias("_vhi")))
    return res.select(*g, "p", (F.col("_vlo") + (F.col("_pos") - F.col("_lo")) *
                                (F.col("_vhi") - F.col("_vlo"))).alias("q"))


def exact_quantiles(df: DataFrame, value_col: str, probs: list[float],
                    group_cols: list[str] | tuple = (), n_buckets: int | None = None,
                    weight_col: str | None = None, checkpoint: bool = True) -> DataFrame:
    """``exact_quantiles_at`` for a fixed list of probabilities (rows may
    carry an integer ``weight_col`` = number of identical values).  With
    ``checkpoint=False`` the caller promises a cheap, already written input."""
    g = list(group_cols)
    plist = df.sparkSession.createDataFrame([(float(p),) for p in probs], "p DOUBLE")
    return exact_quantiles_at(df, value_col, plist, g, n_buckets, weight_col, checkpoint)


def threshold_counts(hist: DataFrame, thresholds: list[float], score_col: str = "score",
                     group_cols: list[str] | tuple = (), n_col: str = "n", pos_col: str = "pos",
                     extra_sums: list[str] | tuple = ()) -> DataFrame:
    """Confusion counts of a score histogram at many thresholds in one pass.

    Each histogram row goes to the bucket ``k`` = number of thresholds <= its
    score, so the work is O(rows), not O(rows × thresholds).  Returns
    ``(*group_cols, threshold, n, pos, pred_pos, tp, *extra_pred_sums)`` for
    every group and threshold; ``pred_pos`` counts scores >= threshold.
    """
    g = list(group_cols)
    ts = sorted(set(float(t) for t in thresholds))
    k = count_at_or_below(F.col(score_col), ts)
    per_k = (hist.withColumn("_k", k).groupBy(*g, "_k")
             .agg(F.sum(n_col).alias("_n"), F.sum(pos_col).alias("_p"),
                  *[F.sum(c).alias(f"_x_{c}") for c in extra_sums]))
    grid = per_k.sparkSession.createDataFrame([(i, t) for i, t in enumerate(ts)], "_j INT, threshold DOUBLE")
    groups = per_k.select(*g).distinct() if g else None
    frame = grid if groups is None else groups.crossJoin(F.broadcast(grid))
    # pred_pos(j) = sum over k > j, i.e. scores >= t_j: a suffix sum over at most groups x thresholds rows
    sums = ["_n", "_p", *[f"_x_{c}" for c in extra_sums]]
    at = frame.join(per_k.withColumn("_j", F.col("_k") - 1), [*g, "_j"], "left")
    up = Window.partitionBy(*g).orderBy(F.col("_j").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    names = ["pred_pos", "tp", *[f"pred_{c}" for c in extra_sums]]
    above = at.select(*g, "_j", "threshold", *[F.sum(F.coalesce(F.col(x), F.lit(0))).over(up).alias(y) for x, y in zip(sums, names, strict=True)])
    tot = per_k.groupBy(*g).agg(F.sum("_n").alias("n"), F.sum("_p").alias("pos"))
    out = above.join(tot, g, "inner") if g else above.crossJoin(tot)
    return out.select(*g, "threshold", F.col("n").cast("long").alias("n"), F.col("pos").cast("long").alias("pos"),
                      F.col("pred_pos").cast("long").alias("pred_pos"), F.col("tp").cast("long").alias("tp"),
                      *[f"pred_{c}" for c in extra_sums])
