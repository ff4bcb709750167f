"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Each shard has ``vnodes`` tokens on the ring; a key belongs to the first token
clockwise of its hash.  No shard takes more than its capacity: the keys that
overflow a full shard continue clockwise to the next token whose shard has
room.  With ``load_factor=1`` the capacities add up to the number of keys, so
row counts differ by one at most; larger factors move fewer keys.

Only counts per arc (shards x vnodes rows, a parameter) reach the driver,
where the overflow walk turns them into rank intervals.  Ranks inside an arc
come from sub-cells of about ``cell_rows`` rows: one window per cell and
running totals over cells, so no shard or arc is gathered in one task.  Cells
are cut by a hash of the whole row, so different rows of one key spread over
its cells; equal rows are counted first and take an interval of ranks, which
is spread out again in lots of ``LOT``.

Null keys hash like the empty key; repeated rows get slots of their own; ranks
follow the rows alone, not their partitions.  Input columns named shard or
slot are replaced by the result's, any other name may occur; columns must be
of types that can be grouped.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from auditlens.llm.common import documents, text_or_empty, written

#: The ring has this many positions; tokens are snapped to them.
RING = 1 << 14
#: Equal rows that one task writes out at once.
LOT = 4096


def ring_arcs(n_shards: int, vnodes: int) -> list[tuple[int, int]]:
    """(first position after the previous token, owner) of each arc, clockwise."""
    owner: dict[int, int] = {}
    for shard in range(n_shards):
        for v in range(vnodes):
            at = int(hashlib.md5(f"shard-{shard}-vnode-{v}".encode()).hexdigest()[:8], 16) % RING
            owner.setdefault(at, shard)
    return sorted(owner.items())


def capacities(n_rows: int, n_shards: int, load_factor: float) -> list[int]:
    if load_factor <= 1:
        base, more = divmod(n_rows, n_shards)
        return [base + (s < more) for s in range(n_shards)]
    return [-(-int(n_rows * load_factor) // n_shards) + 1] * n_shards


def walk(arcs: list[tuple[int, int]], counts: dict[int, int], room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Place the keys of every arc: (arc, first rank, end rank, shard, first
    slot).  What an arc's owner cannot take is offered to the next arc's owner
    in the following round."""
    room, used, plan = list(room), [0] * len(room), []
    offers = {a: [(a, 0, counts[a])] for a in range(len(arcs)) if counts.get(a)}
    while offers:
        onward: dict[int, list[tuple[int, int, int]]] = {}
        for at in sorted(offers):
            shard = arcs[at][1]
            for arc, lo, hi in offers[at]:
                take = min(hi - lo, room[shard])
                if take:
                    plan.append((arc, lo, lo + take, shard, used[shard]))
                    room[shard] -= take
                    used[shard] += take
                if lo + take < hi:
                    onward.setdefault((at + 1) % len(arcs), []).append((arc, lo + take, hi))
        offers = onward
    return plan


def spread_out(intervals: DataFrame) -> DataFrame:
    """One row for each of the ``_n`` ranks from ``_slot`` on, as slot.  Long
    intervals are cut into lots and dealt before they are spread out."""
    few, many = F.col("_n") <= LOT, F.col("_n") > LOT
    lots = (intervals.where(many).withColumn("_lot", F.explode(F.expr(f"sequence(0L, _n - 1, {LOT}L)")))
            .withColumns({"_slot": F.col("_slot") + F.col("_lot"), "_n": F.least(F.col("_n") - F.col("_lot"), F.lit(LOT))}).drop("_lot")
            .repartition(F.col("shard"), F.col("_slot")))
    return intervals.where(few).unionByName(lots).withColumn("slot", F.explode(F.expr("sequence(_slot, _slot + _n - 1)")))


def assign_shards(spark: SparkSession, rows: DataFrame, key: str, order: list[str], n_shards: int,
                  vnodes: int = 64, load_factor: float = 1.0, cell_rows: int = 4096) -> DataFrame:
    """``rows`` (narrow: no texts) with columns shard and slot.  Within a cell
    rows are ranked by the key's hash, ``order`` and their other columns."""
    arcs = ring_arcs(n_shards, vnodes)
    kept = [c for c in rows.columns if c not in ("shard", "slot")]
    inner = {c: f"_k{i}" for i, c in enumerate(kept)}
    own = list(inner.values())
    h = F.xxhash64(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")))
    counted = rows.select(h.alias("_h"), *[F.col(f"`{c}`").alias(inner[c]) for c in kept]).groupBy("_h", *own).agg(F.count(F.lit(1)).alias("_copies"))
    base = written(counted, "ring-rows")
    n_rows = base.agg(F.sum("_copies").alias("n")).first()["n"] or 0
    n_sub = max(1, -(-n_rows // (len(arcs) * cell_rows)))
    starts = [at for at, _ in arcs]
    cells = []
    arc = 0
    for pos in range(RING):  # a position after the last token wraps to the first arc
        while arc < len(starts) and starts[arc] < pos:
            arc += 1
        cells.append((pos, arc % len(starts)))
    ring = F.broadcast(spark.createDataFrame(cells, "_pos INT, _arc INT"))  # RING rows, whatever the input
    placed = (base.withColumn("_pos", F.shiftrightunsigned("_h", 50).cast("int")).join(ring, "_pos")
              .withColumn("_sub", F.pmod(F.xxhash64("_h", *own), F.lit(n_sub)).cast("int")))
    counts = written(placed.groupBy("_arc", "_sub").agg(F.sum("_copies").alias("_n")), "ring-cells")
    per_arc = {r["_arc"]: r["n"] for r in counts.groupBy("_arc").agg(F.sum("_n").alias("n")).collect()}  # at most shards x vnodes
    plan = walk(arcs, per_arc, capacities(n_rows, n_shards, load_factor))
    before = Window.partitionBy("_arc").orderBy("_sub").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_arc", "_sub", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    ranks = ["_h", *[inner[c] for c in order if c in inner], *[x for c, x in inner.items() if c not in order]]
    inside = Window.partitionBy("_arc", "_sub").orderBy(*ranks).rowsBetween(Window.unboundedPreceding, -1)
    ranked = (placed.withColumn("_r", F.coalesce(F.sum("_copies").over(inside), F.lit(0))).join(offsets, ["_arc", "_sub"])
              .withColumn("_first", F.col("_before") + F.col("_r")).withColumn("_end", F.col("_first") + F.col("_copies")))
    to = F.broadcast(spark.createDataFrame(plan, "_of INT, _lo LONG, _hi LONG, shard INT, _base LONG"))  # intervals of arcs
    start = F.greatest("_first", "_lo")
    intervals = written(ranked.join(to, (F.col("_arc") == F.col("_of")) & (F.col("_first") < F.col("_hi")) & (F.col("_end") > F.col("_lo")))
                        .select(*own, "shard", (F.col("_base") + start - F.col("_lo")).alias("_slot"), (F.least("_end", "_hi") - start).alias("_n")), "ring-intervals")
    return spread_out(intervals).select(*[F.col(inner[c]).alias(c) for c in kept], "shard", "slot")


def op4_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents on 16 shards with the `rows` law."""
    rows = documents(spark, sf_dir).select(
        "doc_id", (F.octet_length(text_or_empty()) + 1).cast("long").alias("size"),
        F.crc32(text_or_empty().cast("binary")).alias("text_crc32"))
    out = assign_shards(spark, rows, "doc_id", ["doc_id", "size", "text_crc32"], 16)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
