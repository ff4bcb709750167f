"""Removal of long repeated byte strings, by names of growing prefixes at
content anchors (no prefix doubling: no rank is made from a pair of ranks).

Every start of a ``threshold``-byte string has one anchor: the place of the
smallest hashed 8-gram among its first threshold/2 + 1 bytes, so equal strings
have their anchors at equal distances and only anchors, one for about a
quarter of the threshold, are sorted instead of all positions.  Consecutive
starts with the same anchor form a run.

One Python pass names the strings at each anchor: equal strings get equal
hashes.  Round by round Spark counts longer names, and positions whose name is
unique leave, as nothing that starts there repeats:

1. name of threshold/4 bytes from the anchor;
2. with the name at offset threshold/4: threshold/2 bytes;
3. past the threshold: the hull of the run, all bytes that its strings cover.
   Hulls that repeat are removed whole.  What remains are runs at the ends of
   repeated passages; one witness of each repeated hull goes on with them;
4. the same for cells of 32 starts (prefix threshold - 31, then their hull);
5. single starts: names of exactly ``threshold`` bytes.

All counts are partial aggregates and hot names are split in the sort-merge
joins; texts move twice (once for what rounds 1 to 3 left open, once for the
result).  Names have 64 bits in rounds 1 to 3, where all three must agree, and
128 bits after that.

Matches never cross documents; null texts are empty; texts shorter than the
threshold are kept whole; repeated rows are documents of their own, so long
ones are removed whole; very long texts are read in blocks; an empty table
gives no rows; extra columns are not read.  Removal is judged on the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlens.llm.common import discard, documents, row_keyed, slices, written

THRESHOLD = 400
CELL = 32
#: Starts handled at once within one text; positions in a block fit 24 bits.
STEP = 1 << 20


def anchor_runs(data: bytes, threshold: int):
    """(anchors, first starts, last starts) of the runs of ``data``."""
    import numpy as np

    half = threshold // 2
    x = np.frombuffer(data, np.uint8)
    starts = len(x) - threshold + 1
    out = []
    low = np.uint64(0xFFFFFF)
    for base in range(0, starts, STEP):
        n = min(STEP, starts - base)
        v = x[base : base + n + half + 7].astype(np.uint64)
        v = v[:-1] | (v[1:] << np.uint64(8))
        v = v[:-2] | (v[2:] << np.uint64(16))
        v = v[:-4] | (v[4:] << np.uint64(32))
        v *= np.uint64(0x9E3779B97F4A7C15)
        v ^= v >> np.uint64(29)
        v *= np.uint64(0xBF58476D1CE4E5B9)
        v |= low
        v -= np.arange(len(v), dtype=np.uint64)  # of equal hashes the last place is the smallest
        width = 1
        while 2 * width <= half + 1:
            v = np.minimum(v[:-width], v[width:])
            width *= 2
        rest = half + 1 - width
        if rest:
            v = np.minimum(v[:-rest], v[rest:])
        at = (low - (v & low)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        out.append((at[first] + base, first + base, np.r_[first[1:] - 1, n - 1] + base))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def anchor_rows(keyed: DataFrame, threshold: int) -> DataFrame:
    """One row per run: _row, anchor a, first and last start s and e, the ranks
    r1 and r2 of the two quarter blocks from the anchor, and the hull's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        from xxhash import xxh3_64_digest as name

        core = threshold - threshold // 2
        q = core // 2
        for batch in slices(batches):
            ids, parts, n = [], [], 0
            for row, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if data is None or len(data) < threshold:
                    continue
                a, s, e = anchor_runs(data, threshold)
                at = a.tolist()
                parts.append((a, s, e,
                              b"".join([name(data[i : i + q]) for i in at]), b"".join([name(data[i + q : i + core]) for i in at]),
                              b"".join([name(data[i:j]) for i, j in zip(s.tolist(), (e + threshold).tolist(), strict=True)])))
                ids.append(np.full(len(a), row, np.int64))
                n += len(a)
                if n >= 100_000:
                    yield _anchor_batch(ids, parts)
                    ids, parts, n = [], [], 0
            if n:
                yield _anchor_batch(ids, parts)

    return keyed.select("_row", F.col("text").cast("binary").alias("text")).mapInArrow(run, "_row long, a long, s long, e long, r1 long, r2 long, hull long")


def _anchor_batch(ids, parts) -> pa.RecordBatch:
    import numpy as np

    columns = [np.concatenate(ids), *(np.concatenate([p[i] for p in parts]) for i in range(3)), *(np.frombuffer(b"".join([p[i] for p in parts]), np.int64) for i in range(3, 6))]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["_row", "a", "s", "e", "r1", "r2", "hull"])


def repeated(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of a written table whose ``keys`` occur more than once: sorted
    by the rank pair, unique ones leave.  ``rows`` is deleted."""
    again = written(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n"), "ranks")
    left = written(rows.join(again.hint("merge"), keys), "doubled")
    discard(again, rows)
    return left


def settle(rows: DataFrame, rank: list[str], hull: str, position: list[str], threshold: int) -> tuple[DataFrame, DataFrame]:
    """(spans of the rows whose hull repeats, rows to look at closer).  The latter are the
    rows with a hull of their own and, where such a row shares its rank, one
    witness of each repeated hull."""
    keys = [*rank, hull]
    classes = written(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct(*position)).alias("_witness")), "hulls")
    whole = written(rows.join(classes.where("_n > 1").select(*keys).hint("merge"), keys)
                    .select("_row", F.col("s").alias("start"), (F.col("e") + threshold).alias("stop")), "spans")
    single = classes.where("_n = 1")
    mixed = single.select(*rank).distinct()
    witness = classes.where("_n > 1").join(mixed.hint("merge"), rank, "left_semi")
    closer = written(single.select("_witness.*").unionByName(witness.select("_witness.*")), "open")
    discard(rows, classes)
    return whole, closer


def snippets(keyed: DataFrame, open_runs: DataFrame, threshold: int) -> DataFrame:
    """_row, a, s, e and the bytes that the run's strings cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows: list[list] = [[], [], [], [], []]
            for row, data, runs in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                for r in runs:
                    for column, value in zip(rows, (row, r["a"], r["s"], r["e"], data[r["s"] : r["e"] + threshold]), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in rows[:4]), pa.array(rows[4], pa.binary())], ["_row", "a", "s", "e", "part"])

    by_row = open_runs.groupBy("_row").agg(F.collect_list(F.struct("a", "s", "e")).alias("runs"))  # no more than the text's own anchors
    texts = keyed.select("_row", F.col("text").cast("binary").alias("text"))
    return texts.join(by_row.hint("merge"), "_row").mapInArrow(run, "_row long, a long, s long, e long, part binary")


def cell_rows(parts: DataFrame, threshold: int) -> DataFrame:
    """Cells of ``CELL`` distances to the anchor that a run meets: the rank of
    what all strings of the cell share, and of the hull of the run's own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest as name

        for batch in slices(batches):
            rows: list[list] = [[] for _ in range(7)]
            for row, a, s, e, part in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                for cell in range((a - e) // CELL, (a - s) // CELL + 1):
                    near, far = cell * CELL, cell * CELL + CELL - 1
                    core = part[a - near - s : a - far + threshold - s]
                    lo, hi = max(s, a - far), min(e, a - near)
                    for column, value in zip(rows, (row, a, cell, lo, hi, name(core), name(part[lo - s : hi + threshold - s])), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in rows[:5]), *(pa.array(c, pa.binary()) for c in rows[5:])],
                                             ["_row", "a", "cell", "s", "e", "core", "hull"])

    return parts.mapInArrow(run, "_row long, a long, cell long, s long, e long, core binary, hull binary")


def start_rows(open_cells: DataFrame, parts: DataFrame, threshold: int) -> DataFrame:
    """_row, start and name of each single string of the open cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest as name

        for batch in slices(batches):
            rows: list[list] = [[], [], []]
            for row, lo, hi, s, part in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                rows[0] += [row] * (hi - lo + 1)
                rows[1] += range(lo, hi + 1)
                rows[2] += [name(part[p - s : p - s + threshold]) for p in range(lo, hi + 1)]
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in rows[:2]), pa.array(rows[2], pa.binary())], ["_row", "s", "name"])

    cells = open_cells.select("_row", "a", F.col("s").alias("lo"), F.col("e").alias("hi"))
    joined = cells.join(parts.hint("merge"), ["_row", "a"]).where("s <= lo and hi <= e").select("_row", "lo", "hi", "s", "part")
    return joined.mapInArrow(run, "_row long, s long, name binary")


def repeated_spans(keyed: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """_row, start, stop of byte spans made of repeated strings (they may
    overlap; together they are all that repeats)."""
    if threshold < 64:
        raise ValueError("the threshold must be 64 bytes at least")
    anchors = written(anchor_rows(keyed, threshold), "anchors")
    half = repeated(repeated(anchors, ["r1"]), ["r1", "r2"])
    whole, open_runs = settle(half, ["r1", "r2"], "hull", ["_row", "a", "s", "e"], threshold)
    parts = written(snippets(keyed, open_runs, threshold), "snippets")
    cells = repeated(written(cell_rows(parts, threshold), "cells"), ["cell", "core"])
    whole_cells, open_cells = settle(cells, ["cell", "core"], "hull", ["_row", "a", "s", "e"], threshold)
    starts = repeated(written(start_rows(open_cells, parts, threshold), "starts"), ["name"])
    discard(open_runs, open_cells, parts)
    return whole.unionByName(whole_cells).unionByName(starts.select("_row", F.col("s").alias("start"), (F.col("s") + threshold).alias("stop")))


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(stop, out[-1][1])
        else:
            out.append((start, stop))
    return out


def cut(docs: DataFrame, keep: list[str], threshold: int = THRESHOLD, with_text: bool = False) -> DataFrame:
    """``keep`` columns of every document plus _n_bytes, _n_removed, _n_spans,
    _sha256 of the remaining bytes and, if asked for, _text: what remains where
    something was removed, without the bytes of cut characters."""
    keyed = row_keyed(docs)
    by_row = repeated_spans(keyed, threshold).groupBy("_row").agg(F.collect_list(F.struct("start", "stop")).alias("_spans"))
    sent = list(dict.fromkeys(["text", *keep]))  # the text travels once
    texts = keyed.select("_row", *[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(sent)])
    joined = texts.join(by_row.hint("merge"), "_row", "left").select("_spans", *[f"_c{i}" for i in range(len(sent))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import sha256

        for batch in slices(batches):
            n, removed, runs, digests, kept = [], [], [], [], []
            for data, spans in zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(0).to_pylist(), strict=True):
                data = data or b""
                n.append(len(data))
                gone = merge([(x["start"], x["stop"]) for x in spans or []])
                if gone:
                    data = b"".join([data[a:b] for a, b in zip([0, *(x[1] for x in gone)], [*(x[0] for x in gone), len(data)], strict=True)])
                removed.append(n[-1] - len(data))
                runs.append(len(gone))
                digests.append(sha256(data).hexdigest())
                kept.append(data.decode("utf-8", "ignore") if gone and with_text else None)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(1 + sent.index(c)) for c in keep), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(digests, pa.string()), pa.array(kept, pa.string())],
                [*(f"_k{i}" for i in range(len(keep))), "_n_bytes", "_n_removed", "_n_spans", "_sha256", "_text"])

    kinds = "".join(f"_k{i} {docs.schema[c].dataType.simpleString()}, " for i, c in enumerate(keep))
    out = joined.mapInArrow(run, f"{kinds}_n_bytes long, _n_removed long, _n_spans long, _sha256 string, _text string")
    return out.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], "_n_bytes", "_n_removed", "_n_spans", "_sha256", "_text")


def remove_repeats(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """The documents with repeated strings taken out of their texts (n_chars,
    where present, is counted anew; bytes of a cut character are dropped; null
    texts stay null)."""
    changed = F.col("_n_removed") > 0
    out = cut(docs, docs.columns, threshold, with_text=True).withColumn("text", F.when(changed, F.col("_text")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(changed, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def op3_prefix_doubling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut(documents(spark, sf_dir), ["doc_id"]).select(
        "doc_id", F.col("_n_bytes").alias("n_bytes"), F.col("_n_removed").alias("n_removed"), F.col("_n_spans").alias("n_spans"), F.col("_sha256").alias("kept_sha256"))
