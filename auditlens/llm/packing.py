"""Best-fit packing of token pieces into fixed-length sequences.

Each document's ids (plus an end id) are cut into pieces of at most the
sequence length only when longer.  Pieces are packed by bounded-space online
best-fit: at most ``n_open`` bins are open, grouped by free space, and a bitset
holds which free spaces exist, so the tightest bin that fits is one bit
operation away.  When a new bin is needed and all are open, the fullest closes.
What is still open at the end of a partition is packed once more, largest
piece first.

Documents are read once (one pass for ids); only five numbers a piece are
dealt to the packing tasks, whose number grows with the pieces.  Their state is
``n_open`` bins, whatever the partition holds.  Equal pieces are counted before
and dealt in lots of at most ``LOT``, so rows repeated often do not meet in one
task; each task packs in the order of a hash.  The packing therefore follows
from the rows alone, not from the order they arrive in, and a task that runs
again after a lost executor gives the same bins.

Null and empty texts are one piece holding the end id alone; repeated rows are
packed each on its own; an empty table gives no rows; other columns are left
alone.  Ties between bins of equal free space go to the last one used.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlens.llm.common import documents, slices, written
from auditlens.llm.words import library_ids

SEQUENCE = 2048
#: Most copies of a piece that are dealt together.
LOT = 1024


class BestFit:
    """Open bins keyed by free space.  put() returns the bins it closes."""

    def __init__(self, capacity: int, n_open: int):
        self.capacity, self.n_open = capacity, n_open
        self.by_space: list[list[list]] = [[] for _ in range(capacity + 1)]
        self.spaces = 0  # bit f is set while a bin with f free is open
        self.n = 0

    def put(self, size: int, item) -> list[list]:
        closed: list[list] = []
        fitting = self.spaces >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            bins = self.by_space[free]
            taken = bins.pop()
            if not bins:
                self.spaces ^= 1 << free
            self.n -= 1
        else:
            free, taken = self.capacity, []
            if self.n >= self.n_open:
                closed.append(self._close_fullest())
        taken.append(item)
        free -= size
        if free == 0:
            closed.append(taken)
        else:
            self.by_space[free].append(taken)
            self.spaces |= 1 << free
            self.n += 1
        return closed

    def _close_fullest(self) -> list:
        free = (self.spaces & -self.spaces).bit_length() - 1
        bins = self.by_space[free]
        out = bins.pop()
        if not bins:
            self.spaces ^= 1 << free
        self.n -= 1
        return out

    def rest(self) -> list[list]:
        return [b for bins in self.by_space for b in bins]


def pack(sizes: Iterator[tuple[int, object]], capacity: int, n_open: int) -> Iterator[list]:
    """Bins as lists of (size, item).  At most ``n_open`` bins are held."""
    open_bins = BestFit(capacity, n_open)
    for size, item in sizes:
        yield from open_bins.put(size, (size, item))
    left = sorted((x for b in open_bins.rest() for x in b), key=lambda x: -x[0])
    again = BestFit(capacity, len(left) + 1)
    for x in left:
        yield from again.put(x[0], x)
    yield from again.rest()


def document_pieces(docs: DataFrame, tokenizer_file: str, length: int = SEQUENCE, end_id: int = 0, **bounds: int) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of every document.
    ``bounds`` are those of the caches that each worker keeps (``library_ids``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from zlib import crc32

        encoder, end, width = library_ids(tokenizer_file, **bounds), end_id.to_bytes(4, "little"), 4 * length
        for batch in slices(batches):
            rows: list[list] = [[], [], [], [], []]
            for at, ids in enumerate(encoder.texts(batch.column(1).to_pylist())):
                ids += end
                for piece, start in enumerate(range(0, len(ids), width)):
                    part = ids[start : start + width]
                    for column, value in zip(rows, (at, piece, start // 4, len(part) // 4, crc32(part)), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows[0], pa.int64())), pa.array(rows[1], pa.int32()), *(pa.array(r, pa.int64()) for r in rows[2:])],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def pack_pieces(pieces: DataFrame, capacity: int = SEQUENCE, n_open: int = 1024, pieces_a_task: int = 100_000) -> DataFrame:
    """``pieces`` (with a column length, read twice) plus sequence_id and offset."""
    n = pieces.count()
    tasks = max(1, -(-n // pieces_a_task))
    own = [F.col(f"`{c}`") for c in pieces.columns]
    lots = (pieces.groupBy(*own).agg(F.count(F.lit(1)).alias("_copies"))
            .withColumn("_lot", F.explode(F.expr(f"sequence(0L, _copies - 1, {LOT}L)"))).withColumn("_deal", F.xxhash64(*own, "_lot")))
    dealt = (lots.repartition(tasks, "_deal").sortWithinPartitions("_deal", *own)
             .withColumn("_copy", F.explode(F.expr(f"sequence(1L, least(_copies - _lot, {LOT}L))"))).select(*own))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        names = None
        next_id = TaskContext.get().partitionId() << 40
        done: list[tuple[dict, int, int]] = []

        def pieces_in():
            for batch in batches:
                for row in batch.to_pylist():
                    yield row["length"], row

        def out(rows):
            columns = {k: [r[0][k] for r in rows] for k in names}
            arrays = [pa.array(columns[k], types[k]) for k in names]
            return pa.RecordBatch.from_arrays([*arrays, pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64())],
                                              [*names, "sequence_id", "offset"])

        for bin_ in pack(pieces_in(), capacity, n_open):
            names = names or list(bin_[0][1])
            at = 0
            for size, row in bin_:
                done.append((row, next_id, at))
                at += size
            next_id += 1
            if len(done) >= 20_000:
                yield out(done)
                done = []
        if done:
            yield out(done)

    from pyspark.sql.pandas.types import to_arrow_type
    types = {f.name: to_arrow_type(f.dataType) for f in pieces.schema.fields}
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return dealt.mapInArrow(run, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_file: str, length: int = SEQUENCE, end_id: int = 0, **bounds: int) -> DataFrame:
    pieces = written(document_pieces(docs, tokenizer_file, length, end_id, **bounds), "pieces")
    return pack_pieces(pieces, length)


def op10_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
