"""Training-order materialisation of token sequences.

Documents become ids (plus an end id), cut into sequences of ``stride`` ids,
the last one padded.  A sequence's number is (row id - smallest) x most
sequences a document can have + piece; a keyed Feistel network with
cycle-walking permutes these numbers, so each sequence gets a pseudo-random
place that depends on the key, the ids and nothing else.  Numbers may have more
than 64 bits (ids far apart): the network works on halves, and a place is kept
as its upper 62 bits and the rest.  Places are uniform,
so equal ranges of them make equal shards without sampling.  Each task sorts
its range and writes one file of fixed-stride records; a sequence's global
slot is the number of records before its shard plus its place there, gapless
from 0.

A shard file is written under a name of its own attempt and renamed when
complete, so a lost executor or a second attempt leaves whole files only.
``read_records`` seeks to any record, so reading resumes at a slot.

Null and empty texts are one sequence of the end id; ids may lie anywhere in
the range of a long; repeated ids are numbered by row; an empty table writes no shard; columns other than doc_id and text are
not read.  Files go through pyarrow's file systems, local or remote alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from auditlens.llm.common import documents, fresh_path, row_keyed, text_or_empty, written
from auditlens.llm.words import library_ids

STRIDE = 256
SHARD_MB = 64
ROUNDS = 6
#: Shards up to which the table of shard offsets is broadcast.
MAX_BROADCAST = 100_000


def half_bits(domain: int) -> int:
    """Bits of each half of a number below ``domain``."""
    return max(1, (max(domain - 1, 1).bit_length() + 1) // 2)


def feistel_halves(left, right, domain: int, key: int):
    """The permutation of [0, domain) at the numbers whose upper and lower
    halves (numpy uint64) are given; returns halves."""
    import numpy as np

    half = half_bits(domain)
    mask = np.uint64((1 << half) - 1)
    top, rest = np.uint64(domain >> half), np.uint64(domain & ((1 << half) - 1))

    def scramble(x, i):
        x = x + np.uint64((key * 0x9E3779B97F4A7C15 + i * 0xD1B54A32D192ED03) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return (x ^ (x >> np.uint64(31))) & mask

    def once(left, right):
        for i in range(ROUNDS):
            left, right = right, left ^ scramble(right, i)
        return left, right

    left, right = once(left, right)
    while True:  # walk along the cycle until the place lies in the domain
        outside = (left > top) | ((left == top) & (right >= rest))
        if not outside.any():
            return left, right
        left[outside], right[outside] = once(left[outside], right[outside])


def split_bits(domain: int) -> int:
    """Low bits of a place that do not fit its upper 62."""
    return max(0, 2 * half_bits(domain) - 62)


def feistel(numbers, domain: int, key: int):
    """The permutation of [0, domain) at ``numbers`` (a sequence of ints):
    upper 62 bits of the places and the bits below them."""
    import numpy as np

    half, extra = half_bits(domain), np.uint64(split_bits(domain))
    mask, shift = (1 << half) - 1, np.uint64(half)
    if extra:  # numbers of more than 64 bits are cut into halves one by one
        left, right = np.array([n >> half for n in numbers], np.uint64), np.array([n & mask for n in numbers], np.uint64)
    else:
        whole = np.asarray(numbers, np.uint64)
        left, right = whole >> shift, whole & np.uint64(mask)
    left, right = feistel_halves(left, right, domain, key)
    return (left << (shift - extra)) | (right >> extra), right & ((np.uint64(1) << extra) - np.uint64(1))


def sequences(docs: DataFrame, tokenizer_file: str, stride: int, end_id: int, low: int, most: int, domain: int, key: int) -> DataFrame:
    """place and its low bits, doc_id, piece, n_tokens, crc32 of the ids, and
    the padded record (little-endian uint16) of each sequence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from zlib import crc32

        import numpy as np

        encoder, end = library_ids(tokenizer_file), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            rows = batch.column(0).to_pylist()  # Python ints, so that numbers may have more than 64 bits
            at, pieces, lengths, sums, records = [], [], [], [], []
            for i, ids in enumerate(encoder.texts(batch.column(2).to_pylist())):
                ids = np.frombuffer(ids + end, "<u4").astype("<u2")
                n = -(-len(ids) // stride)
                whole = np.full(n * stride, end_id, "<u2")
                whole[: len(ids)] = ids
                data = whole.tobytes()
                for p in range(n):
                    record = data[2 * p * stride : 2 * (p + 1) * stride]
                    length = min(stride, len(ids) - p * stride)
                    at.append(i)
                    pieces.append(p)
                    lengths.append(length)
                    sums.append(crc32(record[: 2 * length]))
                    records.append(record)
                    if len(records) >= 20_000:
                        yield out(batch, rows, at, pieces, lengths, sums, records)
                        at, pieces, lengths, sums, records = [], [], [], [], []
            if records:
                yield out(batch, rows, at, pieces, lengths, sums, records)

    def out(batch, rows, at, pieces, lengths, sums, records):
        import numpy as np

        place, below = feistel([(rows[i] - low) * most + p for i, p in zip(at, pieces, strict=True)], domain, key)
        return pa.RecordBatch.from_arrays(
            [pa.array(place.astype(np.int64)), pa.array(below.astype(np.int64)), batch.column(1).take(pa.array(at, pa.int64())), pa.array(pieces, pa.int32()), pa.array(lengths, pa.int32()),
             pa.array(sums, pa.int64()), pa.array(records, pa.binary())], ["place", "below", "doc_id", "piece", "n_tokens", "ids_crc32", "record"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("_row", "doc_id", "text").mapInArrow(run, f"place long, below long, doc_id {kind}, piece int, n_tokens int, ids_crc32 long, record binary")


def shard_name(shard: int) -> str:
    return f"shard-{shard:06d}.bin"


def write_shards(dealt: DataFrame, folder: str) -> DataFrame:
    """Writes each shard's records in the order given (rows arrive sorted by
    shard and place); returns doc_id, piece, n_tokens, ids_crc32, shard and
    nth, the place in the shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        from pyspark import TaskContext

        store, root = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else "file://" + folder)
        store.create_dir(root, recursive=True)
        attempt = TaskContext.get().taskAttemptId()
        current, sink, n = None, None, 0

        def close():
            if sink is not None:
                sink.close()
                done = f"{root}/{shard_name(current)}"
                if store.get_file_info(done).type != fs.FileType.NotFound:  # an earlier attempt's, with the same records
                    store.delete_file(done)
                store.move(f"{root}/_{attempt}-{shard_name(current)}", done)

        for batch in batches:
            nth = []
            for shard, record in zip(batch.column("shard").to_pylist(), batch.column("record").to_pylist(), strict=True):
                if shard != current:
                    close()
                    current, n = shard, 0
                    sink = store.open_output_stream(f"{root}/_{attempt}-{shard_name(shard)}")
                sink.write(record)
                nth.append(n)
                n += 1
            names = ["doc_id", "piece", "n_tokens", "ids_crc32", "shard"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(nth, pa.int64())], [*names, "nth"])
        close()

    kind = dealt.schema["doc_id"].dataType.simpleString()
    return dealt.mapInArrow(run, f"doc_id {kind}, piece int, n_tokens int, ids_crc32 long, shard int, nth long")


def materialise(docs: DataFrame, tokenizer_file: str, folder: str, stride: int = STRIDE, end_id: int = 0, key: int = 20, shard_mb: float = SHARD_MB) -> DataFrame:
    """Writes the shards below ``folder`` and returns their index: slot, shard,
    position (bytes), doc_id, piece, n_tokens, ids_crc32."""
    keyed = row_keyed(docs).select("_row", "doc_id", "text")
    size = F.octet_length(text_or_empty())
    s = keyed.agg(F.min("_row").alias("low"), F.max("_row").alias("high"), F.max(size).alias("longest"), F.sum(size).alias("total")).first()
    low, high, longest = s["low"] or 0, s["high"] or 0, s["longest"] or 0
    most = -(-(4 * longest + 1) // stride) + 1  # lower-casing and splitting can make a byte no more than a few ids
    domain = (high - low + 1) * most
    n_shards = max(1, -(-(s["total"] or 0) // int(shard_mb * 2**20)))  # about two bytes an id, three bytes of text an id
    made = sequences(keyed, tokenizer_file, stride, end_id, low, most, domain, key)
    width = -(-((domain >> split_bits(domain)) + 1) // n_shards)
    dealt = (made.withColumn("shard", F.floor(F.col("place") / F.lit(float(width))).cast("int"))
             .repartitionById(n_shards, F.least(F.col("shard"), F.lit(n_shards - 1))).sortWithinPartitions("shard", "place", "below"))
    index = written(write_shards(dealt, folder), "order-index")
    counts = index.groupBy("shard").agg(F.count(F.lit(1)).alias("n"))  # one row a shard
    before = counts.select("shard", F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return index.join(F.broadcast(before) if n_shards <= MAX_BROADCAST else before, "shard").select(
        (F.col("before") + F.col("nth")).alias("slot"), "shard", (F.col("nth") * 2 * stride).alias("position"), "doc_id", "piece", "n_tokens", "ids_crc32")


def read_records(folder: str, shard: int, start: int = 0, count: int | None = None, stride: int = STRIDE):
    """The ids of records from ``start`` on, as an array of rows."""
    import numpy as np
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else "file://" + folder)
    with store.open_input_file(f"{root}/{shard_name(shard)}") as f:
        f.seek(2 * stride * start)
        data = f.read() if count is None else f.read(2 * stride * count)
    return np.frombuffer(data, "<u2").reshape(-1, stride)


def op8_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return materialise(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), fresh_path(spark, "training-order"))
