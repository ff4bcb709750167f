"""Near-duplicate classes by DartMinHash and banding.

A text's elements are its shingles of five words with their multiplicity as
weight.  Every unit of weight of every element is a region into which hashed
darts fall as a Poisson process over rank: the s-th dart's rank is a sum of s
exponentials drawn from hashes of (element, unit, s), so equal regions of two
texts get the same darts.  About k(ln k + 3) darts of smallest rank are thrown
per text whatever its length; each dart hits one of k coordinates and the
earliest per coordinate is kept.  Two signatures agree at a coordinate with
the probability of the texts' weighted Jaccard similarity.  If a coordinate
stays empty, the rank limit is doubled.

Texts with equal word sequences are one node.  Nodes that share a band of
coordinates are candidates.  First each bucket's lead (first node in even
bands, last in odd ones) is compared with the bucket's members, which links
most groups: each member with the leads of its two largest buckets, one smaller
and one larger than it, then with its other leads that are in no component
with it yet.  Where a bucket still holds several components, the members
outside its largest one are held against all its members by signature, in
blocks of bounded size, and what passes by the ``LOW`` smallest hashes of their
shingles, which for texts of fewer shingles is the exact check.  Each first
gives its ``FIRST`` likeliest partners of other components, and after these are
linked, all that are left whose estimates are within 2.5 standard deviations of
the threshold; a pair is given by the first bucket it shares only.  So pairs
that fail never become rows but for long texts near the threshold, and no
bucket is gathered in one task.  Candidates are checked exactly on their
shingle multisets (weighted Jaccard of ``THRESHOLD`` or more); classes are the
connected components of the links that hold.

With 32 bands of 8 coordinates a pair of similarity 0.8 shares a band with
probability 0.997 (0.85: 0.9999).

Words are the lower-cased text cut at white space; a text of one to four words
is one shingle; texts without words (null, empty, blank) are classes of their
own.  Ties in class ids go to the smallest doc_id (nulls last); repeated rows
share a class and one copy of them is kept; an empty table gives no rows;
columns other than doc_id and text are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlens.llm.common import discard, documents, row_keyed, slices, written
from auditlens.llm.graph import components

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 8
#: 2.5 standard deviations of the estimate below the threshold.
ESTIMATE = THRESHOLD - 2.5 * math.sqrt(THRESHOLD * (1 - THRESHOLD) / (BANDS * ROWS))
#: Members of a bucket that one task compares: CHUNK against BLOCK.
CHUNK, BLOCK = 4096, 512
FIRST = 8
#: Smallest shingle hashes of a text that go into a bucket's comparison; a text with fewer is compared exactly there.
LOW = 512
#: Words whose hashes a worker remembers.
MAX_WORDS = 100_000
LOW_ESTIMATE = THRESHOLD - 2.5 * math.sqrt(THRESHOLD * (1 - THRESHOLD) / LOW)

_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def mix(x):
    """A 64-bit finalizer over a numpy array (in a new array)."""
    import numpy as np

    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class WordHashes(dict):
    """word -> 64-bit hash, at most ``MAX_WORDS`` remembered: the worker keeps
    them while it runs other stages."""

    def __missing__(self, word: str) -> int:
        from xxhash import xxh3_64_intdigest

        if len(self) >= MAX_WORDS:
            self.clear()
        h = self[word] = xxh3_64_intdigest(word)
        return h


def shingle_cells(words: list[str], hashes: WordHashes):
    """Sorted distinct 64-bit keys, one for each unit of weight of each
    shingle: (shingle, occurrence number)."""
    import numpy as np

    w = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(WORDS, len(w))
    n = len(w) - width + 1
    s = np.zeros(n, np.uint64)
    for i in range(width):
        s += w[i : i + n] * np.uint64(_MULTIPLIERS[i])
    s.sort()
    new = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
    nth = np.arange(n, dtype=np.int64)
    if len(new) < n:
        nth -= np.repeat(new, np.diff(np.r_[new, n]))
        cells = mix(s + nth.astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D))
    else:
        cells = mix(s)
    return np.unique(cells)


def dart_signature(cells, k: int):
    """The id of the earliest dart at each of ``k`` coordinates."""
    import numpy as np

    n = len(cells)
    thrown = k * (math.log(k) + 3)
    step = np.uint64(0x9FB21C651E98DF25)
    while True:
        limit = thrown / n
        if limit > 8:  # few regions, many darts each
            m = int(limit + 8 * math.sqrt(limit) + 20)
            ids = mix(cells[:, None] + np.arange(m, dtype=np.uint64)[None, :] * step)
            rank = np.cumsum(-np.log(((ids >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53), axis=1)
            hit = rank <= limit
            ids, rank = ids[hit], rank[hit]
        else:
            all_ids, all_ranks, live, at, s = [], [], cells, np.zeros(n), 0
            while len(live):
                ids = mix(live + np.uint64(s * int(step) & 0xFFFFFFFFFFFFFFFF))
                at = at - np.log(((ids >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53)
                hit = at <= limit
                live, at = live[hit], at[hit]
                all_ids.append(ids[hit])
                all_ranks.append(at)
                s += 1
            ids, rank = np.concatenate(all_ids), np.concatenate(all_ranks)
        late_first = np.argsort(-rank, kind="stable")
        ids = ids[late_first]
        where = ((ids & np.uint64(0xFFFFFFFF)) * np.uint64(k) >> np.uint64(32)).astype(np.int64)
        signature = np.zeros(k, np.uint64)
        filled = np.zeros(k, bool)
        signature[where] = ids  # of several darts at a coordinate, the earliest comes last and stays
        filled[where] = True
        if filled.all():
            return signature
        thrown *= 2


def band_keys(signature, bands: int, rows: int):
    import numpy as np

    parts = signature.reshape(bands, rows)
    key = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for i in range(rows):
        key = mix(key + parts[:, i])
    return key.view(np.int64)


_HASHES = WordHashes()


def signatures(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, node (digest of the word sequence; null without words), the band
    keys and a sketch (a byte of each coordinate) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        from xxhash import xxh3_128_digest

        for batch in slices(batches):
            nodes, keys, sketches = [], [], []
            for text in batch.column(1).to_pylist():
                words = (text or "").lower().split()
                if words:
                    signature = dart_signature(shingle_cells(words, _HASHES), bands * rows)
                    nodes.append(xxh3_128_digest(" ".join(words)))
                    keys.append(band_keys(signature, bands, rows))
                    sketches.append((signature >> np.uint64(32) & np.uint64(0xFF)).astype(np.uint8).tobytes())  # bits that decide neither rank nor coordinate
                else:
                    nodes.append(None)
                    keys.append(None)
                    sketches.append(None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(nodes, pa.binary()), pa.array(keys, pa.list_(pa.int64())), pa.array(sketches, pa.binary())],
                                             ["doc_id", "node", "bands", "sketch"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, node binary, bands array<long>, sketch binary")


def node_cells(wanted: DataFrame, docs: DataFrame) -> DataFrame:
    """node and its cells (uint32, sorted, binary) for the nodes in ``wanted``
    (node, at: a document with that text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        from xxhash import xxh3_128_digest

        for batch in slices(batches):
            nodes, cells = [], []
            for node, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = (text or "").lower().split()
                if words and xxh3_128_digest(" ".join(words)) == node:  # ids may repeat over different texts
                    nodes.append(node)
                    cells.append(np.sort((shingle_cells(words, _HASHES) >> np.uint64(32)).astype("<u4")).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(cells, pa.binary())], ["node", "cells"])

    texts = docs.select(F.col("doc_id").alias("at"), "text")
    return wanted.hint("merge").join(texts, wanted["at"].eqNullSafe(texts["at"])).select("node", "text").mapInArrow(run, "node binary, cells binary")


def similar(pairs: DataFrame, cells: DataFrame, threshold: float) -> DataFrame:
    """The (a, b) of ``pairs`` whose weighted Jaccard similarity reaches the
    threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in slices(batches):
            hold = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(x, "<u4"), np.frombuffer(y, "<u4")
                if min(len(x), len(y)) < threshold * max(len(x), len(y)):
                    hold.append(False)
                    continue
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                hold.append(common >= threshold * (len(x) + len(y) - common) - 1e-9)
            yield batch.select([0, 1]).filter(pa.array(hold, pa.bool_()))

    left = cells.select(F.col("node").alias("a"), F.col("cells").alias("x"))
    right = cells.select(F.col("node").alias("b"), F.col("cells").alias("y"))
    wide = pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b").select("a", "b", "x", "y")
    return wide.mapInArrow(run, "a binary, b binary")


def may_hold(x, y, threshold: float = THRESHOLD) -> bool:
    """Whether two texts may be similar, by their ``LOW`` smallest cells: exact
    where both are whole, else an estimate over the range both cover."""
    import numpy as np

    limit = threshold - 1e-9
    if len(x) == LOW or len(y) == LOW:
        top = min(v[-1] for v in (x, y) if len(v) == LOW)
        x, y = x[: np.searchsorted(x, top, "right")], y[: np.searchsorted(y, top, "right")]
        limit = LOW_ESTIMATE
    both = np.concatenate([x, y])
    both.sort(kind="stable")
    common = int(np.count_nonzero(both[1:] == both[:-1]))
    return common >= limit * (len(x) + len(y) - common)


def likely_partners(compared: DataFrame, k: int | None) -> DataFrame:
    """(node, other): for each member to be placed (``side`` 0) its ``k``
    likeliest (None: all likely) members of other components, by sketch.
    ``compared`` has a bounded group of members for each (bucket, chunk,
    block)."""

    def run(group: pa.Table) -> pa.Table:
        import numpy as np

        rows = len(group)
        col = {c: group.column(c).combine_chunks() for c in ("sketch", "bands", "side", "node", "label", "lead", "main", "bucket", "seen", "low")}
        side = col["side"].to_numpy(zero_copy_only=False)
        members, placed = np.flatnonzero(side == 1), np.flatnonzero(side == 0)
        out: list[tuple[bytes, bytes]] = []
        if len(members) and len(placed):
            sketches = np.frombuffer(b"".join(col["sketch"].to_pylist()), np.uint8).reshape(rows, -1)
            bands = col["bands"].flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)
            node, label, lead = (np.array(col[c].to_pylist(), object) for c in ("node", "label", "lead"))
            low = [np.frombuffer(x, "<u4") for x in col["low"].to_pylist()]
            main, bucket = col["main"][0].as_py(), col["bucket"][0].as_py()
            held, keys, ids, names = sketches[members], bands[members], node[members], label[members]
            for i in placed:
                near = np.count_nonzero(held == sketches[i], axis=1) / sketches.shape[1]
                at = np.flatnonzero(near >= ESTIMATE)
                # two members to be placed are compared from the smaller one
                at = at[(names[at] != label[i]) & (ids[at] != lead[i]) & ((names[at] == main) | (ids[at] > node[i]))]
                if len(at):
                    shared = keys[at] == bands[i]
                    at = at[shared.argmax(axis=1) == np.flatnonzero(bands[i] == bucket)[0]]
                if len(at) and col["seen"][int(i)].is_valid:
                    seen = set(col["seen"][int(i)].as_py())
                    at = np.array([j for j in at if ids[j] not in seen], np.int64)
                at = np.array([j for j in at if may_hold(low[i], low[members[j]])], np.int64)
                if k is not None and len(at) > k:
                    at = at[np.argpartition(-near[at], k)[:k]]
                out += [(node[i], ids[j]) for j in at]
        return pa.table({"node": pa.array([x for x, _ in out], pa.binary()), "other": pa.array([x for _, x in out], pa.binary())})

    return compared.groupBy("bucket", "chunk", "block").applyInArrow(run, "node binary, other binary")


def open_buckets(members: DataFrame, labels: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """The members with their components, and the buckets of three or more
    members (two have been compared already, one being the lead) that hold
    several: the largest component and the numbers of chunks and blocks."""
    if labels is None:
        labelled = members.withColumn("label", F.col("node"))
    else:
        labelled = members.join(labels.select("node", "label").hint("merge"), "node", "left").withColumn("label", F.coalesce("label", "node"))
    labelled = written(labelled, "labelled")
    per = labelled.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"))
    buckets = per.groupBy("bucket").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("m"), F.max(F.struct("n", "label")).alias("top")).where("c > 1 and m > 2")
    dealt = written(buckets.select("bucket", F.col("top.label").alias("main"), F.ceil(F.col("m") / CHUNK).alias("chunks"),
                                   F.ceil((F.col("m") - F.col("top.n")) / BLOCK).alias("blocks")), "open-buckets")
    return labelled, dealt


def to_compare(labelled: DataFrame, dealt: DataFrame, nodes: DataFrame, cells: DataFrame, seen: DataFrame | None) -> DataFrame:
    """The members of open buckets, dealt into chunks and blocks: side 0 are
    those outside the bucket's largest component."""
    low = cells.select("node", F.substring("cells", 1, 4 * LOW).alias("low"))
    sketched = labelled.join(dealt.hint("merge"), "bucket").join(nodes.select("node", "sketch", "bands").hint("merge"), "node").join(low.hint("merge"), "node")
    h = F.xxhash64("node")
    right = sketched.select("bucket", "node", "label", "lead", "main", "sketch", "bands", "low", F.pmod(h, "chunks").alias("chunk"),
                            F.explode(F.expr("sequence(0L, blocks - 1)")).alias("block"), F.lit(1).alias("side"), F.lit(None).cast("array<binary>").alias("seen"))
    left = sketched.where("label <> main")
    left = left.join(seen.hint("merge"), "node", "left") if seen is not None else left.withColumn("seen", F.lit(None).cast("array<binary>"))
    left = left.select("bucket", "node", "label", "lead", "main", "sketch", "bands", "low", F.explode(F.expr("sequence(0L, chunks - 1)")).alias("chunk"),
                       F.pmod(h, "blocks").alias("block"), F.lit(0).alias("side"), "seen")
    return left.unionByName(right)


def apart(pairs: DataFrame, labels: DataFrame | None) -> DataFrame:
    """The (a, b) of ``pairs`` that no chain of links joins yet."""
    if labels is None:
        return pairs
    of = lambda c: labels.select(F.col("node").alias(c), F.col("label").alias(f"_{c}")).hint("merge")
    return pairs.join(of("a"), "a", "left").join(of("b"), "b", "left").where("_a is null or _b is null or _a <> _b").select("a", "b")


def near_links(sig: DataFrame, docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame | None:
    """(node, label) of every node that has a link, or None without links."""
    nodes = written(sig.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("at"), F.any_value("bands").alias("bands"), F.any_value("sketch").alias("sketch")), "nodes")
    rows = nodes.select("node", F.posexplode("bands").alias("band", "bucket"))
    shared = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("lo"), F.max("node").alias("hi")).where("n > 1")
    leads = written(shared.select("bucket", "n", "lo", "hi"), "leads")
    sized = rows.join(leads.hint("merge"), "bucket")
    members = written(sized.select("bucket", "node", F.when(F.col("band") % 2 == 0, F.col("lo")).otherwise(F.col("hi")).alias("lead"), "n"), "members")
    need = members.select("node").distinct().join(nodes.select("node", "at").hint("merge"), "node")
    cells = written(node_cells(need, docs).dropDuplicates(["node"]), "cells")
    led = members.where("node <> lead")
    ends = led.groupBy("node").agg(*[f(F.struct("n", F.col("lead").alias("other"))).alias(c) for c, f in (("x", lambda v: F.max(F.when(F.col("lead") < F.col("node"), v))), ("y", lambda v: F.max(F.when(F.col("lead") > F.col("node"), v))))])
    first = written(_ordered(ends.select("node", F.explode(F.array("x.other", "y.other")).alias("other")).where("other is not null")).distinct(), "pairs")
    links = [written(similar(first, cells, threshold), "links")]
    discard(first)
    labels, likely = None, None
    if links[0].limit(1).count():
        labels = components(links[0])
    rest = written(apart(_ordered(led.select("node", F.col("lead").alias("other"))).distinct(), labels), "pairs")
    links.append(written(similar(rest, cells, threshold), "links"))
    discard(rest)
    for k in (FIRST, None):
        if links[-1].limit(1).count():
            discard(labels)
            labels = components(_union(links))
        labelled, dealt = open_buckets(members, labels)
        seen = None if likely is None else likely.groupBy("node").agg(F.collect_set("other").alias("seen"))  # FIRST a bucket at most
        now = written(likely_partners(to_compare(labelled, dealt, nodes, cells, seen), k), "likely")
        tried = written(_ordered(now).distinct(), "pairs")
        links.append(written(similar(tried, cells, threshold), "links"))
        discard(labelled, dealt, tried, likely)
        likely = now
    if links[-1].limit(1).count():
        discard(labels)
        labels = components(_union(links))
    discard(nodes, leads, members, cells, likely, *links)
    return labels


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))


def near_classes(docs: DataFrame) -> DataFrame:
    """doc_id, node, class_id (smallest doc_id of the class), class_size and
    kept (one row of each class) for every document."""
    sig = written(signatures(docs), "signatures")
    labels = near_links(sig, docs)
    rows = written(sig.select("doc_id", "node"), "rows")
    discard(sig)
    counted = rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
    labelled = counted.withColumn("label", F.col("node")) if labels is None else (
        counted.join(labels.select("node", "label").hint("merge"), "node", "left").withColumn("label", F.coalesce("label", "node")))
    labelled = written(labelled, "node-labels")
    discard(labels)
    classes = written(labelled.groupBy("label").agg(F.min("first").alias("class_id"), F.sum("n").alias("class_size")), "classes")
    of_node = written(labelled.join(classes.hint("merge"), "label").select("node", "class_id", "class_size", (F.col("label")).alias("label")), "node-classes")
    # one node holds the class's first document: the smallest node among those with that id
    keeper = labelled.join(classes.hint("merge"), "label").where(F.col("first").eqNullSafe(F.col("class_id"))).groupBy("label").agg(F.min("node").alias("keeper"))
    of_node = written(of_node.join(keeper.hint("merge"), "label").select("node", "class_id", "class_size", (F.col("node") == F.col("keeper")).alias("keeps")), "node-classes")
    same = rows.where("node is not null").groupBy("doc_id", "node").agg(F.count(F.lit(1)).alias("copies"))
    found = (same.join(of_node.hint("merge"), "node")
             .select("doc_id", "node", "class_id", "class_size", "keeps", F.explode(F.expr("sequence(1L, copies)")).alias("copy"))
             .select("doc_id", "node", "class_id", "class_size", (F.col("keeps") & F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("copy") == 1)).alias("kept")))
    alone = rows.where("node is null").select("doc_id", "node", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"), F.lit(True).alias("kept"))
    return found.unionByName(alone)


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each class, with all its columns."""
    keyed = row_keyed(docs)
    gone = written(near_classes(keyed.select(F.col("_row").alias("doc_id"), "text")).where("not kept").select(F.col("doc_id").alias("_row")), "near-gone")
    return keyed.join(gone.hint("merge"), "_row", "left_anti").select(*docs.columns)


def op1_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(documents(spark, sf_dir)).select("doc_id", "class_id", "class_size", "kept")
