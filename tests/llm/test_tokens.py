"""Operators 7, 8 and 10: ids, decoding, shards and packing."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from auditlens.llm.bpe import codec, digest_documents, encode_documents
from auditlens.llm.common import fresh_path
from auditlens.llm.packing import BestFit, pack, pack_documents, pack_pieces
from auditlens.llm.training_order import feistel, materialise, read_records, split_bits
from auditlens.llm.words import library_ids

FILE = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [None, "", " ", "Hello, WORLD! it's 12 o'clock", "a\x1cb \x85c <|endoftext|>x<|startoftext|>", "ﬁ ΑΣ Σ İ x́ 각 é", "日本語 ½ ² 😀😀", "ab" * 5000, "word " * 3000]


@pytest.fixture(scope="module")
def reference():
    tk = Tokenizer.from_file(FILE)
    return lambda t: tk.encode(t or "", add_special_tokens=False).ids, lambda ids: tk.decode(ids, skip_special_tokens=False)


def test_ids_equal_the_library(reference, words):
    rng = random.Random(1)
    texts = TEXTS + [" ".join(rng.sample(words, 50)).capitalize() + "!!" for _ in range(50)]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 0x250), rng.randrange(1, 0xD7FF), rng.randrange(0xE000, 0x20000)])) for _ in range(40)) for _ in range(200)]
    texts.append("".join("a" + chr(c) + "a " for c in range(1, 0x600)))
    encode, decode = reference
    encoder, decoder = codec(FILE)
    for t, mine, other in zip(texts, encoder.texts(texts), library_ids(FILE).texts(texts), strict=True):
        ids = encode(t)
        assert np.frombuffer(mine, "<u4").tolist() == ids
        assert mine == other
        assert decoder(ids).decode() == decode(ids)


def test_small_caches_give_the_same_ids(reference, words):
    """The pipeline's stages share their workers, so its caches are smaller; another caller's bounds come back."""
    from corpus_pipeline import CACHES

    encode, _ = reference
    wide = library_ids(FILE)
    assert CACHES["max_chunks"] < wide.max_chunks and CACHES["max_pieces"] < wide.max_pieces
    wide.clear()
    wide.piece_ids.clear()
    small = library_ids(FILE, max_chunks=20, max_pieces=10)
    texts = [" ".join(words[i : i + 15]) for i in range(60)]
    for t, ids in zip(texts, small.texts(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == encode(t)
        assert len(small) <= 35 and len(small.piece_ids) <= 40
    assert library_ids(FILE).max_chunks == 600_000


def test_digest_query(spark, table, reference):
    encode, decode = reference
    docs = table([(i, t) for i, t in enumerate(TEXTS)], extra=["n_tokens", "ids_sha256"])
    got = {r.doc_id: r for r in digest_documents(docs, FILE).collect()}
    for i, t in enumerate(TEXTS):
        ids = encode(t)
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(decode(ids).encode()).hexdigest()
    assert digest_documents(table([]), FILE).collect() == []
    assert encode_documents(table([(1, "a"), (1, "a"), (None, "b")]), FILE).count() == 3


def test_packing_is_whole_and_close(spark, table, reference, words):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choices(words, k=rng.choice([3, 40, 300, 900])))) for i in range(60)] + [(100 + i, t) for i, t in enumerate(TEXTS)] + [(100, None), (None, "x")]
    got = pack_documents(table(rows, extra=["sequence_id", "length"]), FILE, 512).collect()
    encode, _ = reference
    pieces = defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
    for i, t in rows[:-2]:
        if i == 100:
            continue
        ids = [*encode(t), 0]
        own = sorted(pieces[i], key=lambda r: r.piece)
        assert [(r.start, r.length) for r in own] == [(s, min(512, len(ids) - s)) for s in range(0, len(ids), 512)]
        assert [r.ids_crc32 for r in own] == [zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes()) for r in own]
    assert len(pieces[100]) == 2 and len(pieces[None]) == 1
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for ps in places.values():
        at = 0
        for offset, length in sorted(ps):
            assert offset == at
            at += length
        assert at <= 512
    assert len(places) <= 1.03 * sum(r.length for r in got) / 512 + 2
    assert pack_documents(table([]), FILE).collect() == []


def test_best_fit_closes_the_fullest():
    bins = BestFit(10, 2)
    assert bins.put(4, "a") == [] and bins.put(9, "b") == []
    assert bins.put(7, "c") == [["b"]]  # no room anywhere: the fullest goes
    assert bins.put(3, "d") == [["c", "d"]]  # the tightest that fits
    out = list(pack(iter([(6, 1), (6, 2), (4, 3), (4, 4), (10, 5)]), 10, 1))
    assert sorted(sorted(x for _, x in b) for b in out) == [[1, 4], [2, 3], [5]] or sum(len(b) for b in out) == 5


def naive_best_fit(sizes, capacity, n_open):
    """Bins as lists, found by looking at every open bin."""
    open_bins, done = [], []  # (free, last use, items)
    for at, size in enumerate(sizes):
        fitting = [b for b in open_bins if b[0] >= size]
        if fitting:
            b = min(fitting, key=lambda b: (b[0], -b[1]))
            open_bins.remove(b)
        else:
            if len(open_bins) >= n_open:
                full = min(open_bins, key=lambda b: (b[0], -b[1]))
                open_bins.remove(full)
                done.append(full[2])
            b = [capacity, at, []]
        b = [b[0] - size, at, [*b[2], at]]
        if b[0]:
            open_bins.append(b)
        else:
            done.append(b[2])
    return done, [b[2] for b in open_bins]


def test_best_fit_equals_a_scan_of_all_bins():
    rng = random.Random(6)
    for n_open in (1, 3, 20):
        sizes = [rng.choice([1, 2, 3, 5, 8, 13, 20]) for _ in range(600)]
        bins, closed = BestFit(20, n_open), []
        for at, size in enumerate(sizes):
            closed += bins.put(size, at)
        done, rest = naive_best_fit(sizes, 20, n_open)
        assert closed == done and sorted(bins.rest()) == sorted(rest)


def test_packing_follows_from_the_rows_alone(spark):
    rows = [(i % 40 if i % 3 else 7, 0, 0, 3 + (i % 40 if i % 3 else 7), 5) for i in range(600)] + [(None, 0, 0, 9, 1)] * 300
    schema = "doc_id LONG, piece INT, start LONG, length LONG, ids_crc32 LONG"

    def packed(order):
        out = pack_pieces(spark.createDataFrame(order, schema).repartition(3), 64, 4, 100).collect()
        return sorted(out, key=repr)

    one, other = packed(rows), packed(rows[::-1][400:] + rows[::-1][:400])
    assert one == other
    assert sorted(((r.doc_id, r.length) for r in one), key=repr) == sorted(((r[0], r[3]) for r in rows), key=repr)


def test_copies_of_a_piece_are_dealt_to_many_tasks(spark):
    pieces = spark.range(9000).selectExpr("if(id < 6000, 1L, id) AS doc_id", "0 AS piece", "0L AS start", "7L AS length", "3L AS ids_crc32")
    per = [n for _, n in pack_pieces(pieces, 2048, 16, 900).groupBy(F.shiftright("sequence_id", 40)).count().collect()]
    assert sum(per) == 9000 and max(per) < 4 * 1024 and len(per) > 5


def plain_feistel(number, domain, key):
    """One number at a time, in Python's own integers."""
    half = max(1, (max(domain - 1, 1).bit_length() + 1) // 2)
    mask, word = (1 << half) - 1, (1 << 64) - 1
    while True:
        left, right = number >> half, number & mask
        for i in range(6):
            x = (right + key * 0x9E3779B97F4A7C15 + i * 0xD1B54A32D192ED03) & word
            x = ((x ^ x >> 30) * 0xBF58476D1CE4E5B9) & word
            x = ((x ^ x >> 27) * 0x94D049BB133111EB) & word
            left, right = right, left ^ ((x ^ x >> 31) & mask)
        number = left << half | right
        if number < domain:
            return number


@pytest.mark.parametrize("domain", [1, 2, 7, 1000, 4097])
def test_feistel_is_a_permutation(domain):
    out, below = feistel(np.arange(domain, dtype=np.uint64), domain, 20)
    assert sorted(out.tolist()) == list(range(domain)) and not below.any()
    assert domain < 100 or np.abs(np.corrcoef(np.arange(domain), out)[0, 1]) < 0.15
    assert out.tolist() == [plain_feistel(n, domain, 20) for n in range(domain)]


@pytest.mark.parametrize("domain", [(1 << 62) - 5, 1 << 62, (1 << 64) + 1, 5001 << 61, (1 << 91) + 12345])
def test_feistel_of_wide_numbers(domain):
    rng = random.Random(7)
    numbers = [0, domain - 1, *(rng.randrange(domain) for _ in range(300))]
    out, below = feistel(numbers, domain, 20)
    extra = split_bits(domain)
    places = [int(p) << extra | int(b) for p, b in zip(out, below, strict=True)]
    assert places == [plain_feistel(n, domain, 20) for n in numbers]
    assert out.max() < 1 << 62 and len(set(places)) == len(set(numbers))


@pytest.mark.parametrize("ids", [[1, 2, 3, 9], [1, 1 << 50, (1 << 50) + 1, 1 << 61], [-(1 << 63), -5, 0, (1 << 63) - 1]])
def test_slots_equal_a_plain_sort_of_places(spark, table, reference, ids):
    texts = ["one two three", "ab cd " * 50_000, None, "x " * 90]
    got = materialise(table(list(zip(ids, texts, strict=True))), FILE, fresh_path(spark, "order-test"), stride=64, shard_mb=0.05).orderBy("slot").collect()
    encode, _ = reference
    most = -(-(4 * max(len(t or "") for t in texts) + 1) // 64) + 1
    domain = (max(ids) - min(ids) + 1) * most
    keys = [(i, p) for i, t in zip(ids, texts, strict=True) for p in range(-(-(len(encode(t)) + 1) // 64))]
    assert [(r.doc_id, r.piece) for r in got] == sorted(keys, key=lambda k: plain_feistel((k[0] - min(ids)) * most + k[1], domain, 20))
    assert [r.slot for r in got] == list(range(len(keys)))


def test_training_order_round_trip(spark, table, reference, words):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices(words, k=rng.choice([0, 5, 200])))) for i in range(40)] + [(90, None)]
    folder = fresh_path(spark, "order-test")
    index = materialise(table(rows, extra=["slot", "shard"]), FILE, folder, stride=32, shard_mb=0.01).collect()
    encode, _ = reference
    assert sorted(r.slot for r in index) == list(range(len(index)))
    assert len({r.shard for r in index}) > 1
    read = {s: read_records(folder, s, stride=32) for s in {r.shard for r in index}}
    back = defaultdict(dict)
    for r in index:
        record = read[r.shard][r.position // 64]
        assert zlib.crc32(record[: r.n_tokens].tobytes()) == r.ids_crc32
        back[r.doc_id][r.piece] = record[: r.n_tokens].tolist()
    for i, t in rows:
        assert sum((back[i][p] for p in sorted(back[i])), []) == [*encode(t), 0]
    one = index[len(index) // 2]
    assert read_records(folder, one.shard, one.position // 64, 1, stride=32).tolist()[0] == read[one.shard][one.position // 64].tolist()
    order = [(r.doc_id, r.piece) for r in sorted(index, key=lambda r: r.slot)]
    again = materialise(table(rows).repartition(5), FILE, fresh_path(spark, "order-test"), stride=32, shard_mb=0.01).orderBy("slot").collect()
    assert order == [(r.doc_id, r.piece) for r in again]


def test_training_order_edges(spark, table):
    assert materialise(table([]), FILE, fresh_path(spark, "order-test")).collect() == []
    got = materialise(table([(1, "a"), (1, "a"), (None, "b")]), FILE, fresh_path(spark, "order-test")).collect()
    assert sorted(r.slot for r in got) == [0, 1, 2]


def test_ids_fit_two_bytes():
    assert max(Tokenizer.from_file(FILE).get_vocab(with_added_tokens=True).values()) < 1 << 16


def test_registered_queries_cover_all_rows(spark):
    from auditlens.llm.registry import QUERIES
    from tests.conftest import SF

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    n, tokens = docs.count(), QUERIES["op7_pair_index_bpe"](spark, SF).agg(F.sum("n_tokens"), F.count("*")).first()
    packed = QUERIES["op10_best_fit"](spark, SF).agg(F.sum("length"), F.countDistinct("doc_id")).first()
    assert tokens[1] == n == packed[1] and tokens[0] + n == packed[0]
