"""Byte-pair encoding with a pair occurrence index, and decoding.

A block of distinct pieces is laid out as one array of symbols.  The index maps
the rank of each mergeable pair to all positions where it occurs; active ranks
are taken in ascending order from a heap, each is applied at all its positions
from left to right, and the pairs that a merge makes are entered under their
own ranks (entries of pairs that a merge destroyed are skipped when met).
Pieces never merge with each other, so this equals encoding them one by one.

Spark deals the documents out; each Python worker keeps a bounded cache of
encoded chunks.  Null and empty texts have no ids and decode to the empty
text; very long texts are encoded whole, in blocks of chunks; columns other
than the id and the text are not touched.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from auditlens.llm.common import documents
from auditlens.llm.words import ChunkIds, Splitter


class PairIndexBpe:
    """Vocabulary, merge ranks and the block encoder of one tokenizer file."""

    def __init__(self, tokenizer_file: str):
        import json

        with open(tokenizer_file, encoding="utf-8") as f:
            model = json.load(f)["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.end: str = model.get("end_of_word_suffix") or ""
        self.size = max(self.ids.values()) + 1
        self.rank: dict[int, int] = {}
        self.merged: list[int] = []
        for pair in model["merges"]:
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.rank.setdefault(self.ids[left] * self.size + self.ids[right], len(self.merged))
            self.merged.append(self.ids[left + right])

    def encode(self, pieces: list[str], block: int = 50_000) -> list[list[int]]:
        out: list[list[int]] = []
        for at in range(0, len(pieces), block):
            out += self._encode_block(pieces[at : at + block])
        return out

    def _encode_block(self, pieces: list[str]) -> list[list[int]]:
        ids, end, size, rank_of = self.ids, self.end, self.size, self.rank.get
        symbols: list[int] = []  # -1: merged into its left neighbour, or a border between pieces
        starts: list[int] = []
        for p in pieces:
            starts.append(len(symbols))
            if p:
                symbols += [ids[c] for c in p[:-1]]
                symbols.append(ids[p[-1] + end])
            symbols.append(-1)
        n = len(symbols)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        where: dict[int, list[int]] = {}
        for i in range(n - 1):
            left, right = symbols[i], symbols[i + 1]
            if left >= 0 and right >= 0 and (r := rank_of(left * size + right)) is not None:
                if r in where:
                    where[r].append(i)
                else:
                    where[r] = [i]
        active = list(where)
        heapq.heapify(active)
        pair_of = self._pairs()
        while active:
            r = heapq.heappop(active)
            places = where.pop(r)
            left, right = pair_of[r]
            new = self.merged[r]
            places.sort()
            for i in places:
                if symbols[i] != left:
                    continue
                j = after[i]
                if symbols[j] != right:
                    continue
                symbols[i], symbols[j] = new, -1
                k = after[j]
                after[i], before[k] = k, i
                if symbols[k] >= 0 and (q := rank_of(new * size + symbols[k])) is not None:
                    if q in where:
                        where[q].append(i)
                    else:
                        where[q] = [i]
                        heapq.heappush(active, q)
                h = before[i]
                if h >= 0 and symbols[h] >= 0 and (q := rank_of(symbols[h] * size + new)) is not None:
                    if q in where:
                        where[q].append(h)
                    else:
                        where[q] = [h]
                        heapq.heappush(active, q)
        borders = [*starts[1:], n]
        return [[s for s in symbols[a:b] if s >= 0] for a, b in zip(starts, borders, strict=True)]

    def _pairs(self) -> list[tuple[int, int]]:
        if not hasattr(self, "_pair_of"):
            self._pair_of = [(0, 0)] * len(self.merged)
            for key, r in self.rank.items():
                self._pair_of[r] = divmod(key, self.size)
        return self._pair_of


class Decoder:
    """Token strings by id; decoding joins them with blanks, as the library
    does for files that name no decoder."""

    def __init__(self, splitter: Splitter):
        top = splitter.tokenizer.get_vocab(with_added_tokens=True)
        self.tokens = [b""] * (max(top.values()) + 1)
        for token, i in top.items():
            self.tokens[i] = token.encode()

    def __call__(self, ids: list[int]) -> bytes:
        return b" ".join(map(self.tokens.__getitem__, ids))


_CODECS: dict[str, tuple[ChunkIds, Decoder]] = {}


def codec(tokenizer_file: str) -> tuple[ChunkIds, Decoder]:
    """Encoder and decoder of this Python worker."""
    if tokenizer_file not in _CODECS:
        splitter = Splitter(tokenizer_file)
        _CODECS[tokenizer_file] = ChunkIds(splitter, PairIndexBpe(tokenizer_file).encode), Decoder(splitter)
    return _CODECS[tokenizer_file]


def encode_documents(docs: DataFrame, tokenizer_file: str) -> DataFrame:
    """doc_id and ids (little-endian uint32, binary) of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, _ = codec(tokenizer_file)
        for batch in batches:
            ids = list(encoder.texts(batch.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids binary")


def digest_documents(docs: DataFrame, tokenizer_file: str) -> DataFrame:
    """doc_id, n_tokens, and digests of the ids and of the decoded text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from array import array
        from hashlib import sha256

        encoder, decode = codec(tokenizer_file)
        for batch in batches:
            n, of_ids, of_text = [], [], []
            for ids in encoder.texts(batch.column(1).to_pylist()):
                n.append(len(ids) // 4)
                of_ids.append(sha256(ids).hexdigest())
                of_text.append(sha256(decode(array("I", ids).tolist())).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op7_pair_index_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digest_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
