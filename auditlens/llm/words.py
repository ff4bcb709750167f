"""Splitting texts into the pieces that a word-end BPE tokenizer encodes one by
one, and caches of bounded size for what each white-space-free chunk becomes.

Texts are cut at white space (which such a tokenizer drops and never merges
across), so a chunk can be looked up whole.  Chunks of Latin letters, digits
and signs are split here; any other chunk is split by the tokenizer's own
normalizer and pre-tokenizer.
"""

from __future__ import annotations

import re
from itertools import chain

#: Chunks that need no normalization but lower case: ASCII and Latin up to U+024F.
PLAIN = re.compile("[!-~¡-¬®-ɏ]+")
#: Separators that str.split() knows and the tokenizer may not.
ODD_SPACE = re.compile("[\x1c-\x1f]")
ASCII_SPACE = re.compile("[\t-\r ]+")


def byte_chars() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, spare = [""] * 256, 256
    for b in range(256):
        if b in shown:
            out[b] = chr(b)
        else:
            out[b], spare = chr(spare), spare + 1
    return out


class Splitter:
    """chunks() of a text and pieces() of a chunk, each piece in stand-in
    characters or, for a special token, as its id."""

    def __init__(self, tokenizer_file: str):
        import json

        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        with open(tokenizer_file, encoding="utf-8") as f:
            spec = json.load(f)
        split = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.find = regex.compile(split).findall
        self.shown = dict(enumerate(byte_chars()))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    @staticmethod
    def chunks(text: str) -> list[str]:
        if ODD_SPACE.search(text):
            return [c for c in ASCII_SPACE.split(text) if c]
        return text.split()

    def pieces(self, chunk: str) -> list[str | int]:
        if self.cut is not None and "<" in chunk:
            out: list[str | int] = []
            for part in self.cut.split(chunk):
                if part in self.special:
                    out.append(self.special[part])
                elif part:
                    out += self._plain(part)
            return out
        return self._plain(chunk)

    def _plain(self, chunk: str) -> list[str | int]:
        if PLAIN.fullmatch(chunk):
            low = chunk.lower()
            if low.isalpha():
                found = [low]
            elif low[-1] in ".,;:!?" and low[:-1].isalpha():
                found = [low[:-1], low[-1]]
            else:
                found = self.find(low)
            if low.isascii():
                return found  # printable ASCII stands for itself
            return [p.encode().decode("latin-1").translate(self.shown) for p in found]
        pre, norm = self.tokenizer.pre_tokenizer, self.tokenizer.normalizer
        return [p for p, _ in pre.pre_tokenize_str(norm.normalize_str(chunk))]


class ChunkIds:
    """Ids of chunks as little-endian uint32 bytes, filled batch by batch by
    ``encode`` (a list of pieces -> a list of id lists).  Both caches are
    emptied when full, so a worker's memory stays bounded."""

    def __init__(self, splitter: Splitter, encode, max_chunks: int = 600_000, max_pieces: int = 400_000):
        self.splitter, self.encode = splitter, encode
        self.chunk_ids: dict[str, bytes] = {}
        self.piece_ids: dict[str, bytes] = {}
        self.max_chunks, self.max_pieces = max_chunks, max_pieces

    def texts(self, texts: list[str | None]):
        """The ids of each text (null: none) as bytes."""
        split = self.splitter.chunks
        block: list[list[str]] = []
        n = 0
        for t in texts:
            block.append(split(t) if t else [])
            n += len(block[-1])
            if n >= 200_000:
                yield from self._block(block)
                block, n = [], 0
        if block:
            yield from self._block(block)

    def _block(self, block: list[list[str]]):
        if len(self.chunk_ids) > self.max_chunks:
            self.chunk_ids = {}
        if len(self.piece_ids) > self.max_pieces:
            self.piece_ids = {}
        known = self.chunk_ids
        missing = set(chain.from_iterable(block)).difference(known)
        if missing:
            pieces_of = self.splitter.pieces
            parts = {c: pieces_of(c) for c in missing}
            ids = self.piece_ids
            new = list({p for ps in parts.values() for p in ps if p.__class__ is str and p not in ids})
            if new:
                from array import array

                for p, one in zip(new, self.encode(new), strict=True):
                    ids[p] = array("I", one).tobytes()
            for c, ps in parts.items():
                known[c] = b"".join([ids[p] if p.__class__ is str else p.to_bytes(4, "little") for p in ps])
        get = known.__getitem__
        for chunks in block:
            yield b"".join(map(get, chunks))


class LibraryIds(dict):
    """Ids of chunks by the tokenizers library's model, as little-endian
    uint32 bytes, found when a chunk is first asked for.  Emptied between texts
    when full."""

    def __init__(self, splitter: Splitter, max_chunks: int = 600_000, max_pieces: int = 400_000):
        super().__init__()
        self.splitter, self.tokenize = splitter, splitter.tokenizer.model.tokenize
        self.piece_ids: dict[str, bytes] = {}
        self.max_chunks, self.max_pieces = max_chunks, max_pieces

    def __missing__(self, chunk: str) -> bytes:
        known, out = self.piece_ids, []
        for p in self.splitter.pieces(chunk):
            if p.__class__ is int:
                out.append(p.to_bytes(4, "little"))
                continue
            ids = known.get(p)
            if ids is None:
                ids = known[p] = b"".join([t.id.to_bytes(4, "little") for t in self.tokenize(p)])
            out.append(ids)
        ids = self[chunk] = b"".join(out)
        return ids

    def texts(self, texts: list[str | None]):
        """The ids of each text (null: none) as bytes."""
        split, get = self.splitter.chunks, self.__getitem__
        for t in texts:
            if len(self) > self.max_chunks:
                self.clear()
            if len(self.piece_ids) > self.max_pieces:
                self.piece_ids.clear()
            yield b"".join(map(get, split(t))) if t else b""


_ENCODERS: dict[str, LibraryIds] = {}


def library_ids(tokenizer_file: str, max_chunks: int = 600_000, max_pieces: int = 400_000) -> LibraryIds:
    """One encoder a Python worker, with the bounds asked for last."""
    if tokenizer_file not in _ENCODERS:
        _ENCODERS[tokenizer_file] = LibraryIds(Splitter(tokenizer_file))
    encoder = _ENCODERS[tokenizer_file]
    encoder.max_chunks, encoder.max_pieces = max_chunks, max_pieces
    return encoder
