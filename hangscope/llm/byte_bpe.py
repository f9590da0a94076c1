"""Byte-level BPE encoding and decoding by a rank file, merges found with a segment tree.

A text is cut by a pattern into pieces; each piece is encoded by itself.  A
piece that is a token as it stands is that token.  Otherwise its bytes are
joined pair by pair, always the pair whose joint bytes have the lowest rank,
the leftmost of equal ones, until no joint pair has a rank.

``merge`` keeps a segment tree over the byte positions of a piece.  The leaf of
a position where a live part starts holds the rank of that part joined with its
right neighbour, with the position in the low bits, so the root is the leftmost
pair of lowest rank.  A merge updates three leaves (the joined part, the part
that is gone, the left neighbour) and the path above each, and two links to
live neighbours: O(n log n) for a piece of n bytes, so a run of a million
letters is no special case.

Whole texts: a long text is cut into pieces window by window.  What the pattern
finds near a window's end may depend on what follows, so those pieces are left
to the next window; a window that holds no other piece is doubled.  Digests of
ids and of decoded bytes are fed window by window, so what a task holds beside
the text does not grow with it.  Tokens of short pieces are kept per worker, in
two rounds of ``CACHE_BYTES``: when a round is full the one before it is
forgotten, but for the pieces that were met again.

Edge cases: null text counts as empty (no tokens, digests of nothing);
repeated rows stay repeated; other columns pass through untouched if they are
asked for (not those named like an added one); an empty table gives an empty
result.  A
rank file that lacks a single byte raises when a text needs that byte.
"""

from __future__ import annotations

import base64
import hashlib
import struct

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_arrow

WINDOW = 1 << 13            # characters of a long text cut into pieces at a time
AHEAD = 16                  # characters after a piece that the pattern may look at
CACHE_BYTES = 1 << 27       # of pieces and their ids, per worker, and as much again of older ones
CACHED_PIECE = 64           # longest piece kept, in characters
ENTRY_BYTES = 200           # of a kept piece beside its text and ids
_NONE = 1 << 62
_OPEN: dict[tuple[str, str], Codec] = {}


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to id, of a file with a base64 token and its rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def merge(piece: bytes, ranks: dict[bytes, int], longest: int) -> list[bytes]:
    """The parts of ``piece`` after all merges."""
    n = len(piece)
    if n < 2:
        return [piece] if n else []
    width = 1 << (n - 2).bit_length()  # the last position never has a right neighbour
    low = width.bit_length()
    place, rank_of = (1 << low) - 1, ranks.get
    end = list(range(1, n + 1))        # of the part that starts at a position
    left = list(range(-1, n - 1))      # where the live part before it starts
    tree = [_NONE] * (2 * width)       # leaf of a part: rank of it and its right neighbour, and the place
    for i in range(n - 1):
        rank = rank_of(piece[i:i + 2])
        if rank is not None:
            tree[width + i] = rank << low | i
    for k in range(width - 1, 0, -1):
        a, b = tree[2 * k], tree[2 * k + 1]
        tree[k] = a if a < b else b
    while tree[1] != _NONE:
        i = tree[1] & place
        gone = end[i]
        stop = end[i] = end[gone]
        tree[width + i] = _NONE
        if stop < n:
            tree[width + gone] = _NONE
            left[stop] = i
            if end[stop] - i <= longest and (rank := rank_of(piece[i:end[stop]])) is not None:
                tree[width + i] = rank << low | i
        before = left[i]
        if before < 0:
            before = i
        else:
            known = rank_of(piece[before:stop]) if stop - before <= longest else None
            tree[width + before] = _NONE if known is None else known << low | before
        # the paths above the three leaves, each common node once
        x, y, z = width + before, width + i, width + (gone if stop < n else i)
        while x > 1:
            x, y, z = x >> 1, y >> 1, z >> 1
            a, b = tree[2 * x], tree[2 * x + 1]
            tree[x] = a if a < b else b
            if y != x:
                a, b = tree[2 * y], tree[2 * y + 1]
                tree[y] = a if a < b else b
            if z != y:
                a, b = tree[2 * z], tree[2 * z + 1]
                tree[z] = a if a < b else b
    out, i = [], 0
    while i < n:
        out.append(piece[i:end[i]])
        i = end[i]
    return out


class Codec(dict):
    """Pieces of text to their ids as little-endian unsigned 32-bit integers; looks up a piece by ``codec[piece]``."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        super().__init__()
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.tokens = {i: t for t, i in ranks.items()}
        self.longest = max(map(len, ranks), default=0)
        self.held, self.older = 0, {}

    def __missing__(self, piece: str) -> bytes:
        packed = self.older.get(piece) or self._packed(piece)
        if len(piece) <= CACHED_PIECE:
            self.held += ENTRY_BYTES + 5 * len(piece)
            if self.held > CACHE_BYTES:
                # pieces of the last round that are met again are taken over
                self.older, self.held = dict(self), 0
                self.clear()
            self[piece] = packed
        return packed

    def _packed(self, piece: str) -> bytes:
        data = piece.encode("utf-8")
        whole = self.ranks.get(data)
        ids = [whole] if whole is not None else [self.ranks[t] for t in merge(data, self.ranks, self.longest)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def blocks(self, text: str | None):
        """The ids of a text, as bytes, a window at a time."""
        for pieces in self.cut(text or ""):
            yield b"".join(map(self.__getitem__, pieces))

    def cut(self, text: str):
        """Lists of the pieces of a text.  Must not be a pattern that looks back."""
        at, size = 0, WINDOW
        while len(text) - at > size:
            settled, end = [], 0
            for m in self.pattern.finditer(text[at:at + size]):
                if m.end() > size - AHEAD:
                    break
                settled.append(m[0])
                end = m.end()
            yield settled
            at, size = (at + end, WINDOW) if settled else (at, 2 * size)
        yield self.pattern.findall(text[at:] if at else text)

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(b"".join(self.blocks(text)), "<u4").tolist()

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def open_codec(path: str, pattern: str) -> Codec:
    """The codec of a rank file, opened once per worker."""
    if (path, pattern) not in _OPEN:
        _OPEN[path, pattern] = Codec(read_ranks(path), pattern)
    return _OPEN[path, pattern]


def _with_codec(docs: DataFrame, ranks: str, pattern: str, column: str, keep: list[str], added: list[T.StructField], row) -> DataFrame:
    """``keep`` columns of ``docs`` and, as ``added``, what ``row(codec, value of column)`` gives."""
    keep = [c for c in keep if c not in [f.name for f in added]]
    kept = [docs.schema[c] for c in keep]

    def run(batches):
        codec = open_codec(ranks, pattern)
        for b in batches:
            # one value at a time as a Python object: the batch itself stays in Arrow's memory
            rows = [row(codec, v.as_py()) for v in b.column(0)]
            yield [*b.columns[1:], *(pa.array([r[i] for r in rows], f) for i, f in enumerate(arrow))]

    arrow = [{T.LongType(): pa.int64(), T.StringType(): pa.string(), T.BinaryType(): pa.binary()}.get(f.dataType) or pa.list_(pa.int32()) for f in added]
    src = docs.select(F.col(f"`{column}`"), *[F.col(f"`{c}`") for c in keep])
    return map_arrow(src, run, T.StructType([*kept, *added]))


def encode_texts(docs: DataFrame, ranks: str, pattern: str, text: str = "text", keep: list[str] = ("doc_id",), ids: str = "ids") -> DataFrame:
    """``keep`` columns and the ids of each text as an array (null: empty)."""
    return _with_codec(docs, ranks, pattern, text, list(keep), [T.StructField(ids, T.ArrayType(T.IntegerType()))], lambda codec, v: [codec.encode(v)])


def decode_ids(encoded: DataFrame, ranks: str, pattern: str, ids: str = "ids", keep: list[str] = ("doc_id",), data: str = "data") -> DataFrame:
    """``keep`` columns and the bytes of each array of ids (null: empty; text cut inside a character need not be valid UTF-8)."""
    return _with_codec(encoded, ranks, pattern, ids, list(keep), [T.StructField(data, T.BinaryType())], lambda codec, v: [codec.decode(v or ())])


def round_trip_digests(docs: DataFrame, ranks: str, pattern: str, text: str = "text", keep: list[str] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``n_tokens``, SHA-256 of the ids (little-endian unsigned 32 bits) and of the bytes that they decode to."""

    def row(codec, v):
        n, coded, decoded = 0, hashlib.sha256(), hashlib.sha256()
        for block in codec.blocks(v):
            n += len(block) // 4
            coded.update(block)
            decoded.update(codec.decode(np.frombuffer(block, "<u4").tolist()))
        return n, coded.hexdigest(), decoded.hexdigest()

    added = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    return _with_codec(docs, ranks, pattern, text, list(keep), added, row)
