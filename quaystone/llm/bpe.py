"""Byte-level BPE encoding of whole texts with a public vocabulary.

A text is cut into pieces by the vocabulary's pattern, whose pieces join to the text exactly. Within a piece a segment tree
over its byte positions holds, at each live position, the rank of the pair that begins there; its root is the leftmost pair
of least rank. A merge takes the root, links past the swallowed position, and updates at most three leaves, so a piece of
n bytes takes O(n log n) steps however long it is.

Defined results: null and empty texts give an empty list; the strings of special tokens are ordinary text; every other text
is encoded whole, white space included; ids are those of the vocabulary's ranks.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from quaystone.runtime import pick, ship

#: The pieces kept per worker with their ids, and the longest piece that is kept; a full cache starts anew.
CACHE_PIECES, CACHE_BYTES = 400_000, 64
# The pattern by which the vocabulary cuts a text into pieces.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NONE = 1 << 62


def read_ranks(raw: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in raw.splitlines() if line)}


class PairTree:
    """The leftmost least pair of a piece under point updates; keys are rank * width + position."""

    def __init__(self, keys: list[int]):
        self.width = 1 << max(0, (len(keys) - 1).bit_length())
        self.nodes = [NONE] * self.width + keys + [NONE] * (self.width - len(keys))
        for i in range(self.width - 1, 0, -1):
            a, b = self.nodes[2 * i], self.nodes[2 * i + 1]
            self.nodes[i] = a if a < b else b

    def put(self, at: int, key: int) -> None:
        nodes, i = self.nodes, at + self.width
        nodes[i] = key
        while i > 1:
            i >>= 1
            a, b = nodes[2 * i], nodes[2 * i + 1]
            new = a if a < b else b
            if nodes[i] == new:
                break
            nodes[i] = new

    def least(self) -> int:
        return self.nodes[1]


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one piece."""
    if (whole := ranks.get(piece)) is not None:
        return [whole]
    n = len(piece)
    token = [piece[i : i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))

    def key(i: int) -> int:
        j = after[i]
        rank = ranks.get(token[i] + token[j]) if j < n else None
        return NONE if rank is None else rank * n + i

    tree = PairTree([key(i) for i in range(n)])
    while (least := tree.least()) != NONE:
        i = least % n
        j = after[i]
        token[i] += token[j]
        token[j] = b""
        k = after[i] = after[j]
        if k < n:
            before[k] = i
        tree.put(j, NONE)
        tree.put(i, key(i))
        if (p := before[i]) >= 0:
            tree.put(p, key(p))
    return [ranks[t] for t in token if t]


class Encoder:
    def __init__(self, raw: bytes, pattern: str = PIECES):
        import regex

        self.ranks, self.find, self.known = read_ranks(raw), regex.compile(pattern).findall, {}

    def piece(self, text: str) -> list[int]:
        ids = merge(raw := text.encode(), self.ranks)
        if len(raw) <= CACHE_BYTES:
            if len(self.known) >= CACHE_PIECES:
                self.known.clear()
            self.known[text] = ids
        return ids

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        out, known = [], self.known
        for p in self.find(text):
            ids = known.get(p)
            out += self.piece(p) if ids is None else ids
        return out


_encoders: dict[int, Encoder] = {}


def _encoder(raw: bytes) -> Encoder:
    """The encoder of this worker process, which outlives a task."""
    key = hash(raw)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(raw)
    return _encoders[key]


def encode_texts(docs: DataFrame, key: str, text: str, vocabulary: str, out: str = "ids") -> DataFrame:
    """(key, out): the token ids of each text. vocabulary is the path of a rank file, read here and broadcast (under 1 MB)."""
    ship(docs.sparkSession)
    with open(vocabulary, "rb") as f:
        raw = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(raw.value)
        for b in batches:
            ids = pa.array([encoder.encode(t) for t in b.column(1).to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(0), ids], names=[key, out])

    return pick(docs, [key, text]).mapInArrow(run, f"`{key}` {dict(docs.dtypes)[key]}, `{out}` array<int>")


def decode_ids(encoded: DataFrame, key: str, ids: str, vocabulary: str, out: str = "text") -> DataFrame:
    """(key, out): the text that each list of ids spells; null lists give null."""
    ship(encoded.sparkSession)
    with open(vocabulary, "rb") as f:
        raw = encoded.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = {rank: piece for piece, rank in read_ranks(raw.value).items()}
        for b in batches:
            texts = [None if x is None else b"".join(map(token.__getitem__, x)).decode() for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=[key, out])

    return pick(encoded, [key, ids]).mapInArrow(run, f"`{key}` {dict(encoded.dtypes)[key]}, `{out}` string")
