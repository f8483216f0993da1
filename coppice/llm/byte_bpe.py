"""Byte-level BPE over a rank file, with a hierarchical bitmap as the queue of ranks.

A pre-token is a linked list of byte strings. The pairs waiting to be merged lie in buckets, one for each merge rank,
that hold list positions. A two-level bitmap marks which buckets are filled: one 256-bit word for each 256 ranks, and
a summary word over those words. The lowest set bit of the summary, then of its word, is the next rank; both are
found without a search. A bucket's entry is stale, and skipped, if its position was merged away or its pair has
changed since. Each merge adds two entries at most, so a pre-token of n bytes takes O(n) steps, however long it is.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import chunks as C
from .shared import numbered

_coders: dict = {}


class Coder:
    """Encodes and decodes as the library of rank files does, without special tokens."""

    def __init__(self, path: str, pattern: str, cache_size: int = 400_000) -> None:
        import regex

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.bytes = {v: k for k, v in self.ranks.items()}
        self.find = regex.compile(pattern).findall
        self.memo = C.Memo(cache_size)
        #: The lower level of the bitmap: all zero between pre-tokens.
        self.words = [0] * ((max(self.bytes, default=0) >> 8) + 1)

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one pre-token. The queue is written out in the loop, which runs some ten million times a minute."""
        rank_of = self.ranks.get
        whole = rank_of(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        part: list[bytes | None] = [piece[i : i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pair = [rank_of(piece[i : i + 2], -1) for i in range(n - 1)]  # the rank of the pair that begins here, -1 if it has none
        pair.append(-1)
        buckets: dict[int, list[int]] = {}
        words, summary = self.words, 0
        for i, r in enumerate(pair):
            if r >= 0:
                if r in buckets:
                    buckets[r].append(i)
                else:
                    buckets[r] = [i]
                    words[r >> 8] |= 1 << (r & 255)
                    summary |= 1 << (r >> 8)
        while summary:
            high = (summary & -summary).bit_length() - 1
            word = words[high]
            lowest = word & -word
            words[high] = word = word ^ lowest
            if not word:
                summary &= summary - 1
            rank = high << 8 | lowest.bit_length() - 1
            positions = buckets.pop(rank)
            if len(positions) > 1:
                positions.sort()
            for i in positions:
                if pair[i] != rank:
                    continue  # stale
                j = after[i]
                k = after[j]
                merged = part[i] + part[j]
                part[i], part[j], after[i] = merged, None, k
                pair[j] = pair[i] = -1
                if k < n:
                    before[k] = i
                    r = rank_of(merged + part[k], -1)
                    if r >= 0:
                        pair[i] = r
                        if r in buckets:
                            buckets[r].append(i)
                        else:
                            buckets[r] = [i]
                            words[r >> 8] |= 1 << (r & 255)
                            summary |= 1 << (r >> 8)
                h = before[i]
                if h >= 0:
                    pair[h] = r = rank_of(part[h] + merged, -1)
                    if r >= 0:
                        if r in buckets:
                            buckets[r].append(h)
                        else:
                            buckets[r] = [h]
                            words[r >> 8] |= 1 << (r & 255)
                            summary |= 1 << (r >> 8)
        return [self.ranks[p] for p in part if p is not None]

    def encode(self, text: str) -> list[int]:
        return [i for piece in self.find(text) for i in self.merge(piece.encode())]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.bytes[i] for i in ids])

    def rendered(self, chunks: pa.Array) -> list[pa.Array]:
        """Of each chunk: its ids in decimal, each followed by a comma; the bytes that they decode to; how many they are."""
        ids = [self.encode(c) for c in chunks.to_pylist()]
        decimal = pa.array(["".join([f"{i}," for i in x]).encode() for x in ids], pa.large_binary())
        return [decimal, pa.array([self.decode(x) for x in ids], pa.large_binary()), pa.array([len(x) for x in ids], pa.int64())]


def coder(path: str, pattern: str) -> Coder:
    if (path, pattern) not in _coders:
        _coders[path, pattern] = Coder(path, pattern)
    return _coders[path, pattern]


def _joined(parts: pa.Array, index: np.ndarray, off: np.ndarray) -> tuple[memoryview, np.ndarray]:
    """The parts in the order of ``index``, as one block, and where each text's part of it begins."""
    _, offsets, data = parts.take(pa.array(index)).buffers()
    return memoryview(data) if data is not None else memoryview(b""), np.frombuffer(offsets, np.int64)[: len(index) + 1][off]


def encode_decode(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, n_tokens, ids_sha256 (of the decimal ids joined by commas), decoded_sha256.

    Null and empty texts have no ids: both digests are those of no bytes. Repeated rows and null keys stay; other
    columns are not read, whatever their names; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path, pattern)
        for batch in batches:
            for rows, texts in C.slices(batch, "text"):
                pieces, off = C.chunked(texts)
                index, distinct = C.coded(pieces)
                each = own.memo.values(distinct, own.rendered) if len(index) else []
                n = C.summed(each[2].to_numpy()[index], off) if each else np.zeros(len(texts), np.int64)
                digests = []
                for k in (0, 1):
                    data, at = _joined(each[k], index, off) if each else (memoryview(b""), np.zeros(len(texts) + 1, np.int64))
                    digests.append([hashlib.sha256(data[a : max(a, b - (k == 0))]).hexdigest() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)])
                yield pa.RecordBatch.from_arrays([rows.column("key"), pa.array(n), pa.array(digests[0]), pa.array(digests[1])], [key, "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[key].dataType.simpleString()
    rows = numbered(docs, text).select(F.col(key).alias("key"), "text")
    return rows.mapInArrow(run, f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode_ids(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The ids themselves: key, ids array<int>; null and empty texts give an empty array."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path, pattern)
        for batch in batches:
            for rows, texts in C.slices(batch, "text"):
                ids = [own.encode(t) for t in texts.to_pylist()]
                yield pa.RecordBatch.from_arrays([rows.column("key"), pa.array(ids, pa.list_(pa.int32()))], [key, "ids"])

    kind = docs.schema[key].dataType.simpleString()
    return numbered(docs, text).select(F.col(key).alias("key"), "text").mapInArrow(run, f"`{key}` {kind}, ids array<int>")
