"""Sequence packing by lexical retrieval.

Documents are tokenised map-side and laid out by likeness: first by the token that is its smallest by a hash in which
later vocabulary entries, the rarer ones, weigh more, then by the second such token and by a hash of id trigrams, so
that copies and texts on the same matter stand side by side. The order is cut into shards of about ``shard_ids`` ids,
whatever the keys or the sizes of groups. In a shard, a BM25 inverted index over token ids, with the document
frequencies and the mean length of all documents, returns, for a seed document, its unused neighbours, best first; they
fill the seed's window greedily. First the seed's heaviest terms ask, then, if the window is not full, all its terms.
A document that reaches over the window's end is cut there, its rest begins the next window, and it becomes the seed.
If a seed has no unused neighbour left, the first unused document is the next seed. Only the last window of a shard is
not full.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import chunks as C
from .exchange import mixed
from .shared import numbered, stored

_encoders: dict = {}

#: Latin letters only: one pre-token for sure. The dotted capital I is left out, its lower case is two characters.
_PLAIN = "^[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+$"


class Encoder:
    """Ids of texts by a tokenizers file, chunk by chunk; the chunks of earlier texts are looked up in an Arrow table."""

    def __init__(self, path: str, cache_size: int = 300_000) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tokenizers

        self.model = tokenizers.Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()
        self.size = max(self.model.get_vocab().values()) + 1
        self.kind = np.uint16 if self.size <= 1 << 16 else np.uint32
        self.memo = C.Memo(cache_size)
        # Where a suffix marks the last token of each pre-token, words can be encoded many at a time and told apart after.
        vocabulary = self.model.get_vocab()
        self.last = np.zeros(self.size, bool)
        self.last[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.marked = bool(self.last.any())

    def fresh(self, chunks: pa.Array) -> pa.Array:
        """The ids of each chunk, encoded now, as bytes."""
        bare = pc.utf8_trim(chunks, characters=C.BLANKS)
        plain = pc.match_substring_regex(bare, _PLAIN).to_numpy(zero_copy_only=False) if self.marked else np.zeros(len(bare), bool)
        own, alone = np.flatnonzero(plain), [np.flatnonzero(~plain)]
        places, sizes, ids = [], [], []
        words = bare.take(pa.array(own)).to_pylist()
        for at in range(0, len(words), 16384):
            groups = range(at, min(at + 16384, len(words)), 256)
            for a, e in zip(groups, self.model.encode_batch_fast([" ".join(words[a : a + 256]) for a in groups], add_special_tokens=False), strict=True):
                group, found = own[a : a + 256], np.array(e.ids, self.kind)
                ends = np.flatnonzero(self.last[found]) + 1
                if len(ends) != len(group):
                    alone.append(group)
                    continue
                places.append(group)
                sizes.append(np.diff(ends, prepend=0))
                ids.append(found)
        left = np.concatenate(alone)
        for at in range(0, len(left), 8192):
            some = left[at : at + 8192]
            each = [x.ids for x in self.model.encode_batch_fast(bare.take(pa.array(some)).to_pylist(), add_special_tokens=False)]
            places.append(some)
            sizes.append(np.array([len(x) for x in each], np.int64))
            ids.append(np.fromiter((i for x in each for i in x), self.kind))
        if not places:
            return pa.array([], pa.large_binary())
        place, data = np.concatenate(places), np.concatenate(ids)
        offsets = np.concatenate(([0], np.cumsum(np.concatenate(sizes)))) * data.itemsize
        blobs = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(place), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)])
        return blobs.take(pa.array(np.argsort(place)))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and the n + 1 offsets."""
        pieces, off = C.chunked(texts)
        index, distinct = C.coded(pieces)
        if not len(index):
            return np.zeros(0, self.kind), np.zeros(len(texts) + 1, np.int64)
        ids = self.memo.values(distinct, lambda new: [self.fresh(new)])[0]
        _, offsets, data = ids.take(pa.array(index)).buffers()
        where = np.frombuffer(offsets, np.int64)[: len(index) + 1][off] // self.kind().itemsize
        return np.frombuffer(data, self.kind)[: where[-1]] if data is not None else np.zeros(0, self.kind), where


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def distinct_ids(ids: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The ids of all documents, each once for each document that has it."""
    wide = np.uint32 if len(off) <= 1 << 16 and ids.dtype == np.uint16 else np.uint64
    bits = wide(16 if wide is np.uint32 else 32)
    both = np.sort(np.repeat(np.arange(len(off) - 1, dtype=wide), np.diff(off)) << bits | ids.astype(wide))
    new = np.ones(len(both), bool)
    new[1:] = both[1:] != both[:-1]
    return (both[new] & (wide(1) << bits) - wide(1)).astype(np.int64)


def likeness(size: int) -> np.ndarray:
    """A rank of each id: small for few, and sooner for later ids of the vocabulary. Equal in all tasks."""
    u = (mixed(np.arange(size, dtype=np.uint64) + np.uint64(1)) >> np.uint64(11)).astype(float) / 2.0**53
    rank = np.empty(size, np.int32)
    rank[np.argsort(-np.log1p(-u) / (np.arange(size) + 1.0), kind="stable")] = np.arange(size)
    return rank


def places(ids: np.ndarray, off: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Where documents stand in the order by likeness: the two least ranks of its ids, then its least trigram."""
    n = len(off) - 1
    out = np.full(n, np.iinfo(np.int64).max, np.int64)
    some = np.flatnonzero(np.diff(off) > 0)
    if not len(some):
        return out
    r = rank[ids]
    first = np.minimum.reduceat(r, off[some])
    row = np.repeat(np.arange(len(some)), np.diff(off)[some])
    second = np.minimum.reduceat(np.where(r == first[row], np.int32(len(rank)), r), off[some])
    t = ids.astype(np.uint64)
    g = np.full(len(ids), np.iinfo(np.uint64).max, np.uint64)
    if len(ids) > 2:
        g[:-2] = np.where(row[2:] == row[:-2], mixed(t[:-2] << np.uint64(32) | t[1:-1] << np.uint64(16) ^ t[2:]), g[:-2])
    grams = (np.minimum.reduceat(g, off[some]) >> np.uint64(36)).astype(np.int64)
    bits = int(len(rank)).bit_length()
    first, second = first.astype(np.int64), second.astype(np.int64)
    out[some] = (first << bits | second) << 62 - 2 * bits | grams & (1 << 62 - 2 * bits) - 1
    return out


class Bm25:
    """Inverted index over the token ids of some documents; ``df``, ``count`` and ``mean`` are those of all documents, else of these."""

    def __init__(self, ids: np.ndarray, off: np.ndarray, df: np.ndarray | None = None, count: int = 0, mean: float = 0.0, k1: float = 1.2, b: float = 0.75) -> None:
        n = len(off) - 1
        length = np.diff(off)
        pair, tf = np.unique(np.repeat(np.arange(n, dtype=np.int64), length) << 32 | ids.astype(np.int64), return_counts=True)
        doc, term = pair >> 32, pair & 0xFFFFFFFF
        self.n = n
        names, term = np.unique(term, return_inverse=True)
        here = np.bincount(term, minlength=len(names))
        every, count, mean = (here, n, length.mean()) if df is None else (df[names], count, mean)
        idf = np.log1p((count - every + 0.5) / (every + 0.5))
        weight = idf[term] * tf * (k1 + 1) / (tf + k1 * (1 - b + b * length[doc] / max(1.0, mean)))
        self.first = np.searchsorted(doc, np.arange(n + 1))
        self.term, self.weight = term, np.where(here[term] > 1, weight, 0.0)
        order = np.argsort(term, kind="stable")
        self.docs, self.weights = doc[order], weight[order]
        self.lists = np.concatenate(([0], np.cumsum(here)))

    def neighbours(self, seed: int, used: np.ndarray, terms: int | None = None, most: int = 64) -> tuple[list[int], bool]:
        """At most ``most`` unused documents with a common term, best first, and whether there are more. The query is the seed's ``terms`` heaviest terms, else all, that others have."""
        a, b = self.first[seed], self.first[seed + 1]
        heavy = np.argsort(-self.weight[a:b], kind="stable")[:terms]
        heavy = self.term[a:b][heavy[self.weight[a:b][heavy] > 0]]
        if not len(heavy):
            return [], False
        lists = [slice(self.lists[t], self.lists[t + 1]) for t in heavy.tolist()]
        score = np.bincount(np.concatenate([self.docs[s] for s in lists]), np.concatenate([self.weights[s] for s in lists]), self.n)
        score[used] = 0
        found = np.flatnonzero(score)
        more = len(found) > most
        if more:
            least = np.partition(score[found], len(found) - most)[len(found) - most]
            found = found[score[found] >= least]
        return found[np.lexsort((found, -score[found]))][:most].tolist(), more


def fill(lengths: list[int], index: Bm25, window: int, terms: int = 12) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, window number, offset) of all pieces."""
    out: list[tuple[int, int, int, int, int]] = []
    used = np.zeros(len(lengths), bool)
    at, number, ahead, waiting = 0, 0, 0, []
    seed, asked = None, 2  # 0: by the heaviest terms, 1: by all, 2: no more to ask
    while True:
        doc = None
        while doc is None:
            while waiting and doc is None:
                d = waiting.pop()
                doc = None if used[d] else d
            if doc is not None or asked == 2:
                break
            found, more = index.neighbours(seed, used, None if asked else terms)
            waiting, asked = found[::-1], asked + (not more)
        fresh = doc is None
        if fresh:
            while ahead < len(lengths) and used[ahead]:
                ahead += 1
            if ahead == len(lengths):
                return out
            doc = ahead
        used[doc] = True
        start, cut = 0, False
        while start < lengths[doc]:
            n = min(lengths[doc] - start, window - at)
            out.append((doc, start, n, number, at))
            start, at = start + n, at + n
            if at == window:
                number, at, cut = number + 1, 0, start < lengths[doc]
                if not cut:
                    waiting, asked = [], 2  # a new window begins with a new seed
        if (fresh or cut) and at:
            seed, waiting, asked = doc, [], 0


def pack(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", window: int = 2048, end_id: int = 1, shard_ids: int = 1 << 20, part_bytes: int = 16 << 20) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Null and empty texts are documents of the end id alone. Repeated rows and null keys are documents of their own;
    other columns are not read, whatever their names; an empty table gives no rows. Texts of any length are packed
    whole: each id lies in exactly one piece.
    """
    spark = docs.sparkSession

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        rank, df = likeness(own.size), np.zeros(own.size, np.int64)
        done = np.uint64(TaskContext.get().partitionId() << 40)
        for batch in batches:
            for rows, texts in C.slices(batch, "text"):
                ids, off = own.encode(texts)
                df += np.bincount(distinct_ids(ids, off), minlength=own.size)
                # Equal documents are told apart by their place in the input, so that the order has no ties.
                salt = (mixed(done + np.arange(len(texts), dtype=np.uint64)) >> np.uint64(1)).astype(np.int64)
                done += np.uint64(len(texts))
                blobs = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(off * ids.itemsize), pa.py_buffer(np.ascontiguousarray(ids))]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(places(ids, off, rank)), pa.array(salt), rows.column("key"), blobs, pa.nulls(len(texts), pa.int64())], ["place", "salt", "key", "ids", "df"])
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.nulls(len(some), pa.int64()), pa.nulls(len(some), docs_kind), pa.nulls(len(some), pa.binary()), pa.array(df[some])], ["place", "salt", "key", "ids", "df"])

    kind = docs.schema[key].dataType.simpleString()
    rows = numbered(docs, text).select(F.col(key).alias("key"), "text")
    docs_kind = rows.select("key").limit(0).toArrow().schema.field("key").type
    tokens = stored(rows.mapInArrow(tokenise, f"place long, salt long, key {kind}, ids binary, df long"), "tokens")
    # The frequencies are as many as the vocabulary has entries.
    seen = tokens.where("df IS NOT NULL").groupBy("place").agg(F.sum("df").alias("df")).toArrow()
    tokens = tokens.where("ids IS NOT NULL").select("place", "salt", "key", "ids")
    count, size = tokens.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("ids")), F.lit(0))).first()
    shipped = spark.sparkContext.broadcast((seen.column("place").to_numpy(), seen.column("df").to_numpy(), count))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, kind = encoder(path).size, encoder(path).kind
        df = np.zeros(max(size, end_id + 1), np.int64)
        df[shipped.value[0]] = shipped.value[1]
        df[end_id] = shipped.value[2]
        mean = 1 + total / max(1, shipped.value[2])
        next_number = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []
        n = 0

        def out() -> pa.RecordBatch:
            nonlocal next_number
            keys = pa.concat_arrays([b.column("key") for b in held])
            own = [np.append(np.frombuffer(x, kind), kind(end_id)) for b in held for x in b.column("ids").to_pylist()]
            off = np.concatenate(([0], np.cumsum([len(x) for x in own])))
            pieces = fill(np.diff(off).tolist(), Bm25(np.concatenate(own), off, df, shipped.value[2], mean), window)
            crc = [zlib.crc32(own[d][s : s + m].astype("<u4").tobytes()) for d, s, m, _, _ in pieces]
            doc, start, length, number, offset = (np.array(x, np.int64) for x in zip(*pieces, strict=True))
            columns = [keys.take(pa.array(doc)), pa.array(start), pa.array(length), pa.array(crc, pa.int64()), pa.array(np.diff(off)[doc]), pa.array(number + next_number), pa.array(offset)]
            next_number += int(number[-1]) + 1
            return pa.RecordBatch.from_arrays(columns, [key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

        for batch in batches:
            ends = np.cumsum(pc.binary_length(batch.column("ids")).to_numpy()) // kind().itemsize + np.arange(1, batch.num_rows + 1)
            a = 0
            while a < batch.num_rows:
                before = ends[a - 1] if a else 0
                b = max(a + 1, int(np.searchsorted(ends, before + shard_ids - n, "right")))
                held.append(batch.slice(a, b - a))
                n += int(ends[b - 1] - before)
                a = b
                if n >= shard_ids or a < batch.num_rows:
                    yield out()
                    held, n = [], 0
        if held:
            yield out()

    total = size // (2 if encoder(path).kind is np.uint16 else 4)
    parts = max(1, -(-size // part_bytes))
    laid = tokens.repartitionByRange(parts, "place", "salt").sortWithinPartitions("place", "salt").select("key", "ids")
    return laid.mapInArrow(packed, f"`{key}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
