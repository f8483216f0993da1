"""Exact Jaccard join of word 5-gram sets with token-combination prefixes.

The tokens of a set are its shingles, in an order that all tasks agree on: rare ones first, then frequent ones, each by
hash. A shingle is rare for sure if it holds a word that occurs at most ``frequent`` times in all documents; a broadcast
bitmap of word classes tells. So a key made of one rare shingle never has more than ``frequent`` sets.

1. Sets of sizes n that link lack at most n - ceil(t n) = m of each other's shingles. The first shared shingle is among
   the first m + 1 of both. If it is rare, they meet in it: rare shingles of the prefix are keys alone.
2. If it is frequent, all that they share is frequent. They share at least three times as many shingles (t = 0.75) as
   lie in only one of them, so that, among the first 3 (1 - t) n + 3 of either, three shared ones stand side by side
   with no other frequent shingle of either set between: each such triple of the extended prefix is a key. A triple
   comes from a text that is mostly shared; one common passage makes hardly any. Sets with more than m rare shingles
   need no triples. Small sets (under 12 shingles, for which the count does not hold) use single keys of both classes;
   those up to 12 / t use all keys, so that sets on either side of the border meet.
3. A packed exchange by key finds the sets that share one. Star-shaped edges about the first set of each key make
   candidate families, so that a key with m sets costs m rows. A map task makes the stars of its own batches itself and
   sends one set for each key: a key that a third of all sets share arrives once a batch. Only now the full sets of
   those in a family are read.
4. Each set is verified against its family's first set. Those that link to it are connected
   already, so that only pairs with one of the others are left: families are cut into blocks, and each pair of blocks
   with such sets is verified exactly in one task, from an inverted index over its shingles. A task returns only a
   spanning forest of its links: the links' components are whole, but no group is expanded to all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import chunks as C
from .components import components, joined
from .exchange import bitmap, bounds, in_bitmap, mixed, parts_for
from .shared import numbered, release, stored

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANKS = bytes([9, 10, 11, 12, 13, 32])


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word, A-Z lower-cased, of all texts of ``plain()``, and the texts' offsets among the words."""
    data, off = C.raw(texts)
    lo, hi = int(off[0]), int(off[-1])
    data, off = _LOWER[data[lo:hi]], off - lo
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(off), np.int64)
    word = ~_SPACE[data]
    starts = word.copy()
    starts[1:] &= ~word[:-1]
    cut = off[:-1][off[:-1] < off[1:]]
    starts[cut] = word[cut]
    begin = np.flatnonzero(starts)
    if not len(begin):
        return np.zeros(0, np.uint64), np.zeros(len(off), np.int64)
    # Each slice is a word and the white space up to the next one, which the hash leaves out.
    pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(np.append(begin, len(data)).astype(np.int64)), pa.py_buffer(data)])
    index, distinct = C.coded(pieces)
    h = np.array([xxhash.xxh64_intdigest(x.rstrip(_BLANKS)) for x in distinct.to_pylist()], np.uint64)
    return h[index], np.searchsorted(begin, off)


#: Word classes whose counts are taken: their table, and the bitmap of rare ones, have this size at any scale.
WORD_CLASSES = 22


def classes(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(64 - WORD_CLASSES)).astype(np.int64)


def shingle_sets(texts: pa.Array, words: int = 5, rare: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text, one text after the other, the n + 1 offsets, and which shingles are frequent.

    The shingles of a text that hold a word of a class in ``rare`` come first, then the others, each sorted.
    """
    h, off = word_hashes(texts)
    n = np.diff(off)
    doc = np.repeat(np.arange(len(n)), n)
    often = np.ones(len(h), bool) if rare is None else ~rare[classes(h)]
    full = len(h) - words + 1
    out_d, out_s, out_o = [], [], []
    if full > 0:
        s, o = np.zeros(full, np.uint64), np.ones(full, bool)
        for k in range(words):
            s = mixed(s * np.uint64(3) + h[k : k + full])
            o &= often[k : k + full]
        inside = doc[:full] == doc[words - 1 :]
        out_d.append(doc[:full][inside])
        out_s.append(s[inside])
        out_o.append(o[inside])
    few = np.flatnonzero((n > 0) & (n < words))
    if len(few):
        s = np.zeros(len(few), np.uint64)
        for k in range(words - 1):
            has = n[few] > k
            s[has] = mixed(s[has] * np.uint64(5) + h[off[few[has]] + k])
        out_d.append(few)
        out_s.append(mixed(s + np.uint64(1)))
        out_o.append(np.ones(len(few), bool))
    if not out_d:
        return np.zeros(0, np.uint64), np.zeros(len(n) + 1, np.int64), np.zeros(0, bool)
    d, s, o = (np.concatenate(x) for x in (out_d, out_s, out_o))
    order = np.argsort(s)
    place = d[order] << 1 | o[order]
    order = order[np.argsort(place.astype(np.uint16) if len(n) < 1 << 15 else place, kind="stable")]  # short keys are sorted in linear time
    d, s, o = d[order], s[order], o[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (s[1:] != s[:-1])
    d, s, o = d[new], s[new], o[new]
    return s, np.searchsorted(d, np.arange(len(n) + 1)), o


def set_ids(s: np.ndarray, off: np.ndarray) -> np.ndarray:
    """A digest of each set, an int64; 0 for empty sets."""
    sums = np.concatenate(([np.uint64(0)], np.cumsum(mixed(s ^ np.uint64(0x5851F42D4C957F2D)))))[off]
    return (mixed(np.diff(sums) + np.diff(off).astype(np.uint64)) >> np.uint64(1)).astype(np.int64) * (np.diff(off) > 0)


def _needed(n: np.ndarray, percent: int) -> np.ndarray:
    """The least intersection with a set that links to one of n elements."""
    return -(-percent * n // 100)


def prefix_keys(s: np.ndarray, off: np.ndarray, often: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The index keys of sets in the order of ``shingle_sets``, and the set of each."""
    n = np.diff(off)
    row = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(s)) - off[row]
    lacks = n - _needed(n, percent)
    least = -(-300 // (3 * percent - 200)) if percent > 66 else np.iinfo(np.int64).max  # from here on triples are sure
    border = n * percent < least * 100
    single = (at <= lacks[row]) & (~often | border[row])
    keys, of = [mixed(s[single])], [row[single]]
    rare = np.bincount(row[~often], minlength=len(n))
    reach = np.where((n >= least) & (rare <= lacks), np.minimum(n, 3 * n * (100 - percent) // 100 + 3), 0)
    i = np.flatnonzero(often & (at + 2 < reach[row]))
    if len(i):
        keys.append(mixed(mixed(mixed(s[i] * np.uint64(3) + s[i + 1]) * np.uint64(5) + s[i + 2]) ^ np.uint64(0x2545F4914F6CDD1D)))
        of.append(row[i])
    return np.concatenate(keys), np.concatenate(of)


def stars(k: np.ndarray, sid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from the sets of each key to the first of them, and which entries stand for their key."""
    order = np.argsort(k)
    twin = np.zeros(len(k), bool)
    twin[1:] = k[order[1:]] == k[order[:-1]]
    twin[:-1] |= twin[1:]
    alone, order = order[~twin], order[twin]  # few keys have more than one set
    order = order[np.lexsort((sid[order], k[order]))]
    new = np.ones(len(order), bool)
    new[1:] = k[order[1:]] != k[order[:-1]]
    first = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    own, head = sid[order], sid[order[first]]
    apart = own != head
    return np.unique(np.stack([own[apart], head[apart]], axis=1), axis=0), np.concatenate([alone, order[new]])


def rare_classes(docs: DataFrame, frequent: int) -> np.ndarray:
    """Which word classes occur at most ``frequent`` times, counted over all words of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << WORD_CLASSES, np.int64)
        for batch in batches:
            for _, texts in C.slices(batch, "text"):
                total += np.bincount(classes(word_hashes(texts)[0]), minlength=1 << WORD_CLASSES)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["class", "n"])

    got = docs.select("text").mapInArrow(run, "class int, n long").groupBy("class").agg(F.sum("n").alias("n")).where(F.col("n") > frequent).select("class").toArrow()
    out = np.ones(1 << WORD_CLASSES, bool)
    out[got.column("class").to_numpy()] = False
    return out


_ROW = ["part", "key", "n", "sid", "text_id", "keys", "sids", "counts"]


def _entries(docs: DataFrame, words: int, percent: int, parts: int, rare) -> DataFrame:
    """A row for each document (key, n, sid, text_id), rows of packed keys of the distinct sets of each batch (keys, sids, counts), and rows of edges within a batch (n = -1, sids); all dealt by part."""
    kind = docs.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in C.slices(batch, "text"):
                s, off, often = shingle_sets(texts, words, rare.value)
                sid, n = set_ids(s, off), np.diff(off)
                m = len(n)
                nulls = lambda m, *t: [pa.nulls(m, x) for x in t]
                # The rows of documents are dealt by place, not by set, of which one may be very common.
                yield pa.RecordBatch.from_arrays([pa.array((np.arange(m) * 7919 % parts).astype(np.int32)), rows.column("key"), pa.array(n), pa.array(sid), rows.column("text_id"), *nulls(m, *[pa.binary()] * 3)], _ROW)
                _, first = np.unique(sid, return_index=True)  # copies within the batch count once
                keep = np.zeros(m, bool)
                keep[first[n[first] > 0]] = True
                k, row = prefix_keys(s, off, often, percent)
                k, row = k[keep[row]], row[keep[row]]
                if not len(k):
                    continue
                edges, own = stars(k, sid[row])
                k, row = k[own], row[own]
                if len(edges):
                    yield pa.RecordBatch.from_arrays([pa.array([len(k) % parts], pa.int32()), *nulls(1, rows.column("key").type), pa.array([-1], pa.int64()), *nulls(1, *[pa.int64()] * 2, pa.binary()), pa.array([edges.tobytes()], pa.binary()), *nulls(1, pa.binary())], _ROW)
                part = (k % np.uint64(parts)).astype(np.int64)
                order = np.argsort(row, kind="stable")
                order = order[np.argsort(part[order].astype(np.uint16) if parts < 1 << 16 else part[order], kind="stable")]
                part, row, k = part[order], row[order], k[order] // np.uint64(parts)
                # Six bytes of each key beyond its part: a chance collision makes one candidate more, which verifying drops.
                six = np.ascontiguousarray(k.view(np.uint8).reshape(-1, 8)[:, :6])
                out = []
                for p, a, b in zip(*bounds(part), strict=True):
                    r, i, j = bounds(row[a:b])
                    out.append((int(p), six[a:b].tobytes(), sid[r].tobytes(), (j - i).astype(np.int32).tobytes()))
                p, *packed = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int32(), *[pa.binary()] * 3), strict=True)]
                yield pa.RecordBatch.from_arrays([p, *nulls(len(out), rows.column("key").type, *[pa.int64()] * 3), *packed], _ROW)

    return docs.mapInArrow(run, f"part int, key {kind}, n long, sid long, text_id long, keys binary, sids binary, counts binary")


def _met(entries: DataFrame) -> DataFrame:
    """The rows of documents (key, n, sid, text_id), and a, b: each set that shares a key with others, and the first of them."""
    kind = entries.schema["key"].dataType.simpleString()

    def find(table: pa.Table) -> pa.Table:
        packed = table.filter(pc.is_valid(table.column("keys")))
        own = table.filter(pc.is_null(table.column("sids"))).select(_ROW[1:5])
        read = lambda t, c, kind: np.concatenate([np.zeros(0, kind), *(np.frombuffer(x, kind) for x in t.column(c).to_pylist())])
        six = read(packed, "keys", np.uint8).reshape(-1, 6)
        k = np.zeros((len(six), 8), np.uint8)
        k[:, :6] = six
        k = k.view(np.uint64).ravel()
        sid = np.repeat(read(packed, "sids", np.int64), read(packed, "counts", np.int32))
        known = read(table.filter(pc.equal(table.column("n"), -1)), "sids", np.int64).reshape(-1, 2)
        edges = np.unique(np.concatenate([stars(k, sid)[0], known]), axis=0)
        m, e = len(own), len(edges)
        columns = [pa.concat_arrays([own.column(c).combine_chunks(), pa.nulls(e, own.schema.field(c).type)]) for c in _ROW[1:5]]
        columns += [pa.concat_arrays([pa.nulls(m, pa.int64()), pa.array(edges[:, x], pa.int64())]) for x in (0, 1)]
        return pa.table(dict(zip([*_ROW[1:5], "a", "b"], columns, strict=True)))

    return entries.groupBy("part").applyInArrow(find, f"key {kind}, n long, sid long, text_id long, a long, b long")


def _members(docs: DataFrame, own: DataFrame, families: DataFrame, words: int, bits: int) -> DataFrame:
    """sid, component, n, shingles of the sets in families. Only texts whose hash is that of such a set's text are cut again."""
    wanted = own.join(families.select(F.col("node").alias("sid")), "sid", "left_semi").groupBy("sid").agg(F.min("text_id").alias("text_id"))
    marks = docs.sparkSession.sparkContext.broadcast(bitmap(wanted, "text_id", bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = in_bitmap(batch.column("text_id").to_numpy(), marks.value, bits)
            if not hit.any():
                continue
            for _, texts in C.slices(batch.filter(pa.array(hit)), "text"):
                s, off, _ = shingle_sets(texts, words)
                sid = set_ids(s, off)
                _, first = np.unique(sid, return_index=True)
                lists = pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(s.view(np.int64))).take(pa.array(first))
                yield pa.RecordBatch.from_arrays([pa.array(sid[first]), pa.array(np.diff(off)[first]), lists], ["sid", "n", "shingles"])

    found = docs.select("text", "text_id").mapInArrow(run, "sid long, n long, shingles array<long>")
    found = found.join(families.withColumnRenamed("node", "sid"), "sid")
    return stored(found.groupBy("sid", "component").agg(F.first("n").alias("n"), F.first("shingles").alias("shingles")), "members")


def forest(ids: np.ndarray, n: np.ndarray, s: np.ndarray, off: np.ndarray, percent: int, left: np.ndarray | None = None) -> list[tuple[int, int]]:
    """A spanning forest of all links among the given sets; with ``left``, of the links between left and other sets.

    Each set's intersections with all earlier ones are counted at once from an inverted index.
    """
    m = len(ids)
    order = np.argsort(s, kind="stable")
    owner = np.repeat(np.arange(m), np.diff(off))[order]
    _, a, b = bounds(s[order])
    place = np.empty(len(s), np.int64)
    place[order] = np.repeat(np.arange(len(a)), b - a)
    parent = list(range(m))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    edges = []
    for x in range(m):
        lists = place[off[x] : off[x + 1]]
        length = b[lists] - a[lists]
        if not length.sum():
            continue
        at = np.repeat(a[lists] - np.concatenate(([0], np.cumsum(length)[:-1])), length) + np.arange(length.sum())
        y = owner[at]
        y = y[y < x]
        if left is not None:
            y = y[left[y] != left[x]]
        if not len(y):
            continue
        common = np.bincount(y, minlength=x)
        z = np.flatnonzero(common)
        z = z[100 * common[z] >= percent * (n[z] + n[x] - common[z])]
        for t in z.tolist():
            p, q = root(x), root(t)
            if p != q:
                parent[p] = q
                edges.append((int(ids[x]), int(ids[t])))
    return edges


def _links(placed: DataFrame, percent: int, block: int) -> DataFrame:
    """a, b: links whose components are those of all links among the sets of each family.

    Sets that link to their family's first set need no verifying among themselves; the others are verified against
    all of the family, by pairs of blocks of about ``block`` sets.
    """
    sets = placed.select("sid", "n", "shingles")
    heads = placed.where("sid = component").select("component", F.col("n").alias("head_n"), F.col("shingles").alias("head"))
    common = F.size(F.array_intersect("shingles", "head"))
    near = (F.col("sid") == F.col("component")) | (100 * common >= percent * (F.col("n") + F.col("head_n") - common))
    judged = stored(joined(placed, heads, "component").select("sid", "component", near.alias("near")), "judged")
    direct = judged.where("near AND sid <> component").select(F.col("sid").alias("a"), F.col("component").alias("b"))

    blocks = lambda c: F.ceil(F.count_if(c) / block).cast("int")
    sized = judged.groupBy("component").agg(blocks(F.col("near")).alias("near_blocks"), blocks(~F.col("near")).alias("other_blocks")).where("other_blocks > 0")
    left = sets.join(joined(judged, sized, "component"), "sid")
    h = F.xxhash64("sid")
    left = left.withColumn("own", F.when(F.col("near"), F.pmod(h, "near_blocks")).otherwise(F.col("near_blocks") + F.pmod(h, "other_blocks")).cast("int"))
    partners = F.sequence(F.when(F.col("near"), F.col("near_blocks")).otherwise(0), F.col("near_blocks") + F.col("other_blocks") - 1)
    at = F.transform(partners, lambda o: F.struct(F.least(F.col("own"), o).alias("i"), F.greatest(F.col("own"), o).alias("j")))
    sent = left.withColumn("at", F.explode(at)).select("component", "sid", "n", "shingles", "own", F.col("at.i").alias("i"), F.col("at.j").alias("j"))

    def verify(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("sid")
        ids, n, own, i, j = (table.column(c).to_numpy() for c in ("sid", "n", "own", "i", "j"))
        lists = table.column("shingles").combine_chunks()
        s, off = lists.flatten().to_numpy(), np.concatenate(([0], np.cumsum(np.array([len(x) for x in lists], np.int64))))
        e = forest(ids, n, s, off, percent, None if i[0] == j[0] else own == i[0])
        return pa.table({"a": pa.array([x for x, _ in e], pa.int64()), "b": pa.array([x for _, x in e], pa.int64())})

    links = stored(direct.unionByName(sent.groupBy("component", "i", "j").applyInArrow(verify, "a long, b long")), "links")
    release(judged)
    return links


def join_components(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, percent: int = 75, frequent: int = 2, block: int = 512, bits: int = 26) -> DataFrame:
    """One row per row of ``docs``: key, n_shingles, component_id (the smallest key reachable by links).

    Two texts link if 100 * |intersection| >= ``percent`` * |union| of their shingle sets. Null and empty texts, and
    texts of white space, have no shingles and no links: their component is their own key. Repeated rows stay and link
    to each other; keys may have any type that can be ordered; a null key gives a null component unless other keys share
    its set; extra columns are not read; an empty table gives no rows.
    """
    rows = numbered(docs, text).select(F.col(key).alias("key"), "text").withColumn("text_id", F.xxhash64("text"))
    rare = docs.sparkSession.sparkContext.broadcast(rare_classes(rows, frequent))
    met = stored(_met(_entries(rows, words, percent, parts_for(docs, 4), rare)), "met")
    own = met.where("a IS NULL").select("key", "n", "sid", "text_id")
    families = stored(components(met.where("a IS NOT NULL").select("a", "b")), "families")
    members = _members(rows, own.where("n > 0"), families, words, bits)
    found = _links(members, percent, block)
    release(members, families)
    links = stored(components(found), "components")
    release(found)
    # Each set's component, then the smallest key of all rows whose sets lie in it. The size tells sets apart whose ids collide.
    by_set = own.where("n > 0").groupBy("sid", "n").agg(F.min("key").alias("least"))
    of_set = by_set.join(links.select(F.col("node").alias("sid"), "component"), "sid", "left")
    of_set = of_set.select("sid", "n", "least", F.coalesce("component", "sid").alias("c"), F.when(F.col("component").isNull(), F.col("n")).alias("m"))
    least = of_set.groupBy("c", "m").agg(F.min("least").alias("component_id"))
    of_set = joined(of_set, least.withColumnRenamed("m", "__m"), "c").where(F.col("m").eqNullSafe(F.col("__m")))
    of_set = stored(of_set.select("sid", "n", "component_id"), "least")
    release(links)
    out = own.join(of_set.withColumn("__sid", F.bitwise_not("sid")).select("__sid", F.col("n").alias("__n"), "component_id"), (F.bitwise_not("sid") == F.col("__sid")) & (F.col("n") == F.col("__n")), "left")
    return out.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.coalesce("component_id", "key")).otherwise(F.col("key")).alias("component_id"))
