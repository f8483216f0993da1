"""Line de-duplication across all documents by a segment-partition edit join.

A line of ``min_bytes`` bytes or more is dropped where an earlier line (by key, then line number) is equal to it or
within ``max_edits`` edits of it, counted on UTF-8 bytes; the earlier line may itself have been dropped. Lines are cut
into max_edits + 1 segments. If two lines are within max_edits edits, one segment of the shorter line stands unchanged
in the longer one, shifted by a few bytes at most. So each line is indexed under (its length, segment number, segment),
and probes the index, for its own length and those up to max_edits below, with the substrings that the multi-match
rule leaves: for segment i, starts from both ends agree. Candidates whose byte counts alone need more edits go at once; the others
are verified by banded bit-parallel edit distance.

The entries of a key are sorted by the lines' first places, so that a line asks earlier ones only, and in rounds: a line
looks at the first few lines of each of its keys, and asks those whose byte counts agree. A line that has an early near
copy is settled, so m lines that are near each other cost m rows, not m * m. A line that a key had more for goes to the
next round, in which crowded keys are refined: two near lines that share a segment have their other edits in what is left
and right of it, so the longer of these gaps is cut into segments in turn, of which one more must stand unchanged. So
lines with a common head or frame part as soon as a segment outside of it is theirs. How many lines of a key are looked
at grows fourfold a round, so that keys whose gaps are too short to be cut end by giving all that they have, to lines
that are still unsettled.

Index and probe entries travel as packed blobs. Texts are shuffled only for lines with candidates, and once at the end
to apply the decisions. Candidates are known by 64 bits of a hash, which verifying by bytes makes good; what is dropped
is known by all its 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import chunks as C
from .components import joined
from .exchange import bitmap, bounds, in_bitmap, mixed, parts_for
from .shared import numbered, release, stored

_BASE = 0x9E3779B97F4A7C15
_UP, _DOWN = np.uint64(_BASE), np.uint64(pow(_BASE, -1, 1 << 64))


def within(a: bytes, b: bytes, k: int) -> bool:
    """Whether the edit distance is at most ``k``: a band of 2k + 1 diagonals, one bit each, in a column-wise scan.

    ``down`` and ``up`` mark where the distance grows or falls by one from a row of the band to the next.
    """
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > k:
        return False
    i, n = 0, len(a)
    while i < n and a[i] == b[i]:
        i += 1
    j = 0
    while j < n - i and a[len(a) - 1 - j] == b[len(b) - 1 - j]:
        j += 1
    a, b = a[i : len(a) - j], b[i : len(b) - j]
    m, n = len(a), len(b)
    if m == 0:
        return n <= k
    mask, top = (1 << 2 * k + 1) - 1, 1 << 2 * k
    down, up, distance, worst = mask ^ ((1 << k) - 1), 0, min(k, m), 2 * k + n - m
    where: dict[int, int] = {}
    for row in range(min(m, k)):
        where[a[row]] = where.get(a[row], 0) | 1 << row
    side = top >> max(0, k - m)
    for column in range(1, n + 1):
        row = column + k - 1
        if row < m:
            where[a[row]] = where.get(a[row], 0) | 1 << row
        match = where.get(b[column - 1], 0)
        shift = column - k - 1
        match = (match >> shift if shift >= 0 else match << -shift) & mask
        same = ((((match & down) + down) ^ down) | match | up) & mask
        right = (up | ~(same | down)) & mask
        left = same & down
        if row < m:
            distance += not same & top
            if distance > worst:
                return False
        else:
            side >>= 1
            distance += bool(right & side) - bool(left & side)
        down = (left | ~(same >> 1 | right)) & mask
        up = same >> 1 & right
    return distance <= k


def segments(n: int, k: int) -> list[tuple[int, int]]:
    """Start and length of the k + 1 even segments of a line of n bytes; the last ones are longer by one."""
    short, longer = divmod(n, k + 1)
    out, at = [], 0
    for i in range(k + 1):
        size = short + (i >= k + 1 - longer)
        out.append((at, size))
        at += size
    return out


def probes(n: int, k: int) -> list[tuple[int, int, int, int]]:
    """(length of the indexed line, segment, start, size) of the substrings with which a line of n bytes probes."""
    out = []
    for shorter in range(max(1, n - k), n + 1):
        gap = n - shorter
        for i, (at, size) in enumerate(segments(shorter, k)):
            lo = max(0, at - i, at + gap - (k - i))
            hi = min(n - size, at + i, at + gap + (k - i))
            out += [(shorter, i, s, size) for s in range(lo, hi + 1)]
    return out


def _split(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """All lines of all texts, the row and the number of each."""
    lists = pc.split_pattern(texts, "\n")
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(texts)), counts)
    return lists.flatten(), row, np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)


def digests(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Two halves of a 128-bit hash of each line."""
    both = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, lines.cast(pa.large_binary()).to_pylist())), ">i8").astype(np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def _identified(texts: pa.Array, least: int, short: bool = False) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct long lines (``short``: and shorter ones that aren't blank), their ids and checks, and for each occurrence of one its place in these, its row and number."""
    lines, row, number = _split(texts)
    long = pc.binary_length(lines).to_numpy(zero_copy_only=False) >= least
    if short:
        long |= pc.match_substring_regex(lines, r"[^\x20\x09-\x0D]").to_numpy(zero_copy_only=False)
    lines, row, number = lines.filter(pa.array(long)), row[long], number[long]
    index, distinct = C.coded(lines)
    ids, checks = digests(distinct)
    return distinct, ids, checks, index, np.stack([row, number], 1) if len(row) else np.zeros((0, 2), np.int64)


def _places(least: int, short: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in C.slices(batch, "text"):
                _, ids, checks, index, at = _identified(texts, least, short)
                own = rows.select(["key", "row"]).take(pa.array(at[:, 0]))
                yield pa.RecordBatch.from_arrays([pa.array(ids[index], pa.int64()), pa.array(checks[index], pa.int64()), *own.columns, pa.array(at[:, 1].astype(np.int32))], ["line", "check", "key", "row", "number"])

    return run


#: What is left of two lines when equal segments are taken out: start and end in the indexed line, start and end in the other, edits that it may hold.
Gaps = tuple[tuple[int, int, int, int, int], ...]


def _cut(gaps: Gaps, which: int, segment: int, at: int, start: int, size: int) -> Gaps:
    """``gaps`` with one of them parted by a segment at ``at`` in the indexed line and ``start`` in the other.

    Of the segments that stand unchanged, the first before which there are no more edits than segments bounds both sides.
    """
    a, b, c, d, e = gaps[which]
    return (*gaps[:which], (a, at, c, start, segment), (at + size, b, start + size, d, e - segment), *gaps[which + 1 :])


def _longest(gaps: Gaps) -> int | None:
    """The gap to be cut next, by the indexed line alone: the longest with a byte for each segment."""
    some = [i for i, g in enumerate(gaps) if g[1] - g[0] > g[4]]
    return max(some, key=lambda i: gaps[i][1] - gaps[i][0]) if some else None


@lru_cache(maxsize=1 << 14)
def entries(n: int, k: int) -> list[tuple[int, int, int, int, Gaps]]:
    """(length, segment, start, size, gaps) of the k + 1 index entries, then of the probes, of a line of n bytes."""
    own = [(n, i, s, z) for i, (s, z) in enumerate(segments(n, k))] + probes(n, k)
    return [(m, i, s, z, _cut(((0, m, 0, n, k),), 0, i, segments(m, k)[i][0], s, z)) for m, i, s, z in own]


@lru_cache(maxsize=1 << 14)
def refined(gaps: Gaps, index: bool) -> list[tuple[int, int, int, Gaps]]:
    """(segment, start, size, gaps) of the entries by which one with ``gaps`` is refined; with an empty segment if no gap can be cut."""
    which = _longest(gaps)
    if which is None:
        return [(0, 0, 0, gaps)]
    a, b, c, d, e = gaps[which]
    more, out = d - c - (b - a), []
    for i, (at, size) in enumerate(segments(b - a, e)):
        lo = at if index else max(0, at - i, at + more - (e - i))
        hi = at if index else min(d - c - size, at + i, at + more + (e - i))
        out += [(i, c + s, size, _cut(gaps, which, i, a + at, c + s, size)) for s in range(lo, hi + 1)]
    return out


_tables: dict = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** i modulo 2 ** 64 for i up to n at least."""
    if len(_tables.get(base, ())) <= n:
        _tables[base] = np.concatenate(([np.uint64(1)], np.cumprod(np.full(max(n, 1 << 20), base, np.uint64))))
    return _tables[base]


def _first_places(rows: pa.RecordBatch, index: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Row of the batch and number of the first occurrence of each of ``n`` distinct lines, by key, row and number."""
    rank = pc.rank(rows.column("key"), tiebreaker="dense").to_numpy()[at[:, 0]]
    order = np.lexsort((at[:, 1], rows.column("row").to_numpy()[at[:, 0]], rank, index))
    return at[order[np.searchsorted(index[order], np.arange(n))]]


class _Spans:
    """Hashes of substrings of a batch's lines, the same wherever they stand: sums of bytes times powers of an odd base, shifted back."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        n = len(data)
        self.off, self.back, self.sums = off, powers(_DOWN, n), np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(_UP, n)[:n], out=self.sums[1:])

    def hashes(self, line: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        begin = self.off[line] + start
        return (self.sums[begin + size] - self.sums[begin]) * self.back[begin]


def _refine(spans: _Spans, h: np.ndarray, line: np.ndarray, node: np.ndarray, states: list[tuple[Gaps, bool]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[Gaps, bool]]]:
    """The entries that refine some of a batch: hashes, lines, and of each its place in a new list of (gaps, whether of the index)."""
    used, of = np.unique(node, return_inverse=True)
    lists = [refined(*states[i]) for i in used.tolist()]
    wanted = np.full((len(used), max(map(len, lists), default=0), 4), -1, np.int64)
    new: list[tuple[Gaps, bool]] = []
    for row, (i, own) in enumerate(zip(used.tolist(), lists, strict=True)):
        for e, (segment, start, size, gaps) in enumerate(own):
            wanted[row, e] = segment, start, size, len(new)
            new.append((gaps, states[i][1]))
    found: list[list[np.ndarray]] = [[np.zeros(0, np.uint64)], [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]]
    for e in range(wanted.shape[1]):
        has = np.flatnonzero(wanted[of, e, 2] >= 0)
        segment, start, size, to = wanted[of[has], e].T
        found[0].append(mixed(h[has] + mixed(spans.hashes(line[has], start, size) ^ mixed(segment + 1))))
        found[1].append(line[has])
        found[2].append(to)
    return (*map(np.concatenate, found), new)


def _entries(least: int, k: int, parts: int, crowded: tuple = (), bits: int = 0):
    """Packed index and probe entries (of roles 0 and 1) of the distinct lines of each batch, refined once for each bitmap of ``crowded`` keys, of those alone."""
    most = max(len(entries(n, k)) for n in range(4 * k + 4))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in C.slices(batch, "text"):
                distinct, ids, _, index, at = _identified(texts, least)
                if not len(ids):
                    continue
                data, off = C.raw(C.plain(distinct))
                spans = _Spans(data, off)
                lengths, of = np.unique(np.diff(off), return_inverse=True)
                # One column for each entry that a line can have; shorter lists end with empty substrings.
                wanted = np.full((len(lengths), most, 4), -1, np.int64)
                states: list[tuple[Gaps, bool]] = []
                for row, length in enumerate(lengths.tolist()):
                    own = entries(length, k)
                    wanted[row, : len(own)] = [x[:4] for x in own]
                    states += [(x[4], e <= k) for e, x in enumerate(own)] + [((), False)] * (most - len(own))
                keys = wanted[:, :, 0] << 8 | wanted[:, :, 1]
                salt = mixed(keys.astype(np.uint64).ravel()).reshape(keys.shape)
                found: list[list[np.ndarray]] = [[], [], []]
                for e in range(most):
                    start, size = wanted[of, e, 2], wanted[of, e, 3]
                    has = np.flatnonzero(size >= 0)
                    h = mixed(spans.hashes(has, start[has], size[has]) ^ salt[of[has], e])
                    if crowded:
                        met = in_bitmap(h.view(np.int64), crowded[0].value, bits)
                        h, has = h[met], has[met]
                    found[0].append(h)
                    found[1].append(has.astype(np.int32))
                    found[2].append(of[has] * most + e)
                h, line, node = map(np.concatenate, found)
                for level in range(len(crowded)):
                    if level:
                        met = in_bitmap(h.view(np.int64), crowded[level].value, bits)
                        h, line, node = h[met], line[met], node[met]
                    h, line, node, states = _refine(spans, h, line, node, states)
                if not len(h):
                    continue
                role, part = np.array([not own for _, own in states], np.int8)[node], (h % np.uint64(parts)).astype(np.int32)
                order = np.argsort(part << 1 | role, kind="stable")
                part, h, line, role = part[order], h[order], line[order], role[order]
                p, a, b = bounds(part)
                first = _first_places(rows, index, at, len(ids))[line]
                columns = (h, ids[line], bags(data, off)[line], role, first[:, 1].astype(np.int32), rows.column("row").to_numpy()[first[:, 0]])
                blobs = [pa.array([x[i:j].tobytes() for i, j in zip(a, b, strict=True)], pa.binary()) for x in columns]
                owners = pa.ListArray.from_arrays(pa.array(np.append(a, len(h)).astype(np.int32)), rows.column("key").take(pa.array(first[:, 0])))
                yield pa.RecordBatch.from_arrays([pa.array(p), *blobs, owners], ["part", "hashes", "lines", "bags", "roles", "numbers", "rows", "keys"])

    return run


def bags(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Of each line: sixteen counts modulo 16, four bits each, of its bytes by their low four bits."""
    n = len(off) - 1
    row = np.repeat(np.arange(n), np.diff(off))
    counts = np.bincount(row << 4 | (data[int(off[0]) : int(off[-1])] & 15), minlength=16 * n).reshape(n, 16).astype(np.uint64) & np.uint64(15)
    return (counts << (np.arange(16, dtype=np.uint64) * np.uint64(4))).sum(axis=1, dtype=np.uint64)


def bag_distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sum of the circular differences of the counts: an edit adds two at most, so lines within k edits differ by 2 k at most."""
    total = np.zeros(len(x), np.uint8)
    for i in range(0, 64, 4):
        d = (((x >> np.uint64(i)) - (y >> np.uint64(i))) & np.uint64(15)).astype(np.uint8)
        total += np.minimum(d, 16 - d)
    return total


def _candidates(table: pa.Table, k: int, window: int, take: int, asking: np.ndarray | None, bits: int, step: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Later and earlier line of pairs of which one probes an entry of the other, within one part, and whose bags allow ``k`` edits.

    Of the lines under a key, by place, a line looks at the first ``window`` and takes ``take`` of them; with a bitmap ``asking``, only lines in it do. A line paired with itself has more to ask; the last item holds the keys that have more to give.
    """
    h, line, bag, role, number, own_row = (np.frombuffer(b"".join(table.column(c).to_pylist()), t) for c, t in (("hashes", np.uint64), ("lines", np.int64), ("bags", np.uint64), ("roles", np.int8), ("numbers", np.int32), ("rows", np.int64)))
    keys = pa.chunked_array([pc.list_flatten(table.column("keys").combine_chunks())]).combine_chunks()
    place = np.empty(len(line), np.int64)
    place[np.lexsort((number, own_row, pc.rank(keys, tiebreaker="dense").to_numpy()))] = np.arange(len(line))

    def side(which: np.ndarray) -> tuple[np.ndarray, ...]:
        order = np.flatnonzero(which)
        order = order[np.lexsort((place[order], line[order], h[order]))]
        new = np.ones(len(order), bool)
        new[1:] = (h[order[1:]] != h[order[:-1]]) | (line[order[1:]] != line[order[:-1]])
        order = order[new]
        order = order[np.lexsort((place[order], h[order]))]
        return h[order], line[order], bag[order], place[order]

    crowded = [np.zeros(0, np.uint64)]
    index, probing = side(role == 0), side(role == 1)
    for (ah, al, ab, ap), (bh, bl, bb, bp) in ((index, probing), (probing, index)):  # the first asks the second
        names, start, end = bounds(bh)
        if not len(names):
            continue
        g = np.searchsorted(names, ah)
        met = np.flatnonzero(names[np.minimum(g, len(names) - 1)] == ah)
        if asking is not None:
            met = met[in_bitmap(al[met], asking, bits)]
        g, far = g[met], np.int64(len(line) + 1)
        lo = start[g]
        count = np.searchsorted(np.repeat(np.arange(len(start)), end - start) * far + bp, g * far + ap[met]) - lo  # the earlier ones
        met, lo, count = met[count > 0], lo[count > 0], count[count > 0]
        beyond = met[count > window]
        yield np.unique(al[beyond]), np.unique(al[beyond])
        crowded.append(ah[beyond])
        count = np.minimum(count, window)
        total, at = np.cumsum(count), 0
        while at < len(met):  # in steps of whole lines, so that a crowded key does not fill the memory
            to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + step)))
            own = count[at:to]
            x, y = np.repeat(met[at:to], own), np.repeat(lo[at:to] - (np.cumsum(own) - own), own) + np.arange(own.sum())
            good = (al[x] != bl[y]) & (bag_distance(ab[x], bb[y]) <= 2 * k)
            x, y = x[good], y[good]
            rank = np.arange(len(x)) - np.searchsorted(x, x)
            now = rank < take
            over = np.unique(x[~now])
            yield al[over], al[over]
            crowded.append(ah[over])
            pairs = np.unique(np.stack([al[x[now]], bl[y[now]]], axis=1), axis=0)
            yield pairs[:, 0], pairs[:, 1]
            at = to
    yield np.unique(np.concatenate(crowded)).view(np.int64), np.zeros(0, np.int64)


def with_texts(docs: DataFrame, pairs: DataFrame, min_bytes: int, bits: int, at_once: int = 2000) -> tuple[DataFrame, DataFrame]:
    """``pairs`` of ids a, b of lines of ``docs``, and the lines' bytes x, y; and the stored lines. Only texts of lines in ``pairs`` are shuffled.

    The pairs end in so many tasks that one has about ``at_once``: verifying costs far more than their bytes say.
    """
    spark = docs.sparkSession
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("line")).distinct()
    hits = spark.sparkContext.broadcast(bitmap(wanted, "line", bits))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, part in C.slices(batch, "text"):
                distinct, ids, *_ = _identified(part, min_bytes)
                hit = in_bitmap(ids, hits.value, bits)
                yield pa.RecordBatch.from_arrays([pa.array(ids[hit], pa.int64()), distinct.filter(pa.array(hit)).cast(pa.binary())], ["line", "bytes"])

    lines = docs.select("text").mapInArrow(fetch, "line long, bytes binary").join(wanted, "line", "left_semi").groupBy("line").agg(F.min("bytes").alias("bytes"))
    lines = stored(lines, "lines")
    both = pairs.join(lines.select(F.col("line").alias("b"), F.col("bytes").alias("y")), "b").repartition(max(1, -(-pairs.count() // at_once)), "a")
    return both.join(lines.select(F.col("line").alias("a"), F.col("bytes").alias("x")), "a"), lines


def late_lines(docs: DataFrame, max_edits: int, min_bytes: int, window: int = 64, take: int = 16, bits: int = 26) -> DataFrame:
    """line, check: of the lines that have an earlier one within ``max_edits`` edits, stored. ``docs`` has key, row and text."""
    spark = docs.sparkSession
    docs = docs.select("key", "row", "text")
    kind, parts = docs.schema["key"].dataType.simpleString(), parts_for(docs, 8)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yes = pa.array([within(x, y, max_edits) for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True)], pa.bool_())
            own = batch.filter(yes)
            yield pa.RecordBatch.from_arrays([own.column("a"), pa.array(digests(own.column("x"))[1], pa.int64())], ["line", "check"])

    def asked(asking, crowded: tuple) -> DataFrame:
        """a, b: pairs, and lines with themselves; with b null, a is a key."""

        def match(table: pa.Table) -> pa.Table:
            grown = 4 ** len(crowded)
            found = list(_candidates(table, max_edits, grown * window, grown * take, asking.value if asking else None, bits))
            a = np.concatenate([np.zeros(0, np.int64), *(x for x, _ in found)])
            b = pa.concat_arrays([pa.array([], pa.int64()), *(pa.array(y, pa.int64()) if len(x) == len(y) else pa.nulls(len(x), pa.int64()) for x, y in found)])
            return pa.table({"a": pa.array(a, pa.int64()), "b": b})

        packed = docs.mapInArrow(_entries(min_bytes, max_edits, parts, crowded, bits), f"part int, hashes binary, lines binary, bags binary, roles binary, numbers binary, rows binary, keys array<{kind}>")
        return stored(packed.groupBy("part").applyInArrow(match, "a long, b long").distinct(), "pairs")

    late, asking, crowded = [], None, ()
    while True:  # each round cuts gaps of the last one's keys and looks at more
        pairs = asked(asking, crowded)
        both, lines = with_texts(docs.select("text"), pairs.where("a <> b"), min_bytes, bits)
        late.append(stored(both.mapInArrow(verify, "line long, check long").distinct(), "near"))
        release(lines)
        left = pairs.where("a = b").select(F.col("a").alias("line")).join(reduce(DataFrame.union, late).select("line"), "line", "left_anti")
        if left.isEmpty():
            release(pairs)
            break
        asking, more = (spark.sparkContext.broadcast(bitmap(d, c, bits)) for d, c in ((left, "line"), (pairs.where("b IS NULL"), "a")))
        crowded = (*crowded, more)
        release(pairs)
    out = stored(reduce(DataFrame.union, late).distinct(), "late")
    release(*late)
    return out


def told_apart(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with ``__row``, which tells rows with one key apart: 0 if no key is repeated, else numbers, which are stored with the rows."""
    again = docs.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
    if again.isEmpty():
        return docs.withColumn("__row", F.lit(0).cast("long"))
    return stored(docs.withColumn("__row", F.monotonically_increasing_id()), "rows")


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", max_edits: int = 2, min_bytes: int = 32, short: bool = False, words_per_edit: int | None = None) -> DataFrame:
    """The rows and columns of ``docs``, with ``text`` without its dropped lines, and two columns more: n_lines, n_dropped.

    Lines shorter than ``min_bytes`` are dropped only with ``short``, and then where an earlier line equals them; blank
    ones stay. With ``words_per_edit``, a line of ``min_bytes`` or more also goes where an earlier one is within so many
    word edits as the shorter has times that many words (see ``word_lines``). Null texts stay null, with 0 lines; empty texts have one line.
    Rows with the same key are documents of their own, in the order of the input; rows with a null key neither lose lines
    nor cost others any. Columns of ``docs`` named n_lines or n_dropped are replaced. An empty table gives no rows.
    """
    whole = told_apart(docs.drop("n_lines", "n_dropped"), key)
    rows = numbered(whole.where(F.col(key).isNotNull()), text).select(F.col(key).alias("key"), F.col("__row").alias("row"), "text")
    places = stored(rows.mapInArrow(_places(min_bytes, short), f"line long, check long, key {docs.schema[key].dataType.simpleString()}, row long, number int"), "places")
    first = places.groupBy("line", "check").agg(F.min(F.struct("key", "row", "number")).alias("first"), F.count("*").alias("n"))
    near = [late_lines(rows, max_edits, min_bytes)]
    if words_per_edit:
        from . import word_lines

        near.append(word_lines.late_lines(rows, words_per_edit, min_bytes))
    late = reduce(DataFrame.union, near).distinct()
    late = late.withColumn("late", F.lit(True))
    judged = first.join(late, ["line", "check"], "left").where("n > 1 OR late").withColumnRenamed("check", "__check")
    gone = joined(places, judged, "line").where((F.col("check") == F.col("__check")) & (F.coalesce("late", F.lit(False)) | (F.struct("key", "row", "number") != F.col("first"))))
    # A document's list is no longer than its text.
    gone = stored(gone.groupBy(F.col("key").alias("__key"), F.col("row").alias("__of")).agg(F.collect_set("number").alias("__gone")), "gone")
    release(places, *near)
    # Both sides are dealt by key at any size: a broadcast of the lists would hold only for small tables.
    out = whole.join(gone.hint("merge"), (F.col(key) == F.col("__key")) & (F.col("__row") == F.col("__of")), "left")
    lines = F.split(F.col(text).cast("string"), "\n")
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__gone")), lambda i: F.get(lines, i))
    out = out.withColumn("n_lines", F.coalesce(F.greatest(F.size(lines), F.lit(0)), F.lit(0)).cast("long")).withColumn("n_dropped", F.greatest(F.coalesce(F.size("__gone"), F.lit(0)), F.lit(0)).cast("long"))
    return out.withColumn(text, F.when(F.col("__gone").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))).select(*[c for c in docs.columns if c not in ("n_lines", "n_dropped")], "n_lines", "n_dropped")
