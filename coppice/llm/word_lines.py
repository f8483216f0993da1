"""Near copies of lines by words, with room that grows with the line: an exact join on rare word trigrams.

Two lines are near if the shorter has at least ``per`` words and their edit distance in words is at most a ``per``-th of
its number. Each letter of a script written without spaces counts as a word. A word edit touches three trigrams at most, so lines
within e edits share a trigram among the 3 e + 1 first of each, in any order that all tasks agree on. Here those come
first whose rarest word is rare, by counts of the word classes of all lines.

The entries of a trigram are sorted by the lines' first places. A line asks the earliest lines of each of its entries
first, and all other earlier ones only if those are not near: a group of m near copies does not make m * m pairs. In
that second round only the entries of crowded trigrams travel, each with finer counts of the line's words, so that
lines that are a little too far from each other are told apart before they become pairs.
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
from .exchange import bitmap, bounds, in_bitmap, mixed, parts_for
from .line_dedup import _identified, bag_distance, digests, with_texts, within
from .shared import release, stored

_BITS = 18
_ODD = np.uint64(0x9E3779B97F4A7C15)
_UNSPACED = r"([\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}])"


def words(lines: pa.Array) -> pa.Array:
    """The words of each line, as lists."""
    if not pc.all(pc.string_is_ascii(lines)).as_py():
        lines = pc.replace_substring_regex(lines, _UNSPACED, r" \1 ")
    return pc.utf8_split_whitespace(pc.utf8_trim_whitespace(lines))


def _hashes(lists: pa.Array) -> np.ndarray:
    index, distinct = C.coded(lists.flatten())
    return np.array([xxhash.xxh64_intdigest(x) for x in distinct.to_pylist()], np.uint64)[index] if len(index) else np.zeros(0, np.uint64)


def _class(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - _BITS)).astype(np.int64)


def fine_bags(h: np.ndarray, off: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Of some rows: 256 counts modulo 4, two bits each, of their words by eight bits of the hash."""
    n = np.diff(off)[rows]
    at = np.repeat(off[:-1][rows] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    bins = ((h[at] >> np.uint64(8)) & np.uint64(255)).astype(np.int64)
    counts = (np.bincount(np.repeat(np.arange(len(rows)), n) << 8 | bins, minlength=256 * len(rows)) & 3).astype(np.uint8)
    return (counts.reshape(-1, 64, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=2, dtype=np.uint8).view(np.uint64)


_HIGH, _LOW = np.uint64(0xAAAAAAAAAAAAAAAA), np.uint64(0x5555555555555555)


def fine_distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sum of the circular differences of the counts: a word edit adds two at most. All counts of a word are subtracted at once."""
    z = ((x | _HIGH) - (y & _LOW)) ^ ((x ^ ~y) & _HIGH)
    return np.bitwise_count(z & _LOW).sum(axis=1, dtype=np.int64) + 2 * np.bitwise_count(z >> np.uint64(1) & ~z & _LOW).sum(axis=1, dtype=np.int64)


def _grams(lines: pa.Array, per: int, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Which lines have ``per`` words, their numbers of words and bags; of each trigram its row, hash and how often its rarest word's class occurs, equal ones of a line told apart; the hashes of all words."""
    lists = words(lines)
    n = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    enough = n >= per
    lists, n = lists.filter(pa.array(enough)), n[enough]
    h = _hashes(lists)
    row = np.repeat(np.arange(len(n)), n)
    bins = np.bincount(row << 4 | (h & np.uint64(15)).astype(np.int64), minlength=16 * len(n)).reshape(len(n), 16).astype(np.uint64) & np.uint64(15)
    bag = (bins << (np.arange(16, dtype=np.uint64) * np.uint64(4))).sum(axis=1, dtype=np.uint64)
    at = np.flatnonzero(row[2:] == row[:-2]) if len(row) > 2 else np.zeros(0, np.int64)
    often = counts[_class(h)]
    often = np.minimum(np.minimum(often[at], often[at + 1]), often[at + 2])
    gram, row = mixed((h[at] * _ODD + h[at + 1]) * _ODD + h[at + 2]), row[at]
    order = np.lexsort((gram, row))
    gram, row, often = gram[order], row[order], often[order]
    new = np.ones(len(gram), bool)
    new[1:] = (gram[1:] != gram[:-1]) | (row[1:] != row[:-1])
    place = np.arange(len(gram))
    again = place - np.maximum.accumulate(np.where(new, place, 0))
    return enough, n, bag, row, mixed(gram + again.astype(np.uint64) * _ODD), often, h


def _counts(docs: DataFrame, min_bytes: int) -> np.ndarray:
    """How often the words of each of 2 ** 18 classes occur in the lines of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << _BITS, np.int64)
        for batch in batches:
            for _, texts in C.slices(batch, "text"):
                total += np.bincount(_class(_hashes(words(_identified(texts, min_bytes)[0]))), minlength=1 << _BITS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["class", "n"])

    got = docs.select("text").mapInArrow(run, "class int, n long").groupBy("class").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(1 << _BITS, np.int64)
    out[got.column("class").to_numpy()] = got.column("n").to_numpy()
    return out


def _entries(per: int, min_bytes: int, parts: int, counts, crowded=None, bits: int = 0):
    """Packed (trigram, line, bag, number of words, line number, key) of the 3 e + 1 rarest trigrams of each distinct line of a batch; with a bitmap of ``crowded`` trigrams, of those alone, and with finer bags."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in C.slices(batch, "text"):
                distinct, ids, _, index, at = _identified(texts, min_bytes)
                if not len(ids):
                    continue
                keys = rows.column("key")
                rank = pc.rank(keys, tiebreaker="dense").to_numpy()[at[:, 0]]
                order = np.lexsort((at[:, 1], rows.column("row").to_numpy()[at[:, 0]], rank, index))
                first = at[order[np.searchsorted(index[order], np.arange(len(ids)))]]
                enough, n, bag, row, gram, often, h = _grams(distinct, per, counts.value)
                ids, first = ids[enough], first[enough]
                order = np.lexsort((gram, often, row))
                row, gram = row[order], gram[order]
                rarest = np.arange(len(row)) - np.searchsorted(row, row) <= 3 * (n[row] // per)
                row, gram = row[rarest], gram[rarest]
                if crowded is not None:
                    met = in_bitmap(gram.view(np.int64), crowded.value, bits)
                    row, gram = row[met], gram[met]
                if not len(row):
                    continue
                part = (gram % np.uint64(parts)).astype(np.int32)
                order = np.argsort(part, kind="stable")
                part, row, gram = part[order], row[order], gram[order]
                p, a, b = bounds(part)
                fine = np.zeros((len(row), 0), np.uint64)
                if crowded is not None:
                    own, to = np.unique(row, return_inverse=True)
                    fine = fine_bags(h, np.concatenate(([0], np.cumsum(n))), own)[to]
                columns = (gram, ids[row], bag[row], n[row].astype(np.uint32), first[row, 1].astype(np.int32), rows.column("row").to_numpy()[first[row, 0]], fine)
                blobs = [pa.array([x[i:j].tobytes() for i, j in zip(a, b, strict=True)], pa.binary()) for x in columns]
                lists = pa.ListArray.from_arrays(pa.array(np.append(a, len(row)).astype(np.int32)), keys.take(pa.array(first[row, 0])))
                yield pa.RecordBatch.from_arrays([pa.array(p.astype(np.int32)), *blobs, lists], ["part", "grams", "lines", "bags", "words", "numbers", "rows", "fine", "keys"])

    return run


def _pairs(table: pa.Table, per: int, heads: int, asking: np.ndarray | None, bits: int, step: int = 1 << 19) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Later and earlier line of each pair to be compared: with the first ``heads`` of an entry, or, for the lines ``asking``, with the others.

    In the first case a line paired with itself is one that has others to ask, and a last item holds the crowded trigrams.
    """
    gram, line, bag, n, number, own_row = (np.frombuffer(b"".join(table.column(c).to_pylist()), k) for c, k in (("grams", np.uint64), ("lines", np.int64), ("bags", np.uint64), ("words", np.uint32), ("numbers", np.int32), ("rows", np.int64)))
    keys = pa.chunked_array([pc.list_flatten(table.column("keys").combine_chunks())]).combine_chunks()
    place = np.empty(len(line), np.int64)
    place[np.lexsort((number, own_row, pc.rank(keys, tiebreaker="dense").to_numpy()))] = np.arange(len(line))
    order = np.lexsort((place, line, gram))
    new = np.ones(len(order), bool)
    new[1:] = (gram[order[1:]] != gram[order[:-1]]) | (line[order[1:]] != line[order[:-1]])
    order = order[new]
    order = order[np.lexsort((place[order], gram[order]))]
    gram, line, bag, n = gram[order], line[order], bag[order], n[order].astype(np.int64)
    pos = np.arange(len(gram)) - np.searchsorted(gram, gram)
    fine = None
    if asking is None:
        count, lo = np.minimum(pos, heads), 0
        more = np.unique(line[pos > heads])
        yield more, more
    else:
        count, lo = np.where(in_bitmap(line, asking, bits), np.maximum(pos - heads, 0), 0), heads
        fine = np.frombuffer(b"".join(table.column("fine").to_pylist()), np.uint64).reshape(-1, 8)[order]
    some = np.flatnonzero(count)
    total, at = np.cumsum(count[some]), 0
    while at < len(some):  # in steps, so that a crowded trigram does not fill the memory
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + step)))
        i, own = some[at:to], count[some[at:to]]
        j = np.repeat(i - pos[i] + lo - (np.cumsum(own) - own), own) + np.arange(own.sum())
        i = np.repeat(i, own)
        e = np.minimum(n[i], n[j]) // per
        good = np.abs(n[i] - n[j]) <= e
        i, j, e = i[good], j[good], e[good]
        good = bag_distance(bag[i], bag[j]) <= 2 * e
        i, j, e = i[good], j[good], e[good]
        if fine is not None:
            good = np.concatenate([np.zeros(0, bool), *(fine_distance(fine[i[k : k + 65536]], fine[j[k : k + 65536]]) <= 2 * e[k : k + 65536] for k in range(0, len(i), 65536))])
            i, j = i[good], j[good]
        pairs = np.unique(np.stack([line[i], line[j]], axis=1), axis=0)
        yield pairs[:, 0], pairs[:, 1]
        at = to
    if asking is None:
        yield np.unique(gram[pos > heads]).view(np.int64), np.zeros(0, np.int64)


def late_lines(docs: DataFrame, per: int, min_bytes: int, heads: int = 3, bits: int = 26) -> DataFrame:
    """line, check: of the lines that have an earlier near one, stored. ``docs`` has key, row and text."""
    spark = docs.sparkSession
    docs = docs.select("key", "row", "text")
    counts = spark.sparkContext.broadcast(_counts(docs, min_bytes))
    kind = docs.schema["key"].dataType.simpleString()
    parts = parts_for(docs, 8)

    def packed(crowded=None) -> DataFrame:
        return docs.mapInArrow(_entries(per, min_bytes, parts, counts, crowded, bits), f"part int, grams binary, lines binary, bags binary, words binary, numbers binary, rows binary, fine binary, keys array<{kind}>")

    def pairs(entries: DataFrame, asking, purpose: str) -> DataFrame:
        """a, b: pairs; with b null, a is a crowded trigram."""

        def match(table: pa.Table) -> pa.Table:
            found = list(_pairs(table, per, heads, asking.value if asking else None, bits))
            a = np.concatenate([np.zeros(0, np.int64), *(x for x, _ in found)])
            b = pa.concat_arrays([pa.array([], pa.int64()), *(pa.array(y, pa.int64()) if len(x) == len(y) else pa.nulls(len(x), pa.int64()) for x, y in found)])
            return pa.table({"a": pa.array(a, pa.int64()), "b": b})

        return stored(entries.groupBy("part").applyInArrow(match, "a long, b long").distinct(), purpose)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (words(batch.column(c).cast(pa.string())).to_pylist() for c in "xy")
            yes = pa.array([within(v, w, min(len(v), len(w)) // per) for v, w in zip(x, y, strict=True)], pa.bool_())
            own = batch.filter(yes)
            yield pa.RecordBatch.from_arrays([own.column("a"), pa.array(digests(own.column("x"))[1], pa.int64())], ["line", "check"])

    def near(found: DataFrame, purpose: str) -> DataFrame:
        both, lines = with_texts(docs.select("text"), found, min_bytes, bits)
        out = stored(both.mapInArrow(verify, "line long, check long").distinct(), purpose)
        release(lines)
        return out

    found = pairs(packed(), None, "word-pairs")
    late = near(found.where("a <> b"), "late")
    others = stored(found.where("a = b").select(F.col("a").alias("line")).join(late, "line", "left_anti"), "asking")
    if others.isEmpty():
        release(others, found)
        return late
    crowded = spark.sparkContext.broadcast(bitmap(found.where("b IS NULL"), "a", bits))
    release(found)
    more = pairs(packed(crowded), spark.sparkContext.broadcast(bitmap(others, "line", bits)), "more-pairs")
    found = near(more, "more-late")
    both = stored(late.union(found).distinct(), "late")
    release(others, more, found, late)
    return both
