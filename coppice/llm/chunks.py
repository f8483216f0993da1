"""Texts cut, without a copy, into chunks that the tokenisers handle alike alone and in context.

A chunk is a run of white space and the run of other characters after it. No pattern of the supported pre-tokenisers
matches from a non-space into a following space, so a text's pre-tokens are those of its chunks, in order. Only the
six ASCII white-space characters cut; a text that holds any other Unicode white space stays one chunk, so that the
look-ahead of ``\\s+(?!\\S)`` never meets a cut inside a run.

No such pattern matches over the border from an ASCII letter to a point, comma or the like either. A cut there leaves
fewer distinct chunks: a word is the same chunk before a comma and before a space.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Unicode's White_Space property beyond ASCII, and the information separators that some libraries add.
OTHER_SPACE = "[\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\u001c-\u001f]"

_LIBC = ctypes.CDLL(None)

BLANKS = " \t\n\x0b\x0c\r"

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
#: Marks that no special token and no contraction holds.
_MARK = np.zeros(256, dtype=bool)
_MARK[list(b'.,;:!?)"')] = True


def plain(texts: pa.Array) -> pa.Array:
    """As large_string, nulls as empty texts, in one block that starts at offset 0."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    return pa.concat_arrays([pc.fill_null(texts.cast(pa.large_string()), "")])


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts of ``plain()`` and the n + 1 offsets into them."""
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    return (np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), off


def chunked(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The chunks of all texts of ``plain()``, and the n + 1 offsets of the texts among the chunks."""
    data, off = raw(texts)
    lo, hi = int(off[0]), int(off[-1])
    starts = np.zeros(hi - lo + 1, dtype=bool)
    if hi > lo:
        space = _SPACE[data[lo:hi]]
        starts[1:-1] = (space[1:] & ~space[:-1]) | (_MARK[data[lo + 1 : hi]] & _LETTER[data[lo : hi - 1]])
        for i in np.flatnonzero(pc.match_substring_regex(texts, OTHER_SPACE).to_numpy(zero_copy_only=False)):
            starts[off[i] - lo : off[i + 1] - lo] = False
        starts[off[:-1][off[:-1] < off[1:]] - lo] = True
        starts[-1] = False
    at = np.flatnonzero(starts) + lo
    bounds = np.append(at, hi).astype(np.int64)
    out = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(bounds), texts.buffers()[2]) if len(at) else pa.array([], pa.large_string())
    return out, np.searchsorted(at, off)


def coded(chunks: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Each chunk's index into the distinct chunks, and these."""
    d = chunks.dictionary_encode()
    return d.indices.to_numpy(zero_copy_only=False), d.dictionary


class Memo:
    """Values of chunks computed before, in Arrow arrays: at most about ``size`` short chunks, some tens of bytes each."""

    def __init__(self, size: int = 400_000, longest: int = 64) -> None:
        self.size, self.longest = size, longest
        self.keys: pa.Array = pa.array([], pa.large_string())
        self.columns: list[pa.Array] = []

    def values(self, distinct: pa.Array, compute) -> list[pa.Array]:
        """The columns of values of distinct chunks; ``compute`` gives those of chunks that are not known."""
        known = pc.index_in(distinct, value_set=self.keys)
        new = distinct.filter(pc.is_null(known))
        fresh = compute(new)
        columns = [pa.concat_arrays([a, b]) for a, b in zip(self.columns, fresh, strict=True)] if self.columns else fresh
        lost = pc.is_null(known).to_numpy(zero_copy_only=False)
        at = np.where(lost, len(self.keys) + np.cumsum(lost) - 1, pc.fill_null(known, 0).to_numpy(zero_copy_only=False))
        found = [c.take(pa.array(at)) for c in columns]
        if len(self.keys) + len(new) <= self.size:
            short = pc.less_equal(pc.binary_length(new), self.longest)
            kept = pa.concat_arrays([pa.array(np.ones(len(self.keys), bool)), short])
            self.keys, self.columns = pa.concat_arrays([self.keys, new.filter(short)]), [c.filter(kept) for c in columns]
        else:  # what was asked now stays, the rest goes
            short = pc.less_equal(pc.binary_length(distinct), self.longest)
            self.keys, self.columns = distinct.filter(short), [c.filter(short) for c in found]
        return found


def summed(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sums of ``values`` from each offset to the next, empty stretches included."""
    return np.diff(np.concatenate(([0], np.cumsum(values, dtype=np.int64)))[off])


def trim() -> None:
    """Gives memory that Arrow and the C library keep after use back to the system: a worker outlives many operators."""
    pa.default_memory_pool().release_unused()
    if hasattr(_LIBC, "malloc_trim"):
        _LIBC.malloc_trim(0)


def slices(batch: pa.RecordBatch, column: str, most: int = 4 << 20):
    """``batch`` in parts whose texts hold about ``most`` bytes: memory stays bounded for very long texts."""
    texts = plain(batch.column(column))
    _, off = raw(texts)
    n, i = len(texts), 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + most, side="right")) - 1)
        yield batch.slice(i, j - i), pa.concat_arrays([texts.slice(i, j - i)])
        i = j
    trim()
