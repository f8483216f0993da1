"""A shuffle of packed blobs, for stages that would else shuffle many millions of tiny rows.

A map task packs the numbers for one part of the key space into one binary row per batch; a reduce task gets the
blobs of its part. Parts are numbered by a hash of the key, so they are even; their count follows the input's splits.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def parts_for(df: DataFrame, factor: int) -> int:
    """Parts in proportion to the splits of the input, of which Spark bounds the size."""
    return max(8, factor * df.rdd.getNumPartitions())


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every bit depends on all bits."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def bounds(sorted_parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The values of a sorted array, where each begins and where it ends."""
    if not len(sorted_parts):
        return sorted_parts, np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate(([True], sorted_parts[1:] != sorted_parts[:-1])))
    return sorted_parts[first], first, np.append(first[1:], len(sorted_parts))


def bitmap(ids: DataFrame, column: str, bits: int) -> np.ndarray:
    """Which values of ``column`` modulo 2 ** bits occur: at most 2 ** bits / 8 bytes, whatever the number of rows."""
    words = ids.select(F.col(column).bitwiseAND(F.lit((1 << bits) - 1)).alias("p")).select(F.shiftright("p", 6).alias("w"), F.expr("shiftleft(1L, cast(p & 63 AS int))").alias("m")).groupBy("w").agg(F.bit_or("m").alias("m")).toArrow()
    out = np.zeros(1 << bits - 6, np.int64)
    out[words.column("w").to_numpy()] = words.column("m").to_numpy()
    return out.view(np.uint8)


def in_bitmap(ids: np.ndarray, marks: np.ndarray, bits: int) -> np.ndarray:
    p = ids & ((1 << bits) - 1)
    return (marks[p >> 3] >> (p & 7).astype(np.uint8)) & 1 > 0
