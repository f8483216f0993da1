"""Ordered work within groups of any size, by a prefix scan in two passes.

A window over a group puts the whole group into one task. Here rows are dealt by ranges of (group, order), so a group
of any size spreads over as many tasks as it fills. The first pass works within each range; of each range only what its
groups hand on is kept. Of the groups in a range at most one, the first, began in an earlier range, so the carries are
at most one row a range: these are broadcast, and the second pass adds them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import stored

PART, AT = "__part", "__at"


def ordered(rows: DataFrame, group: list[str], order: list[str | Column], parts: int | None = None, within: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``rows``, sorted by (group, order) over ranges and written once, with ``__at``, their number in that order, and ``__part``, their range.

    ``order`` must break ties; nulls come first. An empty ``group`` makes all rows one group. ``within`` is applied to
    the sorted ranges before they are written; it must not deal rows anew.
    """
    by = [F.col(c) if isinstance(c, str) else c for c in [*group, *order]]
    if not by:
        raise ValueError("no order")
    dealt = rows.repartitionByRange(parts, *by) if parts else rows.repartitionByRange(*by)
    numbered = dealt.sortWithinPartitions(*by).withColumn(AT, F.monotonically_increasing_id())
    numbered = numbered.withColumn(PART, F.shiftright(AT, 33).cast("int"))
    return stored(within(numbered) if within else numbered, "ordered")


def _within(group: list[str]) -> Window:
    return Window.partitionBy(PART, *group).orderBy(AT)


def carried(s: DataFrame, carry: DataFrame, group: list[str]) -> DataFrame:
    """``s`` with the columns of ``carry``, which has a row for at most one group of each range; null group keys meet."""
    side = F.broadcast(carry.select(F.col(PART).alias("__p"), *[F.col(g).alias(f"__g{i}") for i, g in enumerate(group)], *[c for c in carry.columns if c not in (PART, *group)]))
    on = reduce(lambda a, b: a & b, [F.col(PART) == F.col("__p"), *[F.col(g).eqNullSafe(F.col(f"__g{i}")) for i, g in enumerate(group)]])
    return s.join(side, on, "left").drop("__p", *[f"__g{i}" for i in range(len(group))])


def lagged(s: DataFrame, group: list[str], value: Column, result: str) -> DataFrame:
    """``s`` of ``ordered`` with ``result``: ``value`` of the row before in the group, null for the first."""
    s = s.withColumn("__v", value)
    last = s.groupBy(PART, *group).agg(F.max_by(F.struct("__v"), AT).alias("__last"))
    over = Window.partitionBy(*group).orderBy(PART)  # a row a range and group
    carry = last.withColumn("__before", F.lag("__last").over(over)).where("__before IS NOT NULL").drop("__last")
    w = _within(group)
    r = carried(s.withColumns({"__own": F.lag(F.struct("__v")).over(w)}), carry, group)
    return r.withColumn(result, F.coalesce("__own", "__before")["__v"]).drop("__v", "__own", "__before")


def running(s: DataFrame, group: list[str], value: Column, result: str) -> DataFrame:
    """``s`` of ``ordered`` with ``result``: the sum of ``value`` over the group up to and with the row; a null counts 0."""
    s = s.withColumn("__v", F.coalesce(value.cast("long"), F.lit(0).cast("long")))
    total = s.groupBy(PART, *group).agg(F.sum("__v").alias("__sum"))
    over = Window.partitionBy(*group).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    carry = total.withColumn("__before", F.sum("__sum").over(over)).where("__before IS NOT NULL").drop("__sum")
    own = F.sum("__v").over(_within(group).rowsBetween(Window.unboundedPreceding, 0))
    r = carried(s.withColumn("__own", own), carry, group)
    return r.withColumn(result, F.col("__own") + F.coalesce("__before", F.lit(0))).drop("__v", "__own", "__before")


def plain(s: DataFrame) -> DataFrame:
    return s.drop(PART, AT)
