"""Joins of points with the ranges that hold them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def interval_join(points: DataFrame, ranges: DataFrame, on: list[str], value: str, lo: str, hi: str, width: float, parts: int | None = None) -> DataFrame:
    """``points`` with the columns of each range of the same ``on`` with lo <= value < hi.

    Both sides are cut into buckets of ``width``, so the join is one by equal keys and is dealt by bucket, not by ``on``
    alone: a range goes to each bucket that it meets, a point to one, and each pair meets once. ``width`` should be about
    the usual length of a range; much longer ranges are repeated for each bucket. Nulls and ranges without length join
    nothing. The ranges' columns must have other names than the points' but for ``on``.

    Ranges grow in number by the cut, which Spark's size check for sending them to all tasks does not see; so they are
    never sent but dealt. ``parts`` is the number of tasks for sides of any size, see ``parts_for``.
    """
    bucket = lambda c: F.floor(F.col(c) / width).cast("long")
    r = ranges.where(F.col(lo) < F.col(hi)).withColumn("__bucket", F.explode(F.sequence(bucket(lo), bucket(hi))))
    p = points.where(F.col(value).isNotNull()).withColumn("__bucket", bucket(value))
    if parts:
        r = r.repartition(parts, *on, "__bucket")  # the other side follows
    return p.join(r.hint("merge"), [*on, "__bucket"]).where((F.col(value) >= F.col(lo)) & (F.col(value) < F.col(hi))).drop("__bucket")
