"""Connected components of an edge table by alternating large-star and small-star steps.

Each step is two joins or aggregations on node ids with map-side combination; the number of rounds is logarithmic in
the size of the components. Every round is written to the shared folder, which cuts its lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import release, stored


def joined(rows: DataFrame, per_key: DataFrame, on: str) -> DataFrame:
    """``rows`` with the columns of ``per_key``, one row a key; the rows of a hot key can go to several tasks.

    A join on the exchange of the aggregation that made ``per_key`` can't be split by AQE. So both sides are dealt by
    another expression of the key, of which each has an exchange of its own.
    """
    side = per_key.withColumn("__on", F.bitwise_not(on)).drop(on)
    return rows.withColumn("__on", F.bitwise_not(on)).join(side, "__on").drop("__on")


def joined_by(rows: DataFrame, per_key: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """As ``joined``, for keys of any type, and for left joins too."""
    side = per_key.withColumnRenamed(on, "__key").withColumn("__with", F.xxhash64(F.lit(1), "__key"))
    return rows.withColumn("__on", F.xxhash64(F.lit(1), on)).join(side, (F.col("__on") == F.col("__with")) & (F.col(on) == F.col("__key")), how).drop("__on", "__with", "__key")


def _unfinished(e: DataFrame) -> int:
    """How many nodes have two smaller neighbours, or a smaller and a larger one. Without any, ``e`` is stars about their least nodes."""
    ends = e.select(F.col("a").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(e.select(F.col("b").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up + down > 1 AND up > 0").agg(F.count("*")).first()[0]


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``edges`` (a, b: long) to one row per node that has an edge to another: node, component (its smallest node)."""
    e = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    rounds = 0
    while _unfinished(e):
        if rounds == most_rounds:
            raise RuntimeError(f"no stars after {most_rounds} rounds")
        rounds += 1
        both = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = joined(both, least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = joined(large, least, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")).where("a <> b")
        small = small.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
        last, e = e, stored(small, "edges")
        release(last)
    stars = e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
