"""Whether two graphs are equal but for the labels of their blank nodes, by iterated hashing.

A blank node's colour is a hash of its statements, with the colours of the blank nodes in them; colours are refined until
no more of them differ. Each round is a join of the statements that touch blank nodes with the colours and a sum of
hashes by node, which is combined before it is dealt. Then statements with colours for labels are compared as sets.

Unequal colours prove that graphs differ. Equal ones prove that they are equal if every colour has one node or the blank
nodes of one colour hang below different nodes without rings, as those of nested nodes do; ``colour_counts`` tells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import stored


def _blank(c: str) -> Column:
    return F.col(c).startswith("_:")


def _sum(*parts: Column) -> Column:
    """A hash of a multiset of rows, whatever their order; decimals don't overflow."""
    return F.sum(F.xxhash64(*parts).cast("decimal(38,0)"))


def colours(statements: DataFrame, most_rounds: int = 100) -> DataFrame:
    """node, colour of each blank node of ``statements`` (s, p, o, kind). Labels play no part, so equal graphs give equal colours."""
    keep = [c for c in ("s", "p", "o", "kind", "detail") if c in statements.columns]
    touched = stored(statements.select(*keep).distinct().where(_blank("s") | (F.col("kind") == "blank")), "touched")
    rest = [F.col(c) for c in keep if c not in ("s", "o")]
    # A row for each end of a statement that is a blank node: what lies at the other end, and whether that is blank too.
    out = touched.where(_blank("s")).select(F.col("s").alias("node"), F.lit("out").alias("way"), *rest, F.when(F.col("kind") == "blank", F.col("o")).alias("other"), F.when(F.col("kind") != "blank", F.col("o")).alias("fixed"))
    into = touched.where(F.col("kind") == "blank").select(F.col("o").alias("node"), F.lit("in").alias("way"), *rest, F.when(_blank("s"), F.col("s")).alias("other"), F.when(~_blank("s"), F.col("s")).alias("fixed"))
    ends = stored(out.unionByName(into), "ends")
    parts = [F.col(c) for c in ends.columns if c not in ("node", "other")]
    c = stored(ends.select("node").distinct().withColumn("colour", F.lit(0).cast("long")), "colours")
    n = 0
    for _ in range(most_rounds):
        known = c.select(F.col("node").alias("other"), F.col("colour").alias("theirs"))
        seen = ends.join(known, "other", "left")
        new = seen.groupBy("node").agg(_sum(*parts, F.col("theirs")).alias("a"), _sum(F.lit(1), *parts, F.col("theirs")).alias("b"), F.count("*").alias("n"))
        # The old colour goes in, so that a round never joins what an earlier one told apart.
        c = stored(new.join(c, "node").select("node", F.xxhash64("colour", "a", "b", "n").alias("colour")), "colours")
        now = c.agg(F.countDistinct("colour")).first()[0]
        if now == n:
            return c
        n = now
    raise RuntimeError(f"colours still change after {most_rounds} rounds")


def coloured(statements: DataFrame) -> DataFrame:
    """The distinct statements with the colours of blank nodes for their labels."""
    c = colours(statements)
    keep = [x for x in ("s", "p", "o", "kind", "detail") if x in statements.columns]
    s = statements.select(*keep).distinct()
    s = s.join(c.select(F.col("node").alias("s"), F.col("colour").alias("__s")), "s", "left").join(c.select(F.col("node").alias("o"), F.col("colour").alias("__o")), "o", "left")
    named = lambda x, y: F.when(F.col(y).isNotNull(), F.concat(F.lit("_:c"), F.hex(y))).otherwise(F.col(x)).alias(x)
    end = F.when(F.col("kind") == "blank", F.concat(F.lit("_:c"), F.hex("__o"))).otherwise(F.col("o")).alias("o")
    return s.select(named("s", "__s"), "p", end, *[x for x in keep if x not in ("s", "p", "o")])


def graph_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Statements with their numbers in either graph where these differ: s, p, o, kind, n_left, n_right. Empty for equal graphs.

    Statements count once; alike blank nodes of one colour count each. Columns beside s, p, o, kind and detail are not
    read, and detail only where both have it.
    """
    keep = [x for x in ("s", "p", "o", "kind", "detail") if x in left.columns and x in right.columns]
    a, b = coloured(left.select(keep)).withColumn("__l", F.lit(1)), coloured(right.select(keep)).withColumn("__l", F.lit(0))
    both = a.unionByName(b).groupBy(*keep).agg(F.sum("__l").alias("n_left"), F.sum(1 - F.col("__l")).alias("n_right"))
    return both.where("n_left <> n_right")


def isomorphic(left: DataFrame, right: DataFrame) -> bool:
    return graph_differences(left, right).isEmpty()


def colour_counts(statements: DataFrame) -> DataFrame:
    """One row: blank nodes, colours, and the most nodes of one colour."""
    c = colours(statements).groupBy("colour").count()
    return c.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("nodes"), F.count("*").alias("colours"), F.coalesce(F.max("count"), F.lit(0)).alias("most"))
