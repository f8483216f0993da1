"""Key joins and reference lookups. Sides are broadcast only by Spark's own size check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.notation import code_references
from . import scan


def aligned(left: DataFrame, right: DataFrame, on: Column, pairs: list[tuple[str, str]], required: str) -> DataFrame:
    """Inner join with ``aligned``: ``required`` is not null and each pair of columns is equal, nulls included; never null."""
    same = F.col(required).isNotNull()
    for a, b in pairs:
        same = same & F.col(a).eqNullSafe(F.col(b))
    return left.join(right, on).withColumn("aligned", same)


def only_in(left: DataFrame, right: DataFrame, key: str, other: str, parts: int | None = None) -> DataFrame:
    """The rows of ``left`` whose key ``right`` lacks. ``parts`` is for sides of any size: rows are dealt by key over so many tasks at least, see ``parts_for``."""
    k = right.select(F.col(other).alias("__k"))
    if parts:
        k = k.repartition(parts, "__k").hint("merge")  # the other side follows
    return left.join(k, F.col(key) == F.col("__k"), "left_anti")


def known_split(rows: DataFrame, key: str, known: DataFrame, other: str) -> DataFrame:
    """All rows with ``known``: whether the key is among the known ones."""
    k = known.select(F.col(other).alias("__k")).distinct().withColumn("__y", F.lit(True))
    return rows.join(k, F.col(key) == F.col("__k"), "left").withColumn("known", F.col("__y").isNotNull()).drop("__k", "__y")


def candidates(rows: DataFrame, key: str, text: str, year_guard: bool = True, floor: int = 699) -> DataFrame:
    """key, pos, ref: four-digit words of the text in order, but the row's own key, small numbers and years."""
    refs = rows.select(F.col(key).alias("key"), F.posexplode(F.regexp_extract_all(text, F.lit(r"\b(\d{4})\b"), F.lit(1))).alias("pos", "ref"))
    refs = refs.withColumn("ref", F.col("ref").cast("int")).where((F.col("ref") != F.col("key")) & (F.col("ref") > floor))
    return refs.where(~F.col("ref").between(1970, 2099)) if year_guard else refs


def first_valid_reference(rows: DataFrame, key: str, text: str, targets: DataFrame, target: str, year_guard: bool = True) -> DataFrame:
    """key, replacement: the first candidate that exists among the targets."""
    c = candidates(rows, key, text, year_guard).join(targets.select(F.col(target).alias("ref")).distinct(), "ref")
    return c.groupBy("key").agg(F.min_by("ref", "pos").alias("replacement"))


def dangling_references(rows: DataFrame, key: str, text: str, targets: DataFrame, target: str, year_guard: bool = True) -> DataFrame:
    return candidates(rows, key, text, year_guard).join(targets.select(F.col(target).alias("ref")), "ref", "left_anti").select("key", "ref").distinct()


def by_category(rows: DataFrame, key: str, width: int = 1000) -> DataFrame:
    return rows.withColumn("k", F.floor(F.col(key) / width).cast("long"))


def tally(rows: DataFrame, *keys: str, weight: str | None = None) -> DataFrame:
    """keys, n: the number of rows, or the sum of ``weight``."""
    return rows.groupBy(*keys).agg((F.sum(weight) if weight else F.count("*")).alias("n"))


def grouped_counts(rows: DataFrame, keys: dict[str, Column], sums: dict[str, Column] | None = None) -> DataFrame:
    """Counts by all keys, by all but the last, and so on down to all rows, in one pass: keys, level (grouping id), n and ``sums``.

    ``level`` has a bit for each key that a row sums over, the last key's being the lowest, so that a null key of the
    data and a key summed over differ. No rows give the grand total of 0 alone.
    """
    named = rows.select(*[c.alias(k) for k, c in keys.items()], *[c.alias(k) for k, c in (sums or {}).items()])
    return named.rollup(*keys).agg(F.grouping_id().alias("level"), F.count("*").alias("n"), *[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in sums or {}])


def multiset_diff(left: DataFrame, right: DataFrame, key: str, weight: str | None = None) -> DataFrame:
    """key, n_left, n_right where the tallies differ; an absent key counts 0."""
    a, b = (tally(d, key, weight=weight).withColumnRenamed("n", n) for d, n in ((left, "n_left"), (right, "n_right")))
    both = a.join(b, key, "full_outer").select(key, F.coalesce("n_left", F.lit(0)).alias("n_left"), F.coalesce("n_right", F.lit(0)).alias("n_right"))
    return both.where("n_left <> n_right")


def characters(rows: DataFrame, text: str) -> DataFrame:
    """ch, n: the characters of each row that are no white space, each once with its number there, so that a text makes a row per letter and not per character."""
    bare = F.regexp_replace(text, r"\s+", "")
    own = rows.where(F.col(text).isNotNull()).select(bare.alias("__text"))
    number = lambda c: F.struct(c.alias("ch"), (F.length("__text") - F.length(F.replace(F.col("__text"), c, F.lit("")))).cast("long").alias("n"))
    return own.where("__text <> ''").select(F.explode(F.transform(F.array_distinct(F.split("__text", "")), number)).alias("x")).select("x.*").where("ch <> ''")


def files(spark: SparkSession, folder: str, pattern: str = "*.yaml") -> DataFrame:
    """path (relative to ``folder``), content of all files under it, read by Spark's file source."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder)
    root = folder.rstrip("/").rpartition("://")[2].removeprefix("file:").lstrip("/")
    return f.select(F.substring_index("path", f"{root}/", -1).alias("path"), "content")


def content_diff(left: DataFrame, right: DataFrame, path: str, content: str) -> DataFrame:
    """path, status (missing, extra, changed) of two sets of files, compared by digest."""
    a, b = (d.select(F.col(path).alias("path"), F.sha2(F.col(content), 256).alias(h)) for d, h in ((left, "a"), (right, "b")))
    both = a.join(b, "path", "full_outer")
    return both.where(~F.col("a").eqNullSafe(F.col("b"))).select("path", F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "extra").otherwise("changed").alias("status"))


def next_larger(rows: DataFrame, group: str, order: Column, margin: float, fallback: float, result: str = "next") -> DataFrame:
    """For each row the smallest value of the group above its own by more than ``margin``, else its own plus ``fallback``.

    A range frame finds it in one sorted pass: the frame begins just beyond the margin.
    """
    r = rows.withColumn("__v", order)
    w = Window.partitionBy(group).orderBy("__v").rangeBetween(int(margin) + 1, Window.unboundedFollowing)
    return r.withColumn(result, F.coalesce(F.min("__v").over(w), F.col("__v") + F.lit(fallback).cast(r.schema["__v"].dataType))).drop("__v")


def interval_route(value: Column, intervals: list[tuple[str, float, float]]) -> Column:
    """Name of the first half-open interval that holds the value: a chain of comparisons, no join."""
    chain = F.when((value >= intervals[0][1]) & (value < intervals[0][2]), intervals[0][0])
    for name, lo, hi in intervals[1:]:
        chain = chain.when((value >= lo) & (value < hi), name)
    return chain


def seeded_sample(rows: DataFrame, order: Column, n: int, *keys: str) -> DataFrame:
    """``n`` rows by an order that a seed determines; ``keys`` break ties, so that the sample does not hang on the files."""
    return rows.orderBy(order, *keys).limit(n)


def segment_links(elements: DataFrame, mirror: DataFrame) -> DataFrame:
    """tag, name, type, max_length (of the mirror), repr_raw, aligned of active elements that the mirror has."""
    e = elements.where("status = 'active'").select("tag", "representation")
    m = mirror.select(F.col("tag").alias("__tag"), "name", "type", "max_length")
    e = e.withColumns({"__c": F.col("representation.charset"), "__m": F.col("representation.max_length")})
    j = aligned(e, m, F.col("tag") == F.col("__tag"), [("__c", "type"), ("__m", "max_length")], "representation")
    return j.select("tag", "name", "type", "max_length", F.col("representation.raw").alias("repr_raw"), "aligned")


def code_coverage(elements: DataFrame, counts: DataFrame) -> DataFrame:
    """tag, code_values of active elements with a code list (id, n)."""
    e = elements.where("status = 'active'").select("tag")
    return e.join(counts.select(F.col("id").alias("tag"), F.col("n").alias("code_values")), "tag")


def skipped_ids(elements: DataFrame, counts: DataFrame) -> DataFrame:
    """id of the code lists that no element of any status has."""
    return only_in(counts, elements, "id", "tag").select("id")


def references(entries: DataFrame) -> DataFrame:
    """code_list, entry, code, name, description, pos, kind, tag: a row per cross-reference of code entries."""
    e = entries.select("code_list", "entry", "code", "name", "description", F.posexplode(code_references(F.col("name"), F.col("description"))).alias("pos", "r"))
    return e.select("code_list", "entry", "code", "name", "description", "pos", "r.kind", "r.tag")


def nested_references(refs: DataFrame, elements: DataFrame, width: int | None = None, parts: int | None = None) -> DataFrame:
    """tag, refs: the references to known elements of any status, as a list in file and line order; an empty description is null.

    ``width`` is for tags with any number of references: tag, part, refs, the list in pieces of at most so many, in order
    of ``part``. Rows are then sorted over ``parts`` ranges, and pieces end where ranges do.
    """
    tags = only_known(refs.select("tag").distinct(), elements, "left_semi")  # few, so that a tag's rows stay where they are
    known = refs.join(tags, "tag", "left_semi")
    one = F.struct("code_list", "code", "name", "kind", F.nullif("description", F.lit("")).alias("description"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("code_list", "entry", "pos", one.alias("r")))), lambda x: x.r).alias("refs")
    if width is None:
        return known.groupBy("tag").agg(listed)
    s = scan.ordered(known, ["tag"], ["code_list", "entry", "pos"], parts)
    # Numbers leave gaps between ranges but none within, so a piece is a stretch of one range.
    pieces = s.withColumn("part", F.shiftleft(F.col(scan.PART).cast("long"), 33) + F.floor(F.col(scan.AT).bitwiseAND(F.lit((1 << 33) - 1)) / width))
    return (pieces.repartition(parts, "tag", "part") if parts else pieces).groupBy("tag", "part").agg(listed)


def unknown_tags(refs: DataFrame, elements: DataFrame) -> DataFrame:
    """tag: distinct, of references to no known element."""
    return only_known(refs.select("tag").distinct(), elements, "left_anti")


def only_known(tags: DataFrame, elements: DataFrame, how: str) -> DataFrame:
    """The distinct tags that elements have (``left_semi``) or lack (``left_anti``), before their rows are looked at: these may be many for one tag."""
    return tags.join(elements.select(F.col("tag").alias("__k")), F.col("tag") == F.col("__k"), how)
