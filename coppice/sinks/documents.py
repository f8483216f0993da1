"""One-row JSON documents of a directory and of its joins. They are for reference data that fits a string; JSON lines take more."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.notation import bridges, first_zones
from ..functions.text import let


def _listed(rows: DataFrame, order: list[str], record: Column) -> Column:
    """The records of all rows in order, as an aggregate."""
    return F.transform(F.array_sort(F.collect_list(F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], record.alias("r")))), lambda x: x.r)


def document(rows: DataFrame, order: list[str], record: Column, name: str, counts: dict[str, Column], **fields: str) -> DataFrame:
    """One row: the JSON of ``fields``, then ``counts`` (aggregates), then the list ``name``."""
    parts = [F.lit(v).alias(k) for k, v in fields.items()] + [c.alias(k) for k, c in counts.items()] + [_listed(rows, order, record).alias(name)]
    return rows.agg(F.to_json(F.struct(*parts), {"pretty": "true"}).alias("json"))


def elements_document(elements: DataFrame, source: str, pages: str) -> DataFrame:
    fields = [c for c in elements.columns if c not in ("file", "file_no", "category", "ord")]
    return document(elements, ["tag"], F.struct(*fields), "elements", {"element_count": F.count("*")}, source=source, pages=pages)


def categories_document(spark: SparkSession) -> DataFrame:
    c = S.categories(spark)
    return c.agg(F.to_json(_listed(c, ["k"], F.struct("k", "section", "range", "label")), {"pretty": "true"}).alias("json"))


def parser_fixtures(elements: DataFrame, replacements: DataFrame) -> DataFrame:
    """tag, status, notes, bridges, entries, zones, replacement of the pinned tags."""
    own = elements.where(F.col("tag").isin(S.FIXTURE_TAGS)).join(replacements.select(F.col("key").alias("tag"), "replacement"), "tag", "left")
    zone = lambda z: F.struct(z.line_from.alias("lineFrom"), z.line_to.alias("lineTo"), z.pos_from.alias("posFrom"), z.pos_to.alias("posTo"), z["format"].alias("format"))
    return own.select("tag", "status", "notes", "bridges", bridges(F.col("bridges")).alias("entries"), let(first_zones(F.col("bridges")), lambda a: F.transform(a, zone)).alias("zones"), "replacement")


def fixtures_document(elements: DataFrame, replacements: DataFrame, source: str) -> DataFrame:
    """The cases as JSON; null fields are kept, as other implementations compare them."""
    c = parser_fixtures(elements, replacements)
    cases = _listed(c, ["tag"], F.struct(*c.columns))
    return c.agg(F.to_json(F.struct(F.lit(source).alias("source"), cases.alias("cases")), {"pretty": "true", "ignoreNullFields": "false"}).alias("json"))


def segment_links_document(links: DataFrame, source: str, coverage: str) -> DataFrame:
    """Of ``lookup.segment_links``."""
    record = F.struct("tag", F.struct("name", "type", F.col("max_length").alias("maxLength")).alias("edifact"), F.col("repr_raw").alias("reprRaw"), "aligned")
    return document(links, ["tag"], record, "links", {"joined": F.count("*"), "aligned": F.count_if("aligned")}, source=source, coverage=coverage)


def coverage_document(links: DataFrame, source: str, coverage: str) -> DataFrame:
    """Of ``lookup.code_coverage``."""
    return document(links, ["tag"], F.struct("tag", "code_values"), "links", {"elements": F.count("*"), "code_values": F.coalesce(F.sum("code_values"), F.lit(0))}, source=source, coverage=coverage)


def references_document(links: DataFrame, unknown: DataFrame, source: str, vintage: str, coverage: str) -> DataFrame:
    """Of ``lookup.nested_references`` and ``lookup.unknown_tags``."""
    kind = lambda k: F.coalesce(F.sum(F.size(F.filter("refs", lambda r: r.kind == k))), F.lit(0))
    found = links.agg(F.count("*").alias("elements"), F.coalesce(F.sum(F.size("refs")), F.lit(0)).alias("refs"), kind("equals").alias("equals"), kind("related").alias("related"), _listed(links, ["tag"], F.struct("tag", "refs")).alias("links"))
    lost = unknown.agg(F.array_sort(F.collect_set("tag")).alias("unknown_tags"))
    one = found.crossJoin(lost)  # one row each
    heads = [F.lit(v).alias(k) for k, v in (("source", source), ("vintage", vintage), ("coverage", coverage))]
    return one.select(F.to_json(F.struct(*heads, "elements", "refs", "equals", "related", "unknown_tags", "links"), {"pretty": "true"}).alias("json"))


#: How many differences of each kind, and tags that the mirror alone has, the console shows.
SHOWN = {"repr": 15, "desc": 8}
SHOWN_TAGS = 20


def crosscheck_lines(differences: DataFrame, shown: dict[str, int] | None = None) -> DataFrame:
    """part, ord, line: the differences of each kind by tag, under a heading; all of them or the first ``shown``.

    All of them are numbered over ranges of (kind, tag), so that a kind may have any number.
    """
    from ..operators import scan

    two = F.concat(F.col("tag"), F.lit(":\n    ours: "), F.coalesce("ours", F.lit("")), F.lit("\n    other: "), F.coalesce("other", F.lit("")))
    one = F.format_string("%d: ours %s, other %s", "tag", F.coalesce("ours", F.lit("")), F.coalesce("other", F.lit("")))
    d = differences.select("kind", "tag", F.when(F.col("kind") == "repr", one).otherwise(two).alias("line"))
    d = scan.running(scan.ordered(d, ["kind"], ["tag", "line"]), ["kind"], F.lit(1), "n")
    if shown:
        d = d.where(F.coalesce(*[F.when(F.col("kind") == k, F.col("n") <= n) for k, n in shown.items()], F.lit(True)))
    return d.select(F.when(F.col("kind") == "repr", 3).otherwise(5).alias("part"), F.col("n").alias("ord"), "line")


def crosscheck_report(counters: DataFrame, differences: DataFrame, alone: DataFrame, title: list[str], console: bool = False) -> DataFrame:
    """part, ord, line: title, counters, differences and the tags that the mirror alone has (``alone``: tag), to be put in order by (part, ord).

    The file has all differences and tags, the console the first ones.
    """
    spark = counters.sparkSession
    fixed = lambda part, text: spark.createDataFrame([(part, 0, text)], "part int, ord long, line string")
    heads = spark.createDataFrame([(0, i, x) for i, x in enumerate(title)], "part int, ord long, line string")
    sums = counters.select(F.lit(1).alias("part"), F.lit(0).cast("long").alias("ord"), F.to_json(F.struct(*counters.columns)).alias("line"))
    tags = alone.orderBy("tag").limit(SHOWN_TAGS) if console else alone
    tags = tags.select(F.lit(7).alias("part"), F.col("tag").cast("long").alias("ord"), F.col("tag").cast("string").alias("line"))
    parts = [sums, fixed(2, "\nREPR DIFFS:"), crosscheck_lines(differences, SHOWN if console else None), fixed(4, "\nDESC DIFFS:"), fixed(6, "\nONLY IN THE MIRROR:"), tags]
    for p in parts:
        heads = heads.unionByName(p)
    return heads
