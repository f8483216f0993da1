"""Linked-data nodes of a directory as typed structs; ``to_json`` leaves their null parts out."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.notation import bridges, first_zones
from ..functions.text import capitalised, compact, let
from ..schemas import CATEGORIES

DATASET_PATH = "dataset/directory"


def iri(origin: str, kind: str, key: Column) -> Column:
    return F.concat(F.lit(f"{origin.rstrip('/')}/{kind}/"), key.cast("string"))


def _link(target: Column) -> Column:
    """An object that is another node; null where the target is."""
    return F.when(target.isNotNull(), F.struct(target.alias("@id")))


def _typed(name: str, *fields: Column) -> Column:
    return F.struct(F.lit(name).alias("@type"), *fields)


def _category_iri(origin: str, k: Column) -> Column:
    ranges = F.create_map(*[x for n, _, r, _ in CATEGORIES for x in (F.lit(n), F.lit(r))])
    return iri(origin, "categories", F.try_element_at(ranges, k))


def bridge_nodes(text: Column) -> Column:
    """A node per entry of a bridges text; each UNLK entry carries the zones of the first one. Null without entries."""
    zone = lambda z: _typed("UnlkZone", z.line_from.alias("lineFrom"), z.line_to.alias("lineTo"), z.pos_from.alias("posFrom"), z.pos_to.alias("posTo"), z["format"].alias("fieldFormat"))
    node = lambda zones: lambda b: _typed("Bridge", b.scheme.alias("scheme"), b.detail.alias("detail"), F.when((b.scheme == "UNLK") & (F.size(zones) > 0), zones).alias("zone"))
    own = let(F.transform(first_zones(text), zone), lambda zones: F.transform(bridges(text), node(zones)))
    return F.when(text.isNotNull(), let(own, lambda a: F.when(F.size(a) > 0, a)))


def element_nodes(elements: DataFrame, replacements: DataFrame, origin: str, dataset: str = DATASET_PATH) -> DataFrame:
    """tag, node. ``replacements`` has key and replacement."""
    e = elements.join(replacements.select(F.col("key").alias("tag"), "replacement"), "tag", "left")
    r = F.col("representation")
    shape = F.when(r.isNotNull(), _typed("Representation", r.raw.alias("printedForm"), r.charset.alias("charset"), r.min_length.alias("minLength"), r.max_length.alias("maxLength")))
    node = F.struct(
        iri(origin, "elements", F.col("tag")).alias("@id"), F.lit("TradeDataElement").alias("@type"), "tag", _link(F.lit(f"{origin.rstrip('/')}/{dataset}")).alias("isPartOf"),
        _link(_category_iri(origin, F.floor(F.col("tag") / 1000).cast("int"))).alias("category"), F.col("change_tag").alias("changeTag"), "status", F.col("provenance.page").alias("sourcePage"), "name", "description",
        shape.alias("representation"), compact(F.col("old_name"), F.col("business_term")).alias("altLabel"), _link(iri(origin, "elements", F.col("replacement"))).alias("replacedBy"), "bridges", bridge_nodes(F.col("bridges")).alias("bridge"),
    )
    return e.select("tag", node.alias("node"))


def dataset_node(elements: DataFrame, origin: str, title: str, description: str, source: str, downloads: list[tuple[str, str]], dataset: str = DATASET_PATH) -> DataFrame:
    """node: one row. ``downloads`` are paths and formats."""
    at = origin.rstrip("/")
    files = F.array(*[_typed("DataDownload", F.lit(f"{at}/{p}").alias("contentUrl"), F.lit(f).alias("encodingFormat")) for p, f in downloads])
    node = F.struct(F.lit(f"{at}/{dataset}").alias("@id"), F.lit("Dataset").alias("@type"), F.lit(title).alias("name"), F.lit(description).alias("description"), F.lit(source).alias("source"), F.count("*").alias("elementCount"), files.alias("distribution"))
    return elements.agg(node.alias("node"))


def scheme_iri(origin: str, scheme: str = "ns/directory#CategoryScheme") -> str:
    return f"{origin.rstrip('/')}/{scheme}"


def scheme_node(spark: SparkSession, origin: str, label: str, comment: str) -> DataFrame:
    return spark.range(1).select(F.struct(F.lit(scheme_iri(origin)).alias("@id"), F.lit("CategoryScheme").alias("@type"), F.lit(label).alias("label"), F.lit(comment).alias("comment")).alias("node"))


def category_nodes(elements: DataFrame, categories: DataFrame, origin: str, dataset: str = DATASET_PATH) -> DataFrame:
    """k, node of all categories, also those without elements."""
    n = elements.groupBy(F.floor(F.col("tag") / 1000).cast("int").alias("k")).agg(F.count("*").alias("n"))
    c = categories.join(n, "k", "left")
    node = F.struct(
        iri(origin, "categories", F.col("range")).alias("@id"), F.lit("Category").alias("@type"), capitalised(F.col("label")).alias("label"), F.col("range").alias("tagRange"), F.col("k").alias("position"),
        _link(F.lit(scheme_iri(origin))).alias("inScheme"), _link(F.lit(f"{origin.rstrip('/')}/{dataset}")).alias("isPartOf"), F.coalesce("n", F.lit(0)).alias("elementCount"),
    )
    return c.select("k", node.alias("node"))


def graph(*nodes: DataFrame) -> DataFrame:
    """json: one line per node of all node tables, which keep their own types up to here."""
    return reduce(DataFrame.unionByName, [n.select(F.to_json("node").alias("json")) for n in nodes])


def graph_document(context: DataFrame, *nodes: DataFrame) -> DataFrame:
    """One row: the whole graph as one JSON document, for directories that fit a string; larger ones go to ``graph``.

    ``context`` is one row of one JSON text. The node tables keep their order; within one, nodes go by ``@id``.
    """
    rows = reduce(DataFrame.unionByName, [n.select(F.lit(i).alias("i"), F.col("node.@id").alias("id"), F.to_json("node").alias("json")) for i, n in enumerate(nodes)])
    body = rows.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "id", "json"))), lambda x: x.json), ",\n").alias("body"))
    one = context.select(F.col(context.columns[0]).alias("context")).crossJoin(body)  # one row each
    return one.select(F.concat(F.lit('{"@context":'), "context", F.lit(',\n"@graph":[\n'), "body", F.lit("\n]}\n")).alias("json"))
