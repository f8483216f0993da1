"""The vocabulary of the graph: context, class and property nodes, and documents made of the declarations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S

#: The groups whose commented terms are properties of the graph.
PROPERTY_GROUPS = ["element-level", "category-level", "dataset-level"]



def context(spark: SparkSession, namespace: str) -> DataFrame:
    """ord, term, iri: prefixes, then terms, in declaration order."""
    p = S.prefixes(spark, namespace).select("ord", F.col("prefix").alias("term"), "iri")
    n = len(S.PREFIXES) + 1
    return p.unionByName(S.terms(spark).select((F.col("ord") + n).alias("ord"), "term", "iri"))


def context_map(spark: SparkSession, namespace: str) -> DataFrame:
    """One row: context, the map from prefixes and terms to IRIs."""
    return context(spark, namespace).agg(F.map_from_entries(F.transform(F.array_sort(F.collect_list(F.struct("ord", "term", "iri"))), lambda x: F.struct(x.term, x.iri))).alias("context"))


def context_document(spark: SparkSession, namespace: str) -> DataFrame:
    """One row: the context as JSON."""
    return context_map(spark, namespace).select(F.concat(F.to_json("context", {"pretty": "true"}), F.lit("\n")).alias("json"))


def context_text(spark: SparkSession, namespace: str, title: list[str]) -> DataFrame:
    """One row: the context as YAML, ``title`` as comments, then the prefixes, then the terms under their groups in fixed order."""
    p = S.prefixes(spark, namespace).select(F.lit(0).alias("part"), "ord", F.concat(F.lit("  "), "prefix", F.lit(": "), "iri").alias("line"))
    order = F.array_position(F.array(*map(F.lit, S.GROUPS)), F.col("group")).cast("int")
    t = S.terms(spark).select(order.alias("part"), "ord", F.concat(F.lit("  "), "term", F.lit(": "), "iri").alias("line"))
    heads = S.terms(spark).groupBy("group").agg(F.lit(-1).alias("ord")).select(order.alias("part"), "ord", F.concat(F.lit("\n  # "), "group").alias("line"))
    lines = p.unionByName(t).unionByName(heads).agg(F.array_sort(F.collect_list(F.struct("part", "ord", "line"))).alias("x"))
    body = F.array_join(F.transform("x", lambda r: r.line), "\n")
    return lines.select(F.concat(F.lit("".join(f"# {x}\n" for x in title) + '"@context":\n'), body, F.lit("\n")).alias("text"))


def vocabulary_document(spark: SparkSession, namespace: str) -> DataFrame:
    """One row: namespace, prefixes, classes and terms but the classes, as JSON; what a term lacks is left out."""
    p = S.prefixes(spark, namespace).agg(F.map_from_entries(F.transform(F.array_sort(F.collect_list(F.struct("ord", "prefix", "iri"))), lambda x: F.struct(x.prefix, x.iri))).alias("prefixes"))
    c = S.classes(spark).agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "term", "comment"))), lambda x: F.struct(x.term.alias("term"), x.comment.alias("comment"))).alias("classes"))
    fields = ["term", "iri", "group", "domain", "comment"]
    t = S.terms(spark).where("group <> 'classes'").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", *fields))), lambda x: F.struct(*[x[f].alias(f) for f in fields])).alias("terms"))
    one = p.crossJoin(c).crossJoin(t)  # one row each
    return one.select(F.to_json(F.struct(F.lit(namespace).alias("namespace"), "prefixes", "classes", "terms"), {"pretty": "true"}).alias("json"))


def ontology_nodes(spark: SparkSession, namespace: str) -> DataFrame:
    """ord, node: the classes, then the terms of the property groups that have a comment, in declaration order. A domain that is no class is left out."""
    ns = F.lit(namespace)
    none = F.lit(None).cast("struct<`@id`:string>")
    c = S.classes(spark).select("ord", F.struct(F.concat(ns, "term").alias("@id"), F.lit("rdfs:Class").alias("@type"), "comment", none.alias("domain")).alias("node"))
    named = F.col("domain").isin([x for x, _ in S.CLASSES])
    domain = F.when(named, F.struct(F.concat(ns, "domain").alias("@id")))
    p = S.terms(spark).where(F.col("comment").isNotNull() & F.col("group").isin(PROPERTY_GROUPS))
    p = p.select((F.col("ord") + len(S.CLASSES)).alias("ord"), F.struct(F.concat(ns, "term").alias("@id"), F.lit("rdf:Property").alias("@type"), "comment", domain.alias("domain")).alias("node"))
    return c.unionByName(p)
