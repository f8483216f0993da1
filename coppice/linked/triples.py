"""Triples of node tables: a walk over the struct type builds one expression, so that a row is expanded in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S

RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
_STATEMENT = "array<struct<s:string,p:string,o:string,kind:string>>"


def names(namespace: str) -> dict[str, str]:
    """The full IRI of each term, each class and the two kinds of vocabulary nodes."""
    prefixes = {"utd": namespace, **dict(S.PREFIXES)}
    full = lambda x: prefixes[x.partition(":")[0]] + x.partition(":")[2]
    found = {t: full(i) for t, _, i, _, _ in S.TERMS}
    return found | {k: full(k) for k in ("rdfs:Class", "rdf:Property")}


def _one(s: Column, p: str, o: Column, kind: str) -> Column:
    return F.when(o.isNotNull(), F.array(F.struct(s.alias("s"), F.lit(p).alias("p"), o.cast("string").alias("o"), F.lit(kind).alias("kind"))))


def _all(parts: list[Column]) -> Column:
    return F.flatten(F.array(*[F.coalesce(x, F.array().cast(_STATEMENT)) for x in parts]))


def _values(v: Column, kind: T.DataType, p: str, s: Column, base: Column, iris: dict[str, str]) -> Column:
    if isinstance(kind, T.ArrayType):
        return F.flatten(F.transform(v, lambda x, i: F.coalesce(_values(x, kind.elementType, p, s, F.concat(base, F.lit("_"), i.cast("string")), iris), F.array().cast(_STATEMENT))))
    if not isinstance(kind, T.StructType):
        return _one(s, p, v, "integer" if isinstance(kind, T.IntegralType) else "string")
    if kind.fieldNames() == ["@id"]:
        return _one(s, p, v["@id"], "iri")
    own = v["@id"] if "@id" in kind.fieldNames() else F.concat(F.lit("_:"), base)
    return F.when(v.isNotNull(), _all([_one(s, p, own, "iri" if "@id" in kind.fieldNames() else "blank"), _statements(v, kind, own, base, iris)]))


def _statements(node: Column, kind: T.StructType, s: Column, base: Column, iris: dict[str, str]) -> Column:
    types = F.create_map(*[x for k, i in iris.items() for x in (F.lit(k), F.lit(i))])
    parts = []
    for f in kind.fields:
        if f.name == "@type":
            parts.append(_one(s, f"{RDF}type", F.try_element_at(types, node["@type"]), "iri"))
        elif f.name in iris:
            parts.append(_values(node[f.name], f.dataType, iris[f.name], s, F.concat(base, F.lit(f"_{f.name}")), iris))
    return _all(parts)


def node_triples(nodes: DataFrame, iris: dict[str, str]) -> DataFrame:
    """s, p, o, kind (iri, blank, string, integer) of the column ``node``; repeated statements of a node count once.

    Nested nodes without an id get one from their node's and their place in it, so that runs agree. Fields that the
    context does not declare make no statement, as JSON-LD has it.
    """
    n = F.col("node")
    base = F.concat(F.lit("n"), F.lower(F.hex(F.xxhash64(n["@id"]))))
    each = F.array_distinct(_statements(n, nodes.schema["node"].dataType, n["@id"], base, iris))
    return nodes.select(F.explode(each).alias("x")).select("x.*")


def triples(rows: DataFrame, subject: Column, values: dict[str, Column]) -> DataFrame:
    """s, p, o of the values that are not null, for tables that are no nodes."""
    each = F.array_compact(F.array(*[F.when(v.isNotNull(), F.struct(F.lit(p).alias("p"), v.cast("string").alias("o"))) for p, v in values.items()]))
    return rows.select(subject.alias("s"), F.explode(each).alias("x")).select("s", "x.p", "x.o")


def node_triples_of(rows: DataFrame, subject: Column, values: dict[str, tuple[Column, str]]) -> DataFrame:
    """s, p, o, kind of the values that are not null, each with its kind, for tables that are no nodes."""
    each = F.array_compact(F.array(*[F.when(v.isNotNull(), F.struct(F.lit(p).alias("p"), v.cast("string").alias("o"), F.lit(k).alias("kind"))) for p, (v, k) in values.items()]))
    return rows.select(subject.alias("s"), F.explode(each).alias("x")).select("s", "x.*")


def unresolved(statements: DataFrame, predicates: list[str]) -> DataFrame:
    """Objects of the predicates that are no subject: empty in a closed graph."""
    return statements.where(F.col("p").isin(predicates)).select(F.col("o").alias("missing")).distinct().join(statements.select(F.col("s").alias("missing")), "missing", "left_anti")


def used_terms(statements: DataFrame) -> DataFrame:
    """iri: every predicate, and every object of a type statement."""
    both = F.array(F.col("p"), F.when(F.col("p") == f"{RDF}type", F.col("o")))
    return statements.select(F.explode(F.array_compact(both)).alias("iri")).distinct()


def vocabulary_gaps(statements: DataFrame, namespace: str, declared: list[str] | None = None) -> DataFrame:
    """iri, gap: terms used but not declared, and terms of the namespace declared but not used. Empty for a closed vocabulary.

    ``declared`` are the terms of the namespace, by default those of the directory; the public prefixes may be used freely.
    """
    own = declared if declared is not None else [i[4:] for _, _, i, _, _ in S.TERMS if i.startswith("utd:")]
    spark = statements.sparkSession
    d = spark.createDataFrame([(namespace + t,) for t in own], "iri string").distinct()
    used = used_terms(statements)
    public = F.lit(False)
    for _, prefix in S.PREFIXES:
        public = public | F.col("iri").startswith(prefix)
    undeclared = used.where(~public).join(d, "iri", "left_anti").withColumn("gap", F.lit("undeclared"))
    return undeclared.unionByName(d.join(used, "iri", "left_anti").withColumn("gap", F.lit("unused")))
