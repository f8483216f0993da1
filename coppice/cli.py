"""The pipeline on a console: ``python -m coppice.cli validate|verify|extract|export|links|coverage|references|crosscheck ...``.

Exit code 1 if an error or a failed check is found.
"""

from __future__ import annotations

import argparse
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .checks import crosscheck as Y
from .checks import validate as V
from .checks import verify as W
from .operators import lookup as J
from .schemas import categories
from .sinks import documents as D
from .sinks import writers as K
from .sources import mirrors as M
from .sources.paths import exists, resolve
from .sources.yaml_source import elements, review_queue


def validation_report(errors: DataFrame, summary: DataFrame) -> tuple[list[str], bool]:
    """The lines to print, and whether all is well."""
    row = summary.first().asDict()
    bad = [f"  {r.key}: {r.rule}" if r.key is not None else f"  {r.rule}" for r in errors.orderBy("key", "rule").toLocalIterator()]
    return [f"{k}: {v}" for k, v in row.items()] + (["FAILED:", *bad] if bad else ["OK"]), not bad


def verification_report(checks: DataFrame) -> tuple[list[str], bool]:
    rows = checks.collect()  # one row a check
    failed = [r.check for r in rows if r.status == "fail"]
    lines = [f"{r.check:<24} {r.status.upper():<5} {r.detail}" for r in rows]
    return [*lines, f"VERIFY FAILED: {', '.join(failed)}" if failed else "VERIFY OK"], not failed


def extraction_report(statistics: DataFrame) -> list[str]:
    r = statistics.first()
    return [f"rows: {r.rows}", f"elements: {r.elements}", "change tags: " + " ".join(f"{k}={v}" for k, v in sorted(r.change_tags.items())), f"review queue entries: {r.reviews}"]


def replacements(e: DataFrame) -> DataFrame:
    return J.first_valid_reference(e.where("status = 'retired' AND notes IS NOT NULL"), "tag", "notes", e, "tag")


def _put(one: DataFrame, path: str, folder: str) -> None:
    K.write_files(one.select(F.lit(path).alias("path"), F.col(one.columns[0]).alias("text")), folder)


def graph_nodes(e: DataFrame, namespace: str, origin: str, title: str, source: str) -> list[DataFrame]:
    """All node tables of a directory, in the order of the graph."""
    from .linked import nodes as N
    from .linked import vocabulary as L

    spark = e.sparkSession
    files = [("data/graph.jsonld", "application/ld+json"), ("data/graph-00000.ttl", "text/turtle"), ("data/elements.json", "application/json")]
    return [
        L.ontology_nodes(spark, namespace), N.dataset_node(e, origin, title, source, source, files), N.scheme_node(spark, origin, "Category scheme", "The nine ordered tag ranges."),
        N.category_nodes(e, categories(spark), origin), N.element_nodes(e, replacements(e), origin),
    ]


def export(e: DataFrame, folder: str, namespace: str, source: str, pages: str, origin: str = "https://example.org") -> None:
    """The flat table, the JSON documents, the context, the graph as JSON-LD and Turtle, and two files per element."""
    from .linked import triples as T
    from .linked import vocabulary as L
    from .linked.nodes import graph_document

    spark = e.sparkSession
    K.write_csv(e, f"{folder}/elements.csv")
    parts = {
        "elements.json": D.elements_document(e, source, pages), "categories.json": D.categories_document(spark), "vocabulary.json": L.vocabulary_document(spark, namespace),
        "parser-fixtures.json": D.fixtures_document(e, replacements(e), source), "context.jsonld": L.context_document(spark, namespace), "context.yamlld": L.context_text(spark, namespace, ["Generated. Do not edit."]),
    }
    nodes, context = graph_nodes(e, namespace, origin, "Directory", source), L.context_document(spark, namespace)
    parts["graph.jsonld"] = graph_document(context, *nodes)
    for path, one in parts.items():
        _put(one, path, folder)
    iris = T.names(namespace)
    K.write_files(K.turtle_files(reduce(DataFrame.unionByName, [T.node_triples(n, iris) for n in nodes]), namespace), folder)
    K.write_files(K.element_files(nodes[-1], T.node_triples(nodes[-1], iris), context, namespace), f"{folder}/elements")


def joins(command: str, e: DataFrame, mirror: str, source: str) -> DataFrame:
    """One row of one text: the document of a join with an external directory."""
    spark = e.sparkSession
    if command == "links":
        return D.segment_links_document(J.segment_links(e, M.segments_mirror(spark, mirror)), source, "active elements that the mirror has, first occurrence per tag")
    if command == "coverage":
        return D.coverage_document(J.code_coverage(e, M.code_counts(spark, mirror)), source, "active elements with code values")
    if command == "references":
        refs = J.references(M.code_entries(spark, mirror))
        return D.references_document(J.nested_references(refs, e), J.unknown_tags(refs, e), source, "", "bracketed numbers are equal, numbers in parentheses related")
    m = M.segments_mirror(spark, mirror)
    lines = D.crosscheck_report(Y.counters(e, m), Y.differences(e, m), Y.only_mirror(e, m), [source])
    return lines.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "ord", "line"))), lambda x: x.line), "\n").alias("text"))


def crosscheck_console(e: DataFrame, mirror: str, source: str) -> list[str]:
    """The counters, the first differences and the first tags that the mirror alone has."""
    m = M.segments_mirror(e.sparkSession, mirror)
    shown = D.crosscheck_report(Y.counters(e, m), Y.differences(e, m), Y.only_mirror(e, m), [source], console=True)
    return [r.line for r in shown.orderBy("part", "ord").collect()]


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> int:
    p = argparse.ArgumentParser(prog="coppice")
    p.add_argument("command", choices=["validate", "verify", "extract", "export", "links", "coverage", "references", "crosscheck"])
    p.add_argument("--data")
    p.add_argument("--words")
    p.add_argument("--out", default="out")
    p.add_argument("--mirror")
    p.add_argument("--first-page", type=int, default=1)
    p.add_argument("--namespace", default="https://example.org/ns/directory#")
    p.add_argument("--source", default="")
    p.add_argument("--pages", default="")
    a = p.parse_args(arguments)
    spark = spark or SparkSession.builder.getOrCreate()
    if a.command == "extract":
        from .operators.extraction import extract, statistics

        x = extract(M.words(spark, resolve(a.words, "COPPICE_WORDS", "words.xhtml"), a.first_page)).persist()
        K.write_files(K.yaml_files(x.elements.drop("row_id")).unionByName(K.review_file(x.reviews)), a.out)
        print("\n".join(extraction_report(statistics(x))))
        x.unpersist()
        return 0
    data = resolve(a.data, "COPPICE_DATA", "data")
    e = elements(spark, f"{data}/elements")
    if a.command == "export":
        export(e, a.out, a.namespace, a.source, a.pages)
        return 0
    if a.command in ("links", "coverage", "references", "crosscheck"):
        mirror = resolve(a.mirror, "COPPICE_MIRROR", "mirror")
        one = joins(a.command, e, mirror, a.source)
        if a.command == "crosscheck":
            print("\n".join(crosscheck_console(e, mirror, a.source)))
        _put(one, f"{a.command}.{'txt' if a.command == 'crosscheck' else 'json'}", a.out)
        return 0
    queue = f"{data}/review-queue.yaml"
    if a.command == "validate":
        lines, well = validation_report(V.validate(e, review_queue(spark, queue) if exists(queue) else None), V.summary(e, review_queue(spark, queue)))
    else:
        checks = W.verify_source(e, M.words(spark, a.words, a.first_page), J.files(spark, data).where("path = 'review-queue.yaml' OR path LIKE 'elements/%'")) if a.words else W.verify(e)
        lines, well = verification_report(checks)
    print("\n".join(lines))
    return 0 if well else 1


if __name__ == "__main__":
    raise SystemExit(main())
