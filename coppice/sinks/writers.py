"""Tables and lines for the exports: flat CSV, JSON lines, YAML files by key range, N-Triples and Turtle."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.text import header
from .yaml_text import yaml_item

#: The columns of the flat export.
CSV_COLUMNS = ["tag", "change_tag", "status", "name", "description", "repr_raw", "repr_charset", "repr_min_length", "repr_max_length", "old_name", "business_term", "notes", "bridges", "page"]
_NESTED = {"repr_raw": "representation.raw", "repr_charset": "representation.charset", "repr_min_length": "representation.min_length", "repr_max_length": "representation.max_length", "page": "provenance.page"}


def flat(rows: DataFrame, columns: list[str] = CSV_COLUMNS, nested: dict[str, str] = _NESTED) -> DataFrame:
    """The given columns in order; ``nested`` says which lie in a struct."""
    return rows.select(*[F.col(nested.get(c, c)).alias(c) for c in columns])


def write_csv(elements: DataFrame, path: str) -> None:
    """In tag order over the part files; each has the header."""
    flat(elements).repartitionByRange("tag").sortWithinPartitions("tag").write.mode("overwrite").option("header", True).option("nullValue", "").option("emptyValue", "").option("escape", '"').csv(path)


def write_json_lines(rows: DataFrame, order: str, path: str) -> None:
    rows.repartitionByRange(order).sortWithinPartitions(order).write.mode("overwrite").json(path)


def _yaml_items(rows: DataFrame, record: Column) -> DataFrame:
    """``rows`` with ``item``: the record as an item of a YAML list, null fields left out."""

    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items = pa.array([yaml_item(x) for x in batch.column("__record").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), items], [*names, "item"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.withColumn("__record", record).mapInArrow(run, f"{kinds}, item string")


def _listed_items(rows: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """The items of each group, in order, as one text."""
    each = F.transform(F.array_sort(F.collect_list(F.struct(*order, "item"))), lambda x: x["item"])
    return rows.groupBy(*by).agg(F.array_join(each, "").alias("items"))


def yaml_files(elements: DataFrame, width: int = 1000, reach: int = 699) -> DataFrame:
    """path, text: a YAML document per key range, its category's heading first, elements by tag. A range holds at most ``width`` tags."""
    fields = [c for c in elements.columns if c not in ("file", "file_no", "category", "ord")]
    rows = elements.select(F.floor(F.col("tag") / width).cast("int").alias("k"), "tag", F.struct(*[F.col(c).alias(c) for c in fields]).alias("r"))
    rows = _listed_items(_yaml_items(rows, F.col("r")).drop("r"), ["k"], ["tag"])
    base = F.col("k") * width
    heading = F.coalesce(*[F.when(F.col("k") == k, header(F.lit(s), F.lit(r), F.lit(label))) for k, s, r, label in S.CATEGORIES], F.concat(base, F.lit(" uncategorized")))
    heading = F.when(F.contains(heading, F.lit(": ")), F.concat(F.lit("'"), F.replace(heading, F.lit("'"), F.lit("''")), F.lit("'"))).otherwise(heading)
    return rows.select(F.concat(F.lit("elements/"), base, F.lit("-"), base + reach, F.lit(".yaml")).alias("path"), F.concat(F.lit("---\ncategory: "), heading, F.lit("\nelements:\n"), "items").alias("text"))


def review_file(queue: DataFrame) -> DataFrame:
    """path, text: one row, the review queue by page, tag (missing ones first) and field."""
    q = queue.select(F.lit(0).alias("k"), "page", F.coalesce("tag", F.lit(0)).alias("t"), "field", F.struct("page", "tag", "field", "raw_fragments", "issue", "confidence").alias("r"))
    rows = _listed_items(_yaml_items(q, F.col("r")).drop("r"), ["k"], ["page", "t", "field"])
    some = rows.select(F.concat(F.lit("---\nentries:\n"), "items").alias("text"))
    return some.agg(F.coalesce(F.max("text"), F.lit("---\nentries: []\n")).alias("text")).select(F.lit("review-queue.yaml").alias("path"), "text")


def stored_form(files: DataFrame) -> DataFrame:
    """path, content: files to be written, as ``lookup.files`` reads written ones."""
    return files.select("path", F.col("text").cast("binary").alias("content"))


def _quoted(o: Column) -> Column:
    for plain, escaped in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        o = F.replace(o, F.lit(plain), F.lit(escaped))
    return F.concat(F.lit('"'), o, F.lit('"'))


def _object(prefixed) -> Column:
    """An object as it is written: IRIs through ``prefixed``, blank nodes and numbers bare in Turtle."""
    o, kind = F.col("o"), F.col("kind")
    return F.when(kind == "iri", prefixed(o)).when(kind == "blank", o).when(kind == "integer", F.concat(F.lit('"'), o, F.lit('"^^<http://www.w3.org/2001/XMLSchema#integer>'))).otherwise(_quoted(o))


def _angled(c: Column) -> Column:
    return F.concat(F.lit("<"), c, F.lit(">"))


def n_triples(statements: DataFrame) -> DataFrame:
    """value: one statement (s, p, o, kind) per line."""
    subject = F.when(F.col("s").startswith("_:"), F.col("s")).otherwise(_angled(F.col("s")))
    return statements.select(F.concat_ws(" ", subject, _angled(F.col("p")), _object(_angled), F.lit(".")).alias("value"))


def turtle_header(namespace: str) -> str:
    return "".join(f"@prefix {p}: <{i}> .\n" for p, i in [("utd", namespace), *S.PREFIXES]) + "\n"


def turtle(statements: DataFrame, namespace: str) -> DataFrame:
    """subject, text: one block per subject, type first, predicates and objects in order; IRIs of known prefixes are shortened."""

    def short(c: Column) -> Column:
        out = _angled(c)
        for p, i in [("utd", namespace), *S.PREFIXES]:
            local = F.substring(c, len(i) + 1, 1 << 20)
            out = F.when(c.startswith(i) & local.rlike("^[A-Za-z][A-Za-z0-9]*$"), F.concat(F.lit(f"{p}:"), local)).otherwise(out)
        return out

    is_type = F.col("p") == "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
    number = F.when(F.col("kind") == "integer", F.col("o")).otherwise(_object(short))
    line = F.concat(F.when(is_type, "a").otherwise(short(F.col("p"))), F.lit(" "), number)
    each = statements.select("s", (~is_type).cast("int").alias("rank"), line.alias("line"))
    block = F.array_join(F.transform(F.array_sort(F.collect_set(F.struct("rank", "line"))), lambda x: x.line), " ;\n  ")
    subject = F.when(F.col("s").startswith("_:"), F.col("s")).otherwise(short(F.col("s")))
    return each.groupBy("s").agg(block.alias("block")).select(F.col("s").alias("subject"), F.concat(subject, F.lit(" "), "block", F.lit(" .\n")).alias("text"))


def turtle_files(statements: DataFrame, namespace: str, parts: int = 1) -> DataFrame:
    """path, text: the whole graph as Turtle, in ``parts`` files by subject, each with its prefixes; take so many that a file fits a row."""
    blocks = turtle(statements, namespace).withColumn("part", F.pmod(F.xxhash64("subject"), F.lit(parts)).cast("int"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("subject", "text"))), lambda x: x.text), "\n")
    return blocks.groupBy("part").agg(body.alias("body")).select(F.format_string("graph-%05d.ttl", "part").alias("path"), F.concat(F.lit(turtle_header(namespace)), "body").alias("text"))


def element_files(nodes: DataFrame, statements: DataFrame, context: DataFrame, namespace: str) -> DataFrame:
    """path, text: a JSON-LD and a Turtle file for each row (tag, node) of ``nodes``.

    The Turtle file holds the statements about the node itself; those about nested nodes are in the whole graph only.
    ``context`` is one row of one JSON text.
    """
    one = context.select(F.col(context.columns[0]).alias("context"))
    linked = nodes.select("tag", F.to_json("node").alias("j")).crossJoin(F.broadcast(one))  # one row on the right
    linked = linked.select(F.concat("tag", F.lit(".jsonld")).alias("path"), F.concat(F.lit('{"@context":'), "context", F.lit(","), F.substring("j", 2, 1 << 30)).alias("text"))
    own = turtle(statements.where(~F.col("s").startswith("_:")), namespace)
    own = own.join(nodes.select("tag", F.col("node.@id").alias("subject")), "subject").select(F.concat("tag", F.lit(".ttl")).alias("path"), F.concat(F.lit(turtle_header(namespace)), "text").alias("text"))
    return linked.unionByName(own)


def write_files(files: DataFrame, folder: str) -> None:
    """Writes rows (path, text) as files under ``folder`` by a sink that commits: see ``file_sink``."""
    from .file_sink import FileSink

    files.sparkSession.dataSource.register(FileSink)
    files.select("path", "text").write.format("coppice_files").option("path", folder).mode("append").save()
