"""Sources, extraction, checks, nodes and sinks on small hand-checked inputs, and on a published directory where one is given.

The published directory is a folder with ``elements/*.yaml`` and ``review-queue.yaml`` named by COPPICE_DATA.
"""

import csv
import json
import os
from functools import reduce

import pytest
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from coppice import cli
from coppice import schemas as S
from coppice.checks import crosscheck as Y
from coppice.checks import validate as V
from coppice.checks import verify as W
from coppice.functions.fragments import asked_words, joined
from coppice.functions.notation import bridges, first_zones, segments, zones
from coppice.linked import nodes as L
from coppice.linked import triples as T
from coppice.linked import vocabulary as O
from coppice.operators import extraction as E
from coppice.operators import lookup as J
from coppice.operators import ordered as R
from coppice.sinks import documents as D
from coppice.sinks import writers as K
from coppice.sources import mirrors as M
from coppice.sources.paths import resolve
from coppice.sources.yaml_source import context_terms, elements, review_queue

NS, ORIGIN = "https://example.org/ns/directory#", "https://example.org"


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


# Parsers: boundaries of tokens.


@pytest.mark.parametrize(
    ("text", "want"),
    [("L 04a", [("text", "L 04a")]), ("P 3 -\n5", [("positions", (3, 5))]), ("an..3x L 2", [("text", "an..3x"), ("lines", (2, None))]), ("L 45 - 61", [("lines", (45, 61))]), ("xL 4, n..11", [("text", "xL 4,"), ("format", "n..11")])],
)
def test_segment_boundaries(spark, text, want):
    got = one(spark, segments(F.lit(text)))
    assert [(x.kind, x.text if x.kind in ("text", "format") else (x["from"], x["to"])) for x in got] == want


def test_zones_need_whole_tokens(spark):
    assert one(spark, zones(F.lit("L 04a, P 3-5"))) == []
    assert [tuple(z) for z in one(spark, zones(F.lit("L 2, P 3 -\n5")))] == [(2, 2, 3, 5, None)]


# Sources.

WORDS = """<html xmlns="http://www.w3.org/1999/xhtml"><body><doc>
<page width="842"><!-- <word xMin="1" yMin="99">no</word> --><word xMin="70" yMin="50.0">head</word><word xMin="30" yMin="90">foot</word>
<word xMin='68.8' yMin="100.0">cn</word><word xMin="108.6" yMin="100.5">1001</word><word xMin="131.3" yMin="100">Docu</word><word xMin="286.6" yMin="100">First &amp; last docu</word><word xMin="523" yMin="100">an..35</word><word xMin="705" yMin="100">UNLK: L 1</word>
<word xMin="131.3" yMin="108.0">ment. Code</word><word xMin="286.6" yMin="108">ment &#233;tat&#x2E;</word></page>
<page><word xMin="131.3" yMin="90">document. End</word><word xMin="68.8" yMin="120.0">x</word><word xMin="108.6" yMin="120.0">1000</word><word xMin="131.3" yMin="120">.</word><word xMin="660" yMin="120">use 1001</word>
<word xMin="68.8" yMin="140.0">ZZ</word><word xMin="108.6" yMin="140.0">1003</word><word xMin="68.8" yMin="160.0">CR</word><word xMin="108.6" yMin="160.0">1005</word><word xMin="523" yMin="160">a-3</word></page>
<page><word xMin="286.6" yMin="90">tail.</word></page><page><word xMin="286.6" yMin="90">lost</word></page></doc></body></html>"""


@pytest.fixture(scope="module")
def words(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("words") / "words.xhtml"
    path.write_text(WORDS, encoding="utf-8")
    return M.words(spark, str(path), first_page=28).cache()


def test_words(words):
    got = [(r.page, r.text, r.x, r.y) for r in words.orderBy("page", "word_no").collect()]
    assert len(got) == 22 and {p for p, *_ in got} == {28, 29, 30, 31}
    assert (28, "cn", 68.8, 100.0) in got and (28, "First & last docu", 286.6, 100.0) in got and (28, "ment état.", 286.6, 108.0) in got
    assert "no" not in [t for _, t, *_ in got]


def test_extraction(words):
    x = E.extract(words)
    got = {r.tag: r for r in x.elements.collect()}
    # 1003 has an unknown change tag, so its row start is none and its words go on with 1000.
    assert set(got) == {1001, 1000, 1005}
    e = got[1001]
    # "document" stands whole on the last line, so the broken word is merged; the next page's lead line goes on with the row.
    assert (e.name, e.change_tag, e.status, e.provenance.page) == ("Document. Code document. End", "cn", "active", 28)
    assert e.description == "First & last document état." and tuple(e.representation) == ("an..35", "an", 1, 35) and e.bridges == "UNLK: L 1"
    assert (got[1000].name, got[1000].status, got[1000].notes) == (None, "retired", "use 1001")
    # The lead line of page 30 goes on with the last row of page 29; page 30 starts no row, so that of page 31 is dropped.
    assert got[1005].description == "tail." and got[1005].representation is None
    issues = {(r.tag, r.field, tuple(r.raw_fragments)) for r in x.reviews.collect()}
    assert issues == {(1005, "representation", ("a-3",)), (1005, "name", ()), (1005, "change_tag", ("cr",))}
    s = E.statistics(x).first()
    assert (s.rows, s.elements, s.reviews, s.change_tags, s.wrapped_cells) == (3, 3, 3, {"cn": 1, "x": 1, "cr": 1}, 2)


def test_review_rules_drop_unknown_tags(spark):
    r = spark.createDataFrame([("zz", None, None, None), ("x", None, None, None)], "change_tag string, name string, raw string, x string")
    found = r.select("change_tag", E.review_rules(r, "change_tag", "name", "raw", "raw", F.create_map().cast("map<string,array<string>>")).alias("e")).collect()
    assert [[(e.field, e.issue) for e in f.e] for f in found] == [[("name", "missing name on non-retired element"), ("change_tag", "unknown change tag")], []]


def test_verification_of_a_source(words):
    x = E.extract(words)
    checks = {r.check: r for r in W.verify_source(x.elements, words).collect()}
    assert checks["tag_order"].status == "report" and checks["tag_order"].detail == "1: 1001->1000 (p28/p29)"
    # The dropped lead line and the second column's unmatched number are found.
    assert checks["character_conservation"].status == "fail" and checks["character_conservation"].detail.split(": ")[1] == "routing"
    assert checks["uid_reconciliation"].detail == "1: 1003: 1 words, 0 elements"
    assert checks["retired_references"].detail == "1 replacement references all resolve to existing tags"
    whole = words.where("page < 31 AND NOT (y BETWEEN 140 AND 141)")
    clean = W.verify_source(E.extract(whole).elements, whole).collect()
    assert {r.check: r.status for r in clean}["character_conservation"] == "fail"  # the notation that does not parse
    fine = whole.where("NOT text IN ('a-3')")
    clean = {r.check: r for r in W.verify_source(E.extract(fine).elements, fine).collect()}
    assert clean["character_conservation"].status == "pass" and clean["uid_reconciliation"].status == "pass"


def test_reading_order_over_pages(spark):
    rows = [(1, 1, 5), (1, 2, 7), (3, 1, 6), (3, 2, 6), (3, 3, 4), (4, 1, 9)]
    got = W.reading_order(spark.createDataFrame(rows, "page int, n int, tag int")).collect()
    assert sorted((r.previous, r.tag, r.previous_page, r.page) for r in got) == [(6, 4, 3, 3), (7, 6, 1, 3)]


def test_row_bands(words):
    got = {r.tag: (r.y0, r.y1) for r in R.row_bands(words).where("page = 29").collect()}
    assert got == {1000: (119.0, 139.0), 1003: (139.0, 159.0), 1005: (159.0, 220.0)}


def test_fragments_by_join(spark):
    cells = spark.createDataFrame([(1, ["docu", "ment name"]), (2, ["do", "cu", "ment x"]), (3, ["docu", "mint name"]), (4, []), (5, None)], "id int, fragments array<string>")
    vocabulary = spark.createDataFrame([("document", 1, 0), ("docu", 0, 1)], "word string, strict long, loose long")
    got = {r.id: r.text for r in joined(cells, vocabulary, ["id"]).collect()}
    assert got == {1: "document name", 2: "do cu ment x", 3: "docu mint name", 4: None, 5: None}
    assert asked_words(["do", "cu", "ment x"]) == ["cument", "docu", "document"] and asked_words(["date/", "time"]) == ["date", "time"]


SEGMENTS = """<?xml version="1.0"?><!DOCTYPE segments><segments><segment><data_element id="1001" name='Doc "name"' desc="One &amp; two &#233;" type="an" maxlength="3"/>
<!-- <data_element id="1003" name="no"/> --><group><data_element id='1000' name="a > b" type="an" maxlength="35"></data_element></group></segment>
<segment><data_element id="1001" name="again" type="n" maxlength="9"/><data_element id="0035" name="service"/><data_element id="1005" name="bare" desc="" type="an"/></segment></segments>"""
CODES = """<data_elements><data_element id="1001"><code id="1">One</code><code id="2"/></data_element><data_element id="1000"/>
<data_element id="1001"><code>Later</code></data_element><group><data_element id="1005"><code/></data_element></group><data_element id="9999"><code/><code/></data_element></data_elements>"""
LIST = """* 1001 Title
     * starred but indented
desc: this says nothing
 1     First name
          [1000] begins
\t         more (1005) and (0999)

NOTE: skipped
any other line
          still the first [1000]
 BB    [1001] Name of a bank
          (1000)
      ABC  No description
"""


def element_rows(spark):
    rows = [
        (1000, "Doc number", "A number.", ("an..35", "an", 1, 35), "active"), (1001, "Doc name", "One two.", ("an..3", "an", 1, 3), "active"), (1002, "Gone", "x", None, "retired"),
        (1005, "Bare", None, None, "active"), (1007, "Only ours", "y.", ("n3", "n", 3, 3), "active"),
    ]
    e = spark.createDataFrame(rows, f"tag int, name string, description string, representation {S.REPRESENTATION}, status string")
    return e.selectExpr("*", "'add' AS change_tag", "cast(NULL AS string) AS old_name", "cast(NULL AS string) AS business_term", "IF(tag = 1002, 'use 1000', NULL) AS notes", "IF(tag = 1000, 'UNLK: L 1, P 0-8', NULL) AS bridges", "named_struct('page', 28) AS provenance")


def test_segments_mirror(spark, tmp_path):
    (tmp_path / "s.xml").write_text(SEGMENTS, encoding="utf-8")
    m = M.segments_mirror(spark, f"{tmp_path}/s.xml")
    got = {r.tag: tuple(r)[1:] for r in m.collect()}
    assert got == {1001: ('Doc "name"', "One & two é", "an", 3), 1000: ("a > b", None, "an", 35), 1005: ("bare", "", "an", 0)}
    e = element_rows(spark)
    links = {r.tag: (r.repr_raw, r.aligned) for r in J.segment_links(e, m).collect()}
    assert links == {1000: ("an..35", True), 1001: ("an..3", True), 1005: (None, False)}
    c = Y.counters(e, m).first()
    assert tuple(c) == (3, 2, 0, 2, 1, 1, 1, 0)
    doc = json.loads(D.segment_links_document(J.segment_links(e, m), "src", "cov").first().json)
    assert (doc["joined"], doc["aligned"], [x["tag"] for x in doc["links"]], doc["links"][1]["edifact"]["maxLength"]) == (3, 2, [1000, 1001, 1005], 3)
    report = lambda d, alone, console: [r.line for r in D.crosscheck_report(Y.counters(e, m), d, alone, ["title"], console).orderBy("part", "ord").collect()]
    lines = report(Y.differences(e, m), Y.only_mirror(e, m), False)
    assert lines[0] == "title" and json.loads(lines[1])["joined"] == 3 and lines[2] == "\nREPR DIFFS:" and lines[4].startswith("1000:\n    ours: A number.\n    other: ") and len(lines) == 6
    # The console shows the first ones of each kind, the file all.
    many = spark.range(40).selectExpr("explode(array('repr', 'desc')) AS kind", "cast(id AS int) AS tag", "'a' AS ours", "'b' AS other")
    tags = spark.range(30).selectExpr("cast(id AS int) AS tag")
    assert [len(report(many, tags, c)) for c in (False, True)] == [5 + 80 + 30, 5 + 15 + 8 + 20]
    assert report(many, tags, True)[3:5] == ["0: ours a, other b", "1: ours a, other b"]


def test_code_counts(spark, tmp_path):
    (tmp_path / "c.xml").write_text(CODES, encoding="utf-8")
    (tmp_path / "other.xml").write_text("<root><data_element id='1005'><code/></data_element></root>", encoding="utf-8")
    counts = M.code_counts(spark, f"{tmp_path}/*.xml")
    assert {r.id: r.n for r in counts.collect()} == {1001: 1, 1000: 0, 9999: 2}
    e = element_rows(spark)
    assert {r.tag: r.code_values for r in J.code_coverage(e, counts).collect()} == {1000: 0, 1001: 1}
    assert [r.id for r in J.skipped_ids(e, counts).collect()] == [9999]
    doc = json.loads(D.coverage_document(J.code_coverage(e, counts), "s", "c").first().json)
    assert (doc["elements"], doc["code_values"], doc["links"]) == (2, 1, [{"tag": 1000, "code_values": 0}, {"tag": 1001, "code_values": 1}])


def test_code_entries_and_references(spark, tmp_path):
    (tmp_path / "3035.txt").write_text(LIST, encoding="utf-8")
    (tmp_path / "0999.txt").write_text(LIST, encoding="utf-8")
    entries = M.code_entries(spark, str(tmp_path))
    got = [(r.code_list, r.code, r.name, r.description) for r in entries.orderBy("entry").collect()]
    assert got == [(3035, "1", "First name", "[1000] begins more (1005) and (0999) still the first [1000]"), (3035, "BB", "[1001] Name of a bank", "(1000)"), (3035, "ABC", "No description", "")]
    refs = J.references(entries)
    assert sorted((r.code, r.kind, r.tag) for r in refs.collect()) == [("1", "equals", 1000), ("1", "related", 1005), ("BB", "equals", 1001), ("BB", "related", 1000)]
    e = element_rows(spark).where("tag <> 1005")
    nest, lost = J.nested_references(refs, e), J.unknown_tags(refs, e)
    assert {r.tag: [(x.code, x.kind) for x in r.refs] for r in nest.collect()} == {1000: [("1", "equals"), ("BB", "related")], 1001: [("BB", "equals")]}
    doc = json.loads(D.references_document(nest, lost, "s", "v", "c").first().json)
    assert (doc["elements"], doc["refs"], doc["equals"], doc["related"], doc["unknown_tags"]) == (2, 3, 2, 1, [1005])


def test_ocr(spark, tmp_path):
    for name, text in (("1000-name", "Doc  nurnber\n"), ("1001-name", "zz"), ("1000-repr", "| an..35 |"), ("1001-repr", "l1"), ("1007-repr", "n..3"), ("1005-name", " ")):
        (tmp_path / f"{name}.txt").write_text(text, encoding="utf-8")
    ocr = M.ocr_texts(spark, str(tmp_path))
    e = element_rows(spark)
    expected = e.select("tag", F.lit("name").alias("field"), F.col("name").alias("expected")).unionByName(e.select("tag", F.lit("repr").alias("field"), F.col("representation.raw").alias("expected")))
    got = {(r.tag, r.field): (r["pass"], r.unreadable) for r in Y.ocr_results(expected, ocr).collect()}
    assert got == {(1000, "name"): (True, False), (1001, "name"): (False, False), (1000, "repr"): (True, False), (1001, "repr"): (None, True), (1007, "repr"): (False, False)}
    report = {r.field: (r.passes, r.total, r.unreadable, [tuple(x) for x in r.failures]) for r in Y.agreement(Y.ocr_results(expected, ocr)).collect()}
    assert report == {"name": (1, 2, 0, [(1001, "Doc name", "zz")]), "repr": (1, 2, 1, [(1007, "n3", "n..3")])}


# Sinks.


def test_files_and_documents(spark, tmp_path):
    e = element_rows(spark)
    out = str(tmp_path)
    queue = spark.createDataFrame([(2, None, "name", ["a"], "i", "low"), (1, 7, "z", [], "i", "low"), (1, 7, "b", [], "i", "low")], S.REVIEW)
    files = K.yaml_files(e).unionByName(K.review_file(queue))
    K.write_files(files, out)
    back = elements(spark, f"{out}/elements")
    assert [tuple(r) for r in back.select(e.columns).orderBy("tag").collect()] == [tuple(r) for r in e.orderBy("tag").collect()]
    assert back.first().category == "4.2.1 (1000-1699) documentation, references" and back.first().file == "1000-1699.yaml"
    assert [(r.page, r.tag, r.field) for r in review_queue(spark, f"{out}/review-queue.yaml").orderBy("ord").collect()] == [(1, 7, "b"), (1, 7, "z"), (2, None, "name")]
    fresh, stored = J.files(spark, f"file://{out}"), J.files(spark, out)
    assert W.regeneration(fresh, stored).first().status == "pass"
    (tmp_path / "elements" / "1000-1699.yaml").write_text("changed")
    again = files.select("path", F.col("text").cast("binary").alias("content"))
    assert W.regeneration(again, J.files(spark, out)).first().detail == "1: elements/1000-1699.yaml changed"
    cli.export(e, f"{out}/x", NS, "source", "28-132")
    rows = [r for p in sorted((tmp_path / "x" / "elements.csv").glob("part*")) for r in csv.DictReader(p.open())]
    assert [r["tag"] for r in rows] == ["1000", "1001", "1002", "1005", "1007"] and rows[0]["repr_max_length"] == "35" and rows[2]["repr_raw"] == ""
    read = lambda n: json.loads((tmp_path / "x" / n).read_text())
    doc = read("elements.json")
    assert list(doc) == ["source", "pages", "element_count", "elements"] and doc["element_count"] == 5 and doc["elements"][2]["notes"] == "use 1000" and "name" not in doc
    assert len(read("categories.json")) == 9 and read("categories.json")[0]["label"] == "documentation, references"
    v = read("vocabulary.json")
    assert v["namespace"] == NS and len(v["classes"]) == 6 and len(v["terms"]) == 39 and v["terms"][0] == {"term": "name", "iri": "schema:name", "group": "dataset-level"}
    assert [c["tag"] for c in read("parser-fixtures.json")["cases"]] == [1002] and read("parser-fixtures.json")["cases"][0]["replacement"] == 1000
    context = read("context.jsonld")
    assert context["utd"] == NS and context["altLabel"] == "skos:altLabel" and len(context) == 55
    assert len(read("graph.jsonld")["@graph"]) == 45 and len(list((tmp_path / "x" / "elements").iterdir())) == 10
    assert (tmp_path / "x" / "graph-00000.ttl").read_text().startswith("@prefix utd:")
    terms = {r.term: r.iri for r in context_terms(spark, f"{out}/x/context.yamlld").collect()}
    assert terms == context
    text = (tmp_path / "x" / "context.yamlld").read_text()
    assert text.index("# classes") < text.index("# dataset-level") < text.index("# element-level") < text.index("# category-level") < text.index("# vocabulary definitions")


def graph_of(spark, e):
    r = cli.replacements(e)
    ds = L.dataset_node(e, ORIGIN + "/", "Title", "About", "Source", [("data/all.jsonld", "application/ld+json"), ("data/all.ttl", "text/turtle")])
    return {"ontology": O.ontology_nodes(spark, NS), "dataset": ds, "scheme": L.scheme_node(spark, ORIGIN, "Label", "Comment"), "categories": L.category_nodes(e, S.categories(spark), ORIGIN), "elements": L.element_nodes(e, r, ORIGIN + "/")}


def statements_of(nodes):
    return reduce(DataFrame.unionByName, [T.node_triples(n, T.names(NS)) for n in nodes.values()])


def test_nodes_and_turtle(spark, tmp_path):
    e = element_rows(spark)
    nodes = graph_of(spark, e)
    by = {json.loads(r.json)["@id"]: json.loads(r.json) for r in L.graph(*nodes.values()).collect()}
    assert L.graph(*nodes.values()).count() == 6 + 23 + 2 + 9 + 5 and len(by) == 44  # the scheme has the IRI of its class here
    assert by[f"{ORIGIN}/elements/1002"] == {
        "@id": f"{ORIGIN}/elements/1002", "@type": "TradeDataElement", "tag": 1002, "isPartOf": {"@id": f"{ORIGIN}/dataset/directory"}, "category": {"@id": f"{ORIGIN}/categories/1000-1699"}, "changeTag": "add", "status": "retired",
        "sourcePage": 28, "name": "Gone", "description": "x", "replacedBy": {"@id": f"{ORIGIN}/elements/1000"},
    }
    assert by[f"{ORIGIN}/elements/1000"]["bridge"] == [{"@type": "Bridge", "scheme": "UNLK", "detail": "L 1, P 0-8", "zone": [{"@type": "UnlkZone", "lineFrom": 1, "lineTo": 1, "posFrom": 1, "posTo": 8}]}]
    assert by[f"{ORIGIN}/categories/1000-1699"]["elementCount"] == 5 and by[f"{ORIGIN}/categories/9000-9699"]["elementCount"] == 0
    assert by[NS + "tag"] == {"@id": NS + "tag", "@type": "rdf:Property", "comment": "The four-digit unique identifier of the data element.", "domain": {"@id": NS + "TradeDataElement"}}
    statements = statements_of(nodes).cache()
    assert T.unresolved(statements, [T.names(NS)[p] for p in ("replacedBy", "category", "inScheme", "isPartOf", "zone", "bridge")]).count() == 0
    assert {r.gap for r in T.vocabulary_gaps(statements, NS).collect()} == {"unused"}  # this small directory has no format
    context = O.context_document(spark, NS)
    doc = json.loads(L.graph_document(context, *nodes.values()).first().json)
    assert len(doc["@graph"]) == 45 and doc["@context"]["utd"] == NS and doc["@graph"][0]["@type"] == "rdfs:Class"
    K.write_files(K.element_files(nodes["elements"], statements, context, NS), f"file://{tmp_path}/e")
    assert sorted(p.name for p in (tmp_path / "e").iterdir()) == sorted(f"{t}.{x}" for t in (1000, 1001, 1002, 1005, 1007) for x in ("jsonld", "ttl"))
    turtle = (tmp_path / "e" / "1000.ttl").read_text()
    assert turtle.startswith("@prefix utd:") and f"<{ORIGIN}/elements/1000> a utd:TradeDataElement ;" in turtle and "utd:tag 1000" in turtle and "utd:lineFrom" not in turtle
    assert json.loads((tmp_path / "e" / "1000.jsonld").read_text())["@context"]["utd"] == NS
    whole = K.turtle_files(statements, NS).collect()
    assert len(whole) == 1 and whole[0].text.count("\n  utd:lineFrom 1 ;") == 1
    assert K.n_triples(statements).count() == statements.count()


def test_console(spark, tmp_path, capsys):
    K.write_files(K.yaml_files(element_rows(spark)), str(tmp_path))
    assert cli.main(["validate", "--data", str(tmp_path)], spark) == 1
    assert "  review queue is missing" in capsys.readouterr().out.splitlines()
    K.write_files(K.review_file(spark.createDataFrame([], S.REVIEW)), str(tmp_path))
    assert cli.main(["validate", "--data", str(tmp_path)], spark) == 0
    assert cli.main(["verify", "--data", str(tmp_path)], spark) == 0
    assert "VERIFY OK" in capsys.readouterr().out
    (tmp_path / "words.xhtml").write_text(WORDS, encoding="utf-8")
    assert cli.main(["extract", "--words", f"{tmp_path}/words.xhtml", "--out", f"{tmp_path}/new"], spark) == 0
    assert "change tags: cn=1 cr=1 x=1" in capsys.readouterr().out and elements(spark, f"{tmp_path}/new/elements").count() == 3
    # A fresh extraction writes what is stored, byte for byte, until someone edits it.
    again = ["verify", "--data", f"{tmp_path}/new", "--words", f"{tmp_path}/words.xhtml"]
    cli.main(again, spark)
    assert "regeneration             PASS  all 2 files byte-identical to fresh extraction" in capsys.readouterr().out
    (tmp_path / "new" / "elements" / "1000-1699.yaml").write_text((tmp_path / "new" / "elements" / "1000-1699.yaml").read_text().replace("document.", "Document."))
    assert cli.main(again, spark) == 1
    assert "regeneration             FAIL  1: elements/1000-1699.yaml changed" in capsys.readouterr().out
    (tmp_path / "s.xml").write_text(SEGMENTS, encoding="utf-8")
    (tmp_path / "c.xml").write_text(CODES, encoding="utf-8")
    (tmp_path / "lists").mkdir()
    (tmp_path / "lists" / "3035.txt").write_text(LIST, encoding="utf-8")
    for command, mirror in (("links", "s.xml"), ("coverage", "c.xml"), ("references", "lists"), ("crosscheck", "s.xml")):
        assert cli.main([command, "--data", str(tmp_path), "--mirror", f"{tmp_path}/{mirror}", "--out", f"{tmp_path}/derived", "--source", "src"], spark) == 0
    derived = lambda n: (tmp_path / "derived" / n).read_text()
    assert json.loads(derived("links.json"))["aligned"] == 2 and json.loads(derived("coverage.json"))["code_values"] == 1 and json.loads(derived("references.json"))["refs"] == 4
    assert derived("crosscheck.txt").splitlines()[0] == "src" and "DESC DIFFS:" in capsys.readouterr().out
    with pytest.raises(FileNotFoundError):
        resolve(None, "COPPICE_NOTHING", f"{tmp_path}/none")


# A published directory.


@pytest.fixture(scope="module")
def published(spark):
    data = os.environ.get("COPPICE_DATA")
    if not data:
        pytest.skip("COPPICE_DATA names no directory")
    return elements(spark, f"{data}/elements").cache(), review_queue(spark, f"{data}/review-queue.yaml")


def test_published_counts(published):
    e, queue = published
    assert V.summary(e, queue).first() == Row(files=9, elements=1504, active=1318, retired=186, active_without_name=0, active_without_repr=4, review_entries=4)
    assert V.validate(e, queue).count() == 0
    assert {r.k: r.n for r in J.tally(J.by_category(e, "tag"), "k").collect()} == dict(enumerate([144, 171, 304, 206, 201, 120, 143, 105, 110], 1))
    assert e.select(F.explode(bridges(F.col("bridges")))).count() == 782
    zoned = e.select("tag", F.explode(first_zones(F.col("bridges"))).alias("z"))
    assert zoned.agg(F.count("*"), F.countDistinct("tag"), F.count("z.format"), F.max("z.line_to")).first()[:] == (255, 254, 33, 68)
    assert cli.replacements(e).count() == 122
    assert J.first_valid_reference(e.where("status = 'retired' AND notes IS NOT NULL"), "tag", "notes", e, "tag", year_guard=False).count() == 124
    checks = {r.check: (r.status, r.detail) for r in W.verify(e).collect()}
    assert checks["retired_references"] == ("report", "1: 4000->1056") and checks["bridge_zones"][0] == "pass"
    assert checks["description_endings"][1].startswith("213: 1003, 1008, 1014, 1030") and checks["name_tails"][1].startswith("tails: Text=350 Code=335 Identifier=194")


def test_published_fixtures(published):
    by = {r.tag: r for r in D.parser_fixtures(published[0], cli.replacements(published[0])).collect()}
    assert sorted(by) == S.FIXTURE_TAGS
    assert by[1002].replacement == 1000 and [tuple(x) for x in by[5010].entries] == [("UNLK", "L 24, P45-80")]
    assert len(by[2025].zones) == 2 and any((z.lineFrom, z.posFrom, z.posTo) == (36, 1, 8) for z in by[1082].zones)
    assert [x.scheme for x in by[1004].entries][-1] == "SAD" and by[1004].entries[-1].detail == ""


def test_published_graph(spark, published):
    nodes = graph_of(spark, published[0])
    assert L.graph(*nodes.values()).count() == 1544
    statements = statements_of(nodes).cache()
    assert statements.count() > 12032
    assert T.vocabulary_gaps(statements, NS).count() == 0
    assert T.unresolved(statements, [T.names(NS)[p] for p in ("replacedBy", "category", "inScheme", "isPartOf")]).count() == 0
    assert statements.where(f"s = '{ORIGIN}/elements/9649' AND p = '{NS}tag'").first().o == "9649"


def test_published_files_are_written_byte_for_byte(published, spark):
    e, queue = published
    fresh = K.stored_form(K.yaml_files(e).unionByName(K.review_file(queue)))
    files = J.files(spark, os.environ["COPPICE_DATA"]).where("path = 'review-queue.yaml' OR path LIKE 'elements/%'")
    assert W.regeneration(fresh, files).first().detail == "all 10 files byte-identical to fresh extraction"


def test_yaml_text():
    from coppice.sinks.yaml_text import yaml_item

    got = yaml_item({"tag": 1, "name": None, "charset": "n", "text": "|odd", "note": "a: b", "long": "word " * 30, "lines": "a\nb", "list": ["12", "x"], "r": {"raw": None, "n": 3}})
    assert got.splitlines()[:4] == ["- tag: 1", '  charset: "n"', '  text: "|odd"', "  note: 'a: b'"] and "name" not in got and "raw" not in got
    assert max(map(len, got.splitlines())) < 90
    import yaml

    assert yaml.safe_load(got) == [{"tag": 1, "charset": "n", "text": "|odd", "note": "a: b", "long": "word " * 30, "lines": "a\nb", "list": ["12", "x"], "r": {"n": 3}}]
