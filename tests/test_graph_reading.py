"""Graphs read back: Turtle and N-Triples in splits, and equality of graphs but for labels."""

import os
import random
import re

import pytest

from coppice.linked import isomorphism as I
from coppice.linked import nodes as N
from coppice.linked import triples as T
from coppice.linked import vocabulary as L
from coppice.sinks import writers as K
from coppice.sources import rdf

SPACE = "https://example.org/ns/directory#"

#: Statements over many lines, texts with points, marks and line ends, prefixes in both forms and set anew.
DOC = '''@prefix ex: <http://e.org/> .
@prefix : <http://d.org/#> .
# a comment . with """ quotes
PREFIX s: <http://s.org/>
ex:a a ex:T ; ex:p "x. y", "two\\nlines" ;
   ex:q """long . text
with "quotes" . and ;;; , [ § ^
ex:not :a :statement .
""" ; ex:n 5, -2.5, 1e3, true .
<http://e.org/b> ex:list ( 1 "b" [ ex:in "deep." ] ) ;
  ex:l "chat"@fr , "5"^^ex:dt ; .
[] ex:p _:b1 .
[ ex:x ex:y ] .
_:b1 ex:r ex:c.d , s:e .
PREFIX
 ex:
 <http://other.org/>
ex:z ex:p \'\'\'single
 . \'\'\' ; ex:q "", "\\\\", "tab\\t\\"q\\"" .
@base <http://base.org/x/> .
:é :p "\\u00e9\\U0001F600", <rel> .
'''


def written(folder, **files):
    for name, text in files.items():
        (folder / f"{name}.ttl").write_text(text, encoding="utf-8")
    return f"file://{folder}"


def rows(df):
    return sorted(str(tuple(r)) for r in df.collect())


def test_turtle_terms(spark, tmp_path):
    got = [tuple(r) for r in rdf.turtle(spark, written(tmp_path, a=DOC)).collect()]
    have = {(s, p.rpartition("/")[2].rpartition("#")[2], o, k, d) for s, p, o, k, d in got if not s.startswith("_:")}
    x = rdf.XSD
    for want in [
        ("http://e.org/a", "type", "http://e.org/T", "iri", None), ("http://e.org/a", "p", "two\nlines", "string", None), ("http://e.org/a", "n", "5", "integer", None), ("http://e.org/a", "n", "-2.5", "typed", f"{x}decimal"),
        ("http://e.org/a", "n", "1e3", "typed", f"{x}double"), ("http://e.org/a", "n", "true", "typed", f"{x}boolean"), ("http://e.org/b", "l", "chat", "language", "fr"), ("http://e.org/b", "l", "5", "typed", "http://e.org/dt"),
        ("http://other.org/z", "p", "single\n . ", "string", None), ("http://other.org/z", "q", "", "string", None), ("http://other.org/z", "q", "\\", "string", None), ("http://other.org/z", "q", 'tab\t"q"', "string", None),
        ("http://d.org/#é", "p", "é😀", "string", None), ("http://d.org/#é", "p", "http://base.org/x/rel", "iri", None),
    ]:
        assert want in have
    assert sum(p == f"{rdf.RDF}rest" for _, p, *_ in got) == 3
    assert ("_:b1", "http://e.org/r", "http://s.org/e", "iri", None) in got


@pytest.mark.parametrize("split", [1, 7, 40, 64, 333])
def test_turtle_is_the_same_for_every_split(spark, tmp_path, split):
    path = written(tmp_path, a=DOC, b=DOC.replace("_:b1", "_:b2"), empty="", blank="# only a comment\n\n")
    assert rows(rdf.turtle(spark, path, split)) == rows(rdf.turtle(spark, path))


@pytest.mark.parametrize("bad", ["<http://a> <http://b> .", "ex:a <http://b> 1 .", "<http://a> <http://b> 1", '<http://a> <http://b> "x\ny" .', '<a:> <b:> """x'])
def test_turtle_errors(spark, tmp_path, bad):
    with pytest.raises(Exception, match="not Turtle|unknown prefix|without its end|not a term"):
        rdf.turtle(spark, written(tmp_path, a=bad)).collect()


def element_rows(spark, n=120):
    e = [(t, f"Name {t}", f'Text "{t}"\\ with\nlines. \'\'\' """', "add", "active", None if t % 3 else "Old", "Term", None, f"UNLK: an..3 L {t % 60 + 1}, P 0-9 MAR: x", (t % 9,), ("an..3", "an", 1, 3) if t % 4 else None) for t in range(1000, 1000 + n)]
    return spark.createDataFrame(e, "tag int, name string, description string, change_tag string, status string, old_name string, business_term string, notes string, bridges string, provenance struct<page:int>, representation struct<raw:string,charset:string,min_length:int,max_length:int>")


def graph_of(spark, e):
    none = spark.createDataFrame([], "key int, replacement int")
    nodes = [L.ontology_nodes(spark, SPACE), N.element_nodes(e, none, "https://example.org")]
    names = T.names(SPACE)
    return T.node_triples(nodes[0], names).unionByName(T.node_triples(nodes[1], names))


def test_written_graph_is_read_back(spark, tmp_path):
    g = graph_of(spark, element_rows(spark)).persist()
    K.write_files(K.turtle_files(g, SPACE), f"file://{tmp_path}/ttl")
    K.n_triples(g).write.text(f"file://{tmp_path}/nt")
    for read in (rdf.turtle(spark, f"file://{tmp_path}/ttl", 5000), rdf.n_triples(spark, f"file://{tmp_path}/nt")):
        assert rows(read.select("s", "p", "o", "kind")) == rows(g.distinct())
        assert I.isomorphic(read.drop("detail"), g)
    g.unpersist()


def relabelled(spark, statements, seed=1):
    found = [tuple(r) for r in statements.collect()]
    labels = sorted({x for r in found for x in (r[0], r[2]) if x.startswith("_:")})
    new = [f"_:x{i}" for i in range(len(labels))]
    random.Random(seed).shuffle(new)
    to = dict(zip(labels, new, strict=True))
    return [(to.get(s, s), p, to.get(o, o) if k == "blank" else o, k) for s, p, o, k in found]


def test_isomorphism(spark):
    g = graph_of(spark, element_rows(spark, 30))
    other = relabelled(spark, g)
    schema = "s string, p string, o string, kind string"
    assert I.isomorphic(g, spark.createDataFrame(other, schema))
    # One text below two blank nodes changed, and one nested node hung below another.
    at = next(i for i, r in enumerate(other) if r[0].startswith("_:") and r[2] == "an..3")
    changed = [*other[:at], (*other[at][:2], "an..4", "string"), *other[at + 1 :]]
    assert not I.isomorphic(g, spark.createDataFrame(changed, schema))
    assert not I.isomorphic(g, spark.createDataFrame(other[:-1], schema))


@pytest.mark.parametrize(
    ("a", "b", "same"),
    [
        ([("_:a", "_:b"), ("_:b", "_:c")], [("_:x", "_:y"), ("_:z", "_:x")], True),  # chains
        ([("_:a", "_:b"), ("_:b", "_:a")], [("_:a", "_:b"), ("_:b", "_:c")], False),  # ring and chain
        ([("_:a", "_:b"), ("_:a", "_:c")], [("_:a", "_:b"), ("_:c", "_:b")], False),
        ([("_:a", "_:b"), ("_:a", "_:b")], [("_:p", "_:q")], True),  # statements count once
        ([], [], True),
    ],
)
def test_isomorphism_of_bare_shapes(spark, a, b, same):
    g = lambda x: spark.createDataFrame([(s, "p", o, "blank") for s, o in x], "s string, p string, o string, kind string")
    assert I.isomorphic(g(a), g(b)) is same


@pytest.mark.skipif(not os.environ.get("COPPICE_DATA"), reason="no published directory")
def test_published_graph_is_read_back(spark, tmp_path):
    from functools import reduce

    from coppice import cli
    from coppice.sources.yaml_source import elements

    e = elements(spark, f"{os.environ['COPPICE_DATA']}/elements").persist()
    nodes = cli.graph_nodes(e, SPACE, "https://example.org", "Directory", "")
    assert sum(n.count() for n in nodes) == 1544
    g = reduce(lambda x, y: x.unionByName(y), [T.node_triples(n, T.names(SPACE)) for n in nodes]).persist()
    assert g.count() > 12_032
    K.write_files(K.turtle_files(g, SPACE), f"file://{tmp_path}/ttl")
    assert I.isomorphic(rdf.turtle(spark, f"file://{tmp_path}/ttl", 100_000).drop("detail"), g)


def test_labels_are_those_of_the_file(spark, tmp_path):
    got = rows(rdf.turtle(spark, written(tmp_path, a="[] <a:p> [] .\n", b="[] <a:p> [] .\n")))
    assert len(set(re.findall(r"_:\w+", " ".join(got)))) == 4
