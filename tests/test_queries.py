"""Every query against DuckDB, and the parsers against literal cases."""

import os
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from coppice.checks import validate as V
from coppice.functions.fragments import join_fragments
from coppice.functions.notation import bridges, code_references, notation, segments, zones
from coppice.operators import ordered as O
from coppice.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(df):
    df = df[sorted(df.columns)]
    return sorted(re.sub(r"(\d)\.0\b", r"\1", str(r)) for r in df.astype(object).where(df.notna(), None).values.tolist())


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, name):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    own, other = QUERIES[name](spark, SF).toPandas(), c.sql(ORACLE_SQL[name]).df()
    assert sorted(own.columns) == sorted(other.columns)
    assert rows(own) == rows(other)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("text", "want"), [("an..35", ("an..35", "an", 1, 35)), ("n3", ("n3", "n", 3, 3)), (" a..2 ", ("a..2", "a", 1, 2)), ("x3", None), ("an..", None), (None, None)])
def test_notation(spark, text, want):
    got = one(spark, notation(F.lit(text).cast("string")))
    assert (tuple(got) if got else None) == want


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("UNLK: an..17 L 04, P 63-80 MAR: IMO/FAL 1-7", [("UNLK", "an..17 L 04, P 63-80"), ("MAR", "IMO/FAL 1-7")]),
        ("UNLK L 24, P45-80", [("UNLK", "L 24, P45-80")]),
        ("see form UNLK: L 2", [("UNLK", "L 2")]),
        ("UNLK: L 1 SAD:", [("UNLK", "L 1"), ("SAD", "")]),
        ("n..11", []),
        (None, []),
    ],
)
def test_bridges(spark, text, want):
    assert [tuple(x) for x in one(spark, bridges(F.lit(text).cast("string")))] == want


def test_segments(spark):
    got = one(spark, segments(F.lit("an..17 L 04, P 63-80")))
    assert [x.kind for x in got] == ["format", "lines", "text", "positions"]
    assert (got[1]["from"], got[1]["to"], got[3]["from"], got[3]["to"]) == (4, None, 63, 80)


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("L 16, P 45 - 61", [(16, 16, 45, 61, None)]),
        ("L 36-46, P 00-08", [(36, 46, 1, 8, None)]),
        ("L15, P 27-44", [(15, 15, 27, 44, None)]),
        ("Date only: L 21, p 74-80", [(21, 21, 74, 80, None)]),
        ("an..17 L 40", [(40, 40, 1, 82, "an..17")]),
        ("an..3 L 1 L 2", [(1, 1, 1, 82, "an..3"), (2, 2, 1, 82, "an..3")]),
        ("P 4-5", []),
        ("n..11", []),
    ],
)
def test_zones(spark, text, want):
    assert [tuple(x) for x in one(spark, zones(F.lit(text)))] == want


def test_code_references(spark):
    got = one(spark, code_references(F.lit("Buyer's bank"), F.lit("[3420] see (1234), [3420], [3035], (0999) and (1234)")))
    assert [tuple(x) for x in got] == [("equals", 3420), ("related", 3035), ("related", 1234)]


@pytest.mark.parametrize(
    ("parts", "want"),
    [
        (["date/", "time"], "date/time"), (["a word", ", more"], "a word, more"), (["pre-", "paid"], "pre-paid"), (["1", "-2"], "1-2"), (["tota", "l sum"], "total sum"),
        (["docu", "ment name"], "document name"), (["two", "words"], "two words"), ([], None), (["x", "  "], "x"),
    ],
)
def test_join_fragments(parts, want):
    assert join_fragments(parts, frozenset({"document"}), frozenset()) == want


def test_layout(spark):
    words = [(1, 0, "head", 130.0, 70.0), (1, 1, "lead", 130.0, 90.0), (1, 2, "add", 70.0, 100.0), (1, 3, "1001", 105.0, 101.0), (1, 4, "Name", 130.0, 102.0), (1, 5, "more", 130.0, 110.0), (2, 0, "tail", 263.0, 90.0), (3, 0, "lost", 263.0, 90.0)]
    lines = O.layout_lines(spark.createDataFrame(words, "page int, word_no int, text string, x double, y double"))
    got = {(r.text, tuple(r.row_id)) for r in O.layout_rows(lines, ["add"]).collect()}
    assert got == {("add", (1, 1)), ("1001", (1, 1)), ("Name", (1, 1)), ("more", (1, 1)), ("tail", (1, 1))}


def test_violations_and_empty_tables(spark):
    e = spark.createDataFrame([], "file string, tag int, change_tag string, status string, name string, provenance struct<page int>, representation struct<raw string, charset string, min_length int, max_length int>")
    assert [r.rule for r in V.validate(e, e).collect()] == ["no elements"]
    assert {r.rule for r in V.validate(e, None).collect()} == {"no elements", "review queue is missing"}
