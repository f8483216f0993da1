"""Cases that only larger tables hold."""

from pyspark.sql import functions as F

from coppice.checks import validate as V
from coppice.operators import lookup as J
from coppice.operators import ordered as O
from coppice.operators.intervals import interval_join
from coppice.sources import rdf


def test_file_range_of_tags_with_five_digits(spark):
    e = spark.createDataFrame([("1000-1699.yaml", 1000), ("1000-1699.yaml", 1700), ("10000-10699.yaml", 10_699), ("10000-10699.yaml", 10_700), ("120000-120699.yaml", 1200), ("odd.yaml", 5)], "file string, tag int")
    rule = "tag outside its file's range"
    assert sorted(r.key for r in V.violations(e, "tag", {rule: V.element_rules()[rule]}).collect()) == [1200, 1700, 10_700]


def test_sample_breaks_ties_by_keys(spark):
    rows = spark.createDataFrame([(k,) for k in range(400, 0, -1)], "k int").repartition(3)
    assert sorted(r.k for r in J.seeded_sample(rows, F.col("k") % 2, 10, "k").collect()) == list(range(2, 21, 2))
    assert sorted(r.k for r in J.seeded_sample(rows, F.col("k") * 0, 5, "k").collect()) == [1, 2, 3, 4, 5]


def test_ranges_of_a_file_are_tasks_of_their_own(spark, tmp_path):
    lines = [f'<a:{i}> <a:p> "base . {i}" ;\n  <a:q> {i} .\n' if i % 50 == 0 else f'<a:{i}> <a:p> "x . {i}" ;\n  <a:q> {i} .\n' for i in range(400)]
    (tmp_path / "a.ttl").write_text("@prefix a: <a:> .\n" + "".join(lines))
    read = rdf.turtle(spark, f"file://{tmp_path}", 1000)
    assert read.rdd.getNumPartitions() >= 10
    assert sorted((r.s, r.p, r.o) for r in read.collect()) == sorted(x for i in range(400) for x in ((f"a:{i}", "a:p", f"{'x' if i % 50 else 'base'} . {i}"), (f"a:{i}", "a:q", str(i))))


def test_plain_ranges_are_left_as_others(monkeypatch):
    texts = ["", "\n\n", "<a:s> <a:p> 1 .\n", "<a:s> <a:p>\n 1\n", ".\n", "a:p 1 ;\n# end . \n\n", 'x "a. b" .\n  # c\n', "<a:s>\n", "a b c .\n<x:y>\n"]
    after = "<a:t> <a:p> 2 .\n@prefix c: <c:> .\n"
    quick = [rdf._left_plainly(x, len(x)) for x in texts]
    assert None not in quick and [rdf.leaves(x + after, len(x), 0) for x in texts] == quick
    monkeypatch.setattr(rdf, "_left_plainly", lambda text, end: None)
    assert [rdf.leaves(x + after, len(x), 0) for x in texts] == quick


def test_anti_join_over_parts_of_its_own(spark):
    a, b = spark.range(1000).withColumnRenamed("id", "a"), spark.range(5, 2000, 2).withColumnRenamed("id", "b")
    got = J.only_in(a, b, "a", "b", 37)
    assert got.rdd.getNumPartitions() == 37  # Spark puts none together
    assert sorted(r.a for r in got.collect()) == sorted({*range(0, 1000, 2), 1, 3})


def test_references_of_one_tag_in_pieces(spark):
    n = 1000
    refs = spark.createDataFrame([(c, 1, "AB", "Name", "", 0, "equals" if c % 3 else "related", tag) for c in range(n) for tag in (7, 9)], "code_list long, entry int, code string, name string, description string, pos int, kind string, tag int").repartition(3)
    elements = spark.createDataFrame([(7,), (7,), (8,)], "tag int")
    found = sorted(J.nested_references(refs, elements, 64, 5).collect(), key=lambda r: r.part)
    assert {r.tag for r in found} == {7} and max(len(r.refs) for r in found) <= 64
    assert [x.code_list for r in found for x in r.refs] == list(range(n))
    assert [x.code_list for x in J.nested_references(refs, elements).first().refs] == list(range(n))
    assert [r.tag for r in J.unknown_tags(refs, elements).collect()] == [9]


def test_ranges_are_dealt_and_not_sent(spark):
    p = spark.range(200).select((F.col("id") % 5).alias("k"), F.col("id").cast("double").alias("v"))
    r = spark.range(5).select(F.col("id").alias("k"), F.lit(10.0).alias("lo"), F.lit(90.0).alias("hi"))
    for parts in (None, 23):
        got = interval_join(p, r, ["k"], "v", "lo", "hi", 1.0, parts)
        assert "BroadcastHashJoin" not in got._jdf.queryExecution().executedPlan().toString()
        assert got.count() == 80
    assert got.rdd.getNumPartitions() == 23


def test_bands_over_parts_of_their_own(spark):
    words = spark.range(300).select((F.col("id") % 10).alias("page"), F.floor(F.col("id") / 10).alias("line"), (F.col("id") % 10 + 140.0).alias("x"), (F.floor(F.col("id") / 10) * 7).cast("double").alias("y"), F.lit(0).alias("word_no"), F.col("id").cast("string").alias("text"))
    bands = spark.range(10).select(F.col("id").alias("page"), (F.col("id") % 3).alias("tag"), F.lit(0.0).alias("y0"), F.lit(100.0).alias("y1"))
    column = F.when(F.col("x") > 130, "name")
    whole, dealt = O.band_cells(words, bands, column), O.band_cells(words, bands, column, 19)
    assert dealt.rdd.getNumPartitions() == 19  # Spark puts none together
    assert sorted(map(str, dealt.collect())) == sorted(map(str, whole.collect())) and whole.count() == 10
