"""Sources and sinks at their edges: streams of XML, split lists, pruned files, committed files, spread windows."""

import io
import os
import resource
import time

import pytest
from pyspark.sql import functions as F

from coppice.operators import ordered as O
from coppice.operators import scan as S
from coppice.operators.intervals import interval_join
from coppice.operators.lookup import grouped_counts
from coppice.sinks import writers as K
from coppice.sources import mirrors as M
from coppice.sources.xml_source import rows_of
from coppice.sources.yaml_source import elements


class Endless(io.RawIOBase):
    """A document of pages made as it is read."""

    def __init__(self, size):
        self.size, self.made, self.page = size, 0, 0

    def read(self, n=-1):
        if self.made >= self.size:
            if self.page < 0:
                return b""
            self.page = -1
            return b"</doc>"
        head = b"<doc>" if not self.made else b""
        self.page += 1
        text = head + b"<page>" + b"".join(b'<word xMin="%d.5" yMin="%d">w&amp;%d</word>' % (i, self.page, i) for i in range(1000)) + b"</page>"
        self.made += len(text)
        return text


def test_xml_of_any_size_takes_bounded_memory():
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    n = 0
    for page, word, text, x, y in rows_of(Endless(200 << 20), "words"):
        assert (text, x, y) == (f"w&{word}", word + 0.5, page + 1)
        n += 1
    assert n % 1000 == 0
    assert n > 4_000_000
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 100 << 10


def test_xml_edges(spark, tmp_path):
    (tmp_path / "a.xhtml").write_text('<!DOCTYPE html PUBLIC "-//W3C//DTD XHTML 1.0//EN" "http://nowhere.example/x.dtd"><html><word xMin="1">none</word><page/><page><word xMin="x" yMin="2"> a&nbsp;b<![CDATA[<word>]]></word><word/></page></html>', encoding="utf-8")
    (tmp_path / "b.xhtml").write_text("<doc/>", encoding="utf-8")
    got = [tuple(r) for r in M.words(spark, str(tmp_path), 5).orderBy("page", "word_no").collect()]
    assert got == [(6, 0, " a\xa0b<word>", None, 2.0), (6, 1, "", None, None)]
    (tmp_path / "c.xhtml").write_text("<doc><page>", encoding="utf-8")
    with pytest.raises(Exception, match="no element found"):
        M.words(spark, f"{tmp_path}/c*").collect()


LIST = "head\n          lost before\n  1   First\n          more\n\n* star\n          and ü more\n  Note: no\n ZZ   Second\nother\n          tail\n  3   Third\n"


@pytest.mark.parametrize("split", [1, 5, 16, 37, 1000])
def test_lists_are_the_same_for_every_split(spark, tmp_path, split):
    (tmp_path / "2000.txt").write_text(LIST, encoding="utf-8")
    (tmp_path / "1000.txt").write_text(LIST.rstrip() + "\r\n" + " " * 12 + "end", encoding="utf-8")
    (tmp_path / "0001.txt").write_text(LIST, encoding="utf-8")
    (tmp_path / "3000.txt").write_text("", encoding="utf-8")
    got = [(r.code_list, r.code, r.name, r.description) for r in M.code_entries(spark, str(tmp_path), split).orderBy("code_list", "entry").collect()]
    one = [("1", "First", "more and ü more"), ("ZZ", "Second", "tail"), ("3", "Third", "")]
    assert got == [*((1000, *x) for x in [*one[:2], ("3", "Third", "end")]), *((2000, *x) for x in one)]


def test_conditions_on_tags_leave_other_files_unopened(spark, tmp_path):
    for lo in (1000, 2000, 3000):
        (tmp_path / f"{lo}-{lo + 699}.yaml").write_text(f"category: c\nelements:\n- {{tag: {lo}, provenance: {{page: 1}}}}\n- {{tag: {lo + 5}, provenance: {{page: 2}}}}\n")
    (tmp_path / "4000-4699.yaml").write_text("no: [yaml")
    e = elements(spark, str(tmp_path), prune=True)
    tags = lambda d: sorted(r.tag for r in d.select("tag").collect())
    for condition, files, want in [("tag = 2005", 1, [2005]), ("tag < 2000", 1, [1000, 1005]), ("tag >= 2000 AND tag <= 3000", 2, [2000, 2005, 3000]), ("tag IN (1005, 3000)", 2, [1005, 3000]), ("tag > 5000", 0, [])]:
        d = e.where(condition)
        assert tags(d) == want
        assert not files or d.rdd.getNumPartitions() == files
    with pytest.raises(Exception, match="expected"):
        tags(e.where("provenance.page = 1"))


def found(folder):
    return sorted(os.path.relpath(os.path.join(d, f), folder) for d, _, names in os.walk(folder) for f in names)


def test_files_come_to_light_together(spark, tmp_path):
    d = spark.range(8).repartition(4).select(F.concat(F.lit("a/"), "id", F.lit(".txt")).alias("path"), F.col("id").cast("string").alias("text"))
    K.write_files(d, str(tmp_path))
    assert found(tmp_path) == [f"a/{i}.txt" for i in range(8)]
    assert os.listdir(tmp_path) == ["a"]
    # A task that fails after others have written: nothing of the job is left, and nothing of an earlier one is touched.
    bad = d.select(F.replace("path", F.lit("a/"), F.lit("b/")).alias("path"), F.when(F.col("path") == "a/7.txt", F.raise_error(F.lit("lost"))).otherwise(F.col("text")).alias("text"))
    with pytest.raises(Exception, match="lost"):
        K.write_files(bad, f"file://{tmp_path}")
    for _ in range(50):  # tasks that ran beside the one that failed end on their own
        if os.listdir(tmp_path) != ["a"]:
            time.sleep(0.1)
    assert found(tmp_path) == [f"a/{i}.txt" for i in range(8)]
    assert os.listdir(tmp_path) == ["a"]
    K.write_files(d.select("path", F.lit("new").alias("text")), str(tmp_path))
    assert {(tmp_path / f).read_text() for f in found(tmp_path)} == {"new"}
    for path in ("/etc/x", "../x", None):
        with pytest.raises(Exception, match="not a file of the folder"):
            K.write_files(spark.createDataFrame([(path, "x")], "path string, text string"), str(tmp_path))


@pytest.mark.parametrize("group", [["g"], []])
def test_spread_windows_equal_plain_ones(spark, group):
    rows = [(None if i % 3 == 0 else i % 2, i, None if i % 11 == 0 else (i * 37) % 101) for i in range(300)]
    d = spark.createDataFrame(rows, "g int, n int, v int").repartition(7)
    same = lambda a, b: a.exceptAll(b.select(a.columns)).isEmpty() and b.select(a.columns).exceptAll(a).isEmpty()
    assert same(O.gap_sessions(d, group, ["n"], F.col("v"), 50, spread=True), O.gap_sessions(d, group, ["n"], F.col("v"), 50))
    assert same(O.inversions(d, group, ["n"], "v", spread=True), O.inversions(d, group, ["n"], "v"))
    text = d.withColumn("t", F.col("n").cast("string"))
    assert same(O.group_records(text, group, ["n"], F.col("n") % 7 == 1, "t", spread=True), O.group_records(text, group, ["n"], F.col("n") % 7 == 1, "t"))


def test_one_group_spreads_over_ranges(spark):
    s = S.ordered(spark.range(1000).withColumn("v", F.col("id") % 7), [], ["id"], parts=8)
    assert s.select("__part").distinct().count() == 8
    assert [r.x for r in S.running(s, [], F.col("v"), "x").orderBy("id").select("x").collect()][-1] == sum(i % 7 for i in range(1000))


def test_interval_join_edges(spark):
    p = spark.createDataFrame([("a", 1.0), ("a", 5.0), ("b", 5.0), ("a", None), (None, 1.0), ("a", -7.5)], "k string, v double")
    r = spark.createDataFrame([("a", 1.0, 5.0, 1), ("a", -100.0, 100.0, 2), ("a", 3.0, 3.0, 3), ("b", 5.0, 5.5, 4), ("a", None, 9.0, 5)], "k string, lo double, hi double, n int")
    for width in (0.5, 3.0, 1000.0):
        got = sorted((x.k, x.v, x.n) for x in interval_join(p, r, ["k"], "v", "lo", "hi", width).collect())
        assert got == [("a", -7.5, 2), ("a", 1.0, 1), ("a", 1.0, 2), ("a", 5.0, 2), ("b", 5.0, 4)]
    plan = interval_join(p, r, ["k"], "v", "lo", "hi", 3.0)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_grouped_counts_tell_null_keys_from_totals(spark):
    d = spark.createDataFrame([("x", None), ("x", "p"), ("y", "p")], "a string, b string")
    got = {(r.a, r.b, r.level): r.n for r in grouped_counts(d, {"a": F.col("a"), "b": F.col("b")}).collect()}
    assert got == {("x", None, 0): 1, ("x", "p", 0): 1, ("y", "p", 0): 1, ("x", None, 1): 2, ("y", None, 1): 1, (None, None, 3): 3}
    assert [r.n for r in grouped_counts(d.limit(0), {"a": F.col("a")}).collect()] in ([0], [])
