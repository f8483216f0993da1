"""External directories: XML mirrors, fixed-width text lists, positioned words and texts read by OCR programs."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import BLANKS, leading_int, strip
from .ranges import Lines, byte_ranges
from .xml_source import xml


def segments_mirror(spark: SparkSession, path: str) -> DataFrame:
    """tag, name, desc, type, max_length (0 if it is missing): ``data_element`` at any depth, numbers of 1000 or more, the first of each tag."""
    e = xml(spark, path, "elements").select("file", "ord", leading_int(F.col("id")).alias("tag"), "name", "desc", "type", leading_int(F.col("maxlength")).alias("max_length"))
    first = e.where("tag >= 1000").groupBy("tag").agg(F.min_by(F.struct("name", "desc", "type", "max_length"), F.struct("file", "ord")).alias("m"))
    return first.select("tag", "m.*")


def code_counts(spark: SparkSession, path: str) -> DataFrame:
    """id, n: number of ``code`` children of the elements right under the root ``data_elements``; the last of each id wins."""
    e = xml(spark, path, "codes").select(leading_int(F.col("id")).alias("id"), "n", F.struct("file", "ord").alias("at"))
    return e.groupBy("id").agg(F.max_by("n", "at").alias("n"))


#: A code line, a line that goes on with the description, and lines that say nothing.
CODE_LINE = r"^\s{0,6}([A-Z0-9]{1,3})\s{2,}(\S.*)$"
MORE_LINE = r"^\s{10,}\S.*$"
NO_LINE = r"^\*|^(?i)\s*(?:Desc|Repr|Note):"


_CODE, _MORE, _NO = re.compile(CODE_LINE, re.A), re.compile(MORE_LINE, re.A), re.compile(r"\*|(?i:\s*(?:Desc|Repr|Note):)", re.A)


def _entries(lines: Lines) -> Iterator[tuple[int, str, str, str]]:
    """Offset, code, name and description of the entries whose code line begins in the range; what goes on past its end is read on."""
    at, now, parts = lines.begin, None, []

    def kind(raw: bytes) -> tuple[re.Match | None, str]:
        line = raw.decode("utf-8", "replace").rstrip(BLANKS)
        return (None, "") if not line or _NO.match(line) else (_CODE.match(line), line)

    def done() -> tuple[int, str, str, str]:
        return *now, " ".join(parts).strip(BLANKS)

    own = lines.own()
    for raw in own[:-1].split(b"\n") if own.endswith(b"\n") else own.split(b"\n") if own else []:
        code, line = kind(raw)
        if code:
            if now:
                yield done()
            now, parts = (at, code[1], code[2].strip(BLANKS)), []
        elif now and _MORE.match(line):
            parts.append(line.strip(BLANKS))
        at += len(raw) + 1
    if now:
        for raw in lines.after():
            code, line = kind(raw)
            if code:
                break
            if _MORE.match(line):
                parts.append(line.strip(BLANKS))
        yield done()


def code_entries(spark: SparkSession, path: str, split_bytes: int = 8 << 20) -> DataFrame:
    """code_list, entry, code, name, description of text lists, one file ``<number>.txt`` per list; numbers under 1000 are skipped.

    A code line holds up to six blanks, a code of one to three capitals or digits, two blanks and the name. Lines that
    begin with ten blanks go on with the description. Empty lines, lines with a star in the first column, and Desc,
    Repr and Note lines in any case are skipped; other lines are ignored and end nothing.

    Files are read in byte ranges: an entry is the range's in which its code line begins, and ``entry``, where that
    line begins in the file, orders the entries of a list. The result is the same for every ``split_bytes``.
    """
    ranges = byte_ranges(spark, path, split_bytes, "*.txt").withColumn("code_list", leading_int(F.element_at(F.split("path", "/"), -1))).where("code_list >= 1000")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                lines = Lines(r["path"], r["begin"], r["end"], r["length"])
                found = list(_entries(lines))
                lines.close()
                if found:
                    entry, code, name, description = zip(*found, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array([r["code_list"]] * len(found), pa.int32()), pa.array(entry, pa.int64()), *(pa.array(c, pa.string()) for c in (code, name, description))], ["code_list", "entry", "code", "name", "description"])

    return ranges.mapInArrow(run, "code_list int, entry long, code string, name string, description string")


def words(spark: SparkSession, path: str, first_page: int = 1) -> DataFrame:
    """page, word_no, text, x, y of XHTML word boxes; the first page of a file has the number ``first_page``."""
    return xml(spark, path, "words").select((F.col("page") + first_page).alias("page"), "word_no", "text", "x", "y")


def ocr_texts(spark: SparkSession, path: str) -> DataFrame:
    """tag, field, ocr of files ``<tag>-<field>.txt`` that an OCR program wrote, white space squeezed. Reading images is no work for Spark."""
    name = F.regexp_extract(F.col("file"), r"^(\d+)-(\w+)\.txt$", 2)
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value")
    return files.select(leading_int(F.col("file")).alias("tag"), name.alias("field"), strip(F.regexp_replace("value", r"\s+", " ")).alias("ocr")).where("field <> ''")
