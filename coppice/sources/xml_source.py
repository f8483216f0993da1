"""XML files as a Python data source: a partition per file, read through a pull parser that never holds the document.

A file is fed to the parser a piece at a time and rows leave as their elements end, so memory does not grow with the
file. Rows carry their place in document order.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.entities import html5
from xml.parsers import expat

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from .paths import listed, streamed

SCHEMAS = {
    "elements": "file string, ord long, id string, name string, desc string, type string, maxlength string",
    "codes": "file string, ord long, id string, n int",
    "words": "file string, page int, word_no int, text string, x double, y double",
}
_PIECE = 1 << 16


class _Rows:
    """Takes the parser's events and makes rows of one kind."""

    def __init__(self) -> None:
        self.rows: list[tuple] = []
        self.ord = 0

    def put(self, *row) -> None:
        self.rows.append(row)
        self.ord += 1

    def start(self, name: str, attributes: dict[str, str]) -> None: ...

    def end(self, name: str) -> None: ...

    def text(self, data: str) -> None: ...


class Elements(_Rows):
    """``data_element`` at any depth with its attributes."""

    def start(self, name: str, attributes: dict[str, str]) -> None:
        if name == "data_element":
            self.put(self.ord, *(attributes.get(a) for a in ("id", "name", "desc", "type", "maxlength")))


class Codes(_Rows):
    """``data_element`` right under the root ``data_elements`` with the number of ``code`` right under it."""

    def __init__(self) -> None:
        super().__init__()
        self.above: list[str] = []
        self.id, self.n = None, 0

    def start(self, name: str, attributes: dict[str, str]) -> None:
        if self.above == ["data_elements"] and name == "data_element":
            self.id, self.n = attributes.get("id"), 0
        elif self.above == ["data_elements", "data_element"] and name == "code":
            self.n += 1
        self.above.append(name)

    def end(self, name: str) -> None:
        self.above.pop()
        if self.above == ["data_elements"] and name == "data_element":
            self.put(self.ord, self.id, self.n)


class Words(_Rows):
    """``word`` within a ``page``: the page's number in the file, the word's on the page, its text and upper left corner."""

    def __init__(self) -> None:
        super().__init__()
        self.page, self.word, self.box = -1, 0, None
        self.parts: list[str] = []

    def start(self, name: str, attributes: dict[str, str]) -> None:
        if name == "page":
            self.page, self.word = self.page + 1, 0
        elif name == "word" and self.page >= 0:
            self.box, self.parts = (_number(attributes.get("xMin")), _number(attributes.get("yMin"))), []

    def text(self, data: str) -> None:
        if self.box is not None:
            self.parts.append(data)

    def end(self, name: str) -> None:
        if name == "word" and self.box is not None:
            self.put(self.page, self.word, "".join(self.parts), *self.box)
            self.word, self.box = self.word + 1, None


def _number(text: str | None) -> float | None:
    try:
        return float(text)
    except (TypeError, ValueError):
        return None


KINDS = {"elements": Elements, "codes": Codes, "words": Words}


def rows_of(stream, kind: str) -> Iterator[tuple]:
    """The rows of one document; ``stream`` has ``read``. One that is not well-formed is an error where it breaks off.

    Named references that only a document type would declare are those of HTML; nothing outside of the file is read.
    """
    own, parser = KINDS[kind](), expat.ParserCreate()
    parser.buffer_text = True
    parser.UseForeignDTD(True)
    parser.SetParamEntityParsing(expat.XML_PARAM_ENTITY_PARSING_ALWAYS)
    parser.ExternalEntityRefHandler = lambda *_: 1
    parser.SkippedEntityHandler = lambda name, is_parameter: None if is_parameter else own.text(html5.get(f"{name};", ""))
    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = own.start, own.end, own.text
    while True:
        piece = stream.read(_PIECE)
        parser.Parse(piece, not piece)
        yield from own.rows
        own.rows.clear()
        if not piece:
            return


class XmlSource(DataSource):
    """``format("coppice_xml")``: option ``path`` is a folder, a file or a pattern, ``kind`` is elements, codes or words."""

    @classmethod
    def name(cls) -> str:
        return "coppice_xml"

    def schema(self) -> str:
        return SCHEMAS[self.options["kind"]]

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options["path"], self.options["kind"])


class _Reader(DataSourceReader):
    def __init__(self, path: str, kind: str) -> None:
        self.path, self.kind = path, kind

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(f) for f in listed(self.path, "")]

    def read(self, partition: InputPartition | None) -> Iterator[tuple]:
        if partition is None:  # Spark asks once where there is no file
            return
        name = partition.value.rpartition("/")[2]
        with streamed(partition.value) as f:
            for row in rows_of(f, self.kind):
                yield name, *row


def xml(spark: SparkSession, path: str, kind: str) -> DataFrame:
    spark.dataSource.register(XmlSource)
    return spark.read.format("coppice_xml").option("path", path).option("kind", kind).load()
