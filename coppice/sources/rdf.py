r"""Graphs written as N-Triples or Turtle, read in splits.

N-Triples have a statement a line, so Spark's text source splits them. Turtle has statements over many lines, prefixes
that hold from where they stand, and texts with line ends in triple quotes. So it is read in two passes over byte ranges
that begin at lines. The first finds for each range how it leaves a reader who enters it outside of texts, in a text of
double or in one of single quotes: in what text it ends, whether a statement ends there, and which prefixes it sets.
Entries then follow from range to range along a file, and the second pass parses: a range owns the statements that begin
in it and reads on to finish the last one.

Both give s, p, o, kind (iri, blank, string, integer, or typed and language with ``detail``, the type's IRI or the
language). Labels of blank nodes stay as they are, so the files of one path are parts of one document; blank nodes
without a label get one from their file and place.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .ranges import Lines, apart, byte_ranges

RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
XSD = "http://www.w3.org/2001/XMLSchema#"
STATEMENT = "s string, p string, o string, kind string, detail string"
_NAMES = ["s", "p", "o", "kind", "detail"]

_LOCAL = r"(?:[\w:]|%[0-9A-Fa-f]{2}|\\[_~.\-!$&'()*+,;=/?#@%])(?:(?:[\w:.\-]|%[0-9A-Fa-f]{2}|\\[_~.\-!$&'()*+,;=/?#@%])*(?:[\w:\-]|%[0-9A-Fa-f]{2}|\\[_~.\-!$&'()*+,;=/?#@%]))?"
_TOKEN = re.compile(
    rf"""(?sx)(?P<space>\s+|\#[^\n]*)
    |(?P<iri><(?:[^<>"{{}}|^`\\\x00-\x20]|\\u[0-9A-Fa-f]{{4}}|\\U[0-9A-Fa-f]{{8}})*>)
    |(?P<long>\"\"\"(?:"{{0,2}}(?:[^"\\]|\\.))*+\"\"\"|'''(?:'{{0,2}}(?:[^'\\]|\\.))*+''')
    |(?P<open>\"\"\"|''')
    |(?P<short>"(?:[^"\\\n\r]|\\.)*+"|'(?:[^'\\\n\r]|\\.)*+')
    |(?P<blank>_:\w(?:[\w.\-]*[\w\-])?)
    |(?P<name>(?:[^\W\d_](?:[\w.\-]*[\w\-])?)?:(?:{_LOCAL})?)
    |(?P<number>[+-]?(?:\d+\.\d*[eE][+-]?\d+|\.?\d+[eE][+-]?\d+|\d*\.\d+|\d+))
    |(?P<at>@[A-Za-z]+(?:-[A-Za-z0-9]+)*)
    |(?P<mark>\^\^|[;,.\[\]()])
    |(?P<word>[A-Za-z]+)"""
)
_CLOSE = {1: re.compile(r'(?s)(?:"{0,2}(?:[^"\\]|\\.))*+"""'), 2: re.compile(r"(?s)(?:'{0,2}(?:[^'\\]|\\.))*+'''")}
_ESCAPE = re.compile(r"""(?s)\\(?:u([0-9A-Fa-f]{4})|U([0-9A-Fa-f]{8})|(.))""")
_SHORT = {"t": "\t", "b": "\b", "n": "\n", "r": "\r", "f": "\f"}

Token = tuple[str, str, int]


def unescaped(text: str) -> str:
    return _ESCAPE.sub(lambda m: chr(int(m[1] or m[2], 16)) if m[1] or m[2] else _SHORT.get(m[3], m[3]), text) if "\\" in text else text


def tokens(text: str, at: int = 0) -> Iterator[Token]:
    """Kind, text and place of the tokens from ``at``; a text without its end is ``open`` and the last one."""
    while at < len(text):
        m = _TOKEN.match(text, at)
        if m is None:
            raise ValueError(f"not Turtle: {text[at : at + 60]!r}")
        if m.lastgroup != "space":
            yield m.lastgroup, m[0], at
            if m.lastgroup == "open":
                return
        at = m.end()


def _directive(held: list[Token]) -> tuple[int, tuple[str, str] | None] | None:
    """How many tokens a directive at the head of ``held`` has, and what it sets; None if there is none."""
    kind, word, _ = held[0]
    name = word.lower().lstrip("@")
    if (kind, name) not in {("at", "prefix"), ("at", "base"), ("word", "prefix"), ("word", "base")}:
        return None
    n = (3 if name == "prefix" else 2) + (kind == "at")
    if len(held) < n:
        return n, None
    return n, ((held[1][1][:-1], unescaped(held[2][1][1:-1])) if name == "prefix" else ("@base", unescaped(held[1][1][1:-1])))


def statements(text: str, at: int, end: int, whole: bool) -> Iterator[tuple[list[Token], tuple[str, str] | None] | None]:
    """The statements that begin in [at, end), each with what it sets if it is a directive; None if the last one goes on past ``text``, which does not happen if ``whole``."""
    held: list[Token] = []
    for t in tokens(text, at):
        if not held and t[2] >= end:
            return
        held.append(t)
        if t[0] == "open":
            break
        if len(held) == 1:
            directs = t[0] in ("at", "word") and _directive(held) is not None
        if directs:
            own = _directive(held)
            if len(held) == own[0]:
                yield held, own[1]
                held = []
        elif t[1] == "." and t[0] == "mark":
            yield held, None
            held = []
    if held:
        if whole:
            raise ValueError(f"a statement without its end: {text[held[0][2] : held[0][2] + 60]!r}")
        yield None


def _entered(text: str, state: int, skip: int) -> int | None:
    """Where the first statement can begin for a reader who enters in a text (1, 2) or amid a statement (``skip`` -1: up to its end, else so many tokens)."""
    at = 0
    if state:
        m = _CLOSE[state].match(text)
        if m is None:
            return None
        at = m.end()
    if skip:
        for t in tokens(text, at):
            if t[0] == "open":
                return None
            skip -= skip > 0
            if not skip or (skip < 0 and t[:2] == ("mark", ".")):
                return t[2] + len(t[1])
        return None
    return at


def leaves(text: str, end: int, state: int) -> tuple[int, int, int, list[tuple[str, str]]]:
    """How a reader who enters ``text`` in ``state`` leaves [0, ``end``): in what text, amid what (as ``skip``), after how many tokens (3 at most), with which prefixes set.

    ``skip`` is right for all entries amid a statement but those that miss tokens of a directive: see ``onward``.
    """
    at, n, skip = 0, 0, 0
    if not state and (plain := _left_plainly(text, end)) is not None:
        return plain
    if state:
        m = _CLOSE[state].match(text)
        if m is None or m.end() > end:
            return state, -1, 3, []
        at, n, skip = m.end(), 3, -1
    sets: list[tuple[str, str]] = []
    held: list[Token] = []
    for t in _readable(text, at):
        over = t[2] >= end
        if over and not (held and skip > 0):
            break
        if t[0] == "open" or (t[0] == "long" and t[2] + len(t[1]) > end and not over):
            return (1 if t[1][0] == '"' else 2), -1, 3, sets
        held.append(t)
        own = _directive(held)
        if own is None:
            held, skip = [], 0 if t[:2] == ("mark", ".") else -1
        elif len(held) == own[0]:
            sets.append(own[1])
            held = []
            if over:  # the directive began here, the reader who comes after has its last tokens before him
                break
            skip = 0
        elif not over:
            skip = own[0] - len(held)
        n = min(3, n + (not over))
    return 0, skip, n, sets


#: What a directive has, and texts over many lines.
_UNPLAIN = re.compile(r"(?i)prefix|base|\"\"\"|'''")


def _left_plainly(text: str, end: int) -> tuple[int, int, int, list] | None:
    """``leaves`` for a reader outside of texts where [0, ``end``) has neither directives nor texts over lines; None elsewhere.

    Every line then begins between tokens, so the first tokens and the last line that has any tell all.
    """
    if _UNPLAIN.search(text, 0, end):
        return None
    n = 0
    for t in _readable(text, 0):
        if t[2] >= end or n == 3:
            break
        n += 1
    stop = end
    while n and stop > 0:
        begin = text.rfind("\n", 0, stop - 1) + 1
        last = None
        for t in _readable(text[begin:stop], 0):
            last = t
        if last is not None:
            return 0, 0 if last[:2] == ("mark", ".") else -1, n, []
        stop = begin
    return 0, 0, n, []


def _readable(text: str, at: int) -> Iterator[Token]:
    """The tokens up to what is none: a reader who does not in fact enter here may find anything."""
    try:
        yield from tokens(text, at)
    except ValueError:
        return


def onward(entry: tuple[int, int], found: list[tuple[int, int, int, list]]) -> tuple[int, int]:
    """Text and skip with which the next range is entered; ``found`` are the ``leaves`` of this one for each text."""
    text, skip, n, _ = found[entry[0]]
    if not text and not entry[0] and (n == 0 or (entry[1] > 0 and n <= entry[1])):
        return 0, entry[1] - n if entry[1] > 0 else entry[1]
    return text, skip


class Parser:
    """Triples of one statement. ``place`` makes the labels of blank nodes without one."""

    def __init__(self, prefixes: dict[str, str], place: str) -> None:
        self.prefixes, self.place, self.made, self.out = prefixes, place, 0, []

    def statement(self, held: list[Token]) -> list[tuple]:
        self.held, self.at, self.out = held, 0, []
        if held[0][:2] == ("mark", "[") and not (len(held) > 1 and held[1][1] == "]"):
            s = self.term()
            if self.now() != ".":
                self.predicates(s)
        else:
            self.predicates(self.term())
        if self.now() != "." or self.at != len(held) - 1:
            raise ValueError(f"not Turtle: {' '.join(t[1] for t in held)[:80]!r}")
        return self.out

    def now(self) -> str:
        return self.held[self.at][1]

    def put(self, s: tuple, p: str, o: tuple) -> None:
        self.out.append((s[0], p, *o))

    def fresh(self) -> tuple:
        self.made += 1
        return f"_:{self.place}n{self.made}", "blank", None

    def iri(self, kind: str, word: str) -> str:
        if kind == "iri":
            found = unescaped(word[1:-1])
            return urljoin(self.prefixes["@base"], found) if "@base" in self.prefixes else found
        prefix, _, local = word.partition(":")
        if prefix not in self.prefixes:
            raise ValueError(f"unknown prefix: {word!r}")
        return self.prefixes[prefix] + re.sub(r"\\(.)", r"\1", local)

    def term(self) -> tuple:
        """Text, kind and detail of a subject or object."""
        kind, word, _ = self.held[self.at]
        self.at += 1
        if kind in ("iri", "name"):
            return self.iri(kind, word), "iri", None
        if kind == "blank":
            return word, "blank", None
        if kind in ("short", "long"):
            return self.literal(unescaped(word[3:-3] if kind == "long" else word[1:-1]))
        if kind == "number":
            typed = "double" if "e" in word.lower() else "decimal" if "." in word else "integer"
            return (word, "integer", None) if typed == "integer" else (word, "typed", XSD + typed)
        if word in ("true", "false"):
            return word, "typed", f"{XSD}boolean"
        if word == "[":
            own = self.fresh()
            if self.now() != "]":
                self.predicates(own)
            self.at += 1
            return own
        if word == "(":
            return self.collection()
        raise ValueError(f"not a term: {word!r}")

    def literal(self, text: str) -> tuple:
        kind, word, _ = self.held[self.at]
        if kind == "at":
            self.at += 1
            return text, "language", word[1:]
        if word != "^^":
            return text, "string", None
        kind, word, _ = self.held[self.at + 1]
        self.at += 2
        full = self.iri(kind, word)
        return {f"{XSD}string": (text, "string", None), f"{XSD}integer": (text, "integer", None)}.get(full, (text, "typed", full))

    def collection(self) -> tuple:
        first = last = None
        while self.now() != ")":
            item = self.term()
            cell = self.fresh()
            if last is None:
                first = cell
            else:
                self.put(last, f"{RDF}rest", cell)
            self.put(cell, f"{RDF}first", item)
            last = cell
        self.at += 1
        none = (f"{RDF}nil", "iri", None)
        if last is None:
            return none
        self.put(last, f"{RDF}rest", none)
        return first

    def predicates(self, s: tuple) -> None:
        while True:
            kind, word, _ = self.held[self.at]
            p = f"{RDF}type" if (kind, word) == ("word", "a") else self.iri(kind, word)
            self.at += 1
            while True:
                self.put(s, p, self.term())
                if self.now() != ",":
                    break
                self.at += 1
            while self.now() == ";":
                self.at += 1
                if self.now() in (".", "]", ";"):
                    if self.now() != ";":
                        return
                    continue
                break
            else:
                return


def _batches(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows, strict=True)], _NAMES)


def n_triples(spark: SparkSession, path: str) -> DataFrame:
    """s, p, o, kind, detail of N-Triples files; a line that is neither a statement nor empty is an error."""

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [x for line in batch.column("value").to_pylist() if (held := list(tokens(line))) for x in Parser({}, "").statement(held)]
            if rows:
                yield _batches(rows)

    return spark.read.text(path).mapInArrow(parsed, STATEMENT)


#: How far a range reads on at once to finish a statement.
_STEP = 1 << 16


def _extended(lines: Lines, end: int, use):
    """``use(text, whole)`` with as much text past the range as it needs: it gives None for more."""
    n = _STEP
    own = lines.text()
    while True:
        whole = lines.end + n >= lines.length
        found = use(own + lines.more(n), len(own), whole)
        if found is not None:
            return found
        n *= 4


def turtle(spark: SparkSession, path: str, split_bytes: int = 8 << 20, pattern: str | None = "*.ttl") -> DataFrame:
    """s, p, o, kind, detail of Turtle files, the same for every ``split_bytes``. Empty files give no rows.

    Prefixes of a file travel with each of its ranges, so they must be few; statements must fit a task's memory.
    """
    ranges = byte_ranges(spark, path, split_bytes, pattern)
    summary = "path string, begin long, end long, length long, texts array<int>, skips array<int>, tokens array<int>, sets array<array<struct<prefix:string,iri:string>>>"

    schema = to_arrow_schema(StructType.fromDDL(summary))

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                lines = Lines(r["path"], r["begin"], r["end"], r["length"])
                own = lines.text()
                tail = lines.more(_STEP)
                lines.close()
                quotes = '"""' in own or "\'\'\'" in own
                # Without triple quotes a reader in a text stays in it.
                found = [leaves(own + tail, len(own), s) if own and (s == 0 or quotes) else (s, -1 if s else 0, 3 if s else 0, []) for s in range(3)]
                out.append(r | {"texts": [f[0] for f in found], "skips": [f[1] for f in found], "tokens": [f[2] for f in found], "sets": [[{"prefix": p, "iri": i} for p, i in f[3]] for f in found]})
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)

    entry_ddl = "path string, begin long, end long, length long, text int, skip int, prefixes map<string,string>"
    entry_schema = to_arrow_schema(StructType.fromDDL(entry_ddl))

    def entered(t: pa.Table) -> pa.Table:
        entry, prefixes, out = (0, 0), {}, []
        for r in sorted(t.to_pylist(), key=lambda r: r["begin"]):
            out.append({k: r[k] for k in ("path", "begin", "end", "length")} | {"text": entry[0], "skip": entry[1], "prefixes": list(prefixes.items())})
            found = list(zip(r["texts"], r["skips"], r["tokens"], r["sets"], strict=True))
            prefixes |= {x["prefix"]: x["iri"] for x in found[entry[0]][3]}
            entry = onward(entry, found)
        return pa.Table.from_pylist(out, entry_schema)

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                lines = Lines(r["path"], r["begin"], r["end"], r["length"])
                rows = _extended(lines, r["end"], lambda text, end, whole, r=r | {"first": lines.begin}: _range_rows(text, end, whole, r))
                lines.close()
                for i in range(0, len(rows), 1 << 14):
                    yield _batches(rows[i : i + (1 << 14)])

    entries = ranges.mapInArrow(summed, summary).groupBy("path").applyInArrow(entered, entry_ddl)
    return apart(entries, ranges.rdd.getNumPartitions()).mapInArrow(parsed, STATEMENT)


def _range_rows(text: str, end: int, whole: bool, r: dict) -> list[tuple] | None:
    """The triples of the statements that begin in a range of which ``text`` has all and more; None if more is needed."""
    at = _entered(text, r["text"], r["skip"])
    if at is None:
        return [] if whole or end < len(text) else None
    if at >= end:
        return []
    prefixes = dict(r["prefixes"])
    rows: list[tuple] = []
    name = f"f{zlib.crc32(r['path'].rpartition('/')[2].encode()):08x}"
    for found in statements(text, at, end, whole):
        if found is None:
            return None
        held, sets = found
        if sets is not None:
            prefixes[sets[0]] = sets[1]
        elif _directive(held) is None:
            # Only a statement with brackets makes labels, from its byte in the file.
            bare = any(t[0] == "mark" and t[1] in "[(" for t in held)
            rows += Parser(prefixes, f"{name}b{r['first'] + len(text[: held[0][2]].encode())}" if bare else "").statement(held)
    return rows
