"""Notation, bridge and zone parsers as column expressions: no Python runs on the executors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import SCHEMES, ZONE
from .text import let, strip

_NOTATION = r"^(an|a|n)(\.\.)?(\d+)$"
#: Marks that no printed text holds.
_A, _B = "\u0001", "\u0002"
_DETAIL = r"\b(?:an|a|n)(?:\.\.)?\d+\b|\b[LP] \d+(?:\s*-\s*\d+)?\b"


def notation(c: Column) -> Column:
    """struct(raw, charset, min_length, max_length) of ``an..35``, ``n3`` and the like; null where it does not parse."""
    s = strip(c)
    n = F.regexp_extract(s, _NOTATION, 3).try_cast("int")
    least = F.when(F.regexp_extract(s, _NOTATION, 2) == "..", 1).otherwise(n)
    return F.when(s.rlike(_NOTATION), F.struct(s.alias("raw"), F.regexp_extract(s, _NOTATION, 1).alias("charset"), least.alias("min_length"), n.alias("max_length")))


def fixed_length(representation: Column) -> Column:
    return representation.min_length == representation.max_length


def bridges(c: Column) -> Column:
    """array<struct<scheme, detail>>: the text after each known scheme and colon; leading text goes.

    Without any marker, a scheme at the start followed by white space opens the only entry.
    """
    names = "|".join(SCHEMES)
    lone = rf"^({names})\s+([\s\S]+)$"
    alone = F.array(F.struct(F.regexp_extract(c, lone, 1).alias("scheme"), F.regexp_extract(c, lone, 2).alias("detail")))
    none = F.array().cast("array<struct<scheme:string,detail:string>>")
    # The text is cut once; each part after a mark is a scheme, a second mark and its detail.
    entry = lambda x: let(F.split(x, _B), lambda y: F.struct(F.get(y, F.lit(0)).alias("scheme"), strip(F.get(y, F.lit(1))).alias("detail")))
    cut = F.split(F.regexp_replace(c, f"({names}):", f"{_A}$1{_B}"), _A)
    found = let(cut, lambda x: F.when(F.size(x) > 1, F.transform(F.slice(x, 2, F.size(x)), entry)).when(c.rlike(lone), alone).otherwise(none))
    return F.when(c.isNull(), none).otherwise(found)


def segments(detail: Column) -> Column:
    """array<struct<kind, text, from, to>> of a detail: format, lines, positions and text tokens, in order."""
    # A token begins with the second mark, so that no text between tokens is taken for one.
    cut = F.split(F.regexp_replace(detail, f"({_DETAIL})", f"{_A}{_B}$1{_A}"), _A)
    kept = F.filter(F.transform(cut, strip), lambda t: t != "")

    def span(t: Column) -> Column:
        kind = F.when(F.substring(t, 2, 1) == "L", "lines").otherwise("positions")
        ends = F.split(F.substring(t, 4, 1 << 20), "-")
        number = lambda e, i: strip(F.get(e, F.lit(i))).try_cast("int")
        return let(ends, lambda e: F.struct(kind.alias("kind"), F.lit(None).cast("string").alias("text"), number(e, 0).alias("from"), number(e, 1).alias("to")))

    def plain(kind: str, text: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), text.alias("text"), F.lit(None).cast("int").alias("from"), F.lit(None).cast("int").alias("to"))

    def one(t: Column) -> Column:
        token = F.substring(t, 1, 1) == _B
        return F.when(~token, plain("text", t)).when(F.substring(t, 2, 1).isin("L", "P"), span(t)).otherwise(plain("format", F.substring(t, 2, 1 << 20)))

    return F.when(detail.isNotNull(), F.transform(kept, one))


def unglued(detail: Column) -> Column:
    """``L15`` to ``L 15`` and ``p 74`` to ``P 74``."""
    d = F.regexp_replace(detail, r"\b([LP])(?=\d)", "$1 ")
    return F.regexp_replace(F.regexp_replace(d, r"\bl(?=\s+\d)", "L"), r"\bp(?=\s+\d)", "P")


def zones(detail: Column) -> Column:
    """array of zones: a fold over the tokens with a pending line span and a format that sticks until a zone closes by positions."""
    none = F.array().cast(f"array<{ZONE}>")
    null = F.lit(None).cast("int")
    state = F.struct(none.alias("zones"), null.alias("line_from"), null.alias("line_to"), F.lit(None).cast("string").alias("format"))

    def zone(s: Column, a: Column, b: Column) -> Column:
        return F.array(F.struct(s.line_from.alias("line_from"), s.line_to.alias("line_to"), a.alias("pos_from"), b.alias("pos_to"), s["format"].alias("format")))

    def flushed(s: Column) -> Column:
        return F.when(s.line_from.isNotNull(), F.concat(s.zones, zone(s, F.lit(1), F.lit(82)))).otherwise(s.zones)

    def step(s: Column, t: Column) -> Column:
        a, b = t["from"], F.coalesce(t["to"], t["from"])
        opened = F.struct(flushed(s).alias("zones"), a.alias("line_from"), b.alias("line_to"), s["format"].alias("format"))
        closed = F.struct(F.concat(s.zones, zone(s, F.greatest(F.lit(1), a), F.greatest(F.lit(1), b))).alias("zones"), null.alias("line_from"), null.alias("line_to"), F.lit(None).cast("string").alias("format"))
        noted = F.struct(s.zones.alias("zones"), s.line_from.alias("line_from"), s.line_to.alias("line_to"), t.text.alias("format"))
        return F.when(t.kind == "lines", opened).when((t.kind == "positions") & s.line_from.isNotNull(), closed).when(t.kind == "format", noted).otherwise(s)

    return F.coalesce(F.aggregate(segments(unglued(detail)), state, step, flushed), none)


def first_zones(bridge_text: Column, scheme: str = "UNLK") -> Column:
    """Zones of the first entry of ``scheme`` only."""
    own = F.get(F.filter(bridges(bridge_text), lambda e: e.scheme == scheme), F.lit(0))
    return F.coalesce(let(own.detail, zones), F.array().cast(f"array<{ZONE}>"))


def code_references(name: Column, description: Column) -> Column:
    """array<struct<kind, tag>>: a bracketed number that begins the description, else the name, equals; others in brackets, then those of 1000 or more in parentheses, are related; each tag once."""
    d, n = F.coalesce(description, F.lit("")), F.coalesce(name, F.lit(""))
    lead = r"^\[(\d{4})\]"
    first = F.coalesce(F.nullif(F.regexp_extract(d, lead, 1), F.lit("")), F.nullif(F.regexp_extract(n, lead, 1), F.lit("")))
    text = F.concat(n, F.lit(" "), d)
    kinds = lambda a, k: F.transform(a, lambda x: F.struct(F.lit(k).alias("kind"), x.cast("int").alias("tag")))
    round_ = F.filter(F.regexp_extract_all(text, F.lit(r"\((\d{4})\)"), F.lit(1)), lambda x: x.cast("int") >= 1000)
    every = F.concat(kinds(F.array_compact(F.array(first)), "equals"), kinds(F.regexp_extract_all(text, F.lit(r"\[(\d{4})\]"), F.lit(1)), "related"), kinds(round_, "related"))
    own = lambda a: lambda seen: F.filter(a, lambda x, i: F.array_position(seen, x.tag) == i + 1)
    return let(every, lambda a: let(F.transform(a, lambda x: x.tag), own(a)))
