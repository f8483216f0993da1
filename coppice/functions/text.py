"""Scalar text functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = " \t\n\r\f\v"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def null_if_blank(c: Column, placeholder: str = ".") -> Column:
    """Null for a blank text or the printed placeholder."""
    s = strip(c)
    return F.when((s != "") & (s != placeholder), c)


def normal_name(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), "[^a-z0-9]", "")


def normal_description(c: Column) -> Column:
    return F.btrim(F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9 ]", ""), " +", " "))


def similarity(a: Column, b: Column, empty_is_zero: bool = False) -> Column:
    """1 - edit distance / longer length; equal texts have 1; with ``empty_is_zero`` else an empty side gives 0."""
    s = F.when(a == b, 1.0)
    if empty_is_zero:
        s = s.when((F.length(a) == 0) | (F.length(b) == 0), 0.0)
    return s.otherwise(1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b)))


def leading_int(c: Column) -> Column:
    """The number that a text begins with, else 0."""
    return F.coalesce(F.regexp_extract(c, r"^\s*([+-]?\d+)", 1).try_cast("int"), F.lit(0))


def clean_word(c: Column) -> Column:
    """Lower-case letters only; null under three of them."""
    w = F.regexp_replace(F.lower(c), "[^a-z]", "")
    return F.when(F.length(w) >= 3, w)


def capitalised(c: Column) -> Column:
    """Only the first character upper-cased."""
    return F.concat(F.upper(F.substring(c, 1, 1)), F.substring(c, 2, 1 << 30))


def name_tail(c: Column) -> Column:
    """What follows the last point, unstripped; trailing empty parts don't count."""
    return F.element_at(F.split(F.regexp_replace(c, r"\.+$", ""), r"\."), -1)


def compact(*cols: Column) -> Column:
    """Array of the values that are not null; null if there are none."""
    a = F.array_compact(F.array(*cols))
    return F.when(F.size(a) > 0, a)


def header(section: Column, range_: Column, label: Column) -> Column:
    return F.format_string("%s (%s) %s", section, range_, label)


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))
