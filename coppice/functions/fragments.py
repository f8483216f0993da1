"""Joins the lines of wrapped cells: the one operator whose state a column expression can't carry readably."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _clean(word: str) -> str:
    return re.sub("[^a-z]", "", word.lower())


def known(word: str, strict: frozenset[str], loose: frozenset[str]) -> bool:
    """Whether a word merged over a line end is one of the vocabulary."""
    if "/" in word:
        return all(len(p) < 3 or p in strict or p in loose for p in map(_clean, word.split("/")))
    w = _clean(word)
    return len(w) >= 4 and w in strict


def join_fragments(fragments: list[str], strict: frozenset[str], loose: frozenset[str]) -> str | None:
    """Left fold; the first rule that holds for the text so far and the next piece decides how they meet."""
    pieces = [p for p in (f.strip() for f in fragments) if p]
    if not pieces:
        return None
    text = pieces[0]
    for piece in pieces[1:]:
        head, *tail = piece.split()
        rest = "".join(f" {w}" for w in tail)
        last = text.split()[-1]
        if text.endswith("/"):
            text += head + rest
        elif head[0] in ",.;:)" and not text.endswith(" "):
            text += piece
        elif re.search(r"\S-$", text) and re.match("[a-z0-9]", piece):
            text += head + rest
        elif re.match(r"-\d", piece) and text[-1].isdigit():
            text += piece
        elif re.fullmatch("[b-hj-z][,.]?", head) and re.search("[a-z]$", text):
            text += head + rest
        elif re.match("[a-z]", piece) and re.search("[a-z]$", text) and known(last + head, strict, loose):
            text = " ".join(text.split()) + head + rest
        else:
            text = f"{text} {piece}"
    return text


def asked_words(fragments: list[str]) -> list[str]:
    """All words that ``join_fragments`` could ask the vocabulary for, cleaned.

    What is merged so far ends in a chain of line ends: the last word of a line and, where lines are single words, all of those.
    """
    pieces = [p.split() for p in fragments if p.strip()]
    found: set[str] = set()
    for i in range(1, len(pieces)):
        chain, j = "", i - 1
        while True:
            chain = pieces[j][-1] + chain
            merged = chain + pieces[i][0]
            found.update(map(_clean, merged.split("/")))
            if len(pieces[j]) > 1 or j == 0:
                break
            j -= 1
    return sorted(w for w in found if len(w) >= 3)


def joined(cells: DataFrame, vocabulary: DataFrame, keys: list[str], fragments: str = "fragments", result: str = "text") -> DataFrame:
    """``keys`` and ``result``: the fragments of each cell joined; null for cells without any.

    ``vocabulary`` (word, strict, loose) may have any size: each cell gets only the words that it asks for, by a join.
    """

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def ask(s: pd.Series) -> pd.Series:
        return s.map(lambda x: asked_words([] if x is None else list(x)))

    @F.pandas_udf(T.StringType())
    def join(s: pd.Series, strict: pd.Series, loose: pd.Series) -> pd.Series:
        own = lambda x: frozenset(() if x is None else x)
        return pd.Series([join_fragments([] if f is None else list(f), own(a), own(b)) for f, a, b in zip(s, strict, loose, strict=True)], dtype=object)

    asked = cells.select(*keys, F.explode(ask(F.col(fragments))).alias("word")).join(vocabulary, "word")
    words = lambda c: F.collect_set(F.when(F.col(c) > 0, F.col("word")))
    answers = asked.groupBy(*keys).agg(words("strict").alias("__strict"), words("loose").alias("__loose"))
    return cells.join(answers, keys, "left").select(*keys, join(F.col(fragments), F.col("__strict"), F.col("__loose")).alias(result))
