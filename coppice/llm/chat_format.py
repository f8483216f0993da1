r"""Chat formatting by prefix-target expansion: every assistant turn is an example of its own.

An example's context is all that precedes the reply in its conversation, and the reply alone is trainable. Turns are
formatted once, a piece for each, with their places in the conversation's text (``pieces``). ``expanded`` then makes the
examples: each holds all pieces of its prefix and its target, a row each, so that none must fit a row and those of a long
conversation, n * n / 4 pieces, spread over tasks. Nothing is cut. ``examples`` gives their places alone.

A piece is ``### role: text</turn>`` and a line end. In texts a backslash goes before each backslash and ``#``, and into
``</turn>`` before its stroke, in roles before colons too; so no mark of the template occurs in a text, not even behind
a backslash, and ``unescaped`` gives back what was written.

Turns are dealt by ranges of (conversation, turn), so a long conversation spreads over tasks; where a range begins
within a conversation, the number of turns and characters before it comes from the ranges before, a row for each range.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.scan import PART, carried, ordered
from .shared import numbered

OPEN, MIDDLE, CLOSE = "### ", ": ", "</turn>\n"

#: A piece: role and text as written.
_PIECE = re.compile(r"(?s)### ((?:[^\\<#:]++|\\.|<(?!/turn>))*+): ((?:[^\\<#]++|\\.|<(?!/turn>))*+)</turn>\n")


def escaped(c: Column, role: bool = False) -> Column:
    for mark, safe in (("\\", "\\\\"), ("#", "\\#"), ("</turn>", "<\\/turn>"), *([(":", "\\:")] if role else [])):
        c = F.replace(c, F.lit(mark), F.lit(safe))
    return c


def unescaped(text: str) -> str:
    return re.sub(r"(?s)\\(.)", r"\1", text) if "\\" in text else text


def parse(piece: str) -> tuple[str, str]:
    """Role and text as written of one piece."""
    found = _PIECE.fullmatch(piece)
    if found is None:
        raise ValueError(f"no piece of the template: {piece[:80]!r}")
    return unescaped(found[1]), found[2]


def turns(conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, turn, role, text: null roles and texts are empty."""
    return numbered(conversations.select(F.col(key).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), F.col(text).alias("text")), "text")


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A sorted range with ``n`` and ``end``: a row's place in its conversation and where its piece ends, both counted within the range."""
    now, n, end = object(), 0, 0
    for batch in batches:
        places, ends = [], []
        for k, size in zip(batch.column("conv_id").to_pylist(), batch.column("size").to_pylist(), strict=True):
            if k != now:
                now, n, end = k, 0, 0
            places.append(n)
            n, end = n + 1, end + size
            ends.append(end)
        names = [x for x in batch.schema.names if x not in ("n", "end")]
        yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in names), pa.array(places, pa.int64()), pa.array(ends, pa.int64())], [*names, "n", "end"])


def pieces(conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", target: str = "assistant") -> DataFrame:
    """conv_id, n (place of the turn, from 0), piece, start, reply_start, reply_end of all turns.

    ``start`` is where the piece begins in the conversation's text, in code points; the last two are null unless the
    role is ``target``. Turns go by ``turn``, nulls first; rows that share one go by role, then by a hash of their text,
    so the order does not hang on the files. Null roles and texts are empty, a null key is a conversation of its own,
    repeated rows are turns of their own, extra columns are not read, and an empty table gives no rows.
    """
    s = turns(conversations, key, turn, role, text)
    head, body = F.concat(F.lit(OPEN), escaped(F.col("role"), role=True), F.lit(MIDDLE)), escaped(F.col("text"))
    s = s.select("conv_id", "turn", "role", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("row"), F.length(head).alias("a"), F.length(body).alias("b"), F.concat(head, body, F.lit(CLOSE)).alias("piece"))
    s = s.withColumn("size", F.col("a") + F.col("b") + len(CLOSE))

    def placed(d: DataFrame) -> DataFrame:
        d = d.select("conv_id", PART, (F.col("role") == target).alias("trained"), "a", "b", "size", "piece")
        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in d.schema)
        return d.mapInArrow(_places, f"{kinds}, n long, `end` long")

    s = ordered(s, ["conv_id"], ["turn", "role", "h", "row"], within=placed)
    sums = s.groupBy(PART, "conv_id").agg(F.count("*").alias("turns"), F.sum("size").alias("chars"))
    before = Window.partitionBy("conv_id").orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    carry = sums.select(PART, "conv_id", F.sum("turns").over(before).alias("turns"), F.sum("chars").over(before).alias("chars")).where("turns IS NOT NULL")
    s = carried(s, carry, ["conv_id"])
    start = F.coalesce("chars", F.lit(0)) + F.col("end") - F.col("size")
    s = s.select("conv_id", (F.coalesce("turns", F.lit(0)) + F.col("n")).alias("n"), "piece", start.alias("start"), "trained", "a", "b")
    at = lambda x: F.when(F.col("trained"), x)
    return s.select("conv_id", "n", "piece", "start", at(F.col("start") + F.col("a")).alias("reply_start"), at(F.col("start") + F.col("a") + F.col("b")).alias("reply_end"))


def examples(formatted: DataFrame) -> DataFrame:
    """conv_id, example (from 0, the turn's place), context_end, reply_start, reply_end: a row for each assistant turn of ``pieces``.

    The example reads the conversation's text from 0 to ``reply_end``; its context ends with the mark that opens the
    reply, at ``reply_start``.
    """
    return formatted.where("reply_start IS NOT NULL").select("conv_id", F.col("n").alias("example"), F.col("start").alias("context_end"), "reply_start", "reply_end")


def per_conversation(rows: DataFrame, columns: list[str], fold: Callable[[], tuple[Callable, Callable]], schema: str, key: str = "conv_id", order: list[str] | None = None) -> DataFrame:
    """A row for each conversation, folded over its rows in order, batch after batch: memory does not grow with a conversation.

    ``fold()`` gives ``add(*values)`` and ``end()``, the columns of the result but the key. A digest of a text must be
    taken in order, so a long conversation is one task's work here; nothing but digests is made this way.
    """
    kind = rows.schema[key].dataType
    dealt = rows.select(key, *(order or []), *[c for c in columns if c not in (order or [])]).repartition(F.col(key)).sortWithinPartitions(key, *(order or []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = [f.name for f in out_schema], [f.type for f in out_schema]
        now, begun, done = None, False, []
        add = end = None
        for batch in batches:
            for k, *values in zip(batch.column(key).to_pylist(), *(batch.column(c).to_pylist() for c in columns), strict=True):
                if not begun or k != now:
                    if begun:
                        done.append((now, *end()))
                    now, begun, (add, end) = k, True, fold()
                add(*values)
            if len(done) >= 4096:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), kinds, strict=True)], names)
                done = []
        if begun:
            done.append((now, *end()))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), kinds, strict=True)], names)

    from pyspark.sql.pandas.types import to_arrow_schema

    out_schema = to_arrow_schema(rows.sparkSession.createDataFrame([], f"`{key}` {kind.simpleString()}, {schema}").schema)
    return dealt.mapInArrow(run, f"`{key}` {kind.simpleString()}, {schema}")


#: Examples whose rows are joined by one key; a long conversation has several such keys.
BLOCK = 256


def expanded(formatted: DataFrame) -> DataFrame:
    """The examples of ``pieces``, each with all of its turns: at (conv_id, example), n, piece, start, reply_start, reply_end.

    An example is the prefix of the conversation up to an assistant turn, and this turn its target: only the target's row
    has ``reply_start`` and ``reply_end``. Turns after the last reply come in one more example, without a target.
    Examples of a conversation of n turns hold about n * n / 4 turns, a row each, dealt by blocks of examples.
    """
    ends = formatted.groupBy("conv_id").agg(F.max("n").alias("last")).select(F.col("conv_id").alias("__c"), "last")
    marked = formatted.join(ends, F.col("conv_id").eqNullSafe(F.col("__c")))
    heads = marked.where("reply_start IS NOT NULL OR n = last").select(F.col("conv_id").alias("__k"), F.col("n").alias("example"), F.expr(f"n div {BLOCK}").alias("__block"))
    rows = marked.withColumn("__b", F.explode(F.sequence(F.expr(f"n div {BLOCK}"), F.expr(f"last div {BLOCK}"))))
    own = F.col("n") == F.col("example")
    both = rows.join(heads, F.col("conv_id").eqNullSafe(F.col("__k")) & (F.col("__b") == F.col("__block")) & (F.col("n") <= F.col("example")))
    return both.select(F.struct("conv_id", "example").alias("at"), "n", "piece", "start", F.when(own, F.col("reply_start")).alias("reply_start"), F.when(own, F.col("reply_end")).alias("reply_end"))


def read_examples(examples: DataFrame) -> DataFrame:
    """What each example of ``expanded`` says: at, n_turns, turns_sha256, target (the unescaped text under its loss mask, null without a target), chars."""

    def fold():
        turns, found = hashlib.sha256(), [0, 0, None]

        def add(piece: str, start: int, a: int | None, b: int | None) -> None:
            role, text = parse(piece)
            if start != found[1] or found[2] is not None:
                raise ValueError("pieces do not follow on each other, or go on past the target")
            turns.update(f"{role}\n{unescaped(text)}\n".encode())
            if a is not None:
                found[2] = unescaped(piece[a - start : b - start])
            found[0] += 1
            found[1] += len(piece)

        return add, lambda: (found[0], turns.hexdigest(), found[2], found[1])

    return per_conversation(examples, ["piece", "start", "reply_start", "reply_end"], fold, "n_turns long, turns_sha256 string, target string, chars long", key="at", order=["n"])


def read_back(formatted: DataFrame) -> DataFrame:
    """What the examples of the formatted text say: conv_id, n_turns, turns_sha256 (role, line end, text, line end for each turn), loss_chars, loss_sha256, formatted_chars.

    Turns are those of the last example, which holds all; the trained text is that of the targets, one after another;
    ``formatted_chars`` counts all examples, prefixes included.
    """

    def fold():
        loss, sums = hashlib.sha256(), [0, "", 0, 0]

        def add(n_turns: int, turns: str, target: str | None, chars: int) -> None:
            sums[0], sums[1] = n_turns, turns
            if target is not None:
                loss.update(target.encode())
                sums[2] += len(target)
            sums[3] += chars

        return add, lambda: (sums[0], sums[1], sums[2], loss.hexdigest(), sums[3])

    each = read_examples(expanded(formatted)).select("at.conv_id", "at.example", "n_turns", "turns_sha256", "target", "chars")
    return per_conversation(each, ["n_turns", "turns_sha256", "target", "chars"], fold, "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long", order=["example"])
