r"""Repair of conversation structure by a min-plus matrix scan.

The roles of a repaired conversation read ``(s?(ua)+)?`` by their initials: nothing, or pairs of user and assistant after
at most one system turn. This is an automaton of four states: begin, after system, after user, after assistant. A turn
is a 4x4 matrix whose element (i, j) is the cheapest way from state i to state j over this turn: keep it (0), give it
another role (3) or delete it (4), then insert empty turns (3 each). An element is a pair (cost, audit), the audit being
the initials of the edits; pairs add and concatenate, and the least pair wins, so ties go to the least audit. Audits of
one cost over the same turns never begin with each other, as each further letter costs something, so concatenation
keeps their order and the product is associative.

So a conversation is the product of its turns' matrices in any bracketing. Turns are dealt by ranges of (conversation,
turn), so a long conversation spreads over tasks. Each range is cut into segments of at most 4096 turns and each
segment reduced to one matrix by halving; segments of a conversation are reduced 64 at a time until one is left. The
audit of a conversation is then cut again by the segments' sizes, and each turn gets its own edits. Nothing of a
conversation is in one task but its matrices, sizes and audit, a few bytes a turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.scan import AT, PART, ordered
from .chat_format import per_conversation
from .shared import numbered, stored

SEGMENT, FAN = 4096, 64
ROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
STATES = range(4)  # begin, after system, after user, after assistant
BLANKS = " \t\n\x0b\x0c\r"

Matrix = tuple[tuple[int, str] | None, ...]


def times(x: Matrix, y: Matrix) -> Matrix:
    """The min-plus product over (cost, audit); element (i, j) is at 4 * i + j, None where there is no way."""
    out = []
    for i in (0, 4, 8, 12):
        row = [(k, x[i + k]) for k in STATES if x[i + k] is not None]
        for j in STATES:
            best = None
            for k, a in row:
                b = y[4 * k + j]
                if b is not None:
                    cost = a[0] + b[0]
                    if best is None or cost < best[0]:
                        best = (cost, a[1] + b[1])
                    elif cost == best[0] and (audit := a[1] + b[1]) < best[1]:
                        best = (cost, audit)
            out.append(best)
    return tuple(out)


def _matrix(ways: dict[tuple[int, int], tuple[int, str]]) -> Matrix:
    return tuple(ways.get((i, j)) for i in STATES for j in STATES)


#: What can be inserted at one place: nothing, or turns on from a state. A circle only costs, so none is needed.
CLOSURE = _matrix({(i, i): (0, "") for i in STATES} | {(0, 2): (INSERT, "I"), (0, 3): (2 * INSERT, "II"), (1, 2): (INSERT, "I"), (1, 3): (2 * INSERT, "II"), (2, 3): (INSERT, "I"), (3, 2): (INSERT, "I")})

_NEXT = {(0, 2), (1, 2), (2, 3), (3, 2)}  # steps to a user or an assistant turn
_KEPT = {0: {(0, 1)}, 1: {(0, 2), (1, 2), (3, 2)}, 2: {(2, 3)}, 3: set()}  # by initial: s, u, a, another


def turn_matrix(code: int) -> Matrix:
    """Of a turn by its code: 8 for one that must go, else its initial (s 0, u 1, a 2, another 3), and 4 more if it is truncated."""
    ways = {(i, i): (DELETE, "D") for i in STATES}
    if code < 8:
        more = TRUNCATED * (code // 4)
        ways |= {x: (ROLE + more, "R") for x in _NEXT} | {x: (more, "K") for x in _KEPT[code % 4]}
    return times(_matrix(ways), CLOSURE)


_TURNS = [turn_matrix(c) for c in range(9)]


@lru_cache(1 << 14)
def _few(codes: bytes) -> Matrix:
    return _halved(codes)


def _halved(codes: bytes) -> Matrix:
    if len(codes) == 1:
        return _TURNS[codes[0]]
    h = len(codes) // 2
    return times(product(codes[:h]), product(codes[h:]))


def product(codes: bytes) -> Matrix:
    """Of one or more turns. Short runs of turns come again and again, so they are remembered."""
    return _few(codes) if len(codes) <= 8 else _halved(codes)


def least(m: Matrix) -> tuple[int, str]:
    """Cost and audit of a whole conversation of which ``m`` is the product."""
    whole = times(CLOSURE, m)
    return min(x for x in (whole[0], whole[3]) if x is not None)


def cut(audit: str, sizes: list[int]) -> list[tuple[str, int]]:
    """The audit's part for each segment, by numbers of turns, with the number of turns that come out before it. Insertions go to the turn before them, the first ones to the first turn."""
    out, at, made = [], 0, 0
    for k, n in enumerate(sizes):
        begin, seen = at, 0
        while at < len(audit) and (seen < n or audit[at] == "I"):
            seen += audit[at] != "I"
            at += 1
        part = audit[begin:at] if k + 1 < len(sizes) else audit[begin:]
        out.append((part, made))
        made += len(part) - part.count("D")
    return out


def damage(conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Faults made on purpose, by crc32 of ``key:turn`` modulo 20: 0 drops the row, 1 empties its text, 2 takes ``.!?`` out of it, 3 repeats the row, 4 makes its role user. Nulls in roles and texts, and in what is hashed, are one space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space(key), F.lit(":"), space(turn))) % 20
    d = conversations.select(F.col(key).alias("conv_id"), F.col(turn).alias("turn"), space(role).alias("role"), space(text).alias("text"), kind.alias("kind")).where("kind <> 0")
    changed = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    d = d.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), changed.alias("text"), "kind")
    return d.withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("kind", "copy")


_SEGMENT = "conv_id {key}, node long, part int, s int, n long, ids array<long>, costs array<long>, audits array<string>, blank long, duplicate long, truncated long, illegal long, first string, last string, low {turn}, high {turn}, distinct long"
_NODE = "conv_id {key}, level long, node long, nodes array<long>, sizes array<long>, costs array<long>, audits array<string>, blank long, duplicate long, truncated long, illegal long, first string, last string, low {turn}, high {turn}, distinct long"

#: The fields of a segment that are added up.
_SUMS = ("blank", "duplicate", "truncated", "illegal", "distinct")
LEGAL = {"su", "ua", "au"}


def _segments(batches: Iterator[pa.RecordBatch], schema: pa.Schema, segment: int) -> Iterator[pa.RecordBatch]:
    """A sorted range to its segments: runs of at most ``segment`` turns of one conversation."""
    out: list[dict] = []
    now, codes, begun = None, bytearray(), None

    def close() -> None:
        m = product(bytes(codes))
        begun["costs"], begun["audits"] = [None if x is None else x[0] for x in m], [None if x is None else x[1] for x in m]
        out.append(begun)

    s = 0
    for batch in batches:
        for key, turn, at, part, row, initial, code, fault in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", AT, PART, "row", "initial", "code", "fault")), strict=True):
            if begun is None or key != now or len(codes) == segment:
                if begun is not None:
                    close()
                    s += 1
                now, codes = key, bytearray()
                begun = {"conv_id": key, "node": at, "part": part, "s": s, "n": 0, "ids": [], "first": initial, "last": None, "low": None, "high": None} | dict.fromkeys(_SUMS, 0)
            codes.append(code)
            begun["n"] += 1
            begun["ids"].append(row)
            if fault:
                begun[fault] += 1
            if begun["last"] is not None and begun["last"] + initial not in LEGAL:
                begun["illegal"] += 1
            begun["last"] = initial
            if turn is not None:
                if begun["high"] is None or turn != begun["high"]:
                    begun["distinct"] += 1
                if begun["low"] is None:
                    begun["low"] = turn
                begun["high"] = turn
        if len(out) >= 2048:
            yield pa.RecordBatch.from_pylist(out, schema)
            out.clear()
    if begun is not None:
        close()
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


def together(parts: list[dict]) -> dict:
    """Neighbouring nodes of one conversation, in order, as one node: matrices multiply, counts add, what meets at the seams is looked at. Associative."""
    out = dict(parts[0])
    m = tuple(None if c is None else (c, a) for c, a in zip(out["costs"], out["audits"], strict=True))
    for p in parts[1:]:
        m = times(m, tuple(None if c is None else (c, a) for c, a in zip(p["costs"], p["audits"], strict=True)))
        for k in _SUMS:
            out[k] += p[k]
        out["illegal"] += out["last"] + p["first"] not in LEGAL
        out["last"] = p["last"]
        if p["low"] is not None:  # turns go up, nulls first
            out["distinct"] -= p["low"] == out["high"]
            out["low"] = p["low"] if out["low"] is None else out["low"]
            out["high"] = p["high"]
        out["nodes"], out["sizes"] = out["nodes"] + p["nodes"], out["sizes"] + p["sizes"]
    return out | {"costs": [None if x is None else x[0] for x in m], "audits": [None if x is None else x[1] for x in m]}


def _arrow(spark, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], ddl).schema)


def _reduced(nodes: DataFrame, ddl: str, fan: int) -> DataFrame:
    """Nodes (conv_id, level, node, ...) with one node left for each conversation, by rounds over ``fan`` neighbours."""
    schema = _arrow(nodes.sparkSession, ddl)

    def merge(t: pa.Table) -> pa.Table:
        return pa.Table.from_pylist([together(sorted(t.to_pylist(), key=lambda x: x["node"]))], schema)

    while not nodes.groupBy("conv_id").count().where("count > 1").isEmpty():
        nodes = nodes.withColumn("level", F.floor(F.col("level") / fan).cast("long"))
        nodes = stored(nodes.groupBy("conv_id", "level").applyInArrow(merge, ddl), "nodes")
    return nodes


def faults(rows: DataFrame) -> DataFrame:
    """row, conv_id, turn, initial, h, code, fault of ``rows`` (row, conv_id, turn, role, text): the first fault that holds of blank, duplicate and truncated."""
    bare = F.rtrim("text", F.lit(BLANKS))
    # What is repeated is known by two 64-bit hashes of role and text.
    light = rows.select("row", "conv_id", "turn", F.substring("role", 1, 1).alias("initial"), F.xxhash64("role", "text").alias("h"), F.xxhash64(F.lit(7), "text", "role").alias("g"), (bare == "").alias("blank"), (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("open"))
    again = light.where("NOT blank").groupBy("conv_id", "h", "g").agg(F.min(F.struct("turn", "row")).alias("at"), F.count("*").alias("n")).where("n > 1")
    # A text that a conversation repeats without end is a hot key here: both sides are dealt by an expression of their own, so that it can be split.
    again = again.select(F.col("conv_id").alias("c"), F.bitwise_not("h").alias("nh"), F.col("g").alias("og"), F.col("at.row").alias("origin"))
    own = light.withColumn("oh", F.bitwise_not("h"))
    l = own.join(again, (own.oh == again.nh) & (own.g == again.og) & own.conv_id.eqNullSafe(again.c), "left")
    fault = F.when(F.col("blank"), "blank").when(F.col("origin").isNotNull() & (F.col("origin") != F.col("row")), "duplicate").when(F.col("open"), "truncated")
    l = l.select("row", "conv_id", "turn", "initial", "h", fault.alias("fault"))
    kind = F.when(F.col("initial") == "s", 0).when(F.col("initial") == "u", 1).when(F.col("initial") == "a", 2).otherwise(3)
    code = F.when(F.col("fault").isin("blank", "duplicate"), 8).otherwise(kind + F.when(F.col("fault") == "truncated", 4).otherwise(0))
    return l.withColumn("code", code.cast("int"))


class Repair:
    """What ``repair`` finds: ``audits``, a row for each conversation that has rows, and ``turns``, the repaired rows."""

    def __init__(self, audits: DataFrame, turns: DataFrame) -> None:
        self.audits, self.turns = audits, turns


def repair(conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", segment: int = SEGMENT, fan: int = FAN) -> Repair:
    """The cheapest repair of every conversation.

    ``audits``: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit. ``turns``: conv_id, node, i, k, role,
    text, edit (K kept, R another role, I inserted), in the order of (node, i, k).

    Rows go by turn, nulls first; rows that share one go by a hash of role and text, so repeated rows lie side by side.
    Null roles and texts are one space; a null key is a conversation of its own; a role counts by its initial. Empty
    texts are blank, so they go. ``turn`` must be an integer. Extra columns are not read, an empty table gives no rows.
    """
    spark = conversations.sparkSession
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = numbered(conversations.select(F.col(key).alias("conv_id"), F.col(turn).cast("long").alias("turn"), space(role).alias("role"), space(text).alias("text")), "text")
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "rows")
    kinds = {"key": rows.schema["conv_id"].dataType.simpleString(), "turn": "long"}
    ddl, node_ddl = _SEGMENT.format(**kinds), _NODE.format(**kinds)
    schema = _arrow(spark, ddl)

    def within(d: DataFrame) -> DataFrame:
        return d.mapInArrow(lambda batches: _segments(batches, schema, segment), ddl)

    segments = ordered(faults(rows), ["conv_id"], ["turn", "h", "row"], within=within)
    seen = segments.groupBy("conv_id").agg(F.count("*").alias("n"))
    several = stored(seen.where("n > 1").select(F.col("conv_id").alias("c")), "several")
    lone = segments.join(several, F.col("conv_id").eqNullSafe(F.col("c")), "left_anti")
    long_ = segments.join(several, F.col("conv_id").eqNullSafe(F.col("c")), "left_semi")
    own = ["costs", "audits", "blank", "duplicate", "truncated", "illegal", "first", "last", "low", "high", "distinct"]
    wide = segments.agg(F.coalesce(F.max("s"), F.lit(0))).first()[0] + 1
    as_nodes = lambda d: d.select("conv_id", (F.col("part").cast("long") * wide + F.col("s")).alias("level"), "node", F.array("node").alias("nodes"), F.array("n").alias("sizes"), *own)
    roots = as_nodes(lone).unionByName(_reduced(as_nodes(long_), node_ddl, fan))

    audit_ddl = f"conv_id {kinds['key']}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, pieces array<struct<node:long,piece:string,made:long,odd:boolean>>"
    audit_schema = _arrow(spark, audit_ddl)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                cost, audit = least(tuple(None if c is None else (c, a) for c, a in zip(r["costs"], r["audits"], strict=True)))
                odd = (len(audit) - audit.count("D")) % 2 > 0
                pieces = [{"node": n, "piece": p, "made": made, "odd": odd} for n, (p, made) in zip(r["nodes"], cut(audit, r["sizes"]), strict=True)]
                gaps = 0 if r["low"] is None else r["high"] - r["low"] + 1 - r["distinct"]
                out.append({"conv_id": r["conv_id"], "gaps": gaps, "cost": cost, "audit": audit, "pieces": pieces} | {k: r[k] for k in ("blank", "duplicate", "truncated", "illegal")})
            if out:
                yield pa.RecordBatch.from_pylist(out, audit_schema)

    judgement = stored(roots.mapInArrow(judged, audit_ddl), "audits")
    audits = judgement.drop("pieces")
    pieces = judgement.select(F.explode("pieces").alias("p")).select("p.*")
    each = segments.select("conv_id", "node", "ids").join(pieces, "node")

    edit_ddl = f"row long, conv_id {kinds['key']}, node long, i int, edits string, made long, odd boolean"
    edit_schema = _arrow(spark, edit_ddl)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                for i, (row, (edits, made)) in enumerate(zip(r["ids"], cut(r["piece"], [1] * len(r["ids"])), strict=True)):
                    if edits != "D":
                        out.append({"row": row, "conv_id": r["conv_id"], "node": r["node"], "i": i, "edits": edits, "made": r["made"] + made, "odd": r["odd"]})
            if out:
                yield pa.RecordBatch.from_pylist(out, edit_schema)

    edits = each.mapInArrow(dealt, edit_ddl).join(rows.select("row", "role", "text"), "row")
    return Repair(audits, edits.select("conv_id", "node", "i", F.posexplode(_turns_of(F.col("edits"))).alias("k", "x")).select("conv_id", "node", "i", "k", "x.*"))


def _turns_of(edits: Column) -> Column:
    """The turns that a row's edits make: roles of inserted and changed turns follow from how many turns have come out before."""
    gone = F.locate("D", F.col("edits"))

    def one(e: Column, i: Column) -> Column:
        place = F.col("made") + i - F.when((gone > 0) & (i >= gone), 1).otherwise(0) - F.col("odd").cast("int")
        role = F.when(e == "K", F.col("role")).when(F.pmod(place, F.lit(2)) == 0, "user").otherwise("assistant")
        return F.struct(role.alias("role"), F.when(e == "I", "").otherwise(F.col("text")).alias("text"), e.alias("edit"))

    return F.filter(F.transform(F.split(edits, ""), one), lambda x: x.edit.isin("K", "R", "I"))


def digests(turns: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256 of ``role:text`` of all repaired turns, joined by line ends."""

    def fold():
        whole, some = hashlib.sha256(), [False]

        def add(role: str, text: str) -> None:
            whole.update((f"\n{role}:{text}" if some[0] else f"{role}:{text}").encode())
            some[0] = True

        return add, lambda: (whole.hexdigest(),)

    return per_conversation(turns, ["role", "text"], fold, "repaired_sha256 string", order=["node", "i", "k"])


def report(conversations: DataFrame, found: Repair, key: str = "conv_id") -> DataFrame:
    """A row for every key of ``conversations``, with the columns of ``audits`` and repaired_sha256; without rows the counts are 0, the audit and the repaired text empty."""
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    none = lambda *names: [F.lit(None).cast("long").alias(c) for c in names]
    text = lambda c: F.lit(None).cast("string").alias(c)
    ids = conversations.select(F.col(key).alias("conv_id")).distinct().select("conv_id", *none(*counts), text("audit"), text("repaired_sha256"))
    a = found.audits.select("conv_id", *counts, "audit", text("repaired_sha256"))
    d = digests(found.turns).select("conv_id", *none(*counts), text("audit"), "repaired_sha256")
    return ids.unionByName(a).unionByName(d).groupBy("conv_id").agg(*[F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in counts], F.coalesce(F.max("audit"), F.lit("")).alias("audit"), F.coalesce(F.max("repaired_sha256"), F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
