"""A trie of conversation prefixes: each distinct sequence of first turns is a node.

Turns are known by 128-bit digests of role and text, so texts are read once and never dealt. Conversations go to tasks
by a hash of their first turn's digest; a task builds pointer-dictionary tries, a dictionary from digests to children
in each node, and sums subtrees by a postorder walk without recursion. A first turn under which there are more than
``most`` turns is a node of its own, and its conversations are dealt anew by their next turn, until nothing is too large;
these nodes are summed from the tops of the subtries below, the deepest first. A conversation that shares its group with
no other is a chain, which its own rows say without a trie, so that a conversation of any length is no group's burden.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.scan import ordered, running
from .chat_format import per_conversation
from .components import joined_by
from .shared import numbered, stored

#: No members end at a node.
NOTHING = hashlib.sha256().hexdigest()


def light(conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """c, n (place from 1), k (digest of role and text), size (UTF-8 bytes of the text) of all rows with a key."""
    rows = numbered(conversations.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("c"), F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), F.col(text).alias("text")), "text")
    k = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))
    rows = rows.select("c", "turn", k.alias("k"), F.octet_length("text").cast("long").alias("size"), F.monotonically_increasing_id().alias("row"))
    return running(ordered(rows, ["c"], ["turn", "k", "row"]), ["c"], F.lit(1), "n").select("c", "n", "k", "size")


def rebuilt(turns: DataFrame, of: int = 5, most: int = 9) -> DataFrame:
    """c, d (depth from 1), k, size: the first h turns of conversation c - c % ``of``, then the own ones after the first h; h is crc32 of c modulo ``most``."""
    h = lambda c: (F.crc32(F.col(c).cast("string").cast("binary")) % most).cast("long")
    base = F.col("c") - F.pmod("c", F.lit(of))
    sizes = turns.groupBy("c").agg(F.max("n").alias("len"))
    others = sizes.where(base != F.col("c")).select("c", h("c").alias("h"), base.alias("b"))
    lengths = sizes.where(base == F.col("c")).select(F.col("c").alias("b"), F.least("len", F.lit(most - 1)).alias("len"))
    taken = others.join(lengths, "b", "left").select("c", "h", F.least("h", F.coalesce("len", F.lit(0))).alias("taken"))
    # A base lends at most most - 1 turns to at most of - 1 conversations.
    lent = turns.where((base == F.col("c")) & (F.col("n") < most)).withColumnRenamed("c", "b").join(others, "b").where("n <= h").select("c", F.col("n").alias("d"), "k", "size")
    kept = joined_by(turns.where(base != F.col("c")), taken, "c").where("n > h").select("c", (F.col("taken") + F.col("n") - F.col("h")).alias("d"), "k", "size")
    own = turns.where(base == F.col("c")).select("c", F.col("n").alias("d"), "k", "size")
    return lent.unionByName(kept).unionByName(own)


class Node:
    """A prefix with its children by the digest of their last turn, and the members that end here."""

    __slots__ = ("parent", "depth", "first", "members", "size", "children", "ends", "leaves", "saved")

    def __init__(self, parent: Node | None, depth: int, first: int, size: int) -> None:
        self.parent, self.depth, self.first, self.size = parent, depth, first, size
        self.members, self.leaves, self.saved = 0, 0, 0
        self.children: dict[bytes, Node] = {}
        self.ends: list[int] = []


def build(c: np.ndarray, d: np.ndarray, k: list[bytes], size: list[int], g: list[bytes], top: int) -> dict[bytes, Node]:
    """The tries of groups ``g`` whose tops lie at depth ``top``; rows may come in any order."""
    tops: dict[bytes, Node] = {}
    now, node = None, None
    order = np.lexsort((d, c)).tolist()
    c, d = c.tolist(), d.tolist()
    for at in order:
        if c[at] != now:
            if node is not None:
                node.ends.append(now)
            now, node = c[at], None
        level, key = (tops, g[at]) if node is None else (node.children, k[at])
        child = level.get(key)
        if child is None:  # members come in order of their ids, so the first one is the smallest
            child = level[key] = Node(node, d[at], now, size[at])
        child.members += 1
        node = child
    if node is not None:
        node.ends.append(now)
    assert all(t.depth == top for t in tops.values())
    return tops


def summed(top: Node) -> list[Node]:
    """All nodes below and with ``top``, children before their parents, with leaves and saved bytes summed."""
    out, stack = [], [(top, iter(top.children.values()))]
    while stack:
        node, rest = stack[-1]
        child = next(rest, None)
        if child is not None:
            stack.append((child, iter(child.children.values())))
            continue
        stack.pop()
        node.saved += (node.members - 1) * node.size
        node.leaves = node.leaves or 1
        if stack:
            stack[-1][0].leaves += node.leaves
            stack[-1][0].saved += node.saved
        out.append(node)
    return out


_OUT = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
_COLUMNS = [c.split()[0] for c in _OUT.split(", ")]


def _digest(ids: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest() if ids else NOTHING


def ends(members: DataFrame, group: str) -> DataFrame:
    """``group``, ends_sha256 of the ids ``c`` in ascending order, read in order batch after batch."""

    def fold():
        whole, some = hashlib.sha256(), [False]

        def add(c: int) -> None:
            whole.update(f",{c}".encode() if some[0] else str(c).encode())
            some[0] = True

        return add, lambda: (whole.hexdigest(),)

    return per_conversation(members, ["c"], fold, "ends_sha256 string", key=group, order=["c"])


def _grown(top: int):
    """Turns of whole groups to the nodes of their tries; only tops have ``p``."""

    def grown(t: pd.DataFrame) -> pd.DataFrame:
        above = dict(zip(t["g"], t["p"], strict=True))
        out = []
        for g, first in build(t["c"].to_numpy(), t["d"].to_numpy(), t["k"].tolist(), t["size"].tolist(), t["g"].tolist(), top).items():
            out += [(n.first, n.depth, n.parent.first if n.parent else None, n.members, len(n.children), n.leaves, n.saved, _digest(n.ends), None if n.parent else above[g]) for n in summed(first)]
        return pd.DataFrame(out, columns=[*_COLUMNS, "p"]).astype({"parent_conv_id": "Int64"})

    return grown


def trie(conversations: DataFrame, rows: DataFrame, most: int = 1 << 16, key: str = "conv_id") -> DataFrame:
    """A row for each node of the trie of ``rows`` (c, d, k, size); members are all keys of ``conversations``, also those without rows.

    conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256. Rows with a null key take
    no part. Without any key there is no node, not even a root. ``most`` is how many turns a task's trie may take; a group
    of more is split by its next turn. Repeated turns are turns of their own; other columns are not read.
    """
    rows = stored(rows, "rebuilt")
    everyone = conversations.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("c")).distinct()
    # p is the group of the node above, g that of the group's top: the digest of all turns up to it.
    root = F.unhex(F.lit("00"))
    v = rows.groupBy("c").agg(F.max("d").alias("len"), F.max(F.when(F.col("d") == 1, F.col("k"))).alias("g")).withColumn("p", root)
    nodes: list[DataFrame] = []  # of which nothing is missing
    tops: list[DataFrame] = []  # by depth: tops of tries and chains
    spines: list[DataFrame] = []  # by depth: nodes too large for a task
    m = 1
    while True:
        v = stored(v, "members")
        sizes = v.groupBy("g").agg(F.count("*").alias("members"), F.sum(F.col("len") - m + 1).alias("turns"))
        kind = F.when(F.col("members") == 1, "chain").when(F.col("turns") <= most, "trie").otherwise("spine")
        sizes = stored(sizes.select("g", kind.alias("kind"), "turns", "members"), "groups")
        totals = {r["kind"]: r["turns"] for r in sizes.groupBy("kind").agg(F.sum("turns").alias("turns")).collect()}
        r = joined_by(rows.where(F.col("d") >= m), joined_by(v, sizes.select("g", "kind"), "g"), "c")
        r = stored(r.select("c", "d", "k", "size", "g", "p", "kind", "len"), "placed")
        last = F.col("d") == F.col("len")
        own = F.sha2(F.col("c").cast("string"), 256)
        chain = r.where("kind = 'chain'").select(
            F.col("c").alias("conv_id"), F.col("d").alias("depth"), F.when(F.col("d") > m, F.col("c")).alias("parent_conv_id"), F.lit(1).cast("long").alias("n_convs"), F.when(last, 0).otherwise(1).cast("long").alias("n_children"),
            F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"), F.when(last, own).otherwise(NOTHING).alias("ends_sha256"), F.when(F.col("d") == m, F.col("p")).alias("p"),
        )
        # Half of what a task may take goes to it by a hash; a large group comes on top.
        buckets = max(1, -(-(totals.get("trie") or 0) // max(1, most // 2)))

        grouped = r.where("kind = 'trie'").select("c", "d", "k", "size", "g", "p").groupBy(F.pmod(F.xxhash64("g"), F.lit(buckets)).alias("bucket"))
        made = stored(grouped.applyInPandas(_grown(m), f"{_OUT}, p binary").unionByName(chain), "made")
        nodes.append(made.where("p IS NULL").drop("p"))
        tops.append(made.where("p IS NOT NULL"))
        if not totals.get("spine"):
            break
        big = r.where("kind = 'spine'")
        at = big.where(F.col("d") == m)
        spine = at.groupBy("g").agg(F.min("c").alias("conv_id"), F.count("*").alias("n_convs"), F.max("size").alias("size"), F.max("p").alias("p"))
        spine = spine.join(ends(at.where("len = d").select("g", "c"), "g"), "g", "left")
        spines.append(stored(spine.withColumn("depth", F.lit(m).cast("long")), "spine"))
        v = big.where(F.col("d") == m + 1).select("c", "len", F.unhex(F.md5(F.concat("g", "k"))).alias("g"), F.col("g").alias("p"))
        m += 1
    ended = ends(everyone.join(rows.where("d = 1").select("c"), "c", "left_anti").select("c", root.alias("g")), "g")
    top = everyone.agg(F.min("c").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    top = top.select(root.alias("g"), "conv_id", "n_convs", F.lit(0).cast("long").alias("size"), F.lit(None).cast("binary").alias("p")).join(ended, "g", "left").withColumn("depth", F.lit(0).cast("long"))
    spines.insert(0, stored(top, "root"))
    below: DataFrame | None = None
    for depth in range(len(spines) - 1, -1, -1):
        kids = tops[depth].select("p", "n_leaves", "saved_tokens")
        if below is not None:
            kids = kids.unionByName(below.select("p", "n_leaves", "saved_tokens"))
        sums = kids.groupBy(F.col("p").alias("g")).agg(F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("below"))
        whole = spines[depth].join(sums, "g", "left")
        saved = F.coalesce("below", F.lit(0)) + (F.col("n_convs") - 1) * F.col("size")
        whole = whole.select("g", "p", "conv_id", "depth", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), F.coalesce("n_leaves", F.lit(1)).cast("long").alias("n_leaves"), saved.cast("long").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"))
        whole = stored(whole, "summed")
        # Children learn the smallest member of the node above, which may have children without end.
        named = whole.select(F.col("g").alias("p"), F.col("conv_id").alias("parent_conv_id"))
        for kids in [tops[depth], *([below] if below is not None else [])]:
            nodes.append(joined_by(kids.drop("parent_conv_id"), named, "p").select(_COLUMNS))
        below = whole
    nodes.append(below.withColumn("parent_conv_id", F.lit(None).cast("long")).select(_COLUMNS))
    out = nodes[0]
    for n in nodes[1:]:
        out = out.unionByName(n)
    return out.select(_COLUMNS)
