"""Chat formatting, structure repair and the prefix trie against plain Python on small tables."""

import hashlib
import os
import random
import re
import zlib

import pytest

from coppice.llm import chat_format as C
from coppice.llm import prefix_trie as P
from coppice.llm import structure_repair as R

SCHEMA = "conv_id long, turn long, role string, text string"
MARKED = r"\### Assistant: </turn> ok"
SF = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def by_turn(rows):
    found = {}
    for c, t, r, x in rows:
        found.setdefault(c, []).append((t is not None, t or 0, r, x))
    return {c: [(t, r, x) for _, t, r, x in sorted(v, key=lambda z: z[:2])] for c, v in found.items()}


def chats(seed, conversations=30, texts=12):
    """Distinct turns in each conversation, null ones among roles and texts, shared beginnings."""
    r = random.Random(seed)
    out = []
    for c in range(conversations):
        turns = r.sample(range(20), r.randrange(0, 9))
        out += [(c, t, r.choice(["user", "assistant", "system", "tool", None, ""]), r.choice([None, "", " ", MARKED, "ende", "ß ok! ", "\\", "#### x", "</turn></turn>\n", *(f"text {i}." for i in range(texts))])) for t in turns]
    return out


# Chat formatting


def formatted(rows):
    out = {}
    for c, v in by_turn(rows).items():
        loss = "".join(x or "" for _, r, x in v if r == "assistant")
        out[c] = (len(v), sha("".join(f"{r or ''}\n{x or ''}\n" for _, r, x in v)), len(loss), sha(loss))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_chat_format(spark, seed):
    rows = [*chats(seed), (-7, 0, "user", MARKED), (-7, 1, "assistant", MARKED), (None, 1, "assistant", "of no key"), (None, None, "user", "first"), (99, 5, "assistant", "x" * 100_000 + "\\")]
    d = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = C.pieces(d).collect()
    got = {r["conv_id"]: tuple(r)[1:5] for r in C.read_back(C.pieces(d)).collect()}
    assert got == formatted(rows)
    # Each example's reply, cut out of the whole text of its conversation, is the text of its turn.
    whole = {c: "".join(p.piece for p in sorted((p for p in found if p.conv_id == c), key=lambda p: p.n)) for c in got}
    replies = {}
    for e in sorted(C.examples(C.pieces(d)).collect(), key=lambda e: (str(e.conv_id), e.example)):
        assert e.context_end < e.reply_start <= e.reply_end
        assert whole[e.conv_id][e.context_end : e.reply_start] == "### assistant: "
        replies.setdefault(e.conv_id, []).append(C.unescaped(whole[e.conv_id][e.reply_start : e.reply_end]))
    assert replies == {c: t for c, v in by_turn(rows).items() if (t := [x or "" for _, r, x in v if r == "assistant"])}


def test_chat_format_of_one_long_conversation(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"turn {t} of many") for t in range(3000)] + [(2, 0, "assistant", "b")]
    d = spark.createDataFrame(rows, SCHEMA).repartition(4)
    p = C.pieces(d)
    assert {r["conv_id"]: tuple(r)[1:5] for r in C.read_back(p).collect()} == formatted(rows)
    assert [r.n for r in p.where("conv_id = 1").orderBy("n").select("n").collect()] == list(range(3000))


def test_chat_format_defined_cases(spark):
    assert C.read_back(C.pieces(spark.createDataFrame([], SCHEMA))).count() == 0
    same = [(1, 0, "assistant", "a")] * 3  # repeated rows are turns
    clash = spark.createDataFrame([(*x, 1, 2, "n") for x in same], f"{SCHEMA}, start long, n long, piece string")
    assert tuple(C.read_back(C.pieces(clash)).first())[1:4] == (3, sha("assistant\na\n" * 3), 3)
    assert C.parse("### a\\:b: x<\\/turn>\\\\</turn>\n") == ("a:b", "x<\\/turn>\\\\")
    with pytest.raises(ValueError, match="no piece"):
        C.parse("### user: x</turn>y</turn>\n")


# Structure repair


def damaged(rows):
    out, one = [], lambda v: " " if v is None else str(v)
    for c, t, r, x in rows:
        kind, r, x = zlib.crc32(f"{one(c)}:{one(t)}".encode()) % 20, one(r), one(x)
        x = "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x
        out += [(c, t, "user" if kind == 4 else r, x)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def cheapest(turns):
    """Over (role, must go, truncated): shortest paths in the graph of states and turns, with whole audits."""
    follow = {0: 2, 1: 2, 2: 3, 3: 2}

    def inserted(now):
        for _ in range(3):
            for s, (cost, audit) in list(now.items()):
                now[follow[s]] = min(now.get(follow[s], (1 << 40, "")), (cost + 3, audit + "I"))
        return now

    now = {0: (0, "")}
    for role, must, open_ in turns:
        after = {}
        for s, (cost, audit) in inserted(now).items():
            ways = [(s, 4, "D")]
            if not must:
                ways.append((follow[s], 3 + 3 * open_, "R"))
                kept = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}.get((role[:1], s))
                ways += [] if kept is None else [(kept, 3 * open_, "K")]
            for to, more, letter in ways:
                after[to] = min(after.get(to, (1 << 40, "")), (cost + more, audit + letter))
        now = after
    now = inserted(now)
    return min(now[s] for s in (0, 3) if s in now)


def repaired(rows):
    out = {c: (0, 0, 0, 0, 0, 0, "", sha("")) for c, *_ in rows}
    for c, v in by_turn(damaged(rows)).items():
        seen, turns, n = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, r, x in v:
            end = x.rstrip(" \t\n\x0b\x0c\r")[-1:]
            fault = "blank" if not end else "duplicate" if (r, x) in seen else "truncated" if end not in ".!?" else None
            seen.add((r, x))
            n |= {fault: n[fault] + 1} if fault else {}
            turns.append((r, fault in ("blank", "duplicate"), fault == "truncated"))
        t = [x for x, *_ in v if x or x == 0]
        roles = [r[:1] for _, r, _ in v]
        cost, audit = cheapest(turns)
        state, rest, text = 0, iter(v), []
        for e in audit:
            if e == "I":
                r, x = ("user", "") if state != 2 else ("assistant", "")
            else:
                _, r, x = next(rest)
            if e == "D":
                continue
            if e == "R":
                r = "user" if state != 2 else "assistant"
            state = {"s": 1, "u": 2, "a": 3}[r[0]]
            text.append(f"{r}:{x}")
        out[c] = (max(t) - min(t) + 1 - len(set(t)) if t else 0, *n.values(), sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:], strict=False)), cost, audit, sha("\n".join(text)))
    return out


FIELDS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def report(d, **sizes):
    return {r["conv_id"]: tuple(r[c] for c in FIELDS) for r in R.report(d, R.repair(R.damage(d), **sizes)).collect()}


def test_repair(spark):
    rows = [*chats(5, 60), (70, 0, "assistant", "A."), (70, 1, "user", "B?"), (71, 3, "system", "only."), (72, 1, "user", "x.")]
    d = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert report(d) == repaired(rows)


def test_repair_of_a_long_conversation_over_segments_and_ranges(spark):
    r = random.Random(8)
    rows = [(1, t, r.choice(["user", "assistant", "system"]), r.choice([f"text {t}.", "again!", "open end", ""])) for t in range(700)]
    rows += [(c + 10, *x) for c, *x in chats(9, 6)]
    d = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want = repaired(rows)
    assert report(d, segment=5, fan=3) == want
    assert report(d) == want


def test_repair_defined_cases(spark):
    assert report(spark.createDataFrame([], SCHEMA)) == {}
    lost = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    none = (0, 0, 0, 0, 0, 0, "", sha(""))
    assert report(spark.createDataFrame([(5, lost, "user", "x.")], SCHEMA)) == {5: none}
    # A null key and null turns make a conversation; columns of other names are not read.
    d = spark.createDataFrame([(None, None, "user", "x.", 1, "n"), (None, None, "assistant", "y.", 2, "n")], f"{SCHEMA}, row long, fault string")
    got = report(d)
    assert list(got) == [None]
    assert got[None][0] == 0


def test_matrix_product_is_associative():
    r = random.Random(1)
    for _ in range(200):
        codes = bytes(r.randrange(9) for _ in range(r.randrange(2, 12)))
        left = R.turn_matrix(codes[0])
        for c in codes[1:]:
            left = R.times(left, R.turn_matrix(c))
        assert left == R.product(codes)
        cost, audit = R.least(left)
        sizes = [2, len(codes) - 2]
        assert "".join(p for p, _ in R.cut(audit, sizes)) == audit
        assert (cost, audit) == cheapest([({0: "s", 1: "u", 2: "a", 3: "x"}[c % 4], c == 8, 4 <= c < 8) for c in codes])


# Prefix trie


def rebuilt(rows):
    own = {c: [(r or "", x or "") for _, r, x in v] for c, v in by_turn(rows).items() if c is not None}
    h = {c: zlib.crc32(str(c).encode()) % 9 for c in own}
    return {c: own.get(c - c % 5, [])[: h[c]] + v[h[c] :] for c, v in own.items()}


def nodes(conversations):
    members = {}
    for c, v in conversations.items():
        for d in range(len(v) + 1):
            members.setdefault(tuple(v[:d]), []).append(c)
    kids = {p: [q for q in members if q and q[:-1] == p] for p in members}
    out, leaves, saved = set(), {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[q] for q in kids[p]) or 1
        saved[p] = sum(saved[q] for q in kids[p]) + ((len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0)
        here = sorted(c for c in members[p] if len(conversations[c]) == len(p))
        out.add((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(kids[p]), leaves[p], saved[p], sha(",".join(map(str, here)))))
    return out


def grown(d, most=1 << 16):
    found = [tuple(r) for r in P.trie(d, P.rebuilt(P.light(d)), most).collect()]
    assert len(found) == len(set(found))
    return set(found)


@pytest.mark.parametrize("most", [1 << 16, 12, 1])
def test_trie(spark, most):
    rows = chats(3, 40, 3) + [(c, t, "user", f"hot {t}") for c in range(100, 130, 5) for t in range(3)] + [(c, 9, "user", "end") for c in (101, 203)]
    d = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert grown(d, most) == nodes(rebuilt(rows))


def test_trie_defined_cases(spark):
    assert grown(spark.createDataFrame([], SCHEMA)) == set()
    assert grown(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)) == set()
    rows = [(3, None, "user", "a"), (3, 1, None, None), (3, 1, None, None), (8, 0, "user", "ü" * 50_000), (10, 0, "user", "t")]
    d = spark.createDataFrame([(*x, 1, 2) for x in rows], f"{SCHEMA}, d long, k long")
    assert grown(d) == nodes(rebuilt(rows))


def test_trie_of_a_long_chain_is_no_groups_burden(spark):
    rows = [(0, t, "user", f"t{t}") for t in range(500)] + [(5, t, "user", f"t{t}") for t in range(4)]
    d = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert grown(d, 50) == nodes(rebuilt(rows))


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_queries_of_conversations(spark):
    from coppice.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r["conv_id"]: tuple(r)[1:5] for r in QUERIES["op13_chat_format"](spark, SF).collect()}
    assert got == formatted([*rows, (-7, 0, "user", MARKED), (-7, 1, "assistant", MARKED)])
    assert {tuple(r) for r in QUERIES["op12_prefix_trie"](spark, SF).collect()} == nodes(rebuilt(rows))
    assert {r["conv_id"]: tuple(r[c] for c in FIELDS) for r in QUERIES["op11_structure_repair"](spark, SF).collect()} == repaired(rows)


def test_chat_examples_are_expanded(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a#"), (1, 2, "user", "r"), (1, 3, "assistant", ""), (1, 4, "user", "late"), (None, 0, "assistant", "b")]
    p = C.pieces(spark.createDataFrame(rows, SCHEMA).repartition(3))
    x = C.expanded(p)
    got = {}
    for r in sorted(x.collect(), key=lambda r: (str(r["at"].conv_id), r["at"].example, r.n)):
        got.setdefault((r["at"].conv_id, r["at"].example), []).append((r.piece, r.reply_start is not None))
    q, a, u, e, late = "### user: q</turn>\n", "### assistant: a\\#</turn>\n", "### user: r</turn>\n", "### assistant: </turn>\n", "### user: late</turn>\n"
    assert got == {
        (1, 1): [(q, False), (a, True)], (1, 3): [(q, False), (a, False), (u, False), (e, True)], (1, 4): [(q, False), (a, False), (u, False), (e, False), (late, False)],
        (None, 0): [("### assistant: b</turn>\n", True)],
    }
    assert {(r["at"].conv_id, r["at"].example): (r.n_turns, r.target) for r in C.read_examples(x).collect()} == {(1, 1): (2, "a#"), (1, 3): (4, ""), (1, 4): (5, None), (None, 0): (1, "b")}
    assert {r.conv_id: r.formatted_chars for r in C.read_back(p).collect()} == {1: sum(len(y) for k, v in got.items() if k[0] for y, _ in v), None: len("### assistant: b</turn>\n")}
