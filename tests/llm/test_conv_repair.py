"""Conversation repair against a plain search, with odd rows and conversations over many tasks."""

import random
import re
from hashlib import sha256

import pytest

from basketlens.llm.conv_repair import NOTHING, Survivors, conversation_digests, repair_conversations

TURN = "conv_id long, turn long, role string, text string"
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"


def faults(rows):
    seen, found = set(), []
    for _, role, text in rows:
        kept = text.strip(BLANKS)
        found.append("blank" if not kept else "duplicate" if (role, text) in seen else "" if kept[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return found


def cheapest(rows, found):
    """(cost, audit, lines): whole strings are kept for every state after every row."""
    after = {"": "u", "s": "u", "a": "u", "u": "a"}
    names = {"u": "user", "a": "assistant"}

    def gifts(ways):
        for _ in range(2):
            for state, (cost, audit, lines) in list(ways.items()):
                to = after[state]
                offer = (cost + 5, audit + "I", (*lines, (names[to], "")))
                if to not in ways or offer < ways[to]:
                    ways[to] = offer
        return ways

    ways = gifts({"": (0, "", ())})
    for (_, role, text), fault in zip(rows, found, strict=True):
        new = {}
        for state, (cost, audit, lines) in ways.items():
            offers = [(state, (cost + 2, audit + "D", lines))]
            if fault not in ("blank", "duplicate"):
                extra = 5 * (fault == "truncated")
                initial = role[:1]
                if initial and (initial == after[state] or (initial == "s" and state == "")):
                    offers.append((initial, (cost + extra, audit + "K", (*lines, (role, text)))))
                to = after[state]
                offers.append((to, (cost + 1 + extra, audit + "R", (*lines, (names[to], text)))))
            for to, offer in offers:
                if to not in new or offer < new[to]:
                    new[to] = offer
        ways = gifts(new)
    return min(ways[s] for s in ("", "a") if s in ways)


def plain(rows):
    """conv -> (gaps, blank, duplicate, truncated, illegal, cost, audit, digest)."""
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv, own in convs.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        found = faults(own)
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, lines = cheapest(own, found)
        said = "\n".join(f"{r}:{t}" for r, t in lines)
        counts = [found.count(x) for x in ("blank", "duplicate", "truncated")]
        out[conv] = (gaps, *counts, illegal, cost, audit, sha256(said.encode()).hexdigest())
        assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in lines))
    return out


def repaired(df):
    repair = repair_conversations(df)
    digests = {r["conv"]: r["sha256"] for r in conversation_digests(repair.rows).collect()}
    none = sha256(b"").hexdigest()
    fields = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    report = repair.report.collect()
    assert len({r["conv"] for r in report}) == len(report)
    return {r["conv"]: (*[r[f] for f in fields], digests.get(r["conv"], none)) for r in report}


def some_conversation(rng, conv, n, roles=("user", "assistant", "user", "assistant", "system", "tool", None, "", "User", "u")):
    texts = ["Well.", "Yes!", "no end", "So? \n", " ", "", None, "é.", "a.b"]
    rows = []
    for k in range(n):
        turn = rng.choice([k, k, k, k + 1, None]) if rng.random() < 0.5 else k
        text = rng.choice(texts) if rng.random() < 0.4 else f"{rng.randrange(10**6)}{rng.choice(['.', '.', '!', ''])}"
        rows.append((conv, turn, rng.choice(roles), text))
    return rows


def some_rows(seed):
    rng = random.Random(seed)
    rows = []
    for conv in range(60):
        rows += some_conversation(rng, conv, rng.randrange(1, 9), ("user", "assistant"))
    for conv in range(60, 120):
        rows += some_conversation(rng, conv, rng.randrange(1, 7))
    rows += some_conversation(rng, None, 9)
    rows += [(200, 0, "user", "x."), (200, 0, "user", "x."), (200, 0, "user", "x."), (201, None, None, None)]
    rows += [(202, t, "system", "s.") for t in range(4)] + [(203, t, "user", f"{t} open") for t in range(5)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_repairs_match_a_plain_search(spark, seed):
    rows = some_rows(seed)
    df = spark.createDataFrame([(*r, "c", 1) for r in rows], TURN + ", conv string, part int").repartition(5)
    assert repaired(df) == plain(rows)


@pytest.mark.parametrize("kind", ["mixed", "users", "blanks", "system first", "renamed", "equal turns"])
def test_one_conversation_over_many_tasks(spark, kind):
    """Most rows belong to one conversation, which lies in many ranges."""
    rng = random.Random(kind)
    rows = [(k // 4, k % 4, "user" if k % 2 == 0 else "assistant", f"{k}.") for k in range(40)]
    for k in range(400):
        role = "user" if k % 2 == 0 else "assistant"
        text = f"{k}."
        if kind == "mixed":
            role, text = rng.choice([role] * 8 + ["system", "user", "tool"]), rng.choice([text] * 9 + [" ", "1.", f"{k}"])
        elif kind == "users":
            role = "user"
        elif kind == "blanks" and 2 < k < 390:
            text = ""
        elif kind == "system first":
            role, text = ("system", "s.") if k == 0 else (role, "" if k < 399 else text)
        elif kind == "renamed":
            role = rng.choice(["user", "assistant", "system"])
        rows.append((5, 9 if kind == "equal turns" and k > 3 else k, role, text))
    rng.shuffle(rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        repair = repair_conversations(spark.createDataFrame(rows, TURN))
        parts = {r["place"]["part"] for r in repair.rows.where("conv = 5").select("place").collect()}
        got = repaired(spark.createDataFrame(rows, TURN))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert kind in ("blanks", "system first") or len(parts) > 3
    assert got == plain(rows)


def test_rows_are_the_repaired_turns(spark):
    rows = [(1, 0, "assistant", "a."), (1, 1, "user", "b."), (1, 2, "user", ""), (1, 3, "user", "c."), (1, 5, "assistant", "d.")]
    repair = repair_conversations(spark.createDataFrame(rows, TURN))
    got = [(r["turn"], r["role"], r["text"], r["edit"]) for r in repair.rows.orderBy("place").collect()]
    assert got == [(0, "user", "a.", "R"), (1, "assistant", "b.", "R"), (3, "user", "c.", "K"), (5, "assistant", "d.", "K")]


def test_memory_is_freed_when_survivors_coalesce():
    """Nodes stay few over a long conversation, deletions are one node, and edits come out early."""
    rng = random.Random(4)
    way, most, rows = Survivors(NOTHING), 0, 0
    for k in range(5000):
        way.step("ua"[k % 2] if rng.random() < 0.95 else "s", rng.random() < 0.1, rng.random() < 0.05)
        rows += sum(n for letter, n in way.decided() if letter not in "Ii")
        most = max(most, way.nodes())
    assert most < 80 and rows > 4900
    way = Survivors(NOTHING)
    for initial, unwanted in [("s", False)] + [("u", True)] * 3000:
        way.step(initial, unwanted, False)
    assert way.nodes() < 12


def test_equal_costs_take_the_smallest_audit():
    rows = [(0, "user", "a."), (1, "user", "b."), (2, "user", "c.")]
    cost, audit, _ = cheapest(rows, faults(rows))
    way = Survivors(NOTHING)
    for _ in rows:
        way.step("u", False, False)
    best = min((way.tips[s].cost, way.keys[s], way.open(s).upper()) for s in (0, 3) if s in way.tips)
    shared = "".join(letter * n for letter, n in way.decided()).upper()
    assert (best[0], shared + best[2]) == (cost, audit)


def test_no_rows(spark):
    repair = repair_conversations(spark.createDataFrame([], TURN))
    assert repair.report.count() == 0 and repair.rows.count() == 0
