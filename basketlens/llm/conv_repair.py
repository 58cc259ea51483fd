"""Cheapest repair of conversations: turns kept, given another role, deleted or inserted.

The repaired role initials are to be ``(s?(ua)+)?``, read by four states. A row's cheapest
way into every state is one Viterbi step; ways are kept as a backpointer tree.

1. Rows are sorted by ranges of (conversation, turn, ...), so a conversation of any length
   is spread over tasks. Each task reads its rows once, in order.
2. Tree nodes count who refers to them; a way that is given up is freed. As soon as all
   surviving ways share an ancestor (survivor coalescence), the edits up to it are decided
   and leave the task with their rows. Of tied ways the one whose whole unresolved edit
   string is smaller survives: strings of different ways never are prefixes of each other at
   their last row, so their order is kept as ranks from row to row.
3. Only the first and the last conversation of a task can go on in another one. The first is
   followed from all four states until they coalesce; what lies before, and what is still
   open at the task's end, is listed for every state. A conversation has one such list for
   each range that it lies in; they are put together, and the rows that had to wait get their
   edits.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from hashlib import sha256
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from basketlens.llm.common import pieces
from basketlens.shipping import map_batches
from basketlens.staging import stage

#: Nothing yet, after the system turn, after a user turn, after an assistant turn.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTED = (NOTHING, ASSISTANT)
#: Costs of edits, and of keeping a truncated row.
RENAMED, DELETED, INSERTED, TRUNCATED = 1, 2, 5, 5
#: The state after a user or assistant turn.
_NEXT = {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
_KEPT = {"s": {NOTHING: SYSTEM}, "u": {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
#: Edits as upper-case initials; a lower-case one makes an assistant turn.
_RENAME, _INSERT = {USER: "R", ASSISTANT: "r"}, {USER: "I", ASSISTANT: "i"}
_ROLE = {"R": "user", "r": "assistant", "I": "user", "i": "assistant"}
#: What any ending from the first state costs more, at most, when begun in the second:
#: inserting the missing turns, deleting a system turn that comes too late.
_SLACK = {
    NOTHING: {SYSTEM: 2 * INSERTED, USER: INSERTED + DELETED, ASSISTANT: DELETED},
    SYSTEM: {NOTHING: 0, USER: INSERTED, ASSISTANT: 0},
    USER: {NOTHING: INSERTED, SYSTEM: INSERTED, ASSISTANT: INSERTED},
    ASSISTANT: {NOTHING: 0, SYSTEM: 2 * INSERTED, USER: INSERTED},
}
_LEGAL = {"su", "ua", "au"}
#: Where a row lies in its piece: before the states coalesce, decided in the task, open at its end.
_HEAD, _MIDDLE, _TAIL = range(3)


class _Node:
    """An edit (``count`` equal deletions) and the way before it; ``held`` if it ends a surviving way."""

    __slots__ = ("parent", "letter", "count", "kids", "held", "state", "cost")

    def __init__(self, parent, letter, state, cost):
        self.parent, self.letter, self.count, self.kids, self.held = parent, letter, 1, [], 1
        self.state, self.cost = state, cost
        if parent is not None:
            parent.kids.append(self)

    @property
    def references(self) -> int:
        return len(self.kids) + self.held


class Survivors:
    """The cheapest way into every state, from one entry state.

    ``step`` reads a row, ``decided`` returns the edits that all ways share by now. ``keys``
    order the ways' whole edit strings: (rank at the last row, insertions after it).
    """

    def __init__(self, entry: int):
        self.root = _Node(None, "", entry, 0)
        self.tips, self.keys = {entry: self.root}, {entry: (0, "")}
        self.rows_decided = 0
        self._insert()

    def _give_up(self, node: _Node) -> None:
        node.held = 0
        while node.references == 0 and node.parent is not None:
            node.parent.kids.remove(node)
            node = node.parent

    def _insert(self) -> None:
        for state in (NOTHING, SYSTEM, ASSISTANT, USER):
            if state not in self.tips:
                continue
            to, tip, (rank, more) = _NEXT[state], self.tips[state], self.keys[state]
            offer = (tip.cost + INSERTED, rank, more + "I")
            if to not in self.tips or offer < (self.tips[to].cost, *self.keys[to]):
                if to in self.tips:
                    self._give_up(self.tips[to])
                self.tips[to], self.keys[to] = _Node(tip, _INSERT[to], to, offer[0]), offer[1:]

    def step(self, initial: str, unwanted: bool, truncated: bool) -> None:
        """Read a row; an unwanted one is deleted."""
        if unwanted:
            self._delete()
        else:
            self._choose(initial, TRUNCATED if truncated else 0)
        ranked = sorted(self.keys, key=self.keys.get)
        self.keys = {state: (rank, "") for rank, state in enumerate(ranked)}
        self._insert()
        costs = {state: tip.cost for state, tip in self.tips.items()}
        for state in [x for x in costs if any(costs[x] > costs[y] + _SLACK[x][y] for y in costs if y != x)]:
            self._give_up(self.tips.pop(state))
            del self.keys[state]

    def _delete(self) -> None:
        for state, tip in self.tips.items():
            rank, more = self.keys[state]
            self.keys[state] = (rank, more + "D")
            above = tip.parent
            if above is not None and tip.letter == "D" and not tip.kids:
                tip.count, tip.cost = tip.count + 1, tip.cost + DELETED
                if above.letter == "D" and above.references == 1 and above.parent is not None:
                    tip.count, tip.parent = tip.count + above.count, above.parent
                    above.parent.kids[above.parent.kids.index(above)] = tip
            else:
                self.tips[state] = _Node(tip, "D", state, tip.cost + DELETED)
                tip.held = 0

    def _choose(self, initial: str, extra: int) -> None:
        best: dict[int, tuple] = {}
        for state, tip in self.tips.items():
            rank, more = self.keys[state]
            kept, named = _KEPT.get(initial, {}).get(state), _NEXT[state]
            moves = [(state, "D", DELETED)]
            if kept is not None:
                moves.append((kept, "K", extra))
            if kept != named:
                moves.append((named, _RENAME[named], RENAMED + extra))
            for to, letter, price in moves:
                offer = (tip.cost + price, rank, more + letter.upper())
                if to not in best or offer < best[to][0]:
                    best[to] = (offer, tip, letter)
        before = list(self.tips.values())
        self.tips = {to: _Node(tip, letter, to, offer[0]) for to, (offer, tip, letter) in best.items()}
        self.keys = {to: offer[1:] for to, (offer, _, _) in best.items()}
        for tip in before:
            self._give_up(tip)

    def decided(self) -> list[tuple[str, int]]:
        """(edit, times) that all surviving ways share and that were not returned yet."""
        found = []
        while not self.root.held and len(self.root.kids) == 1:
            self.root = self.root.kids[0]
            self.root.parent = None
            found.append((self.root.letter, self.root.count))
            if self.root.letter not in "Ii":
                self.rows_decided += self.root.count
        return found

    def open(self, state: int) -> str:
        """The edits from the decided ones to the way's end."""
        found, node = [], self.tips[state]
        while node is not self.root:
            found.append(node.letter * node.count)
            node = node.parent
        return "".join(reversed(found))

    def nodes(self) -> int:
        """Nodes kept, for measuring."""
        todo, n = [self.root], 0
        while todo:
            n += 1
            todo += todo.pop().kids
        return n


_WAY = pa.struct([("zone", pa.int32()), ("first", pa.int32()), ("last", pa.int32()), ("cost", pa.int64()), ("letters", pa.string())])
_COUNTS = ("blank", "duplicate", "truncated", "illegal")
_PIECE = pa.struct(
    [(c, pa.int64()) for c in (*_COUNTS, "turns", "low", "high", "cost")]
    + [("initials", pa.string()), ("audit", pa.string()), ("ended", pa.bool_()), ("ways", pa.list_(_WAY))]
)
_EDITED = [("conv", pa.int64()), ("part", pa.int32()), ("zone", pa.int32()), ("seq", pa.int64()), ("turn", pa.int64())]
_EDITED += [("role", pa.string()), ("text", pa.string()), ("edit", pa.string()), ("piece", _PIECE)]
_WAYS = "array<struct<zone: int, first: int, last: int, cost: long, letters: string>>"
_PIECE_SQL = (
    f"struct<{', '.join(f'{c}: long' for c in (*_COUNTS, 'turns', 'low', 'high', 'cost'))}, "
    f"initials: string, audit: string, ended: boolean, ways: {_WAYS}>"
)
_ROWS = "conv long, part int, zone int, seq long, turn long, role string, text string, edit string"
_REPORT = "conv long, gaps long, " + ", ".join(f"{c} long" for c in _COUNTS) + ", cost long, audit string"


class _Piece:
    """The rows of one conversation in one task. ``out`` gets what leaves it, as columns of ``_EDITED``.

    A row that waits for its edit has none; its ``seq`` counts rows, that of others counts edits.
    """

    def __init__(self, conv, part: int, entries: tuple[int, ...], out: list):
        self.conv, self.part, self.out = conv, part, out
        self.ways = {e: Survivors(e) for e in entries}
        self.heads = {e: [] for e in entries}
        self.listed: list[dict] = []
        self.merged = False
        self.first = 0
        self.rows, self.edits, self.audit = 0, 0, []
        self.waiting: deque = deque()
        self.stats = dict.fromkeys((*_COUNTS, "turns"), 0) | {"low": None, "high": None}
        self.initials = ""
        self._merge()

    def read(self, turn, role: str, text: str, times: int, blank: bool, duplicate: bool, truncated: bool) -> None:
        stats, initial = self.stats, role[:1]
        if turn is not None and turn != stats["high"]:
            stats["turns"] += 1
            stats["low"] = turn if stats["low"] is None else stats["low"]
            stats["high"] = turn
        for k in range(times):
            again = duplicate or k > 0
            fault = "blank" if blank else "duplicate" if again else "truncated" if truncated else None
            if fault:
                stats[fault] += 1
            if self.rows and self.last + initial not in _LEGAL:
                stats["illegal"] += 1
            if not self.rows:
                self.first_initial = initial
            self.last = initial
            unwanted = blank or again
            if not unwanted:
                self.waiting.append((self.rows, turn, role, text))
            self.rows += 1
            for way in self.ways.values():
                way.step(initial, unwanted, fault == "truncated")
            if self.merged:
                self._apply(self.way.decided())
            else:
                self._merge()

    def _merge(self) -> None:
        """Join the entry states' ways once the decided parts of all end at one row in one state."""
        for e, way in self.ways.items():
            self.heads[e] += [letter * n for letter, n in way.decided()]
        ends = {(w.rows_decided, w.root.state) for w in self.ways.values()}
        self._wait_before(min(row for row, _ in ends), _HEAD, 0)
        if len(ends) > 1:
            return
        self.listed = [
            {"zone": _HEAD, "first": e, "last": None, "cost": w.root.cost, "letters": "".join(self.heads[e])} for e, w in self.ways.items()
        ]
        self.way = next(iter(self.ways.values()))
        self.ways = {0: self.way}
        self.base, self.first, self.merged = self.way.root.cost, self.way.rows_decided, True

    def _wait_before(self, row: int, zone: int, first: int) -> None:
        while self.waiting and self.waiting[0][0] < row:
            place, turn, role, text = self.waiting.popleft()
            self.out.append((self.conv, self.part, zone, place - first, turn, role, text, None, None))

    def _apply(self, edits: list[tuple[str, int]]) -> None:
        for letter, times in edits:
            self.audit.append(letter * times)
            if letter == "D":
                self.first += times
                while self.waiting and self.waiting[0][0] < self.first:
                    self.waiting.popleft()
            else:
                turn = text = role = None
                if letter not in "Ii":
                    _, turn, role, text = self.waiting.popleft()
                    self.first += 1
                self.out.append((self.conv, self.part, _MIDDLE, self.edits, turn, _ROLE.get(letter, role), text or "", letter.upper(), None))
            self.edits += times

    def end(self, last: bool) -> None:
        """The piece's own record; ``last`` if the conversation may go on in the next task."""
        cost = None
        ended = not last and len(self.listed) == 1
        if ended:
            way = self.way
            state = min((s for s in ACCEPTED if s in way.tips), key=lambda s: (way.tips[s].cost, *way.keys[s]))
            cost = way.tips[state].cost
            self._apply([(letter, 1) for letter in way.open(state)])
        elif self.merged:
            way = self.way
            self.listed += [
                {"zone": _TAIL, "first": None, "last": s, "cost": tip.cost - self.base, "letters": way.open(s)} for s, tip in way.tips.items()
            ]
            self._wait_before(self.rows, _TAIL, way.rows_decided)
        else:
            self.listed = [
                {"zone": _MIDDLE, "first": e, "last": s, "cost": tip.cost, "letters": "".join(self.heads[e]) + way.open(s)}
                for e, way in self.ways.items()
                for s, tip in way.tips.items()
            ]
            self._wait_before(self.rows, _HEAD, 0)
        record = self.stats | {
            "cost": cost,
            "initials": f"{self.first_initial or '-'}{self.last or '-'}",
            "audit": "".join(self.audit).upper(),
            "ended": ended,
            "ways": [] if ended else self.listed,
        }
        self.out.append((self.conv, self.part, None, None, None, None, None, None, record))


def _batch(rows: list[tuple], fields: list) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, (_, t) in zip(columns, fields)], names=[n for n, _ in fields])


def _repair(batches) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by conversation, turn, role, text."""
    out, piece, first = [], None, True
    for batch in batches:
        for cut in pieces([batch], "text"):
            for row in cut.to_pylist():
                if piece is None or row["conv"] != piece.conv:
                    if piece is not None:
                        piece.end(last=False)
                        first = False
                    piece = _Piece(row["conv"], row["part"], tuple(range(4)) if first else (NOTHING,), out)
                piece.read(row["turn"], row["role"], row["text"], row["times"], row["blank"], row["duplicate"], row["truncated"])
            if out:
                yield _batch(out, _EDITED)
                out.clear()
    if piece is not None:
        piece.end(last=True)
        yield _batch(out, _EDITED)


class _Joined:
    """The pieces of one conversation, in order. ``ways``: per state (cost, [(part, zone, letters)])."""

    def __init__(self, conv):
        self.conv, self.chosen, self.cost = conv, [], 0
        self.ways = {NOTHING: (0, [])}
        self.stats, self.last, self.high = dict.fromkeys((*_COUNTS, "turns"), 0), None, None
        self.low = None

    @staticmethod
    def _order(way: tuple) -> tuple:
        return way[0], "".join(letters for _, _, letters in way[1]).upper()

    def read(self, part: int, piece: dict) -> None:
        for c in (*_COUNTS, "turns"):
            self.stats[c] += piece[c]
        first, last = (x.replace("-", "") for x in piece["initials"])
        if self.last is not None and self.last + first not in _LEGAL:
            self.stats["illegal"] += 1
        self.last = last
        if piece["low"] is not None:
            self.stats["turns"] -= piece["low"] == self.high
            self.low = piece["low"] if self.low is None else self.low
            self.high = piece["high"]
        listed = piece["ways"]
        through = [w for w in listed if w["zone"] == _MIDDLE]
        if through:
            offers = [(w["last"], w["first"], w["cost"], (part, _HEAD, w["letters"])) for w in through]
            found: dict[int, tuple] = {}
            for to, state, cost, step in offers:
                if state in self.ways:
                    way = (self.ways[state][0] + cost, [*self.ways[state][1], step])
                    if to not in found or self._order(way) < self._order(found[to]):
                        found[to] = way
            self.ways = found
            return
        heads = [w for w in listed if w["zone"] == _HEAD and w["first"] in self.ways]
        offers = [(self.ways[w["first"]][0] + w["cost"], [*self.ways[w["first"]][1], (part, _HEAD, w["letters"])]) for w in heads]
        cost, steps = min(offers, key=self._order)
        self.chosen += [*steps, (part, _MIDDLE, piece["audit"])]
        self.ways = {w["last"]: (cost + w["cost"], [(part, _TAIL, w["letters"])]) for w in listed if w["zone"] == _TAIL}

    def end(self) -> list[tuple]:
        cost, steps = min((self.ways[s] for s in ACCEPTED if s in self.ways), key=self._order)
        self.chosen += steps
        gaps = self.high - self.low + 1 - self.stats["turns"] if self.low is not None else 0
        counts = {"gaps": gaps, "cost": cost, "audit": "".join(x for _, _, x in self.chosen).upper()} | {c: self.stats[c] for c in _COUNTS}
        found = [(self.conv, part, zone, letters, None) for part, zone, letters in self.chosen if zone != _MIDDLE]
        return [*found, (self.conv, None, None, None, counts)]


_COUNTED = pa.struct([(c, pa.int64()) for c in ("gaps", *_COUNTS, "cost")] + [("audit", pa.string())])
_CHOSEN = [("conv", pa.int64()), ("part", pa.int32()), ("zone", pa.int32()), ("letters", pa.string()), ("report", _COUNTED)]
_CHOSEN_SQL = "conv long, part int, zone int, letters string, report struct<" + _REPORT.replace("conv long, ", "").replace(" long", ": long").replace(" string", ": string") + ">"


def _join_pieces(batches) -> Iterator[pa.RecordBatch]:
    """Pieces come sorted by conversation and part."""
    joined = None
    for batch in batches:
        for row in batch.to_pylist():
            if joined is None or row["conv"] != joined.conv:
                if joined is not None:
                    yield _batch(joined.end(), _CHOSEN)
                joined = _Joined(row["conv"])
            joined.read(row["part"], row["piece"])
    if joined is not None:
        yield _batch(joined.end(), _CHOSEN)


def _spell(batches) -> Iterator[pa.RecordBatch]:
    """Give the waiting rows of a zone its edits; the edits come before the rows."""
    fields, out = _EDITED[:-1], []
    state = {"letters": "", "at": 0, "row": 0, "key": None}

    def inserted() -> None:
        while state["at"] < len(state["letters"]) and state["letters"][state["at"]] in "Ii":
            letter = state["letters"][state["at"]]
            out.append((*state["key"], state["at"], None, _ROLE[letter], "", letter.upper()))
            state["at"] += 1

    def until(row: int | None) -> None:
        """Go on to the edit of a row; rows that did not wait are deleted ones."""
        inserted()
        while state["at"] < len(state["letters"]) and state["row"] != row:
            state["at"] += 1
            state["row"] += 1
            inserted()

    for batch in batches:
        for row in batch.to_pylist():
            if row["letters"] is not None:
                until(None)
                state |= {"letters": row["letters"], "at": 0, "row": 0, "key": (row["conv"], row["part"], row["zone"])}
                continue
            until(row["seq"])
            letter = state["letters"][state["at"]]
            if letter != "D":
                out.append((*state["key"], state["at"], row["turn"], _ROLE.get(letter, row["role"]), row["text"], letter.upper()))
            state["at"] += 1
            state["row"] += 1
        if out:
            yield _batch(out, fields)
            out.clear()
    until(None)
    if out:
        yield _batch(out, fields)


class Repair(NamedTuple):
    """``rows``: conv, place (orders a conversation's rows), turn, role, text, edit. ``report``: a row for each conversation."""

    rows: DataFrame
    report: DataFrame


def _holds_characters(text: Column) -> Column:
    return text.rlike(r"[^\x20\x09-\x0D]")


def repair_conversations(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> Repair:
    """The cheapest edits that make every conversation's role initials ``(s?(ua)+)?``.

    A conversation's rows are taken by turn (nulls first), rows of one turn by role and text;
    a null role or text counts as one space, rows without a conversation are one conversation.
    A row's first fault counts: blank (no character but ``[\\x20\\x09-\\x0D]``), duplicate (role
    and text seen earlier in the conversation), truncated (its last other character is none of
    ``.!?``). Keeping a row costs 0 and needs a role initial that fits; another role (user or
    assistant) costs 1, deletion 2, an inserted empty turn 5, a truncated row that stays 5 more.
    Blank and duplicate rows are deleted. Of equally cheap repairs the one with the smallest
    ``audit``, the edits' initials in order, is taken.

    ``report`` has conv, gaps (missing turn numbers between the first and the last), blank,
    duplicate, truncated, illegal (adjacent role initials other than su, ua, au), cost and audit.
    ``rows`` are the kept, renamed and inserted turns (inserted ones have no turn number). A
    conversation of which nothing stays has no rows; an empty table gives empty results. Other
    columns are ignored.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(" "))
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(" "))
    turn = F.col(turn_col).cast("long")
    source = turns.select(F.col(conv_col).cast("long").alias("conv"), turn.alias("turn"), role.alias("role"), text.alias("text"))
    said = F.concat_ws(":", F.coalesce(F.col("conv").cast("string"), F.lit("")), F.octet_length("role"), "role", "text")
    # Rows alike in everything are one row with a count, however many.
    alike = source.groupBy("conv", "turn", "role", "text").agg(F.count("*").alias("times"))
    alike = stage(alike.withColumn("said", F.sha2(said.cast("binary"), 256)), "conversation-rows")
    when = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    firsts = stage(alike.groupBy("said").agg(F.min(when).alias("first")), "conversation-firsts")
    flagged = alike.join(firsts, "said").select(
        "conv",
        "turn",
        "role",
        "text",
        "times",
        (~_holds_characters(F.col("text"))).alias("blank"),
        (~F.col("turn").eqNullSafe(F.col("first.turn"))).alias("duplicate"),
        (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("truncated"),
    )
    # The beginning of a text is enough to cut ranges; within one the whole text orders.
    flagged = flagged.withColumn("begin", F.substring("text", 1, 32))
    ordered = flagged.repartitionByRange("conv", "turn", "role", "begin").sortWithinPartitions("conv", "turn", "role", "text")
    ordered = ordered.drop("begin").withColumn("part", F.spark_partition_id())
    worked = stage(map_batches(ordered, _repair, f"{_ROWS}, piece {_PIECE_SQL}"), "conversation-edits")

    whole = worked.where("piece.ended")
    cut = worked.where("not piece.ended").select("conv", "part", "piece")
    cut = cut.repartition("conv").sortWithinPartitions("conv", "part")
    chosen = stage(map_batches(cut, _join_pieces, _CHOSEN_SQL), "conversation-joined")

    waiting = worked.where("piece is null and edit is null").select("conv", "part", "zone", "seq", "turn", "role", "text")
    edits = chosen.where("letters is not null").select("conv", "part", "zone", F.lit(-1).cast("long").alias("seq"), "letters")
    mixed = waiting.unionByName(edits, allowMissingColumns=True)
    mixed = mixed.repartition("conv", "part", "zone").sortWithinPartitions("conv", "part", "zone", "seq")
    rows = worked.where("edit is not null").drop("piece").union(map_batches(mixed, _spell, _ROWS))
    rows = rows.select("conv", F.struct("part", "zone", "seq").alias("place"), "turn", "role", "text", "edit")

    gaps = F.coalesce(F.col("piece.high") - F.col("piece.low") + 1 - F.col("piece.turns"), F.lit(0)).alias("gaps")
    counts = [F.col(f"piece.{c}") for c in (*_COUNTS, "cost", "audit")]
    report = whole.select("conv", gaps, *counts).union(chosen.where("report is not null").select("conv", "report.*"))
    return Repair(rows, report)


def _hashed(batches) -> Iterator[pa.RecordBatch]:
    key, state, done = None, None, []
    for batch in batches:
        for row in batch.to_pylist():
            line = f"{row['role']}:{row['text']}".encode()
            if state is None or row["conv"] != key:
                if state is not None:
                    done.append((key, state.hexdigest()))
                key, state = row["conv"], sha256(line)
            else:
                state.update(b"\n" + line)
        if done:
            yield _batch(done, [("conv", pa.int64()), ("sha256", pa.string())])
            done = []
    if state is not None:
        yield _batch([(key, state.hexdigest())], [("conv", pa.int64()), ("sha256", pa.string())])


def conversation_digests(rows: DataFrame) -> DataFrame:
    """(conv, sha256) of the ``role:text`` lines of every conversation of ``rows`` (conv, place, role, text), newline-joined.

    One digest reads its text in order, so a conversation passes through one task, as a stream.
    """
    ordered = rows.select("conv", "place", "role", "text").repartition("conv").sortWithinPartitions("conv", "place")
    return map_batches(ordered, _hashed, "conv long, sha256 string")
