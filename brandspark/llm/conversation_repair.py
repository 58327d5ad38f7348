"""Conversation structure repair by iterative-deepening A*.

A conversation is legal if its role initials are ``(s?(ua)+)?``.  Edits of its
rows, in ASCII order of their initials: Delete (2; blank and repeated rows have
to go), Insert an empty user or assistant turn anywhere (5), Keep (0), Rerole to
user or assistant (1); a truncated row that stays costs 5 more.  The role after
an edit is fixed by the state of the automaton, so a string of initials is one
repair.  The search goes depth first in the order of the initials under a cost
bound, takes the least exceeding cost as the next bound, and keeps for each
(row, state) the largest budget known to fail; the first accepting path is the
cheapest repair, and the least one of its cost.

Rows that have to go are left out of the search: ``D`` sorts before ``I``, so
their letters stand right behind the row before them.  A conversation of more
than ``PIECE`` other rows is searched in pieces, from each state to each state,
and the pieces are put together by cost, then by letters: but for the last
piece none is a prefix of another, as an inserted turn belongs to the row behind.

Plan: equal rows are counted before they travel, as the row that occurs first is
by a map-side-combined minimum over digests.  Then one exchange by conversation
and a sort bring for each conversation its rows without texts, which decide the
repair, and after them the rows that can stay with their texts; a task reads this
as a stream and never holds a conversation's texts.  What it does hold is a few bytes a row:
the audit is one string, and its hash is sequential, so one conversation is one
task's stream however long it is.

Edge cases: a null role or text is one space; null conv_ids are one
conversation; null turns come first, equal turns go by role and digest of the
text; texts are equal if their SHA-256 is; roles go by the first character;
repeated rows are rows; extra columns are ignored; an empty table gives an
empty result.  Texts and conversations may have any length.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, read, stored

PIECE = 64
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
#: States: nothing yet, after system, after user, after assistant; where a kept initial leads, and the role an insert or rerole takes.
STEP = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
NEXT = (2, 2, 3, 2)
ROLE = ("user", "user", "assistant", "user")
ENDS = (0, 3)
FINE, CUT, BLANK, REPEATED = range(4)


def search(rows: list[tuple[str, bool]], start: int = 0, ends: tuple[int, ...] = ENDS, last: bool = True) -> tuple[int, str]:
    """(cost, initials) of the cheapest, then least, edits of (initial, truncated) rows that lead from ``start`` to one of ``ends``.

    ``ends`` has to be within reach.  Without ``last``, no turn is inserted behind the last row.
    """
    n = len(rows)
    least = [0] * (n + 1)  # of truncated rows each costs 2 at least
    for k in range(n - 1, -1, -1):
        least[k] = least[k + 1] + (min(DELETE, TRUNCATED) if rows[k][1] else 0)
    failed = [[-1] * 4 for _ in range(n + 1)]

    def edits(k: int, state: int) -> Iterator[tuple[str, int, int, int]]:
        if k < n:
            initial, truncated = rows[k]
            more = TRUNCATED if truncated else 0
            yield "D", DELETE, k + 1, state
            yield "I", INSERT, k, NEXT[state]
            if initial in STEP[state]:
                yield "K", more, k + 1, STEP[state][initial]
            yield "R", REROLE + more, k + 1, NEXT[state]
        elif last:
            yield "I", INSERT, k, NEXT[state]

    bound = least[0]
    while True:
        beyond = None
        path: list[str] = []
        stack = [(0, start, bound, edits(0, start))]
        if n == 0 and start in ends:
            return 0, ""
        while stack:
            k, state, budget, left = stack[-1]
            for letter, cost, at, to in left:
                rest = budget - cost
                need = max(least[at], failed[at][to] + 1)
                if rest < need:
                    over = bound + need - rest
                    beyond = over if beyond is None else min(beyond, over)
                    continue
                path.append(letter)
                if at == n and to in ends:
                    return bound - rest, "".join(path)
                stack.append((at, to, rest, edits(at, to)))
                break
            else:
                failed[k][state] = max(failed[k][state], budget)
                stack.pop()
                if stack:
                    path.pop()
        bound = beyond


def _reach(rows: list[tuple[str, bool]], start: int) -> list[int]:
    """States that some edits of a piece that is not the last lead to."""
    if start >= 2:
        return [2, 3]
    return [2, 3, 1] if start else [0, 2, 3, *([1] if any(initial == "s" for initial, _ in rows) else [])]


def repair_letters(rows: list[tuple[str, bool]], piece: int = PIECE) -> tuple[int, str]:
    """``search`` from the first state to the ends, in pieces where there are more rows than ``piece``."""
    if len(rows) <= piece:
        return search(rows)
    pieces = [rows[k : k + piece] for k in range(0, len(rows), piece)]
    ways: list[dict[tuple[int, int], tuple[int, str]]] = []
    for k, own in enumerate(pieces):
        final = k + 1 == len(pieces)
        ways.append({(q, r): search(own, q, (r,), final) for q in range(4) for r in _reach(own, q) if not final or r in ENDS})
    most = 1 << 60
    ahead = [{0: 0, 3: 0}]  # least cost from each state to the end, last piece first
    for way in reversed(ways):
        cost: dict[int, int] = {}
        for (q, r), (c, _) in way.items():
            cost[q] = min(cost.get(q, most), c + ahead[-1].get(r, most))
        ahead.append(cost)
    ahead.reverse()
    states, out = {0}, []
    for k, way in enumerate(ways):  # states that share the least letters so far
        best = [(letters, r) for (q, r), (c, letters) in way.items() if q in states and c + ahead[k + 1].get(r, most) == ahead[k][q]]
        letters = min(best)[0]
        out.append(letters)
        states = {r for x, r in best if x == letters}
    return ahead[0][0], "".join(out)


class _Conversation:
    """One conversation of the stream: first its rows without texts, then those that can stay."""

    def __init__(self, conv):
        self.conv = conv
        self.free: list[tuple[str, bool]] = []
        self.before = array("q", [0])  # rows that have to go, before each other row and at the end
        self.faults = [0] * 4
        self.illegal = self.turns = 0
        self.low = self.high = self.initial = None
        self.letters = None
        self.at = self.state = self.place = 0

    def see(self, turn: int | None, role: str, n: int, fault: int) -> None:
        if turn is not None and turn != self.high:
            self.turns += 1
            self.high = turn
            self.low = turn if self.low is None else self.low
        initial = role[:1]
        if self.initial is not None:
            self.illegal += self.initial + initial not in ("su", "ua", "au")
        self.initial = initial
        self.illegal += n - 1
        if fault in (FINE, CUT):
            self.free.append((initial, fault == CUT))
            self.before.append(n - 1)
            self.faults[fault] += 1
            self.faults[REPEATED] += n - 1
        else:
            self.before[-1] += n
            self.faults[fault] += n

    def solve(self) -> None:
        if self.letters is None:
            self.cost, self.letters = repair_letters(self.free)
            self.cost += DELETE * sum(self.before)
            self.free = []

    def _inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.letters[self.at : self.at + 1] == "I":
            yield "I", ROLE[self.state], ""
            self.state = NEXT[self.state]
            self.at += 1

    def keep(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """(edit, role, text) of the repaired turns up to and with this row."""
        self.solve()
        yield from self._inserted()
        letter = self.letters[self.at]
        self.at += 1
        if letter == "K":
            yield letter, role, text
            self.state = STEP[self.state][role[0]]
        elif letter == "R":
            yield letter, ROLE[self.state], text
            self.state = NEXT[self.state]

    def end(self) -> Iterator[tuple[str, str, str]]:
        self.solve()
        yield from self._inserted()

    def audit(self) -> str:
        out, rows = ["D" * self.before[0]], 0
        for letter in self.letters:
            out.append(letter)
            if letter != "I":
                rows += 1
                out.append("D" * self.before[rows])
        return "".join(out)

    def gaps(self) -> int:
        return self.high - self.low + 1 - self.turns if self.turns else 0


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Conversation, tuple[str, str, str] | None]]:
    """Each conversation with its repaired turns one by one, then with None."""
    own = None
    for batch in batches:
        for conv, kind, turn, role, n, fault, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if own is None or conv != own.conv:
                if own is not None:
                    yield from ((own, t) for t in own.end())
                    yield own, None
                own = _Conversation(conv)
            if kind == 1:
                own.see(turn, role, n, fault)
            elif kind == 2:
                yield from ((own, t) for t in own.keep(role, text))
    if own is not None:
        yield from ((own, t) for t in own.end())
        yield own, None


REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _batches(rows: Iterator[tuple], schema: pa.Schema, most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Rows as batches of at most some 4 MB of text, or one row."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 64 + sum(len(x) for x in row if isinstance(x, str))
        if size > most:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in held], schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in held], schema)


def _reports(kind: pa.DataType, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        digest = hashlib.sha256()
        for own, turn in _walk(batches):
            if turn is not None:
                digest.update(f"{chr(10) if own.place else ''}{turn[1]}:{turn[2]}".encode())
                own.place += 1
            else:
                f = own.faults
                yield own.conv, own.gaps(), f[BLANK], f[REPEATED], f[CUT], own.illegal, own.cost, own.audit(), digest.hexdigest()
                digest = hashlib.sha256()

    longs = [(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return _batches(rows(), pa.schema([("conv_id", kind), *longs, ("audit", pa.string()), ("repaired_sha256", pa.string())]))


def _turns(kind: pa.DataType, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for own, turn in _walk(batches):
            if turn is not None:
                yield own.conv, own.place, *turn
                own.place += 1

    text = [(c, pa.string()) for c in ("edit", "role", "text")]
    return _batches(rows(), pa.schema([("conv_id", kind), ("place", pa.int64()), *text]))


def _stream(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """For each conversation of ``ids``: a row that names it, its rows without texts, and with texts those that can stay."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    plain = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), blank("role"), blank("text"))
    digest = F.unhex(F.sha2("text", 256)).alias("digest")
    counted = stored(plain.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("n")).select("*", digest))
    # of texts that occur in several turns, the turn they occur in first
    first = counted.groupBy("conv_id", "role", "digest").agg(F.min(F.struct(F.col("turn").isNotNull(), "turn"))["turn"].alias("first"), F.count("*").alias("k"))
    first = first.filter("k > 1").select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "first", "k")
    joined = counted.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d")), "left")
    later = F.col("k").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first"))
    ended = F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    fault = F.when(~F.col("text").rlike(WORD), BLANK).when(later, REPEATED).when(~ended, CUT).otherwise(FINE).cast("byte")
    faulty = joined.select("conv_id", "turn", "role", "digest", "n", fault.alias("fault"), "text")
    null = lambda kind: F.lit(None).cast(kind)
    kind = lambda k: F.lit(k).cast("byte").alias("kind")
    named = ids.select("conv_id").distinct().select(
        "conv_id", kind(0), *[null(t).alias(c) for c, t in (("turn", "long"), ("role", "string"), ("n", "long"), ("fault", "byte"), ("text", "string"), ("digest", "binary"))]
    )
    narrow = faulty.select("conv_id", kind(1), "turn", "role", "n", "fault", null("string").alias("text"), "digest")
    wide = faulty.filter(F.col("fault") < BLANK).select("conv_id", kind(2), "turn", "role", "n", "fault", "text", "digest")
    every = named.union(narrow).union(wide).repartition("conv_id")
    return every.sortWithinPartitions("conv_id", "kind", "turn", "role", "digest").drop("digest")


def _mapped(rows: DataFrame, ids: DataFrame | None, run, columns: str) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_type

    kind = rows.schema["conv_id"].dataType
    stream = _stream(rows, rows if ids is None else ids)
    return stream.mapInArrow(partial(run, to_arrow_type(kind)), f"conv_id {kind.simpleString()}, {columns}")


def repair_reports(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """One row for each conversation of ``rows``, or of ``ids``: faults, cost, the edits' initials, hash of the repaired turns."""
    return _mapped(rows, ids, _reports, REPORT)


def repaired_turns(rows: DataFrame) -> DataFrame:
    """(conv_id, place, edit, role, text): the turns of the repaired conversations; ``edit`` is I, K or R."""
    return _mapped(rows, None, _turns, "place long, edit string, role string, text string")


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` with faults by the checksum of ``conv_id:turn``: dropped, emptied, unpunctuated, repeated, given to the user."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(part("text"), "[.!?]", "")).otherwise(part("text"))
    role = F.when(kind == 4, "user").otherwise(part("role"))
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.filter(kind != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def query(spark, sf_dir: str) -> DataFrame:
    """Repairs of the damaged conversations; one row for each original conv_id."""
    rows = read(spark, sf_dir, "conversations")
    return repair_reports(damaged(rows), rows)
