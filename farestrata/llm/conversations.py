"""Repair of a conversation's structure at the least cost, as Knuth's lightest derivations.

A sound conversation has the role initials ``(s?(ua)+)?``: maybe a system turn, then user and assistant in turn. Edits keep
a row, give it another role, delete it, or insert an empty turn; the letters of the edits, in order, are the audit.

**Deduction.** An item is a state of that pattern before the remaining rows; its weight is (cost, rows used, audit) of the best
way to the end. A rule joins a move of one row (or an insertion) to an item behind it: it adds its cost and puts its letters
in front. Every rule raises (cost, rows used) and, applied to one item, keeps the order of audits, so rules are monotone
superior functions and items popped from the agenda in order of weight are final; the run ends when the goal, the
first state before the first row, is popped. Audits of one item with equal costs are never prefixes of each other, so
ties can be broken piecewise.

**Scale.** Rows that agree in conversation, turn, role and text are one row with a count before anything is ordered. The rest
is ordered by range, so a conversation of any length spreads over tasks. A task derives whole conversations at
once; of a conversation that continues in other tasks it gives one piece: the lightest moves from every state to every other,
found block by block. Pieces are again moves, and the same agenda joins them. Texts travel twice, once to be counted and once to be
joined in order; the second time only SHA-256 makes a conversation pass through one task, as a stream.

NULL roles and texts count as one space, in the damage key also NULL ids and turns. Turns are whole numbers; others count
as NULL. Rows of one turn are taken by role, then by MD5 of the text. A row with an empty role can't be kept as it is. A NULL conversation is one like others.
Empty conversations and tables give sound, empty results; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heappop, heappush
from itertools import groupby

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farestrata.llm.common import map_arrow, stored

#: The pattern as states: 0 nothing yet, 1 after system, 2 after user, 3 after assistant; it may end in 0 and 3.
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
STATES, ENDS = range(4), (0, 3)
ROLES = {"u": "user", "a": "assistant"}
#: The only role that may be put in at a state.
DUE = {state: initial for (state, initial) in NEXT if initial in ROLES}
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 3, 4, 3, 3
SOUND, TRUNCATED, DUPLICATE, BLANK = range(4)
#: Rows that one run of the agenda takes.
BLOCK = 256
SPACES = " \t\n\x0b\x0c\r"

Moves = tuple[tuple[int, int, int, str], ...]


@lru_cache(maxsize=4_096)
def moves(initial: str, fault: int, copies: int) -> Moves:
    """State before, state after, cost and letters of everything that may happen to a row and its copies."""
    found = [(state, state, DELETE_COST * copies, DELETE * copies) for state in STATES]
    if fault in (SOUND, TRUNCATED):
        rest, letters = DELETE_COST * (copies - 1), DELETE * (copies - 1)
        rest += TRUNCATED_COST if fault == TRUNCATED else 0
        for (before, wanted), after in NEXT.items():
            if wanted == initial:
                found.append((before, after, rest, KEEP + letters))
            elif wanted in ROLES:
                found.append((before, after, rest + REROLE_COST, REROLE + letters))
    return tuple(found)


def lightest(steps: list[Moves], ends: Iterable[int], goals: Iterable[int]) -> dict[int, tuple[int, str]]:
    """(cost, audit) from each goal state before the first step to one of the end states after the last."""
    total, wanted = len(steps), set(goals)
    agenda = [(0, 0, "", state) for state in ends]
    final, found = set(), {}
    while agenda and wanted:
        cost, used, audit, state = heappop(agenda)
        if (used, state) in final:
            continue
        final.add((used, state))
        if used == total and state in wanted:
            wanted.remove(state)
            found[state] = cost, audit
        for before, initial in DUE.items():
            if NEXT[before, initial] == state:
                heappush(agenda, (cost + INSERT_COST, used, INSERT + audit, before))
        if used < total:
            for before, after, price, letters in steps[total - used - 1]:
                if after == state:
                    heappush(agenda, (cost + price, used + 1, letters + audit, before))
    return found


@lru_cache(maxsize=65_536)
def _repair(rows: tuple[tuple[str, int, int], ...]) -> tuple[int, str]:
    return lightest([moves(*row) for row in rows], ENDS, (0,))[0]


def joined(steps: list[Moves]) -> Moves:
    """All steps as one: the lightest moves between every two states."""
    return tuple(
        (before, after, cost, audit)
        for after in STATES
        for before, (cost, audit) in lightest(steps, (after,), STATES).items()
    )


# --- damage and faults ------------------------------------------------------------------------------------------------


def damage(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies`` after the contract's damage; ``copies`` is 0 for a dropped row, 2 for a repeated one."""
    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    hit = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    text = F.when(hit == 1, "").when(hit == 2, F.regexp_replace(shown("text"), "[.!?]", "")).otherwise(shown("text"))
    return conversations.select(
        "conv_id",
        F.when(hit != 0, F.col("turn").try_cast("bigint")).alias("turn"),
        F.when(hit == 0, "").when(hit == 4, ROLES["u"]).otherwise(shown("role")).alias("role"),
        F.when(hit == 0, "").otherwise(text).alias("text"),
        F.when(hit == 0, 0).when(hit == 3, 2).otherwise(1).cast("bigint").alias("copies"),
    )


def whole(conversations: DataFrame) -> DataFrame:
    """The rows as they are, in the form of :func:`damage`."""
    return conversations.select(
        "conv_id", F.col("turn").try_cast("bigint").alias("turn"),
        *[F.coalesce(F.col(name).cast("string"), F.lit(" ")).alias(name) for name in ("role", "text")],
        F.lit(1).cast("bigint").alias("copies"),
    )


def faults(rows: DataFrame) -> DataFrame:
    """One row per ``conv_id, turn, role, text`` with ``copies``, ``text_md5`` and ``fault``, that of the first copy; stored."""
    bare = F.rtrim("text", F.lit(SPACES))
    counted = stored(
        rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies")).select(
            "*",
            F.md5(F.col("text").cast("binary")).alias("text_md5"),
            F.when(bare == "", BLANK).when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), TRUNCATED).otherwise(SOUND).alias("own"),
        ),
        "turns",
    )
    at = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    again = stored(
        counted.where("copies > 0").groupBy("conv_id", "role", "text_md5").agg(F.min(at).alias("first"), F.max(at).alias("last"))
        .where("first != last")
        .select(F.col("conv_id").alias("a_conv"), F.col("role").alias("a_role"), F.col("text_md5").alias("a_md5"), "first"),
        "turns-again",
    )
    same = F.col("conv_id").eqNullSafe(F.col("a_conv")) & (F.col("role") == F.col("a_role")) & (F.col("text_md5") == F.col("a_md5"))
    repeated = F.coalesce(at > F.col("first"), F.lit(False))
    return stored(
        counted.join(again, same, "left").select(
            "conv_id", "turn", "role", "text_md5", "text", "copies",
            F.when((F.col("own") != BLANK) & repeated, DUPLICATE).otherwise(F.col("own")).alias("fault"),
        ),
        "turn-faults",
    )


# --- derivation -------------------------------------------------------------------------------------------------------

ORDER = ("conv_id", "turn", "role", "text_md5")
COUNTS = ("blank", "duplicate", "truncated", "illegal")
PIECE = (
    "part int, first string, last string, low bigint, high bigint, turns bigint, "
    + ", ".join(f"{name} bigint" for name in COUNTS)
    + ", cost bigint, audit string, moves array<struct<before:int,after:int,cost:bigint,audit:string>>"
)
PIECE_FIELDS = [field.strip().split(" ")[0] for field in PIECE.split(", ")]


class Stretch:
    """Consecutive rows of one conversation, read once: what is counted, and the moves so far."""

    def __init__(self) -> None:
        self.first = self.last = self.low = self.high = None
        self.turns = 0
        self.counts = dict.fromkeys(COUNTS, 0)
        self.rows: list[tuple[str, int, int]] = []
        self.blocks: list[list[Moves]] = [[]]

    def follow(self, first: str, last: str, low: int | None, high: int | None, turns: int) -> None:
        """Count what comes next: its first and last initials, its smallest and largest turn, and how many turns it has."""
        if self.last is not None and (self.last, first) not in (("s", "u"), ("u", "a"), ("a", "u")):
            self.counts["illegal"] += 1
        self.first = first if self.first is None else self.first
        self.last = last
        if low is not None:
            self.turns += turns - (low == self.high)
            self.low = low if self.low is None else self.low
            self.high = high

    def add(self, turn: int | None, role: str, copies: int, fault: int) -> None:
        if not copies:
            return
        initial = role[:1]
        self.follow(initial, initial, turn, turn, 1)
        self.counts["illegal"] += copies - 1
        if fault == BLANK:
            self.counts["blank"] += copies
        else:
            self.counts["duplicate"] += copies - (fault != DUPLICATE)
            self.counts["truncated"] += fault == TRUNCATED
        self.rows.append((initial, fault, copies))
        if len(self.rows) > BLOCK:
            self.push([moves(*row) for row in self.rows[:BLOCK]])
            self.rows = self.rows[BLOCK:]

    def push(self, steps: list[Moves], level: int = 0) -> None:
        """Join a full block of steps; ``BLOCK`` blocks are joined again, so few are held whatever the length."""
        if level == len(self.blocks):
            self.blocks.append([])
        self.blocks[level].append(joined(steps))
        if len(self.blocks[level]) == BLOCK:
            full, self.blocks[level] = self.blocks[level], []
            self.push(full, level + 1)

    def steps(self) -> list[Moves]:
        older = [step for level in reversed(self.blocks) for step in level]
        return older + [moves(*row) for row in self.rows]

    def piece(self, part: int, open_: bool) -> dict:
        """The fields of a row; open ones keep their moves, others have their repair."""
        found = {"part": part, "first": self.first, "last": self.last, "low": self.low, "high": self.high,
                 "turns": self.turns, **self.counts, "cost": None, "audit": None, "moves": None}
        if open_:
            names = ("before", "after", "cost", "audit")
            found["moves"] = [dict(zip(names, move, strict=True)) for move in joined(self.steps())]
        elif any(self.blocks):
            found["cost"], found["audit"] = lightest(self.steps(), ENDS, (0,))[0]
        else:
            found["cost"], found["audit"] = _repair(tuple(self.rows))
        return found


def _rows(batches) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


def _in_chunks(found: Iterable[tuple], size: int = 1_000) -> Iterator[tuple[list, ...]]:
    """Rows as tuples of columns."""
    chunk: list[tuple] = []
    for row in found:
        chunk.append(row)
        if len(chunk) == size:
            yield tuple(map(list, zip(*chunk, strict=True)))
            chunk = []
    if chunk:
        yield tuple(map(list, zip(*chunk, strict=True)))


def verdicts(rows: DataFrame) -> DataFrame:
    """``conv_id``, the counts, ``gaps, cost`` and ``audit`` of every conversation, from the rows of :func:`faults`."""
    kind = dict(rows.dtypes)["conv_id"]
    schema = f"conv_id {kind}, {PIECE}"

    def derive(batches) -> Iterator[tuple]:
        """A conversation at either end of the task may go on in another one; those between are whole."""
        part = TaskContext.get().partitionId()

        def pieces() -> Iterator[tuple]:
            pending = None
            for place, (key, own) in enumerate(groupby(_rows(batches), key=lambda row: row[0])):
                if pending:
                    yield (pending[0], *pending[1].piece(part, pending[2]).values())
                stretch = Stretch()
                for row in own:
                    stretch.add(*row[1:])
                pending = key, stretch, place == 0
            if pending:
                yield (pending[0], *pending[1].piece(part, True).values())

        yield from _in_chunks(pieces())

    ordered = rows.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    pieces = stored(map_arrow(ordered.select("conv_id", "turn", "role", "copies", "fault"), derive, schema), "turn-pieces")

    def combine(batches) -> Iterator[tuple]:
        def ended() -> Iterator[tuple]:
            for key, own in groupby(_rows(batches), key=lambda row: row[0]):
                stretch, steps = Stretch(), []
                for _, *values in own:
                    row = dict(zip(PIECE_FIELDS, values, strict=True))
                    if row["first"] is not None:
                        stretch.follow(row["first"], row["last"], row["low"], row["high"], row["turns"])
                    for name in COUNTS:
                        stretch.counts[name] += row[name]
                    steps.append(tuple((m["before"], m["after"], m["cost"], m["audit"]) for m in row["moves"]))
                cost, audit = lightest(steps, ENDS, (0,))[0]
                yield (key, *(stretch.piece(0, False) | {"cost": cost, "audit": audit}).values())

        yield from _in_chunks(ended())

    # a few pieces per task, never rows: a conversation has one in each task that holds rows of it
    cut = pieces.where("moves IS NOT NULL").repartition("conv_id").sortWithinPartitions("conv_id", "part")
    found = pieces.where("moves IS NULL").union(map_arrow(cut, combine, schema))
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0))
    return found.select("conv_id", gaps.alias("gaps"), *COUNTS, "cost", "audit")


def _edited(audit: str, own: Iterator[tuple]) -> Iterator[tuple[str, str, str, str]]:
    """Letter, role as it was, role and text of every turn that stays, from an audit and ``role, text, copies`` in order."""
    state, at = 0, 0

    def put_in() -> Iterator[tuple[str, str, str, str]]:
        nonlocal state, at
        while at < len(audit) and audit[at] == INSERT:
            due = DUE[state]
            state, at = NEXT[state, due], at + 1
            yield INSERT, "", ROLES[due], ""

    for role, text, copies in own:
        for _ in range(copies):
            yield from put_in()
            letter, at = audit[at], at + 1
            if letter != DELETE:
                due = role[:1] if letter == KEEP else DUE[state]
                state = NEXT[state, due]
                yield letter, role, role if letter == KEEP else ROLES[due], text
    yield from put_in()


def _in_order(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Every conversation's verdict followed by its rows."""
    nothing = {"gaps": "bigint", **dict.fromkeys(COUNTS, "bigint"), "cost": "bigint", "audit": "string"}
    turns = rows.where("copies > 0").select(
        "conv_id", F.lit(1).alias("kind"), "turn", "role", "text_md5",
        # what is surely deleted needs no text
        F.when(F.col("fault").isin(SOUND, TRUNCATED), F.col("text")).alias("text"), "copies",
        *[F.lit(None).cast(kind).alias(name) for name, kind in nothing.items()],
    )
    heads = found.select(
        "conv_id", F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("turn"),
        *[F.lit(None).cast("string").alias(name) for name in ("role", "text_md5", "text")],
        F.lit(None).cast("bigint").alias("copies"), *nothing,
    )
    return turns.union(heads).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "text_md5")


def _conversations(batches) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """The verdict row of each conversation, and its rows as ``role, text, copies``."""
    for _, own in groupby(_rows(batches), key=lambda row: row[0]):
        yield next(own), ((row[3], row[5], row[6]) for row in own)


def repaired_turns(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The repaired conversations: ``conv_id, position, edit, role_before, role, text``."""
    def run(batches) -> Iterator[tuple]:
        yield from _in_chunks(
            (head[0], place, *turn)
            for head, own in _conversations(batches)
            for place, turn in enumerate(_edited(head[-1], own))
        )

    kind = dict(rows.dtypes)["conv_id"]
    schema = f"conv_id {kind}, position bigint, edit string, role_before string, role string, text string"
    return map_arrow(_in_order(rows, found), run, schema)


def repair_digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The verdicts with ``repaired_sha256``, the digest of the repaired ``role:text``, joined by line feeds."""
    def run(batches) -> Iterator[tuple]:
        def digests() -> Iterator[tuple]:
            for head, own in _conversations(batches):
                whole_text = hashlib.sha256()
                for place, (_, _, role, text) in enumerate(_edited(head[-1], own)):
                    whole_text.update(f"{chr(10) if place else ''}{role}:{text}".encode())
                yield head[0], *head[7:], whole_text.hexdigest()

        yield from _in_chunks(digests())

    kind = dict(rows.dtypes)["conv_id"]
    counts = ", ".join(f"{name} bigint" for name in ("gaps", *COUNTS, "cost"))
    return map_arrow(_in_order(rows, found), run, f"conv_id {kind}, {counts}, audit string, repaired_sha256 string")
