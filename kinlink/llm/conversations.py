"""Repair of conversations at least cost: a lightest derivation, found with Knuth's agenda.

A conversation is in order if its roles are an optional system turn and then pairs of user and assistant, or if it is
empty. Items of the deduction are [i, state]: the first i turns are dealt with and what they gave so far ends in
state. An item and a way to read turn i make an item of i + 1, an edge of a weighted hypergraph; an insertion makes one
of i. An item's value is the pair (cost, audit), costs added and letters joined. Values only grow along an edge, and
edges keep their order, so items are final in the order in which the agenda gives them out. (Two audits of one item and
one cost are never a beginning of each other: what is left of the longer would be insertions, which cost.)
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

WHITE = " \t\n\x0b\f\r"
#: Faults of a turn; the first that holds counts.
NO_FAULT, BLANK, DUPLICATE, TRUNCATED = range(4)
KEEP, REROLE, DELETE, INSERT, UNMENDED = 0, 1, 2, 5, 5

EMPTY, SYSTEM, USER, ASSISTANT = range(4)
#: state -> {initial of a role: next state}, and the state of a new user or assistant turn with its role.
NEXT = {EMPTY: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
TURN = {EMPTY: (USER, "user"), SYSTEM: (USER, "user"), USER: (ASSISTANT, "assistant"), ASSISTANT: (USER, "user")}
GOAL = (EMPTY, ASSISTANT)
LEGAL = {"su", "ua", "au"}

#: Turns in one run of the agenda. A longer conversation is derived piece by piece.
PIECE = 512
#: The end that one state reaches, any other reaches with so much more cost at most: inserting a user and an assistant turn.
SLACK = 2 * INSERT


def readings(initial: str, fault: int) -> list[tuple[int, str, str | None]]:
    """(cost, letter, initial) of each way to take a turn; the initial is None where the state decides it or nothing is left."""
    out = [(DELETE, "D", None)]
    if fault in (NO_FAULT, TRUNCATED):
        extra = UNMENDED if fault == TRUNCATED else 0
        out += [(KEEP + extra, "K", initial), (REROLE + extra, "R", None)]
    return out


def lightest(turns: list[tuple[str, int]], start: dict[int, tuple[int, str]], last: bool) -> dict[int, tuple[int, str]]:
    """{state: (cost, audit)} after the turns (initial, fault), from the items in start; the goal alone if they are the last.

    A deduction that takes a turn has two premises, the item [i, state] and a reading of turn i; it fires once the agenda
    has given out both. A reading's value is (cost, ""), so that the conclusion (cost + cost, audit + letter) is never
    below a premise. An insertion has the item as its one premise.

    Items that cost more than the lightest end by over SLACK cannot be part of a lightest derivation and are left out.
    """
    n = len(turns)
    agenda = [(cost, audit, 0, True, state, None) for state, (cost, audit) in start.items()]
    agenda += [(cost, "", i, False, letter, to) for i, turn in enumerate(turns) for cost, letter, to in readings(*turn)]
    heapq.heapify(agenda)
    items, read = [{} for _ in range(n + 1)], [[] for _ in range(n + 1)]     # final items and readings of each turn
    ends, limit = items[n], None

    def fire(i: int, state: int, reading: tuple) -> None:
        (cost, audit), (more, letter, initial) = items[i][state], reading
        after = state if letter == "D" else TURN[state][0] if letter == "R" else NEXT[state].get(initial)
        if after is not None and after not in items[i + 1]:
            heapq.heappush(agenda, (cost + more, audit + letter, i + 1, True, after, None))

    while agenda:
        cost, audit, i, is_item, what, to = heapq.heappop(agenda)
        if limit is not None and cost > limit:
            break
        if not is_item:
            read[i].append((cost, what, to))
            for state in list(items[i]):
                fire(i, state, read[i][-1])
            continue
        if what in items[i]:
            continue
        items[i][what] = (cost, audit)
        if i == n:
            if last and what in GOAL:
                return {what: (cost, audit)}
            if not last:
                limit = cost + SLACK if limit is None else limit
                if len(ends) == len(NEXT):
                    break
                continue
        for reading in read[i]:
            fire(i, what, reading)
        if TURN[what][0] not in items[i]:
            heapq.heappush(agenda, (cost + INSERT, audit + "I", i, True, TURN[what][0], None))
    return ends


@dataclass
class Repair:
    """A conversation as its turns come in, by turn. Edits that all remaining derivations share are given out and forgotten."""

    piece: int = PIECE
    turns: list = field(default_factory=list)      # (turn, role, text, fault) not given out yet
    waiting: int = 0                               # how many of them the frontier does not cover yet
    frontier: dict = field(default_factory=lambda: {EMPTY: (0, "")})
    state: int = EMPTY                             # of what was given out

    def add(self, turn, role: str, text: str, fault: int) -> list[tuple]:
        edits = self._derive(False) if self.waiting >= self.piece else []
        self.turns.append((turn, role, text, fault))
        self.waiting += 1
        return edits

    def finish(self) -> tuple[list[tuple], int]:
        """The last edits, and the cost of all."""
        edits = self._derive(True)
        return edits, next(iter(self.frontier.values()))[0]

    def _derive(self, last: bool) -> list[tuple]:
        rows = self.turns[len(self.turns) - self.waiting:]
        self.frontier = lightest([(role[:1], fault) for _, role, _, fault in rows], self.frontier, last)
        self.waiting = 0
        audits = [audit for _, audit in self.frontier.values()]
        low, high = min(audits), max(audits)
        shared = next((k for k, (x, y) in enumerate(zip(low, high)) if x != y), min(len(low), len(high)))
        self.frontier = {s: (cost, audit[shared:]) for s, (cost, audit) in self.frontier.items()}
        return self._apply(low[:shared])

    def _apply(self, audit: str) -> list[tuple]:
        """(letter, turn, role, text) of each edit; deleted turns as they were."""
        out, at = [], 0
        for letter in audit:
            after, role = TURN[self.state]
            if letter == "I":
                out.append((letter, None, role, ""))
            else:
                turn, own, text, _ = self.turns[at]
                at += 1
                if letter == "D":
                    out.append((letter, turn, own, text))
                    continue
                if letter == "K":
                    after, role = NEXT[self.state][own[:1]], own
                out.append((letter, turn, role, text))
            self.state = after
        self.turns = self.turns[at:]
        return out


# --- on tables ----------------------------------------------------------------------------------

def with_damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, present): turns damaged by crc32 of 'conv_id:turn' modulo 20.

    0 drops the turn (present is false), 1 empties its text, 2 takes '.', '!' and '?' out, 3 repeats the turn, 4 makes it
    the user's. Null roles and texts, and null ids or turns in the key, are one space.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", text("conv_id"), text("turn")).cast("binary")) % 20
    return conversations.select(
        "conv_id", "turn", kind.alias("kind"), text("role").alias("role"), text("text").alias("text"),
    ).select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (F.col("kind") != 0).alias("present"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")


def with_faults(turns: DataFrame) -> DataFrame:
    """Turns with the column fault, a conversation's all in one partition and by turn, nulls first; equal turns by role and text.

    The partitions are sorted, not gathered: what follows reads them row by row.
    """
    stripped = F.rtrim(F.col("text"), F.lit(WHITE))
    # Both windows and the last order need the conversations together, which the first line does: one shuffle.
    rows = turns.repartition("conv_id")
    earlier = F.row_number().over(Window.partitionBy("conv_id", "present", "role", "text").orderBy(F.col("turn").asc_nulls_first())) > 1
    fault = (F.when(F.length(stripped) == 0, BLANK).when(F.col("earlier"), DUPLICATE)
             .when(~F.right(stripped, F.lit(1)).isin(".", "!", "?"), TRUNCATED).otherwise(NO_FAULT))
    return (rows.withColumn("earlier", earlier).withColumn("fault", fault)
            .select("conv_id", "turn", "role", "text", "present", "fault")
            .sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text", "fault"))


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, None) at the start of each conversation, (conv_id, row) for each of its turns."""
    current, begun = None, False
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if not begun or row[0] != current:
                current, begun = row[0], True
                yield current, None
            yield current, row


SUMMARY = ("conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, "
           "repaired_sha256 string, n_turns bigint, n_repaired bigint")
EDITS = "conv_id bigint, step bigint, edit string, turn bigint, role string, text string"
ROWS_HELD = 5_000


class _Summary:
    """Counts, audit and hash of one conversation, from its turns and edits in order."""

    def __init__(self, conv_id):
        self.conv_id, self.faults, self.illegal, self.initial = conv_id, [0, 0, 0, 0], 0, None
        self.first = self.last = None
        self.distinct = self.turns = self.lines = 0
        self.audit, self.sha = [], hashlib.sha256()

    def turn(self, turn, role: str, fault: int) -> None:
        self.turns += 1
        self.faults[fault] += 1
        if self.initial is not None and self.initial + role[:1] not in LEGAL:
            self.illegal += 1
        self.initial = role[:1]
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last = turn
            self.distinct += 1

    def edits(self, edits: list[tuple]) -> None:
        for letter, _, role, text in edits:
            self.audit.append(letter)
            if letter != "D":
                self.sha.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
                self.lines += 1

    def row(self, cost: int) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.distinct
        return (self.conv_id, gaps, *self.faults[1:], self.illegal, cost, "".join(self.audit), self.sha.hexdigest(), self.turns, self.lines)


def _repaired(batches: Iterator[pa.RecordBatch], piece: int, want_edits: bool) -> Iterator[tuple]:
    """Rows of SUMMARY, or of EDITS."""
    summary = repair = None
    step = 0

    def out(edits):
        nonlocal step
        summary.edits(edits)
        for letter, turn, role, text in edits if want_edits else ():
            yield summary.conv_id, step, letter, turn, role, text
            step += 1

    def end():
        edits, cost = repair.finish()
        yield from out(edits)
        if not want_edits:
            yield summary.row(cost)

    for conv_id, row in _conversations(batches):
        if row is None:
            if summary is not None:
                yield from end()
            summary, repair, step = _Summary(conv_id), Repair(piece), 0
            continue
        _, turn, role, text, present, fault = row
        if present:
            summary.turn(turn, role, fault)
            yield from out(repair.add(turn, role, text, fault))
    if summary is not None:
        yield from end()


def _task(schema: str, piece: int, want_edits: bool):
    types = [{"bigint": pa.int64(), "string": pa.string()}[c.split()[1]] for c in schema.split(", ")]
    names = [c.split()[0] for c in schema.split(", ")]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for row in _repaired(batches, piece, want_edits):
            held.append(row)
            if len(held) == ROWS_HELD:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*held), types)], names)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*held), types)], names)

    return task


def repair_summary(turns: DataFrame, piece: int = PIECE) -> DataFrame:
    """One row per conversation: faults found, cost and letters of the cheapest edits, hash of the repaired conversation.

    turns has conv_id, turn, role, text and present (false for turns that are gone; a conversation of such turns alone
    gives zeros, an empty audit and the hash of nothing). Letters: K keep, R another role, D delete, I insert; of equal
    costs the ASCII-least audit. Null ids are one conversation; null turns come first; rows repeated with one turn are
    duplicates if role and text agree; other columns are not read; an empty table gives no rows.

    Each conversation is read once, in order, by one task, since the hash of its text cannot be computed in parts; the
    task holds one piece of it at a time and what its remaining derivations do not share.
    """
    rows = with_faults(turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), "role", "text", "present"))
    return rows.mapInArrow(_task(SUMMARY, piece, False), SUMMARY)


def repaired_turns(turns: DataFrame, piece: int = PIECE) -> DataFrame:
    """(conv_id, step, edit, turn, role, text): every edit of the cheapest repair, in order; rows with edit D are not in the result.

    Same input and cases as repair_summary. Inserted turns have a null turn and an empty text.
    """
    rows = with_faults(turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), "role", "text", "present"))
    return rows.mapInArrow(_task(EDITS, piece, True), EDITS)
