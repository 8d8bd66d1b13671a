"""Repair of conversations' structure at the least cost, by the auction algorithm for shortest paths.

The lattice of a conversation has a node for each place between its rows and each state of the grammar `(s?(ua)+)?`; edits are its arcs.
The auction extends or contracts one path and raises the prices of nodes; at its end the arcs of all cheapest repairs
are tight, and the repair whose letters are least is read off along them. Long conversations are cut into blocks of
rows, solved from the last one back: the four distances at a block's start are what leaving the block before costs.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skeinwork.llm.common import bound_batches

SPACES = " \t\n\x0b\x0c\r"
#: Costs of the edits, and what a truncated row costs that is not deleted.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: States: nothing yet, behind a system turn, behind a user turn, behind an assistant turn. What each expects next.
STATES, EXPECTED, DONE = 4, "uuau", (0, 3)
AFTER = {"s": 1, "u": 2, "a": 3}
NEVER = 1 << 40
#: Rows of a block; blocks that a worker keeps solved; bytes of a conversation's texts that are held in memory.
BLOCK, SOLVED, SPOOL = 64, 1 << 14, 8 << 20
AUDITS = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
TURNS = "conv_id long, place long, edit string, role string, text string"


def damage(conversations: DataFrame) -> DataFrame:
    """Each row, damaged by d = crc32(`conv_id:turn`) mod 20: 0 drops it (gone; it stays as a mark of its conversation), 1 empties its text, 2
    removes its `.!?`, 3 repeats it, 4 sets its role to user. Nulls in role, text and the hashed string count as one space.
    Returns conv_id, turn, role, text, gone."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    d = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    own = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), space("role").alias("role"), space("text").alias("text"), d.alias("d"))
    text = F.when(F.col("d").isin(0, 1), "").when(F.col("d") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("d") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return own.select("conv_id", "turn", F.when(F.col("d") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (F.col("d") == 0).alias("gone"), F.explode(copies)).drop("col")


def _marked(rows: DataFrame) -> DataFrame:
    """Rows with their faults, each conversation's together and in order, in one partition as Spark sorts them.

    The shuffle by conv_id serves the window as well: its keys begin with it.
    """
    end = F.rtrim(F.col("text"), F.lit(SPACES))
    marks = rows.withColumn("blank", end == "").withColumn("open", ~F.substring(end, -1, 1).isin(*".!?"))
    same = Window.partitionBy("conv_id", "gone", "role", "text").orderBy("turn")
    nth = marks.repartition("conv_id").withColumn("nth", F.row_number().over(same))
    fault = F.when(F.col("gone"), "g").when(F.col("blank"), "b").when(F.col("nth") > 1, "d").when(F.col("open"), "t").otherwise("")
    in_order = nth.sortWithinPartitions("conv_id", "turn", "role", "text", "nth")
    return in_order.select("conv_id", "turn", "role", "text", fault.alias("fault"))


@lru_cache(64)
def _arcs(code: str) -> list[list[tuple[int, int, int, str]]]:
    """Per state the arcs at a row (cost, rows taken, next state, letter), by letter. code: `-` where the row has to go, else the role's
    initial (`o`: none of the three), in capitals if it is truncated; empty behind the last row."""
    out = []
    for state, expected in enumerate(EXPECTED):
        arcs = [(INSERT, 0, AFTER[expected], "I")]
        if code:
            arcs.append((DELETE, 1, state, "D"))
        if code and code != "-":
            more, initial = TRUNCATED * code.isupper(), code.lower()
            if initial == expected or initial == "s" and state == 0:
                arcs.append((KEEP + more, 1, AFTER[initial], "K"))
            arcs.append((REROLE + more, 1, AFTER[expected], "R"))
        out.append(sorted(arcs, key=lambda a: a[3]))
    return out


@lru_cache(64)
def _least(code: str) -> int:
    """No edit of the row costs less, whatever the state."""
    return min(a[0] for arcs in _arcs(code) for a in arcs if a[1])


def auction(arcs: list[list[tuple[int, int, str]]], price: list[int], origin: int) -> None:
    """Raises the prices until the path from origin reaches the last node. price[i] <= cost + price[j] holds before, after and at every
    step for each arc, with equality along the path; so price[origin] ends as the distance."""
    path, goal = [origin], len(price) - 1
    while path[-1] != goal:
        node = path[-1]
        best, to = min((cost + price[j], j) for cost, j, _ in arcs[node])
        if price[node] < best:  # contract
            price[node] = best
            if len(path) > 1:
                path.pop()
        else:  # extend
            path.append(to)


def trace(arcs: list[list[tuple[int, int, str]]], price: list[int], origin: int) -> tuple[str, int]:
    """The least letters along tight arcs from origin to the last node, and the node before that.

    Every shortest path is tight throughout; a tight arc may still lead to a node without a tight way on, which is left for good.
    """
    goal, path, left = len(price) - 1, [(origin, "")], set()
    while path[-1][0] != goal:
        node = path[-1][0]
        step = next(((j, letter) for cost, j, letter in arcs[node] if price[node] == cost + price[j] and j not in left), None)
        if step:
            path.append(step)
        else:
            left.add(node)
            path.pop()
    return "".join(letter for _, letter in path), path[-2][0]


@lru_cache(SOLVED)
def solve(codes: str, exits: tuple[int, ...], first: bool) -> list[tuple[int, str, int]]:
    """A block of rows from each state it may be entered in (the first block: state 0): cost, letters, state it is left in. exits: what
    follows the block costs from each state; NEVER where it may not be left."""
    n = len(codes)
    goal = STATES * (n + 1)
    arcs = [[(cost, STATES * (i + taken) + to, letter) for cost, taken, to, letter in own] for i in range(n) for own in _arcs(codes[i])]
    # The block is left before anything is inserted behind its rows: what follows can insert as well.
    arcs += [[(exits[q], goal, "")] * (exits[q] < NEVER) + [(cost, STATES * n + to, letter) for cost, _, to, letter in own] for q, own in enumerate(_arcs(""))]
    price = [0] * (goal + 1)
    rest = min(exits)
    for i in range(n, -1, -1):
        rest += _least(codes[i]) if i < n else 0
        price[STATES * i : STATES * i + STATES] = [rest] * STATES
    out = []
    for origin in range(1 if first else STATES):
        auction(arcs, price, origin)
        letters, last = trace(arcs, price, origin)
        out.append((price[origin], letters, last % STATES))
    return out


def repair(codes: str) -> tuple[int, str]:
    """The least cost of the edits that put a conversation in order, and of the cheapest edits the letters that are first in ASCII."""
    starts = range(0, len(codes), BLOCK) or [0]
    exits, more, plan = tuple(0 if q in DONE else NEVER for q in range(STATES)), 0, []
    for at in reversed(starts):
        plan.append((codes[at : at + BLOCK], exits, at == 0))
        costs = [cost for cost, *_ in solve(*plan[-1])]
        low = min(costs) if at else 0
        more, exits = more + low, tuple(c - low for c in costs)
    state, letters = 0, []
    for block in reversed(plan):
        _, part, state = solve(*block)[state]
        letters.append(part)
    return more + costs[0], "".join(letters)


class Conversation:
    """One conversation as its rows pass: a code a row, counts, and the texts, on disk once they are many."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id, self.codes, self.rows, self.last = conv_id, bytearray(), 0, None
        self.blank = self.duplicate = self.truncated = self.illegal = self.distinct = 0
        self.low = self.high = None
        self.texts = tempfile.SpooledTemporaryFile(SPOOL)

    def add(self, turn: int | None, role: str, text: str, fault: str) -> None:
        if fault == "g":
            return
        self.blank += fault == "b"
        self.duplicate += fault == "d"
        self.truncated += fault == "t"
        initial = role[:1]
        self.illegal += self.rows > 0 and self.last + initial not in ("su", "ua", "au")
        if turn is not None:
            self.distinct += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        code = "-" if fault in ("b", "d") else initial if initial in AFTER else "o"
        self.codes += (code.upper() if fault == "t" else code).encode()
        self.rows, self.last = self.rows + 1, initial
        pickle.dump((role, text), self.texts)

    def repaired(self, audit: str) -> Iterator[tuple[str, str, str]]:
        """(edit, role, text) of the turns that the edits leave."""
        self.texts.seek(0)
        state = 0
        for letter in audit:
            role, text = pickle.load(self.texts) if letter != "I" else ("", "")
            if letter == "D":
                continue
            if letter != "K":
                role = {"u": "user", "a": "assistant"}[EXPECTED[state]]
            state = AFTER[role[0]]
            yield letter, role, text

    def audit(self) -> tuple:
        """The row of AUDITS."""
        cost, audit = repair(self.codes.decode())
        digest = hashlib.sha256()
        for i, (_, role, text) in enumerate(self.repaired(audit)):
            digest.update(f"{chr(10) if i else ''}{role}:{text}".encode())
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        return self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit, digest.hexdigest()

    def turns(self) -> Iterator[tuple]:
        """The rows of TURNS."""
        for i, (edit, role, text) in enumerate(self.repaired(repair(self.codes.decode())[1])):
            yield self.conv_id, i, edit, role, text


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[Conversation]:
    own = None
    for batch in batches:
        for conv_id, *row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "fault"))):
            if own is None or own.conv_id != conv_id:
                if own is not None:
                    yield own
                    own.texts.close()
                own = Conversation(conv_id)
            own.add(*row)
    if own is not None:
        yield own
        own.texts.close()


def _batches(rows: Iterator[tuple], schema: str, most: int = 10_000, most_chars: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    names, kinds = zip(*(c.split() for c in schema.split(", ")))
    held, chars = [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if k == "long" else pa.string()) for c, k in zip(zip(*held), kinds)], names=list(names))

    for row in rows:
        held.append(row)
        chars += sum(len(x) for x in row if isinstance(x, str))
        if len(held) >= most or chars > most_chars:
            yield batch()
            held, chars = [], 0
    if held:
        yield batch()


def audits(rows: DataFrame) -> DataFrame:
    """Faults and cheapest repair of each conversation of rows (conv_id, turn, role, text, gone; see damage()).

    A conversation's rows are taken by turn, nulls first, then by role and text. A row's first fault counts: blank
    (nothing but white space), duplicate (role and text seen earlier), truncated (its end is not one of `.!?`). gaps: turns missing between
    the smallest and the largest (nulls aside). illegal: neighbours whose roles' initials are not su, ua or au. Edits: Keep 0, Rerole to
    user or assistant 1, Delete 2 (blank and duplicate rows have to go), Insert an empty user or assistant turn 5; a truncated row that
    stays costs 5 more. audit: the letters of the cheapest edits that lead to `(s?(ua)+)?`, of several the ones first in ASCII;
    with the states they fix each role, so the repaired conversation as well. repaired_sha256: of its `role:text` lines.

    A conversation without rows has zeros, no audit and the digest of nothing; one of null conv_id is one of its
    own. A digest takes a conversation's texts one after the other, so one task takes them, as a stream: Spark sorts
    (and spills) them, and in memory stays one byte a row, which is the audit's own length. Other columns of rows are not read.
    """
    bound_batches(rows.sparkSession)
    return _marked(rows).mapInArrow(lambda b: _batches((c.audit() for c in _conversations(b)), AUDITS), AUDITS)


def repaired_turns(rows: DataFrame) -> DataFrame:
    """The turns of the repaired conversations: conv_id, place (from 0), edit (K, R or I), role, text."""
    bound_batches(rows.sparkSession)
    return _marked(rows).mapInArrow(lambda b: _batches((t for c in _conversations(b) for t in c.turns()), TURNS), TURNS)
